"""Hard-negative mining by a vertical (BOND) scan over blocks of rows.

Vectors are compared by the integer inner product of their scaled components.
Rows lie in blocks, one array per dimension. For an anchor the dimensions are
read in descending order of its own components' magnitude. After every few of
them, what the unread ones can still add to a row is bounded by their smallest
and largest value in the block, and rows whose score can't matter any more
leave the bitmap of candidates. The survivors' sums are exact.

Two scans: the first finds each anchor's best rows of its own label, the second
the best rows of other labels within the score window of each of them. Blocks
of anchors meet blocks of rows by an equi-join on (anchor block, row block);
both have a bounded number of rows, whatever the table holds. No block sends
more than ``n`` rows for an anchor (and positive) to the merge.

Defined results: a row without id or label, without vector, or with a null or
non-finite component takes no part; of several rows with one id the smallest by
label and vector does. Vectors of different lengths are compared over their
shared dimensions, an empty vector scores 0 with every row. Ties go to the
smaller id. Fewer rows than asked for are all returned; an anchor without a
positive, or a positive with no row in its window, returns none; an empty table
gives an empty result. Extra columns are ignored. Scaled components beyond
``LIMIT`` are refused with an error, so every score is exact in a long.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

LIMIT = 1 << 24
#: rows and anchors of a block
BLOCK_ROWS, BLOCK_ANCHORS = 1 << 14, 1 << 12
#: dimensions read between two looks at the bounds
STEP = 8


def usable(vec: Column) -> Column:
    """No null and no non-finite component."""
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def scaled(vec: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component."""
    def one(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) <= LIMIT, y.cast("int")).otherwise(
            F.raise_error(F.lit("component out of range")).cast("int"))
    return F.transform(vec, one)


def matrix(lists: pa.ChunkedArray, width: int, dtype: type) -> np.ndarray:
    """Dimensions x rows; short vectors are filled up with zeros."""
    lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    flat = lists.flatten().to_numpy()
    if (sizes == width).all():
        return np.ascontiguousarray(flat.reshape(len(sizes), width).T, dtype)
    out = np.zeros((width, len(sizes)), dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), row] = flat
    return out


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    some = np.flatnonzero(scores >= _kth(scores, k))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def vertical_scan(rows: np.ndarray, least: np.ndarray, most: np.ndarray, anchor: np.ndarray, alive: np.ndarray,
                  narrow: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The rows left of ``alive`` (a bitmap over the block) and their exact scores;
    ``narrow(lowest, highest)`` tells which candidates can still matter."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    order = order[anchor[order] != 0]
    a = anchor[order]
    ends = a * least[order], a * most[order]
    rest = [np.concatenate((np.cumsum(f(*ends)[::-1])[::-1], [0])) for f in (np.minimum, np.maximum)]
    left = np.flatnonzero(alive)
    sums = np.zeros(len(left), rows.dtype)
    for j in range(0, len(order), STEP):
        part = rows[order[j:j + STEP]]
        sums = sums + a[j:j + STEP] @ (part if len(left) == part.shape[1] else part[:, left])
        read = min(j + STEP, len(order))
        keep = narrow(sums + rest[0][read], sums + rest[1][read])
        if not keep.all():
            left, sums = left[keep], sums[keep]
    return left, sums


def _of_top(k: int):
    return lambda low, high: high >= _kth(low, k)


def _of_windows(windows: list[tuple[int, int]], k: int):
    def narrow(low, high):
        keep = np.zeros(len(low), bool)
        for lo, hi in windows:
            # k rows that are surely inside rule out what can't reach the worst of them
            sure = low[(low >= lo) & (high <= hi)]
            keep |= (high >= max(lo, _kth(sure, k))) & (low <= hi)
        return keep
    return narrow


def _scan(n: int, own_label: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The cogrouped step of one block of rows and one of anchors."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and anchors.num_rows:
            lists = rows["vec"].combine_chunks(), anchors["vec"].combine_chunks()
            width = max(int(np.diff(x.offsets.to_numpy()).max()) for x in lists)
            peak = [max(1, int(np.abs(x.flatten().to_numpy()).max(initial=0))) for x in lists]
            # doubles hold these integers exactly as long as no sum can leave 53 bits
            dtype = np.float64 if peak[0] * peak[1] * max(width, 1) < 1 << 52 else np.int64
            x, y = (matrix(t["vec"], width, dtype) for t in (rows, anchors))
            least, most = (x.min(axis=1), x.max(axis=1)) if width else (x[:, 0], x[:, 0])
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            names, own = anchors["id"].to_numpy(), anchors["label"].to_numpy()
            wanted = None if own_label else anchors["positives"].to_pylist()
            for i in range(len(names)):
                if own_label:
                    left, scores = vertical_scan(x, least, most, y[:, i], (labels == own[i]) & (ids != names[i]), _of_top(n))
                    at = best(scores, ids[left], n)
                    found.append((np.full(len(at), names[i]), np.full(len(at), -1), ids[left][at], scores[at]))
                    continue
                windows = [(p["lo"], p["hi"]) for p in wanted[i]]
                left, scores = vertical_scan(x, least, most, y[:, i], labels != own[i], _of_windows(windows, n))
                for p in wanted[i]:
                    inside = np.flatnonzero((scores >= p["lo"]) & (scores <= p["hi"]))
                    at = inside[best(scores[inside], ids[left][inside], n)]
                    found.append((np.full(len(at), names[i]), np.full(len(at), p["nth"]), ids[left][at], scores[at]))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table(columns, names=["anchor_id", "nth", "id", "score"])
    return run


FOUND = "anchor_id bigint, nth bigint, id bigint, score bigint"


def _met(rows: DataFrame, anchors: DataFrame, cells: int, blocks: int, n: int, own_label: bool) -> DataFrame:
    """The best ``n`` rows of every anchor (and positive) over all blocks of rows."""
    left = rows.withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(cells))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    # names of their own: both sides come from one table
    right = anchors.select(*[F.col(c).alias(c) for c in anchors.columns]).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))).withColumn(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
    found = left.groupBy("block", "cell").cogroup(right.groupBy("block", "cell")).applyInArrow(_scan(n, own_label), FOUND)
    order = Window.partitionBy("anchor_id", "nth").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", label: Column | str = "label",
                   vec_col: str = "embedding", n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
                   scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` picks the anchors by the id column. The negatives of a positive
    of score p are the best rows of another label with a score from ``low`` to
    ``high`` per cent of p.
    """
    label = F.col(label) if isinstance(label, str) else label
    used = df.where(F.col(id_col).isNotNull() & label.isNotNull() & usable(F.col(vec_col)))
    # one row per id; the scaled vectors are read by a count and two scans
    rows = cut_lineage(used.select(F.col(id_col).cast("long").alias("id"), is_anchor.alias("anchor"), F.struct(
        label.cast("long").alias("label"), scaled(F.col(vec_col), scale).alias("vec")).alias("row"))
        .groupBy("id").agg(F.min("row").alias("row"), F.max("anchor").alias("anchor")).select("id", "row.*", "anchor"))
    sizes = rows.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    cells = max(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sizes[0] // BLOCK_ROWS))
    blocks = max(1, -(-sizes[1] // BLOCK_ANCHORS))
    anchors, rows = rows.where("anchor").select("id", "label", "vec"), rows.select("id", "label", "vec")
    positives = cut_lineage(_met(rows, anchors, cells, blocks, n_positives, True).select(
        "anchor_id", F.col("rank").cast("long").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    p = F.col("positive_score")
    lo, hi = -F.floor(p * F.lit(-low) / F.lit(100.0)), F.floor(p * F.lit(high) / F.lit(100.0))
    # whole numbers again: the quotient by 100 may round at large scores
    lo = F.when(lo * 100 < p * low, lo + 1).when((lo - 1) * 100 >= p * low, lo - 1).otherwise(lo)
    hi = F.when(hi * 100 > p * high, hi - 1).when((hi + 1) * 100 <= p * high, hi + 1).otherwise(hi)
    windows = positives.select("anchor_id", F.struct("nth", lo.alias("lo"), hi.alias("hi")).alias("w")).where("w.lo <= w.hi")
    windows = windows.groupBy("anchor_id").agg(F.collect_list("w").alias("positives"))     # at most n_positives elements
    wanted = anchors.join(windows.withColumnRenamed("anchor_id", "id"), "id")
    negatives = _met(rows, wanted, cells, blocks, n_negatives, False)
    return negatives.join(positives, ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
