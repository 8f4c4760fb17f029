"""Isotonic fit by pooled blocks that merge (M3).

Scores are counted first (label sum and weight per distinct score) and sorted in ranges. Each
range pools its own violators: a block is a run of scores with one mean, means
ascend. Pooling a part first never changes the fit of the whole, so neighbouring ranges are
merged ``FAN_IN`` at a time until one list is left. What moves and what the
last merge holds are blocks: with labels 0 and 1 at most about n^(2/3) of n rows, since so many
rows are needed for that many different ascending means. No array of scores comes to the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAN_IN = 8
#: blocks that are sent to the tasks at a time (24 bytes each)
MAX_BLOCKS = 1 << 20
BLOCK = "part bigint, lo double, hi double, total double, weight double"


def pooled(blocks: np.ndarray) -> np.ndarray:
    """Blocks (lo, hi, total, weight) in score order with ascending means: every descending
    run is one block, again and again until none is left."""
    while len(blocks) > 1:
        mean = blocks[:, 2] / blocks[:, 3]
        first = np.concatenate(([True], mean[1:] > mean[:-1]))
        if first.all():
            break
        at = np.flatnonzero(first)
        ends = np.append(at[1:], len(blocks)) - 1
        blocks = np.column_stack([blocks[at, 0], blocks[ends, 1], np.add.reduceat(blocks[:, 2], at), np.add.reduceat(blocks[:, 3], at)])
    return blocks


def _table(part: int, blocks: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.full(len(blocks), part, np.int64)), *[pa.array(np.ascontiguousarray(blocks[:, i])) for i in range(4)]]


def _pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros((0, 4))
    for batch in batches:
        score, total, weight = (batch.column(i).to_numpy() for i in range(3))
        held = pooled(np.concatenate([held, np.column_stack([score, score, total, weight])]))
    yield pa.RecordBatch.from_arrays(_table(TaskContext.get().partitionId(), held), names=["part", "lo", "hi", "total", "weight"])


def _merge(parts: pa.Table) -> pa.Table:
    blocks = np.column_stack([parts[c].to_numpy() for c in ("lo", "hi", "total", "weight")])
    return pa.table(_table(parts["part"][0].as_py(), pooled(blocks[np.argsort(blocks[:, 0], kind="stable")])),
                    names=["part", "lo", "hi", "total", "weight"])


class Isotonic:
    """The fitted map; ``blocks`` is its table ``lo, hi, value, weight``."""

    def __init__(self, blocks: DataFrame, score_col: str, out: str = "calibrated"):
        self.blocks, self.score_col, self.out = blocks, score_col, out
        self.n = blocks.count()

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the fitted value: a block's mean inside it, linear between blocks, the first or last mean
        outside. NULL and NaN scores, and a fit without rows, give NULL. More than ``MAX_BLOCKS``
        blocks are applied in passes, each with the blocks of one range of scores."""
        x = F.col(self.score_col).cast("double")
        x = F.when(~F.isnan(x), x)
        if not self.n:
            return df.withColumn(self.out, F.lit(None).cast("double"))
        passes = -(-self.n // MAX_BLOCKS)
        if passes == 1:
            return df.withColumn(self.out, self._values(None, None)(x))
        cuts = self.blocks.agg(F.percentile_approx("lo", [i / passes for i in range(1, passes)], 10 * passes)).first()[0]
        df = df.withColumn(self.out, F.lit(None).cast("double"))
        for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
            inside = (F.lit(True) if lo is None else x >= lo) & (F.lit(True) if hi is None else x < hi)
            df = cut_lineage(df.withColumn(self.out, F.when(inside, self._values(lo, hi)(x)).otherwise(F.col(self.out))))
        return df

    def _values(self, lo: float | None, hi: float | None):
        """The map on scores from ``lo`` up to ``hi``, from the blocks there and the two next to them."""
        b = self.blocks.select("lo", "hi", "value")
        own = b.where((F.lit(True) if lo is None else F.col("lo") >= lo) & (F.lit(True) if hi is None else F.col("lo") < hi))
        if lo is not None:
            own = own.unionByName(b.where(F.col("lo") < lo).orderBy(F.col("lo").desc()).limit(1))
        if hi is not None:
            own = own.unionByName(b.where(F.col("lo") >= hi).orderBy("lo").limit(1))
        rows = own.orderBy("lo").toPandas()          # about MAX_BLOCKS rows
        at, value = np.ravel(rows[["lo", "hi"]].to_numpy(float)), np.repeat(rows["value"].to_numpy(float), 2)

        def run(scores: pa.Array) -> pa.Array:
            v = scores.to_numpy(zero_copy_only=False).astype(float)
            return pa.array(np.interp(v, at, value), mask=np.isnan(v))
        return F.arrow_udf(run, "double")


def fit(scored: DataFrame, score_col: str = "score", label: str = "label", weight: str | None = None) -> Isotonic:
    """Isotonic (ascending) regression of the label on the score; rows without either take no part."""
    x, w = F.col(score_col).cast("double"), F.col(weight).cast("double") if weight else F.lit(1.0)
    points = scored.where(x.isNotNull() & ~F.isnan(x) & F.col(label).isNotNull() & (w > 0)).groupBy((x + 0.0).alias("score")).agg(
        F.sum(w * F.col(label).cast("double")).alias("total"), F.sum(w).alias("weight"))
    blocks = points.repartitionByRange("score").sortWithinPartitions("score").mapInArrow(_pool, BLOCK)
    n = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while n > 1:
        blocks = blocks.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInArrow(_merge, BLOCK)
        n = -(-n // FAN_IN)
    return Isotonic(cut_lineage(blocks.select("lo", "hi", (F.col("total") / F.col("weight")).alias("value"), "weight")), score_col)
