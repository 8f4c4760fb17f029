"""SimHash near-dedup: pigeonhole blocks, join on blocks, verified by Hamming distance.

1. ``fingerprint``: XXH64 of every word shingle of the whole text, computed for
   all shingles of a batch at once, and the majority of each bit.
2. ``links``: the distinct fingerprints are cut into ``max_bits + 4`` blocks. Two
   that differ in at most ``max_bits`` bits agree on all blocks but ``max_bits``,
   whichever these are, so they meet in a group that shares those blocks.
   Within a group the pairs are verified by Hamming distance, and the group
   returns one link per fingerprint (to the smallest it is connected with in
   the group), never its pairs. Groups of more than ``SPLIT`` fingerprints are
   grouped again on blocks of the bits that are still free, which leaves few.
3. ``components``: alternating large-star and small-star rounds, each
   checkpointed, until the links stop changing.

Defined results: null and empty texts have fingerprint zero and are linked like
any other; fewer words than a shingle count as one shingle; identical rows are
one fingerprint; the component id is the smallest non-null ``doc_id`` in reach
(null if there is none); texts of any length are hashed whole; an empty table gives
an empty result. ``near_groups`` ignores extra columns, ``keep_one`` carries them
inside a struct, so names like ``fp`` or ``id`` don't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import ragged
from riskframe.session import cut_lineage

SHINGLE, MAX_BITS, SEED = 3, 2, 42
#: spans of more bytes than this are hashed by the library
LONG = 1024
#: more distinct fingerprints than this in a group are grouped again
SPLIT = 1024

_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64(buf: np.ndarray, view: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of byte spans, all at once; those over ``LONG`` bytes (few, each of a long word) one by one."""
    size = ends - starts
    h = (size.astype(np.uint64) + np.uint64(seed)) + _P5
    pos = starts.copy()
    striped = np.flatnonzero((size >= 32) & (size <= LONG))
    if len(striped):
        # four lanes of eight bytes a stripe
        first = seed + np.array([int(_P1) + int(_P2), int(_P2), 0, -int(_P1)], object)
        lane = np.repeat(np.array([int(x) % (1 << 64) for x in first], np.uint64)[:, None], len(striped), axis=1)
        rows = np.arange(len(striped))
        while len(rows):
            at = pos[striped[rows]]
            for i in range(4):
                lane[i, rows] = _rot(lane[i, rows] + view[at + 8 * i] * _P2, 31) * _P1
            pos[striped[rows]] += 32
            rows = rows[ends[striped[rows]] - pos[striped[rows]] >= 32]
        x = _rot(lane[0], 1) + _rot(lane[1], 7) + _rot(lane[2], 12) + _rot(lane[3], 18)
        for i in range(4):
            x = (x ^ (_rot(lane[i] * _P2, 31) * _P1)) * _P1 + _P4
        h[striped] = x + size[striped].astype(np.uint64)
    rows = np.flatnonzero((ends - pos >= 8) & (size <= LONG))
    while len(rows):
        h[rows] = _rot(h[rows] ^ (_rot(view[pos[rows]] * _P2, 31) * _P1), 27) * _P1 + _P4
        pos[rows] += 8
        rows = rows[ends[rows] - pos[rows] >= 8]
    rows = np.flatnonzero((ends - pos >= 4) & (size <= LONG))
    h[rows] = _rot(h[rows] ^ ((view[pos[rows]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    pos[rows] += 4
    rows = np.flatnonzero((ends > pos) & (size <= LONG))
    while len(rows):
        h[rows] = _rot(h[rows] ^ ((view[pos[rows]] & np.uint64(0xFF)) * _P5), 11) * _P1
        pos[rows] += 1
        rows = rows[ends[rows] > pos[rows]]
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    data = memoryview(np.ascontiguousarray(buf))
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]], seed=seed)
    return h


def majority(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bits set in over half of ``h[bounds[i]:bounds[i + 1]]`` (none: zero)."""
    n = np.diff(bounds)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n > 0)
    if len(full):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, bounds[full], axis=0, dtype=np.int32)
        set_bits = np.packbits(ones * 2 > n[full, None], axis=1, bitorder="little")
        out[full] = np.ascontiguousarray(set_bits).view("<u8").ravel()
    return out


def slice_fingerprints(buf: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    low = ragged.LOWER[buf]
    mask = ragged.WORD[low]
    starts, ends = ragged.spans(mask)
    bounds = np.searchsorted(starts, offsets)
    # one space after every word: a shingle is then one span of bytes
    keep = mask.copy()
    keep[ends] = True
    low[ends] = 0x20
    packed, at = low[keep], np.cumsum(keep) - keep
    starts, ends = at[starts], at[ends]
    n_words = np.diff(bounds)
    n = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    to = np.concatenate(([0], np.cumsum(n)))
    first = np.arange(to[-1]) + np.repeat(bounds[:-1] - to[:-1], n)
    last = np.minimum(first + shingle, np.repeat(bounds[1:], n)) - 1
    return majority(xxh64(packed, ragged.lanes(packed), starts[first], ends[last]), to)


def fingerprint(text: Column | str, shingle: int = SHINGLE) -> Column:
    """64-bit SimHash of a text column (as a signed long)."""
    def run(texts: pa.Array) -> pa.Array:
        parts = [slice_fingerprints(buf, offsets, shingle) for _, _, buf, offsets in ragged.slices(texts)]
        return pa.array((np.concatenate(parts) if parts else np.zeros(0, np.uint64)).view(np.int64))
    # as nondeterministic: no filter on it is pushed below, so it runs once per row
    return F.arrow_udf(run, "bigint").asNondeterministic()(ragged.terminated(text))


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    return [x.tolist() for x in np.array_split(np.array(bits), n)]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def block_masks(max_bits: int) -> list[list[int]]:
    """For every choice of ``max_bits`` blocks that may differ: the bits of the others."""
    blocks = _blocks(list(range(64)), max_bits + 4)
    return [sum((b for i, b in enumerate(blocks) if i not in out), []) for out in combinations(range(len(blocks)), max_bits)]


def _grouped(rows: DataFrame, masks: list[list[int]], *keys: str) -> DataFrame:
    """Distinct fingerprints that agree on the bits of one mask, as arrays."""
    tables = F.array(*[F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
                       for t, m in enumerate(masks)])
    return (rows.select(*keys, "fp", F.inline(tables)).groupBy(*keys, "table", "part")
            .agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1))


def star_of(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of one group: each fingerprint to the smallest it is connected with."""
    fps = np.sort(fps)
    near = np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)[None, :]) <= max_bits
    root = np.arange(len(fps))
    while True:
        low = np.where(near, root[None, :], len(fps)).min(axis=1)
        low = low[low]
        if (low == root).all():
            break
        root = low
    rows = np.flatnonzero(root != np.arange(len(fps)))
    return fps[rows], fps[root[rows]]


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v), u > v: links that connect all distinct fingerprints at ``max_bits`` or fewer bits."""
    masks = block_masks(max_bits)
    # a fingerprint is a few bytes here and a row per mask below: spread them before
    partitions = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = cut_lineage(_grouped(fingerprints.select("fp").distinct().repartition(partitions, "fp"), masks))
    finer = None
    for t, mask in enumerate(masks):
        free = [b for b in range(64) if b not in mask]
        blocks = _blocks(free, max_bits + 4)
        again = [mask + sum((b for i, b in enumerate(blocks) if i not in out), [])
                 for out in combinations(range(len(blocks)), max_bits)]
        tables = F.array(*[F.struct(F.lit(i).alias("sub"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(again)])
        pick = F.when(F.col("table") == t, tables)
        finer = pick if finer is None else F.coalesce(finer, pick)
    split = (groups.where(F.size("fps") > SPLIT).select("table", F.explode("fps").alias("fp"), finer.alias("tables"))
             .select("table", "fp", F.inline("tables"))
             .groupBy("table", "sub", F.col("fp").bitwiseAND(F.col("mask")).alias("part"))
             .agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1))
    small = groups.where(F.size("fps") <= SPLIT).select("fps").unionByName(split.select("fps"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            at, values = column.offsets.to_numpy(), column.values.to_numpy()
            stars = [star_of(values[a:b], max_bits) for a, b in zip(at[:-1], at[1:], strict=True)]
            u, v = (np.concatenate([s[i] for s in stars]) if stars else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
    return small.mapInArrow(verify, "u bigint, v bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that is not the smallest of its component, and that smallest node.

    Large-star links each larger neighbour of a node to its smallest one,
    small-star the smaller ones and itself; in turn they end in one star per
    component after about log(nodes) rounds.
    """
    edges, state = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = cut_lineage(small.select("e.u", "e.v").where("u <> v").distinct())


def near_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long) and component_id."""
    rows = cut_lineage(docs.select("doc_id", fingerprint("text", shingle).alias("fp")))
    rooted, best = _rooted(rows, max_bits)
    component = rooted.join(best, "root").select("fp", F.when(~F.col("best.no_id"), F.col("best.id")).alias("component_id"))
    return rows.join(component, "fp").select("doc_id", "fp", "component_id")


def _id() -> list[Column]:
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id")]


def _rooted(rows: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of every distinct fingerprint; (root, best): the smallest id of
    each component, null ids last, with its fingerprint and ``key`` if the rows have one."""
    own = rows.groupBy("fp").agg(F.min(F.struct(*_id(), "fp", *[c for c in ("key",) if c in rows.columns])).alias("own"))
    stars = components(links(own, max_bits)).withColumnsRenamed({"u": "fp", "v": "root"})
    rooted = cut_lineage(own.join(stars, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    return rooted.select("fp", "root"), rooted.groupBy("root").agg(F.min("own").alias("best"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every component (its smallest ``doc_id``; of rows that tie the smallest by fingerprint and
    by a hash of all columns), all columns as they were. Texts are read by Python once:
    the rows that stay are found again by id and that hash."""
    own = docs.select(F.struct("*").alias("row"))
    rows = cut_lineage(own.select("row.doc_id", fingerprint("row.text", shingle).alias("fp"), F.xxhash64("row").alias("key")))
    keys = ["no_id", "id", "key"]
    winners = _rooted(rows, max_bits)[1].select("best.no_id", "best.id", "best.key").distinct()
    kept = own.select("row", F.col("row.doc_id").isNull().alias("no_id"), F.coalesce("row.doc_id", F.lit(0)).alias("id"),
                      F.xxhash64("row").alias("key")).join(winners, keys)
    # rows alike in all columns: one of them
    return kept.groupBy(*keys).agg(F.any_value("row").alias("row")).select("row.*")
