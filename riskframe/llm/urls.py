"""URL filters: longest-prefix rules, then an exact block list in a Bloom filter cascade.

The cascade answers, for every key of a known universe, whether it is on a
list. Level 0 is a Bloom filter of the listed keys, level 1 one of the other
keys that pass level 0 by mistake, level 2 one of the listed keys that pass
level 1, and so on until a level has no false positive. A key is then listed
exactly when the first level that it fails has an odd number (or it fails
none and the last number is even). The universe is every domain of the corpus: each
host and all its parent domains, so the answer is exact for every page.

Levels are built in Spark: tasks set bits of 4096-byte blocks, which are
combined by ``bitmap_or_agg``. Only the finished filter (about 12 bits a listed
key) reaches the driver and the tasks, and only while it is below
``max_bytes``; a longer list is matched by an equi-join on the domain. A key is
known by 128 bits of hash. Should a listed key and another share them, the cascade
would not end; after ``MAX_LEVELS`` levels the join takes over as well.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and is allowed. Only A-Z is lower-cased. Whatever stands before the first
``/``, ``?`` or ``#`` is the host, port and user included. Domains have at most 253
characters (the limit of DNS): a longer one is never listed, its shorter
parents may be. Repeated rows are judged one by one; an empty table or list gives an empty
result or allows every page. Extra columns are kept, those named like the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.exact import lower_ascii
from riskframe.session import cut_lineage

MAX_DOMAIN = 253
MAX_LEVELS = 64
#: above this many bytes the filter is not sent to the tasks
MAX_BYTES = 64 << 20
#: share of false positives of the levels after the first
LATER = 1 / 8
#: bits of a block, as ``bitmap_or_agg`` takes them
BLOCK = 1 << 15


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def url_parts(url: Column | str) -> tuple[Column, Column]:
    """Host and path of a url (both empty without ``://``)."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    pattern = r"(?s)://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits host and path, as a struct ``verdict, rule`` (null: none);
    of equally long ones the first."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for r in sorted(reversed(rules), key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.host + r.path).alias("rule"))).otherwise(out)
    return out


def domains(host: Column) -> Column:
    """The host and all its parent domains of at most ``MAX_DOMAIN`` characters."""
    labels = F.split(F.substring(host, -(MAX_DOMAIN + 1), MAX_DOMAIN + 1), r"\.")
    # of a longer host the first piece is a cut label (or the empty one before a dot)
    first = F.when(F.char_length(host) > MAX_DOMAIN, 1).otherwise(0)
    starts = F.filter(F.sequence(F.lit(0), F.size(labels) - 1), lambda i: i >= first)
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def key(domain: Column) -> list[Column]:
    """The 128 bits by which the cascade knows a domain."""
    return [F.xxhash64(domain).alias("a"), F.xxhash64(F.lit("second"), domain).alias("b")]


class Level(NamedTuple):
    n_bits: int
    n_hashes: int
    bits: np.ndarray


def _mixed(x: np.ndarray, level: int) -> np.ndarray:
    """Independent hashes of a level."""
    x = x.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def places(a: np.ndarray, b: np.ndarray, level: int, n_bits: int, n_hashes: int) -> np.ndarray:
    """Bits of every key, keys x hashes."""
    first, step = _mixed(a, level), _mixed(b, level) | np.uint64(1)
    return ((first[:, None] + np.arange(n_hashes, dtype=np.uint64) * step[:, None]) % np.uint64(n_bits)).astype(np.int64)


def passed(levels: Sequence[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Levels that each key passes before it first fails one."""
    depth, alive = np.zeros(len(a), np.int64), np.arange(len(a))
    for i, level in enumerate(levels):
        at = places(a[alive], b[alive], i, level.n_bits, level.n_hashes)
        alive = alive[((level.bits[at >> 3] >> (at & 7)) & 1).all(axis=1)]
        depth[alive] = i + 1
    return depth


def _sized(n: int, share: float) -> tuple[int, int]:
    """Bits and hash functions of a Bloom filter for ``n`` keys."""
    n_hashes = max(1, round(-math.log2(share)))
    return max(64, math.ceil(n * n_hashes / math.log(2))), n_hashes


class Cascade(NamedTuple):
    levels: list[Level]

    def n_bytes(self) -> int:
        return sum(len(x.bits) for x in self.levels)

    def listed(self, keys: Column) -> Column:
        """Whether any key of an array of structs ``a, b`` is listed."""
        levels = self.levels

        def run(arrays: pa.Array) -> pa.Array:
            arrays = arrays.combine_chunks() if isinstance(arrays, pa.ChunkedArray) else arrays
            flat = arrays.flatten()
            a, b = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            hit = np.concatenate(([0], np.cumsum(passed(levels, a, b) % 2)))
            ends = arrays.offsets.to_numpy() - (arrays.offsets[0].as_py() if len(arrays) else 0)
            return pa.array(hit[ends[1:]] > hit[ends[:-1]], pa.bool_())
        return F.arrow_udf(run, "boolean")(keys)


def build(universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade | None:
    """The cascade over ``universe`` (``a, b, listed``: one row per key), or None if its
    filters would not fit ``max_bytes`` or two keys can't be told apart."""
    n_listed, n_rest = universe.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    if not n_listed:
        return Cascade([])
    # so many false positives that the next levels cost as little as the first
    share = min(0.5, n_listed / (math.sqrt(2) * max(n_rest, 1)))
    levels, keys = [], universe
    n_bits, n_hashes = _sized(n_listed, share)
    expected = [n_listed, math.ceil(n_rest * 0.5 ** n_hashes)]
    for i in range(MAX_LEVELS):
        if i:       # with room to spare: a filter with more keys than planned would let ever more of them through
            n_bits, n_hashes = _sized(3 * expected[i] // 2 + 64, LATER)
        if Cascade(levels).n_bytes() + n_bits // 8 > max_bytes:
            return None
        n_blocks = -(-n_bits // BLOCK)
        found = keys.where(F.col("listed") == (i % 2 == 0)).select("a", "b").mapInArrow(
            _bits(levels, i, n_bits, n_hashes), "block bigint, bits binary, n bigint")
        # at most one row of 4096 bytes per block of the filter
        blocks = found.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n")).collect()
        n = sum(r["n"] for r in blocks if r["block"] < 0)
        if not n:
            return Cascade(levels)
        bits = np.zeros(n_blocks * BLOCK // 8, np.uint8)
        for r in blocks:
            if r["block"] >= 0:
                bits[r["block"] * BLOCK // 8:][:BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
        levels.append(Level(n_bits, n_hashes, bits))
        expected[i] = n
        expected.append(max(1, math.ceil(n * LATER)))
        if i == 0 and n_rest:
            # later levels need only the listed keys and those that pass the first filter
            first = levels[:1]
            alive = F.arrow_udf(lambda a, b: pa.array(passed(first, *(np.asarray(x) for x in (a, b))) > 0, pa.bool_()), "boolean")
            keys = cut_lineage(universe.where(F.col("listed") | alive("a", "b")))
    return None


def _bits(levels: list[Level], level: int, n_bits: int, n_hashes: int):
    """Blocks of the bits of the keys that pass all ``levels``, and (block -1) their number."""
    levels = list(levels)

    def run(batches):
        for batch in batches:
            a, b = (np.asarray(batch.column(i)) for i in (0, 1))
            alive = passed(levels, a, b) == len(levels)
            at = np.unique(places(a[alive], b[alive], level, n_bits, n_hashes))
            block, start = np.unique(at // BLOCK, return_index=True)
            rows = []
            for spots in np.split(at % BLOCK, start[1:]) if len(at) else []:
                bits = np.zeros(BLOCK, np.uint8)
                bits[spots] = 1
                rows.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array([*block.tolist(), -1], pa.int64()), pa.array([*rows, bytes(BLOCK // 8)], pa.binary()),
                pa.array([*[0] * len(rows), int(alive.sum())], pa.int64())], names=["block", "bits", "n"])
    return run


def judged(pages: DataFrame, rules: Sequence[Rule], blocked: DataFrame, url_col: str = "url",
           max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``: the verdict of the longest rule
    that fits, else ``block`` if the host or a parent domain is in ``blocked`` (column ``domain``), else ``allow``."""
    host, path = url_parts(url_col)
    # the page's own columns stay inside a struct, so that no name clashes
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    x = pages.select(F.struct(*kept).alias("page"), host.alias("host"), path.alias("path"))
    x = x.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    names = corpus_domains(x)
    listed = blocked.select(lower_ascii(F.col("domain")).alias("domain")).where(
        F.col("domain").isNotNull() & (F.char_length("domain") <= MAX_DOMAIN)).distinct().withColumn("listed", F.lit(True))
    known = cut_lineage(names.join(listed, "domain", "left").select(
        "domain", *key(F.col("domain")), F.coalesce("listed", F.lit(False)).alias("listed")))
    cascade = build(known.select("a", "b", "listed"), max_bytes)
    if cascade is None:
        hit = _joined(x, known.where("listed").select("domain"))
    elif not cascade.levels:
        hit = x.withColumn("hit", F.lit(False))
    else:
        hit = x.withColumn("hit", cascade.listed(F.transform(domains(F.col("host")), lambda d: F.struct(*key(d)))))
    own = F.when(F.col("hit"), "block").otherwise("allow")
    return hit.select("page.*", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"))


def corpus_domains(hosts: DataFrame) -> DataFrame:
    """Every domain of the corpus once; hosts first, so a common one is expanded once."""
    return hosts.select("host").distinct().select(F.explode(domains(F.col("host"))).alias("domain")).distinct()


def _joined(x: DataFrame, listed: DataFrame) -> DataFrame:
    """The way beyond the size bound: hosts with a listed domain, by joins on distinct names."""
    hosts = x.select("host").distinct().select("host", F.explode(domains(F.col("host"))).alias("domain"))
    bad = hosts.join(listed, "domain").select("host").distinct().withColumn("hit", F.lit(True))
    return x.join(bad, "host", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def domains_with_words(names: DataFrame, words: Sequence[str]) -> DataFrame:
    """A block list from the corpus itself: every domain whose first label holds one
    of ``words`` between dots or hyphens."""
    label = F.split(F.split("domain", r"\.")[0], "-")
    return names.where(F.arrays_overlap(label, F.array(*[F.lit(w) for w in words])))
