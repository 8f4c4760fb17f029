"""Merkle manifest of a dataset: leaves, subroots, root and a proof per row, by pointer jumping.

Every row is a leaf, every source a tree, and the subroots of the sources are
the leaves of one more tree, whose root names the dataset. A node is the
SHA-256 of the hex digests of ``ARITY`` consecutive nodes (the last run may have
fewer, even one), until one node is left.

Trees are built ``LEVELS`` levels a round: one grouping by position brings the at
most ``ARITY ** LEVELS`` nodes of a subtree together, whose digests are computed inside the
row. That round also gives each of these nodes its first pointer: the subtree's
top, and the segment of siblings on the way there. Then pointers jump: a
self-join on (pointer = node) replaces a pointer by its own node's pointer and
concatenates the segments, so the distance doubles until every leaf reaches the
root. Few nodes have many descendants, so that join is salted by position.

Positions come from a range sort by (source, id, leaf), equal leaves counted first, and
from counts per range; no task holds a source.

Defined results: a null field is ``-``, so null and empty texts differ; a null
id sorts first and is not tampered with; a null source is a source of its own,
the first one. Rows alike in all five columns are leaves of their own, next to
each other. Texts of any length are hashed whole. One row: its leaf is subroot
and root, its proof the hash of nothing. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

ARITY = 3
#: levels of a tree computed inside one grouped row
LEVELS = 3
SPAN = ARITY ** LEVELS
#: equal leaves that one row of the sort expands to at a time, descendants per salted join key
EXPAND, PER_KEY = 1024, 729
#: the tree over the sources
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<l:string,r:string>>"


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """Hash of a row's fields, each with its length in bytes."""
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


def n_levels(n: Column) -> Column:
    """Levels above ``n`` leaves until one node is left."""
    out = F.lit(0)
    for i in range(39):
        out = out + F.when(n > F.lit(ARITY ** i), 1).otherwise(0)
    return out


def _above(nodes: Column) -> Column:
    """Digests one level up."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(ARITY))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(nodes, i, ARITY), ""), 256))


def _siblings(nodes: Column, i: Column) -> Column:
    """The digests left and right of node ``i`` in its run."""
    first = (i - F.pmod(i, F.lit(ARITY))).cast("int")
    return F.struct(F.array_join(F.slice(nodes, first + 1, (i - first).cast("int")), "").alias("l"),
                    F.array_join(F.slice(nodes, (i + 2).cast("int"), (first + ARITY - 1 - i).cast("int")), "").alias("r"))


def placed(rows: DataFrame, group: Sequence[str], order: Sequence[str], out: str, extra: DataFrame | None = None) -> DataFrame:
    """``out``: place of each row of weight ``n`` from 0 among its ``group`` (all rows if none), by ``order``.

    Sorted in ranges, offsets from the counts per range; the ranges are kept in a
    table, so a rerun task finds the same ones. ``extra`` (columns ``of``, the group, and
    more) is joined to those counts, a few rows per group, not to the rows."""
    x = cut_lineage(rows.repartitionByRange(*group, *order).withColumn("range", F.spark_partition_id()))
    totals = x.groupBy(*group, "range").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"g_{c}") for c in group], F.col("range").alias("g_range"),
                            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    same = F.col("range") == F.col("g_range")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"g_{c}"))
    if extra is not None:
        offsets = offsets.join(extra, F.col(f"g_{group[0]}").eqNullSafe(F.col("of"))).drop("of")
    inside = Window.partitionBy(*group, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, same)
    return x.withColumn(out, F.col("offset") + F.col("inside")).drop(
        "range", "inside", "offset", "g_range", *[f"g_{c}" for c in group])


def build(leaves: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """All trees over ``tree, levels, pos, digest, weight, row`` (``levels`` of a tree, at most
    ``most``; ``weight``: documents below; ``row``: carried along).

    Returns the tops ``tree, digest, weight`` and the pointers: ``tree, level, pos, digest, weight, row``
    of every node that a subtree starts from and ``to_tree, to_level, to_pos, to_digest, to_weight, segment``."""
    nodes, pointers, tops = leaves.select("tree", "levels", "pos", "digest", "weight", "row"), [], []
    kind = nodes.schema["row"].dataType
    for base in range(0, max(most, 1), LEVELS):
        runs = nodes.groupBy("tree", "levels", F.floor(F.col("pos") / SPAN).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", "weight", "row"))).alias("d"),     # at most SPAN elements
            F.sum("weight").alias("to_weight"))
        runs = runs.withColumns({"rise": F.least(F.lit(LEVELS), F.col("levels") - base), "d0": F.col("d.digest")})
        for k in range(1, LEVELS + 1):
            runs = runs.withColumn(f"d{k}", F.when(F.col("rise") >= k, _above(F.col(f"d{k - 1}"))).otherwise(F.col(f"d{k - 1}")))
        runs = cut_lineage(runs.withColumns({"to_digest": F.element_at(f"d{LEVELS}", 1), "ends": F.col("levels") <= base + LEVELS})
                           .drop("d0", f"d{LEVELS}"))
        x = runs.select("*", F.col("d.digest").alias("d0"), F.posexplode("d").alias("i", "node"))
        steps, at = [], F.col("i")
        for k in range(LEVELS):
            steps.append(F.when(F.col("rise") > k, _siblings(F.col(f"d{k}"), at)))
            at = F.floor(at / ARITY)
        pointers.append(x.select(
            "tree", F.lit(base).alias("level"), "node.*",
            # the top of a source's tree is the leaf of that number in the tree over the sources
            F.when(F.col("ends"), TOP).otherwise(F.col("tree")).cast("long").alias("to_tree"),
            F.when(F.col("ends"), 0).otherwise(base + LEVELS).alias("to_level"),
            F.when(F.col("ends"), F.col("tree")).otherwise(F.col("block")).alias("to_pos"), "to_digest", "to_weight",
            F.filter(F.array(*steps), lambda s: s.isNotNull()).cast(SEGMENT).alias("segment")))
        tops.append(runs.where("ends").select("tree", F.col("to_digest").alias("digest"), F.col("to_weight").alias("weight")))
        nodes = runs.where(~F.col("ends")).select("tree", "levels", F.col("block").alias("pos"), F.col("to_digest").alias("digest"),
                                                  F.col("to_weight").alias("weight"), F.lit(None).cast(kind).alias("row"))
    for x in pointers[1:]:
        pointers[0] = pointers[0].unionByName(x)
    for x in tops[1:]:
        tops[0] = tops[0].unionByName(x)
    return tops[0], pointers[0]


def jumped(rows: DataFrame, inner: DataFrame) -> DataFrame:
    """Each pointer of ``rows`` replaced by that of the node it points to, segments joined;
    rows that already point to the root stay. A node with many documents below is
    there once per salt, so that no join key has more than about ``PER_KEY`` of them."""
    salts = lambda w: F.ceil(F.col(w) / PER_KEY).cast("int")
    there = inner.select(*[F.col(c).alias(f"n_{c}") for c in (
        "tree", "level", "pos", "weight", "subroot", "to_tree", "to_level", "to_pos", "to_digest", "to_weight", "segment")]).withColumn(
        "n_salt", F.explode(F.sequence(F.lit(0), salts("n_weight") - 1)))
    spread = F.xxhash64("tree", "pos")
    # a pointer that has arrived matches nothing; its salt only keeps such rows apart
    x = rows.withColumn("salt", F.when(F.col("to_level").isNull(), spread).otherwise(F.pmod(spread, salts("to_weight"))))
    on = [F.col("to_tree") == F.col("n_tree"), F.col("to_level") == F.col("n_level"), F.col("to_pos") == F.col("n_pos"),
          F.col("salt") == F.col("n_salt")]
    # a pointer to a leaf of the upper tree has that source's subroot as its digest
    subroot = F.when((F.col("to_tree") == TOP) & (F.col("to_level") == 0), F.col("to_digest"))
    return x.join(there, on, "left").select(
        "tree", "level", "pos", "digest", "weight", "row", F.coalesce("subroot", subroot, "n_subroot").alias("subroot"),
        *[F.col(f"n_{c}").alias(c) for c in ("to_tree", "to_level", "to_pos")],
        *[F.coalesce(f"n_{c}", c).alias(c) for c in ("to_digest", "to_weight")],
        F.concat("segment", F.coalesce("n_segment", F.array().cast(SEGMENT))).alias("segment"))


def proofs(docs: DataFrame, tampered_text: Column, tampered: Column, fields: Sequence[str] = FIELDS) -> DataFrame:
    """One row per row of ``docs``: the id, ``leaf, subroot, root, proof`` (digests left and
    right of the path, level by level), ``folded_root, verified``.

    ``fields`` are id, source, and the other hashed columns, the text last. Where ``tampered``
    holds, the proof is folded with the leaf that has ``tampered_text`` in place of the text."""
    key, source = fields[0], fields[1]
    plain = [F.col(c) for c in fields]
    other = F.when(F.coalesce(tampered, F.lit(False)), leaf([*plain[:-1], tampered_text]))
    rows = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), leaf(plain).alias("leaf"), other.alias("other"))
    # equal leaves are one row until they are placed: they differ in nothing
    rows = cut_lineage(rows.groupBy("source", "id", "leaf").agg(F.max("other").alias("other"), F.count(F.lit(1)).alias("n")))
    sources = placed(rows.groupBy("source").agg(F.sum("n").alias("leaves")).withColumn("n", F.lit(1)), [], ["source"], "tree")
    sources = cut_lineage(sources.select(F.col("source").alias("of"), "tree", n_levels(F.col("leaves")).alias("levels")))
    n_sources, most = sources.agg(F.count(F.lit(1)), F.coalesce(F.max("levels"), F.lit(0))).first()
    upper = sum(n_sources > ARITY ** i for i in range(39))
    # a leaf with very many copies is expanded in two steps
    ranked = placed(rows, ["source"], ["id", "leaf"], "first", sources)
    some = ranked.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / EXPAND))))
    end = F.least(F.col("n"), (F.col("chunk") + 1) * EXPAND) - 1
    leaves = some.withColumn("nth", F.explode(F.sequence(F.col("chunk") * EXPAND, end))).select(
        "tree", "levels", (F.col("first") + F.col("nth")).alias("pos"), F.col("leaf").alias("digest"),
        F.lit(1).cast("long").alias("weight"), F.struct("id", "other").alias("row"))
    tops, low = build(leaves, most)
    _, high = build(tops.select(F.lit(TOP).cast("long").alias("tree"), F.lit(upper).alias("levels"), F.col("tree").alias("pos"),
                                "digest", "weight", F.lit(None).cast(leaves.schema["row"].dataType).alias("row")), upper)
    # pointers to the root end there
    ends = F.col("to_pos") == TOP
    high = high.withColumns({c: F.when(~ends, F.col(c)) for c in ("to_tree", "to_level", "to_pos")})
    none = F.lit(None).cast("string").alias("subroot")
    inner = cut_lineage(low.where("level > 0").unionByName(high).withColumn("subroot", none))
    paths = low.where("level = 0").withColumn("subroot", none)
    hops, reach = max(1, -(-most // LEVELS)) + max(1, -(-upper // LEVELS)), 1
    while reach < hops:
        # what a pointer over that many hops can point to
        targets = inner.where((F.col("level") >= LEVELS * reach) | (F.col("tree") == TOP))
        paths = jumped(paths, targets)
        reach *= 2
        if reach < hops:
            inner = cut_lineage(jumped(inner, targets))
    folded = F.aggregate("segment", F.coalesce("row.other", "digest"), lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))
    return paths.select(
        F.col("row.id").alias(key), F.col("digest").alias("leaf"), "subroot", F.col("to_digest").alias("root"),
        F.col("segment").alias("proof"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def proof_text(proof: Column) -> Column:
    """The siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["l"], s["r"])), "")
