"""Exact dedup: tree-merge of sorted digest runs (DataFrame operations only).

Every partition of the table is one run: its rows grouped by digest, which
Spark sorts, with the retained id and the number of copies of each digest.
Runs are then merged ``FAN_IN`` at a time, in rounds, until one run is left
(spread over all tasks by digest). In every round a digest of a run is one
row, so a text with any number of copies sends at most one row per run, and a
merge sees at most ``FAN_IN`` of them.

Two texts count as equal when their 64-bit digest, their length and their
SHA-256 agree; all three are grouping keys at every level, so a retained id is
verified by the long digest, never by the short one alone.

Defined results: equal means identical after lower-casing A-Z only; null counts
as empty, so null and empty texts are one group; the largest ``doc_id`` stays
(null ids are smallest); of rows that tie in text and id exactly one stays, the same one on every run; an
empty table gives an empty result; texts of any length are digested whole;
``keep_one`` carries extra columns inside a struct, so no name clashes.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

FAN_IN = 8
KEYS = ["digest", "sha", "n_bytes"]


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. Texts without other than ASCII bytes take the fast function."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def digests(text: str = "text") -> list[Column]:
    """The grouping keys of a text: 64-bit digest, SHA-256, bytes."""
    t = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    return [F.xxhash64(t).alias("digest"), F.unhex(F.sha2(t, 256)).alias("sha"), F.octet_length(t).alias("n_bytes")]


def n_runs(df: DataFrame) -> int:
    """Runs of the first level: the power of ``FAN_IN`` from the number of shuffle partitions up."""
    partitions, n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), FAN_IN
    while n < partitions:
        n *= FAN_IN
    return n


def first_runs(rows: DataFrame) -> DataFrame:
    """One row per digest and run: the retained id, the number of copies."""
    return rows.groupBy(*KEYS, "run").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))


def merge_runs(runs: DataFrame, n: int) -> DataFrame:
    """Merge rounds down to one run: per digest the retained id and the number of copies."""
    while n > 1:
        n //= FAN_IN
        runs = (runs.withColumn("run", F.floor(F.col("run") / FAN_IN)).groupBy(*KEYS, "run")
                .agg(F.max("id").alias("id"), F.sum("n").alias("n")))
    return runs.drop("run")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    The answer goes back down by (digest, run): a run holds the copies of one
    part of the table, so that join has no hot key either.
    """
    runs = n_runs(docs)
    rows = cut_lineage(docs.select(
        F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("id"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).cast("long").alias("run"), *digests()))
    first = first_runs(rows)
    copied = merge_runs(first, runs).where("n > 1").withColumnsRenamed({"id": "keep", "n": "size"})
    answer = first.select(*KEYS, "run").join(copied, KEYS)
    out = rows.join(answer, [*KEYS, "run"], "left")
    keep = F.coalesce("keep", "id")
    return out.select(
        F.col("id.doc_id").alias("doc_id"), keep["doc_id"].alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("group_size"), (keep["row"] == F.col("id.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every group of equal texts (the largest ``doc_id``), all columns as they were."""
    runs = n_runs(docs)
    plain = [F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id")]
    rows = docs.select(F.struct("doc_id").alias("id"),
                       F.pmod(F.spark_partition_id(), F.lit(runs)).cast("long").alias("run"), *digests())
    winners = merge_runs(first_runs(rows), runs).select(*KEYS, "id.doc_id").select(*KEYS, *plain)
    own = docs.select(F.struct("*").alias("row"), *digests(), *plain)
    # rows that tie in text and id: the smallest by a hash of all their columns, on every run the same
    keys = [*KEYS, "id", "no_id"]
    return own.join(winners, keys).groupBy(*keys).agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
