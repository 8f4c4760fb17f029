"""Mixing sources to target weights by weighted fair queueing (DataFrame operations only).

Every source is a queue of its shuffled documents, repeated up to
``max_epochs`` times, and is served at its target weight. A copy of a document
gets a virtual finish time: the words of its source up to and with this copy,
divided by the source's weight. Copies are range-sorted by that time, and the
mix is truncated at the virtual time at which all queues together have
delivered the total budget: copies that finish by then are taken whole, and of
each source the one copy then in service is cut at the words delivered.

A source that runs dry leaves its share to the others by weight, so at the
truncation each source has delivered its target: weight share of the budget,
at most ``max_epochs`` times its size, the excess reshared. That virtual time
is the water level of the targets, found from running sums over the sources
ordered by the time at which they run dry (one row per source).

Cumulative words need no source in one task: the shuffle order of a source is
cut into buckets of hash ranges, bucket totals give offsets, and the window
runs inside one bucket.

Defined results: null text has 0 words and is not taken; a null source is one
source, ordered last; repeated rows are separate documents; an empty table or
one without words gives targets of 0; documents that tie in the shuffle order come by id and
size; a very long text is one document. ``mix`` carries extra columns inside a struct, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

WEIGHTS = (5, 2, 1)
BUDGET, MAX_EPOCHS = 1.5, 2
WORDS = r"[^\\x20\\x09-\\x0D]+"


def n_words(text: str = "text") -> Column:
    """Number of words of the text (null: 0)."""
    return F.coalesce(F.expr(f"regexp_count({text}, '{WORDS}')"), F.lit(0)).cast("long")


def buckets(df: DataFrame) -> int:
    """Hash ranges a source is cut into: follows the shuffle parallelism."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def queued(docs: DataFrame) -> DataFrame:
    """Rows with doc_id, source and size, with their queue and place in the shuffle order."""
    source = F.col("source").cast("string")
    return docs.withColumns({
        "queue": F.concat(F.when(source.isNull(), "1").otherwise("0"), F.coalesce(source, F.lit(""))),
        "place": F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))),
    }).withColumn("bucket", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * buckets(docs) / F.lit(1 << 32)))


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """queue, weight, source_size, level (virtual time of the truncation) and target.

    ``totals``: queue, source_size. Sources ordered by the time at which they
    run dry; with the first k of them dry, the rest share what is left of the
    budget by weight; that share is largest for the right k (sources that were
    dry earlier left more than they would get, those that follow less).
    """
    by_name, dry = Window.orderBy("queue"), Window.orderBy("dry", "queue")
    before, rest = dry.rowsBetween(Window.unboundedPreceding, -1), dry.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    x = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    x = x.withColumn("dry", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    x = x.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(budget)))
    x = x.withColumn("shared", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    x = x.withColumn("level", F.max("shared").over(everything))
    return x.select("queue", "weight", "source_size", "level",
                    F.least(F.col("level") * F.col("weight"), F.col("cap")).alias("target"))


def schedule(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET,
             max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, size and whatever else) with weight,
    source_size, target, ``finish`` (virtual finish time of the first copy),
    ``words`` (array: the words taken of each copy) and ``taken`` (their sum)."""
    x = queued(docs)
    sums = cut_lineage(x.groupBy("queue", "bucket").agg(F.sum("size").alias("words")))
    plan = targets(sums.groupBy("queue").agg(F.sum("words").alias("source_size")), weights, budget, max_epochs)
    earlier = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("queue", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    offsets = offsets.join(plan, "queue")
    inside = (Window.partitionBy("queue", "bucket").orderBy("place", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.join(offsets, ["queue", "bucket"]).withColumn("upto", F.sum("size").over(inside) + F.col("offset"))
    served = F.floor(F.col("target") + 1e-6)
    words = [F.greatest(F.lit(0), F.least(F.col("size"), served - (F.col("upto") - F.col("size") + F.col("source_size") * e)))
             for e in range(max_epochs)]
    return (x.withColumn("words", F.array(*words)).withColumn("finish", F.col("upto") / F.col("weight"))
            .withColumn("taken", F.aggregate("words", F.lit(0).cast("long"), lambda a, b: a + b))
            .drop("queue", "place", "bucket", "offset", "upto", "level"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to and with its n-th word, separators as they are."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), n), "")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix: a row per copy taken, the columns of ``docs``, range-sorted by
    virtual finish time. A cut copy holds its first words."""
    x = docs.select(F.struct("*").alias("row"), "doc_id", "source", n_words().alias("size"))
    x = schedule(x, weights, budget, max_epochs).where("taken > 0")
    x = x.select("row", "size", "finish", "weight", "source_size", F.posexplode("words").alias("epoch", "part")).where("part > 0")
    cut = F.when(F.col("part") < F.col("size"), first_words(F.col("row.text"), F.col("part").cast("int"))).otherwise(F.col("row.text"))
    x = x.select((F.col("finish") + F.col("epoch") * F.col("source_size") / F.col("weight")).alias("finish"),
                 F.col("row").withField("text", cut).alias("row"))
    return x.repartitionByRange("finish").sortWithinPartitions("finish").select("row.*")
