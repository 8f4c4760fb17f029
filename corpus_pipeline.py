"""From raw documents to packed sequences: five stages, each one operator of ``riskframe.llm``.

Every stage takes rows with null ids, sources and texts, empty and very long
texts, ties, repeated rows, empty tables and extra columns of any name; what it
makes of them is said below and in its operator.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import exact, mixing, packing, quality, simhash
from riskframe.session import checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees (fitted on the labelled ones).

    Null and empty texts have no words and go; repeated rows are judged one by one, so
    are rows without an id, which only can't be labelled; without labels of both kinds
    the trees accept all."""
    return quality.keep_good(docs, quality.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id.

    A null text equals an empty one; a null id is smaller than any other; of rows that tie in
    text and id one stays, the same on every run."""
    return exact.keep_one(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id.

    Texts without words are one group; a null id comes after all others; ties as in ``exact_dedup``."""
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by the sources' target weights, in the order of the mix.

    A null source is a source of its own, the last one; texts without words are not drawn; a document
    may come twice, and the one in service at the end is cut to the words that are left."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens.

    A null or empty text is its end id alone; repeated rows are packed each; long ones are cut into pieces."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("pack_sequences", pack_sequences),
]

#: trees, fingerprints and token ids are beyond SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again;
    a stage's table is removed once the next one is written."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    docs, done = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        out, path = stage(spark, docs, sf_dir), f"{folder}/{i}-{name}"
        out.write.parquet(path)
        if done:
            _remove(spark, done)
        docs, done = spark.read.schema(out.schema).parquet(path), path
    return docs


def _remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of this run from the shared store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
