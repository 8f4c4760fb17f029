"""CSV scans (S1-S3): data dictionary, pre-split train/test, raw loan file.

Schemas are explicit (no inference pass over the data); dirty columns are
read as text and parsed by ``operators.clean``. Records may hold quoted line
breaks and doubled quotes. A line break lies inside quotes exactly if some line of
the file has an odd number of quotes, which one split scan of the lines finds
out; only files with such a line are read by one task each, all others in splits
(``line_breaks`` states it instead). A gzip file cannot be split either way.
Scans that can't be split are spread over partitions right after reading and meant
to be written once as Parquet.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DICTIONARY_SCHEMA = "LoanStatNew string, Description string"
_EDGE_SPACE = r"^[\s ]+|[\s ]+$"


def load_data_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``feature, description``: quoted multi-line records, keys stripped of
    edge whitespace including no-break spaces, records without a name dropped."""
    raw = (spark.read.schema(DICTIONARY_SCHEMA).option("header", True).option("multiLine", True)
           .option("escape", '"').csv(path))
    key = F.regexp_replace(F.col("LoanStatNew"), _EDGE_SPACE, "")
    return (raw.select(key.alias("feature"), F.col("Description").alias("description"))
            .where(F.col("feature").isNotNull() & (F.col("feature") != "")))


def files_with_line_breaks(spark: SparkSession, path: str) -> dict[str, bool]:
    """Every file below ``path``, and whether one of its records has a line break inside quotes."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"),
                                         (F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))).alias("n"))
    # one row per file
    return {unquote(r["file"]): bool(r["odd"]) for r in lines.groupBy("file").agg(F.max(F.col("n") % 2).alias("odd")).collect()}


def _csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str, line_breaks: bool) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("multiLine", line_breaks)
            .option("quote", '"').option("escape", '"').csv(path))


def _records(spark: SparkSession, path: str, schema: T.StructType | str, line_breaks: bool | None) -> DataFrame:
    """CSV records with doubled quotes and quoted line breaks; files without such line breaks are read in splits."""
    if line_breaks is not None:
        return _csv(spark, path, schema, line_breaks)
    found = files_with_line_breaks(spark, path)
    parts = [_csv(spark, files, schema, kind) for kind in (False, True)
             if (files := sorted(f for f, odd in found.items() if odd == kind))]
    if not parts:
        return _csv(spark, path, schema, False)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def load_train_test(spark: SparkSession, train_path: str, test_path: str,
                    schema: T.StructType | str, line_breaks: bool | None = None) -> DataFrame:
    """Both files as one frame with a ``split`` column (train / test)."""
    def one(path: str, split: str) -> DataFrame:
        return _records(spark, path, schema, line_breaks).withColumn("split", F.lit(split))
    return one(train_path, "train").unionByName(one(test_path, "test"), allowMissingColumns=True)


def load_raw_loans(spark: SparkSession, path: str, schema: T.StructType | str,
                   partitions: int | None = None, line_breaks: bool | None = None) -> DataFrame:
    """Raw loan CSV (gzip by extension). What can't be split is spread over ``partitions`` right away."""
    df = _records(spark, path, schema, line_breaks)
    if line_breaks or path.endswith(".gz"):
        df = df.repartition(partitions or spark.sparkContext.defaultParallelism)
    return df


def rename_dictionary(df: DataFrame) -> DataFrame:
    """Raw dictionary columns to ``feature_name, description`` (when present)."""
    return df.withColumnsRenamed({c: n for c, n in (("LoanStatNew", "feature_name"),
                                                    ("Description", "description"),
                                                    ("feature", "feature_name")) if c in df.columns})
