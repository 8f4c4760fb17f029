"""Token ids as ORC files: run-length encoded integers, row indexes, Bloom filters.

``write`` range-partitions the documents by ``doc_id``, sorts each partition and
writes one ORC file per partition in ascending order of ids; the writer encodes
integers in runs, keeps row indexes and statistics per stripe, and a Bloom
filter on ``doc_id``. ``read`` is stripe-parallel, and a filter on ``doc_id``
skips files, stripes and row groups by those.

Every row holds where it starts in its file; the start in the whole table
needs only the tokens of each file, read without touching the ids.

Defined results: null and empty texts are the end id alone; null ids come
first; repeated rows follow one another, equal ids in order of their text; a very long
text is one row; an empty table gives no rows. Only doc_id and text are
read, so extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm import ragged
from riskframe.llm.tokens import Codec, vocabulary_path
from riskframe.session import checkpoint_dir

END = 1
SCHEMA = "doc_id bigint, file_start bigint, n_tokens bigint, ids array<int>"
OPTIONS = {"orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20),
           "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd"}


def encoded(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """doc_id, file_start, n_tokens, ids of every document, partitions in ascending order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, before = Codec(path), 0
        for batch in batches:
            for lo, hi, buf, offsets in ragged.slices(batch.column(1)):
                ids, at = codec.encode(buf, offsets, end)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(before + at[:-1]), pa.array(np.diff(at)), lists],
                    ["doc_id", "file_start", "n_tokens", "ids"])
                before += int(at[-1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ragged.terminated("text").alias("text"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)


def write(docs: DataFrame, folder: str | None = None, path: str | None = None) -> str:
    """Write the ids of all documents as ORC; returns the folder (by default a new
    one in the shared folder of the session)."""
    folder = folder or f"{checkpoint_dir(docs.sparkSession)}/token-ids-{uuid4().hex}"
    encoded(docs, path or vocabulary_path()).write.options(**OPTIONS).orc(folder)
    return folder


def crc32(ids: Column | str) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    def run(lists: pa.Array) -> pa.Array:
        at = lists.offsets.to_numpy()
        return pa.array(ragged.crc32s(lists.values.to_numpy(zero_copy_only=False).astype("<u4"), at))
    return F.arrow_udf(run, "bigint")(ids)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids."""
    rows = spark.read.schema(SCHEMA).orc(folder).select("*", F.col("_metadata.file_path").alias("file"))
    files = rows.groupBy("file").agg(F.min("doc_id").alias("lowest"), F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("lowest", "file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(files), "file").select(      # one row per file: the ids are not exchanged
        "doc_id", (F.col("before") + F.col("file_start")).alias("start"), "n_tokens", "ids")
