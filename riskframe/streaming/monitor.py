"""Continuous monitoring: the batch monitoring operators per micro-batch.

The reference monitors a model by re-running its performance check (D4) and
drift check (D3) on newly scored data. Here a stream of scored rows feeds
``foreachBatch``; each micro-batch gets the same operators and the results
are written partitioned by batch id with dynamic partition overwrite, so a
batch replayed after a failure replaces its rows instead of duplicating them.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskframe.operators.drift import drift_metrics, performance_monitor


def monitor_stream(scored_stream: DataFrame, reference: DataFrame, reference_metrics: DataFrame,
                   features: Sequence[str], out_dir: str, checkpoint: str,
                   label: str = "label", score: str = "score", trigger: dict | None = None) -> StreamingQuery:
    """Start a query writing ``monitor`` and ``drift`` tables under ``out_dir``."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        mon = performance_monitor(batch, reference_metrics, label, score).withColumns({
            "batch_id": F.lit(batch_id), "recommendations": F.concat_ws(" | ", "recommendations")})
        mon.write.mode("overwrite").partitionBy("batch_id").parquet(os.path.join(out_dir, "monitor"))
        drift_metrics(reference, batch, features).withColumn("batch_id", F.lit(batch_id)) \
            .write.mode("overwrite").partitionBy("batch_id").parquet(os.path.join(out_dir, "drift"))

    w = scored_stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
