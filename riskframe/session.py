"""Session construction and the lineage-cut helper."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "riskframe",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    AQE re-plans joins from runtime sizes (broadcast only when the measured
    side is small) and splits skewed shuffle partitions; the UI stays off.
    """
    builder = (SparkSession.builder.appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - Spark Connect: no client-side context
        pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session names none and runs locally (tests) is a scratch
    folder set; a cluster must name a folder that all executors share.
    Under Spark Connect (no SparkContext on the client) the server's
    ``spark.checkpoint.dir`` applies and nothing is set here.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no client-side context
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="riskframe-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


#: rows of a file of a written frame
FILE_ROWS = 1 << 17


def written(df: DataFrame) -> DataFrame:
    """The frame as Parquet files of at most ``FILE_ROWS`` rows in the shared folder: for frames
    that are scanned many times for a few columns each, by more tasks than wrote them."""
    path = f"{checkpoint_dir(df.sparkSession)}/written-{uuid4().hex}"
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
