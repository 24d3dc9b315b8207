"""Session defaults, the shared scratch folder, and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows a join side may hold to be sent to every executor. A pair row is about 40 bytes, so the
# bound is some 80 MB of raw data; every broadcast in this package is behind `fits`.
BROADCAST_ROWS = 2_000_000

_run_dirs: set[str] = set()


def build_session(app: str = "stationfield", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Radius joins and interpolation make far more rows than the bytes they read suggest.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`.

    Only a local session, whose driver and executors are one process, may do without that
    setting and gets a folder of its own; a cluster without it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stationfield-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The application's own folder below the shared one: what it writes in between lies there, and
    the file system removes it when the driver ends."""
    context = spark.sparkContext
    path = f"{shared_dir(spark)}/run-{context.applicationId}"
    if path not in _run_dirs:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(context._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _run_dirs.add(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives Catalyst an exact size to plan with.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when `df` has at most `max_rows` rows; one number per task is sent."""
    return df.count() <= max_rows
