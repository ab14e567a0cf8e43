"""Session defaults and the few helpers that touch cluster storage or the driver."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a parameter table may hold before it is joined by shuffle instead of broadcast.
PARAMETER_ROWS = 200_000


def build_session(app: str = "tarmac", cpus: int | None = None) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the session submitted to you."""
    cpus = cpus or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts: the shared one the cluster names, a private one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tarmac-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Lets Spark delete the shuffle files of a query when the query ends, instead of when the driver collects its garbage.
_SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder, so that later jobs neither recompute it
    nor see it differently, and still read only the columns they need. With ``drop_shuffles`` the shuffle files
    of this computation are deleted when the table is written."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tarmac-{uuid.uuid4().hex}"
    before = spark.conf.get(_SHUFFLES_END, None)
    if drop_shuffles:
        spark.conf.set(_SHUFFLES_END, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles and before is None:
            spark.conf.unset(_SHUFFLES_END)
        elif drop_shuffles:
            spark.conf.set(_SHUFFLES_END, before)
    return spark.read.schema(df.schema).parquet(path)


def parameter_table(df: DataFrame, max_rows: int = PARAMETER_ROWS) -> DataFrame:
    """Fix a fitted table, and mark it for broadcast when it is proven small.

    The driver fetches at most ``max_rows + 1`` rows. A larger table is written to the shared folder
    instead and read back without a hint, so the optimizer joins it by shuffle.
    """
    fetched = df.limit(max_rows + 1).toArrow()
    if fetched.num_rows > max_rows:
        return materialize(df)
    return F.broadcast(df.sparkSession.createDataFrame(fetched, schema=df.schema))


def parameter_row(df: DataFrame) -> dict:
    """The only row of a global aggregate, as a dict."""
    return df.first().asDict()
