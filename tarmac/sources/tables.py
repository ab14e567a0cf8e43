"""Reading, writing and checkpointing tables."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.columns import floating_columns
from tarmac.functions.expr import nan_as_null


def normalise_missing(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN becomes null in every floating column."""
    floats = set(floating_columns(df))
    if not floats:
        return df
    return df.select(
        *[nan_as_null(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    nrows: int | None = None,
    malformed: str = "null",
) -> DataFrame:
    """CSV with a header. Pass ``schema`` at scale: inferring it costs a whole extra scan.

    A declared schema is matched to the file by header name, so the file may hold more columns, or
    hold them in another order. ``malformed`` says what becomes of a cell that is not of its declared type:
    ``null``, ``fail`` (an error when it is read), or ``keep`` (null, with a map ``malformed_cells`` from column
    to the cell's text, empty where all cells are good).
    """
    if malformed not in ("null", "fail", "keep"):
        raise ValueError(f"unknown treatment of malformed cells: {malformed!r}")
    reader = spark.read.option("header", True)
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        text = reader.csv(path)
        known = {f.name: f.dataType for f in schema.fields}
        cells, bad = [], []
        for c in text.columns:
            if c not in known:
                cells.append(F.col(c))
                continue
            value = F.col(c).try_cast(known[c])
            wrong = value.isNull() & F.col(c).isNotNull()
            if malformed == "fail":
                note = F.concat(F.lit(f"malformed cell in column {c}: "), F.col(c))
                value = F.when(wrong, F.raise_error(note).cast(known[c])).otherwise(value)
            cells.append(value.alias(c))
            bad.append(F.when(wrong, F.struct(F.lit(c).alias("key"), F.col(c).alias("value"))))
        if malformed == "keep":
            found = F.filter(F.array(*bad), lambda cell: cell.isNotNull())
            cells.append(F.map_from_entries(found).alias("malformed_cells"))
        df = text.select(*cells)
    if nrows is not None:
        df = df.limit(nrows)
    return normalise_missing(df)


def read_parquet(spark: SparkSession, path: str, nan_is_missing: bool = True) -> DataFrame:
    """Columnar table. Switch ``nan_is_missing`` off for tables known to hold no NaN: filters on
    floating columns then reach the file reader."""
    df = spark.read.parquet(path)
    return normalise_missing(df) if nan_is_missing else df


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deal rows out by key when a scan has fewer tasks than cores, as with a file of one row group.

    A large table is read by many tasks already and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def first_rows(df: DataFrame, n: int, order_cols: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a declared order (a plain limit has none)."""
    return df.orderBy(*order_cols).limit(n)


def write_csv(df: DataFrame, path: str) -> None:
    """Report or table as a folder of CSV parts with headers."""
    df.write.mode("overwrite").option("header", True).csv(path)


_MANIFEST = "saved_at long, version string, rows long, table_schema string, fitted string"


def save_checkpoint(df: DataFrame, path: str, fitted: dict | None = None, keep: int = 2) -> str:
    """Persist a phase's table with the parameters fitted so far, as a new version that counts once it is whole.

    A version is a folder of its own, so what was saved before stays readable. The table is written first, then a manifest
    with its schema, number of rows and the parameters: a single file, which appears when the job that writes it commits.
    A run that dies in between leaves a folder without manifest, which ``load_checkpoint`` does not see.
    The ``keep`` latest whole versions stay; older ones are removed after the new one is whole. Returns its name.
    """
    spark = df.sparkSession
    saved_at = time.time_ns()
    version = f"{saved_at:020d}-{uuid.uuid4().hex[:8]}"
    at = f"{path}/version={version}"
    df.write.parquet(f"{at}/table")
    rows = spark.read.parquet(f"{at}/table").count()
    manifest = spark.createDataFrame([(saved_at, version, rows, df.schema.json(), json.dumps(fitted or {}))], _MANIFEST)
    manifest.coalesce(1).write.json(f"{at}/manifest")
    for old in _versions(spark, path)[keep:]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={old['version']}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return version


def _versions(spark: SparkSession, path: str) -> list:
    """Manifests of the whole versions, the latest first."""
    try:
        found = spark.read.schema(_MANIFEST).json(f"{path}/version=*/manifest").where("version IS NOT NULL")
        return found.orderBy(F.desc("saved_at"), F.desc("version")).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def load_checkpoint(spark: SparkSession, path: str, version: str | None = None) -> tuple[DataFrame, dict]:
    """Table and parameters of the latest whole version, or of a named one. A table with other rows than its manifest
    says is an error."""
    known = [v for v in _versions(spark, path) if version in (None, v["version"])]
    if not known:
        raise ValueError(f"no whole checkpoint at {path}" + (f" named {version}" if version else ""))
    chosen = known[0]
    schema = T.StructType.fromJson(json.loads(chosen["table_schema"]))
    table = spark.read.schema(schema).parquet(f"{path}/version={chosen['version']}/table")
    if table.count() != chosen["rows"]:
        raise ValueError(f"checkpoint {chosen['version']} at {path} does not hold the rows it was saved with")
    return table, json.loads(chosen["fitted"])
