"""Sessions: settings that suit the operators, and this package on Python workers."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: list[str] = []


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or passed with --py-files as well."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in (paths := [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]):
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    # Memory that a worker frees goes back to the system; workers idle beside those of later stages.
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    env.setdefault("MALLOC_ARENA_MAX", "2")
    env.setdefault("MALLOC_TRIM_THRESHOLD_", "1048576")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where that is unset and executors run within the driver (tests) a temporary folder is used;
    on a cluster it must be set."""
    ship(spark)
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _LOCAL_DIR:
        _LOCAL_DIR.append(tempfile.mkdtemp(prefix="corpusflow-"))
    return "file://" + _LOCAL_DIR[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that materialize() made and that nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, df.written_to)


def release_at_exit(*tables: DataFrame) -> None:
    """Delete tables that a returned DataFrame still reads when this program ends."""
    for df in tables:
        drop_at_exit(df.sparkSession, df.written_to)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when this program ends."""
    atexit.register(_drop, spark, path)


def _drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone: then the folder's owner cleans up
        delete(spark, path)


def local(cores: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, as tests and bench use it."""
    return ship(
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
