"""Session defaults and the shared scratch folder.

Some operators must fix an intermediate result before using it twice (a range
partitioning must not be re-sampled between two reads). They write it as a
Parquet table below the folder the cluster names in ``spark.checkpoint.dir``:
every executor can reach it, and a lost executor costs a re-read, not a
recomputation.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_DIRS: dict[str, str] = {}  # per application, local mode only


def local_session(cores: int | str = 8, **extra: str) -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
    )
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did.

    For local use; where that folder does not exist, workers need it installed
    or passed with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        joined = os.pathsep.join(filter(None, [paths, root]))
        spark.sparkContext.environment["PYTHONPATH"] = joined
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(
            f"{_CHECKPOINT_DIR} is unset: name a folder all executors can reach"
        )
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="tabloom-")
    return _LOCAL_DIRS[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/tabloom/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it (an action)."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table at ``path``, or None when nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
