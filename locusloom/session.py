"""Session settings, the shared folder and lineage cuts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", app: str = "locusloom", **conf: str) -> SparkSession:
    """A session for tests and benches on this machine, with a folder of its own for what it stores;
    a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="locusloom-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Where that is unset the warehouse takes its place: it is shared by the same definition, on a
    cluster and on one machine alike.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/locusloom-scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/locusloom-{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage once; later jobs re-read it instead of recomputing it.

    The partitions of the returned frame are fixed, so ``spark_partition_id()`` on it
    gives the same answer after any task or executor is retried.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def try_cast(col: Column | str, kind: str) -> Column:
    """Cast that yields null for unparsable text in every ANSI mode."""
    return (F.col(col) if isinstance(col, str) else col).try_cast(kind)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application. The kernels import it
    there, and a cluster's machines need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="locusloom-ship-"), "locusloom")
        archive = shutil.make_archive(target, "zip", os.path.dirname(here), os.path.basename(here))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; have {df.columns}")
