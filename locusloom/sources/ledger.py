"""A table of run records that survives retries and several writers.

Every append writes its rows into a folder of its own and then, as a second job, one commit record into
another folder of its own. Readers see the rows of committed appends only, and of several rows with
one key the newest: a lost or repeated append changes nothing, and no two writers share a folder that one
of them could clean up under the other.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMIT = "version long, committed_at timestamp"


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """``version, committed_at, attempt`` of all commits; none where nothing was committed yet."""
    try:
        found = spark.read.schema(f"{_COMMIT}, attempt string").parquet(f"{path}/commits")
        return found.select("version", "committed_at", "attempt")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{_COMMIT}, attempt string")


def write_rows(rows: DataFrame, path: str, attempt: str) -> None:
    """The rows of one append; they are not seen before :func:`commit`."""
    rows.write.mode("overwrite").parquet(f"{path}/rows/attempt={attempt}")


def commit(spark: SparkSession, path: str, attempt: str) -> None:
    """Make an append visible. Its version is above all that are committed; writers that commit at once
    may share one, and then the time and the name decide."""
    version = (_commits(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    record = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.current_timestamp().alias("committed_at"))
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/attempt={attempt}")


def append(rows: DataFrame, path: str) -> str:
    """Add ``rows``; returns the name of the append."""
    attempt = uuid.uuid4().hex
    write_rows(rows, path, attempt)
    commit(rows.sparkSession, path, attempt)
    return attempt


def history(spark: SparkSession, path: str) -> DataFrame:
    """All committed rows with ``version``, ``committed_at`` and ``attempt``."""
    return spark.read.option("mergeSchema", True).parquet(f"{path}/rows").join(_commits(spark, path), "attempt")


def newest(spark: SparkSession, path: str, key: str = "run_id") -> DataFrame:
    """The committed rows, of each ``key`` the newest. One aggregate: it keeps a row for each key of a task."""
    rows = history(spark, path)
    columns = [c for c in rows.columns if c not in ("version", "committed_at", "attempt")]
    last = F.max_by(F.struct(*columns), F.struct("version", "committed_at", "attempt"))
    return rows.groupBy(F.col(key).alias("_key")).agg(last.alias("row")).select("row.*")
