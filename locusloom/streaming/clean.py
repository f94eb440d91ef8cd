"""Clean association results as runs finish.

Cleaning is row-wise, so the batch operators apply unchanged and no state is kept. Rows that cleaning would drop
can be kept aside: each micro-batch then goes into two sinks, exactly once although either may fail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.results import clean_assoc, rejected_assoc, significant_hits


def stream_assoc(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Result files with a header that arrive in ``folder``, in the given layout."""
    return spark.readStream.option("sep", "\t").option("header", True).schema(schema).csv(folder)


def clean_as_they_arrive(
    assoc: DataFrame, path: str, checkpoint: str, threshold: float | None = None
) -> StreamingQuery:
    """Append the cleaned rows (or only those below a fixed threshold) to parquet, exactly once,
    and stop when the files present have been read."""
    rows = clean_assoc(assoc)
    if threshold is not None:
        rows = significant_hits(rows, threshold)
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def clean_with_quarantine(assoc: DataFrame, folder: str, checkpoint: str, p_col: str = "p_lrt", stat_col: str = "l_mle") -> StreamingQuery:
    """Split the arriving rows into ``clean`` and ``rejected`` below ``folder``, and stop when the files present have been read.

    A micro-batch writes each sink's folder of its own number, replacing what an earlier try left there, and
    then its mark. A batch that was lost between the sinks is run again under its number, with the same
    rows, by the query's checkpoint; readers (:func:`finished_batches`) see batches with a mark only.
    """
    folder = folder.rstrip("/")

    def split(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for name, rows in (("clean", clean_assoc(batch, p_col, stat_col)), ("rejected", rejected_assoc(batch))):
                write_batch(rows, f"{folder}/{name}/batch={number}")
            mark = batch.sparkSession.range(1).select(F.current_timestamp().alias("finished_at"))
            write_batch(mark.coalesce(1), f"{folder}/finished/batch={number}")
        finally:
            batch.unpersist()

    return assoc.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_batch(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def finished_batches(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of sink ``name`` (``clean`` or ``rejected``) of all finished micro-batches, each row once."""
    finished = spark.read.parquet(f"{folder.rstrip('/')}/finished").select("batch")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}").join(F.broadcast(finished), "batch", "left_semi").drop("batch")
