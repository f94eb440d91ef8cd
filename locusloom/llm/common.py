"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import require_columns, scratch_path, ship_package

#: A-Z to a-z on bytes; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a null document id while ids are compared; larger than any real one.
NULL_ID = 2**63 - 1


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id long, text binary)``: the two columns an operator reads, so that other columns,
    whatever their names, never meet its own. A null text is an empty one; a null id stays null."""
    require_columns(docs, id_col, text_col)
    ship_package(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read again: the lineage ends there, a lost
    executor costs no recomputation, and each reader picks its columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows(batch: pa.RecordBatch) -> tuple[list, list[bytes]]:
    """Ids and texts of a batch of :func:`id_and_text`."""
    return batch.column(0).to_pylist(), batch.column(1).to_pylist()


def fresh(name: str, df: DataFrame) -> str:
    """``name``, or with underscores behind it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def lower_az(col: Column) -> Column:
    return F.translate(col, UPPER_AZ, LOWER_AZ)
