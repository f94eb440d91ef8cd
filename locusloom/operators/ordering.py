"""Order-dependent sums over a whole table without a one-task window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Repeats of one value that one task makes at a time.
CHUNK = 100_000


def place_in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range partition on ``order``, sort within partitions and write once; ``_part`` is the
    number of the partition. ``order`` should tell rows apart, so give a table already
    aggregated on those columns: a value that fills a third of the raw data is one row here."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(ordered).withColumn("_part", F.spark_partition_id())


def running_total(placed: DataFrame, value: str, out: str) -> tuple[DataFrame, int]:
    """``(placed with out, grand total)``: ``out`` is the sum of ``value`` (a long) over all rows
    ordered before this one.

    One total per partition goes to the driver, and each task adds its own start to a carry:
    nothing is gathered in one task and no row moves.
    """
    df = placed.drop("_part")
    per_part = placed.groupBy("_part").agg(F.sum(value).alias("total")).collect()
    starts, seen = {}, 0
    for row in sorted(per_part):
        starts[row["_part"]], seen = seen, seen + (row["total"] or 0)
    shared = df.sparkSession.sparkContext.broadcast(starts)
    kept = df.columns

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if at is None:
                at = shared.value[batch.column("_part")[0].as_py()]
            amounts = batch.column(value).to_numpy(zero_copy_only=False)
            ends = at + np.cumsum(amounts)
            columns = [batch.column(c) for c in kept]
            columns.append(pa.array(ends - amounts, pa.int64()))
            at = int(ends[-1])
            yield pa.RecordBatch.from_arrays(columns, [*kept, out])

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])
    return placed.mapInArrow(carry, schema), seen


def expand_counts(df: DataFrame, count: str, index: str) -> DataFrame:
    """Repeat each row ``count`` times with ``index`` = 0, 1, ...

    Counts are cut into chunks, one for most rows, which are spread over the cluster before they are
    repeated: a value that fills a third of the data is not one task's work.
    """
    n, zero = F.col(count), F.lit(0).cast("long")
    chunk = F.lit(CHUNK).cast("long")
    # A stated number of partitions: chunks are tiny until they are expanded, and adaptive
    # execution would otherwise merge them by size into one task.
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = df.filter(n > 0).withColumn("_from", F.explode(F.sequence(zero, n - 1, chunk))).repartition(spread, *df.columns, "_from")
    ordinals = F.sequence(F.col("_from"), F.least(F.col("_from") + chunk, n) - 1)
    return chunks.withColumn(index, F.explode(ordinals)).drop("_from")
