"""Stored variants and reuse of materialised intermediates."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_variants(sites: DataFrame, path: str, partitions: int | None = None) -> None:
    """Position-sorted parquet with one folder per chromosome.

    Range partitioning on chromosome and position splits a chromosome that holds most of the
    data over many tasks, and each file covers one stretch of it, so both the folder and the
    file statistics prune a region query. The alleles break ties between records at one position.
    """
    order = [c for c in ("chrom", "pos", "ref", "id") if c in sites.columns]
    ranged = sites.repartitionByRange(partitions, *order) if partitions else sites.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.partitionBy("chrom").parquet(path)


def read_variants(
    spark: SparkSession, path: str, chromosomes: Sequence[str] | None = None, region: tuple[int, int] | None = None
) -> DataFrame:
    """Stored variants, optionally of some chromosomes and of a position range (both inclusive)."""
    text = T.StructField("chrom", T.StringType())  # a folder named 1 must stay text
    found = spark.read.parquet(path).schema
    df = spark.read.schema(T.StructType([text if f.name == "chrom" else f for f in found])).parquet(path)
    if chromosomes is not None:
        df = df.filter(F.col("chrom").isin(*chromosomes))
    if region is not None:
        df = df.filter(F.col("pos").between(*region))
    return df


def fingerprint(spark: SparkSession, inputs: Sequence[str], parameters: Mapping[str, object] | None = None) -> str:
    """Key of a result: names, sizes and modification times of all input files, and the parameters.

    The file listing is summed up in an order-free aggregate; contents are not read.
    """
    parts = [json.dumps(dict(parameters or {}), sort_keys=True, default=str)]
    for path in inputs:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(path)
            .select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)").alias("h"))
        )
        parts.append(f"{path}:{files.agg(F.count('*'), F.sum('h')).first()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24]


def _finished(spark: SparkSession, path: str) -> bool:
    """True when a previous job wrote the table and then its mark; a lost job leaves no mark."""
    try:
        return spark.read.parquet(f"{path}/mark").count() == 1
    except AnalysisException:
        return False


def reuse_or_compute(
    spark: SparkSession, folder: str, builder: Callable[[], DataFrame], key: str
) -> DataFrame:
    """The table stored under ``key``, computed and written first when it is absent.

    The key is a fingerprint of inputs and parameters, never a file name, so changed inputs
    are computed anew; a folder left by a lost job is overwritten.
    """
    path = f"{folder.rstrip('/')}/{key}"
    if not _finished(spark, path):
        builder().write.mode("overwrite").parquet(f"{path}/data")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/mark")
    return spark.read.parquet(f"{path}/data")


# ------------------------------------------------------------------ reuse by part


@dataclass
class Parts:
    """A table kept in parts, one for each input: all parts together, and the inputs that had to be computed."""

    table: DataFrame
    computed: list[str]


def reuse_parts(
    spark: SparkSession,
    folder: str,
    inputs: Sequence[str],
    builder: Callable[[str], DataFrame],
    parameters: Mapping[str, object] | None = None,
) -> Parts:
    """The tables of all ``inputs`` (files, or folders such as those of single chromosomes) in one, each kept below
    ``folder`` under the fingerprint of its own input and of ``parameters``.

    Only inputs that are new or were changed are computed. A manifest of this set of inputs is written last,
    so what was kept for inputs that are gone does not come back. Row-wise results are simply
    the rows of all parts; sums that add up over parts (``kinship_sums``) are stored as such and added after.
    """
    keys = {path: fingerprint(spark, [path], parameters) for path in inputs}
    if len(keys) < len(inputs):
        raise ValueError("an input is listed twice")
    folder, computed = folder.rstrip("/"), []
    for path, key in keys.items():
        if not _finished(spark, f"{folder}/{key}"):
            computed.append(path)
        reuse_or_compute(spark, folder, lambda p=path: builder(p), key)
    whole = hashlib.sha256("\n".join(sorted(keys.values())).encode()).hexdigest()[:24]
    manifest = f"{folder}/manifest-{whole}"
    if not _finished(spark, manifest):
        listed = spark.createDataFrame(list(keys.items()), "input string, key string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{manifest}/data")
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{manifest}/mark")
    return Parts(spark.read.option("mergeSchema", True).parquet(*(f"{folder}/{k}/data" for k in sorted(set(keys.values())))), computed)


# ------------------------------------------------------------------ sets of regions

#: Positions in a bin of the interval index, as a power of two.
BIN_BITS = 17
#: Stretches of the store that a set of regions is pruned to before the join.
STRETCHES = 64


def binned_regions(regions: DataFrame) -> DataFrame:
    """``regions`` (chrom, start, end; both ends inclusive) with a row for each ``bin`` of positions that one
    touches; regions without a position have none."""
    real = regions.filter((F.col("start") <= F.col("end")) & (F.col("end") >= 0))
    first, last = F.shiftright(F.greatest("start", F.lit(0)).cast("long"), BIN_BITS), F.shiftright(F.col("end").cast("long"), BIN_BITS)
    return real.withColumn("bin", F.explode(F.sequence(first, last)))


def _stretches(closed: DataFrame) -> Column:
    """A condition that holds wherever a region does, from at most ``STRETCHES`` stretches a chromosome. Regions are put
    into as many equal parts of the positions by their start, and each part keeps its least and largest position."""
    reach = closed.groupBy("chrom").agg(F.max("start").alias("reach"))
    part = F.floor(F.greatest("start", F.lit(0)) * STRETCHES / (F.greatest("reach", F.lit(0)) + 1)).alias("part")
    found = closed.join(reach, "chrom").groupBy("chrom", part).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    near = F.lit(False)
    for r in found.orderBy("chrom", "start").collect():
        near = near | ((F.col("chrom") == r["chrom"]) & F.col("pos").between(r["start"], r["end"]))
    return near


def _opened(regions: DataFrame) -> Column | None:
    """The condition of the regions with an open side: for each chromosome one least start and one largest end."""
    least = F.min(F.when(F.col("end").isNull(), F.coalesce("start", F.lit(0))))
    loose = regions.filter(F.col("start").isNull() | F.col("end").isNull()).groupBy("chrom")
    found = None
    for r in loose.agg(least.alias("least"), F.max(F.when(F.col("start").isNull(), F.col("end"))).alias("most")).orderBy("chrom").collect():
        sides = [F.col("pos") >= r["least"]] * (r["least"] is not None) + [F.col("pos") <= r["most"]] * (r["most"] is not None)
        here = (F.col("chrom") == r["chrom"]) & (sides[0] | sides[-1])
        found = here if found is None else found | here
    return found


def read_regions(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """Stored variants that lie in any of ``regions`` (chrom, start, end; both ends inclusive), each once.

    A null start or end leaves that side open, so a region with neither is a whole chromosome; a region that ends
    before it starts is empty, and one without a chromosome is left out. The regions' stretches (at most ``STRETCHES`` a
    chromosome) and the open regions prune folders and row groups of the scan. What is left meets the other
    regions in one bin of positions, so nothing is compared with more than the regions of its bin.
    """
    variants = read_variants(spark, path)
    regions = regions.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).filter("chrom IS NOT NULL")
    closed = regions.filter("start <= end")
    bins = binned_regions(closed).select(F.col("chrom").alias("r_chrom"), F.col("bin").alias("r_bin"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    opened = _opened(regions)
    rest = variants.filter(_stretches(closed) if opened is None else _stretches(closed) & ~opened)
    same_bin = (F.col("chrom") == F.col("r_chrom")) & (F.shiftright(F.col("pos").cast("long"), BIN_BITS) == F.col("r_bin"))
    found = rest.join(bins, same_bin & F.col("pos").between(F.col("r_start"), F.col("r_end")), "left_semi")
    return found if opened is None else variants.filter(opened).unionByName(found)
