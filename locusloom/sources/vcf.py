"""Variant call files, plain or gzip, as site rows."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.genotype import call_or_null, compute_once

FIXED_FIELDS = 9


def _unix(value: Column) -> Column:
    return F.rtrim(value, F.lit("\r"))


def _header(spark: SparkSession, path: str) -> str:
    """The first column header found; it stands near a file's start, so few splits are read."""
    found = spark.read.text(path).filter(F.col("value").startswith("#CHROM")).first()
    if found is None:
        raise ValueError(f"{path}: no #CHROM header")
    return found["value"].rstrip("\r")


def _names(header: str) -> list[str]:
    return header.split("\t")[FIXED_FIELDS:]


def vcf_samples(spark: SparkSession, path: str) -> DataFrame:
    """``sample_idx, sample_id`` in file order."""
    rows = list(enumerate(_names(_header(spark, path))))
    return spark.createDataFrame(rows, "sample_idx int, sample_id string")


def read_vcf(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """``variant_id, chrom, pos, id, ref, alts, calls``: one row per site, calls in sample order.

    All files under ``path`` must list the same samples. ``variant_id`` is ``chrom:pos:ref:alts``, the same in every run. A gzip file is one split,
    alone or in a folder, so where there are fewer files than tasks their lines are spread over ``partitions`` tasks
    right away; plain text splits by itself.
    Keep the result with ``write_variants`` and read that for repeated work.
    """
    header = _header(spark, path)
    n = len(_names(header))
    # Headers of further files are compared in the same pass that reads the sites.
    same = F.sha2(_unix(F.col("value")), 256) == hashlib.sha256(header.encode()).hexdigest()
    is_site = (
        F.when(~F.col("value").startswith("#"), ~F.col("value").isin("", "\r"))
        .when(~F.col("value").startswith("#CHROM") | same, False)
        .otherwise(F.raise_error(F.lit("the files list different samples")).cast("boolean"))
    )
    text = spark.read.text(path)
    lines = text.filter(is_site)
    if partitions is None:
        files = text.inputFiles()  # the scan has listed them
        tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        if len(files) < tasks and any(f.endswith(".gz") for f in files):
            partitions = tasks
    if partitions:
        lines = lines.repartition(partitions, F.xxhash64("value"))
    fields = F.split(_unix(F.col("value")), "\t")
    at = lambda i: F.get(F.col("f"), F.lit(i))
    rows = compute_once(lines, "f", fields).select(
        at(0).alias("chrom"),
        at(1).try_cast("bigint").alias("pos"),
        at(2).alias("id"),
        at(3).alias("ref"),
        F.when(at(4) == ".", F.array().cast("array<string>")).otherwise(F.split(at(4), ",")).alias("alts"),
        F.split(at(8), ":").alias("format"),
        F.slice("f", FIXED_FIELDS + 1, max(n, 1)).alias("texts"),
    )
    keys = {k: F.array_position("format", k).cast("int") - 1 for k in ("GT", "DP", "GQ")}
    rows = rows.select("*", *[v.alias(f"at_{k}") for k, v in keys.items()])

    def call(parts: Column) -> Column:
        return F.struct(
            call_or_null(F.get(parts, F.col("at_GT"))).alias("gt"),
            F.get(parts, F.col("at_DP")).try_cast("int").alias("dp"),
            F.get(parts, F.col("at_GQ")).try_cast("int").alias("gq"),
        )

    # Filters pushed to the scan may be evaluated on header lines too, so those must not fail here.
    complete = (F.size("texts") == n) | F.col("chrom").startswith("#") | F.col("chrom").isin("", "\r")
    calls = F.when(complete, F.transform(F.transform("texts", lambda text: F.split(text, ":")), call)).otherwise(
        F.raise_error(F.concat(F.lit("wrong number of sample fields at "), "chrom", F.lit(":"), F.col("pos").cast("string")))
        .cast("array<struct<gt:string,dp:int,gq:int>>")
    )
    return compute_once(rows, "calls", calls).select(
        F.concat_ws(":", "chrom", F.col("pos").cast("string"), "ref", F.concat_ws(",", "alts")).alias("variant_id"),
        "chrom", "pos", "id", "ref", "alts", "calls",
    )
