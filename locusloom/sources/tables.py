"""Delimited text inputs: phenotypes, covariates, results and measurements."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.samples import MISSING_PHENOTYPE


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``sample_idx, value``: the lines of a headerless file with their number from 0. Several files, such as the
    ordered parts that the sinks write, are numbered through in order of their names.

    Lines are counted for each split of a file, and every split adds its own start: lines stay
    where they are read, and what is put in order is one row for each split.
    """
    # Only a line feed ends a line: carriage returns stay visible to the checks.
    lines = spark.read.option("lineSep", "\n").text(path)
    at = {"name": "file_name", "file": "file_path", "block": "file_block_start"}
    # Ids rise one by one within a split, wherever in a task it is read.
    placed = lines.select("value", *(F.col(f"_metadata.{c}").alias(k) for k, c in at.items()), F.monotonically_increasing_id().alias("id"))
    splits = placed.groupBy(*at).agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("n").over(W.orderBy(*at).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = splits.select("file", "block", (before - F.col("first")).alias("shift"))
    return placed.join(starts, ["file", "block"]).select((F.col("shift") + F.col("id")).cast("int").alias("sample_idx"), "value")


def read_keep_list(spark: SparkSession, path: str) -> DataFrame:
    """``position, sample_id``: one sample id per line, in list order; blank lines are left out."""
    lines = numbered_lines(spark, path).select(F.col("sample_idx").alias("position"), F.trim(F.regexp_replace("value", "\r$", "")).alias("sample_id"))
    return lines.filter("sample_id <> ''")


def read_phenotypes(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """One column per trait, line number = sample ordinal. ``NA``, blanks and the missing code are null."""
    rows = numbered_lines(spark, path).select(
        "sample_idx", F.split(F.regexp_replace("value", "\r$", ""), "\t").alias("f")
    )
    values = [F.trim(F.get("f", F.lit(i))).try_cast("double") for i in range(len(names))]
    return rows.select(
        "sample_idx", *[F.when(v != MISSING_PHENOTYPE, v).alias(name) for name, v in zip(names, values)]
    )


def read_phenotypes_by_id(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """``sample_id`` and one column per trait: the first field of a line is the sample's id, so lines may stand in
    any order. Values as in :func:`read_phenotypes`; blank lines are left out."""
    fields = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = spark.read.option("lineSep", "\n").text(path).select(fields.alias("f")).filter(F.array_join("f", "") != "")
    values = [F.trim(F.get("f", F.lit(i + 1))).try_cast("double") for i in range(len(names))]
    return rows.select(F.trim(F.col("f")[0]).alias("sample_id"), *[F.when(v != MISSING_PHENOTYPE, v).alias(name) for name, v in zip(names, values)])


def read_covariates(spark: SparkSession, path: str) -> DataFrame:
    """``sample_idx, w``: all columns of a headerless file as one array of doubles."""
    return numbered_lines(spark, path).select(
        "sample_idx",
        F.transform(
            F.split(F.trim(F.regexp_replace("value", "\r$", "")), r"[\t ]+"), lambda x: x.try_cast("double")
        ).alias("w"),
    )


# Column types of the two result layouts.
_ASSOC_TYPES = {
    "chr": "string", "rs": "string", "ps": "bigint", "n_miss": "int", "allele1": "string", "allele0": "string",
    "af": "double", "beta": "double", "se": "double", "l_remle": "double", "l_mle": "double",
    "p_wald": "double", "p_lrt": "double", "p_score": "double", "logl_H1": "double",
}


def read_assoc(spark: SparkSession, path: str) -> DataFrame:
    """Raw association results of either layout, typed by column name. Only the first line is a
    header, so a chromosome whose name starts like one stays a data row."""
    text = spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path)
    if text.columns[:3] != ["chr", "rs", "ps"]:
        raise ValueError(f"{path}: expected a header starting chr, rs, ps; found {text.columns[:3]}")
    return text.select(
        *[F.trim(F.col(c)).try_cast(_ASSOC_TYPES.get(c, "double")).alias(c) for c in text.columns]
    )


CLEAN_SCHEMA = "SNP string, CHR bigint, BP bigint, P double, zscore double"


def read_clean_assoc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).schema(CLEAN_SCHEMA).csv(path)


def file_headers(spark: SparkSession, folder: str, name_pattern: str) -> DataFrame:
    """``header, files``: the first line of all files whose name matches, and the files that have it. One pass over
    the text; a row for each layout comes out, with the paths of its files.

    The first line's number per file is found by a fixed-width minimum, and that line alone is
    joined back: no task holds or sorts the lines of its files to find it."""
    at = {c: F.col(f"_metadata.{c}") for c in ("file_name", "file_path", "file_block_start")}
    lines = spark.read.text(folder).select("value", *(c.alias(k) for k, c in at.items()), F.monotonically_increasing_id().alias("id"))
    heads = lines.filter(F.col("file_name").rlike(name_pattern) & (F.col("file_block_start") == 0))
    starts = heads.groupBy("file_path").agg(F.min("id").alias("id"))
    first = heads.join(F.broadcast(starts), ["file_path", "id"]).select("file_path", F.col("value").alias("header"))
    return first.groupBy("header").agg(F.array_sort(F.collect_list("file_path")).alias("files"))


def read_measurements(
    spark: SparkSession, folder: str, name_pattern: str, schema: T.StructType | str, unknown: str = "fail"
) -> DataFrame:
    """All files whose *name* matches a regular expression, bound by column name; ``source_file`` keeps the name.

    Files may have their columns in different orders or lack some, which are null then. Files are grouped by header, and each
    layout is read in one scan that checks the headers again. A column that ``schema`` does not
    know fails by name, unless ``unknown`` is ``drop``; a column that stands twice always fails. Without a matching
    file there are no rows.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = {f.name.lower(): f for f in wanted}
    found: list[DataFrame] = []
    for row in file_headers(spark, folder, name_pattern).orderBy("header").collect():
        names = [n.strip() for n in next(csv.reader([row["header"]], delimiter="\t"))]
        lower = [n.lower() for n in names]
        strange = [n for n in names if n.lower() not in known]
        if len(set(lower)) < len(lower) or (strange and unknown != "drop"):
            problem = f"unknown columns {strange}" if strange else f"repeated columns in {names}"
            raise ValueError(f"{row['files'][0]} and {len(row['files']) - 1} more: {problem}")
        layout = T.StructType([known.get(n.lower(), T.StructField(n, T.StringType())) for n in names])
        read = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", False).schema(layout).csv(row["files"])
        columns = [(F.col(f"`{f.name}`") if f.name.lower() in lower else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted]
        found.append(read.select(*columns, F.col("_metadata.file_name").alias("source_file")))
    if not found:
        return spark.createDataFrame([], T.StructType([*wanted.fields, T.StructField("source_file", T.StringType())]))
    return reduce(DataFrame.unionByName, found)
