"""Image measurements to per-accession phenotypes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import naming
from .ordering import place_in_order, running_total


def union_measurements(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every text column."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def parse_accession(df: DataFrame, mode: str = "default", label: str = "label") -> DataFrame:
    """Add ``accession`` in front."""
    return df.select(naming.accession(F.col(label), mode).alias("accession"), *df.columns)


def reorder_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The named columns first, the others after them in their order."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def levels(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def mean_strict(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Group means; a null anywhere in the group makes the mean null."""
    return df.groupBy(group).agg(*[_strict(c).alias(c) for c in columns])


def mean_skip_na(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Group means over the non-null values."""
    return df.groupBy(group).agg(*[F.avg(c).alias(c) for c in columns])


def _strict(column: str) -> Column:
    return F.when(F.count(column) == F.count("*"), F.avg(column))


def contingency(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts per ``row`` value with one column per ``column`` value, 0 where none.

    Column names must be known before a plan is, so without ``values`` the levels are fetched, as many as
    ``spark.sql.pivotMaxValues`` allows; more are an error, and :func:`contingency_long` counts any number.
    """
    if values is None:
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).toArrow().column(0).to_pylist()
        if len(found) > most:
            raise ValueError(f"{column} has more than {most} levels: name the values, or use contingency_long")
        values = sorted(found)
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(str(v)) for v in values])


def contingency_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """``row, column, n``: the counts above 0 of any number of levels, one row each."""
    return df.filter(F.col(column).isNotNull()).groupBy(row, column).agg(F.count("*").alias("n"))


def _hx(column: str, compact: str) -> Column:
    return F.try_divide(F.count_if(F.col(column) == compact).cast("double"), F.count(column))


def hx_by_accession(df: DataFrame, group: str = "accession", column: str = "type", compact: str = "compact") -> DataFrame:
    """Share of compact nuclei among those with a type; null for a group without any."""
    return df.groupBy(group).agg(_hx(column, compact).alias("hx"))


def hx_overall(df: DataFrame, column: str = "type", compact: str = "compact") -> DataFrame:
    return df.agg(_hx(column, compact).alias("hx"))


def merge_by_accession(frames: Sequence[DataFrame], on: str = "accession") -> DataFrame:
    """Inner joins of summaries on one column."""
    return reduce(lambda a, b: a.join(b, on), frames)


def _single_tag(tag: str) -> Column:
    clash = F.raise_error(F.lit("an accession carries more than one tag")).cast("string")
    return F.when(F.min(tag) == F.max(tag), F.min(tag).cast("string")).when(F.min(tag) != F.max(tag), clash)


def attach_tag(summary: DataFrame, source: DataFrame, tag: str, on: str = "accession") -> DataFrame:
    """Join each accession's tag from the rows that carry both. Two tags for one accession fail."""
    kind = source.schema[tag].dataType
    tags = source.groupBy(on).agg(_single_tag(tag).cast(kind).alias(tag)).filter(F.col(tag).isNotNull())
    return summary.join(tags, on)


def summarize_accessions(
    df: DataFrame,
    strict_columns: Sequence[str],
    skip_na_columns: Sequence[str],
    tag: str,
    group: str = "accession",
    type_column: str = "type",
) -> DataFrame:
    """Accession, tag, strict means, null-skipping means and HX in **one** aggregation: the
    three summaries and the tag share a key, so joining them would only repeat the shuffle.
    Accessions without a tag are left out, as an inner join would."""
    kind = df.schema[tag].dataType
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            _single_tag(tag).cast(kind).alias(tag),
            *[_strict(c).alias(c) for c in strict_columns],
            *[F.avg(c).alias(c) for c in skip_na_columns],
            _hx(type_column, "compact").alias("hx"),
        )
        .filter(F.col(tag).isNotNull())
    )


# ---------------------------------------------------------------- box plots


def _value_counts(df: DataFrame, group: str, variable: str) -> DataFrame:
    """``g, v, n`` in order of group and value, stored once."""
    counts = (
        df.select(F.col(group).alias("g"), F.col(variable).cast("double").alias("v"))
        .filter(F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy("g", "v")
        .agg(F.count("*").alias("n"))
    )
    return place_in_order(counts, ["g", "v"])


def _boxes(placed: DataFrame) -> DataFrame:
    """One row of quartiles and fences per group.

    Quartiles interpolate between order statistics found by rank in the table of distinct
    (group, value) pairs. The pairs are counted before the shuffle and ranked by range
    partitions, so a group holding a third of all rows is split like any other data; the
    built-in exact percentile would hold such a group's values in one task.
    """
    ranked, _ = running_total(placed, "n", "before")
    sizes = ranked.groupBy(F.col("g").alias("_g")).agg(F.sum("n").alias("size"), F.min("before").alias("start"))
    lo = F.col("before") - F.col("start")
    at = ranked.join(sizes, F.col("g").eqNullSafe(F.col("_g"))).select(
        "g", "v", "size", lo.alias("lo"), (lo + F.col("n")).alias("hi")
    )
    picks, quartiles = [], []
    for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        h = (F.col("size") - 1) * share
        for end, k in (("low", F.floor(h)), ("high", F.ceil(h))):
            picks.append(F.max(F.when((F.col("lo") <= k) & (k < F.col("hi")), F.col("v"))).alias(f"{name}_{end}"))
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        quartiles.append((low + (h - F.floor(h)) * (high - low)).alias(name))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return (
        at.groupBy("g", "size")
        .agg(*picks)
        .select(F.col("g").alias("_g"), "size", *quartiles)
        .withColumn("fence_low", F.col("q1") - reach)
        .withColumn("fence_high", F.col("q3") + reach)
    )


def boxplot_stats(df: DataFrame, group: str, variable: str) -> DataFrame:
    """``group, n, q1, median, q3, whisker_low, whisker_high, n_outliers`` per group: quartiles
    by linear interpolation, whiskers at the outermost values within 1.5 times the box height."""
    placed = _value_counts(df, group, variable)
    inside = F.col("v").between(F.col("fence_low"), F.col("fence_high"))
    return (
        placed.join(_boxes(placed), F.col("g").eqNullSafe(F.col("_g")))
        .groupBy("g", "size", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).cast("long").alias("n_outliers"),
        )
        .withColumnsRenamed({"g": group, "size": "n"})
    )


def boxplot_outliers(df: DataFrame, group: str, variable: str) -> DataFrame:
    """The rows of ``df`` beyond the whiskers; null and NaN values are no outliers."""
    fences = _boxes(_value_counts(df, group, variable)).select("_g", "fence_low", "fence_high")
    value = F.col(variable)
    return (
        df.join(fences, df[group].eqNullSafe(F.col("_g")))
        .filter(~F.isnan(value.cast("double")) & ((value < F.col("fence_low")) | (value > F.col("fence_high"))))
        .select(*df.columns)
    )
