"""Association results: cleaning, thresholds, hits, and the tables behind the plots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import naming
from ..session import require_columns
from .ordering import expand_counts, place_in_order, running_total

# The two reference lines of a genome-position plot, as p-values.
SUGGESTIVE_P = 1e-5
GENOME_WIDE_P = 5e-8

# Fixed value: the error rate of the corrected threshold.
ALPHA = 0.05

# ---------------------------------------------------------------- cleaning


def recover_chromosome(assoc: DataFrame) -> DataFrame:
    """Add ``chrom_text``: the chromosome, or the digits in the first part of the SNP name
    when the chromosome is 0."""
    return assoc.withColumn("chrom_text", naming.chromosome_from_name(F.col("chr"), F.col("rs")))


def drop_non_integer_chromosomes(assoc: DataFrame) -> DataFrame:
    """Keep rows whose ``chrom_text`` is an integer (organelle chromosomes go)."""
    return assoc.filter(F.col("chrom_text").try_cast("bigint").isNotNull())


def project_clean(assoc: DataFrame, p_col: str = "p_lrt", stat_col: str = "l_mle") -> DataFrame:
    """SNP, CHR, BP, P, zscore, picked by name so both result layouts work.

    ``zscore`` carries the model's statistic column; under the likelihood ratio test that is
    the variance ratio, and the column keeps its name for the readers of the file.
    """
    require_columns(assoc, p_col, stat_col)
    return assoc.select(
        F.col("rs").alias("SNP"),
        F.col("chrom_text").try_cast("bigint").alias("CHR"),
        F.col("ps").alias("BP"),
        F.col(p_col).alias("P"),
        F.col(stat_col).alias("zscore"),
    )


def clean_assoc(
    assoc: DataFrame, p_col: str = "p_lrt", stat_col: str = "l_mle", on_bad: str = "drop"
) -> DataFrame:
    """The three steps above. Rows without an integer chromosome are dropped, or fail the
    job with ``on_bad='fail'``; ``rejected_assoc`` returns them."""
    rows = recover_chromosome(assoc)
    if on_bad == "fail":
        code = F.col("chrom_text").try_cast("bigint")
        message = F.concat(F.lit("chromosome is not an integer: "), F.coalesce("chr", F.lit("null")))
        rows = rows.withColumn(
            "chrom_text",
            F.when(code.isNotNull(), F.col("chrom_text")).otherwise(F.raise_error(message).cast("string")),
        )
    elif on_bad == "drop":
        rows = drop_non_integer_chromosomes(rows)
    else:
        raise ValueError("on_bad must be 'drop' or 'fail'")
    return project_clean(rows, p_col, stat_col)


def rejected_assoc(assoc: DataFrame) -> DataFrame:
    """The rows ``clean_assoc`` drops."""
    return (
        recover_chromosome(assoc)
        .filter(F.col("chrom_text").try_cast("bigint").isNull())
        .drop("chrom_text")
    )


# ---------------------------------------------------------------- thresholds and hits


def is_bonferroni(threshold: float | str) -> bool:
    return isinstance(threshold, str) and threshold.strip().lower() == "bonferroni"


def bonferroni_threshold(clean: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """One row: ``n_tests`` (rows with a null P count) and ``threshold`` = alpha / n_tests."""
    return clean.agg(F.count("*").alias("n_tests")).select(
        "n_tests", F.try_divide(F.lit(alpha), F.col("n_tests").cast("double")).alias("threshold")
    )


def threshold_column(clean: DataFrame, threshold: float | str, alpha: float = ALPHA) -> Column:
    """A number, a numeric text, or ``"bonferroni"`` (a scalar subquery, evaluated once)."""
    if is_bonferroni(threshold):
        return bonferroni_threshold(clean, alpha).select("threshold").scalar()
    return F.lit(float(threshold))


def significant_hits(clean: DataFrame, threshold: float | str = 0.0) -> DataFrame:
    """Rows with P strictly below the threshold; the default 0 selects none. Null P never passes."""
    return clean.filter(F.col("P") < threshold_column(clean, threshold))


def highlight(clean: DataFrame, snps: Sequence[str] | DataFrame) -> DataFrame:
    """Flag the listed SNP names: a short list in place, a table of names by a join."""
    if isinstance(snps, DataFrame):
        listed = snps.select(F.col(snps.columns[0]).alias("SNP")).distinct().withColumn("_listed", F.lit(True))
        joined = clean.join(listed, "SNP", "left")
        return joined.select(*clean.columns, F.coalesce("_listed", F.lit(False)).alias("highlight"))
    return clean.withColumn("highlight", F.coalesce(F.col("SNP").isin(*snps), F.lit(False)))


def hits_to_bed(hits: DataFrame, half_open: bool = False) -> DataFrame:
    """``chrom, start, end, name``; the first ``:`` of the name becomes ``_``.

    Start and end are both the position, as the interval files in use have it;
    ``half_open=True`` gives the zero-based start the format defines.
    """
    return hits.select(
        F.concat(F.lit("chr"), F.col("CHR").cast("string")).alias("chrom"),
        (F.col("BP") - (1 if half_open else 0)).alias("start"),
        F.col("BP").alias("end"),
        F.regexp_replace("SNP", "^([^:]*):", "$1_").alias("name"),
    )


def neg_log_p(clean: DataFrame) -> DataFrame:
    """Add ``neg_log10_p`` and ``neg_ln_p``."""
    return clean.withColumn("neg_log10_p", naming.neg_log(F.col("P"))).withColumn(
        "neg_ln_p", naming.neg_log(F.col("P"), "e")
    )


def orient_effect(assoc: DataFrame, beta: str = "beta", alt_af: str = "alt_af") -> DataFrame:
    """Slope in terms of the alternative allele: sign flipped where that allele is the more
    frequent one, because the model then counted the other allele."""
    return assoc.withColumn(beta, F.when(F.col(alt_af) > 0.5, -F.col(beta)).otherwise(F.col(beta)))


# ---------------------------------------------------------------- tables behind the plots


def snps_per_chromosome(clean: DataFrame) -> DataFrame:
    return clean.groupBy("CHR").agg(F.count("*").alias("n_snps"))


def chr_scatter(clean: DataFrame) -> DataFrame:
    return clean.select("CHR", naming.neg_log(F.col("P"), "e").alias("neg_ln_p"))


def pretty_edges(low: float, high: float, bins: int) -> tuple[float, float, int]:
    """Round bin edges covering [low, high] with about ``bins`` bins of width 1, 2 or 5 times a
    power of ten: ``(first edge, width, number of bins)``."""
    least = bins // 3
    if high > low:
        cell = (high - low) / bins
    else:  # a single value: a width of its own magnitude
        cell = max(abs(low), abs(high)) or 1.0
        cell = 0.75 * (9.0 + cell / 10.0 if cell > 10.0 else cell) / max(least, 1)
    base = 10.0 ** math.floor(math.log10(cell))
    width = base
    # The bias towards the larger of two neighbouring widths (1.5 and 0.5 + 1.5 * 1.5).
    for factor, bias in ((2.0, 1.5), (5.0, 2.75), (10.0, 1.5)):
        if factor * base - cell < bias * (cell - width):
            width = factor * base
    slack = 1e-10
    first = math.floor(low / width + slack)
    last = math.ceil(high / width - slack)
    if last - first < least:
        lack = least - (last - first)
        if low == 0.0 and first == 0 and high != 0.0:
            last += lack
        elif high == 0.0 and last == 0 and low != 0.0:
            first -= lack
        elif first >= 0:
            last += lack // 2
            first -= lack - lack // 2
        else:
            first -= lack // 2
            last += lack - lack // 2
    return first * width, width, max(int(last - first), 1)


def histogram(clean: DataFrame, bins: int | None = None) -> DataFrame:
    """Counts of -ln P in right-closed bins, the lowest value included: ``bin, lower, upper, n``.

    The number of bins follows the logarithm of the number of values unless given, then the
    edges are rounded. Only bins with values have a row. One pass finds the range (one row
    reaches the driver), the second counts with map-side combining.
    """
    values = clean.select(naming.neg_log(F.col("P"), "e").alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != float("inf"))
    )
    n, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return values.select(
            F.lit(0).alias("bin"), F.col("v").alias("lower"), F.col("v").alias("upper"), F.lit(0).cast("long").alias("n")
        ).limit(0)
    first, width, count = pretty_edges(low, high, bins or math.ceil(math.log2(n) + 1))
    index = F.ceil((F.col("v") - first) / width - 1e-7).cast("int")
    return (
        values.select(F.greatest(F.lit(1), F.least(index, F.lit(count))).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            (F.lit(first) + (F.col("bin") - 1) * width).alias("lower"),
            (F.lit(first) + F.col("bin") * width).alias("upper"),
            "n",
        )
    )


def qq_points(clean: DataFrame) -> DataFrame:
    """Observed against expected -log10 P, one row per valid P (0 < P < 1): ``rank, P, observed, expected``.

    Equal p-values are counted before they are shuffled, the distinct ones are range
    partitioned, ranks follow from one start per partition, and counts are expanded again.
    """
    counted = clean.filter((F.col("P") > 0) & (F.col("P") < 1)).groupBy("P").agg(F.count("*").alias("copies"))
    ranked, n = running_total(place_in_order(counted, ["P"]), "copies", "before")
    shift = 0.375 if n <= 10 else 0.5
    return (
        expand_counts(ranked, "copies", "copy")
        .select("P", (F.col("before") + F.col("copy") + 1).alias("rank"))
        .select(
            "rank",
            "P",
            (-F.log10("P")).alias("observed"),
            (-F.log10((F.col("rank") - shift) / (n + 1 - 2 * shift))).alias("expected"),
        )
    )


def chromosome_layout(clean: DataFrame) -> DataFrame:
    """``CHR, min_bp, max_bp, n_snps, offset, tick``: where each chromosome starts on a common
    axis (the largest positions of the chromosomes before it, summed) and its label centre. The
    ordered sum runs over one aggregated row per chromosome."""
    table = clean.groupBy("CHR").agg(F.min("BP").alias("min_bp"), F.max("BP").alias("max_bp"), F.count("*").alias("n_snps"))
    before = W.orderBy("CHR").rowsBetween(W.unboundedPreceding, -1)
    placed = table.withColumn("offset", F.coalesce(F.sum("max_bp").over(before), F.lit(0)).cast("long"))
    return placed.withColumn("tick", F.col("offset") + (F.col("min_bp") + F.col("max_bp")) / 2.0)


def manhattan_ticks(clean: DataFrame) -> DataFrame:
    return chromosome_layout(clean)


def manhattan_layout(
    clean: DataFrame, threshold: float | str = SUGGESTIVE_P, highlighted: Sequence[str] | DataFrame = ()
) -> DataFrame:
    """Add ``x`` (position on the common axis), ``y`` (-log10 P), ``threshold_y``, ``above``
    (P below the threshold) and ``highlight``."""
    table = chromosome_layout(clean)
    offsets = table.select("CHR", "offset")
    if is_bonferroni(threshold):
        # The layout has counted the rows already.
        limit = table.agg(F.try_divide(F.lit(ALPHA), F.sum("n_snps").cast("double")).alias("threshold")).scalar()
    else:
        limit = F.lit(float(threshold))
    listed = isinstance(highlighted, DataFrame) or len(highlighted) > 0
    flagged = highlight(clean, highlighted) if listed else clean.withColumn("highlight", F.lit(False))
    return (
        flagged.join(offsets, "CHR")
        .withColumn("x", F.col("BP") + F.col("offset"))
        .withColumn("y", naming.neg_log(F.col("P")))
        .withColumn("threshold_y", naming.neg_log(limit))
        .withColumn("above", F.coalesce(F.col("P") < limit, F.lit(False)))
        .drop("offset")
    )
