"""Genotype expressions. All are built-in expressions on one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The quality presets (minimum depth, minimum genotype quality).
LENIENT = (3, 25)
STRINGENT = (5, 30)

# The texts of a wholly missing call.
MISSING_CALLS = ("./.", ".|.", ".")


def call_or_null(gt: Column) -> Column:
    """A wholly missing call becomes null, anything else stays as written."""
    return F.when(~gt.isin(*MISSING_CALLS), gt)


def gt_dosage(gt: Column, haploid: str = "missing") -> Column:
    """Number of non-reference alleles (0, 1, 2) of a genotype text, null when unknown.

    A call with any ``.`` is unknown. A one-allele call is unknown too unless
    ``haploid='double'``, which counts its allele twice.
    """
    if haploid not in ("missing", "double"):
        raise ValueError("haploid must be 'missing' or 'double'")
    parts = F.split(gt, r"[/|]")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    alt = lambda a: F.when(a == "0", 0.0).otherwise(1.0)
    rare = F.when(
        (F.size(parts) == 2) & (first != ".") & (second != "."), alt(first) + alt(second)
    )
    if haploid == "double":
        rare = rare.when((F.size(parts) == 1) & (first != "."), 2.0 * alt(first))
    # The common texts are decided without splitting.
    return (
        F.when(gt.isin("0/0", "0|0"), 0.0)
        .when(gt.isin("0/1", "1/0", "0|1", "1|0"), 1.0)
        .when(gt.isin("1/1", "1|1"), 2.0)
        .when(gt.isNull() | gt.isin(*MISSING_CALLS), F.lit(None).cast("double"))
        .otherwise(rare)
    )


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    The optimizer copies an expression into every place that uses it, also when it pushes a
    filter below the projection that computes it; a lambda parameter cannot be copied.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set column ``name`` so that filters on it use the computed value.

    A filter on a projected column is pushed below the projection together with a copy of the
    whole expression; one on a generated column is not. Filters on other columns still move to
    the scan, ahead of the computation.
    """
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(value)).alias(name)).select(*rest, name)


def plain_code(gt: Column) -> Column:
    """0, 1, 2 for the common two-allele diploid texts, 9 for a wholly missing call, null for
    any other text."""
    return (
        F.when(gt.isin("0/0", "0|0"), 0)
        .when(gt.isNull() | gt.isin(*MISSING_CALLS), 9)
        .when(gt.isin("0/1", "1/0", "0|1", "1|0"), 1)
        .when(gt.isin("1/1", "1|1"), 2)
    )


def allele_count(gt: Column, allele: Column) -> Column:
    """How often an allele code occurs in a fully called genotype; 0 when it is unknown."""
    parts = F.split(gt, r"[/|]")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    hit = lambda a: F.when(a == allele, 1).otherwise(0)
    return F.when(
        (F.size(parts) == 2) & (first != ".") & (second != "."), hit(first) + hit(second)
    ).otherwise(0)


def passes_quality(dp: Column, gq: Column, min_dp: int, min_gq: int) -> Column:
    """True when depth and quality reach both thresholds; an absent value fails."""
    return F.coalesce((dp >= min_dp) & (gq >= min_gq), F.lit(False))


def dosage_sum(dosage: Column) -> Column:
    return F.aggregate(dosage, F.lit(0.0), lambda acc, d: acc + F.coalesce(d, F.lit(0.0)))


def called_count(dosage: Column) -> Column:
    return F.size(F.array_compact(dosage)).cast("long")


def missing_count_limit(n_samples: int, fraction: float) -> int:
    """Largest whole number of missing calls within ``fraction`` of the samples."""
    return int(n_samples * fraction + 1e-9)
