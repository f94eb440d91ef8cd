"""Sample-space tables: order, phenotypes, covariates and their checks.

Every table carries ``sample_idx`` explicitly; row order never means anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the code of a missing phenotype in sample tables.
MISSING_PHENOTYPE = -9.0


def sample_order(df: DataFrame) -> DataFrame:
    return df.orderBy("sample_idx")


def select_traits(pheno: DataFrame, ordinals: Sequence[int]) -> DataFrame:
    """Keep the trait columns at the given 1-based ordinals, next to the sample keys."""
    keys = [c for c in ("sample_idx", "sample_id") if c in pheno.columns]
    traits = [c for c in pheno.columns if c not in keys]
    return pheno.select(*keys, *[traits[i - 1] for i in ordinals])


def align_phenotypes(samples: DataFrame, pheno: DataFrame) -> DataFrame:
    """Phenotypes by accession name put in sample order; a sample without one keeps nulls."""
    values = [c for c in pheno.columns if c not in ("sample_id", "sample_idx")]
    return samples.join(pheno.select("sample_id", *values), "sample_id", "left").select(
        "sample_idx", "sample_id", *values
    )


def paste_phenotype(fam: DataFrame, pheno: DataFrame, trait: str) -> DataFrame:
    """Replace the placeholder sixth column of the sample table by a trait, matched on the
    explicit ordinal. A sample without a row in ``pheno`` keeps its line, with a null phenotype."""
    return fam.drop("phenotype").join(
        pheno.select("sample_idx", F.col(trait).alias("phenotype")), "sample_idx", "left"
    )


def check_counts(samples: DataFrame, pheno: DataFrame, key: str = "sample_idx") -> DataFrame:
    """One row: ``n_samples, n_phenotypes, only_samples, only_phenotypes, same_count, ok``; ok asks for the
    same keys on both sides, same_count for equal numbers only."""
    marks = samples.select(key, F.lit(1).alias("s"), F.lit(0).alias("p")).unionByName(
        pheno.select(key, F.lit(0).alias("s"), F.lit(1).alias("p"))
    )
    per_key = marks.groupBy(key).agg(F.sum("s").alias("s"), F.sum("p").alias("p"))
    return per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("n_samples"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("n_phenotypes"),
        F.count_if(F.col("p") == 0).alias("only_samples"),
        F.count_if(F.col("s") == 0).alias("only_phenotypes"),
    ).withColumn("same_count", F.col("n_samples") == F.col("n_phenotypes")).withColumn(
        "ok", F.col("same_count") & (F.col("only_samples") == 0) & (F.col("only_phenotypes") == 0)
    )


def check_covariates(covar: DataFrame, pheno: DataFrame) -> DataFrame:
    """One row: ``n_covariate_rows, n_phenotypes, intercept_ok, ok``; the first column must be all 1."""
    left = covar.agg(
        F.count("*").alias("n_covariate_rows"),
        F.coalesce(F.bool_and(F.coalesce(F.get("w", F.lit(0)) == 1.0, F.lit(False))), F.lit(False)).alias("intercept_ok"),
    )
    n = pheno.agg(F.count("*").alias("n")).scalar()
    return left.withColumn("n_phenotypes", n).withColumn(
        "ok", F.col("intercept_ok") & (F.col("n_covariate_rows") == F.col("n_phenotypes"))
    )


def check_values(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row of counts over raw lines: ``n_lines, n_empty, n_carriage_return, n_not_numeric, ok``."""
    text = F.col(value)
    trimmed = F.trim(F.regexp_replace(text, "\r$", ""))
    fields = F.split(trimmed, "\t")
    bad = F.exists(fields, lambda f: f.try_cast("double").isNull() & (F.trim(f) != "NA"))
    return lines.agg(
        F.count("*").alias("n_lines"),
        F.count_if(trimmed == "").alias("n_empty"),
        F.count_if(text.endswith("\r")).alias("n_carriage_return"),
        F.count_if((trimmed != "") & bad).alias("n_not_numeric"),
    ).withColumn("ok", (F.col("n_empty") + F.col("n_carriage_return") + F.col("n_not_numeric")) == 0)


def require_ok(check: DataFrame) -> None:
    """Raise with the numbers of a check that failed."""
    row = check.first().asDict()
    if not row["ok"]:
        raise ValueError(f"input check failed: {row}")


def covariate_from_snp(geno: DataFrame, names: Sequence[str], key: str = "rs") -> DataFrame:
    """``sample_idx, w``: a leading 1 and the dosage of each named marker, in the given order;
    a gap takes the marker mean. Each sample's group has one entry per named marker."""
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(key))
    picked = geno.filter(F.col(key).isin(*names)).select(order.alias("at"), F.col("dosage"))
    mean = F.try_divide(
        F.aggregate("dosage", F.lit(0.0), lambda acc, d: acc + F.coalesce(d, F.lit(0.0))),
        F.size(F.array_compact("dosage")).cast("double"),
    )
    cells = picked.select("at", mean.alias("mean"), F.posexplode("dosage").alias("sample_idx", "d")).select(
        "at", "sample_idx", F.coalesce("d", "mean").alias("code")
    )
    # One aggregate per named marker: bounded by the list, and a repeated name fails below.
    columns = [F.max(F.when(F.col("at") == i + 1, F.col("code"))) for i in range(len(names))]
    found = F.count("*") == len(names)
    for column in columns:
        found = found & column.isNotNull()
    return cells.groupBy("sample_idx").agg(
        F.when(found, F.array(F.lit(1.0), *columns))
        .otherwise(F.raise_error(F.lit("a named marker is absent or occurs twice")).cast("array<double>"))
        .alias("w")
    )


def phenotype_by_allele(geno: DataFrame, pheno: DataFrame, name: str, trait: str = "y", key: str = "rs") -> DataFrame:
    """``sample_idx, dosage, <trait>`` for one marker: the phenotype next to the genotype class."""
    codes = geno.filter(F.col(key) == name).select(F.posexplode("dosage").alias("sample_idx", "dosage"))
    return codes.filter(F.col("dosage").isNotNull()).join(pheno.select("sample_idx", trait), "sample_idx")
