"""Run summaries and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import ledger
from .lmm import NullModel


def run_summary(
    spark: SparkSession,
    model: NullModel,
    run_id: str,
    n_markers: int,
    n_tested: int,
    seconds: float,
    parameters: dict[str, str] | None = None,
    trait: str = "y",
    covariates: str | None = None,
) -> DataFrame:
    """One row per run: label, trait, covariate name (null: none), parameters, marker counts, wall time
    and the null-model numbers. Stored rows of two runs can be compared by their trait."""
    row = model.summary(spark)
    return row.select(
        F.lit(run_id).alias("run_id"),
        F.lit(trait).alias("trait"),
        F.lit(covariates).cast("string").alias("covariates"),
        F.create_map(*[F.lit(x) for kv in (parameters or {}).items() for x in map(str, kv)])
        .cast("map<string,string>")
        .alias("parameters"),
        F.lit(n_markers).cast("long").alias("n_markers"),
        F.lit(n_tested).cast("long").alias("n_tested"),
        F.lit(float(seconds)).alias("seconds"),
        *row.columns,
    )


def append_summary(summary: DataFrame, path: str) -> None:
    """Add the rows of ``summary`` to the ledger at ``path``; a run that is appended again replaces its row."""
    ledger.append(summary, path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed row of each run_id."""
    return ledger.newest(spark, path, "run_id")


def pve_delta(without: Column, with_covariate: Column) -> Column:
    """Share of variance the covariate explains."""
    return without - with_covariate


def compare_stored_runs(runs: DataFrame) -> DataFrame:
    """:func:`compare_runs` of stored summaries: each set of covariates against the run of its trait without any."""
    plain, covaried = runs.filter(F.col("covariates").isNull()), runs.filter(F.col("covariates").isNotNull())
    return _compared(_single(plain, ["trait"]), _single(covaried, ["trait", "covariates"]), "trait")


def compare_runs(without: DataFrame, with_covariate: DataFrame, on: str = "trait") -> DataFrame:
    """Runs without and with covariates, matched one to one: ``pve_0, pve_c, pve_delta, beta_c``. Several runs of
    one key on a side fail."""
    return _compared(_single(without, [on]), _single(with_covariate, [on]), on)


def _single(runs: DataFrame, on: list[str]) -> DataFrame:
    """``runs`` with a check that no two have the same ``on``."""
    several = F.raise_error(F.concat(F.lit("several runs of "), F.concat_ws(", ", *(F.col(c).cast("string") for c in on))))
    only = F.when(F.count("*") == 1, F.first(F.struct("pve", "beta"))).otherwise(several)
    return runs.groupBy(*on).agg(only.alias("run")).select(*on, "run.pve", "run.beta")


def _compared(without: DataFrame, with_covariate: DataFrame, on: str) -> DataFrame:
    a = without.select(on, F.col("pve").alias("pve_0"))
    b = with_covariate.withColumnsRenamed({"pve": "pve_c", "beta": "beta_c"})
    kept = [c for c in b.columns if c not in (on, "pve_c", "beta_c")]
    return a.join(b, on).select(on, *kept, "pve_0", "pve_c", pve_delta(F.col("pve_0"), F.col("pve_c")).alias("pve_delta"), "beta_c")
