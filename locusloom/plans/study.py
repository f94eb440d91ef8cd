"""From the files of a study to checked markers and phenotypes in one sample order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import run_label
from ..operators import samples as SA
from ..operators import sites as S
from ..sources import store, tables, vcf
from .association import markers
from .funnel import quality_funnel


@dataclass
class Study:
    """Inputs of a run: its label, samples, phenotypes, covariates if any, and stored markers."""

    run_id: str
    samples: DataFrame
    pheno: DataFrame
    covar: DataFrame | None
    markers: DataFrame


def study_inputs(
    spark: SparkSession,
    phenotype_path: str,
    calls_path: str,
    folder: str,
    traits: Sequence[str] = ("y",),
    covariate_path: str | None = None,
    keep_path: str | None = None,
    by_id: bool = False,
    **funnel,
) -> Study:
    """Validate the files of a study, filter its calls and store the markers below ``folder``.

    Phenotype lines must be as many as the samples of the call file, without blank lines, carriage
    returns or text, in the order of those samples; covariate lines as many again, with a first column of 1.
    With ``by_id`` a phenotype line begins with its sample's id and may stand anywhere. A keep list (ids, one a
    line) takes those samples in its own order: calls, samples, phenotypes and covariates are all
    renumbered by it. Ordinals (``samples=``) are refused, as they would leave the others behind.
    Markers are found by a fingerprint of the call file, the keep list and the funnel options, so further traits reuse them.
    """
    if "samples" in funnel:
        raise ValueError("give the samples as a keep list of ids, not as ordinals")
    samples = vcf.vcf_samples(spark, calls_path)
    lines = tables.numbered_lines(spark, phenotype_path)
    if by_id:
        SA.require_ok(SA.check_values(lines.select(F.regexp_replace("value", "^[^\t]*\t", "").alias("value"))))
        pheno = tables.read_phenotypes_by_id(spark, phenotype_path, traits)
    else:
        SA.require_ok(SA.check_values(lines))
        pheno = tables.read_phenotypes(spark, phenotype_path, traits)
        SA.require_ok(SA.check_counts(samples, pheno))
        pheno = samples.join(pheno, "sample_idx").drop("sample_idx")
    covar = None
    if covariate_path is not None:
        covar = tables.read_covariates(spark, covariate_path)
        SA.require_ok(SA.check_covariates(covar, samples))
        covar = samples.join(covar, "sample_idx").drop("sample_idx")
    keep = None if keep_path is None else tables.read_keep_list(spark, keep_path)
    order = samples if keep is None else S.listed_samples(samples, keep)
    if keep is not None:
        pheno = pheno.join(order.select("sample_id"), "sample_id", "left_semi")
    SA.require_ok(SA.check_counts(order, pheno, "sample_id"))

    def build() -> DataFrame:
        sites = vcf.read_vcf(spark, calls_path)
        return markers(quality_funnel(sites if keep is None else S.subset_by_id(sites, samples, keep)[0], **funnel))

    key = store.fingerprint(spark, [calls_path] if keep_path is None else [calls_path, keep_path], funnel)
    kept = store.reuse_or_compute(spark, folder, build, key)
    if covar is not None:
        covar = order.join(covar, "sample_id").select("sample_idx", "w")
    return Study(run_label(phenotype_path, covariate_path), order, SA.align_phenotypes(order, pheno), covar, kept)
