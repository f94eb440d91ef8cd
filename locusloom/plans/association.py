"""An association run from marker rows to a cleaned result."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import kinship as K
from ..operators import lmm as L
from ..operators import results as R
from ..operators import sites as S
from ..operators.report import run_summary
from ..session import cut_lineage


@dataclass
class Run:
    """What a run leaves behind."""

    run_id: str
    kinship: DataFrame
    model: L.NullModel
    assoc: DataFrame
    clean: DataFrame
    summary: DataFrame


def markers(sites: DataFrame, name: str = "id") -> DataFrame:
    """Sites with calls -> marker rows counting the rarer allele."""
    dosed = S.gt_to_dosage(sites).select(
        "chrom", F.col(name).alias("rs"), "pos", F.get("alts", F.lit(0)).alias("a1"), F.col("ref").alias("a0"), "dosage"
    )
    return S.minor_allele_recode(dosed)


def relatedness(geno: DataFrame, n_samples: int, **options) -> DataFrame:
    """The centred matrix, kept in reliable storage: every trait and covariate set reuses it."""
    return cut_lineage(K.kinship_centered(geno, n_samples, **options))


def association_run(
    geno: DataFrame,
    pheno: DataFrame,
    n_samples: int,
    run_id: str,
    trait: str = "y",
    covar: DataFrame | None = None,
    kin: DataFrame | None = None,
    test: str = "lrt",
    maf: float = 0.05,
    max_missing: float = 0.05,
    kinship_maf: float = 0.01,
) -> Run:
    """Relatedness (unless given), null model, marker scan, cleaned result and run summary.

    The scan result is written once, so the cleaned table, the counts and later reports read
    it instead of testing the markers again. ``geno`` is read once for the relatedness and once
    for the scan (its rows are counted on the way), so store it when it comes from raw calls.
    """
    started = time.monotonic()
    if kin is None:
        kin = relatedness(geno, n_samples, maf=kinship_maf)
    model = L.null_model(pheno, kin, trait, covar, n_samples)
    seen = Observation()
    counted = geno.select(*L.MARKER_COLUMNS).observe(seen, F.count(F.lit(1)).alias("markers"))
    assoc = cut_lineage(L.lmm_scan(counted, model, test, maf, max_missing))
    stat = "l_mle" if test == "lrt" else "beta"
    summary = run_summary(
        geno.sparkSession, model, run_id, seen.get["markers"], assoc.count(), time.monotonic() - started,
        {"trait": trait, "test": test, "maf": maf, "max_missing": max_missing, "kinship_maf": kinship_maf},
        trait, None if covar is None else run_id,
    )
    return Run(run_id, kin, model, assoc, R.clean_assoc(assoc, "p_lrt", stat), summary)


def association_traits(
    geno: DataFrame,
    pheno: DataFrame,
    n_samples: int,
    traits: Sequence[str],
    kin: DataFrame,
    covar: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Several traits tested in one pass over the genotypes; one ``trait`` column more. The
    relatedness is collected once and decomposed once per set of analysed samples."""
    K_, done = L.relatedness_matrix(kin, n_samples), {}
    models: Mapping[str, L.NullModel] = {t: L.null_model(pheno, K_, t, covar, n_samples, done) for t in traits}
    return L.lmm_scan(geno, models, **options)
