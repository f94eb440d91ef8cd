"""Relatedness, mixed model and run comparison."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import kinship as K
from ..operators import lmm as L
from ..operators import phenotype as P
from ..operators import report as RP
from ..operators import results as R
from ..operators import samples as SA
from ..operators import slopes
from ..plans.association import association_run, association_traits, relatedness
from ..session import scratch_path
from ..sources import ledger
from . import query, rounded

N = fx.N_GENO_SAMPLES
COVARIATE = "snp0"


def _covar(spark, sf):
    return SA.covariate_from_snp(fx.geno(spark, sf), [COVARIATE])


def _null(spark, sf, covar=None):
    return L.null_model(fx.pheno(spark, sf), K.kinship_centered(fx.geno(spark, sf), N), covar=covar, n_samples=N)


_CENTRED = """, x AS (SELECT g.variant_id, sample_idx, coalesce(d, mean) - mean AS z, called, mean FROM geno_long g JOIN markers m USING (variant_id)),
    v AS (SELECT variant_id, sum(z * z) / 64 AS var FROM x GROUP BY variant_id, called, mean
          HAVING 64 - called <= 0.05e0 * 64 AND least(mean / 2, 1 - mean / 2) >= 0.01e0 AND sum(z * z) / 64 > 1e-12),
    k AS (SELECT x.variant_id, sample_idx, z, var FROM x JOIN v USING (variant_id))
    SELECT a.sample_idx AS i, b.sample_idx AS j, round(sum(a.z * b.z{scale}) / (SELECT count(*) FROM v), 8) AS k
    FROM k a JOIN k b ON a.variant_id = b.variant_id AND a.sample_idx <= b.sample_idx GROUP BY a.sample_idx, b.sample_idx"""


@query("kinship_centered", "geno_long markers", _CENTRED.format(scale=""))
def kinship_centered(spark, sf):
    return K.kinship_centered(fx.geno(spark, sf), N).withColumn("k", rounded("k", 8))


@query("kinship_standardized", "geno_long markers", _CENTRED.format(scale=" / a.var"))
def kinship_standardized(spark, sf):
    return K.kinship_standardized(fx.geno(spark, sf), N).withColumn("k", rounded("k", 8))


@query("null_model")
def null_model(spark, sf):
    return _null(spark, sf).summary(spark, trait="y")


@query("lmm_scan_lrt")
def lmm_scan_lrt(spark, sf):
    return L.lmm_scan(fx.geno(spark, sf), _null(spark, sf), "lrt")


@query("lmm_scan_all")
def lmm_scan_all(spark, sf):
    return L.lmm_scan(fx.geno(spark, sf), _null(spark, sf), "all")


@query("lmm_scan_covariates")
def lmm_scan_covariates(spark, sf):
    return L.lmm_scan(fx.geno(spark, sf), _null(spark, sf, _covar(spark, sf)), "all")


@query(
    "lmm_scan_markers",
    "geno_long markers",
    """SELECT CAST(variant_id % 5 + 1 AS VARCHAR) AS chr, 'snp' || CAST(variant_id AS VARCHAR) AS rs, variant_id * 1000 + 1 AS ps,
         CAST(64 - called AS INT) AS n_miss, 'A' AS allele1, 'G' AS allele0, round(mean / 2, 9) AS af
       FROM markers WHERE 64 - called <= 0.05e0 * 64 AND least(mean / 2, 1 - mean / 2) >= 0.05e0 AND kinds > 1""",
)
def lmm_scan_markers(spark, sf):
    scanned = lmm_scan_lrt(spark, sf)
    return scanned.select("chr", "rs", "ps", "n_miss", "allele1", "allele0", rounded("af").alias("af"))


@query(
    "lmm_scan_unrelated",
    "geno_long pheno markers",
    """, x AS (SELECT g.variant_id, coalesce(d, mean) AS x, y FROM geno_long g JOIN pheno USING (sample_idx) JOIN markers m
           ON m.variant_id = g.variant_id
           WHERE 64 - called <= 0.05e0 * 64 AND least(mean / 2, 1 - mean / 2) >= 0.05e0 AND kinds > 1),
    f AS (SELECT variant_id, count(*) AS n, regr_slope(y, x) AS beta, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy
          FROM x GROUP BY variant_id)
    SELECT 'snp' || CAST(variant_id AS VARCHAR) AS rs, round(beta, 7) AS beta,
      round(sqrt((syy - beta * beta * sxx) / (n - 2) / sxx), 7) AS se FROM f""",
)
def lmm_scan_unrelated(spark, sf):
    """Without relatedness the model is ordinary regression, which SQL can state. Seven digits: some slopes of
    whole numbers end behind the seventh, where six would be a rounding tie."""
    pheno = fx.pheno(spark, sf)
    other = pheno.select(F.col("sample_idx").alias("j"))
    none = pheno.select(F.col("sample_idx").alias("i")).join(other, F.col("i") <= F.col("j")).withColumn("k", F.lit(0.0))
    scanned = L.lmm_scan(fx.geno(spark, sf), L.null_model(pheno, none, n_samples=N), "all")
    return scanned.select("rs", rounded("beta", 7).alias("beta"), rounded("se", 7).alias("se"))


@query(
    "slope_scan",
    "geno_long pheno markers",
    """, x AS (SELECT g.variant_id, sample_idx, coalesce(d, mean) AS x FROM geno_long g JOIN markers m ON m.variant_id = g.variant_id
           WHERE 64 - called <= 0.05e0 * 64 AND least(mean / 2, 1 - mean / 2) >= 0.05e0 AND kinds > 1),
    u AS (SELECT sample_idx, y, k, 1 / (0.8e0 * (k % 5) + 1) AS w,
            CASE WHEN k = 0 THEN 0.125e0 ELSE sqrt(2e0 / 64) * cos(pi() * (sample_idx + 0.5e0) * k / 64) END AS u
          FROM pheno, range(64) r(k)),
    t AS (SELECT variant_id, k, sum(u * x) AS t FROM x JOIN u USING (sample_idx) GROUP BY variant_id, k),
    n AS (SELECT k, w, sum(u * y) AS y, sum(u) AS o FROM u GROUP BY k, w),
    s AS (SELECT variant_id, sum(w * t * t) - pow(sum(w * t * o), 2) / sum(w * o * o) AS xx,
            sum(w * t * y) - sum(w * t * o) * sum(w * o * y) / sum(w * o * o) AS xy,
            sum(w * y * y) - pow(sum(w * o * y), 2) / sum(w * o * o) AS yy FROM t JOIN n USING (k) GROUP BY variant_id)
    SELECT 'snp' || CAST(variant_id AS VARCHAR) AS rs, round(xy / xx, 6) AS beta, round(sqrt((yy - xy * xy / xx) / 62 / xx), 6) AS se,
      round(xy * xy / xx / ((yy - xy * xy / xx) / 62), 6) AS f_wald, round(64 * xy * xy / (yy * xx), 6) AS f_score FROM s""",
)
def slope_scan(spark, sf):
    """Slopes at a given variance ratio, for a relatedness whose eigenvectors are cosines."""
    pheno = fx.pheno(spark, sf)
    cosine = F.sqrt(F.lit(2 / N)) * F.cos(F.pi() * (F.col("sample_idx") + 0.5) * F.col("k") / N)
    cells = pheno.select("sample_idx", F.explode(F.sequence(F.lit(0), F.lit(N - 1))).alias("k"))
    basis = cells.withColumn("u", F.when(F.col("k") == 0, F.sqrt(F.lit(1 / N))).otherwise(cosine))
    spectrum = basis.select("k").distinct().withColumn("d", (F.col("k") % 5).cast("double"))
    scanned = slopes.slope_scan(fx.geno(spark, sf), basis, spectrum, pheno, N, ratio=0.8, block_cells=16 * N)
    return scanned.select("rs", *[rounded(c, 6).alias(c) for c in ("beta", "se", "f_wald", "f_score")])


@query("association_traits")
def traits(spark, sf):
    geno = fx.geno(spark, sf)
    pheno = fx.pheno(spark, sf).withColumn("log_y", F.log1p(F.col("y") - F.lit(fx.pheno(spark, sf).agg(F.min("y")).first()[0])))
    return association_traits(geno, pheno, N, ["y", "log_y"], relatedness(geno, N))


@query(
    "covariate_from_snp",
    "geno_long markers",
    """, c AS (SELECT g.variant_id, sample_idx, CAST(coalesce(d, mean) AS DOUBLE) AS code FROM geno_long g JOIN markers USING (variant_id))
    SELECT a.sample_idx, 1e0 AS w0, round(a.code, 9) AS w1, round(b.code, 9) AS w2
    FROM c a JOIN c b ON a.sample_idx = b.sample_idx WHERE a.variant_id = 0 AND b.variant_id = 7""",
)
def covariate_from_snp(spark, sf):
    w = SA.covariate_from_snp(fx.geno(spark, sf), ["snp0", "snp7"])
    return w.select("sample_idx", *[rounded(F.get("w", F.lit(i))).alias(f"w{i}") for i in range(3)])


@query(
    "prune_collinear",
    "geno_long markers",
    """, c AS (SELECT g.variant_id, sample_idx, coalesce(d, mean) AS code FROM geno_long g JOIN markers USING (variant_id))
    SELECT c.variant_id FROM c JOIN c z ON z.sample_idx = c.sample_idx AND z.variant_id = 0
    GROUP BY c.variant_id HAVING min(c.code) < max(c.code) AND pow(corr(c.code, z.code), 2) < 0.9999e0""",
)
def prune_collinear(spark, sf):
    w = _covar(spark, sf).orderBy("sample_idx").toArrow()["w"].to_pylist()
    return L.prune_collinear(fx.geno(spark, sf), np.array(w)).select("variant_id")


@query(
    "phenotype_by_allele",
    "geno_long pheno",
    """SELECT sample_idx, CAST(d AS DOUBLE) AS dosage, y FROM geno_long JOIN pheno USING (sample_idx)
       WHERE variant_id = 25 AND d IS NOT NULL""",
)
def phenotype_by_allele(spark, sf):
    return SA.phenotype_by_allele(fx.geno(spark, sf), fx.pheno(spark, sf), "snp25")


@query(
    "phenotype_by_allele_box",
    "geno_long pheno",
    """SELECT CAST(d AS DOUBLE) AS dosage, count(*) AS n, round(quantile_cont(y, 0.25), 6) AS q1,
         round(quantile_cont(y, 0.5), 6) AS median, round(quantile_cont(y, 0.75), 6) AS q3
       FROM geno_long JOIN pheno USING (sample_idx) WHERE variant_id = 25 AND d IS NOT NULL GROUP BY d""",
)
def phenotype_by_allele_box(spark, sf):
    box = P.boxplot_stats(phenotype_by_allele(spark, sf), "dosage", "y")
    return box.select("dosage", "n", *[rounded(c, 6).alias(c) for c in ("q1", "median", "q3")])


_RUN = """SELECT c_mktsegment AS trait, sum(CASE WHEN c_acctbal > {0} THEN 1e0 ELSE 0e0 END) / count(*) AS pve,
  count(*) AS n FROM customer GROUP BY c_mktsegment"""


@query(
    "compare_runs",
    sql=f"""SELECT trait, round(a.pve, 9) AS pve_0, round(b.pve, 9) AS pve_c, round(a.pve - b.pve, 9) AS pve_delta, CAST(b.n AS DOUBLE) AS beta_c
            FROM ({_RUN.format('0')}) a JOIN ({_RUN.format('5000')}) b USING (trait)""",
)
def compare_runs(spark, sf):
    def run(limit):
        return spark.sql(_RUN.format(limit).replace("FROM customer", "FROM {c}"), c=fx.table(spark, sf, "customer")).withColumn(
            "beta", F.array(F.lit(0.0), F.col("n").cast("double"))
        )

    out = RP.compare_runs(run("0"), run("5000"))
    return out.select("trait", *[rounded(c).alias(c) for c in ("pve_0", "pve_c", "pve_delta")], F.get("beta_c", F.lit(1)).alias("beta_c"))


@query(
    "append_summary",
    sql=f"""SELECT trait, round(a.pve, 9) AS pve_0, round(b.pve, 9) AS pve_c, round(a.pve - b.pve, 9) AS pve_delta, CAST(b.n AS DOUBLE) AS beta_c
            FROM ({_RUN.format('0')}) a JOIN ({_RUN.format('5000')}) b USING (trait)""",
)
def append_summary(spark, sf):
    """Summaries of runs without and with a covariate, stored one after the other and compared."""
    path = scratch_path(spark, "runs")
    for limit, name in (("0", None), ("5000", "covar")):
        rows = spark.sql(_RUN.format(limit).replace("FROM customer", "FROM {c}"), c=fx.table(spark, sf, "customer"))
        beta = F.array(F.lit(0.0), F.col("n").cast("double"))
        run_id = F.concat_ws("_", "trait", F.lit(name).cast("string")).alias("run_id")
        RP.append_summary(rows.select(run_id, "trait", F.lit(name).cast("string").alias("covariates"), "pve", beta.alias("beta")), path)
    out = RP.compare_stored_runs(RP.read_summaries(spark, path))
    return out.select("trait", *[rounded(c).alias(c) for c in ("pve_0", "pve_c", "pve_delta")], F.get("beta_c", F.lit(1)).alias("beta_c"))


@query(
    "run_ledger",
    sql="""SELECT run_id, pve, n FROM (
      SELECT 'c' || CAST(o_custkey AS VARCHAR) AS run_id, round(sum(o_totalprice) / 1e6, 6) AS pve, count(*) AS n, 1 + CAST(substr(o_orderpriority, 1, 1) AS INT) % 3 AS step,
        row_number() OVER (PARTITION BY o_custkey ORDER BY 1 + CAST(substr(o_orderpriority, 1, 1) AS INT) % 3 DESC) AS back
      FROM orders GROUP BY o_custkey, 1 + CAST(substr(o_orderpriority, 1, 1) AS INT) % 3) WHERE back = 1""",
)
def run_ledger(spark, sf):
    """Records of the same keys in three appends, one of them repeated, and one that was never committed."""
    path = scratch_path(spark, "ledger")
    orders = fx.table(spark, sf, "orders")
    step = 1 + F.substring("o_orderpriority", 1, 1).cast("int") % 3
    rows = orders.groupBy(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("run_id"), step.alias("step")).agg(
        rounded(F.sum("o_totalprice") / 1e6, 6).alias("pve"), F.count("*").alias("n")
    )
    for k in (1, 2, 2, 3):
        ledger.append(rows.filter(F.col("step") == k).drop("step"), path)
    ledger.write_rows(rows.withColumn("pve", F.lit(-1.0)).drop("step"), path, "lost")
    return ledger.newest(spark, path)


@query("pve_delta")
def pve_delta(spark, sf):
    kin = relatedness(fx.geno(spark, sf), N)
    pheno = fx.pheno(spark, sf)
    plain = L.null_model(pheno, kin, n_samples=N).summary(spark, trait="y")
    covaried = L.null_model(pheno, kin, covar=_covar(spark, sf), n_samples=N).summary(spark, trait="y")
    return RP.compare_runs(plain, covaried)


@query("association_run")
def run(spark, sf):
    return association_run(fx.geno(spark, sf), fx.pheno(spark, sf), N, "y").clean


@query("run_summary")
def run_summary(spark, sf):
    return association_run(fx.geno(spark, sf), fx.pheno(spark, sf), N, "y_snp0", covar=_covar(spark, sf)).summary


@query(
    "run_summary_counts",
    "geno_long markers",
    """SELECT 'y' AS run_id, 'y' AS trait, (SELECT count(*) FROM markers) AS n_markers, count(*) AS n_tested
       FROM markers WHERE 64 - called <= 0.05e0 * 64 AND least(mean / 2, 1 - mean / 2) >= 0.05e0 AND kinds > 1""",
)
def run_summary_counts(spark, sf):
    """What a run's summary says about its markers."""
    out = association_run(fx.geno(spark, sf), fx.pheno(spark, sf), N, "y").summary
    return out.filter("covariates IS NULL").select("run_id", "trait", "n_markers", "n_tested")


@query("association_hits")
def association_hits(spark, sf):
    out = association_run(fx.geno(spark, sf), fx.pheno(spark, sf), N, "y", test="all")
    return R.hits_to_bed(R.significant_hits(out.clean, 0.05))
