"""Sites, calls and the quality funnel."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import genotype as G
from ..operators import sites as S
from ..plans.funnel import quality_funnel
from . import query, rounded

SITE = ("variant_id", "chrom", "pos")
SITE_SQL = "variant_id, chrom, pos"


@query(
    "site_stats",
    "sites calls d stats",
    f"""SELECT {SITE_SQL}, ac, 2 * n_called AS an,
          CASE WHEN n_called > 0 THEN round(ac / (2e0 * n_called), 9) END AS af, n_called, n_miss FROM stats""",
)
def site_stats(spark, sf):
    return S.site_stats(fx.called_sites(spark, sf)).select(*SITE, "ac", "an", rounded("af").alias("af"), "n_called", "n_miss")


@query(
    "site_stats_long",
    "calls d",
    """SELECT variant_id, CAST(coalesce(sum(d), 0) AS BIGINT) AS ac, 2 * count(d) AS an,
         CASE WHEN count(d) > 0 THEN round(sum(d) / (2e0 * count(d)), 9) END AS af,
         count(d) AS n_called, 10 - count(d) AS n_miss FROM d GROUP BY variant_id""",
)
def site_stats_long(spark, sf):
    return S.site_stats_long(fx.calls(spark, sf), fx.N_CALL_SAMPLES).withColumn("af", rounded("af"))


@query(
    "subset_samples",
    "sites calls d",
    f"""SELECT {SITE_SQL}, CAST(coalesce(sum(d), 0) AS BIGINT) AS ac, 5 - count(d) AS n_miss
        FROM sites LEFT JOIN (SELECT * FROM d WHERE sample_idx IN (0, 2, 4, 6, 8)) k USING (variant_id)
        GROUP BY {SITE_SQL}""",
)
def subset_samples(spark, sf):
    kept = S.subset_samples(fx.called_sites(spark, sf), [0, 2, 4, 6, 8])
    return S.site_stats(kept).select(*SITE, "ac", "n_miss")


_KEPT = "SELECT CAST(s_suppkey % 10 AS INT) AS sample_idx FROM supplier GROUP BY s_suppkey % 10 HAVING avg(s_acctbal) > 4500e0"


@query(
    "subset_samples_long",
    "calls",
    f"SELECT variant_id, sample_idx, gt FROM calls WHERE sample_idx IN ({_KEPT})",
)
def subset_samples_long(spark, sf):
    kept = spark.sql(_KEPT.replace("FROM supplier", "FROM {supplier}"), supplier=fx.table(spark, sf, "supplier"))
    return S.subset_samples_long(fx.calls(spark, sf), kept).select("variant_id", "sample_idx", "gt")


@query(
    "keep_chromosomes",
    "sites",
    f"SELECT {SITE_SQL} FROM sites WHERE chrom IN ('Chr1', 'Chr2', 'Chr3', 'Chr4', 'Chr5')",
)
def keep_chromosomes(spark, sf):
    return S.keep_chromosomes(fx.sites(spark, sf), [f"Chr{i}" for i in range(1, 6)]).select(*SITE)


@query("min_ac", "sites calls d stats", f"SELECT {SITE_SQL} FROM stats WHERE ac >= 1")
def min_ac(spark, sf):
    return S.min_ac(fx.called_sites(spark, sf), 1).select(*SITE)


@query("max_alleles", "sites", f"SELECT {SITE_SQL} FROM sites WHERE 1 + len(string_split(alt_alleles, ',')) <= 2")
def max_alleles(spark, sf):
    return S.max_alleles(fx.sites(spark, sf), 2).select(*SITE)


@query(
    "remove_indels",
    "sites",
    f"""SELECT {SITE_SQL} FROM sites
        WHERE len(list_filter(string_split(alt_alleles, ','), lambda a: length(a) <> length(ref))) = 0""",
)
def remove_indels(spark, sf):
    return S.remove_indels(fx.sites(spark, sf)).select(*SITE)


@query(
    "mask_calls",
    "sites calls d md",
    """SELECT s.variant_id, CAST(i AS INT) AS sample_idx, md.gt
       FROM (SELECT variant_id, unnest(range(10)) AS i FROM sites) s
       LEFT JOIN md ON md.variant_id = s.variant_id AND md.sample_idx = s.i""",
)
def mask_calls(spark, sf):
    masked = S.mask_calls(fx.called_sites(spark, sf), *G.LENIENT)
    return S.unnest_calls(masked).select("variant_id", "sample_idx", F.col("call.gt").alias("gt"))


@query(
    "mask_calls_long",
    "calls",
    "SELECT variant_id, sample_idx, CASE WHEN dp >= 5 AND gq >= 30 THEN gt END AS gt, dp, gq FROM calls",
)
def mask_calls_long(spark, sf):
    return S.mask_calls_long(fx.calls(spark, sf), *G.STRINGENT).select("variant_id", "sample_idx", "gt", "dp", "gq")


@query("max_missing_count", "sites calls d stats", f"SELECT {SITE_SQL} FROM stats WHERE n_miss <= 2")
def max_missing_count(spark, sf):
    return S.max_missing_count(fx.called_sites(spark, sf), G.missing_count_limit(fx.N_CALL_SAMPLES, 0.2)).select(*SITE)


@query("missing_rate_filter", "sites calls d stats", f"SELECT {SITE_SQL} FROM stats WHERE n_miss <= 0.25e0 * 10")
def missing_rate_filter(spark, sf):
    return S.missing_rate_filter(fx.called_sites(spark, sf), 0.25).select(*SITE)


@query(
    "maf_filter",
    "sites calls d stats",
    f"""SELECT {SITE_SQL} FROM stats WHERE n_called > 0
        AND least(ac / (2e0 * n_called), 1e0 - ac / (2e0 * n_called)) >= 0.05e0""",
)
def maf_filter(spark, sf):
    return S.maf_filter(fx.called_sites(spark, sf), 0.05).select(*SITE)


_SINGLETONS = """SELECT chrom, pos, CASE WHEN ac = 1 THEN 'S' ELSE 'D' END AS kind,
  CASE code WHEN 0 THEN ref ELSE split_part(alt_alleles, ',', 1) END AS allele, sample_idx
FROM (SELECT variant_id, code, sum(a) AS ac, sum(CASE WHEN a > 0 THEN 1 ELSE 0 END) AS carriers,
        min(CASE WHEN a > 0 THEN sample_idx END) AS sample_idx
      FROM (SELECT variant_id, sample_idx, 0 AS code, 2 - d AS a FROM d WHERE d IS NOT NULL
            UNION ALL SELECT variant_id, sample_idx, 1, d FROM d WHERE d IS NOT NULL) u
      GROUP BY variant_id, code) c JOIN sites USING (variant_id)
WHERE ac = 1 OR (ac = 2 AND carriers = 1)"""


@query("singletons", "sites calls d", _SINGLETONS)
def singletons(spark, sf):
    return S.singletons(fx.called_sites(spark, sf))


@query(
    "singletons_odd_calls",
    "sites odd_calls",
    """, a AS (SELECT variant_id, sample_idx, CAST(unnest(string_split(replace(gt, '|', '/'), '/')) AS INT) AS code
           FROM odd_calls WHERE regexp_matches(gt, '^[0-9]+[/|][0-9]+$')),
    n AS (SELECT variant_id, code, count(*) AS ac, count(DISTINCT sample_idx) AS carriers, min(sample_idx) AS sample_idx FROM a GROUP BY ALL)
    SELECT chrom, pos, CASE WHEN ac = 1 THEN 'S' ELSE 'D' END AS kind,
      CASE WHEN code = 0 THEN ref ELSE split_part(alt_alleles, ',', code) END AS allele, sample_idx
    FROM n JOIN sites USING (variant_id)
    WHERE (ac = 1 OR (ac = 2 AND carriers = 1)) AND code <= len(string_split(alt_alleles, ','))""",
)
def singletons_odd_calls(spark, sf):
    """Third alleles, one-allele and half-missing texts."""
    return S.singletons(fx.odd_sites(spark, sf))


@query(
    "gt_to_dosage_haploid",
    "sites odd_calls",
    """, p AS (SELECT variant_id, sample_idx, gt, string_split(replace(gt, '|', '/'), '/') AS a FROM odd_calls)
    SELECT s.variant_id, CAST(i AS INT) AS sample_idx,
      CASE WHEN gt IS NULL OR list_contains(a, '.') THEN NULL WHEN len(a) = 1 THEN CASE WHEN a[1] = '0' THEN 0e0 ELSE 2e0 END
           ELSE CASE WHEN a[1] = '0' THEN 0e0 ELSE 1e0 END + CASE WHEN a[2] = '0' THEN 0e0 ELSE 1e0 END END AS d
    FROM (SELECT variant_id, unnest(range(10)) AS i FROM sites) s LEFT JOIN p ON p.variant_id = s.variant_id AND p.sample_idx = s.i""",
)
def gt_to_dosage_haploid(spark, sf):
    dosed = S.gt_to_dosage(fx.odd_sites(spark, sf), "double")
    return dosed.select("variant_id", F.posexplode("dosage").alias("sample_idx", "d"))


_EXCLUDED = f"SELECT {SITE_SQL} FROM sites WHERE (chrom, pos) NOT IN (SELECT (chrom, pos) FROM ({_SINGLETONS}))"


@query("exclude_positions", "sites calls d", _EXCLUDED)
def exclude_positions(spark, sf):
    called = fx.called_sites(spark, sf)
    return S.exclude_positions(called, S.singletons(called)).select(*SITE)


@query("drop_singletons", "sites calls d", _EXCLUDED)
def drop_singletons(spark, sf):
    return S.drop_singletons(fx.called_sites(spark, sf)).select(*SITE)


@query("strip_chrom_prefix", "sites", "SELECT variant_id, regexp_replace(chrom, '^Chr', '') AS chrom, pos FROM sites")
def strip_chrom_prefix(spark, sf):
    return S.strip_chrom_prefix(fx.sites(spark, sf)).select(*SITE)


@query(
    "default_variant_id",
    "sites",
    "SELECT variant_id, CASE WHEN id = '.' THEN chrom || ':' || CAST(pos AS VARCHAR) ELSE id END AS id FROM sites",
)
def default_variant_id(spark, sf):
    return S.default_variant_id(fx.sites(spark, sf)).select("variant_id", "id")


@query(
    "chrom_code",
    "sites",
    """SELECT variant_id, coalesce(TRY_CAST(c AS INT), 0) AS chrom_code FROM
       (SELECT variant_id, CASE WHEN variant_id % 2 = 0 THEN chrom ELSE regexp_replace(chrom, '^Chr', '') END AS c FROM sites)""",
)
def chrom_code(spark, sf):
    mixed = fx.sites(spark, sf).withColumn(
        "chrom",
        F.when(F.col("variant_id") % 2 == 0, F.col("chrom")).otherwise(F.regexp_replace("chrom", "^Chr", "")),
    )
    return S.chrom_code(mixed).select("variant_id", "chrom_code")


@query(
    "gt_to_dosage",
    "sites calls d",
    """SELECT s.variant_id, CAST(i AS INT) AS sample_idx, CAST(d.d AS DOUBLE) AS d
       FROM (SELECT variant_id, unnest(range(10)) AS i FROM sites) s
       LEFT JOIN d ON d.variant_id = s.variant_id AND d.sample_idx = s.i""",
)
def gt_to_dosage(spark, sf):
    dosed = S.gt_to_dosage(fx.called_sites(spark, sf))
    return dosed.select("variant_id", F.posexplode("dosage").alias("sample_idx", "d"))


@query(
    "minor_allele_recode",
    "sites calls d stats",
    """SELECT variant_id, CASE WHEN f THEN ref ELSE a END AS a1, CASE WHEN f THEN a ELSE ref END AS a0, f AS flipped,
         CASE WHEN f THEN 2 * n_called - ac ELSE ac END AS ac
       FROM (SELECT variant_id, ref, split_part(alt_alleles, ',', 1) AS a, ac, n_called,
               n_called > 0 AND ac > n_called AS f FROM stats)""",
)
def minor_allele_recode(spark, sf):
    dosed = S.gt_to_dosage(fx.called_sites(spark, sf)).select(
        "variant_id", F.get("alts", F.lit(0)).alias("a1"), F.col("ref").alias("a0"), "dosage"
    )
    return S.site_stats(S.minor_allele_recode(dosed)).select("variant_id", "a1", "a0", "flipped", "ac")


FUNNEL_SQL = """SELECT s.variant_id, regexp_replace(s.chrom, '^Chr', '') AS chrom, s.pos,
         CASE WHEN s.id = '.' THEN regexp_replace(s.chrom, '^Chr', '') || ':' || CAST(s.pos AS VARCHAR) ELSE s.id END AS id
       FROM stats s LEFT JOIN (
         SELECT variant_id, count(d) AS called, sum(d) AS alt, sum(2 - d) AS ref,
           sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS alt_carriers, sum(CASE WHEN d < 2 THEN 1 ELSE 0 END) AS ref_carriers
         FROM md GROUP BY variant_id) m ON m.variant_id = s.variant_id
       WHERE s.chrom LIKE 'Chr_' AND s.chrom NOT IN ('ChrM', 'ChrC')
         AND s.alt_alleles NOT LIKE '%,%' AND length(s.alt_alleles) = length(s.ref) AND s.ac >= 1
         AND 10 - coalesce(m.called, 0) <= 5
         AND NOT (m.alt = 1 OR (m.alt = 2 AND m.alt_carriers = 1) OR m.ref = 1 OR (m.ref = 2 AND m.ref_carriers = 1))"""


@query("quality_funnel", "sites calls d md stats", FUNNEL_SQL)
def funnel(spark, sf):
    return quality_funnel(
        fx.called_sites(spark, sf), chromosomes=[f"Chr{i}" for i in range(1, 6)], max_missing=5
    ).select("variant_id", "chrom", "pos", "id")
