"""Cleaning, hits and the tables behind the plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import naming
from ..operators import results as R
from . import query, rounded


def clean(spark, sf):
    return R.clean_assoc(fx.assoc(spark, sf))


@query(
    "recover_chromosome",
    "assoc",
    """SELECT rs, CASE WHEN TRY_CAST(chr AS BIGINT) = 0
         THEN regexp_replace(split_part(rs, ':', 1), '[^0-9]', '', 'g') ELSE chr END AS chrom_text FROM assoc""",
)
def recover_chromosome(spark, sf):
    return R.recover_chromosome(fx.assoc(spark, sf)).select("rs", "chrom_text")


@query(
    "drop_non_integer_chromosomes",
    "assoc",
    "SELECT rs, split_part(rs, ':', 1) AS chrom_text FROM assoc WHERE TRY_CAST(split_part(rs, ':', 1) AS BIGINT) IS NOT NULL",
)
def drop_non_integer_chromosomes(spark, sf):
    named = fx.assoc(spark, sf).select("rs", F.get(F.split("rs", ":"), F.lit(0)).alias("chrom_text"))
    return R.drop_non_integer_chromosomes(named)


@query(
    "project_clean",
    "assoc",
    """SELECT rs AS "SNP", TRY_CAST(chr AS BIGINT) AS "CHR", ps AS "BP", p_lrt AS "P", l_mle AS zscore FROM assoc""",
)
def project_clean(spark, sf):
    return R.project_clean(fx.assoc(spark, sf).withColumn("chrom_text", F.col("chr")))


@query("clean_assoc", "assoc clean", "SELECT * FROM clean")
def clean_assoc(spark, sf):
    return clean(spark, sf)


@query(
    "rejected_assoc",
    "assoc",
    "SELECT rs, chr, ps FROM assoc WHERE chr = '0' AND regexp_replace(split_part(rs, ':', 1), '[^0-9]', '', 'g') = ''",
)
def rejected_assoc(spark, sf):
    return R.rejected_assoc(fx.assoc(spark, sf)).select("rs", "chr", "ps")


@query(
    "bonferroni_threshold",
    "assoc clean",
    "SELECT count(*) AS n_tests, round(5e-2 / count(*), 15) AS threshold FROM clean",
)
def bonferroni_threshold(spark, sf):
    return R.bonferroni_threshold(clean(spark, sf)).withColumn("threshold", rounded("threshold", 15))


@query(
    "significant_hits",
    "assoc clean",
    """SELECT * FROM clean WHERE "P" < (SELECT 5e-2 / count(*) FROM clean)""",
)
def significant_hits(spark, sf):
    return R.significant_hits(clean(spark, sf), "bonferroni")


@query("significant_hits_fixed", "assoc clean", """SELECT * FROM clean WHERE "P" < 5e-8""")
def significant_hits_fixed(spark, sf):
    return R.significant_hits(clean(spark, sf), "5E-8")


@query(
    "highlight",
    "assoc clean",
    """SELECT "SNP", "SNP" IN ('4:30', '1:150', 'none') AS highlight FROM clean""",
)
def highlight(spark, sf):
    return R.highlight(clean(spark, sf), ["4:30", "1:150", "none"]).select("SNP", "highlight")


@query(
    "highlight_table",
    "assoc clean",
    """SELECT "SNP", "SNP" IN (SELECT CAST(c_nationkey % 5 + 1 AS VARCHAR) || ':' || CAST(c_custkey * 10 AS VARCHAR)
         FROM customer) AS highlight FROM clean""",
)
def highlight_table(spark, sf):
    listed = fx.table(spark, sf, "customer").select(
        F.concat_ws(":", (F.col("c_nationkey") % 5 + 1).cast("string"), (F.col("c_custkey") * 10).cast("string")).alias("SNP")
    )
    return R.highlight(clean(spark, sf), listed).select("SNP", "highlight")


@query(
    "hits_to_bed",
    "assoc clean",
    """SELECT 'chr' || CAST("CHR" AS VARCHAR) AS chrom, "BP" AS start, "BP" AS "end",
         regexp_replace("SNP", ':', '_') AS name
       FROM clean WHERE "P" < (SELECT 5e-2 / count(*) FROM clean)""",
)
def hits_to_bed(spark, sf):
    return R.hits_to_bed(R.significant_hits(clean(spark, sf), "bonferroni"))


@query(
    "neg_log",
    "assoc clean",
    """SELECT "SNP", round(-log10("P"), 9) AS neg_log10_p, round(-ln("P"), 9) AS neg_ln_p FROM clean""",
)
def neg_log(spark, sf):
    return R.neg_log_p(clean(spark, sf)).select("SNP", rounded("neg_log10_p").alias("neg_log10_p"), rounded("neg_ln_p").alias("neg_ln_p"))


@query(
    "orient_effect",
    "assoc",
    "SELECT rs, CASE WHEN 2 * af > 0.5e0 THEN -(l_mle - 48) ELSE l_mle - 48 END AS beta FROM assoc",
)
def orient_effect(spark, sf):
    slopes = fx.assoc(spark, sf).select("rs", (F.col("l_mle") - 48).alias("beta"), (2 * F.col("af")).alias("alt_af"))
    return R.orient_effect(slopes).select("rs", "beta")


@query("snps_per_chromosome", "assoc clean", """SELECT "CHR", count(*) AS n_snps FROM clean GROUP BY "CHR" """)
def snps_per_chromosome(spark, sf):
    return R.snps_per_chromosome(clean(spark, sf))


@query("chr_scatter", "assoc clean", """SELECT "CHR", round(-ln("P"), 9) AS neg_ln_p FROM clean""")
def chr_scatter(spark, sf):
    return R.chr_scatter(clean(spark, sf)).select("CHR", rounded("neg_ln_p").alias("neg_ln_p"))


@query(
    "histogram",
    "assoc clean",
    """, v AS (SELECT -ln("P") AS v FROM clean WHERE "P" > 0),
    r AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / ceil(log2(count(*)) + 1) AS cell FROM v),
    b AS (SELECT *, pow(10e0, floor(log10(cell))) AS base FROM r),
    u2 AS (SELECT *, CASE WHEN 2 * base - cell < 1.5e0 * (cell - base) THEN 2 * base ELSE base END AS w2 FROM b),
    u5 AS (SELECT *, CASE WHEN 5 * base - cell < 2.75e0 * (cell - w2) THEN 5 * base ELSE w2 END AS w5 FROM u2),
    u AS (SELECT *, CASE WHEN 10 * base - cell < 1.5e0 * (cell - w5) THEN 10 * base ELSE w5 END AS w FROM u5),
    e AS (SELECT w, floor(lo / w + 1e-10) * w AS first, ceil(hi / w - 1e-10) - floor(lo / w + 1e-10) AS n_bins FROM u)
    SELECT bin, round(first + (bin - 1) * w, 9) AS lower, round(first + bin * w, 9) AS upper, count(*) AS n
    FROM (SELECT CAST(greatest(1, least(n_bins, ceil((v - first) / w - 1e-7))) AS INT) AS bin, first, w FROM v, e)
    GROUP BY bin, first, w""",
)
def histogram(spark, sf):
    return R.histogram(clean(spark, sf)).select("bin", rounded("lower").alias("lower"), rounded("upper").alias("upper"), "n")


@query(
    "qq_points",
    "assoc clean",
    """SELECT rank, "P", round(-log10("P"), 9) AS observed, round(-log10((rank - a) / (n + 1 - 2 * a)), 9) AS expected
       FROM (SELECT "P", row_number() OVER (ORDER BY "P") AS rank, count(*) OVER () AS n,
               CASE WHEN count(*) OVER () <= 10 THEN 0.375e0 ELSE 0.5e0 END AS a
             FROM clean WHERE "P" > 0 AND "P" < 1)""",
)
def qq_points(spark, sf):
    return R.qq_points(clean(spark, sf)).select("rank", "P", rounded("observed").alias("observed"), rounded("expected").alias("expected"))


_OFFSETS = """, c AS (SELECT "CHR", min("BP") AS min_bp, max("BP") AS max_bp, count(*) AS n_snps FROM clean GROUP BY "CHR"),
    o AS (SELECT *, CAST(coalesce(sum(max_bp) OVER (ORDER BY "CHR" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
            AS "offset" FROM c)"""


@query(
    "manhattan_layout",
    "assoc clean",
    _OFFSETS
    + """ SELECT "SNP", "CHR", "BP", "BP" + "offset" AS x, round(-log10("P"), 9) AS y,
        round(-log10((SELECT 5e-2 / count(*) FROM clean)), 9) AS threshold_y,
        "P" < (SELECT 5e-2 / count(*) FROM clean) AS above, "SNP" IN ('4:30', '1:150') AS highlight
      FROM clean JOIN o USING ("CHR")""",
)
def manhattan_layout(spark, sf):
    return R.manhattan_layout(clean(spark, sf), "bonferroni", ["4:30", "1:150"]).select(
        "SNP", "CHR", "BP", "x", rounded("y").alias("y"), rounded("threshold_y").alias("threshold_y"), "above", "highlight"
    )


@query(
    "manhattan_ticks",
    "assoc clean",
    _OFFSETS + """ SELECT *, "offset" + (min_bp + max_bp) / 2e0 AS tick FROM o""",
)
def manhattan_ticks(spark, sf):
    return R.manhattan_ticks(clean(spark, sf))


@query(
    "run_id",
    sql="""SELECT c_custkey, concat_ws('_', c_mktsegment, CASE WHEN c_nationkey % 2 = 0 THEN c_name END) AS run_id FROM customer""",
)
def run_id(spark, sf):
    return fx.table(spark, sf, "customer").select(
        "c_custkey",
        naming.run_id(F.col("c_mktsegment"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name"))).alias("run_id"),
    )
