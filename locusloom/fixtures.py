"""Study-shaped tables derived from the bundled test tables.

Each text runs unchanged on Spark and on the SQL engine used for checking, except the
two that unpack the embedding array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.sites import nest_calls

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "embeddings")
N_CALL_SAMPLES = 10
N_GENO_SAMPLES = 64

SITES = """
SELECT p_partkey AS variant_id,
  CASE p_size % 7 WHEN 5 THEN 'ChrM' WHEN 6 THEN 'ChrC'
       ELSE 'Chr' || CAST(p_size % 7 + 1 AS STRING) END AS chrom,
  p_partkey * 100 + 1 AS pos,
  CASE WHEN p_partkey % 3 = 0 THEN 'snp' || CAST(p_partkey AS STRING) ELSE '.' END AS id,
  substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) AS ref,
  CASE WHEN p_size % 10 = 0 THEN substr('CGTA', CAST(p_partkey % 4 + 1 AS INT), 1) || ',' || substr('GTAC', CAST(p_partkey % 4 + 1 AS INT), 1)
       WHEN p_size % 10 = 1 THEN substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) || 'T'
       ELSE substr('CGTA', CAST(p_partkey % 4 + 1 AS INT), 1) END AS alt_alleles
FROM part
"""

CALLS = """
SELECT l_partkey AS variant_id, CAST(l_suppkey % 10 AS INT) AS sample_idx,
  CASE MAX(CAST(l_quantity AS INT)) % 7 WHEN 4 THEN '0/1' WHEN 5 THEN '1/1' WHEN 6 THEN './.' ELSE '0/0' END AS gt,
  MAX(CAST(round(l_tax * 100) AS INT)) AS dp, 4 * MAX(CAST(round(l_discount * 100) AS INT)) AS gq
FROM lineitem GROUP BY l_partkey, CAST(l_suppkey % 10 AS INT)
"""

#: Third alleles, one-allele and half-missing calls.
ODD_CALLS = """
SELECT l_partkey AS variant_id, CAST(l_suppkey % 10 AS INT) AS sample_idx,
  CASE MAX(CAST(l_quantity AS INT)) % 12 WHEN 3 THEN '0/2' WHEN 4 THEN '2|2' WHEN 5 THEN '1/2' WHEN 6 THEN '.' WHEN 7 THEN '1'
    WHEN 8 THEN './1' WHEN 9 THEN '0|1' WHEN 10 THEN '0' WHEN 11 THEN '1/1' ELSE '0/0' END AS gt
FROM lineitem GROUP BY l_partkey, CAST(l_suppkey % 10 AS INT)
"""

#: Names of the samples of ``calls``: of the suppliers that make up one sample the first.
CALL_SAMPLES = "SELECT CAST(s_suppkey % 10 AS INT) AS sample_idx, min(s_name) AS sample_id FROM supplier GROUP BY CAST(s_suppkey % 10 AS INT)"

ASSOC = """
SELECT CAST(CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE o_orderkey % 5 + 1 END AS STRING) AS chr,
  CASE o_orderkey % 150 WHEN 0 THEN 'ChrM' WHEN 50 THEN 'Chr4' WHEN 100 THEN 'scaffold_12'
       ELSE CAST(o_orderkey % 5 + 1 AS STRING) END || ':' || CAST(o_orderkey * 10 AS STRING) AS rs,
  o_orderkey * 10 AS ps, CAST(o_orderkey % 4 AS INT) AS n_miss, 'A' AS allele1, 'G' AS allele0,
  CAST(o_orderkey % 50 AS DOUBLE) / 100e0 AS af, CAST(o_orderkey % 97 AS DOUBLE) AS l_mle, x * x * x AS p_lrt
FROM (SELECT o_orderkey, CAST((o_orderkey * 7919) % 1000003 + 1 AS DOUBLE) / 1000004e0 AS x FROM orders) t
"""

NUCLEI = """
SELECT 'Acc' || CAST(l_suppkey % 20 AS STRING) || '_2017-' || CAST(l_linenumber AS STRING) || '.tif' AS label,
  6000 + l_suppkey % 20 AS tg_ecotypeid, CASE l_linestatus WHEN 'O' THEN 'compact' ELSE 'loose' END AS type,
  l_quantity AS nuc_area, CASE WHEN l_partkey % 400 = 0 AND l_suppkey % 20 = 3 THEN NULL ELSE l_extendedprice END AS nuc_price,
  NULLIF(l_discount, 0) AS cc_area
FROM lineitem
"""

_DOSAGE = """CASE WHEN (vec_id * 31 + i * 17) % 97 = 0 THEN NULL
       WHEN CAST(e AS DOUBLE) < -0.06e0 THEN 0 WHEN CAST(e AS DOUBLE) < 0.06e0 THEN 1 ELSE 2 END"""

GENO_LONG_SPARK = f"""
SELECT vec_id AS variant_id, i AS sample_idx, {_DOSAGE} AS d
FROM embeddings LATERAL VIEW posexplode(embedding) t AS i, e
"""

GENO_LONG_CHECK = f"""
SELECT vec_id AS variant_id, CAST(i AS INT) AS sample_idx, {_DOSAGE} AS d
FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) t
"""

# Every marker contributes; a few contribute strongly.
PHENO = """
SELECT sample_idx, CAST(SUM(d * CASE WHEN variant_id % 25 = 0 THEN 20 ELSE variant_id % 5 - 2 END) AS DOUBLE) / 20e0
  + CAST((sample_idx * 37) % 11 AS DOUBLE) AS y
FROM geno_long GROUP BY sample_idx
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, sf_dir: str, text: str, **views: DataFrame) -> DataFrame:
    frames = dict(views)
    for name in TABLES:
        if f"FROM {name}" in text:
            frames[name] = table(spark, sf_dir, name)
    for name in frames:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(text, **frames)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site columns with ``alts`` as an array, without calls."""
    df = _sql(spark, sf_dir, SITES)
    return df.select("variant_id", "chrom", "pos", "id", "ref", F.split("alt_alleles", ",").alias("alts"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, CALLS)


def call_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, CALL_SAMPLES)


def called_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites with the calls of ten samples in one array; a site without calls keeps ten nulls."""
    nested = nest_calls(calls(spark, sf_dir), N_CALL_SAMPLES, unique=True)
    none = F.array_repeat(F.lit(None).cast("struct<gt:string,dp:int,gq:int>"), N_CALL_SAMPLES)
    return (
        sites(spark, sf_dir)
        .join(nested, "variant_id", "left")
        .withColumn("calls", F.coalesce("calls", none))
    )


def odd_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sites with ``ODD_CALLS``; calls hold a genotype only."""
    long = _sql(spark, sf_dir, ODD_CALLS).withColumn("calls", F.struct("gt")).select("variant_id", "sample_idx", "calls")
    none = F.array_repeat(F.lit(None).cast("struct<gt:string>"), N_CALL_SAMPLES)
    nested = nest_calls(long, N_CALL_SAMPLES, fields=("calls",), unique=True)
    return sites(spark, sf_dir).join(nested, "variant_id", "left").withColumn("calls", F.coalesce("calls", none))


def assoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, ASSOC)


def nuclei(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, NUCLEI)


def geno_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, GENO_LONG_SPARK)


def geno(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marker rows with 64 dosages, straight from the stored array: no explode, no shuffle."""

    def dosage(e, i):
        e = e.cast("double")
        gap = (F.col("vec_id") * 31 + i * 17) % 97 == 0
        return F.when(gap, F.lit(None).cast("double")).otherwise(
            F.when(e < -0.06, 0.0).when(e < 0.06, 1.0).otherwise(2.0)
        )

    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("variant_id"),
        (F.col("vec_id") % 5 + 1).cast("string").alias("chrom"),
        F.concat(F.lit("snp"), F.col("vec_id").cast("string")).alias("rs"),
        (F.col("vec_id") * 1000 + 1).alias("pos"),
        F.lit("A").alias("a1"),
        F.lit("G").alias("a0"),
        F.transform("embedding", dosage).alias("dosage"),
    )


def pheno(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, PHENO, geno_long=geno_long(spark, sf_dir))
