"""Measurements, samples and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import phenotype as P
from ..operators import samples as SA
from ..plans.phenotyping import accession_phenotypes, measurement_rows
from . import query, rounded


def rows(spark, sf):
    return P.parse_accession(fx.nuclei(spark, sf), "name")


@query(
    "union_measurements",
    "nuclei",
    "SELECT label, tg_ecotypeid, type, nuc_area, nuc_price, cc_area FROM nuclei",
)
def union_measurements(spark, sf):
    n = fx.nuclei(spark, sf)
    loose = n.filter("type = 'loose'").select("cc_area", "type", "label", "tg_ecotypeid", "nuc_price", "nuc_area")
    return P.union_measurements([n.filter("type = 'compact'"), loose])


@query(
    "blank_to_null",
    sql="SELECT c_custkey, NULLIF(CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE c_mktsegment END, '') AS segment, c_name FROM customer",
)
def blank_to_null(spark, sf):
    segment = F.when(F.col("c_nationkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment")
    return P.blank_to_null(fx.table(spark, sf, "customer").select("c_custkey", segment, "c_name"))


@query("parse_accession_name", "nuclei", "SELECT split_part(label, '_', 1) AS accession, label FROM nuclei")
def parse_accession_name(spark, sf):
    return P.parse_accession(fx.nuclei(spark, sf), "name").select("accession", "label")


@query(
    "parse_accession_default",
    "nuclei",
    "SELECT regexp_replace(label, '[-_][0-9]+.tif$', '') AS accession, label FROM nuclei",
)
def parse_accession_default(spark, sf):
    return P.parse_accession(fx.nuclei(spark, sf)).select("accession", "label")


@query("reorder_columns", "nuclei acc", "SELECT accession, tg_ecotypeid, label, type, nuc_area FROM acc")
def reorder_columns(spark, sf):
    plain = rows(spark, sf).select("label", "type", "nuc_area", "tg_ecotypeid", "accession")
    return P.reorder_columns(plain, ["accession", "tg_ecotypeid"])


@query("levels", "nuclei acc", "SELECT DISTINCT accession FROM acc ORDER BY accession")
def levels(spark, sf):
    return P.levels(rows(spark, sf), "accession")


_STRICT = "CASE WHEN count({0}) = count(*) THEN round(avg({0}), 6) END AS {0}"


@query(
    "mean_strict",
    "nuclei acc",
    f"SELECT accession, {_STRICT.format('nuc_area')}, {_STRICT.format('nuc_price')} FROM acc GROUP BY accession",
)
def mean_strict(spark, sf):
    means = P.mean_strict(rows(spark, sf), "accession", ["nuc_area", "nuc_price"])
    return means.select("accession", rounded("nuc_area", 6).alias("nuc_area"), rounded("nuc_price", 6).alias("nuc_price"))


@query("mean_skip_na", "nuclei acc", "SELECT accession, round(avg(cc_area), 9) AS cc_area FROM acc GROUP BY accession")
def mean_skip_na(spark, sf):
    return P.mean_skip_na(rows(spark, sf), "accession", ["cc_area"]).select("accession", rounded("cc_area").alias("cc_area"))


@query(
    "contingency",
    "nuclei acc",
    """SELECT accession, count(*) FILTER (type = 'compact') AS compact, count(*) FILTER (type = 'loose') AS loose
       FROM acc GROUP BY accession""",
)
def contingency(spark, sf):
    return P.contingency(rows(spark, sf), "accession", "type")


@query("contingency_long", "nuclei acc", "SELECT accession, type, count(*) AS n FROM acc WHERE type IS NOT NULL GROUP BY accession, type")
def contingency_long(spark, sf):
    return P.contingency_long(rows(spark, sf), "accession", "type")


_HX = "round(count(*) FILTER (type = 'compact') / CAST(count(type) AS DOUBLE), 9) AS hx"


@query("hx_by_accession", "nuclei acc", f"SELECT accession, {_HX} FROM acc GROUP BY accession")
def hx_by_accession(spark, sf):
    return P.hx_by_accession(rows(spark, sf)).select("accession", rounded("hx").alias("hx"))


@query("hx_overall", "nuclei acc", f"SELECT {_HX} FROM acc")
def hx_overall(spark, sf):
    return P.hx_overall(rows(spark, sf)).select(rounded("hx").alias("hx"))


_SUMMARY = f"""SELECT accession, {_STRICT.format('nuc_area')}, {_STRICT.format('nuc_price')},
  round(avg(cc_area), 9) AS cc_area, {_HX}"""


def _rounded_summary(df, *keys):
    return df.select(
        *keys, rounded("nuc_area", 6).alias("nuc_area"), rounded("nuc_price", 6).alias("nuc_price"),
        rounded("cc_area").alias("cc_area"), rounded("hx").alias("hx"),
    )


@query("merge_by_accession", "nuclei acc", f"{_SUMMARY} FROM acc GROUP BY accession")
def merge_by_accession(spark, sf):
    r = rows(spark, sf)
    merged = P.merge_by_accession(
        [P.mean_strict(r, "accession", ["nuc_area", "nuc_price"]), P.mean_skip_na(r, "accession", ["cc_area"]), P.hx_by_accession(r)]
    )
    return _rounded_summary(merged, "accession")


@query(
    "attach_tag",
    "nuclei acc",
    f"SELECT accession, tg_ecotypeid, {_HX} FROM acc GROUP BY accession, tg_ecotypeid",
)
def attach_tag(spark, sf):
    r = rows(spark, sf)
    return P.attach_tag(P.hx_by_accession(r), r, "tg_ecotypeid").withColumn("hx", rounded("hx"))


@query("summarize_accessions", "nuclei acc", _SUMMARY + ", max(tg_ecotypeid) AS tg_ecotypeid FROM acc GROUP BY accession")
def summarize_accessions(spark, sf):
    s = P.summarize_accessions(rows(spark, sf), ["nuc_area", "nuc_price"], ["cc_area"], "tg_ecotypeid")
    return _rounded_summary(s, "accession", "tg_ecotypeid")


_BOX = """, q AS (SELECT {g} AS g, count({v}) AS n, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median,
             quantile_cont({v}, 0.75) AS q3 FROM {t} WHERE {v} IS NOT NULL GROUP BY {g}),
    f AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM q)"""

_BOX_SELECT = """ SELECT {g}, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min({v}) FILTER ({v} BETWEEN lo AND hi) AS whisker_low, max({v}) FILTER ({v} BETWEEN lo AND hi) AS whisker_high,
       count(*) FILTER ({v} NOT BETWEEN lo AND hi) AS n_outliers
     FROM {t} JOIN f ON f.g = {t}.{g} WHERE {v} IS NOT NULL GROUP BY {g}, n, q1, median, q3"""


def _rounded_box(df):
    for c in ("q1", "median", "q3"):
        df = df.withColumn(c, rounded(c, 6))
    return df


@query(
    "boxplot_stats",
    "nuclei acc",
    (_BOX + _BOX_SELECT).format(g="accession", v="nuc_price", t="acc"),
)
def boxplot_stats(spark, sf):
    return _rounded_box(P.boxplot_stats(rows(spark, sf), "accession", "nuc_price"))


@query(
    "boxplot_outliers",
    "assoc clean",
    _BOX.format(g='"CHR"', v="nl", t='(SELECT "CHR", -ln("P") AS nl FROM clean)')
    + """ SELECT "SNP", "CHR", "P" FROM clean JOIN f ON f.g = "CHR" WHERE -ln("P") NOT BETWEEN lo AND hi""",
)
def boxplot_outliers(spark, sf):
    from ..operators.results import clean_assoc

    logs = clean_assoc(fx.assoc(spark, sf)).select("SNP", "CHR", "P", (-F.ln("P")).alias("nl"))
    return P.boxplot_outliers(logs, "CHR", "nl").select("SNP", "CHR", "P")


@query(
    "accession_phenotypes",
    "nuclei",
    f""", tagged AS (SELECT *, regexp_replace(label, '[-_][0-9]+.tif$', '') AS accession FROM nuclei),
    s AS ({_SUMMARY} FROM tagged GROUP BY accession)
    SELECT CAST(p_size AS INT) AS sample_idx, 'Acc' || CAST(p_size AS VARCHAR) || '_2017' AS sample_id, nuc_area, cc_area, hx
    FROM (SELECT DISTINCT p_size FROM part) LEFT JOIN s ON s.accession = 'Acc' || CAST(p_size AS VARCHAR) || '_2017'""",
)
def phenotypes_in_order(spark, sf):
    samples = (
        fx.table(spark, sf, "part").select(F.col("p_size").cast("int").alias("sample_idx")).distinct()
        .withColumn("sample_id", F.concat(F.lit("Acc"), F.col("sample_idx").cast("string"), F.lit("_2017")))
    )
    r = measurement_rows([fx.nuclei(spark, sf)])
    out = accession_phenotypes(r, samples, ["nuc_area"], ["cc_area"])
    return out.select(
        "sample_idx", "sample_id", rounded("nuc_area", 6).alias("nuc_area"), rounded("cc_area").alias("cc_area"), rounded("hx").alias("hx")
    )


# ---------------------------------------------------------------- samples


def _samples(spark, sf):
    return fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("sample_idx"), F.col("s_name").alias("sample_id")
    )


_HEIGHT = """SELECT s_name AS sample_id, sum(CASE WHEN s_nationkey <> 7 THEN l_quantity END) AS height,
               min(CASE WHEN s_nationkey <> 7 THEN l_quantity END) AS width
             FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_name"""


def _heights(spark, sf):
    return spark.sql(
        _HEIGHT.replace("FROM lineitem JOIN supplier", "FROM {lineitem} JOIN {supplier}"),
        lineitem=fx.table(spark, sf, "lineitem"), supplier=fx.table(spark, sf, "supplier"),
    )


@query("sample_order", sql="SELECT CAST(s_suppkey AS INT) AS sample_idx, s_name AS sample_id FROM supplier ORDER BY 1")
def sample_order(spark, sf):
    return SA.sample_order(_samples(spark, sf))


_ALIGNED = f"""SELECT CAST(s_suppkey AS INT) AS sample_idx, s_name AS sample_id, height, width
               FROM supplier LEFT JOIN ({_HEIGHT}) h ON h.sample_id = s_name"""


@query("align_phenotypes", sql=_ALIGNED)
def align_phenotypes(spark, sf):
    return SA.align_phenotypes(_samples(spark, sf), _heights(spark, sf))


@query("select_traits", sql=f"SELECT sample_idx, sample_id, width FROM ({_ALIGNED})")
def select_traits(spark, sf):
    return SA.select_traits(align_phenotypes(spark, sf), [2])


@query(
    "paste_phenotype",
    sql=f"""SELECT sample_idx, sample_id AS family, sample_id, 0 AS father, 0 AS mother, 0 AS sex, height AS phenotype FROM ({_ALIGNED})""",
)
def paste_phenotype(spark, sf):
    zero = F.lit(0)
    fam = _samples(spark, sf).select(
        "sample_idx", F.col("sample_id").alias("family"), "sample_id", zero.alias("father"), zero.alias("mother"),
        zero.alias("sex"), F.lit(SA.MISSING_PHENOTYPE).alias("phenotype"),
    )
    return SA.paste_phenotype(fam, align_phenotypes(spark, sf), "height")


@query(
    "paste_phenotype_absent",
    sql="""SELECT CAST(c_custkey AS INT) AS sample_idx, c_name AS sample_id, y AS phenotype
           FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS y FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def paste_phenotype_absent(spark, sf):
    """Customers without orders have no phenotype row at all, and keep their line."""
    fam = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("sample_idx"), F.col("c_name").alias("sample_id"), F.lit(SA.MISSING_PHENOTYPE).alias("phenotype")
    )
    pheno = fx.table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("int").alias("sample_idx")).agg(F.count("*").alias("y"))
    return SA.paste_phenotype(fam, pheno, "y")


@query(
    "check_counts",
    sql="""SELECT (SELECT count(*) FROM customer) AS n_samples, (SELECT count(DISTINCT o_custkey) FROM orders) AS n_phenotypes,
             (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS only_samples,
             (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS only_phenotypes,
             (SELECT count(*) FROM customer) = (SELECT count(DISTINCT o_custkey) FROM orders) AS same_count,
             (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) = 0
               AND (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) = 0 AS ok""",
)
def check_counts(spark, sf):
    samples = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("sample_id"))
    pheno = fx.table(spark, sf, "orders").select(F.col("o_custkey").alias("sample_id")).distinct()
    return SA.check_counts(samples, pheno, "sample_id")


@query(
    "check_covariates",
    sql="""SELECT (SELECT count(*) FROM customer) AS n_covariate_rows, (SELECT count(*) FROM customer) AS n_phenotypes,
             (SELECT count(*) FROM customer WHERE c_nationkey = 3) = 0 AS intercept_ok,
             (SELECT count(*) FROM customer WHERE c_nationkey = 3) = 0 AS ok""",
)
def check_covariates(spark, sf):
    c = fx.table(spark, sf, "customer")
    first = F.when(F.col("c_nationkey") == 3, 2.0).otherwise(1.0)  # some rows break the rule
    return SA.check_covariates(c.select(F.array(first, "c_acctbal").alias("w")), c.select("c_custkey"))


_LINES = """CASE WHEN c_nationkey = 1 THEN '' WHEN c_nationkey = 2 THEN CAST(c_custkey AS VARCHAR) || chr(13)
  WHEN c_nationkey = 3 THEN 'tall' ELSE CAST(c_custkey AS VARCHAR) END"""


@query(
    "check_values",
    sql="""SELECT count(*) AS n_lines, count(*) FILTER (c_nationkey = 1) AS n_empty, count(*) FILTER (c_nationkey = 2) AS n_carriage_return,
             count(*) FILTER (c_nationkey = 3) AS n_not_numeric, count(*) FILTER (c_nationkey IN (1, 2, 3)) = 0 AS ok FROM customer""",
)
def check_values(spark, sf):
    lines = fx.table(spark, sf, "customer").select(F.expr(_LINES.replace("VARCHAR", "STRING")).alias("value"))
    return SA.check_values(lines)
