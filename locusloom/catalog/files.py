"""Readers and writers: each query writes files derived from the tables, then reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import results as R
from ..operators.sites import site_stats
from ..operators.sites import subset_by_id as subset
from ..plans.funnel import quality_funnel
from ..plans.study import study_inputs
from ..session import scratch_path
from ..sources import sinks, store, tables, vcf
from ..streaming.clean import clean_with_quarantine, finished_batches, stream_assoc
from . import phenotypes, query
from .results import clean
from .variants import FUNNEL_SQL


def _vcf(spark, sf, compression: str = "none") -> str:
    """The called sites as a variant call file (test input; the library only reads the format)."""
    call = lambda c: F.concat_ws(
        ":", F.coalesce(c["gt"], F.lit("./.")), F.coalesce(c["gq"].cast("string"), F.lit(".")), F.coalesce(c["dp"].cast("string"), F.lit("."))
    )
    sites = fx.called_sites(spark, sf)
    body = sites.select(
        F.lit(2).alias("section"),
        "variant_id",
        F.concat_ws(
            "\t", "chrom", F.col("pos").cast("string"), "id", "ref", F.concat_ws(",", "alts"), F.lit("."), F.lit("PASS"), F.lit("."),
            F.lit("GT:GQ:DP"), F.array_join(F.transform("calls", call), "\t"),
        ).alias("value"),
    )
    names = [r["sample_id"] for r in fx.call_samples(spark, sf).orderBy("sample_idx").collect()]
    columns = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names]
    head = spark.createDataFrame(
        [(0, 0, "##fileformat=VCFv4.2"), (1, 0, "\t".join(columns))], "section int, variant_id bigint, value string"
    )
    path = scratch_path(spark, "vcf")
    lines = head.unionByName(body.withColumn("variant_id", F.col("variant_id").cast("bigint")))
    lines.orderBy("section", "variant_id").select("value").write.option("compression", compression).text(path)
    return path


_CALL_ROWS = """SELECT s.chrom, s.pos, s.id, s.ref, s.alt_alleles AS alts, CAST(i AS INT) AS sample_idx,
    CASE WHEN gt <> './.' THEN gt END AS gt, dp, gq
  FROM (SELECT *, unnest(range(10)) AS i FROM sites) s LEFT JOIN d ON d.variant_id = s.variant_id AND d.sample_idx = s.i"""


@query("read_vcf", "sites calls d", _CALL_ROWS)
def read_vcf(spark, sf):
    sites = vcf.read_vcf(spark, _vcf(spark, sf))
    return sites.select(
        "chrom", "pos", "id", "ref", F.concat_ws(",", "alts").alias("alts"), F.posexplode("calls").alias("sample_idx", "c")
    ).select("chrom", "pos", "id", "ref", "alts", "sample_idx", "c.gt", "c.dp", "c.gq")


@query("read_vcf_gzip", "sites calls d", _CALL_ROWS)
def read_vcf_gzip(spark, sf):
    sites = vcf.read_vcf(spark, _vcf(spark, sf, "gzip"), partitions=4)
    return sites.select(
        "chrom", "pos", "id", "ref", F.concat_ws(",", "alts").alias("alts"), F.posexplode("calls").alias("sample_idx", "c")
    ).select("chrom", "pos", "id", "ref", "alts", "sample_idx", "c.gt", "c.dp", "c.gq")


@query("vcf_samples", sql=fx.CALL_SAMPLES)
def vcf_samples(spark, sf):
    return vcf.vcf_samples(spark, _vcf(spark, sf))


_KEEP = f"""SELECT row_number() OVER (ORDER BY sample_id DESC) - 1 AS position, sample_idx, sample_id
            FROM ({fx.CALL_SAMPLES}) WHERE sample_idx % 3 <> 1"""


def _keep_list(spark, sf) -> str:
    """A file with the ids of some samples, in another order than the study's."""
    path = scratch_path(spark, "keep")
    ids = fx.call_samples(spark, sf).filter("sample_idx % 3 <> 1").orderBy(F.col("sample_id").desc())
    ids.select("sample_id").write.text(path)
    return path


@query("read_keep_list", sql=f"SELECT CAST(position AS INT) AS position, sample_id FROM ({_KEEP})")
def read_keep_list(spark, sf):
    return tables.read_keep_list(spark, _keep_list(spark, sf))


@query(
    "subset_by_id",
    "sites calls d",
    f"""SELECT s.variant_id, CAST(position AS INT) AS sample_idx, sample_id, d.gt
        FROM sites s CROSS JOIN ({_KEEP}) k LEFT JOIN d ON d.variant_id = s.variant_id AND d.sample_idx = k.sample_idx""",
)
def subset_by_id(spark, sf):
    keep = tables.read_keep_list(spark, _keep_list(spark, sf))
    sites, order = subset(fx.called_sites(spark, sf), fx.call_samples(spark, sf), keep)
    return sites.select("variant_id", F.posexplode("calls").alias("sample_idx", "c")).join(order, "sample_idx").select("variant_id", "sample_idx", "sample_id", "c.gt")


_KEPT_PARTS = f""", keepers AS ({_KEEP}),
    kept_d AS (SELECT * FROM d WHERE sample_idx IN (SELECT sample_idx FROM keepers)),
    kept_md AS (SELECT * FROM md WHERE sample_idx IN (SELECT sample_idx FROM keepers)),
    kept_stats AS (SELECT s.*, coalesce(n.ac, 0) AS ac FROM sites s
                   LEFT JOIN (SELECT variant_id, sum(d) AS ac FROM kept_d GROUP BY variant_id) n ON n.variant_id = s.variant_id)
    """
_KEPT_SITES = FUNNEL_SQL.replace("stats s", "kept_stats s").replace("FROM md", "FROM kept_md").replace("10 - ", "(SELECT count(*) FROM keepers) - ").replace("<= 5", "<= 3")
_KEPT_FUNNEL = _KEPT_PARTS + _KEPT_SITES


@query("quality_funnel_by_id", "sites calls d md", _KEPT_FUNNEL)
def quality_funnel_by_id(spark, sf):
    """The funnel on a sample subset in list order."""
    sites, _ = subset(fx.called_sites(spark, sf), fx.call_samples(spark, sf), tables.read_keep_list(spark, _keep_list(spark, sf)))
    kept = quality_funnel(sites, chromosomes=[f"Chr{i}" for i in range(1, 6)], max_missing=3)
    return kept.select("variant_id", "chrom", "pos", "id")


@query(
    "study_inputs",
    "sites calls d md stats",
    f"""SELECT f.chrom, f.id AS rs, f.pos, n.n_samples, n.total FROM ({FUNNEL_SQL}) f
        CROSS JOIN (SELECT count(*) AS n_samples, CAST(sum(sample_idx * sample_idx) AS DOUBLE) AS total FROM ({fx.CALL_SAMPLES})) n""",
)
def study(spark, sf):
    """Phenotypes, covariates and calls as files; their checks, and the markers that stay."""
    lines = fx.call_samples(spark, sf).orderBy("sample_idx")
    paths = {name: scratch_path(spark, name) for name in ("height.tsv", "covar.txt", "markers")}
    lines.select((F.col("sample_idx") * F.col("sample_idx")).cast("string")).write.text(paths["height.tsv"])
    lines.select(F.concat(F.lit("1\t"), F.col("sample_idx").cast("string"))).write.text(paths["covar.txt"])
    found = study_inputs(
        spark, paths["height.tsv"], _vcf(spark, sf), paths["markers"], ["height"], paths["covar.txt"],
        chromosomes=[f"Chr{i}" for i in range(1, 6)], max_missing=5,
    )
    totals = found.pheno.agg(F.count("*").alias("n_samples"), F.sum("height").alias("total"))
    return found.markers.select("chrom", "rs", "pos").crossJoin(F.broadcast(totals))


@query(
    "study_inputs_by_id",
    "sites calls d md",
    f"""{_KEPT_PARTS} SELECT f.chrom, f.id AS rs, f.pos, t.n AS n_dosages, coalesce(c.called_at, 0) AS called_at, t.height, t.covariate
        FROM ({_KEPT_SITES}) f
        LEFT JOIN (SELECT variant_id, CAST(sum(position + 1) AS BIGINT) AS called_at FROM kept_md JOIN keepers USING (sample_idx)
                   WHERE d IS NOT NULL GROUP BY variant_id) c ON c.variant_id = f.variant_id
        CROSS JOIN (SELECT CAST(count(*) AS INT) AS n, CAST(sum((position + 1) * sample_idx * sample_idx) AS DOUBLE) AS height,
                      CAST(sum((position + 1) * sample_idx) AS DOUBLE) AS covariate FROM keepers) t""",
)
def study_by_id(spark, sf):
    """A keep list in another order, phenotypes by id in a third: everything follows the list. Sums weighted by the
    new ordinals show that phenotypes, covariates and calls agree on them."""
    lines = fx.call_samples(spark, sf)
    paths = {name: scratch_path(spark, name) for name in ("height.tsv", "covar.txt", "markers")}
    square = (F.col("sample_idx") * F.col("sample_idx")).cast("string")
    lines.orderBy(F.reverse("sample_id")).select(F.concat_ws("\t", "sample_id", square)).write.text(paths["height.tsv"])
    lines.orderBy("sample_idx").select(F.concat(F.lit("1\t"), F.col("sample_idx").cast("string"))).write.text(paths["covar.txt"])
    found = study_inputs(
        spark, paths["height.tsv"], _vcf(spark, sf), paths["markers"], ["height"], paths["covar.txt"], _keep_list(spark, sf), by_id=True,
        chromosomes=[f"Chr{i}" for i in range(1, 6)], max_missing=3,
    )
    weight = F.col("sample_idx") + 1
    totals = found.pheno.agg(F.sum(weight * F.col("height")).alias("height")).crossJoin(found.covar.agg(F.sum(weight * F.get("w", F.lit(1))).alias("covariate")))
    called = F.transform("dosage", lambda d, i: F.when(d.isNotNull(), i + 1).otherwise(0))
    at = F.aggregate(called, F.lit(0).cast("long"), lambda total, x: total + x).alias("called_at")
    return found.markers.select("chrom", "rs", "pos", F.size("dosage").alias("n_dosages"), at).crossJoin(F.broadcast(totals))


@query("write_phenotype", sql=f"SELECT sample_idx, height FROM ({phenotypes._ALIGNED})")
def write_phenotype(spark, sf):
    path = scratch_path(spark, "pheno")
    sinks.write_phenotype(phenotypes.align_phenotypes(spark, sf), "height", path)
    return tables.read_phenotypes(spark, path, ["height"])


@query("read_phenotypes", sql=f"SELECT sample_idx, height, width FROM ({phenotypes._ALIGNED})")
def read_phenotypes(spark, sf):
    path = scratch_path(spark, "traits")
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in ("height", "width")])
    phenotypes.align_phenotypes(spark, sf).orderBy("sample_idx").select(line.alias("value")).write.text(path)
    return tables.read_phenotypes(spark, path, ["height", "width"])


@query("read_covariates", sql="SELECT CAST(s_suppkey AS INT) AS sample_idx, 1e0 AS w0, CAST(s_nationkey AS DOUBLE) AS w1 FROM supplier")
def read_covariates(spark, sf):
    path = scratch_path(spark, "covar")
    s = fx.table(spark, sf, "supplier")
    line = F.concat_ws("\t", F.lit("1"), F.col("s_nationkey").cast("string")).alias("value")
    s.orderBy("s_suppkey").select(line).write.text(path)
    return tables.read_covariates(spark, path).select("sample_idx", F.get("w", F.lit(0)).alias("w0"), F.get("w", F.lit(1)).alias("w1"))


@query(
    "write_fam",
    sql=f"""SELECT sample_id || ' ' || sample_id || ' 0 0 0 ' || coalesce(CAST(CAST(height AS BIGINT) AS VARCHAR) || '.0', 'NA') AS line
            FROM ({phenotypes._ALIGNED})""",
)
def write_fam(spark, sf):
    path = scratch_path(spark, "fam")
    sinks.write_fam(phenotypes.paste_phenotype(spark, sf), path)
    # Large heights are written in scientific notation; compare by value, in plain notation.
    parts = F.split("value", " ")
    height = F.get(parts, F.lit(5)).try_cast("double")
    text = F.coalesce(F.concat(height.cast("bigint").cast("string"), F.lit(".0")), F.lit("NA"))
    return spark.read.text(path).select(F.concat_ws(" ", F.slice(parts, 1, 5), text).alias("line"))


@query("read_assoc", "assoc", "SELECT * FROM assoc")
def read_assoc(spark, sf):
    path = scratch_path(spark, "assoc")
    fx.assoc(spark, sf).write.option("sep", "\t").option("header", True).csv(path)
    return tables.read_assoc(spark, path)


@query("write_clean_assoc", "assoc clean", "SELECT * FROM clean")
def write_clean_assoc(spark, sf):
    path = scratch_path(spark, "clean")
    sinks.write_clean_assoc(clean(spark, sf), path)
    return tables.read_clean_assoc(spark, path)


@query("read_clean_assoc", "assoc clean", "SELECT * FROM clean")
def read_clean_assoc(spark, sf):
    path = scratch_path(spark, "clean")
    clean(spark, sf).write.option("sep", "\t").option("header", True).csv(path)
    return tables.read_clean_assoc(spark, path)


@query(
    "write_bed",
    "assoc clean",
    """SELECT 'chr' || CAST("CHR" AS VARCHAR) || chr(9) || CAST("BP" AS VARCHAR) || chr(9) || CAST("BP" AS VARCHAR) || chr(9)
         || regexp_replace("SNP", ':', '_') AS line FROM clean WHERE "P" < 1e-4""",
)
def write_bed(spark, sf):
    path = scratch_path(spark, "bed")
    sinks.write_bed(R.hits_to_bed(R.significant_hits(clean(spark, sf), 1e-4)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query(
    "read_measurements",
    "nuclei",
    "SELECT label, type, nuc_area, nuc_price, cc_area FROM nuclei WHERE type = 'compact'",
)
def read_measurements(spark, sf):
    """Two kinds of files in one folder tree; the name pattern picks one."""
    path = scratch_path(spark, "nuclei")
    n = fx.nuclei(spark, sf).select("label", "type", "nuc_area", "nuc_price", "cc_area")
    n.filter("type = 'compact'").write.option("sep", "\t").option("header", True).csv(path)
    n.filter("type = 'loose'").select("label", "nuc_area").write.mode("append").option("sep", "\t").option("header", True).option(
        "compression", "gzip"
    ).csv(path)
    schema = "label string, type string, nuc_area double, nuc_price double, cc_area double"
    return tables.read_measurements(spark, path, r"\.csv$", schema).drop("source_file")


@query(
    "read_measurements_by_name",
    "nuclei",
    """SELECT label, CASE WHEN label NOT LIKE '%5%' THEN type END AS type, nuc_area, CASE WHEN label LIKE '%7%' THEN nuc_price END AS nuc_price,
         CASE WHEN label LIKE '%5%' OR label LIKE '%7%' THEN cc_area END AS cc_area FROM nuclei""",
)
def read_measurements_by_name(spark, sf):
    """Files of four layouts: columns in other orders, and some of them absent."""
    path = scratch_path(spark, "layouts")
    n = fx.nuclei(spark, sf)
    five, seven = F.col("label").contains("5"), F.col("label").contains("7")
    layouts = [
        (five & seven, ["cc_area", "label", "nuc_price", "nuc_area"]), (five & ~seven, ["nuc_area", "cc_area", "label"]),
        (~five & seven, ["type", "nuc_price", "label", "cc_area", "nuc_area"]), (~five & ~seven, ["label", "type", "nuc_area"]),
    ]
    for kind, columns in layouts:
        n.filter(kind).select(*columns).write.mode("append").option("sep", "\t").option("header", True).csv(path)
    schema = "label string, type string, nuc_area double, nuc_price double, cc_area double"
    return tables.read_measurements(spark, path, r"\.csv$", schema).drop("source_file")


@query("write_variants", "sites calls d stats", "SELECT variant_id, chrom, pos, ac FROM stats WHERE chrom IN ('Chr1', 'Chr4')")
def write_variants(spark, sf):
    path = scratch_path(spark, "variants")
    store.write_variants(site_stats(fx.called_sites(spark, sf)).drop("calls"), path)
    return store.read_variants(spark, path, ["Chr1", "Chr4"]).select("variant_id", "chrom", "pos", "ac")


@query("read_variants_region", "sites calls d stats", "SELECT variant_id, chrom, pos, ac FROM stats WHERE pos BETWEEN 5000 AND 12000")
def read_variants_region(spark, sf):
    path = scratch_path(spark, "variants")
    store.write_variants(site_stats(fx.called_sites(spark, sf)).drop("calls"), path)
    return store.read_variants(spark, path, region=(5000, 12000)).select("variant_id", "chrom", "pos", "ac")


@query("reuse_or_compute", "assoc", "SELECT chr, count(*) AS n FROM assoc GROUP BY chr")
def reuse_or_compute(spark, sf):
    folder = scratch_path(spark, "reuse")
    key = store.fingerprint(spark, [f"{sf}/orders.parquet"], {"step": "per chr"})
    build = lambda: fx.assoc(spark, sf).groupBy("chr").agg(F.count("*").alias("n"))
    store.reuse_or_compute(spark, folder, build, key)

    def never():
        raise AssertionError("the stored table was not reused")

    return store.reuse_or_compute(spark, folder, never, key)


@query("stream_quarantine", "assoc clean", """SELECT 'clean' AS part, "SNP" AS rs, "CHR" AS chrom, "BP" AS ps FROM clean
    UNION ALL SELECT 'rejected', rs, NULL, ps FROM assoc WHERE rs NOT IN (SELECT "SNP" FROM clean)""")
def stream_quarantine(spark, sf):
    """Result files as a stream, split into clean and rejected rows; both stored by batch."""
    source, folder = scratch_path(spark, "arriving"), scratch_path(spark, "split")
    fx.assoc(spark, sf).write.option("sep", "\t").option("header", True).csv(source)
    arriving = stream_assoc(spark, source, fx.assoc(spark, sf).schema.simpleString()[7:-1].replace(":", " "))
    clean_with_quarantine(arriving, folder, scratch_path(spark, "split-state")).awaitTermination()
    kept = finished_batches(spark, folder, "clean").select(F.lit("clean").alias("part"), F.col("SNP").alias("rs"), F.col("CHR").alias("chrom"), F.col("BP").alias("ps"))
    lost = finished_batches(spark, folder, "rejected").select(F.lit("rejected").alias("part"), "rs", F.lit(None).cast("long").alias("chrom"), "ps")
    return kept.unionByName(lost)


_REGIONS = """SELECT 'Chr' || CAST(n_nationkey % 5 + 1 AS STRING) AS chrom,
  CASE WHEN n_nationkey = 24 THEN NULL ELSE CAST(n_nationkey * 1500 AS BIGINT) END AS start,
  CASE WHEN n_nationkey IN (23, 24) THEN NULL WHEN n_nationkey % 7 = 6 THEN CAST(n_nationkey * 1500 - 1 AS BIGINT)
       ELSE CAST(n_nationkey * 1500 + n_regionkey * 4000 AS BIGINT) END AS {end}
FROM {nation} WHERE n_nationkey % 5 < 4 OR n_nationkey = 24"""


@query(
    "read_variants_regions",
    "sites calls d stats",
    f"""SELECT variant_id, chrom, pos, ac FROM stats s WHERE EXISTS (
          SELECT 1 FROM ({_REGIONS.format(end='stop', nation='nation')}) r
          WHERE r.chrom = s.chrom AND s.pos >= coalesce(r.start, 0) AND (r.stop IS NULL OR s.pos <= r.stop))""",
)
def read_variants_regions(spark, sf):
    """Overlapping, empty and open regions, and a whole chromosome."""
    path = scratch_path(spark, "variants")
    store.write_variants(site_stats(fx.called_sites(spark, sf)).drop("calls"), path)
    regions = spark.sql(_REGIONS.format(end="end", nation="{nation}"), nation=fx.table(spark, sf, "nation"))
    return store.read_regions(spark, path, regions).select("variant_id", "chrom", "pos", "ac")


@query(
    "reuse_parts",
    sql="""SELECT o_orderpriority AS part, o_orderstatus AS status, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS total
           FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderkey % 2 = 0 GROUP BY o_orderpriority, o_orderstatus""",
)
def reuse_parts(spark, sf):
    """Five inputs, all computed, then one of them changed: the others come from what was kept."""
    source, folder = scratch_path(spark, "inputs"), scratch_path(spark, "parts")
    orders = fx.table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus", "o_custkey", "o_orderkey")
    names = [f"{k}-{n}" for k, n in enumerate(("URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED", "LOW"), 1)]
    paths = {n: f"{source}/{n[0]}" for n in names}
    for n in names:
        orders.filter(F.col("o_orderpriority") == n).write.parquet(paths[n])

    def count(path):
        return spark.read.parquet(path).groupBy(F.col("o_orderpriority").alias("part"), F.col("o_orderstatus").alias("status")).agg(
            F.count("*").alias("n"), F.sum("o_custkey").alias("total")
        )

    first = store.reuse_parts(spark, folder, list(paths.values()), count)
    orders.filter("o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0").write.mode("overwrite").parquet(paths["5-LOW"])
    again = store.reuse_parts(spark, folder, list(paths.values()), count)
    if (len(first.computed), again.computed) != (5, [paths["5-LOW"]]):
        raise AssertionError(f"computed {first.computed}, then {again.computed}")
    return again.table
