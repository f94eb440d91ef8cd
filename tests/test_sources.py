import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusloom.operators import kinship as K
from locusloom.operators import results as R
from locusloom.session import scratch_path
from locusloom.sources import sinks, store, tables, vcf

VCF = """##fileformat=VCFv4.2
##contig=<ID=Chr1>
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t1001\t1002\t1003
Chr1\t10\t.\tA\tC\t.\tPASS\t.\tGT:DP:GQ\t0/0:5:30\t./.:.:.\t0|1:9:99
Chr1\t20\trs7\tA\tC,G\t.\tPASS\t.\tGQ:GT\t30:0/2\t31:1/1\t32
Chr2\t30\t.\tT\t.\t.\tPASS\t.\tGT\t0/0\t.\t0/0
"""


@pytest.fixture
def folder(tmp_path):
    def write(name, text, binary=False):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(gzip.compress(text.encode()) if binary else text.encode())
        return str(path)

    return write


@pytest.mark.parametrize("name, crlf", [("x.vcf", False), ("x.vcf.gz", False), ("dos.vcf", True)])
def test_vcf(spark, folder, name, crlf):
    path = folder(name, VCF.replace("\n", "\r\n") if crlf else VCF, name.endswith(".gz"))
    assert [tuple(r) for r in vcf.vcf_samples(spark, path).collect()] == [(0, "1001"), (1, "1002"), (2, "1003")]
    rows = {r.pos: r for r in vcf.read_vcf(spark, path).collect()}
    assert rows[10].variant_id == "Chr1:10:A:C" and rows[30].alts == [] and rows[20].alts == ["C", "G"]
    assert [tuple(c) for c in rows[10].calls] == [("0/0", 5, 30), (None, None, None), ("0|1", 9, 99)]
    assert [tuple(c) for c in rows[20].calls] == [("0/2", None, 30), ("1/1", None, 31), (None, None, 32)]
    assert [c.gt for c in rows[30].calls] == ["0/0", None, "0/0"]


def test_vcf_problems_are_reported(spark, folder):
    with pytest.raises(ValueError, match="no #CHROM"):
        vcf.read_vcf(spark, folder("none.vcf", "##only\n"))
    short = folder("short.vcf", VCF + "Chr3\t5\t.\tA\tC\t.\t.\t.\tGT\t0/0\n")
    with pytest.raises(Exception, match="wrong number of sample fields at Chr3:5"):
        vcf.read_vcf(spark, short).collect()
    first = folder("many/a.vcf", VCF)
    folder("many/b.vcf", VCF.replace("1003", "1004"))
    with pytest.raises(Exception, match="different samples"):
        vcf.read_vcf(spark, os.path.dirname(first)).collect()


def test_phenotypes_and_covariates(spark, folder):
    path = folder("p.tsv", "12.3\t1\r\n13.4\tNA\r\n-9\t3")
    got = tables.read_phenotypes(spark, path, ["a", "b"]).orderBy("sample_idx").collect()
    assert [tuple(r) for r in got] == [(0, 12.3, 1.0), (1, 13.4, None), (2, None, 3.0)]
    path = folder("c.txt", "1\t1\n1\t1\n1\t0\n1\t0\n")
    assert [r.w for r in tables.read_covariates(spark, path).orderBy("sample_idx").collect()] == [[1, 1], [1, 1], [1, 0], [1, 0]]


def test_line_numbers_over_many_splits(spark, folder):
    path = folder("long.tsv", "\n".join(str(i) for i in range(20000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = tables.read_phenotypes(spark, path, ["y"])
        assert df.rdd.getNumPartitions() > 3
        assert df.filter("sample_idx <> y").count() == 0 and df.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")


def test_lines_of_several_parts_are_numbered_through(spark, folder):
    """Parts in order of their names, one of them empty, several splits a part."""
    first = folder("p/a.tsv", "".join(f"{i}\n" for i in range(3000)))
    folder("p/b.tsv", "")
    folder("p/c.tsv", "3000")
    folder("p/d.tsv", "".join(f"{i}\n" for i in range(3001, 9000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = tables.read_phenotypes(spark, os.path.dirname(first), ["y"])
        assert df.count() == 9000 and df.filter("sample_idx <> y").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")


def test_ordered_text_in_many_parts(spark):
    """A sink of several parts and its reader agree on the order; no task holds all samples."""
    n = 20_000
    pheno = spark.range(n).select(F.col("id").cast("int").alias("sample_idx"), F.when(F.col("id") % 5 > 0, F.col("id") * 0.5).alias("y")).repartition(7)
    path = scratch_path(spark, "pheno")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_phenotype(pheno, "y", path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spark.read.text(path).inputFiles()) > 4
    back = tables.read_phenotypes(spark, path, ["y"])
    assert back.exceptAll(pheno).count() == 0 and back.count() == n
    fam = pheno.select("sample_idx", F.lit("f").alias("family"), F.concat(F.lit("s"), "sample_idx").alias("sample_id"), *(F.lit(0).alias(c) for c in ("father", "mother", "sex")), F.col("y").alias("phenotype"))
    path = scratch_path(spark, "fam")
    sinks.write_fam(fam, path)
    lines = tables.numbered_lines(spark, path)
    assert lines.count() == n and lines.filter("split(value, ' ')[1] <> concat('s', sample_idx)").count() == 0


LRT = "chr\trs\tps\tn_miss\tallele1\tallele0\taf\tl_mle\tp_lrt\n"
ALL = "chr\trs\tps\tn_miss\tallele1\tallele0\taf\tbeta\tse\tl_remle\tl_mle\tp_wald\tp_lrt\tp_score\n"


def test_both_result_layouts(spark, folder):
    lrt = folder("a.assoc.txt", LRT + "0\tChr5:1500020\t1500020\t0\tA\tG\t0.1\t2.5\t1e-3\nchr4\tx\t7\t0\tA\tG\t0.1\t2.5\tnan\n")
    rows = tables.read_assoc(spark, lrt)
    assert rows.count() == 2 and rows.filter("chr = 'chr4'").count() == 1  # not taken for a header
    assert tuple(R.clean_assoc(rows).first()) == ("Chr5:1500020", 5, 1500020, 1e-3, 2.5)
    every = folder("b.assoc.txt", ALL + "3\tx\t7\t0\tA\tG\t0.1\t-1.5\t0.2\t9\t8\t0.01\t0.02\t0.03\n")
    assert tuple(R.clean_assoc(tables.read_assoc(spark, every), stat_col="beta").first()) == ("x", 3, 7, 0.02, -1.5)
    with pytest.raises(ValueError, match="expected a header"):
        tables.read_assoc(spark, folder("c.txt", "SNP\tCHR\n"))


def test_measurements_by_name_pattern(spark, folder):
    first = folder("m/one_nuclei.txt", "Label\tArea\tType\nCol_1.tif\t1.5\tcompact\nCol_2.tif\t\t\n")
    folder("m/two_nuclei.txt", "Label\tArea\tType\nLer_1.tif\t2.5\tloose\n")
    folder("m/one_CCs.txt", "Other\n1\n")
    schema = "Label string, Area double, Type string"
    df = tables.read_measurements(spark, os.path.dirname(first), r"nuclei\.txt$", schema)
    assert {(r.Label, r.Area, r.source_file) for r in df.collect()} == {
        ("Col_1.tif", 1.5, "one_nuclei.txt"), ("Col_2.tif", None, "one_nuclei.txt"), ("Ler_1.tif", 2.5, "two_nuclei.txt")
    }
    folder("m/other_nuclei.txt", "Area\tlabel\n7\tx_1.tif\n")
    got = {(r.Label, r.Area, r.Type, r.source_file) for r in tables.read_measurements(spark, os.path.dirname(first), r"nuclei\.txt$", schema).collect()}
    assert ("x_1.tif", 7.0, None, "other_nuclei.txt") in got and ("Ler_1.tif", 2.5, "loose", "two_nuclei.txt") in got and len(got) == 4
    assert tables.read_measurements(spark, os.path.dirname(first), "absent", schema).collect() == []
    folder("m/new_nuclei.txt", "Area\tShape\tLabel\n1\tround\ty\n")
    with pytest.raises(ValueError, match=r"new_nuclei.txt.*unknown columns \['Shape'\]"):
        tables.read_measurements(spark, os.path.dirname(first), r"nuclei\.txt$", schema)
    rows = tables.read_measurements(spark, os.path.dirname(first), r"nuclei\.txt$", schema, unknown="drop")
    assert rows.columns == ["Label", "Area", "Type", "source_file"] and rows.filter("Label = 'y' AND Area = 1").count() == 1
    folder("m/twice_nuclei.txt", "Area\tArea\tLabel\n1\t2\tz\n")
    with pytest.raises(ValueError, match="repeated columns"):
        tables.read_measurements(spark, os.path.dirname(first), "twice", schema)


def test_text_outputs(spark):
    clean = spark.createDataFrame([("4:5", 4, 5, 1e-9, 2.0)], "SNP string, CHR long, BP long, P double, zscore double").coalesce(1)
    path = scratch_path(spark, "t")
    sinks.write_clean_assoc(clean, path)
    assert [r.value for r in spark.read.text(path).collect()] == ["SNP\tCHR\tBP\tP\tzscore", "4:5\t4\t5\t1.0E-9\t2.0"]
    path = scratch_path(spark, "t")
    sinks.write_bed(R.hits_to_bed(clean.withColumn("SNP", F.lit('4:"5"'))), path)
    assert [r.value for r in spark.read.text(path).collect()] == ['chr4\t5\t5\t4_"5"']
    fam = spark.createDataFrame([(1, "b", 2.5), (0, "a", None)], "sample_idx int, sample_id string, phenotype double")
    path = scratch_path(spark, "t")
    sinks.write_phenotype(fam, "phenotype", path)
    assert [r.value for r in spark.read.text(path).collect()] == ["NA", "2.5"]
    path = scratch_path(spark, "t")
    full = fam.selectExpr("*", "sample_id AS family", "0 AS father", "0 AS mother", "0 AS sex")
    sinks.write_fam(full, path)
    assert [r.value for r in spark.read.text(path).collect()] == ["a a 0 0 0 NA", "b b 0 0 0 2.5"]


def test_variant_store_splits_a_hot_chromosome_and_prunes(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string"))).alias("chrom"),
        (F.col("id") * 10).alias("pos"), F.lit("A").alias("ref"), F.lit(".").alias("id"),
    )
    path = scratch_path(spark, "store")
    store.write_variants(rows, path, partitions=8)
    back = store.read_variants(spark, path)
    assert back.count() == 3000 and dict(back.dtypes)["chrom"] == "string"
    assert back.filter("chrom = '1'").select(F.input_file_name()).distinct().count() > 1
    some = store.read_variants(spark, path, ["1"], (0, 300))
    assert {r.pos for r in some.collect()} == set(range(0, 301, 30))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "(chrom" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0] and "GreaterThanOrEqual(pos,0)" in plan


def test_reuse_follows_inputs_not_names(spark, folder):
    path = folder("in.tsv", "1\n")
    target = scratch_path(spark, "reuse")
    built = []

    def run(parameters):
        key = store.fingerprint(spark, [path], parameters)
        return store.reuse_or_compute(spark, target, lambda: built.append(key) or spark.read.text(path), key).collect()

    assert run({"maf": 0.05}) == run({"maf": 0.05}) and len(built) == 1
    run({"maf": 0.1})
    assert len(built) == 2
    folder("in.tsv", "22\n")
    assert [r.value for r in run({"maf": 0.05})] == ["22"] and len(built) == 3
    marker = f"{target}/{built[-1]}/mark".removeprefix("file:")
    os.rename(marker, f"{marker}-lost")  # as a lost job would leave it
    run({"maf": 0.05})
    assert len(built) == 4


def test_only_changed_parts_are_computed(spark, folder):
    """One of five files touched: one part is computed, and the sum of all parts is that of a full run."""
    rng = np.random.default_rng(2)
    lines = [["\t".join(map(str, rng.integers(0, 3, 12))) for _ in range(30)] for _ in range(6)]
    paths = [folder(f"g/{k}.tsv", "\n".join(lines[k])) for k in range(5)]
    target, built = scratch_path(spark, "parts"), []

    def geno(*names):
        return spark.read.text(list(names)).select(F.split("value", "\t").cast("array<double>").alias("dosage"))

    def sums(path):
        built.append(path)
        return K.kinship_sums(geno(path), 12)

    def rows(df):
        return sorted((r.i, r.j, round(r.k, 9)) for r in df.collect())

    found = store.reuse_parts(spark, target, paths, sums, {"maf": 0.01})
    assert len(built) == len(found.computed) == 5
    assert rows(K.kinship_of_sums(found.table)) == rows(K.kinship(geno(*paths), 12))
    folder("g/3.tsv", "\n".join(lines[5]))
    built.clear()
    found = store.reuse_parts(spark, target, paths, sums, {"maf": 0.01})
    assert built == found.computed == [paths[3]]
    assert rows(K.kinship_of_sums(found.table)) == rows(K.kinship(geno(*paths), 12))
    built.clear()
    fewer = store.reuse_parts(spark, target, paths[:2], sums, {"maf": 0.01})
    assert built == [] and rows(K.kinship_of_sums(fewer.table)) == rows(K.kinship(geno(*paths[:2]), 12))
    store.reuse_parts(spark, target, paths, sums, {"maf": 0.02})
    assert len(built) == 5
    with pytest.raises(ValueError, match="twice"):
        store.reuse_parts(spark, target, [paths[0], paths[0]], sums)


def test_regions_prune_and_meet_in_bins(spark):
    rows = spark.range(4000).select(
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("chrom"), (F.col("id") * 997).alias("pos"), F.lit("A").alias("ref"), F.col("id").cast("string").alias("id"),
    ).unionByName(spark.createDataFrame([("c1", 500_000, "A", str(-k)) for k in range(1, 400)], "chrom string, pos long, ref string, id string"))
    path = scratch_path(spark, "store")
    store.write_variants(rows, path, partitions=12)
    every = [(r.chrom, r.pos, r.id) for r in rows.collect()]

    def check(regions):
        df = spark.createDataFrame(regions, "chrom string, start long, end long")
        found = store.read_regions(spark, path, df)
        want = [v for v in every if any(c == v[0] and v[1] >= (s or 0) and (e is None or v[1] <= e) for c, s, e in regions)]
        assert sorted((r.chrom, r.pos, r.id) for r in found.collect()) == sorted(want)
        return found, len(want)

    found, n = check([("c1", 400_000, 600_000), ("c1", 450_000, 700_000), ("c2", 10, 5), ("c2", 1_000_000, 1_000_100), ("absent", 0, 10)])
    assert n > 400
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = found.select("pos")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    folders = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "chrom" in folders and "c1" in folders and "GreaterThanOrEqual(pos,400000)" in plan and "LessThanOrEqual(pos,700000)" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    check([("c3", None, None), ("c0", None, 300_000), ("c0", 2_000_000, None), ("c0", 250_000, 260_000)])
    check([("c0", s, s + 200_000) for s in range(0, 4_000_000, 150_000)] + [("c1", 0, 0), ("c1", -5, -1), ("c2", -10, 20_000)])
    check([("c1", -10, -2)])
    assert check([("c2", 9, 3)])[1] == 0
    assert store.read_regions(spark, path, spark.createDataFrame([], "chrom string, start long, end long")).count() == 0


def test_no_job_while_a_plan_is_built(spark):
    """Row-wise operators work on a stream, which could not be collected."""
    from locusloom.operators import results, sites

    stream = spark.readStream.format("rate").load().selectExpr("'1' AS chrom", "value AS pos", "'a' AS SNP")
    assert results.highlight(stream, spark.createDataFrame([("a",)], "SNP string")).isStreaming
    assert sites.exclude_positions(stream, spark.createDataFrame([("1", 2)], "chrom string, pos long")).isStreaming


def test_keep_list_and_numbers(spark, folder):
    path = folder("keep.txt", "b\r\n\na\n")
    assert sorted(tuple(r) for r in tables.read_keep_list(spark, path).collect()) == [(0, "b"), (2, "a")]
    long = folder("long.txt", "".join(f"line {i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = tables.numbered_lines(spark, long)
        assert got.count() == 20_000 and got.filter("value <> concat('line ', sample_idx)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_folder_of_gzip_files_is_spread(spark, tmp_path):
    for k in (1, 2):
        body = "".join(f"Chr{k}\t{i}\t.\tA\tC\t.\tPASS\t.\tGT\t0/0\t0/1\t1/1\n" for i in range(1, 201))
        (tmp_path / f"part{k}.vcf.gz").write_bytes(gzip.compress((VCF.split("Chr1\t10")[0] + body).encode()))
    sites = vcf.read_vcf(spark, str(tmp_path))
    assert sites.count() == sites.select("variant_id").distinct().count() == 400
    assert "Exchange hashpartitioning" in sites._jdf.queryExecution().executedPlan().toString()


def test_file_headers_hold_no_lines(spark, tmp_path):
    """The first line of each file is found without sorting or buffering the files' lines (before: a sort of all of them)."""
    for name, lines in (("a.csv", ["x\ty", "1\t2", "3\t4"]), ("b.csv", ["y\tx", "5\t6"]), ("c.txt", ["z", "7"])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    found = tables.file_headers(spark, str(tmp_path), r"\.csv$")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min_by" not in plan
    assert sorted((r.header, [p.rsplit("/", 1)[-1] for p in r.files]) for r in found.collect()) == [("x\ty", ["a.csv"]), ("y\tx", ["b.csv"])]
