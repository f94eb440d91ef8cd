from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from locusloom import fixtures as fx
from locusloom.operators import results as R
from locusloom.operators import samples as SA
from locusloom.operators.report import append_summary, compare_stored_runs, read_summaries
from locusloom.plans import analysis, association, phenotyping
from locusloom.plans.funnel import quality_funnel
from locusloom.plans.study import study_inputs
from locusloom.session import scratch_path
from locusloom.sources import ledger, tables
from locusloom.streaming import clean
from locusloom.streaming.clean import clean_as_they_arrive, stream_assoc


def test_from_calls_to_hits(spark, sf_mid):
    """Calls -> funnel -> markers -> relatedness -> scan -> report, on the call fixture."""
    kept = quality_funnel(fx.called_sites(spark, sf_mid), quality=(0, 0), chromosomes=[f"Chr{i}" for i in range(1, 6)], max_missing=0)
    geno = association.markers(kept).checkpoint()
    assert geno.filter(F.col("chrom").contains("Chr")).count() == 0
    samples = spark.createDataFrame([(i, float((i * 7) % 10) + i / 3) for i in range(10)], "sample_idx int, y double")
    run = association.association_run(geno, samples, 10, "y", maf=0.1)
    summary = run.summary.first()
    assert summary.n_markers == geno.count() and summary.n_tested == run.assoc.count() > 0
    assert run.clean.count() == run.assoc.count()
    path = scratch_path(spark, "runs")
    for _ in range(2):
        append_summary(run.summary, path)
    kept_runs = read_summaries(spark, path)
    assert kept_runs.count() == 1 and kept_runs.first().parameters["maf"] == "0.1"
    assert run.assoc.filter("af > 0.5 OR af < 0.1").count() == 0
    out = analysis.result_tables(run.clean, 0.05, ["snp3"])
    n = run.clean.filter("P < 1").count()
    assert out["qq"].count() == n and out["layout"].count() == run.clean.count()
    assert out["hits"].count() == out["intervals"].count() == run.clean.filter("P < 0.05").count()
    assert out["histogram"].agg(F.sum("n")).first()[0] == run.clean.count()
    assert out["per_chromosome"].count() == out["ticks"].count()


def test_covariate_removes_its_own_signal(spark, sf_mid):
    geno, pheno = fx.geno(spark, sf_mid), fx.pheno(spark, sf_mid)
    kin = association.relatedness(geno, 64)
    plain = association.association_run(geno, pheno, 64, "y", kin=kin)
    top = plain.clean.orderBy("P").first()
    covar = SA.covariate_from_snp(geno, [top.SNP])
    again = association.association_run(geno, pheno, 64, "y_top", covar=covar, kin=kin)
    assert again.clean.filter(F.col("SNP") == top.SNP).count() == 0
    row = again.summary.first()
    assert row.n_covariates == 2 and len(row.beta) == len(row.se_beta) == 2


def summaries(spark, pve, covariates=None, trait="t"):
    run_id = trait if covariates is None else f"{trait}_{covariates}"
    return spark.createDataFrame([(run_id, trait, covariates, pve, [pve])], "run_id string, trait string, covariates string, pve double, beta array<double>")


def test_ledger_survives_retries(spark):
    path = scratch_path(spark, "ledger")
    for pve in (0.9, 0.8):
        append_summary(summaries(spark, pve), path)
        append_summary(summaries(spark, pve / 2, "snp"), path)
    append_summary(summaries(spark, 0.1, "other"), path)
    ledger.write_rows(summaries(spark, 0.0), path, "half")  # a writer that was lost before its commit
    rows = {r.covariates: r for r in compare_stored_runs(read_summaries(spark, path)).collect()}
    assert set(rows) == {"snp", "other"}
    assert rows["snp"].pve_delta == pytest.approx(0.4) and rows["other"].pve_delta == pytest.approx(0.7)
    assert ledger.history(spark, path).count() == 5
    ledger.commit(spark, path, "half")  # the retry finishes it
    assert read_summaries(spark, path).filter("run_id = 't'").first().pve == 0.0


def test_ledger_of_two_writers(spark):
    path = scratch_path(spark, "ledger")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: append_summary(summaries(spark, k / 10, trait=f"t{k % 6}"), path), range(12)))
    assert ledger.history(spark, path).count() == 12 and read_summaries(spark, path).count() == 6
    wide = summaries(spark, 0.5, trait="t9").withColumn("note", F.lit("new column"))
    append_summary(wide, path)
    assert {r.run_id: r.note for r in read_summaries(spark, path).collect()}["t9"] == "new column"


def test_several_runs_of_one_trait_fail(spark):
    twice = summaries(spark, 0.5).unionByName(summaries(spark, 0.4).withColumn("run_id", F.lit("else")))
    with pytest.raises(Exception, match="several runs of t"):
        compare_stored_runs(twice.unionByName(summaries(spark, 0.1, "snp"))).collect()


def test_measurements_to_sample_order(spark):
    a = spark.createDataFrame([("Col_2017-1.tif", "compact", 1.0, "t1"), ("Col_2017-2.tif", "", 3.0, "t1")], "label string, type string, area double, tag string")
    b = spark.createDataFrame([("t2", 5.0, "loose", "Ler_2017-1.tif")], "tag string, area double, type string, label string")
    rows = phenotyping.measurement_rows([a, b], "name")
    assert rows.filter("type IS NULL").count() == 1
    samples = spark.createDataFrame([(0, "Ler"), (1, "Ws"), (2, "Col")], "sample_idx int, sample_id string")
    got = phenotyping.accession_phenotypes(rows, samples, ["area"], [], "tag").orderBy("sample_idx").collect()
    assert [(r.sample_id, r.tag, r.area, r.hx) for r in got] == [("Ler", "t2", 5.0, 0.0), ("Ws", None, None, None), ("Col", "t1", 2.0, 1.0)]


def test_cleaning_a_stream_equals_the_batch(spark, sf):
    folder, out, state = (scratch_path(spark, x) for x in ("in", "out", "state"))
    assoc = fx.assoc(spark, sf)
    schema = "chr string, rs string, ps long, n_miss int, allele1 string, allele0 string, af double, l_mle double, p_lrt double"
    expect = R.clean_assoc(assoc)
    for part in ("ps % 20 = 0", "ps % 20 <> 0"):  # a second batch of files arrives later
        assoc.filter(part).write.mode("append").option("sep", "\t").option("header", True).csv(folder)
        clean_as_they_arrive(stream_assoc(spark, folder, schema), out, state).awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == expect.count() and got.exceptAll(expect).count() == 0


def test_quarantine_survives_a_kill_between_the_sinks(spark, sf, monkeypatch):
    source, folder, state = (scratch_path(spark, n) for n in ("arriving", "split", "state"))
    rows = fx.assoc(spark, sf)
    schema = rows.schema.simpleString()[7:-1].replace(":", " ")
    parts = rows.randomSplit([0.4, 0.6], seed=1)
    parts[0].write.option("sep", "\t").option("header", True).csv(source)
    run = lambda: clean.clean_with_quarantine(stream_assoc(spark, source, schema), folder, state).awaitTermination()
    run()
    parts[1].write.mode("append").option("sep", "\t").option("header", True).csv(source)
    written, write = [], clean.write_batch

    def killed(df, path):
        if "rejected" in path or "finished" in path:
            raise RuntimeError("killed between the sinks")
        written.append(path)
        write(df, path)

    monkeypatch.setattr(clean, "write_batch", killed)
    for _ in range(2):
        with pytest.raises(Exception, match="killed between"):
            run()
    assert len(written) == 2 and written[0] == written[1]
    seen = clean.finished_batches(spark, folder, "clean").count()
    assert seen == R.clean_assoc(parts[0]).count()  # the half batch is not seen
    monkeypatch.setattr(clean, "write_batch", write)
    run()
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(clean.finished_batches(spark, folder, "clean"), R.clean_assoc(rows))
    assert same(clean.finished_batches(spark, folder, "rejected"), R.rejected_assoc(rows))


def test_result_file_round_trip_through_the_reader(spark, sf):
    path = scratch_path(spark, "assoc")
    fx.assoc(spark, sf).write.option("sep", "\t").option("header", True).csv(path)
    assert R.clean_assoc(tables.read_assoc(spark, path)).count() == 1490


@pytest.mark.parametrize("bad", ["wald"])
def test_unknown_test_is_refused(spark, sf, bad):
    with pytest.raises(ValueError):
        association.L.lmm_scan(fx.geno(spark, sf), None, bad)


def test_funnel_names_after_the_prefix_is_gone(spark):
    calls = "array(named_struct('gt','0/1','dp',9,'gq',40), named_struct('gt','0/1','dp',9,'gq',40), named_struct('gt','0/0','dp',9,'gq',40))"
    sites = spark.sql(f"SELECT 'Chr4' AS chrom, 10420088 AS pos, '.' AS id, 'A' AS ref, array('C') AS alts, {calls} AS calls")
    assert [tuple(r) for r in quality_funnel(sites).select("chrom", "id").collect()] == [("4", "4:10420088")]


@pytest.mark.parametrize(
    ("heights", "covar", "match"),
    [
        ("1\n2\n", None, "n_phenotypes': 2"), ("1\n\n3\n", None, "n_empty': 1"), ("1\r\n2\n3\n", None, "n_carriage_return': 1"),
        ("1\n2\ntall\n", None, "n_not_numeric': 1"), ("1\n2\n3\n", "1\t0\n2\t0\n1\t1\n", "intercept_ok': False"),
        ("1\n2\n3\n", "1\t0\n1\t1\n", "n_covariate_rows': 2"),
    ],
)
def test_study_refuses_bad_files(spark, tmp_path, heights, covar, match):
    head = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "a", "b", "c"])
    files = {"calls.vcf": f"##fileformat=VCFv4.2\n{head}\n", "height.tsv": heights, "covar.txt": covar}
    for name, text in files.items():
        if text is not None:
            (tmp_path / name).write_bytes(text.encode())
    path = lambda name: str(tmp_path / name) if files[name] is not None else None
    with pytest.raises(ValueError, match=match):
        study_inputs(spark, path("height.tsv"), path("calls.vcf"), str(tmp_path / "out"), covariate_path=path("covar.txt"))


HEAD = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "a", "b", "c", "d"])


def calls_file(tmp_path):
    """Four samples whose calls tell them apart: 0/0, 0/1, 1/1 and a gap, turned by site."""
    calls = ["0/0:9:99", "0/1:9:99", "1/1:9:99", "./.:.:."]
    sites = [f"Chr1\t{10 * k + 10}\t.\tA\tC\t.\tPASS\t.\tGT:DP:GQ\t" + "\t".join(calls[(k + i) % 4] for i in range(4)) for k in range(4)]
    (tmp_path / "calls.vcf").write_text("\n".join(["##fileformat=VCFv4.2", HEAD, *sites]) + "\n")
    return str(tmp_path / "calls.vcf")


def test_study_by_id_and_keep_list(spark, tmp_path):
    calls = calls_file(tmp_path)
    (tmp_path / "height.tsv").write_text("c\t3\nx\t99\na\t1\nd\t4\nb\t2\n")
    (tmp_path / "plain.tsv").write_text("1\n2\n3\n4\n")
    (tmp_path / "covar.txt").write_text("1\t10\n1\t20\n1\t30\n1\t40\n")
    (tmp_path / "keep.txt").write_text("d\na\nc\n")
    path = lambda n: str(tmp_path / n)
    for phenotypes, by_id in (("height.tsv", True), ("plain.tsv", False)):
        found = study_inputs(
            spark, path(phenotypes), calls, path(f"out-{by_id}"), ["height"], path("covar.txt"), path("keep.txt"), by_id, singletons=True, min_alt=0
        )
        assert sorted(map(tuple, found.samples.collect())) == [(0, "d"), (1, "a"), (2, "c")]
        assert sorted((r.sample_idx, r.sample_id, r.height) for r in found.pheno.collect()) == [(0, "d", 4.0), (1, "a", 1.0), (2, "c", 3.0)]
        assert sorted((r.sample_idx, r.w) for r in found.covar.collect()) == [(0, [1.0, 40.0]), (1, [1.0, 10.0]), (2, [1.0, 30.0])]
        gap = {r.pos: [i for i, d in enumerate(r.dosage) if d is None] for r in found.markers.collect()}
        of = {"a": 3, "b": 2, "c": 1, "d": 0}  # the site at which a sample has its gap
        assert all(len(r.dosage) == 3 for r in found.markers.collect()) and len(gap) == 4
        assert {p: g for p, g in gap.items() if g} == {10 * of[s] + 10: [i] for i, s in enumerate("dac")}
    everyone = study_inputs(spark, path("plain.tsv"), calls, path("out-all"), ["height"], singletons=True, min_alt=0)
    assert [r.sample_id for r in everyone.samples.orderBy("sample_idx").collect()] == list("abcd")
    assert all(len(r.dosage) == 4 for r in everyone.markers.collect())


@pytest.mark.parametrize(
    "options, match",
    [
        ({"samples": [1, 0]}, "keep list of ids"), ({"by_id": True}, "only_phenotypes': 1"), ({"keep": "d\nz\n"}, "unknown sample ids"),
        ({"keep": "d\nd\n"}, "listed twice"), ({"by_id": True, "heights": "a\t1\nb\t2\n", "keep": "a\nd\n"}, "only_samples': 1"),
        ({"by_id": True, "heights": "a\t1\na\t2\n", "keep": "a\n"}, "n_phenotypes': 2"),
    ],
)
def test_study_refuses_other_orders(spark, tmp_path, options, match):
    calls = calls_file(tmp_path)
    by_id = options.pop("by_id", False)
    heights = options.pop("heights", "a\t1\nb\t2\nc\t3\nd\t4\nx\t5\n" if by_id else "1\n2\n3\n4\n")
    (tmp_path / "height.tsv").write_text(heights)
    keep = options.pop("keep", None)
    if keep is not None:
        (tmp_path / "keep.txt").write_text(keep)
        options["keep_path"] = str(tmp_path / "keep.txt")
    with pytest.raises(ValueError, match=match):
        study_inputs(spark, str(tmp_path / "height.tsv"), calls, str(tmp_path / "out"), by_id=by_id, **options)
