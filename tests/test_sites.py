import pytest
from pyspark.sql import functions as F

from locusloom import fixtures as fx
from locusloom.functions import genotype as G
from locusloom.operators import sites as S
from locusloom.plans.funnel import quality_funnel

SCHEMA = "variant_id int, chrom string, pos long, id string, ref string, alts array<string>, calls array<struct<gt:string,dp:int,gq:int>>"


def site(spark, *rows):
    """Rows of (id, pos, alts, genotypes); depth 9 and quality 40 unless given as a tuple."""
    data = []
    for vid, pos, alts, gts in rows:
        calls = [g if isinstance(g, tuple) or g is None else (g, 9, 40) for g in gts]
        data.append((vid, "Chr1", pos, ".", "A", alts, calls))
    return spark.createDataFrame(data, SCHEMA)


def ids(df):
    return sorted(r.variant_id for r in df.select("variant_id").collect())


def test_dosage_of_every_kind_of_text(spark):
    texts = ["0/0", "0|1", "1/0", "1|1", "./.", ".|.", ".", "0/.", "./1", "1", "0", "1/2", "2|0", "0/10", "0/0/1", None]
    df = spark.createDataFrame([(t,) for t in texts], "gt string")
    got = [r[0] for r in df.select(G.gt_dosage(F.col("gt"))).collect()]
    assert got == [0, 1, 1, 2, None, None, None, None, None, None, None, 2, 1, 1, None, None]
    got = [r[0] for r in df.select(G.gt_dosage(F.col("gt"), "double")).collect()]
    assert got[9:11] == [2, 0] and got[6] is None


def test_masking_keeps_the_site_and_absent_quality_fails(spark):
    df = site(spark, (1, 10, ["C"], [("0/1", 3, 25), ("0/1", 2, 25), ("0/1", 3, 24), ("0/1", None, 99), None]))
    row = S.mask_calls(df, *G.LENIENT).first()
    assert [c and c.gt for c in row.calls] == ["0/1", None, None, None, None]
    assert [c and c.dp for c in row.calls] == [3, 2, 3, None, None]


def test_missing_count_boundary(spark):
    assert G.missing_count_limit(80, 0.05) == 4
    df = site(
        spark,
        (1, 1, ["C"], ["./."] * 4 + ["0/1"] * 76),
        (2, 2, ["C"], ["./."] * 5 + ["0/1"] * 75),
    )
    assert ids(S.max_missing_count(df, 4)) == [1]
    assert ids(S.missing_rate_filter(df, 0.05)) == [1]


def test_subset_recounts_alleles_in_list_order(spark):
    df = site(spark, (1, 1, ["C"], ["1/1", "0/0", "0/1"]), (2, 2, ["C"], ["1/1", "0/0", "0/0"]))
    kept = S.subset_samples(df, [2, 1])
    assert [c.gt for c in kept.filter("variant_id = 1").first().calls] == ["0/1", "0/0"]
    assert ids(S.min_ac(kept, 1)) == [1]


def test_indels_and_allele_limit(spark):
    df = site(spark, (1, 1, ["C"], ["0/1"]), (2, 2, ["CT"], ["0/1"]), (3, 3, ["C", "G"], ["0/1"]), (4, 4, [], ["0/0"]))
    assert ids(S.remove_indels(df)) == [1, 3, 4]
    assert ids(S.max_alleles(df, 2)) == [1, 2, 4]


def test_singletons_of_all_alleles(spark):
    df = site(
        spark,
        (1, 1, ["C"], ["0/0", "0/1", "0/0"]),  # one alternative
        (2, 2, ["C"], ["0/0", "1/1", "0/0"]),  # private homozygote
        (3, 3, ["C"], ["0/1", "0/1", "0/0"]),  # twice, in two samples
        (4, 4, ["C"], ["1/1", "0/1", "1/1"]),  # one reference
        (5, 5, ["C", "G"], ["0/1", "0/1", "0/2"]),  # third allele once
        (6, 6, ["C"], ["0/0", "./1", "0/0"]),  # partial call is unknown
        (7, 7, ["C"], [None, None, "0/0"]),  # reference in one homozygote only
    )
    got = {tuple(r) for r in S.singletons(df).select("pos", "kind", "allele", "sample_idx").collect()}
    assert got == {(1, "S", "C", 1), (2, "D", "C", 1), (4, "S", "A", 1), (5, "S", "G", 2), (7, "D", "A", 2)}
    only = {r.pos for r in S.singletons(df, include_doubletons=False).collect()}
    assert only == {1, 4, 5}


def test_dropping_singletons_equals_the_position_join(spark):
    common = ["0/1", "0/1", "0/0", "0/0"]
    df = site(
        spark,
        (1, 1, ["C"], common),
        (2, 2, ["C"], ["0/1", "0/0", "0/0", "0/0"]),
        (3, 2, ["G"], common),  # shares its position with a singleton record
        (4, 3, ["C"], common),
        (5, 3, ["G"], common),
    )
    joined = ids(S.exclude_positions(df, S.singletons(df)))
    assert ids(S.drop_singletons(df)) == joined == [1, 4, 5]


def test_minor_allele_recode(spark):
    df = spark.createDataFrame(
        [(1, "C", "A", [2.0, 2.0, 1.0, None]), (2, "C", "A", [0.0, 1.0, 1.0, None]), (3, "C", "A", [2.0, 0.0, None, None]), (4, "C", "A", [None] * 4)],
        "variant_id int, a1 string, a0 string, dosage array<double>",
    )
    got = {r.variant_id: r for r in S.minor_allele_recode(df).collect()}
    assert (got[1].a1, got[1].a0, got[1].flipped, got[1].dosage) == ("A", "C", True, [0.0, 0.0, 1.0, None])
    assert not got[2].flipped and not got[3].flipped and not got[4].flipped
    assert S.site_stats(S.minor_allele_recode(df)).agg(F.max("af")).first()[0] <= 0.5


def test_names(spark):
    df = spark.createDataFrame(
        [("Chr5", 1500020, "."), ("Chr5", 7, "rs1"), ("xChr5", 7, None), ("5", 7, "")], "chrom string, pos long, id string"
    )
    assert [r.id for r in S.default_variant_id(df).collect()] == ["Chr5:1500020", "rs1", "xChr5:7", "5:7"]
    assert [r.chrom for r in S.strip_chrom_prefix(df).collect()] == ["5", "5", "xChr5", "5"]
    assert [r.chrom_code for r in S.chrom_code(df).collect()] == [0, 0, 0, 5]


def test_nesting_fills_gaps_and_rejects_repeats(spark):
    long = spark.createDataFrame(
        [(1, 0, "0/0", 5, 30), (1, 2, "0/1", 5, 30), (2, 0, "0/0", 5, 30), (2, 1, "1/1", 5, 30), (2, 2, "0/1", 5, 30)],
        "variant_id int, sample_idx int, gt string, dp int, gq int",
    )
    got = {r.variant_id: [c and c.gt for c in r.calls] for r in S.nest_calls(long, 3).collect()}
    assert got == {1: ["0/0", None, "0/1"], 2: ["0/0", "1/1", "0/1"]}
    with pytest.raises(Exception, match="repeated or out-of-range"):
        S.nest_calls(long.union(long.limit(1)), 3).collect()
    for unique in (False, True):
        with pytest.raises(Exception, match="repeated or out-of-range"):
            S.nest_calls(long, 2, unique=unique).collect()
    with pytest.raises(Exception, match="repeated or out-of-range"):
        S.nest_calls(long.union(long.filter("variant_id = 2")), 3, unique=True).collect()
    one = S.nest_calls(long, 3, fields=["gt"]).filter("variant_id = 1").first()
    assert one.calls == ["0/0", None, "0/1"]


def test_long_and_nested_layouts_agree(spark, sf):
    nested = S.site_stats(fx.called_sites(spark, sf)).select("variant_id", "ac", "an", "n_miss")
    long = S.site_stats_long(fx.calls(spark, sf), fx.N_CALL_SAMPLES).select("variant_id", "ac", "an", "n_miss")
    assert long.exceptAll(nested).count() == 0


def test_funnel_counts_on_the_fixture(spark, sf_mid):
    """Counts stated for this fixture, which take alternative alleles after masking."""
    base = S.remove_indels(S.max_alleles(S.keep_chromosomes(fx.called_sites(spark, sf_mid), [f"Chr{i}" for i in range(1, 6)])))
    masked = S.max_missing_count(S.mask_calls(base, *G.LENIENT), 5)
    assert (base.count(), masked.count(), S.min_ac(masked, 1).count()) == (1162, 764, 668)


def test_funnel_moves_no_calls(spark, sf):
    """Without the singleton step the funnel adds no exchange to its input."""
    stored = fx.called_sites(spark, sf).checkpoint()
    plan = quality_funnel(stored, [0, 1, 2], ["Chr1"], max_missing=2, singletons=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    plan = quality_funnel(stored, chromosomes=["Chr1"], max_missing=5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_calls_are_decoded_once(spark, sf):
    sites = fx.called_sites(spark, sf)
    for df in (S.site_stats(sites).filter("n_miss < 3"), S.min_ac(S.subset_samples(sites, [1, 0, 5]))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("transform(calls") <= 2, plan


def test_subset_by_id_keeps_list_order(spark):
    sites = spark.createDataFrame([(1, ["0/0", "0/1", "1/1"])], "variant_id int, calls array<string>")
    samples = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "sample_idx int, sample_id string")
    keep = lambda *ids: spark.createDataFrame(list(enumerate(ids)), "position int, sample_id string")
    kept, order = S.subset_by_id(sites, samples, keep("z", "x"))
    assert kept.first().calls == ["1/1", "0/0"]
    assert sorted(tuple(r) for r in order.collect()) == [(0, "z"), (1, "x")]
    for ids, match in ((("z", "w"), "w"), (("x", "x"), "twice")):
        with pytest.raises(ValueError, match=match):
            S.subset_by_id(sites, samples, keep(*ids))
