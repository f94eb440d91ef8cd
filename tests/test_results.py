import math
import random

import pytest
from pyspark.sql import functions as F

from locusloom import fixtures as fx
from locusloom.operators import ordering as O
from locusloom.operators import results as R

ASSOC = "chr string, rs string, ps long, l_mle double, p_lrt double"
CLEAN = "SNP string, CHR long, BP long, P double, zscore double"


def test_cleaning_rules(spark):
    df = spark.createDataFrame(
        [
            ("0", "Chr5:1500020", 1500020, 1.0, 0.1),
            ("0", "ChrM:7", 7, 1.0, 0.1),
            ("0", "ChrC:7", 7, 1.0, 0.1),
            ("0", "scaffold_12:5", 5, 1.0, 0.1),
            ("3", "x", 9, 1.0, None),
            (" 7 ", "y", 9, 1.0, 0.2),
            ("chrUn", "z", 9, 1.0, 0.2),
            (None, "w", 9, 1.0, 0.2),
        ],
        ASSOC,
    )
    clean = R.clean_assoc(df)
    assert {(r.SNP, r.CHR) for r in clean.collect()} == {("Chr5:1500020", 5), ("scaffold_12:5", 12), ("x", 3), ("y", 7)}
    assert clean.columns == ["SNP", "CHR", "BP", "P", "zscore"]
    assert {r.rs for r in R.rejected_assoc(df).collect()} == {"ChrM:7", "ChrC:7", "z", "w"}
    with pytest.raises(Exception, match="chromosome is not an integer"):
        R.clean_assoc(df, on_bad="fail").collect()


def test_columns_are_picked_by_name(spark):
    df = spark.createDataFrame(
        [("1", "a", 5, 2.0, 0.5, 9.0, 9.0, 0.03, 0.01)],
        "chr string, rs string, ps long, beta double, se double, l_mle double, l_remle double, p_wald double, p_lrt double",
    )
    row = R.clean_assoc(df, stat_col="beta").first()
    assert (row.P, row.zscore) == (0.01, 2.0)
    with pytest.raises(ValueError, match="missing column"):
        R.clean_assoc(df, p_col="p_score")


@pytest.fixture
def clean(spark):
    return spark.createDataFrame(
        [("4:10420088", 4, 10420088, 1e-9, 1.0), ("1:24018", 1, 24018, 0.01, 1.0), ("a:b:c", 2, 5, 0.0, 1.0), ("n", 2, 6, None, 1.0)], CLEAN
    )


def test_thresholds(clean):
    pick = lambda t: {r.SNP for r in R.significant_hits(clean, t).collect()}
    assert R.bonferroni_threshold(clean).first().threshold == 0.05 / 4
    assert pick("bonferroni") == {"4:10420088", "1:24018", "a:b:c"}
    assert pick("5E-8") == {"4:10420088", "a:b:c"}
    assert pick("0") == set() and pick(0.0) == set()
    assert R.significant_hits(clean).columns == clean.columns


def test_highlight_and_intervals(spark, clean):
    marked = {r.SNP for r in R.highlight(clean, ["4:10420088", "5:112000"]).filter("highlight").collect()}
    assert marked == {"4:10420088"}
    listed = spark.createDataFrame([("1:24018",), ("1:24018",)], "name string")
    both = R.highlight(clean, listed)
    assert both.count() == 4 and both.filter("highlight").first().SNP == "1:24018"
    bed = {r.name: r for r in R.hits_to_bed(clean).collect()}
    assert tuple(bed["4_10420088"])[:3] == ("chr4", 10420088, 10420088)
    assert "a_b:c" in bed
    assert R.hits_to_bed(clean, half_open=True).filter("name = '1_24018'").first().start == 24017


def test_zero_p_gives_infinity(clean):
    row = R.neg_log_p(clean).filter("SNP = 'a:b:c'").first()
    assert math.isinf(row.neg_log10_p) and math.isinf(row.neg_ln_p)
    assert R.neg_log_p(clean).filter("SNP = 'n'").first().neg_log10_p is None


def brute_qq(ps):
    ps = sorted(p for p in ps if p is not None and 0 < p < 1)
    n, a = len(ps), 0.375 if len(ps) <= 10 else 0.5
    return [(i, p, -math.log10(p), -math.log10((i - a) / (n + 1 - 2 * a))) for i, p in enumerate(ps, 1)]


@pytest.mark.parametrize("n", [3, 10, 500])
def test_qq_points_against_brute_force(spark, n):
    random.seed(n)
    ps = [random.random() for _ in range(n)] + [None, 0.0, 1.0]
    df = spark.createDataFrame([(p,) for p in ps], "P double")
    got = sorted(tuple(r) for r in R.qq_points(df).collect())
    assert len(got) == n
    for have, want in zip(got, brute_qq(ps)):
        assert have == pytest.approx(want, rel=1e-12)


def test_ties_beyond_a_chunk_are_spread_and_complete(spark, monkeypatch):
    """A third of all rows share one value."""
    monkeypatch.setattr(O, "CHUNK", 50)
    ps = [0.25] * 1000 + [i / 4001 for i in range(1, 2001)]
    df = spark.createDataFrame([(p,) for p in ps], "P double").repartition(7)
    points = R.qq_points(df)
    got = sorted(tuple(r) for r in points.collect())
    assert [g[:2] for g in got] == [w[:2] for w in brute_qq(ps)]
    tied = points.filter("P = 0.25").groupBy(F.spark_partition_id()).count().collect()
    assert len(tied) > 1


def test_running_total_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 5).alias("v"))
    total, want = 0, {}
    for k, v in sorted(map(tuple, df.collect())):
        want[k] = total
        total += v
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got, grand = O.running_total(O.place_in_order(df, ["k"]), "v", "before")
        assert got.rdd.getNumPartitions() > 1 and grand == total
        assert {r.k: r.before for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_layout(spark):
    df = spark.createDataFrame(
        [("a", 1, 10, 0.5, 0.0), ("b", 1, 90, 1e-9, 0.0), ("c", 3, 5, 0.2, 0.0), ("d", 7, 4, None, 0.0)], CLEAN
    )
    expect = {"a": 10, "b": 90, "c": 95, "d": 99}
    assert {r.SNP: r.x for r in R.manhattan_layout(df).collect()} == expect
    above = {r.SNP for r in R.manhattan_layout(df, "bonferroni", ["c"]).filter("above").collect()}
    assert above == {"b"}
    assert {r.threshold_y for r in R.manhattan_layout(df, "bonferroni").collect()} == {-math.log10(0.05 / 4)}
    ticks = {r.CHR: (r.offset, r.tick) for r in R.manhattan_ticks(df).collect()}
    assert ticks == {1: (0, 50.0), 3: (90, 95.0), 7: (95, 99.0)}


@pytest.mark.parametrize(
    "low, high, bins, want",
    [
        (0.0, 10.0, 5, (0.0, 2.0, 5)),
        (0.1, 9.7, 8, (0.0, 1.0, 10)),
        (0.0, 31.0, 15, (0.0, 2.0, 16)),
        (2.3, 2.9, 4, (2.2, 0.2, 4)),
        (-3.0, 4.0, 3, (-4.0, 2.0, 4)),
        (5.0, 5.0, 5, (0.0, 5.0, 1)),
    ],
)
def test_round_edges(low, high, bins, want):
    assert R.pretty_edges(low, high, bins) == pytest.approx(want)


def test_histogram_is_right_closed_and_drops_infinity(spark):
    values = [0.0, 1.0, 2.0, 2.0, 3.5, 10.0]
    df = spark.createDataFrame([(math.exp(-v),) for v in values] + [(0.0,), (None,)], "P double")
    got = {(r.lower, r.upper): r.n for r in R.histogram(df, bins=5).collect()}
    assert got == {(0.0, 2.0): 4, (2.0, 4.0): 1, (8.0, 10.0): 1}
    assert R.histogram(df.filter("P is null")).collect() == []


def test_orientation(spark):
    df = spark.createDataFrame([(8.34, 0.6), (8.34, 0.4)], "beta double, alt_af double")
    assert [r.beta for r in R.orient_effect(df).collect()] == [-8.34, 8.34]


def test_fixture_counts(spark, sf):
    clean = R.clean_assoc(fx.assoc(spark, sf))
    assert (clean.count(), R.significant_hits(clean, "bonferroni").count()) == (1490, 49)
