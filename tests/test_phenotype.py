import numpy as np
import pytest
from pyspark.sql import functions as F

from locusloom.operators import phenotype as P


def test_accession_from_label(spark):
    labels = ["Col-0_2017-03-12.tif", "Col-0_2017_12.tif", "Ler_7xtif", "Ws", None]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    default = [r.accession for r in P.parse_accession(df).collect()]
    assert default == ["Col-0_2017-03", "Col-0_2017", "Ler", "Ws", None]
    assert [r.accession for r in P.parse_accession(df, "name").collect()] == ["Col-0", "Col-0", "Ler", "Ws", None]
    with pytest.raises(ValueError):
        P.parse_accession(df, "other")


def test_means_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 4.0), ("c", None)], "g string, x double")
    assert {r.g: r.x for r in P.mean_strict(df, "g", ["x"]).collect()} == {"a": None, "b": 3.0, "c": None}
    assert {r.g: r.x for r in P.mean_skip_na(df, "g", ["x"]).collect()} == {"a": 1.0, "b": 3.0, "c": None}


def test_compact_share_with_other_and_missing_types(spark):
    rows = [("a", "compact"), ("a", "loose"), ("a", "other"), ("a", None), ("a", ""), ("b", None), ("c", "loose")]
    df = P.blank_to_null(spark.createDataFrame(rows, "accession string, type string"))
    assert {r.accession: r.hx for r in P.hx_by_accession(df).collect()} == {"a": 1 / 3, "b": None, "c": 0.0}
    assert P.hx_overall(df).first().hx == 0.25
    counts = {r.accession: (r.compact, r.loose, r.other) for r in P.contingency(df, "accession", "type").collect()}
    assert counts == {"a": (1, 1, 1), "b": (0, 0, 0), "c": (0, 1, 0)}
    assert [r.type for r in P.levels(df, "type").collect()] == ["compact", "loose", "other"]


def test_tags_follow_pairs_and_conflicts_fail(spark):
    df = spark.createDataFrame(
        [("Acc2", 30, 1.0, "compact"), ("Acc10", 20, 2.0, "loose"), ("Acc10", 20, 4.0, "compact"), ("none", None, 1.0, "loose")],
        "accession string, tag int, x double, type string",
    )
    got = {r.accession: (r.tag, r.x, r.hx) for r in P.summarize_accessions(df, ["x"], [], "tag").collect()}
    assert got == {"Acc2": (30, 1.0, 1.0), "Acc10": (20, 3.0, 0.5)}
    assert {r.accession: r.tag for r in P.attach_tag(P.hx_by_accession(df), df, "tag").collect()} == {"Acc2": 30, "Acc10": 20}
    bad = df.union(spark.createDataFrame([("Acc2", 31, 1.0, "loose")], df.schema))
    with pytest.raises(Exception, match="more than one tag"):
        P.summarize_accessions(bad, ["x"], [], "tag").collect()


def test_summary_is_one_aggregation(spark, sf):
    from locusloom import fixtures as fx

    rows = P.parse_accession(fx.nuclei(spark, sf), "name")
    plan = P.summarize_accessions(rows, ["nuc_area", "nuc_price"], ["cc_area"], "tg_ecotypeid")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def brute_box(x):
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = x[(x >= lo) & (x <= hi)]
    return len(x), q1, med, q3, inside.min(), inside.max(), int(((x < lo) | (x > hi)).sum())


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_box_against_brute_force_with_a_hot_group(spark, coalesce):
    rng = np.random.default_rng(5)
    groups = {"hot": np.r_[rng.normal(0, 1, 900).round(2), 50.0, -40.0], "two": np.array([1.0, 2.0]), "one": np.array([7.0]),
              "ties": np.array([3.0] * 400 + [4.0] * 3), None: rng.exponential(3, 101)}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("one", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = {r[0]: tuple(r)[1:] for r in P.boxplot_stats(df, "g", "v").collect()}
        outliers = P.boxplot_outliers(df, "g", "v").groupBy("g").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(got) == set(groups)
    for g, x in groups.items():
        assert got[g] == pytest.approx(brute_box(x), abs=1e-9), g
    want = {g: brute_box(x)[-1] for g, x in groups.items() if brute_box(x)[-1]}
    assert {r.g: r["count"] for r in outliers} == want


def test_union_is_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert sorted(map(tuple, P.union_measurements([a, b]).collect())) == [(1, "x"), (2, "y")]
    assert P.reorder_columns(a, ["s"]).columns == ["s", "n"]
    assert P.levels(a.withColumn("s", F.lit(None).cast("string")), "s").count() == 0


def test_nan_is_no_outlier(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 100.0, float("nan"))] + [("a", None)], "g string, v double")
    assert [r.v for r in P.boxplot_outliers(df, "g", "v").collect()] == [100.0]
    assert P.boxplot_stats(df, "g", "v").first().n_outliers == 1


def test_counts_of_any_number_of_levels(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("b", None)], "g string, t string")
    assert sorted(tuple(r) for r in P.contingency_long(df, "g", "t").collect()) == [("a", "x", 2), ("b", "y", 1)]
    assert P.contingency(df, "g", "t").columns == ["g", "x", "y"]
    most = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(ValueError, match="more than 1 levels"):
            P.contingency(df, "g", "t")
        assert P.contingency(df, "g", "t", ["y"]).filter("y = 1").count() == 1
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", most)
