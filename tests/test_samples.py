import pytest

from locusloom.functions.naming import run_label
from locusloom.operators import report as RP
from locusloom.operators import samples as SA


@pytest.fixture
def samples(spark):
    return spark.createDataFrame([(0, "1001"), (1, "1002"), (2, "1003")], "sample_idx int, sample_id string")


def test_phenotypes_take_sample_order(spark, samples):
    pheno = spark.createDataFrame([("1003", 15.3), ("1001", 12.3), ("9999", 1.0)], "sample_id string, height double")
    aligned = SA.sample_order(SA.align_phenotypes(samples, pheno)).collect()
    assert [tuple(r) for r in aligned] == [(0, "1001", 12.3), (1, "1002", None), (2, "1003", 15.3)]
    check = SA.check_counts(samples, pheno, "sample_id").first()
    assert (check.n_samples, check.n_phenotypes, check.only_samples, check.only_phenotypes, check.same_count, check.ok) == (3, 3, 1, 1, True, False)
    with pytest.raises(ValueError, match="check failed"):
        SA.require_ok(SA.check_counts(samples, pheno.limit(1), "sample_id"))


def test_traits_by_ordinal(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0, 3.0)], "sample_idx int, a double, b double, c double")
    assert SA.select_traits(df, [3, 1]).columns == ["sample_idx", "c", "a"]


def test_fam_gets_the_trait_by_ordinal_not_row_order(spark, samples):
    fam = samples.selectExpr("sample_idx", "sample_id", "-9.0D AS phenotype")
    pheno = spark.createDataFrame([(2, 15.3), (0, 12.3), (1, 13.4)], "sample_idx int, y double")
    got = {r.sample_id: r.phenotype for r in SA.paste_phenotype(fam, pheno, "y").collect()}
    assert got == {"1001": 12.3, "1002": 13.4, "1003": 15.3}
    got = {r.sample_id: r.phenotype for r in SA.paste_phenotype(fam, pheno.filter("sample_idx <> 1"), "y").collect()}
    assert got == {"1001": 12.3, "1002": None, "1003": 15.3}


def test_covariate_checks(spark, samples):
    good = spark.createDataFrame([(i, [1.0, c]) for i, c in enumerate([1.0, 1.0, 0.0])], "sample_idx int, w array<double>")
    assert SA.check_covariates(good, samples).first().ok
    assert not SA.check_covariates(good.limit(2), samples).first().ok
    bad = good.selectExpr("sample_idx", "transform(w, x -> x * 2) AS w")
    row = SA.check_covariates(bad, samples).first()
    assert not row.intercept_ok and not row.ok
    assert not SA.check_covariates(good.filter("false"), samples).first().ok


def test_line_checks(spark):
    df = spark.createDataFrame([("12.3",), ("",), ("13.4\r",), ("tall",), ("1\t2",), ("NA",), ("1\tx",)], "value string")
    row = SA.check_values(df).first()
    assert (row.n_lines, row.n_empty, row.n_carriage_return, row.n_not_numeric, row.ok) == (7, 1, 1, 2, False)


def test_covariates_from_markers(spark):
    geno = spark.createDataFrame(
        [("a", [1.0, 1.0, 0.0, 0.0]), ("b", [2.0, None, 0.0, 1.0]), ("twice", [0.0] * 4), ("twice", [0.0] * 4)],
        "rs string, dosage array<double>",
    )
    w = {r.sample_idx: r.w for r in SA.covariate_from_snp(geno, ["a"]).collect()}
    assert w == {0: [1.0, 1.0], 1: [1.0, 1.0], 2: [1.0, 0.0], 3: [1.0, 0.0]}
    w = {r.sample_idx: r.w for r in SA.covariate_from_snp(geno, ["b", "a"]).collect()}
    assert w[1] == [1.0, 1.0, 1.0] and w[0] == [1.0, 2.0, 1.0]
    for names in (["a", "absent"], ["twice"]):
        with pytest.raises(Exception, match="absent or occurs twice"):
            SA.covariate_from_snp(geno, names).collect()


def test_explained_share_of_a_covariate(spark):
    runs = lambda pve, beta: spark.createDataFrame([("t", pve, beta)], "trait string, pve double, beta array<double>")
    row = RP.compare_runs(runs(0.942693, [8.3849]), runs(0.193322, [11.1001, -8.34676])).first()
    assert row.pve_delta == pytest.approx(0.749371) and row.beta_c == [11.1001, -8.34676]


def test_labels():
    assert run_label("/data/x/height.tsv") == "height"
    assert run_label("height.v2.tsv", "./covar/snp_4.txt") == "height.v2_snp_4"
