import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusloom import fixtures as fx
from locusloom.functions.special import chi2_tail_1df, f_tail_1df
from locusloom.operators import kinship as K
from locusloom.operators import lmm as L


def brute_kinship(G, standardize=False, maf=0.01, miss=0.05):
    n = G.shape[1]
    total, used = np.zeros((n, n)), 0
    for x in G:
        gaps = np.isnan(x)
        if gaps.sum() > miss * n:
            continue
        mean = x[~gaps].mean()
        z = np.where(gaps, 0.0, x - mean)
        var = (z * z).sum() / n
        if var < 1e-12 or min(mean / 2, 1 - mean / 2) < maf:
            continue
        total += np.outer(z, z) / (var if standardize else 1.0)
        used += 1
    return total / used


def study(seed=1, n=40, m=120, missing=0.02):
    rng = np.random.default_rng(seed)
    freq = rng.uniform(0.05, 0.5, m)
    G = rng.binomial(2, freq[:, None], (m, n)).astype(float)
    Z = G - G.mean(axis=1, keepdims=True)
    y = Z.T @ rng.normal(0, 0.25, m) + 1.5 * G[5] + rng.normal(0, 1, n)
    G[rng.random(G.shape) < missing] = np.nan
    G[7] = 1.0
    G[8, :10] = np.nan
    return G, y


def as_geno(spark, G, parts=3):
    rows = [(i, "1", f"snp{i}", i * 10, "A", "G", [None if np.isnan(v) else float(v) for v in x]) for i, x in enumerate(G)]
    schema = "variant_id int, chrom string, rs string, pos int, a1 string, a0 string, dosage array<double>"
    return spark.createDataFrame(rows, schema).repartition(parts, "variant_id")


def as_matrix(kin, n):
    K_ = np.full((n, n), np.nan)
    for r in kin.collect():
        assert r.i <= r.j and np.isnan(K_[r.i, r.j])
        K_[r.i, r.j] = K_[r.j, r.i] = r.k
    return K_


@pytest.mark.parametrize("standardize", [False, True])
def test_kinship_against_brute_force(spark, standardize):
    G, _ = study()
    got = as_matrix(K.kinship(as_geno(spark, G), 40, standardize), 40)
    assert got == pytest.approx(brute_kinship(G, standardize), abs=1e-10)
    assert np.allclose(got, got.T) and np.allclose(got.sum(axis=0), 0, atol=1e-9)
    assert np.linalg.eigvalsh(got).min() > -1e-9
    several = as_matrix(K.kinship(as_geno(spark, G, 5), 40, standardize, side=16), 40)
    assert several == pytest.approx(got, abs=1e-10)


@pytest.mark.parametrize("side, fractions", [(7, False), (13, True), (20, False)])
def test_kinship_in_tiles(spark, monkeypatch, side, fractions):
    """Three tiles and more, several blocks of rows a task, whole and fractional dosages."""
    monkeypatch.setattr(K, "BLOCK_CELLS", 40 * 9)
    G, _ = study(seed=4)
    if fractions:
        G[::3] *= 0.9
    for standardize in (False, True):
        got = as_matrix(K.kinship(as_geno(spark, G, 6), 40, standardize, side=side), 40)
        assert got == pytest.approx(brute_kinship(G, standardize), abs=1e-10)


def test_kinship_adds_up_over_parts(spark):
    G, _ = study(seed=6)
    parts = [K.kinship_sums(as_geno(spark, G[k::3]), 40, side=16) for k in range(3)]
    got = as_matrix(K.kinship_of_sums(parts[0].unionByName(parts[1]).unionByName(parts[2])), 40)
    assert got == pytest.approx(brute_kinship(G), abs=1e-10)
    assert K.kinship_sums(as_geno(spark, np.ones((5, 40))), 40).count() == 0


def test_kinship_rejects_short_rows(spark):
    G, _ = study(m=10)
    with pytest.raises(Exception, match="must hold 41 values"):
        K.kinship_centered(as_geno(spark, G), 41).collect()


# ---------------------------------------------------------------- dense reference for the model


class Dense:
    """The model with an explicit covariance matrix, no decomposition."""

    def __init__(self, K_, y, W):
        n = len(y)
        C = np.eye(n) - 1.0 / n
        self.K, self.y, self.W, self.n = C @ K_ @ C, y, W, n

    def parts(self, A, ratio):
        Hi = np.linalg.inv(ratio * self.K + np.eye(self.n))
        S = A.T @ Hi @ A
        P = Hi - Hi @ A @ np.linalg.solve(S, A.T @ Hi)
        return P, -np.linalg.slogdet(Hi)[1], np.linalg.slogdet(S)[1], self.y @ P @ self.y

    def loglik(self, A, ratio, kind):
        _, log_h, log_s, yPy = self.parts(A, ratio)
        n = self.n
        if kind == "ml":
            return n / 2 * math.log(n / (2 * math.pi)) - n / 2 - 0.5 * log_h - n / 2 * math.log(yPy)
        f = n - A.shape[1]
        log_a = np.linalg.slogdet(A.T @ A)[1]
        return f / 2 * math.log(f / (2 * math.pi)) - f / 2 + 0.5 * log_a - 0.5 * log_h - 0.5 * log_s - f / 2 * math.log(yPy)

    def best(self, A, kind):
        grid = np.linspace(math.log(1e-5), math.log(1e5), 81)
        values = [self.loglik(A, math.exp(g), kind) for g in grid]
        i = int(np.argmax(values))
        lo, hi = grid[max(i - 1, 0)], grid[min(i + 1, 80)]
        g = (math.sqrt(5) - 1) / 2
        for _ in range(60):
            a, b = hi - g * (hi - lo), lo + g * (hi - lo)
            if self.loglik(A, math.exp(a), kind) > self.loglik(A, math.exp(b), kind):
                hi = b
            else:
                lo = a
        at = 0.5 * (lo + hi)
        return math.exp(at), self.loglik(A, math.exp(at), kind)


@pytest.fixture(scope="module")
def fitted(spark):
    G, y = study()
    rng = np.random.default_rng(3)
    W = np.c_[np.ones(40), rng.integers(0, 3, 40)]
    K_ = brute_kinship(G)
    return G, y, W, K_, L.fit_null(K_, y, W), Dense(K_, y, W)


def test_null_model_against_dense(fitted):
    G, y, W, K_, model, dense = fitted
    for kind, ratio, value in (("ml", model.ratio_ml, model.loglik_ml), ("reml", model.ratio_reml, model.loglik_reml)):
        want_ratio, want = dense.best(W, kind)
        assert value == pytest.approx(want, abs=1e-6)
        assert ratio == pytest.approx(want_ratio, rel=1e-3)
    P, _, _, yPy = dense.parts(W, model.ratio_reml)
    assert model.ve == pytest.approx(yPy / (40 - 2), rel=1e-8)
    t = np.trace(dense.K) / 40
    assert model.pve == pytest.approx(t * model.vg / (t * model.vg + model.ve))
    H = model.ratio_reml * dense.K + np.eye(40)
    V = np.linalg.inv(W.T @ np.linalg.solve(H, W))
    assert model.beta == pytest.approx((V @ W.T @ np.linalg.solve(H, y)).tolist())
    assert model.se_beta == pytest.approx(np.sqrt(np.diag(V) * model.ve).tolist())
    h = 1e-3 * model.ratio_reml
    f = lambda r: dense.loglik(W, r, "reml")
    curve = (f(model.ratio_reml + h) - 2 * f(model.ratio_reml) + f(model.ratio_reml - h)) / h**2
    assert model.se_pve == pytest.approx(t / (t * model.ratio_reml + 1) ** 2 * math.sqrt(-1 / curve), rel=1e-3)


def test_published_logs_agree_on_the_scale():
    """pve, vg and ve of three published null fits imply one scale each; two share their samples."""
    scale = lambda pve, vg, ve: pve / (1 - pve) * ve / vg
    assert scale(0.848988, 10.6163, 0.73981) == pytest.approx(0.391775, abs=2e-6)
    a, b = scale(0.942693, 38.6983, 0.906486), scale(0.193322, 0.622643, 1.00113)
    assert a == pytest.approx(b, abs=3e-6)


def test_scan_against_dense(spark, fitted):
    G, y, W, K_, model, dense = fitted
    rows = {r.rs: r for r in L.lmm_scan(as_geno(spark, G), model, "all").collect()}
    assert "snp7" not in rows and "snp8" not in rows  # one genotype only, too many gaps
    for i in (0, 5, 20, 60, 119):
        if f"snp{i}" not in rows:
            continue
        r = rows[f"snp{i}"]
        gaps = np.isnan(G[i])
        x = np.where(gaps, np.nanmean(G[i]), G[i])
        A = np.c_[W, x]
        assert (r.n_miss, r.af) == (gaps.sum(), pytest.approx(np.nanmean(G[i]) / 2))
        ratio, value = dense.best(A, "ml")
        assert r.p_lrt == pytest.approx(math.erfc(math.sqrt(max(value - dense.best(W, "ml")[1], 0.0))), rel=1e-4)
        assert r.l_mle == pytest.approx(ratio, rel=1e-3)
        assert r.l_remle == pytest.approx(dense.best(A, "reml")[0], rel=1e-3)
        P, *_ = dense.parts(W, r.l_remle)
        xx, xy, yy = x @ P @ x, x @ P @ y, y @ P @ y
        assert r.beta == pytest.approx(xy / xx, rel=1e-6)
        left = yy - xy * xy / xx
        assert r.se == pytest.approx(math.sqrt(left / (37 * xx)), rel=1e-6)
        assert r.p_wald == pytest.approx(f_tail_1df(np.array([xy * xy / xx / (left / 37)]), 37)[0], rel=1e-6)
        P, *_ = dense.parts(W, model.ratio_ml)
        xx, xy, yy = x @ P @ x, x @ P @ y, y @ P @ y
        assert r.p_score == pytest.approx(f_tail_1df(np.array([40 * xy * xy / (yy * xx)]), 37)[0], rel=1e-6)
    lrt = {r.rs: r.p_lrt for r in L.lmm_scan(as_geno(spark, G, 7), model).collect()}
    assert lrt == pytest.approx({k: r.p_lrt for k, r in rows.items()}, rel=1e-9)


def test_without_relatedness_it_is_ordinary_regression(spark):
    G, y = study(missing=0.0)
    model = L.fit_null(np.zeros((40, 40)), y)
    for r in L.lmm_scan(as_geno(spark, G), model, "all").collect():
        x = G[int(r.rs[3:])]
        A = np.c_[np.ones(40), x]
        b, res, *_ = np.linalg.lstsq(A, y, rcond=None)
        se = math.sqrt(res[0] / 38 * np.linalg.inv(A.T @ A)[1, 1])
        stat = 40 * math.log(((y - y.mean()) ** 2).sum() / res[0])
        assert (r.beta, r.se) == (pytest.approx(b[1]), pytest.approx(se))
        assert r.p_lrt == pytest.approx(math.erfc(math.sqrt(stat / 2)))


def test_samples_without_a_phenotype_are_left_out(spark):
    G, y = study()
    keep = np.ones(40, bool)
    keep[[3, 17]] = False
    K_ = brute_kinship(G)
    short = {r.rs: r for r in L.lmm_scan(as_geno(spark, G[:, keep]), L.fit_null(K_[np.ix_(keep, keep)], y[keep])).collect()}
    full_y = np.where(keep, y, np.nan)
    pheno = spark.createDataFrame([(i, None if np.isnan(v) else float(v)) for i, v in enumerate(full_y)], "sample_idx int, y double")
    kin = spark.createDataFrame([(i, j, float(K_[i, j])) for i in range(40) for j in range(i, 40)], "i int, j int, k double")
    model = L.null_model(pheno.repartition(5), kin.repartition(5))
    assert (model.n_total, model.n) == (40, 38)
    full = {r.rs: r for r in L.lmm_scan(as_geno(spark, G), model).collect()}
    assert set(full) == set(short)
    for rs in full:
        assert full[rs].p_lrt == pytest.approx(short[rs].p_lrt, rel=1e-8) and full[rs].n_miss == short[rs].n_miss


def test_traits_share_one_pass(spark, fitted):
    G, y, W, K_, model, _ = fitted
    other_y = np.where(np.arange(40) < 4, np.nan, -y)
    other = L.fit_null(K_, other_y, W)
    both = L.lmm_scan(as_geno(spark, G), {"a": model, "b": other})
    done = {}
    fits = [L.fit_null(K_, v, W, done) for v in (y, -y, other_y)]
    assert len(done) == 2 and fits[0].U is fits[1].U and fits[0].pve == pytest.approx(fits[1].pve)
    for trait, single in (("a", model), ("b", other)):
        want = {r.rs: r.p_lrt for r in L.lmm_scan(as_geno(spark, G), single).collect()}
        assert {r.rs: r.p_lrt for r in both.filter(F.col("trait") == trait).collect()} == pytest.approx(want)


def test_markers_that_follow_the_covariates(spark):
    G, y = study(missing=0.0)
    W = np.c_[np.ones(40), G[5], G[9]]
    left = {r.rs for r in L.prune_collinear(as_geno(spark, G), W).select("rs").collect()}
    assert left == {f"snp{i}" for i in range(120)} - {"snp5", "snp9", "snp7"}  # 7 does not vary
    model = L.fit_null(brute_kinship(G), y, W)
    assert not {"snp5", "snp9"} & {r.rs for r in L.lmm_scan(as_geno(spark, G), model).collect()}


def test_inputs_are_checked(spark):
    pheno = spark.createDataFrame([(i, float(i)) for i in range(6)], "sample_idx int, y double")
    kin = spark.createDataFrame([(0, 0, 1.0)], "i int, j int, k double")
    with pytest.raises(ValueError, match="one row per sample"):
        L.null_model(pheno.filter("sample_idx <> 3"), kin, n_samples=6)
    with pytest.raises(ValueError, match="one row per sample"):
        L.null_model(pheno.union(pheno.limit(1)), kin)
    whole = spark.createDataFrame([(i, j, float(i == j)) for j in range(6) for i in range(j + 1)], "i int, j int, k double")
    covar = pheno.selectExpr("sample_idx", "array(y, 1.0D) AS w")
    with pytest.raises(ValueError, match="must be all 1"):
        L.null_model(pheno, whole, covar=covar)
    with pytest.raises(ValueError, match="0 cells"):
        L.null_model(pheno, kin.filter("false"))
    assert np.array_equal(L.relatedness_matrix(whole, 6), np.eye(6))
    with pytest.raises(ValueError, match="20 cells"):
        L.relatedness_matrix(whole.filter("i <> 2 OR j <> 4"), 6)
    with pytest.raises(ValueError, match="repeats cells"):
        L.relatedness_matrix(whole.filter("i <> 2 OR j <> 4").union(whole.filter("i = 1 AND j = 4")), 6)
    with pytest.raises(ValueError, match="linearly dependent"):
        L.fit_null(np.eye(6), np.arange(6.0), np.ones((6, 2)))
    with pytest.raises(ValueError, match="too few"):
        L.fit_null(np.eye(2), np.array([1.0, 2.0]))


def test_scan_and_kinship_plans(spark, sf):
    geno = fx.geno(spark, sf)
    model = L.fit_null(np.eye(64), np.arange(64.0))
    plan = L.lmm_scan(geno, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "label" not in plan.split("ReadSchema")[1]


def test_tails():
    assert chi2_tail_1df(np.array([0.0, 3.841458820694124, 100.0])) == pytest.approx([1.0, 0.05, 1.523970604832094e-23])
    # Tabulated 5 % points of F(1, df), and the closed forms for one and two degrees of freedom.
    assert f_tail_1df(np.array([161.44764]), 1)[0] == pytest.approx(0.05, rel=1e-5)
    assert f_tail_1df(np.array([4.00119]), 60)[0] == pytest.approx(0.05, rel=1e-4)
    for f in (1e-6, 0.3, 2.0, 50.0, 1e6):
        assert f_tail_1df(np.array([f]), 1)[0] == pytest.approx(1 - 2 / math.pi * math.atan(math.sqrt(f)), rel=1e-8)
        assert f_tail_1df(np.array([f]), 2)[0] == pytest.approx(1 - math.sqrt(f / (f + 2)), rel=1e-7)
    assert np.isnan(f_tail_1df(np.array([np.nan]), 5)[0])
