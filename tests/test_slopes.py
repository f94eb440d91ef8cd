"""Slopes at a given variance ratio against dense matrices."""

import numpy as np
import pytest
from test_model import as_geno, study

from locusloom.operators.slopes import slope_scan


def tables(spark, K, y, W=None):
    d, U = np.linalg.eigh(K)
    n = len(y)
    basis = spark.createDataFrame([(i, k, float(U[i, k])) for i in range(n) for k in range(n)], "sample_idx int, k int, u double")
    spectrum = spark.createDataFrame([(k, float(v)) for k, v in enumerate(d)], "k int, d double")
    pheno = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "sample_idx int, y double")
    covar = None if W is None else spark.createDataFrame([(i, [float(v) for v in w]) for i, w in enumerate(W)], "sample_idx int, w array<double>")
    return basis, spectrum, pheno, covar


def dense(G, y, W, K, ratio):
    n, found = len(y), {}
    V = np.linalg.inv(ratio * K + np.eye(n))
    P = V - V @ W @ np.linalg.inv(W.T @ V @ W) @ W.T @ V
    free = n - W.shape[1] - 1
    for i, x in enumerate(G):
        gaps = np.isnan(x)
        mean = x[~gaps].mean()
        x = np.where(gaps, mean, x)
        if gaps.sum() > 0.05 * n or min(mean / 2, 1 - mean / 2) < 0.05 or x.min() == x.max():
            continue
        xx, xy, yy = x @ P @ x, x @ P @ y, y @ P @ y
        left = yy - xy * xy / xx
        found[f"snp{i}"] = [xy / xx, np.sqrt(left / free / xx), xy * xy / xx / (left / free), n * xy * xy / (yy * xx)]
    return found


@pytest.mark.parametrize("covariates", [False, True])
def test_slopes_against_dense_matrices(spark, covariates):
    G, y = study()
    n = len(y)
    Z = np.nan_to_num(G - np.nanmean(G, axis=1, keepdims=True))
    K = Z.T @ Z / len(Z)
    rng = np.random.default_rng(2)
    W = np.column_stack([np.ones(n), rng.normal(size=n), rng.integers(0, 2, n)]) if covariates else np.ones((n, 1))
    # A covariate that the others determine changes nothing.
    given = np.column_stack([W, W[:, 0] + 2 * W[:, 1]]) if covariates else None
    geno = as_geno(spark, G)
    geno = geno.union(geno.filter("rs in ('snp5', 'snp9')"))  # repeated rows come back repeated
    rows = slope_scan(geno, *tables(spark, K, y, given)[:3], n, 0.7, covar=tables(spark, K, y, given)[3], block_cells=7 * n).collect()
    want = dense(G, y, W, K, 0.7)
    assert sorted(r.rs for r in rows) == sorted([*want, *[s for s in ("snp5", "snp9") if s in want]])
    for r in rows:
        assert [r.beta, r.se, r.f_wald, r.f_score] == pytest.approx(want[r.rs], rel=1e-8, abs=1e-10)


def test_slopes_of_odd_tables(spark):
    G, y = study(n=20, m=12, missing=0)
    basis, spectrum, pheno, _ = tables(spark, np.eye(20), y)
    assert slope_scan(as_geno(spark, G).limit(0), basis, spectrum, pheno, 20, 1.0).count() == 0
    covar = spark.createDataFrame([(i, [1.0, float(v)]) for i, v in enumerate(G[5])], "sample_idx int, w array<double>")
    found = {r.rs: r.beta for r in slope_scan(as_geno(spark, G), basis, spectrum, pheno, 20, 1.0, covar=covar).collect()}
    assert found["snp5"] is None and any(v is not None for v in found.values())
    with pytest.raises(ValueError, match="cells"):
        slope_scan(as_geno(spark, G), basis.filter("k < 19"), spectrum, pheno, 20, 1.0)
    with pytest.raises(ValueError, match="phenotype"):
        slope_scan(as_geno(spark, G), basis, spectrum, pheno.filter("sample_idx > 0"), 20, 1.0)
