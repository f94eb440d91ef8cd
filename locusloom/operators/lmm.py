"""Univariate linear mixed model: one null fit on the driver, one narrow scan over markers.

Model y = W a + x b + u + e with u ~ N(0, vg K), e ~ N(0, ve I), following the published
exact method of Zhou and Stephens (2012). With K = U diag(d) U' everything is rotated by U'
once; for a variance ratio r the weights are w = 1 / (r d + 1). The sample-by-sample matrix is
small (thousands of samples) and lives on the driver and in one broadcast; the markers, the
part that grows, stay distributed and are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrow import dosage_matrix, fill_with_mean
from ..functions.special import chi2_tail_1df, f_tail_1df
from ..session import ship_package

# The range searched for the variance ratio.
RATIO_MIN, RATIO_MAX = 1e-5, 1e5
GRID_STEPS = 40
CHUNK_CELLS = 256_000

MARKER_COLUMNS = ("chrom", "rs", "pos", "a1", "a0", "dosage")
LRT_SCHEMA = (
    "chr string, rs string, ps long, n_miss int, allele1 string, allele0 string, af double, "
    "l_mle double, p_lrt double"
)
ALL_SCHEMA = (
    "chr string, rs string, ps long, n_miss int, allele1 string, allele0 string, af double, "
    "beta double, se double, l_remle double, l_mle double, p_wald double, p_lrt double, p_score double"
)

NULL_SCHEMA = (
    "n_total int, n_analyzed int, n_covariates int, loglik_reml double, loglik_ml double, pve double, se_pve double, "
    "vg double, ve double, beta array<double>, se_beta array<double>"
)


@dataclass
class NullModel:
    """The rotated sample-space basis and the fit without a marker."""

    keep: np.ndarray  # ordinals of the analysed samples
    n_total: int
    U: np.ndarray
    d: np.ndarray
    Wr: np.ndarray  # U'W
    yr: np.ndarray  # U'y
    W: np.ndarray
    ratio_ml: float = 0.0
    ratio_reml: float = 0.0
    loglik_ml: float = 0.0
    loglik_reml: float = 0.0
    pve: float = 0.0
    se_pve: float = 0.0
    vg: float = 0.0
    ve: float = 0.0
    beta: list[float] = field(default_factory=list)
    se_beta: list[float] = field(default_factory=list)

    @property
    def n(self) -> int:
        return len(self.yr)

    def summary(self, spark: SparkSession, **labels) -> DataFrame:
        """One row with the run's null-model numbers, behind any label columns."""
        row = [(
            int(self.n_total), int(self.n), int(self.W.shape[1]), float(self.loglik_reml), float(self.loglik_ml),
            float(self.pve), float(self.se_pve), float(self.vg), float(self.ve),
            [float(b) for b in self.beta], [float(s) for s in self.se_beta],
        )]
        df = spark.createDataFrame(row, NULL_SCHEMA)
        return df.select(*[F.lit(v).alias(k) for k, v in labels.items()], *df.columns)


# ---------------------------------------------------------------- likelihoods for many markers


class _Profile:
    """Likelihoods of many markers as functions of one variance ratio per marker.

    ``X`` holds rotated markers, one per row, or is None for the model without a marker. The
    marker and the phenotype enter as residuals of an unweighted regression on the covariates:
    the fitted model is the same, and differences of large weighted sums are avoided. All
    weighted sums of covariates are matrix products of the weights with fixed columns.
    """

    def __init__(self, d: np.ndarray, W: np.ndarray, y: np.ndarray, X: np.ndarray | None):
        # An orthonormal basis of the covariates, the intercept first, keeps the weighted
        # equations well conditioned at extreme ratios; both likelihoods depend on its span only.
        W = np.linalg.qr(W)[0]
        self.d, self.W = d, W
        self.y = y - W @ (W.T @ y)
        self.X = None if X is None else X - (X @ W) @ W.T
        self.n, self.c = W.shape
        self.q = self.c + (X is not None)
        self.WW = (W[:, :, None] * W[:, None, :]).reshape(self.n, -1)
        self.log_det_AA = 0.0
        if X is not None:
            with np.errstate(divide="ignore"):
                self.log_det_AA = np.log((self.X * self.X).sum(axis=1))

    def rows(self, pick: np.ndarray) -> _Profile:
        """The same profile for a subset of the markers."""
        part = object.__new__(_Profile)
        part.__dict__.update(self.__dict__)
        if self.X is not None:
            part.X, part.log_det_AA = self.X[pick], self.log_det_AA[pick]
        return part

    def _solve(self, w: np.ndarray):
        """Weighted normal equations per row: inverse of the covariate block, the projected
        marker ``k``, the marker's remaining weight ``s`` and the residual of y."""
        S = (w @ self.WW).reshape(-1, self.c, self.c)
        inv = 1.0 / S if self.c == 1 else np.linalg.inv(S)
        by = np.matmul(inv, (w @ (self.W * self.y[:, None]))[:, :, None])[:, :, 0]
        if self.X is None:
            return S, inv, None, None, self.y - by @ self.W.T
        wX = w * self.X
        Sx = wX @ self.W
        k = np.matmul(inv, Sx[:, :, None])[:, :, 0]
        s = np.einsum("bn,bn->b", wX, self.X) - (Sx * k).sum(axis=1)
        slope = (wX @ self.y - (Sx * by).sum(axis=1)) / s
        left = self.X - k @ self.W.T
        return S, inv, k, s, self.y - by @ self.W.T - slope[:, None] * left

    def weights(self, ratio: np.ndarray) -> np.ndarray:
        return 1.0 / (ratio[:, None] * self.d[None, :] + 1.0)

    def _value(self, kind: str, log_w, log_det_S, log_det_AA, yPy):
        n, f = self.n, self.n - self.q
        if kind == "ml":
            return n / 2 * math.log(n / (2 * math.pi)) - n / 2 + 0.5 * log_w - n / 2 * np.log(yPy)
        return (
            f / 2 * math.log(f / (2 * math.pi))
            - f / 2
            + 0.5 * log_det_AA
            + 0.5 * log_w
            - 0.5 * log_det_S
            - f / 2 * np.log(yPy)
        )

    def loglik(self, kind: str, ratio: np.ndarray) -> np.ndarray:
        w = self.weights(ratio)
        S, _, _, s, r = self._solve(w)
        log_det = np.linalg.slogdet(S)[1] + (0.0 if s is None else np.log(s))
        return self._value(kind, np.log(w).sum(axis=1), log_det, self.log_det_AA, np.einsum("bn,bn,bn->b", w, r, r))

    def slope(self, kind: str, ratio: np.ndarray) -> np.ndarray:
        """Derivative of the log-likelihood in the logarithm of the ratio."""
        w = self.weights(ratio)
        _, inv, k, s, r = self._solve(w)
        wr = w * r
        yPy, ydy = np.einsum("bn,bn->b", wr, r), (wr * wr) @ self.d
        trace = w @ self.d
        size = self.n
        if kind == "reml":
            size = self.n - self.q
            wwd = w * w * self.d
            T = (wwd @ self.WW).reshape(-1, self.c, self.c)
            trace = trace - np.einsum("bij,bji->b", inv, T)
            if k is not None:
                left = self.X - k @ self.W.T
                trace = trace - np.einsum("bn,bn,bn->b", wwd, left, left) / s
        return ratio * (-0.5 * trace + size / 2 * ydy / yPy)

    def grid(self, kind: str) -> np.ndarray:
        """(markers, grid) log-likelihoods; one ratio serves all markers, so the marker sums
        are matrix products over the whole batch."""
        w = self.weights(np.exp(_GRID))
        S = (w @ self.WW).reshape(-1, self.c, self.c)
        inv = np.linalg.inv(S)
        Sy = w @ (self.W * self.y[:, None])
        by = np.matmul(inv, Sy[:, :, None])[:, :, 0]
        yPy = w @ (self.y * self.y) - (Sy * by).sum(axis=1)
        log_w, log_det = np.log(w).sum(axis=1), np.linalg.slogdet(S)[1]
        if self.X is None:
            return self._value(kind, log_w, log_det, self.log_det_AA, yPy)[None, :]
        xx, xy = (self.X * self.X) @ w.T, (self.X * self.y) @ w.T
        xW = np.stack([(self.X * self.W[:, i]) @ w.T for i in range(self.c)], axis=2)
        xx = xx - np.einsum("bgi,gij,bgj->bg", xW, inv, xW)
        xy = xy - np.einsum("bgi,gi->bg", xW, by)
        with np.errstate(invalid="ignore", divide="ignore"):
            return self._value(kind, log_w, log_det + np.log(xx), self.log_det_AA[:, None], yPy - xy * xy / xx)

    def maximise(self, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """``(ratio, log-likelihood)`` at the maximum for every marker.

        The best grid point brackets the maximum, then a bracketed secant on the slope, with a
        bisection every third step, narrows all open brackets together. A maximum at either
        end of the range stays there.
        """
        grid = self.grid(kind)
        best = np.argmax(np.where(np.isnan(grid), -np.inf, grid), axis=1)
        lo, hi = _GRID[np.maximum(best - 1, 0)].copy(), _GRID[np.minimum(best + 1, GRID_STEPS)].copy()
        f_lo, f_hi = self.slope(kind, np.exp(lo)), self.slope(kind, np.exp(hi))
        at = np.where((best == 0) & (f_lo <= 0), lo, np.where((best == GRID_STEPS) & (f_hi >= 0), hi, np.nan))
        todo = np.flatnonzero(np.isnan(at))
        part, lo, hi, f_lo, f_hi = self.rows(todo), lo[todo], hi[todo], f_lo[todo], f_hi[todo]
        for step in range(100):
            if not len(todo):
                break
            with np.errstate(invalid="ignore", divide="ignore"):
                mid = hi - f_hi * (hi - lo) / (f_hi - f_lo)
            mid = np.where((mid > lo) & (mid < hi) & (step % 3 != 2), mid, 0.5 * (lo + hi))
            f = part.slope(kind, np.exp(mid))
            up = f > 0
            lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
            f_lo, f_hi = np.where(up, f, 0.5 * f_lo), np.where(up, 0.5 * f_hi, f)
            at[todo] = mid
            open_ = ~((hi - lo < 1e-12) | (np.abs(f) < 1e-11))
            if not open_.all():
                todo, lo, hi, f_lo, f_hi = todo[open_], lo[open_], hi[open_], f_lo[open_], f_hi[open_]
                part = part.rows(open_)
        value = self.loglik(kind, np.exp(at))
        peak = grid[np.arange(len(best)), best]
        fell = ~(value >= peak - 1e-9)  # a bracket with several extremes: keep the grid point
        return np.exp(np.where(fell, _GRID[best], at)), np.where(fell, peak, value)

    def projected(self, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(x'Px, x'Py, y'Py)`` with the covariates projected out at each marker's ratio."""
        w = self.weights(ratio)
        _, inv, k, s, _ = self._solve(w)
        by = np.matmul(inv, (w @ (self.W * self.y[:, None]))[:, :, None])[:, :, 0]
        ry = self.y - by @ self.W.T
        rx = self.X - k @ self.W.T
        wy = w * ry
        return s, np.einsum("bn,bn->b", wy, rx), np.einsum("bn,bn->b", wy, ry)


_GRID = np.linspace(math.log(RATIO_MIN), math.log(RATIO_MAX), GRID_STEPS + 1)


# ---------------------------------------------------------------- null model


Decomposed = dict[bytes, tuple[np.ndarray, np.ndarray]]


def _decompose(K: np.ndarray, keep: np.ndarray, done: Decomposed) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of the centred matrix of the kept samples, computed once per set."""
    key = keep.tobytes()
    if key not in done:
        part = K[np.ix_(keep, keep)]
        part = part - part.mean(axis=0)[None, :] - part.mean(axis=1)[:, None] + part.mean()
        d, U = np.linalg.eigh((part + part.T) / 2)
        done[key] = np.where(d < 1e-10, 0.0, d), U
    return done[key]


def fit_null(
    K: np.ndarray, y: np.ndarray, W: np.ndarray | None = None, decomposed: Decomposed | None = None
) -> NullModel:
    """Fit without a marker. Samples whose ``y`` or covariates are NaN are left out of y, W and K
    first. ``decomposed`` keeps decompositions for further traits of the same samples."""
    y = np.asarray(y, dtype=float)
    W = np.ones((len(y), 1)) if W is None else np.asarray(W, dtype=float)
    if K.shape != (len(y), len(y)) or len(W) != len(y):
        raise ValueError("relatedness, phenotype and covariates must cover the same samples")
    keep = np.flatnonzero(~np.isnan(y) & ~np.isnan(W).any(axis=1))
    yk, Wk = y[keep], W[keep]
    n, c = Wk.shape
    if n <= c + 1:
        raise ValueError(f"{n} samples with a phenotype are too few for {c} covariate(s)")
    if np.linalg.matrix_rank(Wk) < c:
        raise ValueError("the covariates of the analysed samples are linearly dependent")
    d, U = _decompose(K, keep, {} if decomposed is None else decomposed)
    model = NullModel(keep, len(y), U, d, U.T @ Wk, U.T @ yk, Wk)

    profile = _Profile(d, model.Wr, model.yr, None)
    ratio, value = profile.maximise("ml")
    model.ratio_ml, model.loglik_ml = float(ratio[0]), float(value[0])
    ratio, value = profile.maximise("reml")
    r = model.ratio_reml = float(ratio[0])
    model.loglik_reml = float(value[0])

    w = 1.0 / (r * d + 1.0)
    weighted = model.Wr * w[:, None]
    inv_S = np.linalg.inv(weighted.T @ model.Wr)
    beta = inv_S @ (weighted.T @ model.yr)
    left = model.yr - model.Wr @ beta
    model.ve = float(w @ (left * left)) / (n - c)
    model.vg = r * model.ve
    model.beta = beta.tolist()
    model.se_beta = np.sqrt(np.diag(inv_S) * model.ve).tolist()
    share = d.sum() / n
    model.pve = share * r / (share * r + 1.0)
    model.se_pve = _se_pve(share, r, d, model.Wr, w, inv_S, left)
    return model


def _se_pve(share: float, r: float, d, Wr, w, inv_S, left) -> float:
    """Delta-method standard error from the curvature of the restricted log-likelihood."""
    n, c = Wr.shape
    WO = Wr * w[:, None]
    # trace((P D)^2) with P = diag(w) - WO inv_S WO', without forming the n x n matrix.
    cross1 = WO.T @ (Wr * (w * d * d * w)[:, None])
    half = inv_S @ (WO.T @ (WO * d[:, None]))
    trace_pdpd = float(np.sum((w * d) ** 2) - 2.0 * np.trace(inv_S @ cross1) + np.trace(half @ half))
    Py = w * left
    DPy = d * Py
    PDPy = w * DPy - WO @ (inv_S @ (WO.T @ DPy))
    yPy, ydy, ydpdy = float(Py @ left), float(Py @ DPy), float(DPy @ PDPy)
    curvature = 0.5 * trace_pdpd - 0.5 * (n - c) * (2.0 * ydpdy * yPy - ydy * ydy) / (yPy * yPy)
    if curvature >= 0:
        return float("nan")
    return share / (share * r + 1.0) ** 2 * math.sqrt(-1.0 / curvature)


def relatedness_matrix(kin: DataFrame, n: int) -> np.ndarray:
    """``kin(i, j, k)`` with i <= j as a dense matrix of 8 n^2 bytes on the driver.

    The cells are counted before they are fetched: exactly one for each pair of samples.
    """
    ends = kin.agg(F.count("*"), F.min("i"), F.max("j"), F.count_if(F.col("i") > F.col("j"))).first()
    if tuple(ends) != (n * (n + 1) // 2, 0, n - 1, 0):
        raise ValueError(f"the relatedness table has {ends[0]} cells for {n} samples")
    cells = kin.select("i", "j", "k").toArrow()
    i, j, k = (cells[c].to_numpy() for c in ("i", "j", "k"))
    K = np.full((n, n), np.nan)
    K[i, j] = k
    K[j, i] = k
    if np.isnan(K).any():
        raise ValueError("the relatedness table repeats cells or has empty ones")
    return K


def _per_sample(df: DataFrame, value: str, n: int | None, what: str) -> list:
    """Values in sample order; every ordinal must occur exactly once."""
    count = df.count()
    if n is not None and count != n:
        raise ValueError(f"{what} must have one row per sample: {count} rows for {n} samples")
    rows = df.select("sample_idx", value).toArrow()
    found = dict(zip(rows["sample_idx"].to_pylist(), rows[value].to_pylist()))
    n = n or rows.num_rows
    if rows.num_rows != n or sorted(found) != list(range(n)):
        raise ValueError(f"{what} must have one row per sample: {rows.num_rows} rows for {n} samples")
    return [found[i] for i in range(n)]


def null_model(
    pheno: DataFrame,
    kin: DataFrame | np.ndarray,
    trait: str = "y",
    covar: DataFrame | None = None,
    n_samples: int | None = None,
    decomposed: Decomposed | None = None,
) -> NullModel:
    """``fit_null`` on tables: ``pheno(sample_idx, <trait>)``, ``kin(i, j, k)`` with i <= j (or its
    matrix) and optionally ``covar(sample_idx, w array<double>)``.

    The tables live in sample space and are collected: 8 n^2 bytes for n samples.
    """
    y = np.array(_per_sample(pheno, trait, n_samples, "phenotypes"), dtype=float)
    K = kin if isinstance(kin, np.ndarray) else relatedness_matrix(kin, len(y))
    W = None
    if covar is not None:
        W = np.array(_per_sample(covar, "w", len(y), "covariates"), dtype=float)
        if not np.all(W[:, 0] == 1.0):
            raise ValueError("the first covariate column must be all 1")
    return fit_null(K, y, W, decomposed)


# ---------------------------------------------------------------- marker scan


def _r_squared(x: np.ndarray, W: np.ndarray) -> np.ndarray:
    """Share of each row's variance explained by the covariates; NaN for a row without variance."""
    Q, _ = np.linalg.qr(W)
    centred = x - x.mean(axis=1, keepdims=True)
    total = (centred * centred).sum(axis=1)
    left = x - (x @ Q) @ Q.T
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(total > 1e-12, 1.0 - (left * left).sum(axis=1) / total, np.nan)


def marker_mask(raw: np.ndarray, W: np.ndarray, maf: float, max_missing: float, r2: float):
    """``(keep, filled, n_miss, af)``: gaps filled with the marker mean; markers that are mostly
    missing, too rare, show one genotype only or follow the covariates are not kept."""
    x, n_miss, mean = fill_with_mean(raw)
    af = mean / 2.0
    with np.errstate(invalid="ignore"):
        keep = (n_miss <= max_missing * raw.shape[1]) & (np.minimum(af, 1.0 - af) >= maf)
        keep &= np.nanmax(np.where(np.isnan(raw), -np.inf, raw), axis=1) > np.nanmin(
            np.where(np.isnan(raw), np.inf, raw), axis=1
        )
    if W.shape[1] > 1:
        keep &= np.nan_to_num(_r_squared(np.where(np.isnan(x), 0.0, x), W), nan=1.0) < r2
    return keep, x, n_miss, af


def scan_block(model: NullModel, x: np.ndarray, test: str) -> dict[str, np.ndarray]:
    """Test statistics for filled dosages of the analysed samples, one marker per row."""
    profile = _Profile(model.d, model.Wr, model.yr, x @ model.U)
    ratio_ml, loglik = profile.maximise("ml")
    stat = np.maximum(2.0 * (loglik - model.loglik_ml), 0.0)
    out = {"l_mle": ratio_ml, "p_lrt": chi2_tail_1df(stat)}
    if test == "lrt":
        return out
    free = model.n - profile.c - 1
    ratio_reml, _ = profile.maximise("reml")
    xx, xy, yy = profile.projected(ratio_reml)
    beta = xy / xx
    left = yy - xy * beta
    out["l_remle"] = ratio_reml
    out["beta"] = beta
    out["se"] = np.sqrt(left / (free * xx))
    out["p_wald"] = f_tail_1df(xy * beta / (left / free), free)
    xx, xy, yy = profile.projected(np.full(len(x), model.ratio_ml))
    out["p_score"] = f_tail_1df(model.n * xy * xy / (yy * xx), free)
    return out


def lmm_scan(
    geno: DataFrame,
    models: NullModel | Mapping[str, NullModel],
    test: str = "lrt",
    maf: float = 0.05,
    max_missing: float = 0.05,
    r2: float = 0.9999,
) -> DataFrame:
    """Test every marker of ``geno(chrom, rs, pos, a1, a0, dosage)``.

    ``test='lrt'`` gives the likelihood ratio columns, ``'all'`` adds slope, standard error,
    Wald and score tests. Covariates come with the null model. A mapping of trait name to
    model tests all traits in one pass over the genotypes and adds a ``trait`` column.
    The scan is narrow: it reads the columns it needs, moves no rows and needs no driver step.
    """
    if test not in ("lrt", "all"):
        raise ValueError("test must be 'lrt' or 'all'")
    ship_package(geno.sparkSession)
    several = isinstance(models, Mapping)
    shared = geno.sparkSession.sparkContext.broadcast(dict(models) if several else {"": models})
    schema = LRT_SCHEMA if test == "lrt" else ALL_SCHEMA
    names = [part.split()[0] for part in schema.split(", ")]
    stats = names[7:]

    def test_markers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        traits = shared.value
        for batch in batches:
            for trait, model in traits.items():
                rows = max(1, CHUNK_CELLS // (model.n * (model.W.shape[1] + 1)))
                for start in range(0, batch.num_rows, rows):
                    part = batch.slice(start, rows)
                    raw = dosage_matrix(part, "dosage", model.n_total)[:, model.keep]
                    keep, x, n_miss, af = marker_mask(raw, model.W, maf, max_missing, r2)
                    if not keep.any():
                        continue
                    found = scan_block(model, x[keep], test)
                    kept = pa.array(keep)
                    columns = [part.column(c).filter(kept) for c in ("chrom", "rs", "pos")]
                    columns.append(pa.array(n_miss[keep], pa.int32()))
                    columns += [part.column(c).filter(kept) for c in ("a1", "a0")]
                    columns.append(pa.array(af[keep], pa.float64()))
                    columns += [pa.array(found[s], pa.float64(), from_pandas=True) for s in stats]
                    if several:
                        columns.insert(0, pa.array([trait] * int(keep.sum()), pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, (["trait"] if several else []) + names)

    typed = geno.select(*MARKER_COLUMNS).withColumn("pos", F.col("pos").cast("bigint"))
    return typed.mapInArrow(test_markers, ("trait string, " if several else "") + schema)


def prune_collinear(geno: DataFrame, W: np.ndarray, r2: float = 0.9999) -> DataFrame:
    """Drop markers whose dosage the covariates (nearly) determine. Rows keep all columns."""
    ship_package(geno.sparkSession)
    W = np.asarray(W, dtype=float)
    shared = geno.sparkSession.sparkContext.broadcast(W)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, _, _ = fill_with_mean(dosage_matrix(batch, "dosage", len(shared.value)))
                keep = np.nan_to_num(_r_squared(np.where(np.isnan(x), 0.0, x), shared.value), nan=1.0) < r2
                yield batch.filter(pa.array(keep))

    return geno.mapInArrow(prune, geno.schema)
