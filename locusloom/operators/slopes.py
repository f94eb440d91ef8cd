"""Slopes and score tests of all markers at a given variance ratio, as joins and sums.

With the relatedness given by its eigenvectors (a table of cells) and eigenvalues, a marker needs a few
weighted sums of its rotated dosages. The rotation is a product of two tables cut into blocks: blocks
of eigenvectors of a bounded size meet the markers by the block's number, each meeting leaves a few sums,
and these are combined before they travel. No matrix of samples by samples is collected or broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genotype import called_count, dosage_sum
from ..session import cut_lineage, require_columns

#: Cells of the eigenvectors in a block, 1 MB.
BLOCK_CELLS = 131_072
_MARKER = ("chrom", "rs", "pos", "a1", "a0")


def _dot(u: Column, x: Column) -> Column:
    return F.aggregate(F.zip_with(u, x, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def rotated_null(basis: DataFrame, spectrum: DataFrame, pheno: DataFrame, ratio: float, trait: str = "y", covar: DataFrame | None = None) -> tuple[DataFrame, int, float]:
    """``(components, covariates, yy)``: of each eigenvector ``k`` its weight ``w`` = 1 / (ratio d + 1), the rotated
    phenotype ``e`` without its share of the covariates, and the rotated covariates ``q``, made
    orthonormal under the weights; ``yy`` is the weighted sum of squares of ``e``.

    A covariate that the earlier ones determine is left out. Only sums over all components reach the driver.
    """
    n_covar = 1 if covar is None else covar.agg(F.max(F.size("w"))).first()[0]
    given = pheno.select("sample_idx", F.col(trait).cast("double").alias("y"))
    given = given.withColumn("w", F.array(F.lit(1.0))) if covar is None else given.join(covar.select("sample_idx", "w"), "sample_idx")
    sums = [F.sum(F.col("u") * F.get("w", F.lit(j))).alias(f"c{j}") for j in range(n_covar)]
    rotated = basis.join(given, "sample_idx").groupBy("k").agg(F.sum(F.col("u") * F.col("y")).alias("e"), *sums)
    weight = (1.0 / (F.lit(float(ratio)) * F.col("d") + 1.0)).alias("w")
    parts = cut_lineage(rotated.join(spectrum, "k").select("k", weight, "e", *[f"c{j}" for j in range(n_covar)]))
    kept: list[str] = []
    for c in [f"c{j}" for j in range(n_covar)]:
        before = _squares(parts, c)
        parts = _without(parts, c, kept)
        left = _squares(parts, c)
        if left > 1e-10 * before:
            parts = parts.withColumn(c, F.col(c) / math.sqrt(left))
            kept.append(c)
    parts = cut_lineage(_without(parts, "e", kept).select("k", "w", "e", F.array(*kept).alias("q")))
    return parts, len(kept), _squares(parts, "e")


def _squares(parts: DataFrame, c: str) -> float:
    return parts.agg(F.sum(F.col("w") * F.col(c) * F.col(c))).first()[0] or 0.0


def _without(parts: DataFrame, c: str, kept: list[str]) -> DataFrame:
    """``c`` without its share of the ``kept`` columns; taken off twice, so that rounding leaves nothing of them."""
    for _ in range(2 if kept else 0):
        share = parts.agg(*[F.sum(F.col("w") * F.col(c) * F.col(q)).alias(q) for q in kept]).first()
        parts = parts.withColumn(c, F.col(c) - sum(F.lit(share[q] or 0.0) * F.col(q) for q in kept))
    return parts


def _blocks(basis: DataFrame, components: DataFrame, n_samples: int, block_cells: int) -> tuple[DataFrame, int]:
    """Eigenvectors with their component's numbers, in rows of at most ``block_cells`` cells (or one vector)."""
    size = max(1, block_cells // n_samples)
    vector = F.transform(F.array_sort(F.collect_list(F.struct("sample_idx", "u"))), lambda s: s["u"]).alias("u")
    vectors = basis.groupBy("k").agg(vector).join(components, "k")
    number = F.floor(F.col("k") / size).cast("int").alias("block")
    blocks = vectors.groupBy(number).agg(F.collect_list(F.struct("w", "e", "q", "u")).alias("vectors"))
    return cut_lineage(blocks), -(-n_samples // size)


def slope_scan(
    geno: DataFrame,
    basis: DataFrame,
    spectrum: DataFrame,
    pheno: DataFrame,
    n_samples: int,
    ratio: float,
    trait: str = "y",
    covar: DataFrame | None = None,
    maf: float = 0.05,
    max_missing: float = 0.05,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """``chr, rs, ps, n_miss, allele1, allele0, af, beta, se, f_wald, f_score`` of each marker of
    ``geno(chrom, rs, pos, a1, a0, dosage)`` at the variance ratio ``ratio``; both statistics have 1 and
    n - c - 1 degrees of freedom.

    ``basis(sample_idx, k, u)`` has the cells of the eigenvectors of the relatedness, ``spectrum(k, d)`` its
    eigenvalues, k from 0; ``covar(sample_idx, w)`` the covariates, an intercept where it is absent. Gaps
    take the marker's mean. Markers with too many gaps, too rare, or of one genotype only are left
    out; a marker that the covariates determine has null statistics. Repeated rows come back repeated, an empty
    table gives no rows. A basis that is not n by n, or a sample without a phenotype, is an error.
    """
    require_columns(geno, *_MARKER, "dosage")
    shape = basis.agg(F.count("*"), F.min("k"), F.max("k"), F.min("sample_idx"), F.max("sample_idx")).first()
    if tuple(shape) != (n_samples * n_samples, 0, n_samples - 1, 0, n_samples - 1):
        raise ValueError(f"the basis has {shape[0]} cells for {n_samples} samples")
    if pheno.filter(F.col(trait).isNotNull()).select("sample_idx").distinct().count() != n_samples:
        raise ValueError(f"not every one of {n_samples} samples has a phenotype")
    components, c, yy = rotated_null(basis, spectrum, pheno, ratio, trait, covar)
    blocks, n_blocks = _blocks(basis, components, n_samples, block_cells)

    called = called_count(F.col("dosage"))
    mean = dosage_sum(F.col("dosage")) / called
    rare = F.least(F.col("mean") / 2, 1 - F.col("mean") / 2) < maf
    markers = geno.select(*_MARKER, "dosage", (n_samples - called).cast("int").alias("n_miss"), F.when(called > 0, mean).alias("mean"))
    markers = markers.filter((F.col("n_miss") <= max_missing * n_samples) & ~rare & (F.array_min("dosage") < F.array_max("dosage")))
    filled = F.transform("dosage", lambda d: F.coalesce(d.cast("double"), F.col("mean"))).alias("x")
    key = [*_MARKER, "n_miss", "mean", "mark"]
    markers = markers.select(*key[:-1], F.xxhash64("dosage").alias("mark"), filled)

    met = markers.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(blocks, "block")
    turned = F.transform("vectors", lambda v: F.struct(v["w"].alias("w"), v["e"].alias("e"), v["q"].alias("q"), _dot(v["u"], F.col("x")).alias("t")))
    met = met.select(*key, F.explode(F.array(turned)).alias("v"))  # the products once a row

    def total(term) -> Column:
        return F.sum(F.aggregate("v", F.lit(0.0), lambda acc, v: acc + v["w"] * v["t"] * term(v)))

    shares = [total(lambda v, j=j: F.get(v["q"], F.lit(j))).alias(f"q{j}") for j in range(c)]
    sums = met.groupBy(*key).agg(total(lambda v: v["t"]).alias("xx"), total(lambda v: v["e"]).alias("xy"), *shares, F.count("*").alias("times"))
    # Equal rows were summed together: each has its part, and is one row again.
    rows = (F.col("times") / n_blocks).cast("int")
    sums = sums.withColumn("rows", rows).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    whole, xy = F.col("xx") / F.col("rows"), F.col("xy") / F.col("rows")
    left = whole - sum((F.pow(F.col(f"q{j}") / F.col("rows"), 2) for j in range(c)), F.lit(0.0))
    sums = sums.select(*key[:-1], F.when(left > 1e-8 * whole, left).alias("xx"), xy.alias("xy"))
    free = n_samples - c - 1
    beta, rest = F.col("xy") / F.col("xx"), F.lit(yy) - F.col("xy") * F.col("xy") / F.col("xx")
    return sums.select(
        F.col("chrom").alias("chr"), "rs", F.col("pos").cast("long").alias("ps"), "n_miss", F.col("a1").alias("allele1"), F.col("a0").alias("allele0"),
        (F.col("mean") / 2).alias("af"), beta.alias("beta"), F.sqrt(rest / (free * F.col("xx"))).alias("se"),
        F.try_divide(F.col("xy") * beta, rest / free).alias("f_wald"), F.try_divide(n_samples * F.col("xy") * F.col("xy"), F.lit(yy) * F.col("xx")).alias("f_score"),
    )
