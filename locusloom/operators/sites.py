"""Variant sites and genotype calls.

The working layout is one row per site with the calls of all samples in one
array (``calls: array<struct<gt,dp,gq>>``, position = sample ordinal), or with
their dosages (``dosage: array<double>``, null = missing). In this layout every
filter below is an expression on one row: the whole quality funnel is a single
narrow pass with no shuffle. ``nest_calls`` / ``unnest_calls`` convert from and
to the long layout, one row per (site, sample).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import genotype as G
from ..functions import naming

# ---------------------------------------------------------------- layout


def nest_calls(
    long: DataFrame,
    n_samples: int,
    key: str = "variant_id",
    fields: Sequence[str] = ("gt", "dp", "gq"),
    unique: bool = False,
) -> DataFrame:
    """Long calls -> one row per site with an array in sample order; absent pairs are null.

    A group never exceeds ``n_samples`` entries: a pair occurring twice, or an ordinal out of
    range, fails the job before anything is collected, in an aggregation that combines on the
    map side. Pass ``unique=True`` when the input is already one row per pair (for example
    straight from a ``groupBy`` on both columns) to save that shuffle; the size of every array
    is checked either way.
    """
    idx = F.col("sample_idx").cast("int")
    entry = F.struct(*[F.col(f) for f in fields]) if len(fields) > 1 else F.col(fields[0])
    rows = long.select(key, idx.alias("sample_idx"), entry.alias("entry"))
    if not unique:
        rows = rows.groupBy(key, "sample_idx").agg(
            F.count("*").alias("copies"), F.first("entry").alias("entry")
        )
        valid = (F.col("copies") == 1) & F.col("sample_idx").between(0, n_samples - 1)
        rows = rows.select(
            key,
            F.when(valid, F.col("sample_idx"))
            .otherwise(F.raise_error(F.lit("repeated or out-of-range (site, sample) pair")).cast("int"))
            .alias("sample_idx"),
            "entry",
        )
    ordinals = F.sequence(F.lit(0), F.lit(n_samples - 1))
    grouped = rows.groupBy(key).agg(F.collect_list(F.struct("sample_idx", "entry")).alias("pairs"))
    kind = grouped.schema["pairs"].dataType.elementType
    absent = F.transform(
        F.array_except(ordinals, F.transform("pairs", lambda p: p["sample_idx"])),
        lambda i: F.struct(i.alias("sample_idx"), F.lit(None).cast(kind["entry"].dataType).alias("entry")),
    )
    filled = F.array_sort(F.concat("pairs", absent))
    whole = F.when(F.size(filled) == n_samples, filled).otherwise(
        F.raise_error(F.lit("repeated or out-of-range (site, sample) pair")).cast(T.ArrayType(kind))
    )
    nested = G.bind(whole, lambda pairs: F.transform(pairs, lambda p: p["entry"]))
    return G.compute_once(grouped, "calls", nested).select(key, "calls")


def unnest_calls(sites: DataFrame, array: str = "calls", keep: Sequence[str] = ("variant_id",)) -> DataFrame:
    """One row per (site, sample)."""
    return sites.select(*keep, F.posexplode(array).alias("sample_idx", "call"))


# ---------------------------------------------------------------- sample and site filters


def subset_samples(sites: DataFrame, ordinals: Sequence[int], array: str = "calls") -> DataFrame:
    """Keep the samples at ``ordinals``, renumbered in that order. Counts derived later
    see the kept samples only. Row-local: no join."""
    source = F.col(array)
    picked = F.transform(F.array(*[F.lit(int(i)) for i in ordinals]), lambda i: F.get(source, i))
    return G.compute_once(sites, array, picked)


def subset_samples_long(calls: DataFrame, kept: DataFrame) -> DataFrame:
    """Long layout: semi join with the kept ordinals."""
    return calls.join(kept.select("sample_idx"), "sample_idx", "left_semi")


def listed_samples(samples: DataFrame, keep: DataFrame) -> DataFrame:
    """``samples(sample_idx, sample_id)`` of the ids listed in ``keep(position, sample_id)``, renumbered from 0 in list
    order. An unknown or repeated id fails by name. Both lists have a row per sample of the study."""
    wanted = [r["sample_id"] for r in keep.select("position", "sample_id").orderBy("position").collect()]
    known = {r["sample_id"] for r in samples.select("sample_id").collect()}
    unknown = [i for i in wanted if i not in known]
    if unknown or len(set(wanted)) < len(wanted):
        raise ValueError(f"unknown sample ids {unknown}" if unknown else "a sample id is listed twice")
    return samples.sparkSession.createDataFrame(list(enumerate(wanted)), "sample_idx int, sample_id string")


def subset_by_id(sites: DataFrame, samples: DataFrame, keep: DataFrame, array: str = "calls") -> tuple[DataFrame, DataFrame]:
    """``(sites, samples)`` of the ids listed in ``keep(position, sample_id)``, in list order.

    The kept samples are renumbered from 0 and the new ``samples(sample_idx, sample_id)`` comes back
    with the calls, so ordinals of calls and phenotypes cannot disagree. An unknown or repeated id
    fails by name. Both lists have a row per sample of the study, as wide as one row of ``sites``.
    """
    order = listed_samples(samples, keep)
    place = {r["sample_id"]: r["sample_idx"] for r in samples.select("sample_id", "sample_idx").collect()}
    wanted = [r["sample_id"] for r in order.orderBy("sample_idx").collect()]
    return subset_samples(sites, [place[i] for i in wanted], array), order


def keep_chromosomes(sites: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the listed chromosomes; prunes the folders of a stored variant table."""
    return sites.filter(F.col("chrom").isin(*names))


def max_alleles(sites: DataFrame, k: int = 2) -> DataFrame:
    """Keep sites with at most ``k`` alleles, the reference allele included."""
    return sites.filter(1 + F.size("alts") <= k)


def remove_indels(sites: DataFrame) -> DataFrame:
    """Drop sites with an allele whose length differs from the reference allele."""
    return sites.filter(F.forall("alts", lambda a: F.length(a) == F.length("ref")))


def mask_calls(sites: DataFrame, min_dp: int, min_gq: int, array: str = "calls") -> DataFrame:
    """Blank the genotype of calls below either threshold; the site stays."""
    masked = F.transform(
        array,
        lambda c: F.when(
            c.isNotNull(),
            F.struct(
                F.when(G.passes_quality(c["dp"], c["gq"], min_dp, min_gq), c["gt"]).alias("gt"),
                c["dp"].alias("dp"),
                c["gq"].alias("gq"),
            ),
        ),
    )
    return G.compute_once(sites, array, masked)


def mask_calls_long(calls: DataFrame, min_dp: int, min_gq: int) -> DataFrame:
    keep = G.passes_quality(F.col("dp"), F.col("gq"), min_dp, min_gq)
    return calls.withColumn("gt", F.when(keep, F.col("gt")))


# ---------------------------------------------------------------- dosage


def gt_to_dosage(sites: DataFrame, haploid: str = "missing", array: str = "calls") -> DataFrame:
    """Replace the calls by the array of non-reference allele counts."""
    dosage = F.transform(array, lambda c: G.gt_dosage(c["gt"], haploid))
    return G.compute_once(sites, "dosage", dosage).drop(array)


def _counts(sites: DataFrame) -> Column:
    """``struct(ac, n_called, n)`` of a row; the dosages are decoded once and bound."""

    def count(d: Column) -> Column:
        return F.struct(
            F.aggregate(d, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0))).alias("ac"),
            F.size(F.filter(d, lambda x: x.isNotNull())).cast("long").alias("n_called"),
            F.size(d).cast("long").alias("n"),
        )

    if "dosage" in sites.columns:
        return G.bind(F.col("dosage"), count)
    return G.bind(F.transform("calls", lambda c: G.gt_dosage(c["gt"])), count)


def site_stats(sites: DataFrame) -> DataFrame:
    """Add ``ac, an, af, n_called, n_miss`` from the calls or dosages of each row; ``af`` is
    null when nothing is called."""
    s = F.col("_s")
    return G.compute_once(sites, "_s", _counts(sites)).select(
        *sites.columns,
        s["ac"].cast("long").alias("ac"),
        (2 * s["n_called"]).alias("an"),
        F.try_divide(s["ac"], 2.0 * s["n_called"]).alias("af"),
        s["n_called"].alias("n_called"),
        (s["n"] - s["n_called"]).alias("n_miss"),
    )


def site_stats_long(calls: DataFrame, n_samples: int, key: str = "variant_id") -> DataFrame:
    """The same numbers from long calls. Sums and counts combine before the shuffle, so one
    site holding a large share of the rows costs no more than any other; a (site, sample)
    pair without a row counts as missing."""
    d = G.gt_dosage(F.col("gt"))
    return (
        calls.select(key, d.alias("d"))
        .groupBy(key)
        .agg(F.coalesce(F.sum("d"), F.lit(0.0)).cast("long").alias("ac"), F.count("d").alias("n_called"))
        .select(
            key,
            "ac",
            (2 * F.col("n_called")).alias("an"),
            F.try_divide(F.col("ac").cast("double"), 2.0 * F.col("n_called")).alias("af"),
            "n_called",
            (n_samples - F.col("n_called")).alias("n_miss"),
        )
    )


def _having(sites: DataFrame, condition) -> DataFrame:
    """Filter on the row's counts, given as ``condition(ac, n_called, n)``."""
    return sites.filter(G.bind(_counts(sites), lambda s: condition(s["ac"], s["n_called"], s["n"])))


def _decoded(sites: DataFrame, test) -> tuple[str, Callable[[Column], Column]]:
    """The array of dosages or calls, and ``test`` of the dosage of an element."""
    if "dosage" in sites.columns:
        return "dosage", test
    return "calls", lambda c: test(G.gt_dosage(c["gt"]))


def _missing(sites: DataFrame) -> Column:
    """Number of missing calls of a row, in one pass over them."""
    return F.size(F.filter(*_decoded(sites, lambda d: d.isNull())))


def min_ac(sites: DataFrame, k: int = 1) -> DataFrame:
    """Keep sites with at least ``k`` non-reference alleles among the called ones."""
    if k == 1:  # the first one found settles a site
        return sites.filter(F.exists(*_decoded(sites, lambda d: d > 0)))
    return _having(sites, lambda ac, called, n: ac >= k)


def max_missing_count(sites: DataFrame, k: int) -> DataFrame:
    """Drop sites with more than ``k`` missing calls (``k`` itself stays)."""
    return sites.filter(_missing(sites) <= k)


def missing_rate_filter(sites: DataFrame, rate: float = 0.05) -> DataFrame:
    """Keep sites whose share of missing calls is at most ``rate``."""
    array, _ = _decoded(sites, lambda d: d)
    return sites.filter(_missing(sites) <= rate * F.size(array))


def maf_filter(sites: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Keep sites whose rarer allele has at least this frequency."""

    def common(ac: Column, called: Column, n: Column) -> Column:
        af = F.try_divide(ac, 2.0 * called)
        return F.least(af, 1.0 - af) >= threshold

    return _having(sites, common)


def minor_allele_recode(geno: DataFrame) -> DataFrame:
    """Count the rarer allele. Where the counted allele ``a1`` is the more frequent one the
    alleles are swapped and the dosage becomes ``2 - d``; ``flipped`` records it."""
    stats = site_stats(geno).withColumn("flipped", F.coalesce(F.col("af") > 0.5, F.lit(False)))
    return stats.select(
        *[c for c in geno.columns if c not in ("a1", "a0", "dosage")],
        F.when(F.col("flipped"), F.col("a0")).otherwise(F.col("a1")).alias("a1"),
        F.when(F.col("flipped"), F.col("a1")).otherwise(F.col("a0")).alias("a0"),
        F.when(F.col("flipped"), F.transform("dosage", lambda d: 2.0 - d))
        .otherwise(F.col("dosage"))
        .alias("dosage"),
        "flipped",
    )


# ---------------------------------------------------------------- names


def strip_chrom_prefix(sites: DataFrame, prefix: str = "Chr") -> DataFrame:
    return sites.withColumn("chrom", naming.strip_prefix(F.col("chrom"), prefix))


def default_variant_id(sites: DataFrame) -> DataFrame:
    """Name unnamed variants ``chrom:pos`` in ``id``."""
    return sites.withColumn("id", naming.variant_name(F.col("chrom"), F.col("pos"), F.col("id")))


def chrom_code(sites: DataFrame) -> DataFrame:
    """Add ``chrom_code``: the integer chromosome, or 0."""
    return sites.withColumn("chrom_code", naming.chromosome_code(F.col("chrom")))


# ---------------------------------------------------------------- singletons


_HIT = "struct<code:int,kind:string,sample_idx:int>"


def _hit(code: Column | int, kind: Column | str, sample: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    code = F.lit(code) if isinstance(code, int) else code
    return F.struct(code.cast("int").alias("code"), kind.alias("kind"), sample.cast("int").alias("sample_idx"))


def _hits_from_codes(codes: Column, include_doubletons: bool) -> Column:
    """Rare alleles of a two-allele diploid site."""
    count = lambda k: F.size(F.filter(codes, lambda c: c == k))
    first = lambda k: F.array_position(codes, k) - 1

    def rare(n: Column) -> Column:
        het = n["het"] == 1
        found = []
        for allele, homozygous, homs in ((0, 0, n["ref"]), (1, 2, n["alt"])):
            one = F.when(het & (homs == 0), _hit(allele, "S", first(1)))
            if include_doubletons:
                one = one.when((n["het"] == 0) & (homs == 1), _hit(allele, "D", first(homozygous)))
            found.append(one)
        return F.filter(F.array(*found), lambda h: h.isNotNull())

    counts = F.struct(count(0).alias("ref"), count(1).alias("het"), count(2).alias("alt"))
    return G.bind(counts, rare)


def _hits_from_calls(include_doubletons: bool) -> Column:
    """The same for any number of alleles and any text, counted allele by allele."""

    def describe(allele: Column) -> Column:
        counts = F.transform("calls", lambda c: G.allele_count(c["gt"], allele.cast("string")))

        def total(n: Column) -> Column:
            return F.struct(
                allele.alias("code"),
                F.aggregate(n, F.lit(0), lambda acc, x: acc + x).alias("ac"),
                F.filter(F.transform(n, lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull()).alias("carriers"),
            )

        return G.bind(counts, total)

    def rare(a: Column) -> Column:
        once = a["ac"] == 1
        return once | ((a["ac"] == 2) & (F.size(a["carriers"]) == 1)) if include_doubletons else once

    described = F.transform(F.sequence(F.lit(0), F.size("alts")), describe)
    return F.transform(
        F.filter(described, rare),
        lambda a: _hit(a["code"], F.when(a["ac"] == 1, "S").otherwise("D"), F.get(a["carriers"], F.lit(0))),
    )


def _hits(include_doubletons: bool) -> Column:
    """Array of the row's rare alleles."""
    codes = F.transform("calls", lambda c: G.plain_code(c["gt"]))
    return G.bind(
        codes,
        lambda v: F.when(F.exists(v, lambda c: c.isNull()), _hits_from_calls(include_doubletons).cast(f"array<{_HIT}>"))
        .otherwise(_hits_from_codes(v, include_doubletons).cast(f"array<{_HIT}>")),
    )


def singletons(sites: DataFrame, include_doubletons: bool = True) -> DataFrame:
    """One row per allele seen once (``S``) or in one homozygous sample only (``D``):
    ``chrom, pos, kind, allele, sample_idx``. Reference alleles count too."""
    # The outer explode keeps the optimizer from computing the array a second time as a filter.
    return (
        sites.select("chrom", "pos", "ref", "alts", F.explode_outer(_hits(include_doubletons)).alias("hit"))
        .filter(F.col("hit").isNotNull())
        .select(
            "chrom",
            "pos",
            F.col("hit.kind").alias("kind"),
            F.when(F.col("hit.code") == 0, F.col("ref")).otherwise(F.get("alts", F.col("hit.code") - 1)).alias("allele"),
            F.col("hit.sample_idx").alias("sample_idx"),
        )
    )


def exclude_positions(sites: DataFrame, positions: DataFrame) -> DataFrame:
    """Remove every site at a listed (chrom, pos). A plain anti join: adaptive execution broadcasts the
    list when its measured bytes allow it."""
    return sites.join(positions.select("chrom", "pos"), ["chrom", "pos"], "left_anti")


def mark_singletons(sites: DataFrame, include_doubletons: bool = True) -> DataFrame:
    """Add ``has_singleton``, decided from the row's own calls."""
    return G.compute_once(sites, "has_singleton", F.size(_hits(include_doubletons)) > 0)


def shared_positions(marked: DataFrame) -> DataFrame:
    """``chrom, pos`` of the positions with several records of which one is marked."""
    return (
        marked.select("chrom", "pos", "has_singleton")
        .groupBy("chrom", "pos")
        .agg(F.count("*").alias("records"), F.max("has_singleton").alias("hit"))
        .filter((F.col("records") > 1) & F.col("hit"))
        .select("chrom", "pos")
    )


def drop_marked(marked: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """Remove marked sites and every other record at the position of one; the mark goes too.

    A marked site is dropped by its own row. Only a *different* record at the same position needs
    a join, with the positions that several records share (``shared``, if they are at hand).
    """
    shared = shared_positions(marked) if shared is None else shared
    return exclude_positions(marked.filter(~F.col("has_singleton")).drop("has_singleton"), shared)


def drop_singletons(sites: DataFrame, include_doubletons: bool = True) -> DataFrame:
    """``exclude_positions(sites, singletons(sites))`` without shuffling the calls. Both passes decide
    on the calls; store :func:`mark_singletons` and give it to :func:`drop_marked` to decide once."""
    return drop_marked(mark_singletons(sites, include_doubletons))
