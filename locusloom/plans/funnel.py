"""Quality funnel: raw calls to the sites worth testing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.genotype import LENIENT
from ..operators import sites as S
from ..session import scratch_path


def store_sites(sites: DataFrame) -> DataFrame:
    """``sites`` written once to the shared folder: later passes read the columns they need."""
    path = scratch_path(sites.sparkSession, "sites")
    sites.write.parquet(path)
    return sites.sparkSession.read.schema(sites.schema).parquet(path)


def quality_funnel(
    sites: DataFrame,
    samples: Sequence[int] | None = None,
    chromosomes: Sequence[str] | None = None,
    quality: tuple[int, int] = LENIENT,
    max_missing: int | None = None,
    min_alt: int = 1,
    singletons: bool = False,
    strip_prefix: str | None = "Chr",
) -> DataFrame:
    """The documented order: samples, chromosomes, biallelic sites with an alternative allele
    (counted *before* masking), no indels, masked calls, missing calls, singletons, names.

    The conditions that need only a site's own columns come first so the scan applies them
    before any array is touched; dropping them earlier changes no result. Every step is a
    narrow expression; only the singleton step stores its input, with one mark for each site, and
    aggregates positions from it.
    """
    df = sites
    if chromosomes is not None:
        df = S.keep_chromosomes(df, chromosomes)
    df = S.remove_indels(S.max_alleles(df, 2))
    if samples is not None:
        df = S.subset_samples(df, samples)
    df = S.mask_calls(S.min_ac(df, min_alt), *quality)
    if max_missing is not None:
        df = S.max_missing_count(df, max_missing)
    if not singletons:
        marked = store_sites(S.mark_singletons(df))
        # A stored list has a known size, by which the join is planned before any calls move.
        df = S.drop_marked(marked, store_sites(S.shared_positions(marked)))
    # Names are made from the chromosome as it is called afterwards.
    return S.default_variant_id(df if strip_prefix is None else S.strip_chrom_prefix(df, strip_prefix))
