"""Tables a result is looked at with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import results as R


def result_tables(
    clean: DataFrame, threshold: float | str = "bonferroni", highlighted: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Quantile points, scatter, histogram, counts per chromosome, genome layout, hits, intervals.

    The tables share one input; pass a stored or cached result, not a scan still to be run.
    """
    hits = R.significant_hits(clean, threshold)
    return {
        "qq": R.qq_points(clean),
        "scatter": R.chr_scatter(clean),
        "histogram": R.histogram(clean),
        "per_chromosome": R.snps_per_chromosome(clean),
        "layout": R.manhattan_layout(clean, threshold, highlighted),
        "ticks": R.manhattan_ticks(clean),
        "hits": hits,
        "intervals": R.hits_to_bed(hits),
    }
