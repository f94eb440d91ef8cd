"""Image measurements to one row per accession, in sample order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import phenotype as P
from ..operators import samples as SA


def measurement_rows(frames: Sequence[DataFrame], mode: str = "default", label: str = "label") -> DataFrame:
    """Stack the files' rows, blank text to null, accession in front."""
    return P.parse_accession(P.blank_to_null(P.union_measurements(frames)), mode, label)


def accession_phenotypes(
    rows: DataFrame,
    samples: DataFrame,
    strict_columns: Sequence[str],
    skip_na_columns: Sequence[str],
    tag: str = "tg_ecotypeid",
) -> DataFrame:
    """Summaries put in the order of ``samples``, whose ids are the accession names."""
    summary = P.summarize_accessions(rows, strict_columns, skip_na_columns, tag)
    return SA.align_phenotypes(samples, summary.withColumnRenamed("accession", "sample_id"))
