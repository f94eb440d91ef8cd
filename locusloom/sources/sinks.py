"""Text outputs: folders of part files. Outputs in sample order are range partitioned, so the parts follow each
other by name, and :func:`..sources.tables.numbered_lines` numbers them through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_clean_assoc(clean: DataFrame, path: str) -> None:
    """Tab text with a header in every part."""
    clean.select("SNP", "CHR", "BP", "P", "zscore").write.option("sep", "\t").option("header", True).csv(path)


def write_bed(bed: DataFrame, path: str) -> None:
    """Tab text without header or quotes."""
    bed.select("chrom", "start", "end", "name").write.option("sep", "\t").option("quote", "").csv(path)


def _ordered_text(df: DataFrame, line) -> DataFrame:
    """One range of samples a part; parts are named in order."""
    return df.orderBy("sample_idx").select(line.alias("value"))


def write_phenotype(pheno: DataFrame, trait: str, path: str) -> None:
    """One value per line in sample order, ``NA`` when missing."""
    _ordered_text(pheno, F.coalesce(F.col(trait).cast("string"), F.lit("NA"))).write.text(path)


def write_fam(fam: DataFrame, path: str) -> None:
    """Six space-separated columns in sample order; a missing phenotype is ``NA``."""
    fields = ["family", "sample_id", "father", "mother", "sex"]
    line = F.concat_ws(
        " ", *[F.col(c).cast("string") for c in fields], F.coalesce(F.col("phenotype").cast("string"), F.lit("NA"))
    )
    _ordered_text(fam, line).write.text(path)
