"""Expressions on chromosome, variant and accession names."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trailing image number and extension of a label (the dot matches any character).
IMAGE_SUFFIX = r"[-_][0-9]{1,}.tif$"


def strip_prefix(chrom: Column, prefix: str = "Chr") -> Column:
    """Remove ``prefix`` at the start of the text only."""
    return F.regexp_replace(chrom, "^" + re.escape(prefix), "")


def variant_name(chrom: Column, pos: Column, name: Column) -> Column:
    """``chrom:pos`` for a variant without a name (null, empty or ``.``)."""
    unnamed = F.coalesce(F.trim(name).isin("", "."), F.lit(True))
    return F.when(unnamed, F.concat_ws(":", chrom, pos.cast("string"))).otherwise(name)


def chromosome_code(chrom: Column) -> Column:
    """The integer in the text, or 0 when it is not an integer."""
    return F.coalesce(chrom.try_cast("int"), F.lit(0))


def chromosome_from_name(chrom: Column, name: Column) -> Column:
    """The chromosome text, or the digits before the first ``:`` of the name when it is 0."""
    digits = F.regexp_replace(F.get(F.split(name, ":"), F.lit(0)), "[^0-9]", "")
    return F.when(chrom.try_cast("bigint") == 0, digits).otherwise(F.trim(chrom))


def accession(label: Column, mode: str = "default") -> Column:
    """Accession in an image label.

    ``default`` drops the trailing image number and extension (a date stays);
    ``name`` keeps the text before the first underscore.
    """
    pattern = {"default": IMAGE_SUFFIX, "name": "_"}.get(mode)
    if pattern is None:
        raise ValueError("mode must be 'default' or 'name'")
    return F.get(F.split(label, pattern), F.lit(0))


def neg_log(p: Column, base: str = "10") -> Column:
    """Minus the logarithm of a p-value (base ``10`` or ``e``); a zero gives infinity."""
    if base not in ("10", "e"):
        raise ValueError("base must be '10' or 'e'")
    log = F.log10(p) if base == "10" else F.ln(p)
    return F.when(p == 0.0, F.lit(float("inf"))).otherwise(-log)


def run_label(trait_path: str, covariate_path: str | None = None) -> str:
    """Result label: base name of the phenotype file without ``.tsv``, plus the base
    name of the covariate file without its last extension when one is used."""
    trait = os.path.basename(trait_path).removesuffix(".tsv")
    if covariate_path is None:
        return trait
    return f"{trait}_{os.path.splitext(os.path.basename(covariate_path))[0]}"


def run_id(trait: Column, covariates: Column) -> Column:
    """Column form of the label; a null covariate name means none was used."""
    return F.concat_ws("_", trait, covariates)
