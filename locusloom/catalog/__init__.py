"""Every operator as a named query over the bundled test tables, with its check in plain SQL.

A query is ``f(spark, sf_dir) -> DataFrame``. The SQL reads the same tables by name and states the
result independently, without the library. Queries whose result SQL cannot state have no check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

_PARTS = {
    "sites": fx.SITES,
    "calls": fx.CALLS,
    "odd_calls": fx.ODD_CALLS,
    "assoc": fx.ASSOC,
    "nuclei": fx.NUCLEI,
    "geno_long": fx.GENO_LONG_CHECK,
    "pheno": fx.PHENO,
    "d": """SELECT variant_id, sample_idx, gt, dp, gq,
              CASE gt WHEN '0/0' THEN 0 WHEN '0/1' THEN 1 WHEN '1/1' THEN 2 END AS d FROM calls""",
    "md": """SELECT variant_id, sample_idx, CASE WHEN dp >= 3 AND gq >= 25 THEN gt END AS gt,
               CASE WHEN dp >= 3 AND gq >= 25 THEN d END AS d FROM d""",
    "stats": """SELECT s.variant_id, s.chrom, s.pos, s.id, s.ref, s.alt_alleles,
                  CAST(coalesce(sum(d.d), 0) AS BIGINT) AS ac, count(d.d) AS n_called, 10 - count(d.d) AS n_miss
                FROM sites s LEFT JOIN d ON d.variant_id = s.variant_id
                GROUP BY s.variant_id, s.chrom, s.pos, s.id, s.ref, s.alt_alleles""",
    "clean": """SELECT rs AS "SNP", TRY_CAST(c AS BIGINT) AS "CHR", ps AS "BP", p_lrt AS "P", l_mle AS zscore
                FROM (SELECT *, CASE WHEN TRY_CAST(chr AS BIGINT) = 0
                                     THEN regexp_replace(split_part(rs, ':', 1), '[^0-9]', '', 'g') ELSE chr END AS c
                      FROM assoc) WHERE TRY_CAST(c AS BIGINT) IS NOT NULL""",
    "acc": "SELECT *, split_part(label, '_', 1) AS accession FROM nuclei",
    "markers": """SELECT variant_id, avg(d) AS mean, count(d) AS called, count(DISTINCT d) AS kinds
                  FROM geno_long GROUP BY variant_id""",
}


def with_parts(names: str, select: str) -> str:
    """``select`` behind the named derived tables."""
    return "WITH " + ",\n".join(f"{n} AS ({_PARTS[n]})" for n in names.split()) + "\n" + select


def query(name: str, parts: str | None = None, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its check when ``sql`` is given."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            CHECKS[name] = with_parts(parts, sql) if parts else sql
        return f

    return add


def rounded(column: Column | str, digits: int = 9) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


from . import files, model, phenotypes, results, variants  # noqa: E402,F401
