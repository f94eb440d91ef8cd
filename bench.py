"""Time the headline queries; one JSON line on stdout.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local cores (default 8).
Each query runs twice and the second run counts, so compilation is left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from locusloom import fixtures as fx  # noqa: E402
from locusloom.catalog import QUERIES  # noqa: E402
from locusloom.operators import kinship as K  # noqa: E402
from locusloom.operators import lmm as L  # noqa: E402
from locusloom.plans.association import association_run, markers  # noqa: E402
from locusloom.plans.funnel import quality_funnel  # noqa: E402
from locusloom.session import cut_lineage, local_session, scratch_path  # noqa: E402
from locusloom.sources.store import read_variants, write_variants  # noqa: E402

HEADLINE = (
    "clean_assoc", "significant_hits", "hits_to_bed", "qq_points", "manhattan_layout", "histogram",
    "site_stats", "site_stats_long", "singletons", "quality_funnel", "minor_allele_recode",
    "summarize_accessions", "boxplot_stats", "kinship_centered", "null_model", "lmm_scan_lrt", "lmm_scan_all",
    "association_run",
)
COPIES = 200
#: Sites of the one published run, about, and its samples.
SITES, SAMPLES = 1_500_000, 64


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def scan_rates(spark, sf_dir: str, cores: int) -> dict[str, float]:
    """Markers per second of the scan on the embedded markers repeated ``COPIES`` times."""
    geno = fx.geno(spark, sf_dir)
    model = L.null_model(fx.pheno(spark, sf_dir), K.kinship_centered(geno, fx.N_GENO_SAMPLES), n_samples=fx.N_GENO_SAMPLES)
    many = geno.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))).repartition(cores).drop("copy").cache()
    n = many.count()
    rates = {"markers": n}
    for test in ("lrt", "all"):
        consume(L.lmm_scan(many, model, test))
        rates[f"scan_{test}_per_sec"] = round(n / timed(lambda: consume(L.lmm_scan(many, model, test))))
    rates["kinship_per_sec"] = round(n / timed(lambda: consume(K.kinship_centered(many, fx.N_GENO_SAMPLES))))
    return rates


def end_to_end(spark, sf_dir: str, cores: int) -> dict[str, float]:
    """Seconds from stored calls through funnel, markers and scan to the cleaned result, on the sites of
    the call fixture repeated to about ``SITES`` at places of their own, each with ``SAMPLES`` calls drawn from
    the site's ten by a hash of place and sample. Storing the calls is not timed; ``analysis`` starts from
    the sites that the funnel stored, as the published log starts from filtered ones."""
    sites = fx.called_sites(spark, sf_dir)
    copies = max(1, SITES // sites.count())
    path = scratch_path(spark, "bench-sites")
    many = sites.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).repartition(cores)
    many = many.withColumn("pos", F.col("pos") + F.col("copy") * 10_000_000).drop("copy")
    drawn = F.transform(F.sequence(F.lit(1), F.lit(SAMPLES)), lambda i: F.get("calls", F.pmod(F.hash("pos", i), F.lit(fx.N_CALL_SAMPLES))))
    write_variants(many.withColumn("calls", drawn), path)
    pheno = spark.createDataFrame([(i, float((i * 7) % 10) + i / 3) for i in range(SAMPLES)], "sample_idx int, y double")

    def funnel() -> None:
        counts["kept"] = quality_funnel(read_variants(spark, path), chromosomes=[f"Chr{i}" for i in range(1, 6)], quality=(0, 0), max_missing=SAMPLES // 10)

    def analysis() -> None:
        geno = cut_lineage(markers(counts["kept"]))
        counts["markers"] = geno.count()
        consume(association_run(geno, pheno, SAMPLES, "y", maf=0.1, max_missing=0.2).clean)

    counts = {"sites": copies * sites.count(), "samples": SAMPLES}
    first, second = timed(funnel), timed(analysis)
    del counts["kept"]
    return {"seconds": round(first + second, 1), "funnel": round(first, 1), "analysis": round(second, 1), **counts}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, app="locusloom-bench")
    seconds = {}
    for name in HEADLINE:
        run = lambda: consume(QUERIES[name](spark, sf_dir))  # noqa: E731,B023
        run()
        seconds[name] = round(timed(run), 3)
    rates = scan_rates(spark, sf_dir, cores)
    whole = end_to_end(spark, sf_dir, cores)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cores": cores, "rates": rates, "end_to_end": whole,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
