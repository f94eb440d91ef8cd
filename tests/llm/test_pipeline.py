"""The stages in a row, each against its plain statement on what the one before kept."""

import brute
import corpus_pipeline
import pytest

from locusloom.llm import quality


def whole(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def redacted(text, spans):
    at, out = 0, ""
    for s, e in spans:
        if s >= at:
            out += text[at:s] + "[secret]"
        at = max(at, e)
    return out + text[at:] if spans else text


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "benchmark_decontamination", "secret_scans", "best_fit_packing"]

    kept = stages["quality_rules"](spark, docs, sf).cache()
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    judged = {r["doc_id"] for r in quality.quality_rules(docs, model).filter("kept").collect()}
    failed = {d[0] for d in brute.quality_base([(r["doc_id"], r["text"]) for r in docs.collect()]) if d[6]}
    assert judged and not judged & failed
    assert whole(kept) == whole(docs.filter(docs["doc_id"].isin(sorted(judged))))

    single = stages["near_duplicates"](spark, kept, sf).cache()
    groups = brute.near_duplicates([(r["doc_id"], r["text"]) for r in kept.collect()])
    firsts = sorted({g[2] for g in groups})
    assert len(firsts) < len(groups) and single.columns == columns
    assert whole(single) == whole(kept.filter(kept["doc_id"].isin(firsts)))

    clean = stages["benchmark_decontamination"](spark, single, sf).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    dirty = sorted(o[0] for o in brute.overlaps([(r["doc_id"], r["text"]) for r in single.collect()], items) if o[5])
    assert dirty and clean.columns == columns
    assert whole(clean) == whole(single.filter(~single["doc_id"].isin(dirty)))

    safe = stages["secret_scans"](spark, clean, sf).cache()
    before = clean.collect()
    digest = brute.secret_digest([(r["doc_id"], r["source"], r["text"]) for r in before])
    want = []
    for r, d in zip(before, digest, strict=True):
        spans = [tuple(map(int, s.split(":")[1:])) for s in d[5].split(",") if s]
        text = redacted(r["text"], spans)
        want.append(tuple({**r.asDict(), "text": text, "n_chars": len(text) if spans else r["n_chars"]}.values()))
    assert safe.columns == columns and whole(safe) == sorted(want, key=str)
    assert not any(brute.secrets(r["text"]) for r in safe.collect())

    packed = stages["best_fit_packing"](spark, safe, sf)
    pieces = brute.pieces([(r["doc_id"], r["text"]) for r in safe.collect()])
    assert whole(packed.select("doc_id", "piece", "start", "length", "ids_crc32")) == sorted(pieces, key=str)
    run = corpus_pipeline.run(spark, sf)
    assert whole(run.select("doc_id", "piece", "start", "length", "ids_crc32")) == sorted(pieces, key=str)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark, sf, odd, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, none, sf).count() == 0
    found = stage(spark, odd, sf)
    assert found.count() > 0
    if name != "best_fit_packing":
        assert found.columns == odd.columns and found.schema.simpleString() == odd.schema.simpleString()
