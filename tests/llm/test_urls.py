"""The URL filter against plain statements of its parts."""

import math
import zlib

import numpy as np
import pytest

from locusloom.llm import url_filter as U
from locusloom.llm.catalog import QUERIES

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.index(c) for c in "/?#" if c in rest] or [len(rest)]
    host, tail = rest[: min(ends)], rest[min(ends) :]
    ends = [tail.index(c) for c in "?#" if c in tail] or [len(tail)]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[: min(ends)]


def plain_grams(host, path):
    pieces = [("h", f"^{host}$".encode()), ("p", f"^{path}$".encode())]
    return {zlib.crc32(kind.encode() + raw[k : k + n]) % U.WIDTH for kind, raw in pieces for n in U.GRAMS for k in range(len(raw)) if k + n <= len(raw)}


def plain_answer(url, model):
    host, path = plain_parts(url)
    fit = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    rule = max(fit, key=lambda r: len(r[0] + r[1])) if fit else None
    found = plain_grams(host, path)
    score = model.bias + math.fsum(model.weights[k] for k in found) / math.sqrt(max(1, len(found)))
    return host, path, rule and rule[0] + rule[1], rule[2] if rule else "block" if score > 0 else "allow", score


def same(rows, urls, model):
    assert len(rows) == len(urls)
    for row, url in zip(rows, urls):
        *parts, score = plain_answer(url, model)
        assert [row.host, row.path, row.rule] == parts[:3], url
        assert row.score == pytest.approx(score, abs=1e-8)
        assert row.verdict == parts[3] or (row.rule is None and abs(score) < 1e-8), url


def test_query_against_plain_statements(spark, sf):
    """Every page of the table, with the model that the query learns."""
    model = U.fit_urls(sorted((*plain_parts(url), blocked) for url, blocked in U.labelled_urls()))
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op7_url_filter"](spark, sf).collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    scored = {r.page_id: r for r in U.filter_urls(spark.read.parquet(f"{sf}/pages.parquet"), model).collect()}
    same([scored[k] for k in sorted(urls)], [urls[k] for k in sorted(urls)], model)
    assert all((r.host, r.path, r.rule, r.verdict) == (scored[r.page_id].host, scored[r.page_id].path, scored[r.page_id].rule, scored[r.page_id].verdict) for r in rows)


def test_odd_urls(spark):
    """Very long ones, repeated rows, nulls, no host, other letters, rules at the edge of their hosts and paths."""
    urls = [None, "", "no scheme", "http://", "HTTP://A.Org", "x://org/", "x://notorg/", "x://a.example.org/es", "x://EXAMPLE.org/es/a?b#c", "x://example.org/en/12"]
    urls += ["x://é.com/fr/ü", "x://a.com/FR/", "x://a.com?/fr/", "x://a.com#x", "a://b://c/d", "x://h/" + "long/" * 40_000, "x://" + "h" * 100_000 + ".com/de/", "x://same/1", "x://same/1"]
    model = U.UrlModel(np.random.default_rng(4).normal(size=U.WIDTH), -0.1)
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    rows = sorted(U.filter_urls(frame, model).collect(), key=lambda r: r.page_id)
    same(rows, urls, model)


def test_fit_takes_plain_gradient_steps():
    rows = [("a.com", "/x", 1), ("b.org", "/y/z", 0), ("casino.net", "/win", 1), ("b.org", "/y/z", 0), ("", "", 0)]
    bias = math.log(3 / 4)  # two of five, each side one more
    weights, found = {}, [plain_grams(h, p) for h, p, _ in rows]
    for _ in range(4):
        slope = {}
        for grams, (*_, y) in zip(found, rows):
            size = 1 / math.sqrt(max(1, len(grams)))
            error = (1 / (1 + math.exp(-bias - size * sum(weights.get(k, 0.0) for k in grams))) - y) * size
            for k in grams:
                slope[k] = slope.get(k, 0.0) + error
        weights = {k: weights.get(k, 0.0) - 0.5 * (g / len(rows) * 10 + 0.01 * weights.get(k, 0.0)) for k, g in slope.items()}
    model = U.fit_urls(rows, rounds=4, rate=0.5, ridge=0.01)
    assert model.bias == pytest.approx(bias)
    want = np.zeros(U.WIDTH)
    want[list(weights)] = list(weights.values())
    assert model.weights == pytest.approx(want, abs=1e-12)
