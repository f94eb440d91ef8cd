"""URL filters: host and path rules first, then logistic regression on hashed character n-grams.

The model is fitted on a small labelled table of URLs, whose size is a documented bound, so it is a
few weights whatever the number of pages; scoring is one narrow pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import require_columns, ship_package
from .common import lower_az

#: Labelled URLs that a fit reads at most; a larger table is an error.
LABELLED_ROWS = 20_000
WIDTH = 1 << 16
GRAMS = (3, 4, 5)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("org", "/", True),
    Rule("example.org", "/es/", False),
    Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True),
    Rule("com", "/de/", False),
)

#: Words of labelled example hosts. The labelled table crosses them with ``_SHAPES``; both kinds get the
#: same shapes, so only the words can tell them apart.
_BLOCKED = (
    "casino jackpot lottery betting slots poker pills viagra pharmacy-deals replica-watches payday-loans free-money get-rich porn "
    "xxx escort adult-dating warez torrent crack-keys malware phishing spam click-farm link-farm miracle-diet cheap-meds hot-deals"
).split()
_ALLOWED = (
    "news library university recipes weather museum garden docs school travel health science history music sports council research photo "
    "bookshop radio forum wiki notes hiking chess math physics biology language theatre archive gazette journal planet station harbour "
    "bridge river mountain valley orchard kitchen workshop atelier letters poems stories maps trains cycling running swimming"
).split()
_SHAPES = ("https://{}.example.com/en/{}", "http://www.{}.example.net/{}", "https://blog.{}.example.org/fr/{}?page=2", "http://m.{}.example.com/es/{}/")


def labelled_urls() -> list[tuple[str, int]]:
    """``(url, blocked)``: the small labelled table."""
    rows = []
    for blocked, words in ((1, _BLOCKED), (0, _ALLOWED)):
        for k, word in enumerate(words):
            rows += [(shape.format(word, 7 * k + 3 * j), blocked) for j, shape in enumerate(_SHAPES)]
    return rows


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case. Path: then up to
    ``?``, ``#`` or the end. Both are empty for a null url and for one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return lower_az(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_fits(host: Column, path: Column, rule: Rule) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def decide(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's text, or null, and its verdict."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = rule_fits(host, path, rule)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit("allow" if rule.allow else "block")).otherwise(verdict)
    return text, verdict


def grams(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path, kept apart; ends of both count as letters."""
    found = set()
    for kind, text in ((b"h", f"^{host}$"), (b"p", f"^{path}$")):
        raw = text.encode()
        for n in GRAMS:
            for k in range(len(raw) - n + 1):
                found.add(zlib.crc32(kind + raw[k : k + n]) % WIDTH)
    return np.fromiter(found, dtype=np.int64, count=len(found))


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        at = grams(host, path)
        return self.bias + (float(self.weights[at].sum()) / np.sqrt(len(at)) if len(at) else 0.0)


def fit_urls(rows: Sequence[tuple[str, str, int]], rounds: int = 1_000, rate: float = 2.0, ridge: float = 1e-5) -> UrlModel:
    """Logistic regression of ``(host, path, blocked)``, plain gradient steps over all rows. The bias is
    that of the labelled table and stays: what shows no known n-gram is judged by it alone."""
    y = np.array([r[2] for r in rows], dtype=float)
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    weights = np.zeros(WIDTH)
    found = [grams(h, p) for h, p, _ in rows]
    if not found:
        return UrlModel(weights, bias)
    flat = np.concatenate(found)
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    size = 1 / np.sqrt(np.array([max(1, len(f)) for f in found]))
    for _ in range(rounds):
        margin = bias + np.bincount(row, weights[flat], len(found)) * size
        error = (1 / (1 + np.exp(-margin)) - y) * size
        weights -= rate * (np.bincount(flat, error[row], WIDTH) / len(found) * 10 + ridge * weights)
    return UrlModel(weights, bias)


def fit_url_table(labelled: DataFrame, most: int = LABELLED_ROWS) -> UrlModel:
    """A model of a labelled table ``(url, blocked)``; null labels are left out."""
    require_columns(labelled, "url", "blocked")
    host, path = host_and_path(F.col("url"))
    rows = labelled.dropna(subset=["blocked"]).select(host.alias("host"), path.alias("path"), F.col("blocked").cast("int").alias("blocked")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the labelled table has more than {most} rows")
    return fit_urls(sorted((r["host"], r["path"], r["blocked"]) for r in rows))


def filter_urls(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: its id, host, path, the rule that decides or null, the verdict, and the model's
    block score. Null ids and repeated rows are judged like any other; other columns are not read."""
    require_columns(pages, id_col, url_col)
    ship_package(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.score
        for batch in batches:
            values = [score(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=["page_id", "host", "path", "score"])

    host, path = host_and_path(pages[url_col].cast("string"))
    split = pages.select(pages[id_col].cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    scored = split.mapInArrow(run, "page_id long, host string, path string, score double")
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("score") > 0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), F.round("score", 9).alias("score"))
