"""Quality rules: gradient-boosted trees over document statistics.

The statistics are counted over whole texts in Arrow batches. The trees are fitted on a bounded
sample of labelled documents, flattened into NumPy node arrays, and score a batch by letting all
rows walk down one level at a time. Chosen statistics are monotonic: more of them never raises the
score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import require_columns, ship_package
from .common import LOWER

#: Labelled documents that the trees, and the word list, are fitted on: those with the smallest
#: hash of their id. This bounds what reaches the driver, whatever the size of the corpus.
TRAIN_ROWS = 6_000

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
REPEAT_SHARE = 50  # per cent

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see, with the direction in which they may move the score (0: either).
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0,
    "digit_share": 0, "punct_share": 0, "bar_share": -1, "exclaim_share": -1, "distinct_share": 0, "short_share": 0,
    "line_words": 0, "listed_words": -1, "listed_share": -1,
}


def statistics(text: bytes | None, listed: frozenset[bytes]) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The ``BASE`` counts and the ``FEATURES`` of one whole text; a null text has no words.
    ``listed``: words that labelled bad documents use and good ones don't."""
    text = text or b""
    words = text.split()  # of bytes: exactly the blanks \x20 and \x09-\x0D
    n = len(words)
    points = len(text.translate(None, _CONTINUATION))
    word_chars = points - sum(text.count(b) for b in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    numbers: dict[bytes, int] = {}
    ids = np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64, count=n)
    repeated = _repeated(ids, len(numbers))
    base = (n, word_chars, symbols, dup_lines, repeated)
    size = max(1, len(text))
    plain = text.translate(_BARE).split() if listed else ()
    found = sum(w in listed for w in plain)
    upper = len(text) - len(text.translate(None, _UPPER))
    digits = len(text) - len(text.translate(None, _DIGITS))
    punct = len(text) - len(text.translate(None, _PUNCT))
    per = max(1, n)
    features = (
        math.log1p(n), word_chars / per, symbols / size, dup_lines / max(1, len(lines)), repeated / per, upper / size,
        digits / size, punct / size, text.count(b"|") / per, text.count(b"!") / per, len(numbers) / per,
        sum(len(w) < 3 for w in numbers) / max(1, len(numbers)), n / max(1, len(lines)), float(min(found, 20)), found / per,
    )
    return base, features


#: Bytes that continue a code point.
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER, _DIGITS, _PUNCT = (bytes(range(65, 91)), bytes(range(48, 58)), b".,;:?!'\"()-")
#: Letters and everything above ASCII stay, in lower case; the rest parts words.
_BARE = bytes(LOWER[b] if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a 3-word window found twice or more, the first time included."""
    if len(ids) < 4:
        return 0
    if distinct < 2**21:
        keys = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    else:  # too many kinds of words for one number: number the pairs first
        pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)[1].astype(np.int64)
        keys = pairs[:-1] * distinct + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[k : len(keys) + k] |= twice
    return int(covered.sum())


@dataclass
class Trees:
    """Boosted trees as node arrays: node ``i`` of a tree sends a row to ``left[i]`` if its
    ``feature[i]`` is at most ``threshold[i]``, else to ``left[i] + 1``; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    leaf: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x`` (rows by features)."""
        out = np.full(len(x), self.start)
        every = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                right = x[every, self.feature[at]] > self.threshold[at]
                at = np.where(self.leaf[at], at, self.left[at] + right)
            out += self.value[at]
        return out


def fit_trees(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: float = 1.0
) -> Trees:
    """Second-order boosting of the logistic loss on binned columns of a bounded sample.

    A column with sign -1 (+1) only gets splits whose right leaf is not higher (lower) than the left,
    and the middle between both bounds all leaves below, so the whole tree is monotonic in it.
    """
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    coded = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1) if len(x) else x.astype(int)
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(y), start)
    nodes: list[list] = []  # feature, threshold, left, value, leaf
    roots = []
    for _ in range(rounds if len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, 0.0, 0, 0.0, True])
        work = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf)]
        while work:
            node, rows, level, low, high = work.pop()
            value = lambda g, h, lo=low, hi=high: np.clip(-g / (h + ridge), lo, hi)
            g, h = grad[rows].sum(), hess[rows].sum()
            best = (1e-6, None)
            own = value(g, h)
            gain_of = lambda v, g, h: -(g * v + 0.5 * (h + ridge) * v * v)
            for f in range(x.shape[1]) if level < depth else ():
                n = len(edges[f])
                if not n:
                    continue
                gl = np.cumsum(np.bincount(coded[rows, f], grad[rows], n + 1))[:-1]
                hl = np.cumsum(np.bincount(coded[rows, f], hess[rows], n + 1))[:-1]
                vl, vr = value(gl, hl), value(g - gl, h - hl)
                gain = gain_of(vl, gl, hl) + gain_of(vr, g - gl, h - hl) - gain_of(own, g, h)
                gain[(hl < least) | (h - hl < least)] = -1
                if signs[f]:
                    gain[signs[f] * (vr - vl) < 0] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, float(vl[k]), float(vr[k])))
            if best[1] is None:
                nodes[node][3] = rate * float(own)
                margin[rows] += nodes[node][3]
                continue
            f, k, vl, vr = best[1]
            left = len(nodes)
            nodes[node] = [f, float(edges[f][k]), left, 0.0, False]
            nodes += [[0, 0.0, 0, 0.0, True], [0, 0.0, 0, 0.0, True]]
            goes = coded[rows, f] <= k
            mid = (vl + vr) / 2
            bounds = ((low, high), (low, high)) if not signs[f] else ((mid, high), (low, mid)) if signs[f] < 0 else ((low, mid), (mid, high))
            work.append((left, rows[goes], level + 1, *bounds[0]))
            work.append((left + 1, rows[~goes], level + 1, *bounds[1]))
    columns = list(zip(*nodes, strict=True)) or [[]] * 5
    return Trees(*(np.array(c, dtype=k) for c, k in zip(columns, (np.int64, float, np.int64, float, bool), strict=True)), np.array(roots, dtype=np.int64), depth, start)


@dataclass
class QualityModel:
    trees: Trees | None
    listed: frozenset[bytes]
    cut: float = 0.0

    def keeps(self, features: np.ndarray) -> np.ndarray:
        """Without labels of both kinds there is no model, and the base rules alone decide."""
        return np.ones(len(features), dtype=bool) if self.trees is None else self.trees.score(features) >= self.cut


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, good, texts = (c.to_pylist() for c in batch.columns)
        words = [list(dict.fromkeys((t or b"").translate(_BARE).split())) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(good, pa.int32()), pa.array(texts, pa.binary()), pa.array(words, pa.list_(pa.binary()))],
            names=["doc_id", "good", "text", "words"],
        )


def bad_words(docs: DataFrame, least: int = 3, support: float = 0.004, share: float = 0.8, most: int = 100) -> frozenset[bytes]:
    """Words of at least three bytes that stand in at least ``least`` and a share of ``support`` of the
    sample's bad documents, and mostly there: chance, or a few copies, bring no word onto the list. The
    ``most`` with the highest share of bad documents are kept (a documented bound)."""
    n_bad = docs.agg(F.coalesce(F.sum(1 - F.col("good")), F.lit(0))).first()[0]
    least = max(least, math.ceil(support * n_bad))
    words = docs.select("good", F.explode("words").alias("word")).filter(F.length("word") >= 3)
    counts = words.groupBy("word").agg(F.sum(1 - F.col("good")).alias("bad"), F.count("*").alias("n"))
    shown = counts.filter((F.col("bad") >= least) & (F.col("bad") >= share * F.col("n")))
    best = shown.orderBy((F.col("bad") / (F.col("n") + 2)).desc(), F.col("bad").desc(), "word").limit(most)
    return frozenset(bytes(r["word"]) for r in best.collect())


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, trees: dict | None = None) -> QualityModel:
    """A model of "good and not toxic" from at most ``train_rows`` labelled documents.

    Labels with a null id, quality or toxic flag, and null texts, are left out of the fit. If a
    document has several labels the worst counts; of rows that share an id the smallest text. The sample is by a hash of the id, so it is the
    same for any order or partitioning; only statistics and short word lists reach the driver.
    """
    require_columns(docs, "doc_id", "text")
    require_columns(labels, "doc_id", "quality", "toxic")
    ship_package(docs.sparkSession)
    good = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0)
    marked = labels.dropna(subset=["doc_id", "quality", "toxic"]).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(good).alias("good"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text")).dropna()
    # The sample is at most ``train_rows`` narrow rows, so it is what is broadcast.
    joined = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("good").alias("good"), F.min("text").alias("text"))
    words = joined.mapInArrow(_train_rows, "doc_id long, good int, text binary, words array<binary>").persist()
    try:
        listed = bad_words(words)
        rows = words.select("doc_id", "good", "text").mapInArrow(_features_of(listed), "doc_id long, good int, features array<double>").collect()
    finally:
        words.unpersist()
    rows.sort(key=lambda r: (r["doc_id"], r["good"], r["features"]))
    x = np.array([r["features"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([r["good"] for r in rows], dtype=float)
    if not (0 < y.sum() < len(y)):
        return QualityModel(None, listed)
    return QualityModel(fit_trees(x, y, np.array(list(FEATURES.values())), **(trees or {})), listed)


def _features_of(listed: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t, listed)[1] for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "good", "features"])

    return run


def _judge(texts: list[bytes | None], model: QualityModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [statistics(t, model.listed) for t in texts]
    base = np.array([b for b, _ in found], dtype=np.int64).reshape(-1, len(BASE))
    failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > REPEAT_SHARE * base[:, 0])
    keeps = model.keeps(np.array([f for _, f in found], dtype=float).reshape(-1, len(FEATURES)))
    return base, failed, keeps & ~failed


def quality_rules(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per document: its ``BASE`` counts, whether the base rules reject it, and the verdict.

    A null text is an empty one and fails (fewer than ``MIN_WORDS`` words); null ids and repeated
    rows are judged like any other. Other columns are not read.
    """
    require_columns(docs, "doc_id", "text")
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, failed, kept = _judge(batch.column(1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in base.T), pa.array(failed), pa.array(kept)], names=["doc_id", *BASE, "base_failed", "kept"]
            )

    columns = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    return columns.mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in BASE)}, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns and nothing moved."""
    require_columns(docs, "text")
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_judge(batch.column(at).cast(pa.binary()).to_pylist(), shared.value)[2]))

    return docs.mapInArrow(run, docs.schema)
