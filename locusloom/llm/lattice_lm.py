"""Language-model scores: a word model, and a subword lattice over an existing vocabulary.

Corpus counts are kept per distinct word. The lattice of a word has an arc for every piece of the
vocabulary; log-space forward recursion adds up all its segmentations. Piece weights start from the
scores of the vocabulary file and are re-estimated from the expected counts of the training words
(forward and backward over the same lattice). Pieces do not cross words, so a document's marginal
probability is the product over its words, and each distinct word is computed once.

A bounded number of the most frequent words is broadcast; it answers most tokens where they lie and
takes the hot keys out of the join that answers the others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, id_and_text, store

FOLDS, HELD_OUT = 7, 2
#: Distinct words that a task counts before it passes them on.
COUNT_WORDS = 400_000
#: Most frequent words that are broadcast; the others are joined.
FREQUENT = 200_000
ROUNDS = 1
WORD_START = "▁"
_LN10 = math.log(10)


def held_out(doc_id: Column) -> Column:
    """By the id as text; a row without an id is for training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


@dataclass
class Lattice:
    """Piece weights. ``arcs`` holds the log weight of every piece and, as None, every prefix of one;
    a letter that is no piece is spelled with the weights of its ``spell`` bytes."""

    arcs: dict[str, float | None]
    spell: list[float]
    end: float

    @classmethod
    def of(cls, weights: dict[str, float], spell: list[float], end: float) -> Lattice:
        arcs: dict[str, float | None] = {}
        for piece, weight in weights.items():
            for k in range(1, len(piece)):
                arcs.setdefault(piece[:k], None)
            arcs[piece] = weight
        return cls(arcs, spell, end)

    def edges(self, word: str) -> list[list[tuple[int, float]]]:
        """For each place of ``word`` the pieces that begin there: where they end, and their weight."""
        arcs, n = self.arcs, len(word)
        out = []
        for i in range(n):
            here = []
            single = False
            for j in range(i + 1, n + 1):
                piece = word[i:j]
                if piece not in arcs:
                    break
                weight = arcs[piece]
                if weight is not None:
                    here.append((j, weight))
                    single = single or j == i + 1
            if not single:
                here.append((i + 1, sum(self.spell[b] for b in word[i].encode("utf-8", "replace"))))
            out.append(here)
        return out

    def forward(self, edges: list[list[tuple[int, float]]]) -> list[float]:
        """Log weight of all ways to spell what lies before each place."""
        alpha = [-math.inf] * (len(edges) + 1)
        alpha[0] = 0.0
        for i, here in enumerate(edges):
            a = alpha[i]
            for j, weight in here:
                alpha[j] = _log_add(alpha[j], a + weight)
        return alpha

    def marginal(self, word: bytes) -> float:
        return self.forward(self.edges(WORD_START + word.decode("utf-8", "replace")))[-1]

    def expect(self, word: bytes, times: float, counts: dict[str, float], spelled: np.ndarray) -> None:
        """Add the expected uses of every piece in ``times`` occurrences of ``word``."""
        text = WORD_START + word.decode("utf-8", "replace")
        edges = self.edges(text)
        alpha = self.forward(edges)
        n = len(edges)
        beta = [-math.inf] * n + [0.0]
        whole = alpha[n]
        for i in range(n - 1, -1, -1):
            total = -math.inf
            for j, weight in edges[i]:
                through = weight + beta[j]
                total = _log_add(total, through)
                use = times * math.exp(alpha[i] + through - whole)
                piece = text[i:j]
                if self.arcs.get(piece) is None:
                    for b in piece.encode("utf-8", "replace"):
                        spelled[b] += use
                else:
                    counts[piece] = counts.get(piece, 0.0) + use
            beta[i] = total


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    if b == -math.inf:
        return a
    return a + math.log1p(math.exp(b - a))


def vocabulary_lattice(path: str) -> Lattice:
    """Start weights from a vocabulary file. Its scores rank the pieces (higher is earlier), and a piece
    of rank r weighs as 1 / (r + 1); byte pieces and the end weigh like the last."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = range(model.get_piece_size())
    plain = [i for i in kinds if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    plain.sort(key=lambda i: (-model.get_score(i), i))
    weights = {model.id_to_piece(i): 1 / (r + 1) for r, i in enumerate(plain)}
    last = 1 / (len(plain) + 1)
    total = math.log(sum(weights.values()) + 257 * last)
    return Lattice.of({p: math.log(w) - total for p, w in weights.items()}, [math.log(last) - total] * 256, math.log(last) - total)


def count_words(docs: DataFrame) -> DataFrame:
    """``(word binary, n long)`` of every distinct word of ``docs(doc_id, text, held)``; n counts
    training rows only, so words of held-out rows alone have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        seen: set[bytes] = set()

        def flush() -> pa.RecordBatch:
            words = [*counts, *(w for w in seen if w not in counts)]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([counts.get(w, 0) for w in words], pa.int64())], names=["word", "n"])
            counts.clear()
            seen.clear()
            return out

        for batch in batches:
            for text, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                (seen if held else counts).update(words_of(text))
                if len(counts) + len(seen) > COUNT_WORDS:
                    yield flush()
        yield flush()

    return docs.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def re_estimate(words: DataFrame, shared: Broadcast, end_count: float) -> Lattice:
    """Weights in proportion to the expected counts of all pieces in ``words(word, n)``, each count
    raised by one so that no piece of the vocabulary is lost. A sum for each piece reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice: Lattice = shared.value
        counts: dict[str, float] = {}
        spelled = np.zeros(256)
        for batch in batches:
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lattice.expect(word, n, counts, spelled)
        names = [*counts, *(f"<{b}>" for b in range(256))]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([*counts.values(), *spelled.tolist()]), pa.array([False] * len(counts) + [True] * 256)], names=["piece", "n", "byte"])

    found = words.filter("n > 0").select("word", "n").mapInArrow(run, "piece string, n double, byte boolean")
    sums = {(r["piece"], r["byte"]): r["n"] for r in found.groupBy("piece", "byte").agg(F.sum("n").alias("n")).collect()}
    old: Lattice = shared.value
    weights = {p: sums.get((p, False), 0.0) + 1 for p, w in old.arcs.items() if w is not None}
    spell = [sums.get((f"<{b}>", True), 0.0) + 1 for b in range(256)]
    total = math.log(sum(weights.values()) + sum(spell) + end_count + 1)
    return Lattice.of({p: math.log(w) - total for p, w in weights.items()}, [math.log(w) - total for w in spell], math.log(end_count + 1) - total)


def frequent_words(words: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The rows of ``words(n, ...)`` above a count that at most ``most`` of them pass. The count is found on
    a logarithmic scale of at most 512 steps, so no task ever orders or gathers the words."""
    step = F.floor(F.log2(F.col("n") + 1) * 8)
    room, least = most, None
    for r in sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r["step"]
    return words.filter(step >= least) if least is not None else words.filter(F.lit(False))


def _marginals(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice: Lattice = shared.value
        for batch in batches:
            scores = [lattice.marginal(w) / _LN10 for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=["word", "n", "lattice"])

    return run


def _score(frequent: Broadcast):
    """Per row what the frequent words say, and the other words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known, base, lattice = frequent.value
        get = place.get
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for doc, text, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                at = np.array([get(w, -1) for w in words], dtype=np.int64)
                found = at[at >= 0]
                rest = Counter(words[k] for k in np.flatnonzero(at < 0).tolist())
                out.append((row, doc, held, len(words) + 1, int(known[found].sum()), float(base[found].sum()), float(lattice[found].sum()), list(rest), list(rest.values())))
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            columns = zip(*out, strict=True) if out else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_PART_NAMES)

    return run


_PART_NAMES = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "lattice", "rest", "times"]
_PART = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, lattice double, rest array<binary>, times array<long>"


def score_documents(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words and one end. base_score adds log10((c + 1) / (N + V + 1)) over the tokens;
    score is the lattice's log10 probability of the words and the end. A null or empty text is the end
    alone; a null id is for training; repeated rows come back repeated; an empty table gives no rows,
    and without training rows every count is 0. Other columns are not read.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    spark = docs.sparkSession
    texts = id_and_text(docs)
    texts = texts.select("doc_id", "text", held_out(F.col("doc_id")).alias("held"))
    words = store(count_words(texts), "words")
    ends = texts.agg(F.coalesce(F.sum((~F.col("held")).cast("long")), F.lit(0))).first()[0]
    n, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0))).first()
    tokens, kinds = n + ends, kinds + (ends > 0)
    log_of = lambda c: math.log10((c + 1) / (tokens + kinds + 1))
    lattice = spark.sparkContext.broadcast(vocabulary_lattice(path))
    for _ in range(rounds):
        lattice = spark.sparkContext.broadcast(re_estimate(words, lattice, ends))
    scored = store(words.mapInArrow(_marginals(lattice), "word binary, n long, lattice double"), "scored")
    top = frequent_words(scored).toArrow()
    counts = np.array(top.column("n").to_numpy(), dtype=np.int64)
    place = {w: k for k, w in enumerate(top.column("word").to_pylist())}
    frequent = spark.sparkContext.broadcast((place, counts > 0, np.log10((counts + 1) / (tokens + kinds + 1)), np.array(top.column("lattice").to_numpy())))
    parts = store(texts.select("doc_id", "text", "held").mapInArrow(_score(frequent), _PART), "parts")
    pairs = parts.select("row", F.explode(F.arrays_zip("rest", "times")).alias("w")).select("row", F.col("w.rest").alias("word"), F.col("w.times").alias("times"))
    base = F.log10((F.col("n") + 1) / F.lit(float(tokens + kinds + 1)))
    answers = pairs.join(scored, "word").select(
        "row", (F.col("times") * (F.col("n") > 0).cast("long")).alias("known"), (F.col("times") * base).alias("base"), (F.col("times") * F.col("lattice")).alias("lattice")
    )
    rest = answers.groupBy("row").agg(*(F.sum(c).alias(f"more_{c}") for c in ("known", "base", "lattice")))
    joined = parts.select(*_PART_NAMES[:7]).join(rest, "row", "left")
    more = lambda c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (more("known") + (1 if ends else 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (more("base") + log_of(ends)).alias("base_score"), (more("lattice") + lattice.value.end / _LN10).alias("score"),
    )
