"""Two tokenizations of the same texts, cut into groups where tokens of both end together.

A text is encoded with both vocabularies; the cumulative byte ends of each side become a dictionary
from end to token index. The intersection of the two key sets, sorted, slices both id lists into
groups, and the tokens that end a group together are linked. Neither vocabulary has a token across a
single space, so the distinct parts between them are aligned once for many texts, as a text of their own.

How often a pair of ids is linked is counted over the whole corpus. Pairs with at least one in
``MOST`` of all links (so at most ``MOST`` pairs, whatever the corpus) are broadcast; all others are
joined, and none of those keys holds more than that share of the rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, rows, store
from .tokens import byte_bpe, slices

#: Pairs of ids that may be broadcast: those with at least one in ``MOST`` of all links.
MOST = 200_000
#: Rows that a task holds before it passes them on.
_ROWS = 500
#: Where both vocabularies part a text whatever stands around: at a single space between other characters.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Parts a worker remembers before it starts anew, and text bytes whose new parts are aligned together.
_MEMO, _SLICE = 400_000, 2_000_000
Chunk = tuple[int, int, str, bytes]

_PART = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
_SCORED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<long>, times array<long>"
_KINDS = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}


class PieceBpe:
    """Byte-pair encoding of pieces with byte fallback; a space stands before the text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


class Aligner:
    """Both vocabularies, with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        self.coder = byte_bpe(path_a).fast  # strings of special tokens are plain text to it
        self.bytes_a = [self.coder.decode_single_token_bytes(i) for i in range(self.coder.n_vocab)]
        piece = PieceBpe(path_b)
        self.encode_b, self.bytes_b = piece.encode, piece.bytes
        self.size_a, self.size_b = (np.array([len(t) for t in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        self.many = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(self.many)]

    def ids(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none where a side's bytes are not a space and the text."""
        if text:
            plain, whole = text.decode(errors="replace"), b" " + text
            a, b = self.coder.encode_to_numpy(" " + plain, disallowed_special=()), self.encode_b(plain)
            # Byte-level tokens are the bytes they were made from, so their sum tells; pieces may be rewritten.
            if self.size_a[a].sum() == len(whole) and b"".join(map(self.bytes_b.__getitem__, b)) == whole:
                return a.astype(np.int64), np.array(b, dtype=np.int64)
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each group the number of A and of B tokens up to its end. Tokens are never empty, so an end
        belongs to one token of each side."""
        at_a = dict(zip(np.cumsum(self.size_a[a]).tolist(), range(1, len(a) + 1), strict=True))
        at_b = dict(zip(np.cumsum(self.size_b[b]).tolist(), range(1, len(b) + 1), strict=True))
        common = sorted(at_a.keys() & at_b.keys())
        return tuple(np.array(list(map(at.__getitem__, common)), dtype=np.int64) for at in (at_a, at_b))

    def groups(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[list[int], list[int]]]:
        """The ids of each group."""
        i = j = 0
        for to_a, to_b in zip(*(c.tolist() for c in self.cuts(a, b)), strict=True):
            yield a[i:to_a].tolist(), b[j:to_b].tolist()
            i, j = to_a, to_b

    def digest(self, a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> str:
        """SHA-256 of the groups as decimal ids, or an empty text without any. Every id is written with the mark
        behind it: a comma, or a bar or semicolon where it is the last of its side."""
        if not len(a):
            return ""
        return _sha256("".join(self.marked(a, b, to_a, to_b)))

    def marked(self, a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> list[str]:
        """All ids in the order of the groups, each with its mark."""
        marked_a, marked_b = a.copy(), b.copy()
        marked_a[to_a - 1] += self.many
        marked_b[to_b - 1] += 2 * self.many
        in_order = np.empty(len(a) + len(b), dtype=np.int64)
        in_order[np.arange(len(a)) + np.repeat(np.append(0, to_b[:-1]), np.diff(to_a, prepend=0))] = marked_a
        in_order[np.arange(len(b)) + np.repeat(to_a, np.diff(to_b, prepend=0))] = marked_b
        return list(map(self.written.__getitem__, in_order.tolist()))

    def learn(self, chunks: list[str], memo: dict[str, Chunk | None]) -> None:
        """What ``memo`` lacks of the parts of texts that :data:`_BETWEEN` leaves: ``(n_a, n_b, marked ids, linked pairs)``
        for each, or None where a side rewrites it. They are aligned together, as one text.
        """
        inner = [c for c in chunks if c and not (c[0].isspace() or c[-1].isspace())]
        if len(inner) < len(chunks):  # the first or last of a text, with white space that must not meet another's
            for c in chunks:
                if not c or c[0].isspace() or c[-1].isspace():
                    self._learn([c], memo)
        narrow = [c for c in inner if c.isascii()]
        wide = [c for c in inner if not c.isascii()]  # more often rewritten
        self._learn(narrow, memo)
        self._learn(wide, memo)

    def _learn(self, chunks: list[str], memo: dict[str, Chunk | None]) -> None:
        if not chunks:
            return
        a, b = self.ids(" ".join(chunks).encode())
        if not len(a):
            if len(chunks) == 1:
                memo[chunks[0]] = None if chunks[0] else (0, 0, "", b"")
            else:
                half = len(chunks) // 2
                self._learn(chunks[:half], memo)
                self._learn(chunks[half:], memo)
            return
        to_a, to_b = self.cuts(a, b)
        marked, pairs = self.marked(a, b, to_a, to_b), memoryview(_pairs(a, b, to_a, to_b).tobytes())
        ends = np.cumsum([1 + len(c.encode()) for c in chunks])  # both sides part before a space between letters
        at = np.searchsorted(np.cumsum(self.size_a[a])[to_a - 1], ends) + 1
        i = j = k = 0
        for chunk, group, u, v in zip(chunks, at.tolist(), to_a[at - 1].tolist(), to_b[at - 1].tolist(), strict=True):
            memo[chunk] = u - i, v - j, "".join(marked[i + j : u + v]), bytes(pairs[8 * k : 8 * group])
            i, j, k = u, v, group

    def align(self, text: bytes, memo: dict[str, Chunk | None], chunks: list[str]) -> tuple[int, int, int, str, np.ndarray]:
        """``(n_a, n_b, n_groups, digest, linked pairs)`` of a text, from its parts where neither side rewrites one."""
        found = list(map(memo.__getitem__, chunks))
        if not chunks or None in found:
            a, b = self.ids(text)
            to_a, to_b = self.cuts(a, b)
            return len(a), len(b), len(to_a), self.digest(a, b, to_a, to_b), _pairs(a, b, to_a, to_b)
        n_a, n_b, marked, pairs = zip(*found, strict=True)
        links = np.frombuffer(b"".join(pairs), dtype=np.int64)
        n = sum(n_a)
        return n, sum(n_b), len(links), _sha256("".join(marked)) if n else "", links


def parted(text: bytes) -> list[str]:
    """The parts of a text that are aligned on their own; none of a text that is not UTF-8."""
    try:
        return _BETWEEN.split(text.decode())
    except UnicodeDecodeError:
        return []


def _sha256(marked: str) -> str:
    return hashlib.sha256(marked[:-1].encode()).hexdigest()


def _pairs(a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> np.ndarray:
    """The linked pairs: the last tokens of each group."""
    return a[to_a - 1] << 32 | b[to_b - 1]


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _batch(out: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split(" ") for c in schema.split(", ")), strict=True)
    columns = zip(*out, strict=True) if out else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def _parts(path_a: str, path_b: str):
    """Per row its groups' digest, and its linked pairs of ids with how often it links them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 33
        memo: dict[str, Chunk | None] = {}
        for batch in batches:
            for begin, end in slices(batch.column(1), _SLICE):
                ids, texts = rows(batch.slice(begin, end - begin))
                chunks = list(map(parted, texts))
                if len(memo) > _MEMO:
                    memo.clear()
                both.learn(list(set(chain.from_iterable(chunks)) - memo.keys()), memo)
                out = []
                for doc, text, parts in zip(ids, texts, chunks, strict=True):
                    n_a, n_b, n, digest, links = both.align(text, memo, parts)
                    pairs, times = np.unique(links, return_counts=True)
                    out.append((row, doc, n_a, n_b, n, n, digest, pairs, times))
                    row += 1
                    if len(out) == _ROWS:
                        yield _batch(out, _PART)
                        out = []
                yield _batch(out, _PART)

    return run


def _score(frequent: Broadcast):
    """What the broadcast pairs say of each row, and the row's other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = frequent.value
        for batch in batches:
            kept = [batch.column(c) for c in range(7)]
            pairs, times = batch.column(7), batch.column(8)
            starts = pairs.offsets.to_numpy()
            starts = starts - starts[0]
            flat, n = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            of = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            place = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
            here = known[place] == flat if len(known) else np.zeros(len(flat), dtype=bool)
            sums = np.zeros((2, batch.num_rows), dtype=np.int64)
            np.add.at(sums[0], of[here], n[here] * best[place[here]])
            np.add.at(sums[1], of[here], n[here] * count[place[here]])
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(of[~here], minlength=batch.num_rows)))), pa.int32())
            rest = [pa.ListArray.from_arrays(offsets, pa.array(x[~here], pa.int64())) for x in (flat, n)]
            names = [c.split(" ")[0] for c in _SCORED.split(", ")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums[0]), pa.array(sums[1]), *rest], names=names)

    return run


def pair_counts(parts: DataFrame) -> DataFrame:
    """``(pair, n, best)``: links of each pair of ids, and 1 if its B id has no pair with more."""
    pairs = parts.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    pairs = store(pairs, "pairs")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return pairs.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text that is null or empty, or whose tokens on either side are not the bytes of a space and the text
    (white space or letters that a vocabulary rewrites), has no tokens: zeros and an empty digest. A null
    id stays null; repeated rows come back repeated and all count; an empty table gives no rows. Other
    columns are not read.
    """
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    spark = docs.sparkSession
    parts = store(id_and_text(docs).mapInArrow(_parts(path_a, path_b), _PART), "aligned")
    counts = store(pair_counts(parts), "pair-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = counts.filter(F.col("n") >= F.lit(total / most)).orderBy("pair").toArrow()
    frequent = spark.sparkContext.broadcast(tuple(np.array(top.column(c).to_numpy(), dtype=np.int64) for c in ("pair", "n", "best")))
    scored = store(parts.mapInArrow(_score(frequent), _SCORED), "scored")
    other = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("p")).select("row", F.col("p.rest").alias("pair"), "p.times")
    more = other.join(counts, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    plus = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return scored.drop("rest", "times").join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"), plus("count_sum", "more_sum"), "groups_sha256"
    )
