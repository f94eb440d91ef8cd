"""Benchmark decontamination with suffix arrays over the training text.

Every task cuts its documents into shards, orders the word suffixes of a shard that begin with a
word of the benchmark, and looks up all benchmark suffixes by binary search: the two bounds of a
window give every place where it occurs. What a benchmark suffix shares with its neighbours in the array
spreads from there over the array, as far as suffixes share words with each other, so every place of the shard gets
its longest match of up to ``WINDOW`` words; places with that many are followed to their
end among the fully ordered suffixes of the benchmark. Documents are never split or moved, so nothing
is shuffled. The benchmark comes in blocks of a fixed number of words; each block is one more narrow
pass over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import require_columns, ship_package
from .common import LOWER, fresh

WINDOW = 13
#: A document with a share of 1 / SHARE or more of its words hit is contaminated.
SHARE = 20
#: Words of the benchmark that are held, and broadcast, at once.
BLOCK_WORDS = 1_000_000
#: Bytes of text in a shard, unless one document is longer. A shard's words, suffix array and search take about
#: 13 times its bytes in a Python worker, beside the executor's JVM; 2 MB keep that near 30 MB.
SHARD_BYTES = 2_000_000

#: Word bytes stay (digits, letters in lower case, everything above ASCII); the rest parts words.
_WORDS = bytes(
    LOWER[b] if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("longest", T.LongType()),
        T.StructField("longest_at", T.LongType()),
        T.StructField("hit_start", T.ArrayType(T.IntegerType())),
        T.StructField("hit_end", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


class TestBlock:
    """The windows and suffixes of some benchmark items as rows of word numbers (0: no more words)."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.vocab: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        ids, starts, ends = [], [], []
        for item, words in items:
            numbers = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            for s in range(max(1, len(numbers) - WINDOW + 1)):
                windows.setdefault(tuple(numbers[s : s + WINDOW]), set()).add(item)
            starts += range(len(ids), len(ids) + len(numbers))
            ends += [len(ids) + len(numbers)] * len(numbers)
            ids += [*numbers, 0]  # no match runs on into the next item
        keys = sorted(windows)
        self.lengths = np.array([len(k) for k in keys], dtype=np.int64)
        self.windows = np.zeros((len(keys), WINDOW), dtype=np.int32)
        for row, key in zip(self.windows, keys, strict=True):
            row[: len(key)] = key
        self.items = [sorted(windows[k]) for k in keys]
        self.text = np.array([*ids, 0], dtype=np.int32)
        self.suffixes, self.suffix_ends = np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)
        self.ordered = ordered_suffixes(self.text, self.suffixes)


def ordered_suffixes(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``at`` in order of the whole suffixes there, each up to its first 0, by doubling the depth of their ranks."""
    rank = text.astype(np.int64)
    depth = 1
    while len(at):
        ahead = np.minimum(at + depth, len(text) - 1)
        key = np.stack([rank[at], np.where(rank[at] > 0, rank[ahead], 0)])
        order = np.lexsort(key[::-1])
        at, key = at[order], key[:, order]
        new = (key[:, 1:] != key[:, :-1]).any(axis=0)
        deeper = np.zeros(len(text), dtype=np.int64)
        deeper[at] = np.concatenate(([1], 1 + np.cumsum(new)))
        if new.all() or deeper[at].max() == len(np.unique(rank[at])):  # no rank was split: the rest are equal to their ends
            return at
        rank, depth = deeper, 2 * depth
    return at


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes that begin with a number above 0, in order of their first ``WINDOW``
    words (deeper order is not needed: a group that is equal so far is one occurrence list).
    Suffixes end at the first 0, which stands between documents and for any foreign word."""
    where = np.flatnonzero(text)
    order, step = _pack(text, where, 0)
    sorted_at, known = where[order], step
    rank = np.zeros(len(known), dtype=np.int64)
    depth = 3
    rank[1:] = np.cumsum(known[order][1:] != known[order][:-1])
    while depth < WINDOW and len(rank):
        same = np.zeros(len(rank) + 1, dtype=bool)
        same[1:-1] = rank[1:] == rank[:-1]
        tied = np.flatnonzero(same[1:] | same[:-1])
        if not len(tied):
            break
        _, more = _pack(text, sorted_at[tied], depth)
        again = np.lexsort((more, rank[tied]))
        sorted_at[tied] = sorted_at[tied][again]
        key, group = more[again], rank[tied][again]
        new = np.zeros(len(rank), dtype=bool)
        new[1:] = rank[1:] != rank[:-1]
        new[tied[1:]] |= (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        rank = np.cumsum(new)
        depth += 3
    return sorted_at


def _pack(text: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Three words from ``depth`` on as one number (21 bits each), nothing beyond the first 0."""
    last = len(text) - 1
    out = np.zeros(len(at), dtype=np.int64)
    alive = np.ones(len(at), dtype=bool)
    for k in range(depth):
        alive &= text[np.minimum(at + k, last)] > 0
    for k in range(depth, depth + 3):
        word = text[np.minimum(at + k, last)]
        alive &= word > 0
        out = (out << 21) | np.where(alive, word, 0)
    return np.argsort(out, kind="stable") if depth == 0 else None, out


def _bounds(text: np.ndarray, array: np.ndarray, wanted: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``wanted`` the first and past-last place in ``array`` of suffixes that begin
    with its ``lengths`` words; all rows are searched in step."""
    found = []
    last = len(text) - 1
    for upper in (False, True):
        lo, hi = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(array), dtype=np.int64)
        while (open_ := lo < hi).any():
            rows = np.flatnonzero(open_)
            mid = (lo[rows] + hi[rows]) >> 1
            at = array[mid]
            order = np.zeros(len(rows), dtype=np.int8)  # of the suffix against the wanted words
            undecided = np.arange(len(rows))
            for k in range(wanted.shape[1]):
                undecided = undecided[lengths[rows[undecided]] > k]
                if not len(undecided):
                    break
                have, want = text[np.minimum(at[undecided] + k, last)], wanted[rows[undecided], k]
                order[undecided] = np.sign(have - want)
                undecided = undecided[have == want]
            right = order <= 0 if upper else order < 0
            lo[rows[right]] = mid[right] + 1
            hi[rows[~right]] = mid[~right]
        found.append(lo)
    return found[0], found[1]


def _common(text: np.ndarray, a: np.ndarray, other: np.ndarray, b: np.ndarray, most: int | None = None) -> np.ndarray:
    """How many words from ``a`` in ``text`` equal those from ``b`` in ``other``, at most ``most``, none beyond a 0."""
    out = np.zeros(len(a), dtype=np.int64)
    run, k = np.arange(len(a)), 0
    while len(run) and (most is None or k < most):
        word = text[np.minimum(a[run] + k, len(text) - 1)]
        run = run[(word > 0) & (word == other[np.minimum(b[run] + k, len(other) - 1)])]
        k += 1
        out[run] = k
    return out


def _longest(text: np.ndarray, array: np.ndarray, block: TestBlock) -> np.ndarray:
    """Per word place of the shard the length of the longest match with the benchmark that begins there."""
    out = np.zeros(len(text), dtype=np.int64)
    if not len(array) or not len(block.suffixes):
        return out
    # Suffixes of the items: their first WINDOW words place them between two suffixes of the shard.
    n = np.minimum(block.suffix_ends - block.suffixes, WINDOW)
    wanted = np.zeros((len(n), WINDOW), dtype=np.int32)
    for k in range(WINDOW):
        inside = n > k
        wanted[inside, k] = block.text[block.suffixes[inside] + k]
    low, high = _bounds(text, array, wanted, n)
    shares = np.zeros(len(array), dtype=np.int64)
    for place in (low - 1, low, high):
        ok = np.flatnonzero((place >= 0) & (place < len(array)))
        np.maximum.at(shares, place[ok], _common(text, array[place[ok]], block.text, block.suffixes[ok], WINDOW))
    # A suffix of the shard shares with an item what it shares with all suffixes on the way to the item's place.
    chain = np.append(0, _common(text, array[1:], text, array[:-1], WINDOW))
    found = np.zeros(len(array), dtype=np.int64)
    for depth in range(1, int(shares.max()) + 1):
        group = np.cumsum(chain < depth)
        reached = np.zeros(int(group[-1]) + 1, dtype=bool)
        reached[group[shares >= depth]] = True
        found[reached[group]] = depth
    out[array] = found
    # Whole windows go on: the nearest suffixes of the benchmark in its own full order have the longest match.
    at = array[found == WINDOW]
    lo, hi = np.zeros(len(at), dtype=np.int64), np.full(len(at), len(block.ordered), dtype=np.int64)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        test, here = block.ordered[mid], at[open_]
        same = _common(text, here, block.text, test)
        less = block.text[np.minimum(test + same, len(block.text) - 1)] < text[np.minimum(here + same, len(text) - 1)]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
    for place in (lo - 1, lo):
        ok = np.flatnonzero((place >= 0) & (place < len(block.ordered)))
        out[at[ok]] = np.maximum(out[at[ok]], _common(text, at[ok], block.text, block.ordered[place[ok]]))
    return out


def _search(docs: list[list[bytes]], block: TestBlock) -> list[tuple]:
    """``(n_words, longest, longest_at, hit starts, hit ends, items)`` of each document of a shard."""
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    starts = np.zeros(len(docs) + 1, dtype=np.int64)
    np.cumsum(sizes + 1, out=starts[1:])
    text = np.zeros(int(starts[-1]) + 1, dtype=np.int32)
    get = block.vocab.get
    for start, words in zip(starts, docs, strict=False):
        text[start : start + len(words)] = [get(w, 0) for w in words]
    array = suffix_array(text)
    low, high = _bounds(text, array, block.windows, block.lengths)
    hits: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    for w in np.flatnonzero(high > low):
        at = array[low[w] : high[w]]
        of = np.searchsorted(starts, at, side="right") - 1
        for d, s in zip(of.tolist(), (at - starts[of]).tolist(), strict=True):
            hits.setdefault(d, []).append((s, s + int(block.lengths[w])))
        for d in np.unique(of).tolist():
            items.setdefault(d, set()).update(block.items[w])
    longest = _longest(text, array, block)
    out = []
    for d, n in enumerate(sizes.tolist()):
        spans = merge(hits.get(d, []))
        own = longest[starts[d] : starts[d] + n]
        first = int(own.argmax()) if n else 0
        best = int(own[first]) if n else 0
        out.append((n, best, first if best else None, [s for s, _ in spans], [e for _, e in spans], sorted(items.get(d, ()))))
    return out


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _searcher(shared: Broadcast, place: int, column: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: TestBlock = shared.value
        for batch in batches:
            texts, before = batch.column(column), batch.column(place)
            begin = 0
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            while begin < len(sizes):  # a shard: some rows of the batch, of bounded text
                end, held = begin + 1, sizes[begin]
                while end < len(sizes) and held + sizes[end] <= SHARD_BYTES:
                    held += sizes[end]
                    end += 1
                found = _search([words_of(t) for t in texts[begin:end].to_pylist()], block)
                merged = []
                for old, new in zip(before[begin:end].to_pylist(), found, strict=True):
                    if old is not None:
                        spans = merge([*zip(old["hit_start"], old["hit_end"], strict=True), *zip(new[3], new[4], strict=True)])
                        far = max((new[1:3], (old["longest"], old["longest_at"])), key=lambda x: (x[0], -(x[1] or 0)))
                        new = (new[0], *far, [s for s, _ in spans], [e for _, e in spans], sorted({*old["items"], *new[5]}))
                    merged.append(dict(zip(_FOUND.names, new, strict=True)))
                part = batch.slice(begin, end - begin)
                columns = list(part.columns)
                columns[place] = pa.array(merged, type=batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
                begin = end

    return search


def test_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[TestBlock]:
    """The benchmark in blocks of at most ``block_words`` words (a longer item is a block of its own),
    fetched partition by partition. Items without words and null items' texts give no window."""
    require_columns(benchmark, item_col, text_col)
    held: list[tuple[str, list[bytes]]] = []
    n = 0
    rows = benchmark.select(benchmark[item_col].cast("string").alias("item"), benchmark[text_col].cast("binary").alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(None if row["text"] is None else bytes(row["text"]))
        if not words or row["item"] is None:
            continue
        if held and n + len(words) > block_words:
            yield TestBlock(held)
            held, n = [], 0
        held.append((row["item"], words))
        n += len(words)
    yield TestBlock(held)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_words: int = BLOCK_WORDS, name: str = "overlap") -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, longest (words of the longest verbatim match with an item),
    longest_at (the word with which it begins, the first one of several; null without a match), hit_start / hit_end (maximal runs of hit words) and items (sorted ids with an occurring window).

    A window is ``WINDOW`` consecutive item words, or a whole shorter item. A null or empty text has
    no words. Rows, repeated ones too, and all other columns come back as they are, except that a
    column already called ``name`` is replaced. An empty benchmark hits nothing.
    """
    require_columns(docs, text_col)
    ship_package(docs.sparkSession)
    out = docs.withColumn(name, F.lit(None).cast(_FOUND))
    place, column = out.columns.index(name), out.columns.index(text_col)
    for block in test_blocks(benchmark, block_words=block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        found = out.withColumn(text_col, out[text_col].cast("binary"))
        out = found.mapInArrow(_searcher(shared, place, column), found.schema).withColumn(text_col, F.col(text_col).cast("string"))
    return out


def n_hit(overlap: str = "overlap") -> Column:
    spans = F.zip_with(F.col(f"{overlap}.hit_end"), F.col(f"{overlap}.hit_start"), lambda e, s: (e - s).cast("long"))
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, n: total + n)


def contaminated(overlap: str = "overlap") -> Column:
    hit = n_hit(overlap)
    return (hit > 0) & (F.lit(SHARE) * hit >= F.col(f"{overlap}.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    name = fresh("overlap", docs)
    return find_overlaps(docs, benchmark, name=name).filter(~contaminated(name)).drop(name)


def overlap_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: counts, a hash of the items found, the decision, and the longest match."""
    found = find_overlaps(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        F.col("overlap.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("overlap.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "overlap.items"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
        F.col("overlap.longest").alias("longest"),
        F.col("overlap.longest_at").alias("longest_at"),
    )
