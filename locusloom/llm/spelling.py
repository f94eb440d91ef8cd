"""Words one edit apart, by permuterm rotations.

A word with a mark behind it is turned so that each of its characters stands last once. All words that
can replace that character share what is before it, a prefix that skips the edited character; a
shorter word of which it is an insertion has that very prefix as a whole rotation. So all rotations,
with and without their last character, are range partitioned and sorted, and each stretch of
equal prefixes is read once: its members are each other's neighbours. A stretch has at most one member
for each letter and one whole word, and only the count and the best neighbour of a member leave it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, id_and_text, rows, store

#: Stands behind a word; no word holds it.
MARK = "$"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: How many times as frequent as a word its form must be.
RATIO = 10
#: One run in this many (by checksum of its document and itself) loses a letter.
EVERY = 31
#: Distinct words a task counts before it passes them on.
_HELD = 200_000

_NEAR = "word string, n_near long, form_n long, form string"


def spelled(doc_id: int | None, run: str, start: int | None = None) -> str:
    """The run, or where its checksum says so the run without one code point. A null id is ``null``."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode()) if start is None else start)
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(least: int):
    """Words of a task's texts, counted; runs too short to give a word are not looked at."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}").findall

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(*rows(batch), strict=True):
                start = zlib.crc32(f"{'null' if doc is None else doc}:".encode())
                for found, n in Counter(runs(text.translate(LOWER).decode(errors="replace"))).items():
                    word = spelled(doc, found, start)
                    if len(word) >= least:
                        held[word] += n
                if len(held) > _HELD:
                    yield batch_of(held)
                    held = Counter()
        yield batch_of(held)

    return run


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of all texts."""
    return id_and_text(docs).mapInArrow(_count(least_length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``(key, edited, first, word, n)``: every rotation of every marked word, whole (edited 0) and without
    the character at its end (edited 1). ``first`` is false where the character before the edited one is
    the same: taking out either leaves the same word, and only the first of them stands for it."""
    w, size = F.col("word"), F.length("word")
    turned = lambda i, skip: F.concat(F.substring(w, i + 1 + skip, size), F.lit(MARK), F.substring(w, F.lit(1), i))
    whole = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(turned(i, 0).alias("key"), F.lit(0).alias("edited"), F.lit(True).alias("first")))
    new = lambda i: (i == 0) | (F.substring(w, i, F.lit(1)) != F.substring(w, i + 1, F.lit(1)))
    skipped = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(turned(i, 1).alias("key"), F.lit(1).alias("edited"), new(i).alias("first")))
    return words.filter(size > 0).select(F.explode(F.concat(whole, skipped)).alias("r"), "word", "n").select("r.key", "r.edited", "r.first", "word", "n")


def _best(members: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The two of largest count, the smaller word first among equals."""
    return sorted(members, key=lambda m: (-m[1], m[0]))[:2]


def neighbours(members: list[tuple[int, bool, str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """Of the members (edited, first, word, n) of one stretch: word, neighbours, and the best one's count and
    word. Edited words are neighbours of each other, and those that are ``first`` of the whole word."""
    edited = [(word, n) for e, _, word, n in members if e]
    firsts = [(word, n) for e, first, word, n in members if e and first]
    whole = [(word, n) for e, _, word, n in members if not e]
    top = _best(edited)
    for e, first, word, n in members:
        if not e:
            near, best = len(firsts), _best(firsts)
        else:
            near = len(edited) - 1 + (len(whole) if first else 0)
            best = _best([m for m in top if m[0] != word] + (whole if first else []))
        if near:
            yield word, near, best[0][1], best[0][0]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> what each member of a stretch of two or more learns there."""
    key, held = None, []

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n_near", "form_n", "form"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0)
        new = [0, *(pc.indices_nonzero(pc.not_equal(keys[1:], keys[:-1])).to_numpy() + 1).tolist()]
        columns = [batch.column(c).to_pylist() for c in range(1, 5)]
        out = []
        for begin, end in zip(new, [*new[1:], batch.num_rows], strict=True):
            own = keys[begin].as_py() if begin == 0 or end == batch.num_rows else None
            if begin or own != key:
                if len(held) > 1:
                    out += neighbours(held)
                held = []
            if own is not None or end - begin > 1:
                held += list(zip(*(c[begin:end] for c in columns), strict=True))
            if own is not None:
                key = own
        yield batch_of(out)
    yield batch_of(list(neighbours(held)) if len(held) > 1 else [])


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, form_n, form)`` of words (word, n) that have a neighbour: how many, and the most
    frequent one, the smallest in code-point order among equals."""
    ordered = rotations(words).repartitionByRange("key").sortWithinPartitions("key")
    found = ordered.mapInArrow(_scan, _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form")


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of (word, form): the last form reached. Steps double in each round; as counts grow with each
    step, chains are short and have no rings."""
    steps = store(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = store(steps.select("word", "root").join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if not steps.filter("moved").limit(1).count():
            return steps.select("word", "root")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word of the texts: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters, A-Z lower-cased, some of them less one letter (:func:`spelled`), with
    at least ``least_length`` code points and ``least_count`` occurrences. A word's form is its most
    frequent neighbour, if that is at least ``ratio`` times as frequent. A null or empty text has no words;
    a null id counts as the text ``null``; repeated rows all count; an empty table gives no rows. Other
    columns are not read.
    """
    words = store(count_words(docs, least_length, least_count), "words")
    near = words.join(near_words(words).withColumnRenamed("form_n", "best_n"), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = store(
        near.select(
            "word", F.when(is_form, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ), "near",
    )
    roots = follow(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
