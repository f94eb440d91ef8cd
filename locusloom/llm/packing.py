"""Best-fit packing of token sequences by bin completion.

Only the histogram of piece lengths decides a packing, and it has at most as many entries as a
sequence has tokens, whatever the corpus. So the search runs on the histogram: it fills sequences
around the largest length left, with as many equal sequences at once as the counts allow. The pieces
themselves are numbered within their length and find their place by that number, so no task ever
holds more than its own rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, rows, store
from .tokens import byte_bpe

CAPACITY = 2048
END = 0
#: Alternative fillings that are tried first for one sequence, and steps of the search beyond one full
#: dive, which are its only limit.
FILLINGS = 12
MORE_STEPS = 2_000

Pattern = tuple[int, ...]


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over a histogram: ``(lengths, times)`` of the sequences it makes."""
    room: dict[int, list[tuple[Pattern, int]]] = {}
    rests: list[int] = []

    def put(rest: int, pattern: Pattern, times: int) -> None:
        if rest not in room:
            insort(rests, rest)
            room[rest] = []
        room[rest].append((pattern, times))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(rests, size)
            if at == len(rests):
                each = capacity // size
                for n, times in ((each, left // each), (left % each, 1)):
                    if n and times:
                        put(capacity - n * size, (size,) * n, times)
                break
            rest = rests[at]
            pattern, times = room[rest].pop()
            if not room[rest]:
                del room[rest]
                rests.pop(at)
            each = rest // size
            full = min(times, left // each)
            over = left - full * each if full < times else 0
            over = min(over, each - 1)
            if full:
                put(rest - each * size, pattern + (size,) * each, full)
            if over:
                put(rest - over * size, pattern + (size,) * over, 1)
            if times - full - (over > 0):
                put(rest, pattern, times - full - (over > 0))
            left -= full * each + over
    return [entry for rest in rests for entry in room[rest]]


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: lengths above ``capacity - k`` stand alone, those above half share none, and
    what of the lengths from k to half doesn't fit beside them needs more; the best over all k."""
    if not counts:
        return 0
    n = np.zeros(capacity + 1, dtype=np.int64)
    for size, times in counts.items():
        n[size] = times
    number, total = np.cumsum(n), np.cumsum(n * np.arange(capacity + 1))
    half = capacity // 2
    best = -(-int(total[-1]) // capacity)
    for k in range(1, half + 1):
        alone = int(number[-1] - number[capacity - k])
        wide = int(number[capacity - k] - number[half])
        wide_sum = int(total[capacity - k] - total[half])
        small = int(total[half] - total[k - 1])
        best = max(best, alone + wide + max(0, -(-(small - (wide * capacity - wide_sum)) // capacity)))
    return best


def _dominates(better: Pattern, worse: Pattern) -> bool:
    """True if the items of ``worse`` can be parted over those of ``better`` (tried largest first)."""
    room = sorted(better)
    for item in worse:
        at = bisect_left(room, item)
        if at == len(room):
            return False
        rest = room.pop(at) - item
        insort(room, rest)
    return True


def fillings(sizes: list[int], counts: dict[int, int], room: int) -> list[Pattern]:
    """The first undominated maximal fillings of ``room`` to try, from the ascending ``sizes`` that are left,
    the fullest first; :func:`all_fillings` has the others."""
    if counts.get(room):
        return [(room,)]  # one item that fills the room dominates all other fillings
    top = bisect_right(sizes, room)
    if not top:
        return [()]
    found: dict[Pattern, None] = {}
    for a in reversed(sizes[max(0, top - 64) : top]):  # two items that fill the room
        b = room - a
        if b > a:
            break
        if counts.get(b, 0) > (a == b):
            found[(a, b)] = None
            if len(found) == FILLINGS // 2:
                break

    budget = 8 * FILLINGS
    width = 3

    def extend(chosen: Pattern, rest: int, limit: int) -> None:
        nonlocal budget
        budget -= 1
        at = bisect_right(sizes, min(rest, limit))
        tried = 0
        if counts.get(rest, 0) > chosen.count(rest) and rest <= limit:
            found[(*chosen, rest)] = None
            return
        while at and tried < width and budget > 0:
            at -= 1
            if counts[sizes[at]] > chosen.count(sizes[at]):
                tried += 1
                extend((*chosen, sizes[at]), rest - sizes[at], sizes[at])
        if not tried:
            found[chosen] = None

    # First a few of the largest at each place, for different fillings; then all, for few items.
    extend((), room, room)
    budget, width = 8 * FILLINGS, len(sizes)
    extend((), room, room)
    ranked = sorted(found, key=lambda p: (room - sum(p), len(p), [-x for x in p]))
    kept: list[Pattern] = []
    for p in ranked:
        if len(kept) < FILLINGS and not any(_dominates(k, p) for k in kept):
            kept.append(p)
    return kept


def all_fillings(sizes: list[int], counts: dict[int, int], room: int) -> Iterator[Pattern | None]:
    """Lazily every filling that no other dominates, with some that are; None for each step between."""
    frames = [[(), room, bisect_right(sizes, room), False]]
    while frames:
        frame = frames[-1]
        chosen, rest, at, fits = frame
        yield None
        while at and counts[sizes[at - 1]] <= chosen.count(sizes[at - 1]):
            at -= 1
        if not at:
            if not fits:
                yield chosen
            frames.pop()
            continue
        size = sizes[at - 1]
        frame[2:] = at - 1, True
        if size == rest:  # one item that fills the rest dominates all other ways to do so
            frames.pop()
            yield (*chosen, size)
        else:
            frames.append([(*chosen, size), rest - size, bisect_right(sizes, min(rest - size, size)), False])


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, more_steps: int = MORE_STEPS) -> list[tuple[Pattern, int]]:
    """``(lengths, times)`` of the sequences of the best packing found.

    Depth first: the largest length left gets each undominated filling, as often as the counts allow
    and then once (so, over again, any number of times). A first search has some fillings only; if it
    ends without reaching the lower bound, a second one has all. A branch is left when its wasted tokens exceed what a packing better than the
    incumbent may waste. Best-fit decreasing is the first incumbent, and also what is kept if the
    search ends after one full dive and ``more_steps`` more steps; it ends earlier at the lower bound.
    """
    counts = {s: int(n) for s, n in counts.items() if n}
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError("lengths lie between 1 and the capacity")
    best = best_fit(counts, capacity)
    fewest, bound = sum(n for _, n in best), least_sequences(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    sizes = sorted(counts)
    steps = 4 * len(sizes) + more_steps
    made: list[tuple[Pattern, int]] = []
    used = wasted = 0
    stack: list[tuple[Iterator[tuple[Pattern, int]], int]] = []

    def take(pattern: Pattern, times: int) -> None:
        nonlocal used, wasted
        used += times
        wasted += times * (capacity - sum(pattern))
        for s in pattern:
            was = counts[s]
            counts[s] -= times
            if not counts[s]:
                sizes.pop(bisect_left(sizes, s))
            elif not was:
                insort(sizes, s)

    def choices(every: bool) -> Iterator[tuple[Pattern, int] | None]:
        largest = sizes[-1]
        counts[largest] -= 1
        rest = [s for s in sizes if counts[s]] if not counts[largest] else sizes
        options = fillings(rest, counts, capacity - largest)
        counts[largest] += 1
        whole = [(largest, *p) for p in options]
        most = [min(counts[s] // p.count(s) for s in set(p)) for p in whole]
        yield from zip(whole, most, strict=True)
        yield from ((p, 1) for p, m in zip(whole, most, strict=True) if m > 1)
        if not every:
            return
        left = counts | {largest: counts[largest] - 1}
        for p in all_fillings([s for s in sizes if left[s]], left, capacity - largest):
            if p is None:
                yield None
            elif not any(_dominates(k, p) for k in options):
                options.append(p)
                p = (largest, *p)
                m = min(counts[s] // p.count(s) for s in set(p))
                yield p, m
                if m > 1:
                    yield p, 1

    every = False
    while fewest > bound and steps > 0:
        steps -= 1
        if not sizes:
            if used < fewest:
                fewest, best = used, list(made)
        elif wasted <= (fewest - 1) * capacity - total:
            stack.append((choices(every), len(made)))
        while stack:
            options, depth = stack[-1]
            while len(made) > depth:
                pattern, times = made.pop()
                take(pattern, -times)
            step = next(options, ())
            if step:
                take(*step)
                made.append(step)
                break
            if step is None:  # a step of the enumeration
                steps -= 1
                if steps <= 0:
                    break
            else:
                stack.pop()
        if not stack:
            if every:
                break
            every = True
    return best


def _cut(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path)
        part = TaskContext.get().partitionId()
        ranks: dict[int, int] = {}
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(*rows(batch), strict=True):
                ids = np.append(coder.encode(text.decode()), np.uint32(end)).astype("<u4")
                start, piece = 0, 0
                while start < len(ids):
                    stop = start + capacity if start else len(ids) % capacity or capacity
                    length = stop - start
                    rank = ranks.get(length, 0)
                    ranks[length] = rank + 1
                    out.append((doc, piece, start, length, zlib.crc32(ids[start:stop].tobytes()), part, rank))
                    start, piece = stop, piece + 1
            columns = zip(*out, strict=True) if out else [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return run


def _placer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, sequence, offset = shared.value
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (3, 5))
            at = np.searchsorted(keys, length * (1 << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and then ``end``; a null or empty text is ``end`` alone. One that is longer
    than ``capacity`` is cut, the odd rest first. Null ids and repeated rows are packed like any other
    row; other columns are not read; an empty table gives no rows. Ids are computed once: the pieces
    are stored narrow in the shared folder, numbered within their length by their writing task.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
    pieces = store(id_and_text(docs).mapInArrow(_cut(path, capacity, end), schema), "pieces")
    counted = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    found = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    plan = complete_bins({r["length"]: r["n"] for r in found}, capacity)
    return _place(spark, pieces, bases, plan)


def _place(spark, pieces: DataFrame, bases: DataFrame, plan: list[tuple[Pattern, int]]) -> DataFrame:
    """Pieces of a length take the slots of that length in the order of their numbers."""
    taken: dict[int, int] = {}
    slots: list[tuple[int, int, int, int]] = []
    sequences = 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            first = taken.get(length, 0)
            slots.append((length * (1 << 48) + first, first, sequences, offset))
            taken[length] = first + times
            offset += length
        sequences += times
    columns = tuple(np.array(c, dtype=np.int64) for c in zip(*sorted(slots), strict=True)) if slots else (np.zeros(0, np.int64),) * 4
    # A slot a length of a pattern; a dive adds at most some patterns for each of ``capacity`` lengths.
    shared = spark.sparkContext.broadcast(columns)
    numbered = pieces.join(bases, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    return numbered.mapInArrow(_placer(shared), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
