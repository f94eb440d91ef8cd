"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints are counted in Arrow batches and equal ones become one class before anything is
compared, so exact copies cost one row. Classes that may lie within the radius meet by pigeonhole:
of ``PARTS`` parts of a fingerprint, ``PARTS - RADIUS`` must agree exactly if at most ``RADIUS`` bits
differ, so every choice of that many parts is a key. Within a key, 64 fingerprints at a time are
held as 64 bit planes; one query updates 64 distances at once in carry-save counters, and a block
leaves as soon as all its lanes are beyond the radius. Only a spanning star per key is passed on to
the distributed components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NULL_ID, fresh, id_and_text, rows, store

SHINGLE = 4
RADIUS = 4
SEED = 42
PARTS = 6
#: A key with more classes than this is compared in pairs of chunks of this size, each pair a row
#: group of its own, so that one key never has to be held or searched by one task.
CHUNK = 16_384
#: (query, block) pairs whose counters are updated together.
WIDTH = 1 << 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_ZERO, _ONE = np.uint64(0), np.uint64(1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit b is set if it is set in over half the shingles' hashes, repeats included."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[shingle:]] + [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=False)], dtype="<u8", count=n)
    set_bits = np.zeros(64, dtype=np.int64)
    for k in range(0, n, 1 << 16):  # a very long text a piece at a time
        set_bits += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = rows(batch)
        bits = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bits)], names=["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, bits)`` of every row; a text without words, or null, has fingerprint zero."""
    return id_and_text(docs).mapInArrow(_fingerprints, "doc_id long, bits long")


def _cuts(parts: int) -> list[tuple[int, int]]:
    edges = [64 * k // parts for k in range(parts + 1)]
    return list(zip(edges, edges[1:], strict=False))


def candidate_keys(bits: Column, parts: int = PARTS, radius: int = RADIUS) -> Column:
    """One key per choice of the parts that agree: a number of its choice, and those bits."""
    spans = _cuts(parts)
    keys = []
    for number, chosen in enumerate(combinations(range(parts), parts - radius)):
        mask = sum(((1 << (hi - lo)) - 1) << lo for lo, hi in (spans[c] for c in chosen))
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).cast("short").alias("choice"), bits.bitwiseAND(F.lit(signed).cast("long")).alias("agree")))
    return F.array(*keys)


def planes(prints: np.ndarray) -> np.ndarray:
    """Bit planes of ``prints`` in blocks of 64 lanes: word ``[block, b]`` has bit b of all its lanes."""
    blocks = -(-len(prints) // 64)
    padded = np.zeros(blocks * 64, dtype="<u8")
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(blocks, 64, 8), axis=2, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")).view("<u8")[:, :, 0]


def within(queries: np.ndarray, blocks: np.ndarray, sliced: np.ndarray, valid: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each pair of a query fingerprint and a block the lanes (a bit each) within ``radius``.

    ``ones``, ``twos``, ``fours`` are the digits of 64 counters; once a counter passes 7, or shows more
    than ``radius``, its lane is dead, and pairs without living lanes leave the computation.
    """
    out = np.zeros(len(queries), dtype=np.uint64)
    at = np.arange(len(queries))
    alive = valid.copy()
    ones, twos, fours = (np.zeros(len(at), dtype=np.uint64) for _ in range(3))
    for b in range(64):
        differ = sliced[blocks, b] ^ (_ZERO - ((queries >> np.uint64(b)) & _ONE))
        carry = ones & differ
        ones ^= differ
        carry, twos = twos & carry, twos ^ carry
        carry, fours = fours & carry, fours ^ carry
        alive &= ~carry
        if b % 8 == 7:
            alive &= ~_beyond(ones, twos, fours, radius)
            stay = alive != 0
            if not stay.all():
                at, queries, blocks, alive = at[stay], queries[stay], blocks[stay], alive[stay]
                ones, twos, fours = ones[stay], twos[stay], fours[stay]
            if not len(at):
                break
    out[at] = alive
    return out


def _beyond(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose three-digit count is above ``radius`` (at most 7)."""
    more, equal = np.zeros_like(ones), np.full_like(ones, _ALL)
    for digit, bit in ((fours, 4), (twos, 2), (ones, 1)):
        if radius & bit:
            equal &= digit
        else:
            more |= equal & digit
            equal &= ~digit
    return more


def stars(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct ``prints``, as places (member, root).

    Breadth first: the members reached so far query the lanes not reached yet, so a dense group is
    taken in by few queries, and blocks that are taken in wholly are not looked at again.
    """
    n = len(prints)
    sliced = planes(prints)
    open_ = np.full(len(sliced), _ALL, dtype=np.uint64)
    if n % 64:
        open_[-1] = np.uint64((1 << (n % 64)) - 1)
    found: list[tuple[int, int]] = []
    for root in range(n):
        if not int(open_[root >> 6]) >> (root & 63) & 1:
            continue
        open_[root >> 6] &= ~np.uint64(1 << (root & 63))
        front = np.array([root])
        while len(front):
            reached = []
            lanes = np.flatnonzero(open_)
            step = max(1, WIDTH // max(1, len(lanes)))
            for k in range(0, len(front), step):
                part = front[k : k + step]
                pair_q, pair_b = np.repeat(prints[part], len(lanes)), np.tile(lanes, len(part))
                near = within(pair_q, pair_b, sliced, open_[pair_b], radius)
                hit = np.flatnonzero(near)
                new = np.zeros_like(open_)
                np.bitwise_or.at(new, pair_b[hit], near[hit])
                for block in np.flatnonzero(new).tolist():
                    word = int(new[block])
                    reached += [block * 64 + i for i in range(64) if word >> i & 1]
                open_ &= ~new
            found += [(m, root) for m in reached]
            front = np.array(reached, dtype=np.int64)
    return found


def _small_stars(prints: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """:func:`stars` for many groups of at most 64 prints each: one block a group, all groups at once."""
    found: list[tuple[int, int]] = []
    budget = max(1, WIDTH // 4)
    for k in range(0, len(starts), budget):
        begin, size = starts[k : k + budget], sizes[k : k + budget]
        place = np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        block = np.repeat(np.arange(len(begin)), size)
        lane = (place - begin[block]).astype(np.uint64)
        padded = np.zeros((len(begin), 64), dtype=np.uint64)
        padded[block, lane.astype(np.int64)] = prints[place]
        sliced = planes(padded.reshape(-1))
        full = np.where(size == 64, _ALL, (_ONE << (size % 64).astype(np.uint64)) - _ONE)
        near = np.zeros(len(place), dtype=np.uint64)
        for j in range(0, len(place), WIDTH):
            s = slice(j, j + WIDTH)
            near[s] = within(prints[place[s]], block[s], sliced, full[block[s]] & ~(_ONE << lane[s]), radius)
        linked = np.flatnonzero(near)
        words = dict(zip(place[linked].tolist(), near[linked].tolist(), strict=True))
        first = dict(zip(place[linked].tolist(), begin[block[linked]].tolist(), strict=True))
        done: set[int] = set()
        for root in words:
            if root in done:
                continue
            base, seen, work = first[root], 1 << (root - first[root]), [root]
            while work:
                fresh = words[work.pop()] & ~seen
                seen |= fresh
                while fresh:
                    low = fresh & -fresh
                    member = base + low.bit_length() - 1
                    found.append((member, root))
                    done.add(member)
                    work.append(member)
                    fresh ^= low
            done.add(root)
    return found


def _linker(radius: int, width: int):
    """Over rows sorted by their first ``width`` columns (the key), with the fingerprint last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            if held:
                columns = [np.concatenate(c) for c in zip(held, columns, strict=True)]
            new = np.zeros(len(columns[0]), dtype=bool)
            for key in columns[:width]:
                new[1:] |= key[1:] != key[:-1]
            last = int(np.flatnonzero(new)[-1]) if new.any() else 0  # the last group may go on in the next batch
            yield from _links([c[:last] for c in columns], new[:last], radius)
            held = [c[last:] for c in columns]
        if held:
            new = np.zeros(len(held[0]), dtype=bool)
            for key in held[:width]:
                new[1:] |= key[1:] != key[:-1]
            yield from _links(held, new, radius)

    return run


def _links(columns: list[np.ndarray], new: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    n = len(new)
    if not n:
        return
    starts = np.concatenate(([0], np.flatnonzero(new)))
    sizes = np.diff(np.concatenate((starts, [n])))
    prints = columns[-1].view(np.uint64)
    some = (sizes > 1) & (sizes <= 64)
    found = _small_stars(prints, starts[some], sizes[some], radius)
    for start, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        found += [(m + start, r + start) for m, r in stars(prints[start : start + size], radius)]
    if found:
        pairs = np.array(found)
        signed = prints.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[pairs[:, 0]]), pa.array(signed[pairs[:, 1]])], names=["a", "b"])


def links(classes: DataFrame, radius: int = RADIUS, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """Edges ``(a, b)`` between distinct ``bits`` whose components are those of all links within ``radius``.

    Keys are counted first (map side combined). A key with more than ``chunk`` classes has its classes
    dealt into chunks by a hash, and each pair of chunks is a group; all other keys are the same case
    with one chunk.
    """
    keyed = classes.select("bits", F.explode(candidate_keys(F.col("bits"), parts, radius)).alias("key")).select("key.choice", "key.agree", "bits")
    big = keyed.groupBy("choice", "agree").count().filter(F.col("count") > chunk).select("choice", "agree", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    sized = keyed.join(big, ["choice", "agree"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("bits"), F.col("chunks")).cast("int")
    other = F.sequence(F.lit(0), F.col("chunks") - 1)
    # With one chunk the only pair is (0, 0); else every chunk meets every other once, itself included.
    pair = F.explode(F.transform(other, lambda o: F.struct(F.least(own, o).alias("lo"), F.greatest(own, o).alias("hi"))))
    grouped = sized.select("choice", "agree", pair.alias("pair"), "bits").select("choice", "agree", "pair.lo", "pair.hi", "bits")
    keys = ["choice", "agree", "lo", "hi"]
    dealt = grouped.repartition(*keys).sortWithinPartitions(*keys, "bits")
    return dealt.mapInArrow(_linker(radius, len(keys)), "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges``; root is the smallest node it is connected with.

    Large-star then small-star on stored edges until nothing changes: each node's neighbours are
    re-hung on the smallest one, so paths shorten geometrically. No group is collected; a hub is only
    aggregated and joined on.
    """
    edges = store(edges.filter("a <> b"), "edges")
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        down = large.filter("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        hung = down.join(low, "a")
        small = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).union(hung.select("a", F.col("low").alias("b")))
        edges = store(small.filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots


def resolve(docs: DataFrame, radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, bits)`` of every row, with ``NULL_ID`` for null, and ``(bits, root, component_id)`` of
    every distinct fingerprint."""
    prints = store(fingerprints(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "bits"), "prints")
    classes = store(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes.select("bits"), radius))
    rooted = classes.join(roots, classes["bits"] == roots["node"], "left").select("bits", "first", F.coalesce("root", "bits").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints, rooted.join(firsts, "root").select("bits", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row.

    component_id is the smallest doc_id that links of at most ``radius`` differing bits reach, the
    row's own included. Rows with a null id take part; their id counts as the largest, and a
    component of such rows only has a null component_id. Repeated rows come back repeated, other
    columns are not read, an empty table gives no rows.
    """
    prints, named = resolve(docs, radius)
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return prints.join(named, "bits").select(real("doc_id"), F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), real("component_id"))


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one row of each component left: of those with the smallest id the one
    with the smallest text (a null text first). Rows without an id only stay where a whole component
    has none. Unlike rows that share an id stay each for its own component. All columns of ``docs`` come back."""
    prints, named = resolve(docs, radius)
    named = store(named, "named")
    own, bits, root, first, kept_id, several, row = (fresh(c, docs) for c in ("own_bits", "their_bits", "their_root", "their_first", "kept_id", "several", "kept_row"))
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    often = prints.groupBy("doc_id").agg((F.count("*") > 1).alias(several))
    kept = named.filter(F.col("component_id") != NULL_ID).select(F.col("component_id").alias("doc_id")).distinct()
    kept = kept.join(often, "doc_id").select(F.col("doc_id").alias(kept_id), several)
    found = docs.join(kept, docs["doc_id"] == kept[kept_id])
    firsts = found.filter(~F.col(several)).select(*columns)  # an id of one row: that row is its component's first
    unsure = found.filter(several).select(*columns).unionByName(docs.filter(docs["doc_id"].isNull()))
    place, column = len(docs.columns), docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(column).cast(pa.binary()).to_pylist()
            bits = np.array([fingerprint(t or b"") for t in texts], dtype=np.uint64).view(np.int64)
            columns = list(batch.columns)
            columns[place] = pa.array(bits)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    printed = unsure.withColumn(own, F.lit(None).cast("long"))
    printed = printed.mapInArrow(add, printed.schema)
    theirs = named.select(F.col("bits").alias(bits), F.col("root").alias(root), F.col("component_id").alias(first))
    of_first = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)) == F.col(first)
    candidates = printed.join(theirs, printed[own] == theirs[bits]).filter(of_first)
    best = candidates.groupBy(F.col(root)).agg(F.min_by(F.struct(*columns), F.struct("text")).alias(row))
    others = best.select(*(F.col(row).getField(c).alias(c) for c in docs.columns))
    return firsts.unionByName(others)
