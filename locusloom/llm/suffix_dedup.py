"""Repeated byte windows, by depth-limited radix sort of suffixes.

Only the first ``DEPTH`` bytes of a suffix matter: equal groups after that many bytes are exactly the
repeated windows. Ordering every suffix of the corpus would shuffle it many times over, so windows
are first dealt by an anchor: the window's smallest hashed ``ANCHOR``-byte string. Equal windows have
equal anchors at equal places, and neighbouring windows mostly share theirs, so a run of windows
travels as one short context.

1. Each shard of documents tells each bucket of anchors which ones it has (packed, deduplicated) and
   in how many contexts; the bucket answers with two bits for each: whether any other document may
   have it too, and whether it is hot, that is in more than ``HOT`` contexts of all shards.
2. Shards send the distinct contexts of those anchors, with the smallest document that has them.
   The bucket merges equal contexts and radix-sorts the windows of the others, most significant
   digits first; groups of one leave after each pass. Its answer is, for runs of windows, the smallest
   document of the corpus. Windows of hot anchors are dealt one by one instead, by a hash of their
   bytes and place, so no anchor is one group; equal ones meet, and there is nothing to sort.
3. Shards mark the windows of every document that a smaller document has, and cut them.

No sender writes to more than ``FAN`` receivers, so the messages grow with the bytes and not with shards
times buckets. Where there are more buckets, messages go by ranges of them: a router takes what about
as many shards sent to one range, merges equal keys, contexts and windows, and sends them on to the
parts of that range; answers come back the same way. A router holds about as much as a shard.

The text is shuffled once; the same exchange serves all three steps. An anchor or a passage that a
third of all documents share is one entry for each shard, and one behind each router; a short string
between ever different neighbours is spread over all buckets.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, id_and_text

DEPTH = 50
ANCHOR = 16
#: Text bytes, about, of a shard of documents, and of the corpus for each bucket of anchors. They bound
#: the memory of a task.
SHARD_BYTES = 6_000_000
BUCKET_BYTES = 3_000_000
#: Receivers that a shard or a router sends to at most: a message is still some kilobytes. Each level
#: of receivers beyond the first shuffles the keys and contexts once more.
FAN = 1024
#: Windows that are sorted at once, unless one anchor has more.
WINDOWS = 250_000
#: Contexts (of at most 35 windows each) that one anchor may have in a bucket; the windows of an anchor
#: with more are dealt singly. It changes memory and traffic, never results.
HOT = 30_000
#: Runs of an anchor in a shard up to which equal ones count as different, which only makes it hot earlier.
_FEW = 4
_SEGMENT = (1 << 20) - 64
_PLACE = np.uint64((1 << 20) - 1)
_KEY_BITS = 48
#: Odd multipliers of the anchor hash.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))

_MESSAGE = "bucket int, shard int, kind int, body binary"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, copies long"


def _pack(*columns: np.ndarray) -> bytes:
    raw = b"".join(struct.pack("<I", c.nbytes) + c.tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    out, at = [], 0
    for kind in kinds:
        (n,) = struct.unpack_from("<I", raw, at)
        out.append(np.frombuffer(raw, dtype=kind, count=n // np.dtype(kind).itemsize, offset=at + 4))
        at += 4 + n
    return out


def _hashes(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of ``ANCHOR`` bytes as two words."""
    hashes = low * _MIX[0] + (high ^ (high >> np.uint64(31))) * _MIX[1]
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX[2]
    hashes ^= hashes >> np.uint64(29)
    return hashes


def _keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of anchors. An anchor is the least of 35 hashes, so its own hash is a small number: mixed
    again, keys are even."""
    keys = hashes * _MIX[1]
    keys ^= keys >> np.uint64(32)
    keys *= _MIX[2]
    return (keys >> np.uint64(64 - _KEY_BITS)).astype(np.int64)


def _edges(first: int, fan: int, n: int) -> np.ndarray:
    """Bounds of the keys of ``fan`` of ``n`` buckets from ``first`` on; a bucket is a range of the key."""
    return np.array([-(-(k << _KEY_BITS) // n) for k in range(first, first + fan + 1)], dtype=np.int64)


def _segments(texts: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Buffers of bounded size and what they hold: (document, place in the buffer, place in the document,
    bytes). A longer document comes in pieces that overlap so that each window lies in one of them."""
    buffer: list[bytes] = []
    held: list[tuple[int, int, int, int]] = []
    size = 0
    for d, text in enumerate(texts):
        for begin in range(0, max(1, len(text) - DEPTH + 1), _SEGMENT - DEPTH + 1):
            piece = text[begin : begin + _SEGMENT]
            if len(piece) < DEPTH:
                continue
            if size + len(piece) > _SEGMENT:
                yield b"".join(buffer), held
                buffer, held, size = [], [], 0
            held.append((d, size, begin, len(piece)))
            buffer.append(piece)
            size += len(piece)
    if held:
        yield b"".join(buffer), held


def window_runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows of a document that share an anchor: document, first window, number of
    windows, place of the anchor in the first window, and ``_KEY_BITS`` bits of its hash."""
    width = DEPTH - ANCHOR + 1
    parts: list[tuple[np.ndarray, ...]] = []
    for buffer, held in _segments(texts):
        n = len(buffer)
        words = np.ndarray((n + 1,), dtype="<u8", buffer=buffer + bytes(8), strides=(1,)).copy()
        hashes = _hashes(words[: n - 15], words[8 : n - 7])
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        windows = np.concatenate([np.arange(at, at + size - DEPTH + 1) for _, at, _, size in held])
        anchors = (least[windows] & _PLACE).astype(np.int64)
        new = np.ones(len(windows), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(windows)))
        begin, anchor = windows[first], anchors[first]
        docs, places, offsets, _ = (np.array(c, dtype=np.int64) for c in zip(*held, strict=True))
        of = np.searchsorted(places, begin, side="right") - 1
        parts.append((docs[of], begin - places[of] + offsets[of], count, anchor - begin, _keys(hashes[anchor])))
    if not parts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


class Shard:
    """The documents of a shard in order of id and text, with how many rows each stands for, and the runs
    of their windows."""

    def __init__(self, table: pa.Table):
        docs = zip(*(table.column(c).to_pylist() for c in ("doc_id", "text", "copies")), strict=True)
        self.docs = sorted(docs)
        self.texts = [t for _, t, _ in self.docs]
        self.ids = np.array([d for d, _, _ in self.docs], dtype=np.int64)
        self.doc, self.first, self.count, self.place, keys = window_runs(self.texts)
        self.keys, self.key_of = np.unique(keys, return_inverse=True)

    def buckets(self, n: int) -> np.ndarray:
        """Bounds of the buckets in the sorted distinct keys."""
        return np.searchsorted(self.keys, _edges(0, n, n))

    def shared_inside(self) -> np.ndarray:
        """For each distinct key whether two documents of different ids have it."""
        ids = self.ids[self.doc]
        low = np.full(len(self.keys), np.iinfo(np.int64).max)
        high = np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.key_of, ids)
        np.maximum.at(high, self.key_of, ids)
        return low < high

    def n_contexts(self) -> np.ndarray:
        """For each distinct key in how many different contexts it is, or if it has few runs how many."""
        runs = np.bincount(self.key_of, minlength=len(self.keys))
        many = runs > _FEW
        if many.any():
            found = np.bincount(self.contexts(many)[1], minlength=len(self.keys))
            runs[many] = found[many]
        return runs

    def windows(self, hot: np.ndarray, n_buckets: int) -> tuple[np.ndarray, ...]:
        """The windows of the runs whose key is ``hot``, each with its anchor's place as the last byte.
        Of the distinct ones, in order of bucket: bytes, bucket, smallest id; and of all of them:
        document, place in it, number of the distinct one."""
        runs = np.flatnonzero(hot[self.key_of])
        count = self.count[runs]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        doc, start = np.repeat(self.doc[runs], count), np.repeat(self.first[runs], count) + inside
        place = np.repeat(self.place[runs], count) - inside
        numbers: dict[bytes, int] = {}
        texts, last = self.texts, bytes(range(256))
        of = np.empty(len(doc), dtype=np.int64)
        for k, (d, s, p) in enumerate(zip(doc.tolist(), start.tolist(), place.tolist(), strict=True)):
            of[k] = numbers.setdefault(texts[d][s : s + DEPTH] + last[p : p + 1], len(numbers))
        bucket = np.array([zlib.crc32(w) % n_buckets for w in numbers], dtype=np.int64)
        low = np.full(len(numbers), np.iinfo(np.int64).max)
        np.minimum.at(low, of, self.ids[doc])
        order = np.argsort(bucket, kind="stable")
        turned = np.empty(len(order), dtype=np.int64)
        turned[order] = np.arange(len(order))
        data = np.frombuffer(b"".join(numbers), dtype="u1").reshape(-1, DEPTH + 1)
        return data[order], bucket[order], low[order], doc, start, turned[of]

    def contexts(self, wanted: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct contexts of the runs whose key is ``wanted``, in order of key: the last byte of each
        is its anchor's place. With them: key, smallest id, and the runs with their context's number."""
        runs = np.flatnonzero(wanted[self.key_of])
        runs = runs[np.argsort(self.key_of[runs], kind="stable")]
        numbers: dict[bytes, int] = {}
        texts, last = self.texts, bytes(range(256))
        of = np.empty(len(runs), dtype=np.int64)
        columns = (self.doc[runs].tolist(), self.first[runs].tolist(), self.count[runs].tolist(), self.place[runs].tolist())
        for k, (d, s, c, p) in enumerate(zip(*columns, strict=True)):
            of[k] = numbers.setdefault(texts[d][s : s + c + DEPTH - 1] + last[p : p + 1], len(numbers))
        key = np.zeros(len(numbers), dtype=np.int64)
        key[of] = self.key_of[runs]
        low = np.full(len(numbers), np.iinfo(np.int64).max)
        np.minimum.at(low, of, self.ids[self.doc[runs]])
        return list(numbers), key, low, runs, of


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "shard", "kind", "body"])


def _deltas(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as byte planes of their steps."""
    steps = np.diff(keys, prepend=0).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T[: _KEY_BITS // 8])


def _undeltas(planes: np.ndarray) -> np.ndarray:
    n = len(planes) // (_KEY_BITS // 8)
    full = np.zeros((n, 8), dtype=np.uint8)
    full[:, : _KEY_BITS // 8] = planes.reshape(-1, n).T if n else 0
    return np.cumsum(full.view("<u8").reshape(-1).astype(np.int64))


def _offer(n_buckets: int):
    """Shard -> buckets: its distinct keys, whether it has each in two documents, and in how many contexts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = Shard(table)
        inside, number, bounds, rows = shard.shared_inside(), shard.n_contexts(), shard.buckets(n_buckets), []
        for b in range(n_buckets):
            part = slice(int(bounds[b]), int(bounds[b + 1]))
            if bounds[b] < bounds[b + 1]:
                rows.append((b, key[0].as_py(), 0, _pack(_deltas(shard.keys[part]), np.packbits(inside[part]), number[part].astype("<u4"))))
        return _messages(rows)

    return run


def _offered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys that senders offered, whether two documents may have each, in how many contexts each
    is, and for each message the numbers of its keys."""
    bodies = [_unpack(b, "u1", "u1", "<u4") for b in table.column("body").to_pylist()]
    keys = [_undeltas(k) for k, _, _ in bodies]
    distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
    numbers = np.split(of, np.cumsum([len(k) for k in keys])[:-1])
    mark = np.bincount(of, minlength=len(distinct)) > 1
    total = np.zeros(len(distinct), dtype=np.int64)
    for own, (_, inside, n) in zip(numbers, bodies, strict=True):
        mark[own] |= np.unpackbits(inside, count=len(own)).astype(bool)
        total[own] += n
    return distinct, mark, total, numbers


def _mark(table: pa.Table, numbers: list[np.ndarray], mark: np.ndarray, many: np.ndarray) -> pa.Table:
    """To each sender of ``table`` two bits for each of its keys."""
    rows = []
    for b, s, own in zip(table.column("bucket").to_pylist(), table.column("shard").to_pylist(), numbers, strict=True):
        if mark[own].any():
            rows.append((b, s, 1, _pack(np.packbits(mark[own]), np.packbits((mark & many)[own]))))
    return _messages(rows)


def _shared(hot_contexts: int = HOT):
    """Bucket -> senders: two bits for each key that was offered: it is in two documents; it is hot."""

    def run(table: pa.Table) -> pa.Table:
        _, mark, total, numbers = _offered(table)
        return _mark(table, numbers, mark, total > hot_contexts)

    return run


def _wanted(n_keys: int, bounds: np.ndarray, answers: pa.Table, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct key of a sender to the buckets from ``first`` on: its contexts are wanted; its
    windows are, one by one."""
    wanted, hot = np.zeros((2, n_keys), dtype=bool)
    for b, kind, body in zip(answers.column("bucket").to_pylist(), answers.column("kind").to_pylist(), answers.column("body").to_pylist(), strict=True):
        if kind == 1:
            lo, hi = int(bounds[b - first]), int(bounds[b - first + 1])
            mark, many = (np.unpackbits(x, count=hi - lo).astype(bool) for x in _unpack(body, "u1", "u1"))
            wanted[lo:hi], hot[lo:hi] = mark & ~many, many
    return wanted, hot


def _context_rows(first: int, sender: int, edges: np.ndarray, contexts: list[bytes], low: np.ndarray) -> list[tuple[int, int, int, bytes]]:
    rows = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        lo, hi = int(edges[b]), int(edges[b + 1])
        part = contexts[lo:hi]
        sizes = np.array([len(c) for c in part], dtype="u1")
        rows.append((first + b, sender, 2, _pack(sizes, low[lo:hi], np.frombuffer(b"".join(part), dtype="u1"))))
    return rows


def _window_rows(first: int, sender: int, edges: np.ndarray, data: np.ndarray, low: np.ndarray) -> list[tuple[int, int, int, bytes]]:
    parts = [(b, slice(int(edges[b]), int(edges[b + 1]))) for b in np.flatnonzero(np.diff(edges)).tolist()]
    return [(first + b, sender, 4, _pack(low[part], data[part])) for b, part in parts]


def _send(n_buckets: int, leaves: int | None = None):
    """Shard -> buckets: the distinct contexts of shared anchors, and the distinct windows of hot ones, each
    with its smallest document. The buckets are ranges of ``leaves`` ones."""
    leaves = leaves or n_buckets

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not answers.num_rows or not docs.num_rows:
            return _messages([])
        shard = Shard(docs)
        bounds = shard.buckets(n_buckets)
        wanted, hot = _wanted(len(shard.keys), bounds, answers)
        contexts, at, low, _, _ = shard.contexts(wanted)  # in order of key
        rows = _context_rows(0, key[0].as_py(), np.searchsorted(at, bounds), contexts, low)
        if hot.any():
            data, leaf, low, _, _, _ = shard.windows(hot, leaves)
            edges = np.searchsorted(leaf // (leaves // n_buckets), np.arange(n_buckets + 1))
            rows += _window_rows(0, key[0].as_py(), edges, data, low)
        return _messages(rows)

    return run


def radix_groups(data: np.ndarray, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``DEPTH`` bytes at ``starts`` that equal another one of their first ``group``, and the
    number of their equal group. One pass a digit of eight bytes, most significant first, over the
    windows whose group still has two members."""
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=data.tobytes() + bytes(8), strides=(1,))
    alive = np.arange(len(starts))
    for digit in [None, *range(0, DEPTH - 7, 8), DEPTH - 8]:
        if not len(alive):
            break
        if digit is None:
            order = np.argsort(group, kind="stable")
            new = group[order][1:] != group[order][:-1]
        else:
            value = words[starts[alive] + digit]
            order = np.lexsort((value, group))
            new = (group[order][1:] != group[order][:-1]) | (value[order][1:] != value[order][:-1])
        alive = alive[order]
        group = np.concatenate(([0], np.cumsum(new)))
        size = np.bincount(group)
        stay = size[group] > 1
        alive, group = alive[stay], group[stay]
    return alive, group


def _parts(groups: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Slices of whole groups (which are in order) with about ``WINDOWS`` windows each."""
    ends = np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, len(groups)) if len(groups) else []
    begin = 0
    held = np.cumsum(sizes)
    for end in ends:
        if held[end - 1] - (held[begin - 1] if begin else 0) >= WINDOWS or end == len(groups):
            yield slice(begin, int(end))
            begin = int(end)


def _split(contexts: list[bytes], some: np.ndarray, groups: np.ndarray, sizes: np.ndarray, least: np.ndarray, split: dict[int, list[tuple[int, int, int]]]) -> None:
    """Into ``split``: runs (first window, windows, smallest document) of each context of ``some``."""
    n = sizes[some]
    data = np.frombuffer(b"".join(contexts[k] for k in some), dtype="u1")
    bases = np.concatenate(([0], np.cumsum(n + DEPTH)))[:-1]
    inside = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)))[:-1], n)
    places = np.repeat(np.array([contexts[k][-1] for k in some], dtype=np.int64), n) - inside
    context = np.repeat(some, n)
    alive, equal = radix_groups(data, np.repeat(bases, n) + inside, groups[context] * 64 + places)
    low = least[context]
    if len(alive):
        best = np.full(int(equal.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(best, equal, low[alive])
        low[alive] = best[equal]
    new = np.ones(len(low), dtype=bool)
    new[1:] = (context[1:] != context[:-1]) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)
    for c, w, length, doc in zip(context[first].tolist(), inside[first].tolist(), np.diff(np.append(first, len(low))).tolist(), low[first].tolist(), strict=True):
        split.setdefault(c, []).append((w, length, doc))


def _of_kind(table: pa.Table, kind: int) -> pa.Table:
    """Messages of a kind in order of sender, so that a router numbers them alike each time it runs."""
    return table.filter(pa.array(table.column("kind").to_numpy() == kind)).sort_by("shard")


def _distinct(bodies: Iterator[tuple[np.ndarray, list[bytes]]]) -> tuple[list[bytes], np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Distinct items of messages ``(smallest documents, items)``, the smallest document of each, and for
    each message the numbers of its items and its own smallest documents. One message is open at a time."""
    numbers: dict[bytes, int] = {}
    of, own = [], []
    for low, items in bodies:
        of.append(np.array([numbers.setdefault(item, len(numbers)) for item in items], dtype=np.int64))
        own.append(low)
    least = np.full(len(numbers), np.iinfo(np.int64).max)
    for mine, low in zip(of, own, strict=True):
        np.minimum.at(least, mine, low)
    return list(numbers), least, of, own


def _contexts(table: pa.Table) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    for body in table.column("body"):
        sizes, low, data = _unpack(body.as_py(), "u1", "<i8", "u1")
        raw, ends = data.tobytes(), np.cumsum(sizes, dtype=np.int64).tolist()
        yield low, [raw[begin:end] for begin, end in zip([0, *ends[:-1]], ends, strict=True)]


def _windows(table: pa.Table) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    for body in table.column("body"):
        low, data = _unpack(body.as_py(), "<i8", "u1")
        raw = data.tobytes()
        yield low, [raw[k : k + DEPTH + 1] for k in range(0, len(raw), DEPTH + 1)]


def _tell_windows(table: pa.Table, of: list[np.ndarray], own: list[np.ndarray], least: np.ndarray) -> list[tuple[int, int, int, bytes]]:
    """To each sender, for its windows of hot anchors, the smallest document where it is smaller than its own."""
    rows = []
    for b, shard, mine, low in zip(table.column("bucket").to_pylist(), table.column("shard").to_pylist(), of, own, strict=True):
        k = np.flatnonzero(least[mine] < low)
        if len(k):
            rows.append((b, shard, 5, _pack(k.astype("<u4"), least[mine[k]])))
    return rows


def _tell_contexts(
    table: pa.Table, of: list[np.ndarray], own: list[np.ndarray], sizes: np.ndarray, least: np.ndarray, split: dict[int, list[tuple[int, int, int]]]
) -> list[tuple[int, int, int, bytes]]:
    """To each sender, for runs of windows of its contexts, the smallest document where it is smaller than
    its own: that of the run in ``split``, or that of the whole context."""
    rows = []
    for b, shard, mine, low in zip(table.column("bucket").to_pylist(), table.column("shard").to_pylist(), of, own, strict=True):
        found = []
        for k, (c, doc) in enumerate(zip(mine.tolist(), low.tolist(), strict=True)):
            for w, length, smallest in split.get(c) or ((0, int(sizes[c]), int(least[c])),):
                if smallest < doc:
                    found.append((k, w, length, smallest))
        if found:
            k, w, length, doc = (np.array(x) for x in zip(*found, strict=True))
            rows.append((b, shard, 3, _pack(k.astype("<u4"), w.astype("u1"), length.astype("u1"), doc.astype("<i8"))))
    return rows


def _n_windows(contexts: list[bytes]) -> np.ndarray:
    return np.array([len(c) - DEPTH for c in contexts], dtype=np.int64)  # bytes less the place, less 49


def _resolve(table: pa.Table) -> pa.Table:
    """Bucket -> senders: for runs of windows of their contexts, the smallest document of the corpus, where
    it is smaller than the sender's own smallest; and the same for single windows."""
    rows = _same_contexts(_of_kind(table, 2))
    windows = _of_kind(table, 4)
    _, least, of, own = _distinct(_windows(windows))
    return _messages(rows + _tell_windows(windows, of, own, least))


def _same_contexts(table: pa.Table) -> list[tuple[int, int, int, bytes]]:
    if not table.num_rows:
        return []
    contexts, least, of, own = _distinct(_contexts(table))
    anchors: dict[bytes, int] = {}
    groups = np.array([anchors.setdefault(c[c[-1] : c[-1] + ANCHOR], len(anchors)) for c in contexts], dtype=np.int64)
    several = np.flatnonzero(np.bincount(groups)[groups] > 1)
    sizes = _n_windows(contexts)
    several = several[np.argsort(groups[several], kind="stable")]
    split: dict[int, list[tuple[int, int, int]]] = {}
    for part in _parts(groups[several], sizes[several]):
        _split(contexts, several[part], groups, sizes, least, split)
    return _tell_contexts(table, of, own, sizes, least, split)


# ---------------------------------------------------------------- routers


def _in_order(rank: np.ndarray, items: list[bytes], least: np.ndarray, of: list[np.ndarray]) -> tuple[np.ndarray, list[bytes], np.ndarray, list[np.ndarray]]:
    """Distinct items by ``rank``, and the messages' numbers of them."""
    order = np.argsort(rank, kind="stable")
    turned = np.empty(len(order), dtype=np.int64)
    turned[order] = np.arange(len(order))
    return rank[order], [items[k] for k in order.tolist()], least[order], [turned[mine] for mine in of]


def _routed_contexts(table: pa.Table, first: int, fan: int, n: int):
    """Contexts sent to a router, distinct and in order of key: bounds of its buckets in them, contexts,
    smallest documents, and of each message the numbers of its contexts and its own smallest documents."""
    contexts, least, of, own = _distinct(_contexts(table))
    words = np.frombuffer(b"".join(c[c[-1] : c[-1] + ANCHOR] for c in contexts), dtype="<u8").reshape(-1, 2)
    keys, contexts, least, of = _in_order(_keys(_hashes(words[:, 0], words[:, 1])), contexts, least, of)
    return np.searchsorted(keys, _edges(first, fan, n)), contexts, least, of, own


def _routed_windows(table: pa.Table, first: int, fan: int, n: int, leaves: int):
    """The same of single windows, in order of bucket."""
    windows, least, of, own = _distinct(_windows(table))
    leaf = np.array([zlib.crc32(w) % leaves for w in windows], dtype=np.int64)
    leaf, windows, least, of = _in_order(leaf, windows, least, of)
    return np.searchsorted(leaf // (leaves // n), np.arange(first, first + fan + 1)), windows, least, of, own


def _offer_on(fan: int, n: int):
    """Router -> the ``fan`` parts of its range, of ``n`` in all: the keys it was offered, once each."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        first, sender = key[0].as_py() * fan, key[1].as_py()
        distinct, mark, total, _ = _offered(table.sort_by("shard"))
        edges, rows = np.searchsorted(distinct, _edges(first, fan, n)), []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(int(edges[b]), int(edges[b + 1]))
            rows.append((first + b, sender, 0, _pack(_deltas(distinct[part]), np.packbits(mark[part]), np.minimum(total[part], 2**32 - 1).astype("<u4"))))
        return _messages(rows)

    return run


def _mark_back(fan: int, n: int):
    """Router -> senders: the bits of their keys, from those of all that it offered."""

    def run(key: tuple, offers: pa.Table, answers: pa.Table) -> pa.Table:
        if not offers.num_rows or not answers.num_rows:
            return _messages([])
        first, offers = key[0].as_py() * fan, offers.sort_by("shard")
        distinct, _, _, numbers = _offered(offers)
        wanted, hot = _wanted(len(distinct), np.searchsorted(distinct, _edges(first, fan, n)), answers, first)
        return _mark(offers, numbers, wanted | hot, hot)

    return run


def _send_on(fan: int, n: int, leaves: int):
    """Router -> the parts of its range: distinct contexts and windows, each with its smallest document."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        first, sender = key[0].as_py() * fan, key[1].as_py()
        edges, contexts, low, _, _ = _routed_contexts(_of_kind(table, 2), first, fan, n)
        rows = _context_rows(first, sender, edges, contexts, low)
        edges, windows, low, _, _ = _routed_windows(_of_kind(table, 4), first, fan, n, leaves)
        data = np.frombuffer(b"".join(windows), dtype="u1").reshape(-1, DEPTH + 1)
        return _messages(rows + _window_rows(first, sender, edges, data, low))

    return run


def _filled(runs: list[tuple[int, int, int]], size: int, least: int) -> Iterator[tuple[int, int, int]]:
    """``runs`` with those between them, of which nothing was told: no document is smaller than ``least``."""
    at = 0
    for w, length, doc in sorted(runs):
        if at < w:
            yield at, w - at, least
        yield w, length, doc
        at = w + length
    if at < size:
        yield at, size - at, least


def _told(answers: pa.Table, edges: np.ndarray, first: int = 0) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (first window, windows, smallest document) that a sender was told for its contexts."""
    told: dict[int, list[tuple[int, int, int]]] = {}
    for b, kind, body in zip(answers.column("bucket").to_pylist(), answers.column("kind").to_pylist(), answers.column("body").to_pylist(), strict=True):
        if kind == 3:
            columns = _unpack(body, "<u4", "u1", "u1", "<i8")
            for k, w, length, doc in zip(*(c.tolist() for c in columns), strict=True):
                told.setdefault(int(edges[b - first]) + k, []).append((w, length, doc))
    return told


def _told_windows(answers: pa.Table, edges: np.ndarray, low: np.ndarray, first: int = 0) -> None:
    """Into ``low``: the smaller documents that a sender was told for its single windows."""
    for b, kind, body in zip(answers.column("bucket").to_pylist(), answers.column("kind").to_pylist(), answers.column("body").to_pylist(), strict=True):
        if kind == 5:
            k, least = _unpack(body, "<u4", "<i8")
            low[edges[b - first] + k.astype(np.int64)] = least


def _tell_back(fan: int, n: int, leaves: int):
    """Router -> senders: the answers to what it sent on, for the contexts and windows of each."""

    def run(key: tuple, sent: pa.Table, answers: pa.Table) -> pa.Table:
        if not sent.num_rows:
            return _messages([])
        first = key[0].as_py() * fan
        table = _of_kind(sent, 2)
        edges, contexts, least, of, own = _routed_contexts(table, first, fan, n)
        sizes = _n_windows(contexts)
        split = {c: list(_filled(runs, int(sizes[c]), int(least[c]))) for c, runs in _told(answers, edges, first).items()}
        rows = _tell_contexts(table, of, own, sizes, least, split)
        table = _of_kind(sent, 4)
        edges, _, least, of, own = _routed_windows(table, first, fan, n, leaves)
        _told_windows(answers, edges, least, first)
        return _messages(rows + _tell_windows(table, of, own, least))

    return run


def _levels(buckets: int, most: int) -> tuple[int, int]:
    """``(fan, levels)``: as few levels as give ``buckets`` at a fan of ``most``, and the least fan that does."""
    levels = 1
    while most**levels < buckets:
        levels += 1
    fan = max(1, int(buckets ** (1 / levels)) - 1)
    while fan**levels < buckets:
        fan += 1
    return fan, levels


def _exchange(messages: DataFrame, answer: Callable, on: Callable, back: Callable, fan: int, levels: int, level: int = 1) -> DataFrame:
    """Answers to ``messages``, by buckets where these are the last level and else by routers."""
    if level == levels:
        return messages.groupBy("bucket").applyInArrow(answer, _MESSAGE)
    n = fan ** (level + 1)
    up = lambda column: F.floor(F.col(column) / fan).cast("int")
    routers = lambda: messages.groupBy(F.col("bucket").alias("range"), up("shard").alias("sender"))
    beyond = _exchange(routers().applyInArrow(on(fan, n), _MESSAGE), answer, on, back, fan, levels, level + 1)
    return routers().cogroup(beyond.groupBy(up("bucket").alias("range"), F.col("shard").alias("sender"))).applyInArrow(back(fan, n), _MESSAGE)


def _cut(n_buckets: int, leaves: int | None = None):
    """Every document of a shard with the bytes that smaller documents have taken out."""
    leaves = leaves or n_buckets

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(docs)
        spans: dict[int, list[tuple[int, int]]] = {}
        if answers.num_rows:
            bounds = shard.buckets(n_buckets)
            wanted, hot = _wanted(len(shard.keys), bounds, answers)
            _, at, low, runs, of = shard.contexts(wanted)
            told = _told(answers, np.searchsorted(at, bounds))
            ids, smallest = shard.ids[shard.doc[runs]], low[of]
            whole = ids > smallest  # a smaller document of this shard has the whole context
            columns = (shard.doc[runs].tolist(), shard.first[runs].tolist(), shard.count[runs].tolist(), of.tolist(), ids.tolist(), whole.tolist())
            for d, s, c, k, doc, all_of_it in zip(*columns, strict=True):
                if all_of_it:
                    spans.setdefault(d, []).append((s, s + c + DEPTH - 1))
                elif k in told:
                    for w, length, other in told[k]:
                        if other < doc:
                            spans.setdefault(d, []).append((s + w, s + w + length + DEPTH - 1))
            if hot.any():
                _, leaf, low, docs_of, starts, of = shard.windows(hot, leaves)
                _told_windows(answers, np.searchsorted(leaf // (leaves // n_buckets), np.arange(n_buckets + 1)), low)
                taken = np.flatnonzero(low[of] < shard.ids[docs_of])
                for d, s in zip(docs_of[taken].tolist(), starts[taken].tolist(), strict=True):
                    spans.setdefault(d, []).append((s, s + DEPTH))
        out = []
        for d, (doc, text, copies) in enumerate(shard.docs):
            removed, n, kept, at = 0, 0, hashlib.sha256(), 0
            for s, e in _merged(spans.get(d, [])):
                kept.update(text[at:s])
                removed, n, at = removed + e - s, n + 1, e
            kept.update(text[at:])
            out.append((None if doc == NULL_ID else doc, len(text), removed, n, kept.hexdigest(), copies))
        columns = zip(*out, strict=True) if out else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "copies"])

    return run


def _merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    begin = end = None
    for s, e in sorted(spans):
        if end is not None and s <= end:
            end = max(end, e)
            continue
        if end is not None:
            yield begin, end
        begin, end = s, e
    if end is not None:
        yield begin, end


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch once, with their number."""
    for batch in batches:
        if batch.num_rows:
            found = pa.table(batch).group_by(["doc_id", "text"], use_threads=False).aggregate([([], "count_all")])
            yield from found.rename_columns(["doc_id", "text", "copies"] if found.column_names[0] == "doc_id" else ["copies", "doc_id", "text"]).select(["doc_id", "text", "copies"]).to_batches()


def deal(texts: DataFrame, shards: int) -> DataFrame:
    """``texts`` (doc_id, text) dealt into shards by id and text, so that rows of one id, or
    without one, are spread like others. Equal rows come once for each batch that has them, with the
    number they stand for in ``copies``, so a row that is repeated without end is a few rows."""
    once = texts.mapInArrow(_once, "doc_id long, text binary, copies long")
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    return once.withColumn("shard", shard).repartition(int(shards), "shard")


def remove_repeats(docs: DataFrame, shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_contexts: int = HOT, most: int = FAN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed if a ``DEPTH``-byte string over it also starts in a document with a smaller id.
    A null text is empty; a null id counts as the largest; rows of one id never remove from each
    other, so repeated rows come back alike. Other columns are not read. An empty table gives no rows.
    """
    texts = id_and_text(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "text")
    size, n = texts.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0)), F.count("*")).first()
    shards, buckets = max(1, -(-size // shard_bytes)), max(1, -(-size // bucket_bytes))
    fan, levels = _levels(buckets, most)
    leaves = fan**levels
    dealt = deal(texts, shards)
    grouped = lambda: dealt.groupBy("shard")
    offers = grouped().applyInArrow(_offer(fan), _MESSAGE)
    shared = _exchange(offers, _shared(hot_contexts), _offer_on, _mark_back, fan, levels)
    contexts = grouped().cogroup(shared.groupBy("shard")).applyInArrow(_send(fan, leaves), _MESSAGE)
    on, back = (lambda fan, n, make=make: make(fan, n, leaves) for make in (_send_on, _tell_back))
    resolved = _exchange(contexts, _resolve, on, back, fan, levels)
    answers = shared.unionByName(resolved)
    found = grouped().cogroup(answers.groupBy("shard")).applyInArrow(_cut(fan, leaves), _RESULT)
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return found.withColumn("each", each).drop("copies", "each")
