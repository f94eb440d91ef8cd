"""Static range asymmetric numeral system over token ids, vectorised over interleaved lanes.

One frequency table serves all blocks. A block codes its tokens in ``lanes`` interleaved states that
share one stream of 32-bit words: token ``i`` belongs to lane ``i % lanes``. Coding runs backwards
and decoding forwards, so a step reads its words in lane order. Every ``CHECKPOINT`` steps the
states and the place in the stream are kept, and decoding can start at any of them.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Bits of the frequency scale; frequencies of a table add up to ``1 << SCALE``.
SCALE = 18
LANES = 512
CHECKPOINT = 1024
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIIIIII")
MAGIC = b"RNS1"


def frequency_table(counts: np.ndarray) -> np.ndarray:
    """Frequencies in proportion to ``counts``, at least 1 where a count is above 0; ids that never
    occurred get none. Rounding is settled on the largest ones, smallest id first among equals."""
    counts = np.asarray(counts, dtype=np.int64)
    seen = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.int64)
    if not len(seen):
        return out
    if len(seen) > 1 << SCALE:
        raise ValueError("more kinds of ids than the scale holds")
    exact = counts[seen] / counts[seen].sum() * (1 << SCALE)
    out[seen] = np.maximum(1, np.floor(exact)).astype(np.int64)
    over = int(out.sum()) - (1 << SCALE)
    order = seen[np.argsort(-out[seen], kind="stable")]
    if over < 0:
        out[order[0]] -= over
    for i in order:  # minima may have taken more than the scale has
        if over <= 0:
            break
        less = min(over, int(out[i]) - 1)
        out[i] -= less
        over -= less
    return out


class Coder:
    """Codes and decodes blocks with one table of frequencies."""

    def __init__(self, frequencies: np.ndarray):
        self.freq = np.asarray(frequencies, dtype=np.uint64)
        ends = np.cumsum(self.freq)
        self.start = ends - self.freq
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        self.table_crc = zlib.crc32(np.asarray(frequencies, dtype="<u4").tobytes())

    def encode(self, ids: np.ndarray, lanes: int = LANES) -> bytes:
        """A block: head, checkpoints (states and stream place each), words; an id must have a frequency."""
        ids = np.asarray(ids, dtype=np.int64)
        n = len(ids)
        lanes = max(1, min(lanes, n))
        steps = -(-n // lanes)
        state = np.full(lanes, _LOW, dtype=np.uint64)
        words: list[np.ndarray] = []
        written = 0
        marks: list[tuple[int, bytes]] = []
        freq, start = self.freq[ids], self.start[ids]
        if n and int(freq.min()) == 0:
            raise ValueError("an id without a frequency")
        shift, word = np.uint64(63 - SCALE), np.uint64(32)
        scale = np.uint64(SCALE)
        for step in range(steps - 1, -1, -1):
            f, c = freq[step * lanes : (step + 1) * lanes], start[step * lanes : (step + 1) * lanes]
            x = state[: len(f)]
            big = x >= (f << shift)
            if big.any():
                low = x[big]
                words.append(low.astype("<u4"))
                written += len(low)
                x = np.where(big, x >> word, x)
            q = x // f
            state[: len(f)] = (q << scale) + (x - q * f) + c
            if step % CHECKPOINT == 0:
                marks.append((written, state.tobytes()))
        stream = np.concatenate(words[::-1]).tobytes() if words else b""
        places = [written - at for at, _ in marks[::-1]]
        body = b"".join(struct.pack("<I", p) + s for p, (_, s) in zip(places, marks[::-1], strict=True)) + stream
        plain = zlib.crc32(ids.astype("<u4").tobytes())
        return _HEAD.pack(MAGIC, n, lanes, len(marks), self.table_crc, plain, zlib.crc32(body)) + body

    def decode(self, block: bytes, first_checkpoint: int = 0) -> np.ndarray:
        """All ids of a block, or those from a checkpoint on; damage is an error, not wrong ids."""
        magic, n, lanes, marks, table, plain, body_crc = _HEAD.unpack_from(block)
        body = memoryview(block)[_HEAD.size :]
        if magic != MAGIC or table != self.table_crc or zlib.crc32(body) != body_crc:
            raise ValueError("damaged block, or one of another table")
        if not n:
            return np.zeros(0, dtype=np.uint32)
        width = 4 + 8 * lanes
        mark = body[first_checkpoint * width : (first_checkpoint + 1) * width]
        at = struct.unpack_from("<I", mark)[0]
        state = np.frombuffer(mark[4:], dtype="<u8").copy()
        stream = np.frombuffer(body[marks * width :], dtype="<u4").astype(np.uint64)
        begin = first_checkpoint * CHECKPOINT * lanes
        out = np.empty(n - begin, dtype=np.uint32)
        mask, scale, word = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
        for k in range(0, n - begin, lanes):
            count = min(lanes, n - begin - k)
            x = state[:count]
            slot = x & mask
            symbol = self.symbol[slot]
            out[k : k + count] = symbol
            x = self.freq[symbol] * (x >> scale) + slot - self.start[symbol]
            small = np.flatnonzero(x < _LOW)
            if len(small):
                x[small] = (x[small] << word) | stream[at : at + len(small)]
                at += len(small)
            state[:count] = x
        if not first_checkpoint and zlib.crc32(out.astype("<u4").tobytes()) != plain:
            raise ValueError("decoded ids don't match their checksum")
        return out
