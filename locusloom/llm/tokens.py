"""Token ids of public vocabularies, computed inside Arrow batches.

Both encoders give the ids that the ``tokenizers`` library gives for the same file with
``add_special_tokens=False``. The merges themselves are left to ``tiktoken``, which applies the same
ranks several times faster; texts it can't be given (special tokens as text, letters newer than this
interpreter's tables) go to ``tokenizers``. Files are named by path, loaded once for each worker and never copied.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from tokenizers import Tokenizer

#: How the byte-level vocabulary parts a text before merging.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for the vocabulary with word ends, after lower case.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
END_OF_WORD = "</w>"
#: Marks that are one part together where they end a chunk of letters (no apostrophe: it may begin a part).
PUNCTUATION = ".,;:!?|#$%&*()-"
#: Words whose ids a worker keeps; when full it starts anew.
MEMO = 700_000
#: Text bytes whose chunks are numbered together.
SLICE_BYTES = 16_000_000


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _vocabulary(path: str) -> tuple[dict[str, int], list[str]]:
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    return found["model"]["vocab"], [t["content"] for t in found["added_tokens"]]


class ByteBpe:
    """Byte-level byte-pair encoding."""

    def __init__(self, path: str):
        vocab, special = _vocabulary(path)
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.fast = tiktoken.Encoding("byte", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(path)

    def encode(self, text: str) -> np.ndarray:
        if self.special.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), dtype=np.uint32)


class WordBpe:
    """Byte-pair encoding with word ends: lower case, white space dropped.

    A word's last letter is merged with its end mark first, so the mark is a byte that UTF-8 never
    has, with the ranks of the file. Ids of a white-space separated chunk are remembered.
    """

    MARK = b"\xff"

    def __init__(self, path: str):
        vocab, special = _vocabulary(path)
        letters = _byte_letters()
        ranks = {}
        for token, i in vocab.items():
            if token in special:
                continue
            ended = token.endswith(END_OF_WORD)
            body = bytes(letters[c] for c in (token[: -len(END_OF_WORD)] if ended else token))
            if self.MARK not in body:
                ranks[body + self.MARK if ended else body] = i
        ranks[self.MARK] = max(vocab.values()) + 1
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.merge = tiktoken.Encoding("word", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.parts = regex.compile(WORD_PATTERN).findall
        self.whole = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if "<" in text and self.special.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if not text.isascii():
            # Newer letters than these tables know; they are never printable.
            if not text.isprintable() and any(unicodedata.category(c) == "Cn" for c in text):
                return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
            text = unicodedata.normalize("NFC", text)
        # Letter by letter: only a sigma's small form depends on its neighbours.
        text = text.lower() if "Σ" not in text else "".join([c.lower() for c in text])
        return b"".join([self._part(part.encode()) for part in self.parts(text)])

    def _part(self, part: bytes) -> bytes:
        """Ids of one part, remembered on its own: chunks of other case or punctuation share them."""
        ids = self.words.get(part)
        if ids is None:
            ids = self.words[part] = self._merged(part)
        return ids

    def _merged(self, part: bytes) -> bytes:
        return array("I", self.merge(part + self.MARK)).tobytes() if part else b""

    def encode(self, text: bytes) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.binary()))[0]

    def encode_all(self, texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``texts`` one after the other, and where each begins, with the end of all last.

        Chunks are numbered first, so only distinct ones are looked up here.
        """
        chunks = pc.ascii_split_whitespace(texts.view(pa.string()))  # an empty chunk has no ids
        numbered = chunks.flatten().dictionary_encode()
        ids, place = self._ids(numbered.dictionary)
        found = ids.take(pa.array(place[numbered.indices.to_numpy()]))
        _, ends, values = found.buffers()
        if not len(found) or values is None:
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        ends = np.frombuffer(ends, dtype="<i8")[: len(found) + 1] // 4
        return np.frombuffer(values, dtype="<u4")[: ends[-1]], ends[chunks.offsets.to_numpy()]

    def _ids(self, chunks: pa.StringArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """Ids of distinct chunks in some order, and the place of each chunk in it.

        Words of the letters below U+0100, with at most punctuation behind them, are parted here all
        together, so that words of other case or punctuation are looked up once; the rest one by one.
        """
        if len(self.memo) + len(self.words) > MEMO:
            self.memo.clear()
            self.words.clear()
        plain = _below_100(chunks)
        lower = pc.utf8_lower(chunks.filter(pa.array(plain)))
        bodies = pc.utf8_rtrim(lower, characters=PUNCTUATION)
        word = pc.utf8_is_alpha(bodies).to_numpy(zero_copy_only=False)
        plain[plain] = word
        lower, bodies = lower.filter(pa.array(word)), bodies.filter(pa.array(word))
        ends, data = _offsets(lower), lower.buffers()[2]
        cuts = np.empty(2 * len(lower) + 1, dtype=np.int32)  # a body, what is behind it, the next body
        cuts[::2], cuts[1::2] = ends, ends[:-1] + pc.binary_length(bodies).to_numpy(zero_copy_only=False)
        parts = pa.StringArray.from_buffers(2 * len(lower), pa.py_buffer(cuts), data or pa.py_buffer(b"")).dictionary_encode()
        known = pa.array(self._looked_up(self.words, self._merged, parts.dictionary), pa.large_binary()).take(parts.indices)
        joined = pa.py_buffer(np.ascontiguousarray(_offsets(known)[::2]))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lower), [None, joined, known.buffers()[2] or pa.py_buffer(b"")])
        others = self._looked_up(self.memo, self._chunk, chunks.filter(pa.array(~plain)))
        place = np.where(plain, np.cumsum(plain), len(words) + np.cumsum(~plain)) - 1
        return pa.concat_arrays([words, pa.array(others, pa.large_binary())]), place

    def _looked_up(self, memo: dict[bytes, bytes], compute: Callable[[bytes], bytes], keys: pa.StringArray) -> list[bytes]:
        keys = keys.view(pa.binary()).to_pylist()
        found = list(map(memo.get, keys))
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = memo[keys[k]] = compute(keys[k])
        return found


def _offsets(strings: pa.Array) -> np.ndarray:
    """Where the strings of an array that is no slice begin, with the end of the last."""
    width = "<i8" if pa.types.is_large_binary(strings.type) else "<i4"
    raw = strings.buffers()[1]
    return np.frombuffer(raw, dtype=width)[: len(strings) + 1] if len(strings) else np.zeros(1, dtype=width)


def _below_100(strings: pa.StringArray) -> np.ndarray:
    """Which strings are of ASCII and U+00C0 to U+00FF alone, without ``<`` that may begin a special token.
    Such letters have one form only, and their small ones are in all tables."""
    ends, data = _offsets(strings), strings.buffers()[2]
    raw = np.frombuffer(data or b"", dtype=np.uint8)[: ends[-1]]
    other = np.concatenate(([0], np.cumsum((raw >= 0xC4) | (raw == 0xC2) | (raw == ord("<")), dtype=np.int32)))
    return other[ends[1:]] == other[ends[:-1]]


def slices(texts: pa.BinaryArray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """``(begin, end)`` of runs of texts with about ``size`` bytes each; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(ends):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield begin, end
        begin = end


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)
