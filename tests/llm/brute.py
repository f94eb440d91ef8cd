"""Plain statements of what the operators return, one document or pair at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def overlaps(docs, items):
    windows = {}
    for item, text in items:
        words = PLAIN_WORD.findall(lower(text))
        for i in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[i : i + 13]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words = PLAIN_WORD.findall(lower(text))
        hit, found = [False] * len(words), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                key = tuple(words[i : i + n])
                if key in windows:
                    found |= windows[key]
                    hit[i : i + n] = [True] * n
        n = sum(hit)
        out.append((doc, len(words), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(words)))
    return out


def quality_base(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        words = WORD.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        places = {}
        for i in range(len(words) - 2):
            places.setdefault(tuple(words[i : i + 3]), []).append(i)
        covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        out.append((doc, len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed))
    return out


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_duplicates(docs, radius=4):
    prints = [fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    root = roots(len(docs), pairs)
    first = {}
    for (doc, _), r in zip(docs, root, strict=True):
        first[r] = min(first.get(r, math.inf), math.inf if doc is None else doc)
    return [(doc, f"{p:016x}", None if first[r] == math.inf else first[r]) for (doc, _), p, r in zip(docs, prints, root, strict=True)]


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secrets(text):
    """(start, number, end, kind, value) of the base kinds, in order."""
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access", m[0]) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex", m[0]) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def listed(spans):
    return ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in sorted(spans))


def secret_digest(docs, max_owners=1, max_repositories=8):
    """docs: (doc_id, source, text)."""
    per = []
    for _, _, text in docs:
        base = secrets(text)
        free = [
            (m.start(), 3, m.end(), "owned", m[0])
            for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text or "")
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and not any(m.start() < b[2] and b[0] < m.end() for b in base)
        ]
        per.append((base, free))
    owners, repositories = {}, {}
    for (doc, source, _), (base, free) in zip(docs, per, strict=True):
        for s in base + free:
            owners.setdefault(s[4], set()).add(source)
            repositories.setdefault(s[4], set()).add((source, doc))
    live = lambda s: len(owners[s[4]]) <= max_owners and len(repositories[s[4]]) <= max_repositories
    out = []
    for (doc, _, _), (base, free) in zip(docs, per, strict=True):
        added = [s for s in free if live(s)]
        count = [sum(s[1] == k for s in base) for k in range(3)]
        out.append((doc, *count, sha(listed(base)), listed(base + added), sum(map(live, base)), len(added)))
    return out


def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def pieces(docs, capacity=2048):
    tok, out = tokenizer("byte_bpe_50k.json"), []
    for doc, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        at, piece, step = 0, 0, len(ids) % capacity or capacity
        while at < len(ids):
            out.append((doc, piece, at, step, crc(ids[at : at + step])))
            at, piece, step = at + step, piece + 1, capacity
    return out


def token_rows(docs):
    tok = tokenizer("word_bpe_49k.json")
    coded = [(math.inf if d is None else d, tok.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in docs]
    raw = lambda ids: np.array(ids, dtype="<u4").tobytes()
    coded.sort(key=lambda x: (x[0], zlib.crc32(raw(x[1])), raw(x[1])))
    out, at = [], 0
    for doc, ids in coded:
        out.append((None if doc == math.inf else doc, at, len(ids), crc(ids)))
        at += len(ids)
    return out


def base_scores(docs):
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    tokens = [[*WORD.findall(lower(t)), None] for _, t in docs]
    counts = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    n, kinds = sum(counts.values()), len(counts)
    log = lambda w: math.log10((counts[w] + 1) / (n + kinds + 1))
    return [(d, h, len(ws), sum(counts[w] > 0 for w in ws), n, sum(map(log, ws))) for (d, _), h, ws in zip(docs, held, tokens, strict=True)]


def repeats(docs, depth=50):
    first = {}
    texts = [((math.inf if d is None else d), (t or "").encode()) for d, t in docs]
    for doc, raw in texts:
        for i in range(len(raw) - depth + 1):
            key = raw[i : i + depth]
            first[key] = min(first.get(key, math.inf), doc)
    out = []
    for doc, raw in texts:
        cut = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - depth + 1):
            if first[raw[i : i + depth]] < doc:
                cut[i : i + depth] = True
        spans = int((cut & ~np.concatenate(([False], cut[:-1]))).sum()) if len(raw) else 0
        kept = np.frombuffer(raw, dtype=np.uint8)[~cut].tobytes()
        out.append((None if doc == math.inf else doc, len(raw), int(cut.sum()), spans, sha(kept)))
    return out
