"""Token alignment, spelling variants and source mixes against their plain statements."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from locusloom.llm import align, mixing, spelling
from locusloom.llm.tokens import byte_bpe


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=str)


def ordered(values):
    return sorted(values, key=str)


# 11 alignment

A_LETTERS = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
A_LETTERS |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(A_LETTERS.values()))}


def brute_alignment(pairs):
    """Ends compared one by one, ids from the two libraries themselves."""
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = []
    for doc, text in pairs:
        a = coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        bytes_a = [bytes(A_LETTERS[c] for c in coder.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a = [sum(map(len, bytes_a[: k + 1])) for k in range(len(a))] if len(a) < 400 else np.cumsum(list(map(len, bytes_a))).tolist()
        ends_b = np.cumsum(list(map(len, bytes_b))).tolist()
        by_b = {}
        for e, y in zip(ends_b, b):
            by_b.setdefault(e, []).append(y)
        links = [(x, y) for e, x in zip(ends_a, a) for y in by_b.get(e, [])]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            u, v = max(k for k in range(i, len(a)) if ends_a[k] <= e and (k + 1 == len(a) or ends_a[k + 1] > e)) + 1, j
            while v < len(b) and ends_b[v] <= e:
                v += 1
            groups.append(f"{','.join(map(str, a[i:u]))}|{','.join(map(str, b[j:v]))}")
            i, j = u, v
        found.append((doc, len(a), len(b), groups, links))
    count = Counter(link for *_, links in found for link in links)
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (doc, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for doc, n_a, n_b, groups, links in found
    ]


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
HARD = [
    (50, "a ▁ b"), (51, "<0x41> </s><s><unk>"), (52, "  spaces   inside \n\n\t end  "), (53, "日本語と😀👩‍👩‍👧 mixed"), (54, "\x00\x01\x7f"),
    (55, "é ﬁ Ⅷ"), (56, "1234567890 12,345.67"), (57, "don't can't I'll"), (58, "﻿start"), (59, "ÀÉÎõü ß"),
]


@pytest.mark.parametrize("most", [align.MOST, 20])
def test_alignment(spark, odd, odd_rows, pairs, most):
    extra = [(d, t, None, None, None, None, None, None, None, None, None) for d, t in HARD]
    docs = odd.unionByName(spark.createDataFrame(extra, odd.schema))
    short = [(d, t) for d, t in [*pairs, *HARD]]
    assert rows(align.align_documents(docs, most=most), *ALIGNED) == ordered(brute_alignment(short))


def test_alignment_of_nothing(none):
    assert align.align_documents(none).collect() == []


def test_groups_keep_all_ids():
    both = align.aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    a, b = both.ids("Unaligned 日本語 words—and 12345 numbers".encode())
    groups = list(both.groups(a, b))
    assert [i for g, _ in groups for i in g] == a.tolist() and [i for _, g in groups for i in g] == b.tolist()
    for x, y in groups:
        assert b"".join(both.bytes_a[i] for i in x) == b"".join(both.bytes_b[i] for i in y)


def test_byte_vocabulary_by_all_letters():
    """Every code point falls into the same class for the fast encoder as for the library."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    slow, fast = Tokenizer.from_file(path), byte_bpe(path).fast
    slow.encode_special_tokens = True
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{x}b1{x}1 {x}{x} .{x}." for x in letters[k : k + 16]) for k in range(0, len(letters), 16)]
    for k in range(0, len(texts), 4000):
        part = texts[k : k + 4000]
        assert [e.ids for e in slow.encode_batch(part, add_special_tokens=False)] == [fast.encode_ordinary(t) for t in part]


def test_parts_of_texts_align_like_whole_texts():
    """Single spaces beside white space, letters that one side rewrites, special tokens as text, bytes that are no text."""
    both = align.aligner(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    rng, memo = random.Random(3), {}
    usual = [" ", " ", "a", "the", "word", "\u00e9", "\u65e5\u672c", "12", "!?", "\u03a9", "<s>"]
    rare = ["  ", "\n", "\t", "\ufb01", "\u00a0", "\u3000", "\u0301", "\u2581", "\u200b", "\x00", "\x1c", "\x85", "\u0130", "<0x0A>", "<|endoftext|>", "'s"]
    texts = ["".join(rng.choice(usual + rare * (k % 2)) for _ in range(rng.randrange(14))).encode() for k in range(4000)]
    texts += [b"", b" ", b"\xff a b", b"a b c " * 2000]
    for begin in range(0, len(texts), 500):
        chunks = [align.parted(t) for t in texts[begin : begin + 500]]
        both.learn(sorted({c for parts in chunks for c in parts} - memo.keys()), memo)
        for text, parts in zip(texts[begin : begin + 500], chunks):
            a, b = both.ids(text)
            to_a, to_b = both.cuts(a, b)
            *found, links = both.align(text, memo, parts)
            assert found == [len(a), len(b), len(to_a), both.digest(a, b, to_a, to_b)], text
            assert links.tolist() == (a[to_a - 1] << 32 | b[to_b - 1]).tolist()


# 12 spelling


def brute_spelling(pairs, ratio=10):
    count = Counter()
    for doc, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}

    def near(u, v):
        if abs(len(u) - len(v)) > 1 or u == v:
            return False
        if len(u) == len(v):
            return sum(x != y for x, y in zip(u, v)) == 1
        long, short = (u, v) if len(u) > len(v) else (v, u)
        return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, others in around.items():
        if others:
            top = min(others, key=lambda v: (-words[v], v))
            if words[top] >= ratio * words[w]:
                form[w] = top

    def root(w):
        while w in form:
            w = form[w]
        return w

    return [(w, form.get(w), root(w), n, len(around[w]), words[form[w]] if w in form else None) for w, n in words.items()]


SPELLED = ["word", "form", "root", "n", "n_near", "form_n"]


def variants(rng, n_words):
    """Few words in many spellings: doubled letters, accents, swaps of one letter, chains of three counts."""
    stems = ["balloon", "aaaaaaa", "aabbaabb", "Übergröße", "committee", "mississippi", "éèreèleréoi", "abcdefgh"]
    out = []
    for _ in range(n_words):
        w = list(rng.choice(stems))
        for _ in range(rng.choice([0] * 12 + [1, 1, 2, 3])):
            k = rng.randrange(len(w))
            kind = rng.randrange(3)
            if kind == 0:
                w[k] = rng.choice("abcé")
            elif kind == 1:
                w.insert(k, rng.choice([w[k], "a", "ß"]))
            else:
                del w[k]
        out.append("".join(w))
    return " ".join(out)


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(3)
    texts = [(k, variants(rng, 220)) for k in range(60)]
    return [*texts, (None, variants(rng, 30)), (None, None), (7, ""), (7, texts[7][1]), (61, "×balloon÷ BALLOON ball1oon balloon_balloon"), (62, "x" * 4000)]


def test_spelling(spark, misspelt):
    docs = spark.createDataFrame([(d, t, "w", "r") for d, t in misspelt], "doc_id long, text string, word string, root string").repartition(7)
    got, want = rows(spelling.spelling_variants(docs), *SPELLED), brute_spelling(misspelt)
    assert got == ordered(want)
    by_word = {r[0]: r for r in want}
    assert any(r[1] and by_word[r[1]][1] for r in want), "a chain of forms is among the cases"
    assert sum(r[1] is not None for r in want) > 50


def test_spelling_of_odd_rows(odd, pairs):
    assert rows(spelling.spelling_variants(odd), *SPELLED) == ordered(brute_spelling(pairs))


def test_spelling_of_nothing(none):
    assert spelling.spelling_variants(none).collect() == []


def test_near_words_of_a_full_stretch(spark):
    """All letters at one place, and the word without it; ties go to the smaller word."""
    letters = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
    words = [(f"pre{c}fix", 5) for c in letters] + [("prefix", 7), ("preefix", 1), ("pre", 3)]
    words = list(dict(words).items())
    got = {r["word"]: r for r in spelling.near_words(spark.createDataFrame(words, "word string, n long").repartition(4)).collect()}
    assert got["prefix"]["n_near"] == len(letters) and (got["prefix"]["form_n"], got["prefix"]["form"]) == (5, "preafix")
    assert got["preafix"]["n_near"] == len(letters) and got["preafix"]["form"] == "prefix"
    assert "pre" not in got


# 13 mixing


@pytest.mark.parametrize("seed", range(30))
def test_nearest_sum(seed):
    rng = random.Random(seed)
    sizes = rng.sample(range(1, 40), rng.randrange(1, 5))
    counts = [rng.randrange(0, 4) for _ in sizes]
    goal = rng.randrange(0, sum(s * c for s, c in zip(sizes, counts)) + 5)
    sums = {sum(s * k for s, k in zip(sizes, ks)) for ks in product(*(range(c + 1) for c in counts))}
    taken = mixing.nearest_sum(sizes, counts, goal)
    assert all(0 <= k <= c for k, c in zip(taken, counts))
    assert sum(s * k for s, k in zip(sizes, taken)) == min(sums, key=lambda x: (abs(x - goal), x))


@pytest.mark.parametrize("seed", range(20))
def test_fit_budget(seed):
    rng = random.Random(seed)
    sizes = np.array(rng.sample(range(0, 3000), rng.choice([1, 2, 30, 500])))
    counts = np.array([rng.randrange(1, 50) for _ in sizes])
    total = int((sizes * counts).sum())
    budget = rng.random() * total
    taken = mixing.fit_budget(sizes, counts, budget)
    assert ((0 <= taken) & (taken <= counts)).all()
    miss = abs(int((taken * sizes).sum()) - budget)
    assert miss <= (1 if len(sizes) >= 30 else sizes.max())


def brute_targets(sizes, weights=(5, 2, 1), repeats=3):
    """sizes: words by source, in order. The excess is given to the others until no target is above its cap."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sizes)}
    capped, total = set(), sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in capped]
        rest = total - sum(repeats * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > repeats * sizes[s]]
        if not above:
            return {s: share.get(s, repeats * sizes[s]) for s in sizes}
        capped |= set(above)


def mixed(rng, n=900):
    out = []
    for k in range(n):
        source = rng.choice([None, "", "a", "Z", "é", "b", "b", "b", "b", "tiny"] if k % 50 else ["tiny"])
        text = " ".join("w" for _ in range(int(rng.expovariate(0.02))))
        out.append((k, text + "\x0b\x1c  x" * (k % 7 == 0), source if source != "tiny" or k < 40 else "b"))
    out += [(None, "null id", "a"), (None, None, None), (3, None, "b"), (5, "", "a")]
    out += [(1000, "same row again", "b")] * 300
    return out


MIXED = ["doc_id", "size", "source_size", "target", "taken"]


@pytest.mark.parametrize("hot", [mixing.HOT, 50, 0])
def test_mix(spark, monkeypatch, hot):
    monkeypatch.setattr(mixing, "HOT", hot)
    monkeypatch.setattr(mixing, "BUCKET", 8)
    data = mixed(random.Random(8))
    docs = spark.createDataFrame([(*r, 1, "n", 2) for r in data], "doc_id long, text string, source string, size int, name string, m int").repartition(5)
    got = mixing.mix_sources(docs).collect()
    size_of = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for s in sorted({r[2] for r in data}, key=lambda s: (s is None, s or "")):
        sizes[s] = sum(size_of(t) for _, t, x in data if x == s)
    target = brute_targets(sizes)
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"]) for r in got) == sorted((str(d), size_of(t), sizes[s]) for d, t, s in data)
    by_size = {sizes[s]: s for s in sizes}
    assert len(by_size) == len(sizes)
    taken = Counter()
    for r in got:
        s = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(target[s])
        assert r["taken"] <= 3 * r["size"] and (r["taken"] == 0 if not r["size"] else r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 1
    again = mixing.mix_sources(docs.repartition(3, "text")).collect()
    key = lambda found: sorted(str(tuple(r)) for r in found)
    assert key(got) == key(again)
    assert key(got) != key(mixing.mix_sources(docs, seed=1).collect())


def test_mix_of_odd_and_no_rows(odd, none, odd_rows):
    got = mixing.mix_sources(odd)
    assert got.columns == MIXED and got.count() == len(odd_rows)
    assert mixing.mix_sources(none).collect() == []


def test_mix_of_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert rows(mixing.mix_sources(docs), *MIXED) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
