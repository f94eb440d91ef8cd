"""Each operator against its plain statement, on rows with nulls, ties, repeats and long texts."""

import math
import random
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import prose

from locusloom.llm import chat, decontaminate, lattice_lm, packing, quality, rans, secret_scan, simhash, suffix_dedup, token_files, url_filter
from locusloom.llm.tokens import byte_bpe, word_bpe


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=str)


def ordered(values):
    return sorted(values, key=str)


# 1 packing


def fewest(items, capacity):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                go(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_all_fillings_are_tried(monkeypatch):
    """Where the fillings that are tried first don't do, the search goes on with all others."""
    monkeypatch.setattr(packing, "FILLINGS", 1)
    rng = random.Random(12)
    for _ in range(150):
        capacity = rng.randrange(20, 60)
        items = [rng.randrange(3, capacity // 2 + 3) for _ in range(rng.randrange(6, 12))]
        plan = packing.complete_bins(Counter(items), capacity, more_steps=100_000)
        assert sum(n for _, n in plan) == fewest(sorted(items, reverse=True), capacity)
        assert sum((Counter({s: n * c for s, c in Counter(p).items()}) for p, n in plan), Counter()) == Counter(items)


@pytest.mark.parametrize("items, least", [
    ([11, 12, 13, 18, 18, 22, 23, 25, 27, 28, 32, 38, 43, 43, 47, 49, 50], 5),
    ([11, 20, 24, 25, 26, 29, 33, 34, 36, 39, 39, 39, 39, 43, 47, 48, 49], 6),
    ([10, 11, 12, 16, 17, 18, 20, 20, 22, 23, 24, 36, 39, 41, 47, 47, 47, 49], 5),
])
def test_the_search_does_not_end_with_the_first_fillings(monkeypatch, items, least):
    monkeypatch.setattr(packing, "FILLINGS", 1)
    plan = packing.complete_bins(Counter(items), 100, more_steps=3_000)
    assert sum(n for _, n in plan) == least == packing.least_sequences(Counter(items), 100)


def test_all_fillings_against_every_subset():
    counts = {1: 2, 3: 1, 4: 2, 6: 1, 9: 1}
    for room in range(12):
        found = [p for p in packing.all_fillings(sorted(counts), counts, room) if p is not None]
        every = {()}
        for s in (s for s, n in counts.items() for _ in range(n)):
            every |= {tuple(sorted((*p, s), reverse=True)) for p in every if sum(p) + s <= room}
        assert set(found) <= every
        assert all(any(packing._dominates(k, p) for k in found) for p in every)


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(1)
    for case in range(150):
        capacity = rng.choice([10, 20, 50, 100])
        low, high = (1, capacity) if case % 2 else (max(1, capacity // 5), capacity // 2 + 1)
        items = sorted((rng.randint(low, high) for _ in range(rng.randint(0, 11))), reverse=True)
        plan = packing.complete_bins(Counter(items), capacity)
        used = Counter()
        for pattern, times in plan:
            assert sum(pattern) <= capacity
            for size in pattern:
                used[size] += times
        assert used == Counter(items)
        assert sum(n for _, n in plan) == fewest(items, capacity)


def test_bin_completion_nears_the_bound_on_many_pieces():
    rng = np.random.default_rng(0)
    counts = Counter(np.clip(rng.lognormal(6.3, 1.2, 50_000), 1, 2048).astype(int).tolist())
    made = sum(n for _, n in packing.complete_bins(counts, 2048))
    assert made <= 1.001 * packing.least_sequences(counts, 2048)


def test_packing(odd, none, pairs):
    found = packing.pack_documents(odd)
    assert rows(found, "doc_id", "piece", "start", "length", "ids_crc32") == ordered(brute.pieces(pairs))
    sequences = {}
    for r in found.collect():
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(none).count() == 0


# 2 repeated windows


def test_repeats(odd, none, pairs):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = ordered(brute.repeats(pairs))
    assert rows(suffix_dedup.remove_repeats(odd), *columns) == want
    assert rows(suffix_dedup.remove_repeats(odd, shard_bytes=3_000, bucket_bytes=2_000), *columns) == want
    assert rows(suffix_dedup.remove_repeats(odd, shard_bytes=3_000, bucket_bytes=2_000, most=5), *columns) == want
    assert suffix_dedup.remove_repeats(none).count() == 0


def shared_prose(n):
    """Documents that share words, lines and passages, some with one passage in a third of them."""
    rng = random.Random(18)
    lines = [prose(rng, 12) for _ in range(40)]
    return [(k, " ".join([prose(rng, 15), *rng.sample(lines, 3), prose(rng, 10), lines[0] if k % 3 == 0 else ""])) for k in range(n)]


@pytest.mark.parametrize("hot", [0, 3, 10**9])
def test_repeats_over_routers(spark, hot):
    """Two and four levels of receivers give what one does."""
    docs = shared_prose(150)
    df, want = spark.createDataFrame(docs, "doc_id long, text string"), ordered(brute.repeats(docs))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    size = sum(len(t) for _, t in docs)
    for most, buckets in ((6, 30), (2, 16)):
        found = suffix_dedup.remove_repeats(df, shard_bytes=-(-size // 14), bucket_bytes=-(-size // buckets), hot_contexts=hot, most=most)
        assert rows(found, *columns) == want


def test_levels():
    assert suffix_dedup._levels(1, 256) == (1, 1)
    assert suffix_dedup._levels(170, 256) == (170, 1)
    assert suffix_dedup._levels(256, 256) == (256, 1)
    assert suffix_dedup._levels(10_000, 256) == (100, 2)
    for buckets in (257, 65_536, 65_537, 3 * 10**7):
        fan, levels = suffix_dedup._levels(buckets, 256)
        assert (fan - 1) ** levels < buckets <= fan**levels and fan <= 256 < buckets ** (1 / max(1, levels - 1))


def test_messages_grow_with_the_bytes(spark):
    """Five times the documents, with five times the shards and buckets: as many messages for each shard."""

    def count(table):
        return suffix_dedup._messages([(b, s, 1, str(table.num_rows).encode()) for b, s in zip(table.column("bucket").to_pylist(), table.column("shard").to_pylist(), strict=True)][:1])

    sent = {}
    for n in (80, 400):
        docs = shared_prose(n)
        texts = suffix_dedup.id_and_text(spark.createDataFrame(docs, "doc_id long, text string"))
        shards, (fan, levels) = n // 8, suffix_dedup._levels(n // 4, 5)
        offers = suffix_dedup.deal(texts, shards).groupBy("shard").applyInArrow(suffix_dedup._offer(fan), suffix_dedup._MESSAGE)
        at_each, messages = [], offers
        for level in range(levels):
            found = messages.groupBy("bucket").applyInArrow(count, suffix_dedup._MESSAGE).collect()
            at_each.append(sum(int(r["body"]) for r in found))
            routers = messages.groupBy("bucket", suffix_dedup.F.floor(suffix_dedup.F.col("shard") / fan).cast("int").alias("sender"))
            messages = routers.applyInArrow(suffix_dedup._offer_on(fan, fan ** (level + 2)), suffix_dedup._MESSAGE)
        sent[n] = max(at_each) / shards
        assert levels > 1 and max(at_each) <= 2 * fan * shards < n // 4 * shards
    assert sent[400] <= 1.5 * sent[80]


def test_repeats_sorted_in_parts(odd, pairs):
    """Whole anchors at a time, a few windows each."""
    groups, sizes = np.array([0, 0, 1, 2, 2, 2, 3]), np.array([3, 4, 10, 1, 1, 1, 2])
    suffix_dedup_windows, suffix_dedup.WINDOWS = suffix_dedup.WINDOWS, 5
    try:
        assert [(p.start, p.stop) for p in suffix_dedup._parts(groups, sizes)] == [(0, 2), (2, 3), (3, 7)]
    finally:
        suffix_dedup.WINDOWS = suffix_dedup_windows
    assert list(suffix_dedup._parts(groups[:0], sizes[:0])) == []


def test_repeats_of_a_hot_anchor(spark, monkeypatch):
    """A short string between ever different neighbours is not one group of one bucket."""
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    tag = "(c) Example Site 2024, some rights"
    lines = [some(40) + tag + some(40) for _ in range(120)]
    docs = [(k, some(60) + "".join(rng.sample(lines, 3)) + some(60)) for k in range(200)]
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    df, want = spark.createDataFrame(docs, "doc_id long, text string"), ordered(brute.repeats(docs))
    for few in (0, 5, 10**9):
        assert rows(suffix_dedup.remove_repeats(df, shard_bytes=9_000, bucket_bytes=6_000, hot_contexts=few), *columns) == want

    # The exchange by hand, with the windows sorted at once and those of each bucket counted.
    sorted_at_once, most, n = [], 60, 8
    radix = suffix_dedup.radix_groups
    monkeypatch.setattr(suffix_dedup, "radix_groups", lambda data, starts, group: sorted_at_once.append(np.bincount(np.unique(group // 64, return_inverse=True)[1]).max()) or radix(data, starts, group))
    shards = [suffix_dedup.pa.table({"doc_id": [d for d, _ in docs[s::4]], "text": [t.encode() for _, t in docs[s::4]], "copies": [1] * len(docs[s::4])}) for s in range(4)]
    key = lambda s: (suffix_dedup.pa.scalar(s),)
    join = suffix_dedup.pa.concat_tables
    by = lambda table, column, k: table.filter(suffix_dedup.pa.array(table.column(column).to_numpy() == k))
    offers = join([suffix_dedup._offer(n)(key(s), t) for s, t in enumerate(shards)])
    shared = join([suffix_dedup._shared(most)(t) for b in range(n) if (t := by(offers, "bucket", b)).num_rows])
    sent = join([suffix_dedup._send(n)(key(s), t, by(shared, "shard", s)) for s, t in enumerate(shards)])
    for b in range(n):
        suffix_dedup._resolve(by(sent, "bucket", b))
    assert {2, 4} == set(sent.column("kind").to_pylist())
    assert sorted_at_once and max(sorted_at_once) <= 35 * most
    singly = by(sent, "kind", 4)
    sizes = [sum(map(len, by(singly, "bucket", b).column("body").to_pylist())) for b in range(n)]
    assert max(sizes) < 2 * sum(sizes) / n


def test_repeats_with_ids_that_many_rows_share(spark):
    """Rows without an id, or of one id, are spread over the shards; equal rows travel once for a batch."""
    rng = random.Random(9)
    docs = [(None, prose(rng, 30)) for _ in range(60)] + [(7, prose(rng, 30)) for _ in range(60)] + [(k, prose(rng, 30)) for k in range(20)]
    docs += [(8, docs[0][1] + docs[70][1])] * 100 + [(None, None)] * 50 + [(None, docs[0][1])] * 100
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    dealt = suffix_dedup.deal(suffix_dedup.id_and_text(df).fillna({"doc_id": suffix_dedup.NULL_ID}), 16).collect()
    assert sum(r["copies"] for r in dealt) == len(docs) and len(dealt) <= 140 + 4 * 4
    in_shard = Counter(r["shard"] for r in dealt)
    assert max(in_shard.values()) < len(dealt) / 4
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(suffix_dedup.remove_repeats(df, shard_bytes=9_000, bucket_bytes=6_000), *columns) == ordered(brute.repeats(docs))


def test_radix_groups():
    rng = random.Random(2)
    data = bytes(rng.choice(b"ab") for _ in range(400)) + b"x" * 120
    starts = np.arange(len(data) - 49)
    alive, group = suffix_dedup.radix_groups(np.frombuffer(data, dtype="u1"), starts, np.zeros(len(starts), dtype=np.int64))
    found = {}
    for at, g in zip(alive.tolist(), group.tolist(), strict=True):
        found.setdefault(g, set()).add(at)
    want = {}
    for s in starts.tolist():
        want.setdefault(data[s : s + 50], set()).add(s)
    assert ordered(map(sorted, found.values())) == ordered(sorted(v) for v in want.values() if len(v) > 1)


def test_runs_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SEGMENT", 300)
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 49, 50, 51, 299, 300, 301, 1000)]
    doc, first, count, place, _ = suffix_dedup.window_runs(texts)
    seen = [(d, s + k) for d, s, c in zip(doc.tolist(), first.tolist(), count.tolist(), strict=True) for k in range(c)]
    assert sorted(seen) == [(d, s) for d, t in enumerate(texts) for s in range(len(t) - 49)]
    assert ((place - count + 1 >= 0) & (place <= 34)).all()


# 3 near duplicates


def test_near_duplicates(odd, none, pairs):
    assert rows(simhash.near_duplicates(odd), "doc_id", "fingerprint", "component_id") == ordered(brute.near_duplicates(pairs))
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 200])
def test_bit_sliced_stars(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, max(1, n // 5), dtype=np.uint64)
    noise = [sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 5))) for _ in range(n)]
    prints = np.unique(np.array([int(rng.choice(base)) ^ x for x in noise], dtype=np.uint64))
    m = len(prints)
    want = brute.roots(m, [(i, j) for i in range(m) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 4])
    assert brute.roots(m, simhash.stars(prints)) == want
    if m <= 64:
        assert brute.roots(m, simhash._small_stars(prints, np.array([0]), np.array([m]), 4)) == want


def test_hot_key_in_chunks(spark):
    rng = np.random.default_rng(7)
    prints = sorted({1 << 40 | int(x) for x in rng.integers(0, 1 << 12, 300)})
    frame = spark.createDataFrame([(p,) for p in prints], "bits long")
    edges = [(prints.index(r["a"]), prints.index(r["b"])) for r in simhash.links(frame, chunk=20).collect()]
    n = len(prints)
    assert brute.roots(n, edges) == brute.roots(n, [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute.roots(201, pairs)
    assert all(found.get(n, n) == want[n] for n in range(201))


def test_keep_first_of_rows_that_share_an_id(spark):
    """A row stays if it is the first of its own component, whatever other rows have its id; the smallest text decides ties."""
    rng = random.Random(14)
    copies, others = [prose(rng, 80) for _ in range(6)], [prose(rng, 80) for _ in range(6)]
    c, d, e, f = (prose(rng, 80) for _ in range(4))
    docs = [(k, t) for k, t in enumerate(copies)] + [(10 + k, t) for both in (copies, others) for k, t in enumerate(both)]
    docs += [(20, c), (20, d), (30, c), (31, d), (None, e), (None, e), (None, copies[0]), (40, f), (40, f)]
    want = [*enumerate(copies), *((10 + k, t) for k, t in enumerate(others)), (20, c), (20, d), (None, e), (40, f)]
    for order in (docs, docs[::-1]):
        kept = simhash.keep_first(spark.createDataFrame(order, "doc_id int, text string").coalesce(1))
        assert rows(kept, "doc_id", "text") == ordered(want)


def test_keep_first(odd, none, pairs):
    """One row for each component, found by comparing all fingerprints: its smallest id, and of those the smallest text."""
    prints = [int(g[1], 16) for g in brute.near_duplicates(pairs)]
    of = list(range(len(prints)))
    for _ in prints:
        of = [min(of[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 4) for p in prints]
    best = {}
    for k, (d, t) in enumerate(pairs):
        row = ((d is None, d or 0), t is not None, t or "")
        best[of[k]] = min(best.get(of[k], row), row)
    kept = rows(simhash.keep_first(odd), "doc_id", "text")
    assert kept == ordered((None if i[0] else i[1], t if real else None) for i, real, t in best.values())
    assert simhash.keep_first(none).count() == 0 and simhash.keep_first(odd).columns == odd.columns


# 4 perspectives


def test_perspectives(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 300, "cy", "é" * 3), (1, 2, "bob", "tie"), (1, 2, "bob", "tie"), (1, None, None, "who"), (2, 0, "system", "alone"), (None, 0, "ann", "lost")]
    frame = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, size string")
    found = {}
    for r in chat.rotate_perspectives(frame).collect():
        found.setdefault((r["conv_id"], r["speaker"]), []).append(r)
    assert set(found) == {(1, "ann"), (1, "bob"), (1, "cy"), (None, "ann")}
    for (conv, speaker), said in found.items():
        mine = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is None, t[1] or 0, t[2] is None, t[2] or "", t[3] or ""))
        whole, masks = "", []
        for _, _, role, text in mine:
            head = "<|assistant|>\n" if role == speaker else "<|system|>\n" if role == "system" else f"<|user:{role or 'unknown'}|>\n"
            if role == speaker:
                masks.append((len(whole) + len(head), len(whole) + len(head) + len(text or "") + 8))
            whole += head + (text or "") + "<|end|>\n"
        said.sort(key=lambda r: r["start"])
        assert "".join(r["text"] for r in said) == whole
        assert all(whole[r["start"] : r["end"]] == r["text"] for r in said)
        assert [(r["mask_start"], r["mask_end"]) for r in said if r["mask_start"] is not None] == masks
    assert chat.rotate_perspectives(frame.limit(0)).count() == 0


def test_perspectives_of_a_hot_conversation(spark, monkeypatch):
    """Many turns without a number, many with one number, many copies of one turn, and a very long text:
    runs stay short, and the rendered dialogues are gapless and in order."""
    monkeypatch.setattr(chat, "RUN", 4)
    turns = [(1, None, "ann", f"lost {k}") for k in range(60)] + [(1, 5, "bob", f"tie {k % 25}") for k in range(60)] + [(1, 2, "ann", "again")] * 90
    turns += [(1, 0, "system", "be kind"), (1, 3, "cy", "x" * 200_000), (2, 1, "dee", "alone"), (2, 1, None, None)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    placed = chat._in_order(frame.selectExpr("conv_id", "turn", "role", "coalesce(text, '') said").groupBy("conv_id", "turn", "role", "said").count().withColumnRenamed("count", "n"))
    held = [(r["run"], r["n"]) for r in placed.collect()]
    assert max(Counter(run for run, _ in held).values()) <= 4 and max(n for _, n in held) == 4 and sum(n for _, n in held) == len(turns)
    found = {}
    for r in chat.rotate_perspectives(frame).collect():
        found.setdefault((r["conv_id"], r["speaker"]), []).append(r)
    assert set(found) == {(1, "ann"), (1, "bob"), (1, "cy"), (2, "dee")}
    for (conv, speaker), said in found.items():
        mine = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is None, t[1] or 0, t[2] is None, t[2] or "", t[3] or ""))
        heads = ["<|assistant|>\n" if t[2] == speaker else "<|system|>\n" if t[2] == "system" else f"<|user:{t[2] or 'unknown'}|>\n" for t in mine]
        want, at = [], 0
        for (_, turn, role, text), h in zip(mine, heads, strict=True):
            end = at + len(h) + len(text or "") + 8
            own = role == speaker
            want.append((turn, role, f"{h}{text or ''}<|end|>\n", at, end, at + len(h) if own else None, end if own else None))
            at = end
        said.sort(key=lambda r: r["start"])
        assert [(r["turn"], r["role"], r["text"], r["start"], r["end"], r["mask_start"], r["mask_end"]) for r in said] == want


# 5 token files


def test_token_files(odd, none, pairs):
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert rows(token_files.round_trip(odd), *columns) == ordered(brute.token_rows(pairs))
    assert token_files.round_trip(none).count() == 0


def test_token_files_in_several_ranges_and_blocks(spark, odd, pairs, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    path = token_files.scratch_path(spark, "test")
    token_files.write_token_files(odd, path, range_bytes=5_000)
    assert spark.read.parquet(f"{path}/blocks").select("range").distinct().count() > 3
    assert rows(token_files.read_token_files(spark, path), "doc_id", "start", "n_tokens", "ids_crc32") == ordered(brute.token_rows(pairs))


def test_token_files_of_hot_ids(spark, monkeypatch):
    """A third of the rows without an id and a third with one id: both are spread over several ranges."""
    monkeypatch.setattr(token_files, "BLOCK_IDS", 300)
    rng = random.Random(6)
    docs = [((None, 7, k)[k % 3], prose(rng, rng.randrange(0, 30))) for k in range(900)] + [(7, "same")] * 50
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    path = token_files.scratch_path(spark, "test")
    token_files.write_token_files(frame, path, range_bytes=4_000)
    parts = spark.read.parquet(f"{path}/blocks").selectExpr("range", "explode(ids) AS id").distinct().groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in parts if r["count"] > 3}.keys() == {7, token_files.NULL_ID}
    assert rows(token_files.read_token_files(spark, path), "doc_id", "start", "n_tokens", "ids_crc32") == ordered(brute.token_rows(docs))


def test_word_vocabulary_by_all_letters():
    """Every code point, assigned or not, alone and between letters, digits and marks."""
    whole, coder = brute.tokenizer("word_bpe_49k.json"), word_bpe(brute.public_tokenizers.path("word_bpe_49k.json"))
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{x}B1{x}1 {x} .{x}. E{x}" for x in letters[k : k + 16]) for k in range(0, len(letters), 16)]
    for k in range(0, len(texts), 4000):
        part = texts[k : k + 4000]
        for text, want in zip(part, whole.encode_batch(part, add_special_tokens=False), strict=True):
            if coder.encode(text.encode()).tolist() != want.ids:  # name the letter
                bad = [x for x in text if coder.encode(f"a{x}B1{x}1 {x}".encode()).tolist() != whole.encode(f"a{x}B1{x}1 {x}", add_special_tokens=False).ids]
                raise AssertionError([hex(ord(x)) for x in bad] or text)


@pytest.mark.parametrize("n", [0, 1, 5, 511, 512, 513, 600_000])
def test_range_coder(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 49_000).astype(np.uint32)
    coder = rans.Coder(rans.frequency_table(np.bincount(ids, minlength=49_408) if n else np.array([3])))
    block = coder.encode(ids)
    assert (coder.decode(block) == ids).all()
    if n > rans.LANES * rans.CHECKPOINT:
        assert (coder.decode(block, 1) == ids[rans.LANES * rans.CHECKPOINT :]).all()
    if n > 5:
        with pytest.raises(ValueError):
            coder.decode(block[:-3] + bytes([block[-3] ^ 1]) + block[-2:])


def test_frequencies_add_up():
    for counts in ([1], [5, 0, 1], [1] * 1000, [10**12] + [1] * 5000):
        table = rans.frequency_table(np.array(counts))
        assert table.sum() == 1 << rans.SCALE and ((table > 0) == (np.array(counts) > 0)).all()


@pytest.mark.parametrize(("make", "name"), [(byte_bpe, "byte_bpe_50k.json"), (word_bpe, "word_bpe_49k.json")])
def test_ids_equal_the_tokenizer(make, name, pairs):
    whole, coder = brute.tokenizer(name), make(brute.public_tokenizers.path(name))
    odd = ["", "  a  b\n\n c", "it's I'LL don't ΣΑΣ İstanbul straße", "a<|endoftext|>b <|endoftext|> c", "ẖ H̱ e\u0301 x", "日本語 1234 ½", "\x1c a\x85b", "🙂🙂!!", "WORD!! Word. (word) d'été's x*** -- '' ''s !a", "ΑΣ. ΑΣ Σ, ǅ ﬁ Ⅷ"]
    for text in [*odd, *(t for _, t in pairs if t)]:
        ids = coder.encode(text if make is byte_bpe else text.encode())
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


# 6 language model


def test_base_scores(odd, none, pairs):
    found = lattice_lm.score_documents(odd).collect()
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found), key=str)
    assert got == ordered((*w[:5], round(w[5], 6)) for w in brute.base_scores(pairs))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert lattice_lm.score_documents(none).count() == 0


def test_frequent_words_stay_within_the_bound(spark):
    words = spark.createDataFrame([(f"w{k}", 1000 // (k + 1)) for k in range(300)], "word string, n long")
    for most in (0, 1, 7, 100, 300, 1000):
        got = lattice_lm.frequent_words(words, most).collect()
        assert len(got) <= most
        assert not got or min(r["n"] for r in got) > max([w["n"] for w in words.collect() if w not in got], default=-1)
    assert lattice_lm.frequent_words(words, 300).count() == 300


def test_scores_do_not_depend_on_the_bound(odd, monkeypatch):
    score = lambda: sorted((r["doc_id"] or 0, r["n_known"], round(r["base_score"], 8), round(r["score"], 8)) for r in lattice_lm.score_documents(odd).collect())
    whole = score()
    monkeypatch.setattr(lattice_lm.frequent_words, "__defaults__", (3,))
    assert score() == whole


def test_lattice_adds_all_segmentations():
    lattice = lattice_lm.Lattice.of({"▁": -1.0, "▁a": -2.0, "a": -1.5, "ab": -2.5, "b": -3.0, "▁ab": -4.0}, [-6.0] * 256, -1.0)

    def total(text):
        if not text:
            return 1.0
        known = [k for k in range(1, len(text) + 1) if lattice.arcs.get(text[:k]) is not None]
        ways = sum(math.exp(lattice.arcs[text[:k]]) * total(text[k:]) for k in known)
        return ways + (0 if 1 in known else math.exp(-6.0 * len(text[0].encode())) * total(text[1:]))

    for word in ("", "a", "ab", "abab", "bé", "ba"):
        assert math.isclose(lattice.marginal(word.encode()), math.log(total("▁" + word)), rel_tol=1e-12)
    counts, spelled = {}, np.zeros(256)
    lattice.expect("abé".encode(), 2.0, counts, spelled)
    assert math.isclose(sum(len(p) * n for p, n in counts.items()), 2 * 3) and math.isclose(spelled.sum(), 4)


def test_lattice_training_helps_held_out_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    score = lambda rounds: lattice_lm.score_documents(docs, rounds=rounds).filter("held_out").agg({"score": "sum"}).first()[0]
    assert score(1) > score(0)


# 7 URLs


def test_hosts_paths_and_rules(spark):
    cases = {
        None: ("", "", None), "no scheme/x": ("", "", None), "": ("", "", None), "http://A.Example.ORG/es/1?q#f": ("a.example.org", "/es/1", "example.org/es/"),
        "x://example.org/en/12": ("example.org", "/en/12", "example.org/en/1"), "http://notexample.org/en/1": ("notexample.org", "/en/1", "org/"),
        "http://org": ("org", "", None), "http://b.com/fr/x://y": ("b.com", "/fr/x://y", "com/fr/"), "http://b.com/FR/": ("b.com", "/FR/", None),
        "ftp://É.com/de/#a?b": ("É.com", "/de/", "com/de/"), "http://?x": ("", "", None), "http://h.net#/de/": ("h.net", "", None),
    }
    frame = spark.createDataFrame([(None if k == 3 else k, u, "x") for k, u in enumerate(cases)] + [(0, None, "x")], "page_id long, url string, host string")
    model = url_filter.fit_urls([])
    found = url_filter.filter_urls(frame, model).collect()
    assert ordered((r["host"], r["path"], r["rule"]) for r in found) == ordered([*cases.values(), cases[None]])
    verdict = {r["rule"]: r["verdict"] for r in found}
    assert verdict["example.org/es/"] == verdict["com/de/"] == verdict["example.org/en/1"] == "block" and verdict["org/"] == verdict["com/fr/"] == "allow"
    assert url_filter.filter_urls(frame.limit(0), model).count() == 0


def test_url_model_on_held_out_words(spark):
    labelled = spark.createDataFrame([*url_filter.labelled_urls(), ("http://x/", None)], "url string, blocked int")
    model = url_filter.fit_url_table(labelled)
    blocked = ["http://casino-royal.example.com/en/9", "https://www.cheap-pills.example.net/4", "http://m.spammy-links.example.com/x", "http://freeporn.example.net/"]
    allowed = ["http://dailynews.example.com/en/9", "https://www.cityarchive.example.net/4", "http://m.oldmaps.example.com/x", "http://therha.example.com/en/676"]
    split = lambda url: (url.split("/")[2], "/" + url.split("/", 3)[3])
    assert [model.score(*split(u)) > 0 for u in blocked + allowed] == [True] * 4 + [False] * 4
    with pytest.raises(ValueError):
        url_filter.fit_url_table(labelled, most=3)


# 8 secrets


def test_secrets(odd, none, odd_rows):
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_owned")
    want = brute.secret_digest([(r[0], r[3], r[1]) for r in odd_rows])
    assert rows(secret_scan.secret_digest(odd), *columns) == ordered(want)
    assert any(w[7] for w in want) and any(w[6] for w in want)
    assert secret_scan.secret_digest(none).count() == 0


def test_widely_copied_secrets_are_not_live(spark):
    text = "see QmFzZTY0VG9rZW5Gb3JUZXN0cw99 there"
    frame = spark.createDataFrame([(k, text, f"s{k % 3}") for k in range(30)] + [(99, "only bXlPd25TZWNyZXRUb2tlbg12 here", "s1")], "doc_id long, text string, source string")
    found = {r["doc_id"]: r["spans"] for r in secret_scan.secret_digest(frame).collect()}
    assert found.pop(99) == "owned:5:29" and set(found.values()) == {""}


def test_many_spans_in_one_text(spark):
    text = "é " + " ".join(f"AKIA{k:016d}" for k in range(700))
    found = secret_scan.secret_digest(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).first()
    assert found["n_access"] == 700 and found["base_sha256"] == brute.sha(brute.listed(brute.secrets(text)))


def test_redaction(odd, odd_rows, none):
    found = ordered((r["doc_id"], r["text"], r["n_chars"]) for r in secret_scan.redact_secrets(odd).collect())
    want = []
    live = {(d[0], r[1]): d[5] for d, r in zip(brute.secret_digest([(r[0], r[3], r[1]) for r in odd_rows]), odd_rows, strict=True)}
    for r in odd_rows:
        spans = sorted(tuple(map(int, s.split(":")[1:])) for s in live[(r[0], r[1])].split(",") if s)
        text, at, out = r[1], 0, ""
        for s, e in spans:
            if s >= at:
                out += text[at:s] + "[secret]"
            at = max(at, e)
        whole = out + text[at:] if spans else text
        want.append((r[0], whole, len(whole) if spans else r[4]))
    assert found == ordered(want)
    assert secret_scan.redact_secrets(none).count() == 0


def test_secret_scan_has_no_python(odd, capsys):
    secret_scan.secret_digest(odd).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# 9 quality


def test_quality_counts(odd, none, pairs):
    model = quality.QualityModel(None, frozenset())
    columns = ("doc_id", *quality.BASE, "base_failed")
    found = quality.quality_rules(odd, model)
    assert rows(found, *columns) == ordered(brute.quality_base(pairs))
    assert found.filter("base_failed = kept").count() == 0
    assert quality.quality_rules(none, model).count() == 0
    assert Counter(r["doc_id"] for r in quality.keep_good(odd, model).collect()) == Counter(r["doc_id"] for r in found.filter("kept").collect())


def test_repeated_words_with_many_kinds():
    rng = random.Random(6)
    ids = np.array([rng.randrange(5) for _ in range(200)])
    want = brute.quality_base([(1, " ".join(map(str, ids.tolist())))])[0][5]
    assert quality._repeated(ids, 5) == quality._repeated(ids, 2**21) == want


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    y = ((x[:, 0] > 0) & (x[:, 1] < 0.5)).astype(float)
    trees = quality.fit_trees(x, y, np.array([1, -1, 0]))
    assert ((trees.score(x) > 0) == y).mean() > 0.97
    base = rng.normal(size=(50, 3))
    for f, sign in ((0, 1), (1, -1)):
        moved = np.stack([trees.score(np.where(np.arange(3) == f, v, base)) for v in np.linspace(-3, 3, 40)])
        assert (sign * np.diff(moved, axis=0) >= -1e-12).all()
    node = lambda row: walk(trees, row)
    assert np.allclose(trees.score(base), [node(r) for r in base])


def test_rows_that_share_a_sampled_id_weigh_once(spark):
    rng = random.Random(15)
    docs = [(k, prose(rng, 40) + (" awful" if k % 3 == 0 else "")) for k in range(60)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(60)], "doc_id long, quality int, toxic int")
    fit = lambda d: quality.fit_quality(spark.createDataFrame(d, "doc_id long, text string"), labels)
    once, often = fit(docs), fit(docs + [docs[1]] * 50 + [(3, "x" + prose(rng, 40)) for _ in range(50)])
    assert "awful".encode() in once.listed and often.listed == once.listed
    x = np.random.default_rng(0).uniform(0, 50, size=(200, len(quality.FEATURES)))
    assert often.trees.start == once.trees.start and np.array_equal(once.trees.score(x), often.trees.score(x))


def walk(trees, row):
    total = trees.start
    for at in trees.roots:
        while not trees.leaf[at]:
            at = trees.left[at] + (row[trees.feature[at]] > trees.threshold[at])
        total += trees.value[at]
    return total


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fit, held = labels.filter("doc_id % 3 <> 0"), labels.filter("doc_id % 3 = 0")
    judged = quality.quality_rules(docs, quality.fit_quality(docs, fit)).join(held, "doc_id").filter("not base_failed")
    share = {(r["quality"], r["toxic"]): r["kept"] for r in judged.groupBy("quality", "toxic").agg({"kept": "max", "doc_id": "count"}).withColumnRenamed("max(kept)", "kept").collect()}
    clean = judged.filter("quality = 1 and toxic = 0")
    assert clean.filter("kept").count() > 0.97 * clean.count()
    toxic = judged.filter("toxic = 1")
    assert toxic.filter("kept").count() < 0.1 * toxic.count() and share


def test_fit_without_labels(spark, none, odd):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for docs in (none, odd):
        assert quality.fit_quality(docs, labels).trees is None


# 10 decontamination

ITEMS = [(0, None), (1, ""), (2, "One two THREE"), (3, " ".join(f"k{i}" for i in range(20))), (4, "k3 k4"), (5, "k3 k4"), (None, "one"), (10, "W7 w8 w9")]


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_overlaps(spark, odd, none, odd_rows, block_words, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    rng = random.Random(8)
    more = [(100, "intro one TWO-three outro"), (101, " ".join(f"K{i}" for i in range(5, 19))), (102, " ".join(rng.choice(["k3", "k4", "one", "two", "three"]) for _ in range(3000)))]
    frame = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute.overlaps([*((r[0], r[1]) for r in odd_rows), *more], [i for i in ITEMS if i[0] is not None])
    found = decontaminate.find_overlaps(frame, items, block_words=block_words).select("doc_id", "overlap.*")
    spans = ordered((r["doc_id"], r["n_words"], sum(e - s for s, e in zip(r["hit_start"], r["hit_end"], strict=True)), r["items"]) for r in found.collect())
    digest = decontaminate.overlap_digest(frame, items)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(digest, *columns) == ordered(want)
    assert [s[:3] for s in spans] == [tuple(w[:3]) for w in ordered(w[:3] for w in want)]
    assert decontaminate.overlap_digest(none, items).count() == 0
    assert decontaminate.overlap_digest(frame, items.limit(0)).filter("contaminated").count() == 0


def brute_longest(texts, items):
    """(longest, first place) of each text, by trying every pair of places."""
    found = []
    for text in texts:
        words, best = decontaminate.words_of(text.encode()), (0, None)
        for i in range(len(words)):
            for item in items:
                for j in range(len(item)):
                    n = 0
                    while i + n < len(words) and j + n < len(item) and words[i + n] == item[j + n]:
                        n += 1
                    if n > best[0]:
                        best = (n, i)
        found.append(best)
    return found


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_longest_matches(spark, block_words):
    """One passage in many documents, passages beyond the window, ties, repeated words, all against every pair."""
    rng = random.Random(31)
    passage = [f"p{i}" for i in range(20)]
    items = [[f"k{i}" for i in range(30)], ["a", *passage, "b"], ["c", *passage[:17], "p99", "d"], ["r"] * 25, [f"k{i}" for i in range(5, 25)] * 2, ["short"]]
    texts = [" ".join(["x", *passage, "y"])] * 5 + [" ".join([f"z{k}", *passage[k % 4 : 18 + k % 3], "q"]) for k in range(12)]
    texts += ["x " + " ".join(f"k{i}" for i in range(4, 29)) + " y", "k5 k6 z", "r " * 40, "r " * 13 + "x", "r " * 12, "", "nothing here", "short", "k24 k5 k6 k24 k5 k6 k7"]
    for _ in range(60):
        item = rng.choice(items)
        s = rng.randrange(len(item))
        cut = [w for _ in range(3) for w in [*rng.choice(items)[s % 3 : s % 3 + rng.randrange(1, 20)], rng.choice(["x", "k7", "r", "p3"])]]
        texts.append(" ".join([*item[s : s + rng.randrange(1, 26)], *cut]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    found = decontaminate.find_overlaps(docs, bench, block_words=block_words).select("doc_id", "overlap.longest", "overlap.longest_at").collect()
    words = [[w.encode() for w in i] for i in items]
    assert {r[0]: (r[1], r[2]) for r in found} == dict(enumerate(brute_longest(texts, words)))


def test_ordered_suffixes():
    rng = random.Random(2)
    for _ in range(60):
        text = np.array([rng.randrange(0, 4) for _ in range(rng.randrange(1, 60))] + [0])
        at = np.flatnonzero(text)
        suffix = lambda k: tuple(text[k : k + int(np.flatnonzero(text[k:] == 0)[0])].tolist())
        assert [suffix(k) for k in decontaminate.ordered_suffixes(text, at)] == sorted(suffix(k) for k in at)


def test_decontaminate_keeps_clean_rows(odd, spark):
    items = spark.createDataFrame([(1, "shared passage of over fifty bytes that several documents carry word for word")], "item_id long, text string")
    kept = decontaminate.decontaminate(odd, items)
    assert kept.columns == odd.columns
    assert odd.count() - kept.count() == 2


def test_decontaminate_shard_memory_is_bounded():
    """A full shard is searched in little memory beside its text (before: about 13 times its bytes)."""
    import tracemalloc

    rng = random.Random(7)
    vocab = [f"w{i}".encode() for i in range(5000)]
    passage = [rng.choice(vocab) for _ in range(40)]
    block = decontaminate.TestBlock([("1", passage)])
    docs, held = [], 0
    while held < decontaminate.SHARD_BYTES:
        words = [rng.choice(vocab) for _ in range(rng.randrange(50, 400))] + passage
        docs.append(words)
        held += sum(len(w) + 1 for w in words)
    tracemalloc.start()
    found = decontaminate._search(docs, block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(f[1] == 40 and f[4][-1] - f[3][-1] == 40 for f in found)
    assert peak < 64_000_000
