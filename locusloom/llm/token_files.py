"""Token-id files: whole texts as ids in ascending document order, coded in independent blocks.

Texts are tokenised once, where they lie. What a task has for one range of document ids is packed
into one compressed row, so only packed ids are shuffled. Counts of all ids make the one frequency
table; each range is then coded in blocks of whole documents. A file is a Parquet table of blocks:
the code words in one binary column, ids and lengths of its documents beside them.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .common import NULL_ID, id_and_text, store
from .rans import Coder, frequency_table
from .tokens import slices, word_bpe

END = 1
#: Ids in a block, unless one document has more.
BLOCK_IDS = 1 << 20
#: Text bytes, about, whose documents make one range.
RANGE_BYTES = 24_000_000

_PACK = "range int, ids array<long>, lengths array<long>, packed binary"
_BLOCK = "range int, block int, ids array<long>, lengths array<long>, n_ids long, crcs array<long>, payload binary"


def range_bounds(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> np.ndarray:
    """Document ids that part the corpus into ranges of about ``range_bytes`` bytes of text; one row
    for each range reaches the driver. An id that fills several ranges stands there as often, and
    its documents are dealt to them by a hash of their ids (:func:`range_of`)."""
    size = docs.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    n = max(1, int(size // range_bytes))
    if n == 1:
        return np.zeros(0, dtype=np.int64)
    shares = [k / n for k in range(1, n)]
    real = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).cast("double").alias("doc_id"))
    found = np.sort(np.array(real.approxQuantile("doc_id", shares, 0.1 / n)))
    return np.where(found >= float(NULL_ID), NULL_ID, np.minimum(found, 2.0**62).astype(np.int64))


def range_of(bounds: list[int], doc: int, tokens: np.ndarray) -> int:
    """The range of a document: by its id, and within an id that is a bound several times by a hash of its ids."""
    low, high = bisect_left(bounds, doc), bisect_right(bounds, doc)
    return high if high - low < 2 else low + 1 + tie(tokens) * (high - low) // (1 << 32)


def tie(tokens: np.ndarray) -> int:
    """The order of documents that share an id, in [0, 2^32); equal ones follow each other."""
    return zlib.crc32(tokens.tobytes())


def _pack(path: str, end: int, shared):
    """Documents of a task by range, each range one row; null ids come last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_bpe(path)
        squeeze = zstandard.ZstdCompressor(level=3)
        bounds = shared.value.tolist()
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for r, docs in sorted(held.items()):
                ids = np.concatenate([x for _, x in docs]) if docs else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r], pa.int32()),
                        pa.array([[d for d, _ in docs]], pa.list_(pa.int64())),
                        pa.array([[len(x) for _, x in docs]], pa.list_(pa.int64())),
                        pa.array([squeeze.compress(_planes(ids))], pa.binary()),
                    ],
                    names=["range", "ids", "lengths", "packed"],
                )
            held.clear()

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for begin, behind in slices(texts):
                values, places = coder.encode_all(texts.slice(begin, behind - begin))
                values = np.insert(values, places[1:], end)  # behind every document
                places = (places + np.arange(len(places))).tolist()
                for doc, at, to in zip(ids[begin:behind], places, places[1:]):
                    doc = NULL_ID if doc is None else doc
                    tokens = values[at:to]
                    held.setdefault(range_of(bounds, doc, tokens), []).append((doc, tokens))
                size += len(values)
                if size > 8 * BLOCK_IDS:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _planes(ids: np.ndarray) -> bytes:
    """Low bytes, then the higher ones: similar bytes together compress better."""
    return np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _unpack(packed: bytes) -> np.ndarray:
    return _unplanes(zstandard.ZstdDecompressor().decompress(packed))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            found = np.bincount(_unpack(packed))
            if len(found) > len(total):
                total = np.append(total, np.zeros(len(found) - len(total), dtype=np.int64))
            total[: len(found)] += found
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["id", "n"])


def _encode(shared):
    """Packs sorted by range: the documents of a range in order, coded in blocks."""

    def blocks(number: int, packs: list[tuple]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        docs = []
        for ids, lengths, packed in packs:
            values = _unpack(packed)
            docs += zip(ids, np.split(values, np.cumsum(lengths)[:-1]), strict=True)
        docs.sort(key=lambda d: d[0])
        docs = _settle_ties(docs)
        block, begin = 0, 0
        while begin < len(docs):
            end, held = begin + 1, len(docs[begin][1])
            while end < len(docs) and held + len(docs[end][1]) <= BLOCK_IDS:
                held += len(docs[end][1])
                end += 1
            part = docs[begin:end]
            crcs = [zlib.crc32(x.tobytes()) for _, x in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()), pa.array([block], pa.int32()),
                    pa.array([[d for d, _ in part]], pa.list_(pa.int64())), pa.array([[len(x) for _, x in part]], pa.list_(pa.int64())),
                    pa.array([held], pa.int64()), pa.array([crcs], pa.list_(pa.int64())),
                    pa.array([coder.encode(np.concatenate([x for _, x in part]))], pa.binary()),
                ],
                names=["range", "block", "ids", "lengths", "n_ids", "crcs", "payload"],
            )
            block, begin = block + 1, end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, packs = None, []
        for batch in batches:
            for r, ids, lengths, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != number:
                    yield from blocks(number, packs)
                    number, packs = r, []
                packs.append((ids, lengths, packed))
        yield from blocks(number, packs)

    return run


def _settle_ties(docs: list[tuple[int, np.ndarray]]) -> list[tuple[int, np.ndarray]]:
    """Documents of one id are ordered by a hash of their ids, then by the ids, so the files never depend on chance."""
    out, begin = [], 0
    while begin < len(docs):
        end = begin + 1
        while end < len(docs) and docs[end][0] == docs[begin][0]:
            end += 1
        out += docs[begin:end] if end == begin + 1 else sorted(docs[begin:end], key=lambda d: (tie(d[1]), d[1].tobytes()))
        begin = end
    return out


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END, range_bytes: int = RANGE_BYTES) -> None:
    """Write the ids of all rows of ``docs`` below ``path``: ``blocks`` and the ``table`` of frequencies.

    Documents stand in ascending doc_id order, null ids last, repeated ids by a hash of their token ids. A null
    or empty text is ``end`` alone. Other columns are not read. An empty table gives empty files.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    spark = docs.sparkSession
    texts = id_and_text(docs)
    bounds = spark.sparkContext.broadcast(range_bounds(texts, range_bytes))  # a number a range
    packs = store(texts.mapInArrow(_pack(vocabulary, end, bounds), _PACK), "packs")
    counts = packs.select("packed").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = counts.collect()  # at most the size of the vocabulary
    total = np.zeros(max([r["id"] for r in found], default=0) + 1, dtype=np.int64)
    for r in found:
        total[r["id"]] = r["n"]
    frequencies = frequency_table(total)
    table = [(i, int(f)) for i, f in enumerate(frequencies.tolist()) if f]
    spark.createDataFrame(table, "id int, frequency int").coalesce(1).write.parquet(f"{path}/table")
    coder = spark.sparkContext.broadcast(Coder(frequencies))
    # A range to a task, by its number itself: hashed, some tasks would get several of them.
    dealt = packs.repartitionById(len(bounds.value) + 1, F.col("range")).sortWithinPartitions("range")
    dealt.mapInArrow(_encode(coder), _BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in batches:
            for r, b, ids, lengths, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = coder.decode(payload).astype("<u4")
                begins = np.concatenate(([0], np.cumsum(lengths)))
                raw = memoryview(values.tobytes())
                crcs = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r] * n, pa.int32()), pa.array([b] * n, pa.int32()), pa.array(ids, pa.int64()),
                        pa.array(begins[:-1], pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                    ],
                    names=["range", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    return run


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from its decoded ids.

    Blocks are decoded independently; a damaged one is an error. ``start`` counts the ids of all
    documents before: within the block, in earlier blocks of the range, and in earlier ranges.
    """
    ship_package(spark)
    rows = spark.read.schema("id int, frequency int").parquet(f"{path}/table").collect()
    frequencies = np.zeros(max([r["id"] for r in rows], default=0) + 1, dtype=np.int64)
    for r in rows:
        frequencies[r["id"]] = r["frequency"]
    coder = spark.sparkContext.broadcast(Coder(frequencies))
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    sizes = blocks.select("range", "block", "n_ids")
    totals = sizes.groupBy("range").agg(F.sum("n_ids").alias("total"))  # a row a range
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = totals.select("range", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("range_start"))
    within = Window.partitionBy("range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("block_start", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(ranges, "range")
    starts = starts.select("range", "block", (F.col("range_start") + F.col("block_start")).alias("before"))
    schema = "range int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    docs = blocks.select("range", "block", "ids", "lengths", "payload").mapInArrow(_decode(coder), schema)
    real = F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id")
    return docs.join(starts, ["range", "block"]).select(real, (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame) -> DataFrame:
    """The files of ``docs`` written below the shared folder, and what they hold."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path)
    return read_token_files(docs.sparkSession, path)
