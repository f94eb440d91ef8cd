"""Sources mixed to target weights, by fitting each source's budget as a subset sum.

Documents are counted by exact length within their source. A source's target is first met with
whole copies of the source; what remains is a budget for a subset of it. Most of it is spread evenly over the
lengths; the last part, about two of the longest documents, is left to bounded-knapsack
dynamic programming over the lengths that are left, which finds the nearest sum there is. Each
length's number of documents is then taken in the order of a seeded hash.

Only counts meet in one task: a source's lengths are at most as many as its longest document has words. Documents
themselves are chosen by a bucket of their hash; a length's buckets grow with its documents, and only
the one bucket in which its number runs out is ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordering import expand_counts, place_in_order, running_total
from ..session import require_columns, ship_package
from .common import store

WEIGHTS = (5, 2, 1)
#: How often a document may be taken.
REPEATS = 3
#: Documents, about, of one source and length in a bucket of hashes.
BUCKET = 4096
#: Lengths of a source that may be broadcast: those with at least one in ``HOT`` of all documents.
HOT = 10_000
#: The longest documents' lengths that are left to the dynamic program.
RESERVE = 2

_SOURCE = ["absent", "name"]
_LENGTH = [*_SOURCE, "size"]


def nearest_sum(sizes: Sequence[int], counts: Sequence[int], goal: int) -> list[int]:
    """How many of each size (positive, each available ``counts`` times) come nearest to ``goal``, the lower sum
    of two as near: bounded-knapsack dynamic programming over the sums up to ``goal`` and one largest size.

    ``last`` keeps for a sum the piece with which it was first reached, so the way back needs no table of all
    pieces; the search ends when the goal, or the multiple of the sizes' common divisor nearest to it, is reached.
    """
    taken = [0] * len(sizes)
    if goal <= 0 or not len(sizes):
        return taken
    unit = math.gcd(*sizes)
    aim = min((abs(s * unit - goal), s * unit) for s in (goal // unit, goal // unit + 1))[1] // unit
    top = aim + max(sizes) // unit
    last = np.full(top + 1, -1, dtype=np.int32)
    reached = np.zeros(top + 1, dtype=bool)
    reached[0] = True
    pieces: list[tuple[int, int]] = []
    for k, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        size //= unit
        left, many = min(count, top // size), 1
        while left and not reached[aim]:
            many = min(many, left)
            step = size * many
            new = reached[:-step] & ~reached[step:]
            last[step:][new] = len(pieces)
            reached[step:] |= new
            pieces.append((k, many))
            left, many = left - many, 2 * many
        if reached[aim]:
            break
    found = np.flatnonzero(reached)
    at = int(found[np.argmin(np.abs(found * unit - goal))])
    while at:
        k, many = pieces[last[at]]
        taken[k] += many
        at -= many * sizes[k] // unit
    return taken


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each size to take so that their words come nearest to ``budget``, which is less than all have.

    An even share of each size, longest first, where what is left of a share goes on to the next size; the last
    ``RESERVE`` longest lengths of words are fitted by :func:`nearest_sum`.
    """
    taken = np.zeros(len(sizes), dtype=np.int64)
    total = int((sizes * counts).sum())
    goal = int(budget + 0.5)
    if goal <= 0 or total == 0:
        return taken
    if goal >= total:
        return np.where(sizes > 0, counts, 0)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    even = max(0, goal - RESERVE * int(sizes.max()))
    carry = 0.0
    for k in order.tolist():
        carry += even / total * float(sizes[k] * counts[k])
        taken[k] = min(int(counts[k]), int(carry / sizes[k]))
        carry -= float(taken[k] * sizes[k])
    left = goal - int((taken * sizes).sum())
    taken[order] += np.array(nearest_sum(sizes[order].tolist(), (counts - taken)[order].tolist(), left), dtype=np.int64)
    return taken


def _fit(table: pa.Table) -> pa.Table:
    """The counts of one source, by length, with how many of each length to take."""
    sizes, counts = (table.column(c).to_numpy() for c in ("size", "n"))
    taken = fit_budget(sizes, counts, table.column("budget")[0].as_py())
    return pa.table([*(table.column(c) for c in [*_LENGTH, "n", "whole", "source_size", "target"]), pa.array(taken, pa.int64())], names=[*_LENGTH, "n", "whole", "source_size", "target", "k"])


_FITTED = "absent boolean, name string, size long, n long, whole long, source_size long, target double, k long"


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0, repeats: int = REPEATS) -> DataFrame:
    """``sources`` (absent, name, source_size) with their ``target`` words.

    Sources in code-point order, the null one last, weigh ``weights`` in turn and share ``share`` of all words by
    weight. No target is above ``repeats`` times its source: the excess goes to the others by weight. A
    target is then ``least(cap, level * weight)``; the level rises from round to round as more sources are
    capped, and each round is one aggregate over the sources.
    """
    placed = place_in_order(sources.withColumn("one", F.lit(1).cast("long")), _SOURCE)
    numbered, _ = running_total(placed, "one", "number")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("number") % len(weights) + 1).cast("int"))
    weighed = store(numbered.select(*_SOURCE, "source_size", weight.alias("weight"), (F.col("source_size") * float(repeats)).alias("cap")), "sources")
    total = share * float(weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level, capped = 0.0, -1
    while True:
        above = (F.col("cap") < level * F.col("weight")) if capped >= 0 else F.lit(False)
        of = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0.0))
        n, used, open_weight = weighed.agg(F.count_if(above), of("cap", above), of("weight", ~above)).first()
        if n == capped or not open_weight:
            break
        capped, level = n, (total - used) / open_weight
    target = F.least(F.col("cap"), level * F.col("weight")) if open_weight else F.col("cap")
    return weighed.select(*_SOURCE, "source_size", target.alias("target"))


def _by_length(left: DataFrame, right: DataFrame, total: int) -> DataFrame:
    """``left`` with the row of ``right`` for its source and length, if there is one. The rows of ``right`` that stand
    for at least one in ``HOT`` of all documents, so at most ``HOT``, are broadcast; of the others none is hot."""
    hot = F.broadcast(right.filter(F.col("n") * HOT >= total).drop("n"))
    rest = right.filter(F.col("n") * HOT < total).drop("n")
    return left.join(hot, _LENGTH).unionByName(left.join(hot.select(*_LENGTH), _LENGTH, "left_anti").join(rest, _LENGTH, "left"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0, repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    ``size`` is the text's number of words and ``taken`` a multiple of it, at most ``repeats`` times. The words
    taken of a source come as near to its target as a sum of its documents' sizes does. A null text has no words;
    a null source is one of its own, the last; null ids and repeated rows count like others, and of rows
    alike in id, source and size any may be the one that is taken. An empty table gives no rows. Other
    columns are not read. The choice depends on ``seed``, ids and counts only, so reruns agree.
    """
    require_columns(docs, "doc_id", "text", "source")
    ship_package(docs.sparkSession)
    read = docs.select(
        docs["source"].isNull().alias("absent"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("name"),
        word_count(docs["text"].cast("string")).alias("size"), docs["doc_id"].cast("long").alias("doc_id"),
    )
    each = store(read.groupBy(*_LENGTH, "doc_id").agg(F.count("*").alias("m")).withColumn("h", F.xxhash64(F.lit(seed).cast("long"), "doc_id")), "each")
    lengths = store(each.groupBy(*_LENGTH).agg(F.sum("m").alias("n")), "lengths")
    total = lengths.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sources = lengths.groupBy(*_SOURCE).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    plan = targets(sources, weights, share, repeats)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(repeats), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("budget", F.when(whole < repeats, F.col("target") - whole * F.col("source_size")).otherwise(0.0))
    fitted = store(lengths.join(plan, _SOURCE).groupBy(*_SOURCE).applyInArrow(_fit, _FITTED), "fitted")

    place = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))  # in [0, 1)
    bucket = F.floor(place * F.ceil(F.col("of") / BUCKET)).cast("long")
    dealt = store(_by_length(each, fitted.withColumn("of", F.col("n")), total).withColumn("bucket", bucket), "dealt")
    some = dealt.filter((F.col("k") > 0) & (F.col("k") < F.col("of")))
    held = some.groupBy(*_LENGTH, "bucket").agg(F.sum("m").alias("held"), F.first("k").alias("k"), F.first("of").alias("n"))
    before = F.coalesce(F.sum("held").over(W.partitionBy(*_LENGTH).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = held.withColumn("before", before).filter((F.col("before") < F.col("k")) & (F.col("k") <= F.col("before") + F.col("held")))
    cut = cut.select(*_LENGTH, "n", F.col("bucket").alias("cut"), (F.col("k") - F.col("before")).alias("need"))
    marked = store(_by_length(dealt, store(cut, "cut"), total), "marked")
    columns = ["doc_id", "size", "source_size", "target", "whole", "m"]
    inside = F.col("cut").isNotNull() & (F.col("bucket") == F.col("cut"))
    ahead = F.coalesce(F.sum("m").over(W.partitionBy(*_LENGTH).orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = marked.filter(inside).select(*columns, F.greatest(F.lit(0), F.least(F.col("m"), F.col("need") - ahead)).alias("more"))
    everything = (F.col("k") == F.col("of")) | F.coalesce(F.col("bucket") < F.col("cut"), F.lit(False))
    plain = marked.filter(~inside).select(*columns, F.when(everything, F.col("m")).otherwise(0).alias("more"))
    rows = expand_counts(ranked.unionByName(plain), "m", "copy")
    taken = F.col("size") * (F.col("whole") + (F.col("copy") < F.col("more")).cast("long"))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))
