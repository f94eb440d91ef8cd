"""Secret scans with corpus-wide ownership, in built-in column functions only.

Spans come from splitting a text at a pattern: the pieces and the matches alternate, so running
lengths give every place. Candidates are the values of the base kinds and long random-looking tokens;
their hashes are counted by distinct repositories (documents) and owners (sources) over the whole
corpus. A value that many owners or repositories carry is a copied example; one that few have looks
live. Base spans always stay and are marked live or not; live tokens outside them are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genotype import bind, compute_once
from ..session import require_columns
from .common import fresh, store

#: The patterns of the three base kinds, in the order they are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "owned")
#: A match of ASSIGN counts if this many value characters end it.
ASSIGN_VALUE = r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}$"""

#: Candidate tokens: at least 20 characters, a digit and a letter among them.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: A candidate looks live if at most so many owners, and so many repositories, carry it.
MAX_OWNERS = 1
MAX_REPOSITORIES = 8
_BLOCK = 256


def running(sizes: Column) -> Column:
    """Sums of all sizes before each place of an array, in linear time: within blocks of ``_BLOCK``,
    and over the block totals."""
    n = F.size(sizes)
    blocks = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    empty = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("before"))
    step = lambda acc, x: F.struct((acc["total"] + x).alias("total"), F.concat(acc["before"], F.array(acc["total"])).alias("before"))
    parts = F.transform(blocks, lambda b: F.aggregate(F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK)), empty, step))
    starts = F.aggregate(parts, empty, lambda acc, p: step(acc, p["total"]))["before"]
    return F.flatten(F.zip_with(parts, starts, lambda p, s: F.transform(p["before"], lambda x: x + s)))


_SPAN = "start:int,number:int,end:int,kind:string"


def spans_of(text: Column, pattern: str, kind: str, keep: str | None = None) -> Column:
    """Matches of ``pattern`` as structs (start, number, end, kind, token); code points, end exclusive.
    ``number`` is the kind's place in ``KINDS``; ``keep``: matches without this pattern are dropped."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # One piece more than matches: the last pair has no match and ends the text.
    pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("skip"), F.coalesce(m, F.lit("")).alias("match")))

    def span(pair: Column, at: Column) -> Column:
        start = at + pair["skip"]
        fields = [start.alias("start"), F.lit(KINDS.index(kind)).alias("number"), (start + F.length(pair["match"])).alias("end"), F.lit(kind).alias("kind")]
        return F.struct(*fields, pair["match"].alias("token"))

    def placed(pairs: Column) -> Column:
        before = bind(F.transform(pairs, lambda p: p["skip"] + F.length(p["match"])), running)
        return F.filter(F.zip_with(pairs, before, span), lambda s: s["start"] < s["end"])

    spans = bind(pairs, placed)
    if keep is not None:
        spans = F.filter(spans, lambda s: s["token"].rlike(keep))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<struct<{_SPAN},token:string>>"))


def base_spans(text: Column) -> Column:
    return F.flatten(F.array(spans_of(text, ASSIGN, "assign", keep=ASSIGN_VALUE), spans_of(text, ACCESS, "access"), spans_of(text, HEX, "hex")))


def bare(span: Column) -> Column:
    """A span without its text."""
    return F.struct(*(span[c].alias(c) for c in ("start", "number", "end", "kind")))


def digest(spans: Column) -> Column:
    """kind:start:end of all spans by start, then kind as listed, comma-joined."""
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", text)


def candidates(text: Column) -> Column:
    """All base spans, and the candidate tokens that none of them overlaps."""
    mixed = lambda s: s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]")
    overlaps = lambda t, b: (t["start"] < b["end"]) & (b["start"] < t["end"])
    found = F.filter(spans_of(text, TOKEN, "owned"), mixed)
    free = lambda x: F.concat(x["base"], F.filter(x["found"], lambda t: ~F.exists(x["base"], lambda b: overlaps(t, b))))
    return bind(F.struct(found.alias("found"), base_spans(text).alias("base")), free)


def value_hash(span: Column) -> Column:
    """Of what is secret in a span: the value of an assignment, else all of it."""
    value = F.when(span["kind"] == "assign", F.regexp_extract(span["token"], ASSIGN, 2)).otherwise(span["token"])
    return F.sha2(value, 256)


def row_key(doc_id: Column, text: Column) -> Column:
    """Equal for rows with equal id and text only."""
    return F.sha2(F.concat_ws("\x00", F.coalesce(doc_id.cast("string"), F.lit("\x01")), F.coalesce(text.cast("string"), F.lit(""))), 256)


def ownership(found: DataFrame) -> DataFrame:
    """``(hash, owners, repositories)`` of each candidate of ``found(hash, owner, repository)``.

    Duplicates leave first and everything is combined before each shuffle, so a token that a third of
    all rows carry is one row for each task. Null owners and repositories count as one each.
    """
    once = found.select("hash", F.struct(F.col("owner").alias("v")).alias("owner"), F.struct(F.col("repository").alias("v")).alias("repository")).distinct()
    by_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"))


def live_spans(docs: DataFrame, repository: str, owner: str, max_owners: int, max_repositories: int) -> DataFrame:
    """``(key, spans)`` of the rows with values that look live: those spans, base ones and others."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs[repository].alias("repository"), docs[owner].alias("owner"), text.alias("text"))
    some = F.col("text").rlike(TOKEN) | F.col("text").rlike(ASSIGN)  # the other kinds are tokens as well
    key = row_key(F.col("doc_id"), F.col("text")).alias("key")
    found = rows.filter(some).select(key, "repository", "owner", F.explode(candidates(F.col("text"))).alias("t"))
    # Stored: narrow, and the texts are searched once for the counts and for the places.
    found = store(found.select("key", "repository", "owner", value_hash(F.col("t")).alias("hash"), bare(F.col("t")).alias("span")), "candidates")
    few = ownership(found.select("hash", "owner", "repository")).filter((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories))
    return found.join(few.select("hash"), "hash", "left_semi").groupBy("key").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def scan_secrets(
    docs: DataFrame, repository: str = "doc_id", owner: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, base (spans of the base kinds, sorted), live (those whose
    value looks live) and added (other candidate spans that look live); spans are (start, number, end, kind).

    A null or empty text has no spans. Live spans are joined back by a hash of the row's id and text,
    so null ids and repeated rows are right (equal rows have equal spans). Only these columns are read.
    """
    require_columns(docs, "doc_id", "text", repository, owner)
    live = live_spans(docs, repository, owner, max_owners, max_repositories)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    base = docs.select(row_key(docs["doc_id"], text).alias("key"), docs["doc_id"].alias("doc_id"), F.transform(F.array_sort(base_spans(text)), bare).alias("base"))
    spans = F.coalesce("spans", F.array().cast(f"array<struct<{_SPAN}>>"))
    of = lambda added: F.filter(spans, lambda s: (s["kind"] == "owned") == F.lit(added))
    return base.join(live, "key", "left").select("doc_id", "base", of(False).alias("live"), of(True).alias("added"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts by base kind, a hash of the base spans, all spans as text, and how many base and added
    spans look live."""
    found = scan_secrets(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(F.concat("base", "added")).alias("spans"),
        F.size("live").cast("long").alias("n_live"), F.size("added").cast("long").alias("n_owned"),
    )


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span replaced by ``mark``; spans that overlap are replaced as one."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def join(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        own = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        return F.when(s["start"] < last["end"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(wider))).otherwise(F.concat(acc, F.array(own)))

    def rebuilt(merged: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(merged, lambda s: s["end"]))
        ends = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text)))
        return F.array_join(F.zip_with(starts, ends, lambda s, e: F.substring(text, s + 1, e - s)), mark)

    merged = lambda s: F.aggregate(F.array_sort(s), empty, join)
    return bind(spans, lambda s: F.when(F.size(s) > 0, bind(merged(s), rebuilt)).otherwise(text))


def redact_secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """The rows of ``docs`` with all base and added spans of their text replaced, and n_chars, where
    there is such a column, counted anew. Rows without spans come back as they are.

    Base spans are replaced where the text lies. Only rows with a candidate outside of them, few in
    any corpus, are joined with what was counted.
    """
    require_columns(docs, "doc_id", "text", repository, owner)
    key, theirs, added = fresh("found_key", docs), fresh("their_key", docs), fresh("added_spans", docs)
    live = live_spans(docs, repository, owner, MAX_OWNERS, MAX_REPOSITORIES)
    live = live.select(F.col("key").alias(theirs), F.filter("spans", lambda s: s["kind"] == "owned").alias(added)).filter(F.size(added) > 0)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    open_ = text.rlike(TOKEN) & F.exists(candidates(text), lambda s: s["kind"] == "owned")
    none = F.array().cast(f"array<struct<{_SPAN}>>")
    keyed = docs.filter(open_).withColumn(key, row_key(docs["doc_id"], text))
    joined = keyed.join(live, F.col(key) == F.col(theirs), "left").select(*docs.columns, F.coalesce(added, none).alias(added))
    whole = docs.filter(~open_).withColumn(added, none).unionByName(joined)
    spans = lambda t: F.concat(F.transform(base_spans(t), bare), F.col(added))
    new = F.when(F.col("text").isNotNull(), redacted(F.col("text"), spans(F.col("text"))))
    marked = compute_once(whole, added, new)
    if "n_chars" in docs.columns:
        counted = F.when(F.col(added) == F.col("text"), F.col("n_chars")).otherwise(F.length(added))
        marked = marked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(counted).cast(docs.schema["n_chars"].dataType))
    return marked.withColumn("text", F.col(added)).select(*docs.columns)
