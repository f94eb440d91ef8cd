"""Multi-party chat formatting: one dialogue from the perspective of each of its speakers.

For every participant the dialogue is rendered with that speaker as assistant and all others as named
users, with the span of each turn that a loss may count. A rendered dialogue is kept as its turns with
their places, not as one string, so a conversation of any length is spread over many rows and tasks;
places come from sums within runs of turns and over the runs. Turns that are alike are counted before
they are put in order, and runs are cut from that order, so a conversation with a third of all rows is
spread also where its turns have equal numbers, or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import place_in_order, running_total
from ..session import require_columns

SYSTEM = "system"
ASSISTANT_HEAD, SYSTEM_HEAD, END = "<|assistant|>\n", "<|system|>\n", "<|end|>\n"
#: Name of a speaker whose role is null; such a turn is context, and nobody's perspective.
NOBODY = "unknown"
#: Consecutive turns that make a run at most, and copies of a repeated turn that are kept as one row.
RUN = 256


def head(role: Column, speaker: Column) -> Column:
    named = F.concat(F.lit("<|user:"), F.coalesce(role, F.lit(NOBODY)), F.lit("|>\n"))
    return F.when(role == speaker, ASSISTANT_HEAD).when(role == SYSTEM, SYSTEM_HEAD).otherwise(named)


def rotate_perspectives(turns: DataFrame) -> DataFrame:
    """One row per turn and perspective: conv_id, speaker, turn, role, text (rendered), start, end
    (code points in the whole rendered dialogue, which is the texts in order of start), mask_start and
    mask_end (what the loss may count: the speaker's own words and the end mark, else nothing).

    Every role but ``system`` that speaks in a conversation is a perspective; a conversation without one
    has no rows. Turns are ordered by turn (null last), role, text; repeated turns stay. A null text is
    empty, a null role is the named user ``unknown``, rows with a null conv_id are one conversation.
    Other columns are not read.
    """
    require_columns(turns, "conv_id", "turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("said"))
    placed = _in_order(rows.groupBy("conv_id", "turn", "role", "said").agg(F.count("*").alias("n")))
    speakers = placed.filter(F.col("role") != SYSTEM).select("key", F.col("role").alias("speaker")).distinct()
    seen = placed.join(speakers, "key")
    seen = seen.withColumn("head", head(F.col("role"), F.col("speaker"))).withColumn("text", F.concat("head", "said", F.lit(END)))
    seen = seen.withColumn("size", F.length("text").cast("long")).withColumn("total", F.col("size") * F.col("n"))
    runs = _run_starts(seen.groupBy("key", "speaker", "run").agg(F.sum("total").alias("total")))
    within = Window.partitionBy("key", "speaker", "run").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = seen.withColumn("inside", F.coalesce(F.sum("total").over(within), F.lit(0)))
    inside = inside.join(runs, ["key", "speaker", "run"])  # the window's keys: the texts stay where they are
    each = inside.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    start = F.col("run_start") + F.col("inside") + F.col("copy") * F.col("size")
    own = F.col("role") == F.col("speaker")
    mask = F.when(own, start + F.length("head")), F.when(own, start + F.col("size"))
    return each.select("conv_id", "speaker", "turn", "role", "text", start.alias("start"), (start + F.col("size")).alias("end"), mask[0].alias("mask_start"), mask[1].alias("mask_end"))


def _in_order(once: DataFrame) -> DataFrame:
    """Distinct turns with their number ``n``, in order: ``at`` grows with it, and ``run`` is a run of at
    most ``RUN`` rows. A turn with more than ``RUN`` copies is a row for each ``RUN`` of them. ``key`` is the
    conversation as a text, which no null is."""
    zero, step, many = F.lit(0).cast("long"), F.lit(RUN).cast("long"), F.lit(RUN * RUN).cast("long")
    parts = once.withColumn("_from", F.explode(F.sequence(zero, F.col("n") - 1, many)))
    parts = parts.withColumn("_from", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + many, F.col("n")) - 1, step)))
    parts = parts.withColumn("n", F.least(F.col("n") - F.col("_from"), step))
    parts = parts.withColumn("_no_turn", F.col("turn").isNull()).withColumn("_no_role", F.col("role").isNull())
    placed = place_in_order(parts, ["conv_id", "_no_turn", "turn", "_no_role", "role", "said", "_from"])
    placed = placed.withColumn("at", F.monotonically_increasing_id())  # its partitions are stored, so it stays
    placed = placed.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    return placed.withColumn("run", F.floor(F.col("at") / RUN)).drop("_from", "_no_turn", "_no_role", "_part")


def _run_starts(totals: DataFrame) -> DataFrame:
    """``key, speaker, run, run_start``: what lies before each run in the rendered dialogue."""
    ranked, _ = running_total(place_in_order(totals, ["key", "speaker", "run"]), "total", "before")
    firsts = ranked.groupBy("key", "speaker").agg(F.min("before").alias("first"))
    return ranked.join(firsts, ["key", "speaker"]).select("key", "speaker", "run", (F.col("before") - F.col("first")).alias("run_start"))


SQL = f"""
WITH speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role <> '{SYSTEM}'),
seen AS (
  SELECT c.conv_id, speaker, turn, role, coalesce(text, '') AS said,
    CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = '{SYSTEM}' THEN '<|system|>'
         ELSE '<|user:' || coalesce(role, '{NOBODY}') || '|>' END || chr(10) AS head
  FROM conversations c JOIN speakers s ON c.conv_id IS NOT DISTINCT FROM s.conv_id),
made AS (SELECT *, head || said || '<|end|>' || chr(10) AS text FROM seen),
placed AS (
  SELECT *, CAST(sum(length(text)) OVER (PARTITION BY conv_id, speaker
    ORDER BY turn NULLS LAST, role NULLS LAST, said ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM made)
SELECT conv_id, speaker, turn, role, text, stop - length(text) AS start, stop AS "end",
  CASE WHEN role = speaker THEN stop - length(text) + length(head) END AS mask_start,
  CASE WHEN role = speaker THEN stop END AS mask_end
FROM placed
"""
