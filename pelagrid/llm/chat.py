"""Chat formatting by perspective rotation, in SQL functions only.

For every participant of a conversation the dialogue is rendered once with that speaker as
``assistant``; all other speakers become users under their own names, system turns stay system
turns. Each rendering comes with the spans of the assistant's words (from, to, in code
points of the part's text), which are what a loss mask leaves on.

A conversation of any length is rendered in parts of ``turns`` turns, so a conversation that
holds a third of all rows is spread over tasks; ordinary conversations are one part. Turns are
put in order by range-sorted slices, never by one task per conversation.

Defined results: turns are ordered by turn (null last), role, text; null roles are the speaker
``unknown``, null texts are empty turns; control sequences of the format inside names or texts are defused by a
zero-width space after ``<``; repeated rows are repeated turns; conversations with system turns only give no
rendering; rows without ``conv_id`` are one conversation with a null id. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm.graph import AT, SLICE, running, sliced

TURNS = 256  # turns of one part
SYSTEM, UNKNOWN = "system", "unknown"
OPEN, CLOSE, STOP = "<|", "|>", "<|end|>\n"


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit(OPEN), F.lit("<\u200b|"))


def turns_of(conversations: DataFrame, per_part: int) -> DataFrame:
    """conv_id, part, speaker and text of every turn with its number ``at`` in the dialogue."""
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = sliced(rows, ["conv_id", F.col("turn").asc_nulls_last(), "speaker", "text"], "turns")
    numbered = running(ordered.withColumn("_one", F.lit(1)), ["conv_id"], "_one", "at")
    return numbered.drop(SLICE, AT, "_one", "turn").withColumn(
        "part", F.floor(F.col("at") / per_part).cast("long")
    )


def perspectives(conversations: DataFrame, per_part: int = TURNS) -> DataFrame:
    """conv_id, assistant, part, n_turns, text, spans(begin, end), n_masked_in for every view."""
    turns = turns_of(conversations, per_part)
    parts = turns.groupBy("conv_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("at", "speaker", "text"))).alias("turns")
    )
    speakers = (
        conversations.select(
            F.col("conv_id").alias("_conv"),
            F.coalesce(F.col("role").cast("string"), F.lit(UNKNOWN)).alias("assistant"),
        )
        .where(F.col("assistant") != SYSTEM)
        .distinct()
    )
    views = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    def head(t):
        return (
            F.when(t["speaker"] == F.col("assistant"), F.lit(f"{OPEN}assistant{CLOSE}\n"))
            .when(t["speaker"] == SYSTEM, F.lit(f"{OPEN}system{CLOSE}\n"))
            .otherwise(F.concat(F.lit(f"{OPEN}user name="), _safe(t["speaker"]), F.lit(f"{CLOSE}\n")))
        )

    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"),
            _safe(t["text"]).alias("body"),
            (t["speaker"] == F.col("assistant")).alias("own"),
        ),
    )
    made = views.withColumn("pieces", pieces)
    # Where each turn's words begin: the lengths of all that stands before.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(state, p):
        begin = state["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("begin"), (end + len(STOP)).alias("end")))
        spans = F.when(p["own"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + len(STOP)).alias("at"), spans.alias("spans"))

    spans = F.aggregate("pieces", start, step, lambda s: s["spans"])
    text = F.array_join(
        F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(STOP))), ""
    )
    return made.select(
        "conv_id",
        "assistant",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        text.alias("text"),
        spans.alias("spans"),
    )


def digest(views: DataFrame) -> DataFrame:
    """The views with their masks as text: 1-based assistant spans and the masked-in length."""
    shown = F.array_join(
        F.transform("spans", lambda s: F.concat_ws("-", s["begin"].cast("string"), s["end"].cast("string"))), ","
    )
    masked = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return views.select(
        "conv_id", "assistant", "part", "n_turns", "text", shown.alias("mask"), masked.alias("n_masked_in")
    )
