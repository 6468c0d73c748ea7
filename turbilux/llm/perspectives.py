"""Chat formatting by perspective: each speaker of a dialogue in turn is the assistant, the others are named users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# turns of a dialogue rendered in one row
PIECE_TURNS = 256
ASSISTANT = "<|assistant|>\n"
USER = ("<|user name=", "|>\n")
END, NEXT = "<|end|>", "\n"
UNKNOWN = "unknown"


def _head(role: Column, speaker: Column) -> Column:
    return F.when(role == speaker, F.lit(ASSISTANT)).otherwise(F.concat(F.lit(USER[0]), role, F.lit(USER[1])))


def rotate(turns: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """One row per dialogue, speaker and piece: conv_id, speaker, piece, start, text, mask, n_trained.

    ``text`` renders the piece with the speaker's turns as assistant and all others as users under their names.  ``start`` is
    the place of the piece in the whole dialogue; ``mask`` lists the spans to train on, first-end pairs in characters of the
    whole dialogue: the speaker's own words and end marks, no headers.  n_trained adds them up.

    A piece holds the turns with the same turn // piece_turns, so a dialogue of any length comes in rows of bounded size; its pieces in
    order are the dialogue.  ``turns`` needs conv_id, turn, role and text; other columns are ignored.  A null role is the
    speaker ``unknown``, a null text is empty, null turns come first in piece -1; turns of the same number, repeated rows
    included, stand in the order of role and text.  Rows with a null conv_id belong to no dialogue and are left out.
    """
    turns = turns.where("conv_id is not null").select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(UNKNOWN)).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / piece_turns), F.lit(-1)).alias("piece"),
    )
    speakers = turns.select("conv_id", F.col("role").alias("speaker")).distinct()
    pieces = turns.groupBy("conv_id", "piece").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**62))).alias("turn"), "role", "text"))).alias("said")
    )
    speaker = F.col("speaker")

    def shown(t: Column) -> Column:
        return F.concat(_head(t.role, speaker), t.text, F.lit(END + NEXT))

    def spans(done: Column, t: Column) -> Column:
        first = done.at + F.length(_head(t.role, speaker))
        last = first + F.length(t.text) + len(END)
        own = F.array(F.struct(first.alias("first"), last.alias("last")))
        return F.struct(
            (last + len(NEXT)).alias("at"),
            F.when(t.role == speaker, F.concat(done.spans, own)).otherwise(done.spans).alias("spans"),
        )

    nothing = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("spans")
    )
    rendered = pieces.join(speakers, "conv_id").select(
        "conv_id",
        "speaker",
        "piece",
        F.array_join(F.transform("said", shown), "").alias("text"),
        F.aggregate("said", nothing, spans)["spans"].alias("spans"),
    )
    earlier = Window.partitionBy("conv_id", "speaker").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = rendered.withColumn("start", F.coalesce(F.sum(F.length("text")).over(earlier), F.lit(0)))
    listed = F.transform(
        "spans",
        lambda s: F.concat_ws("-", (s["first"] + F.col("start")).cast("string"), (s["last"] + F.col("start")).cast("string")),
    )
    trained = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]).cast("long"))
    return placed.select(
        "conv_id", "speaker", "piece", "start", "text", F.array_join(listed, ",").alias("mask"), trained.alias("n_trained")
    )
