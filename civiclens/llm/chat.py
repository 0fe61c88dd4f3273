"""Multi-party chat formatting by perspective rotation.

Every participant of a dialogue gives one rendering in which their turns are
the assistant's and all others are users named after their speaker.  The loss
mask of a rendering covers the assistant's texts and end marks.  Narrators
(``system``) speak in every rendering under their own name and have none of
their own.

A dialogue of more than ``max_turns`` turns is cut into segments of that many,
so no conversation is ever gathered as a whole: turns are numbered by a
distributed rank.  Every segment is rendered for every participant of the whole
dialogue, silent ones too.  ``text`` is then a slice: a participant's texts in the
order of ``segment`` joined are the rendering of the dialogue, and the places in
``loss`` count from the start of their slice.

Defined results: a repeated row (equal conversation, turn, role and text)
counts once; turns of one number follow in the order of role and text; a null
text is an empty turn, a null role the speaker ``unknown``; a null turn comes
first; a null conv_id is a conversation of its own; ``<|`` in a text is written
``< |``, so a text cannot hold control marks; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import join_on, written
from civiclens.operators._plan import global_rank

END = "<|end|>\n"


def _clean(c):
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, max_turns: int = 64, narrators: tuple[str, ...] = ("system",)) -> DataFrame:
    """``conv_id, segment, speaker, n_turns, text, loss`` (array of [start, end)
    places in characters) for every segment and participant of its dialogue."""
    rows = turns.select("conv_id", "turn",
                        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    ranked = written(global_rank(rows, ["conv_id", "turn", "role", "text"], "_r"), "turns")
    first = ranked.groupBy("conv_id").agg(F.min("_r").alias("_first"))
    ranked = join_on(ranked, first, ("conv_id",)).withColumn("_pos", F.col("_r") - F.col("_first"))
    seg = ranked.groupBy("conv_id", F.floor(F.col("_pos") / max_turns).alias("segment")).agg(
        F.sort_array(F.collect_list(F.struct("_pos", "role", "text"))).alias("_turns"))
    who = ranked.select("conv_id", F.col("role").alias("speaker")).distinct()
    who = who.where(~F.col("speaker").isin(*narrators)) if narrators else who
    each = join_on(seg, who, ("conv_id",))
    narrator = F.lit(False)

    def head(t):
        own = t["role"] == F.col("speaker")
        told = t["role"].isin(*narrators) if narrators else narrator
        return (F.when(own, F.lit("<|assistant|>\n"))
                 .when(told, F.concat(F.lit("<|"), _clean(t["role"]), F.lit("|>\n")))
                 .otherwise(F.concat(F.lit("<|user "), _clean(t["role"]), F.lit("|>\n"))))

    parts = F.transform("_turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(_clean(t["text"]), F.lit(END)).alias("body"),
        (t["role"] == F.col("speaker")).alias("own")))
    each = each.withColumn("_parts", F.explode(F.array(parts)))
    zero = F.struct(F.lit(0).alias("at"),
                    F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

    def add(acc, p):
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.struct(start.alias("start"), (end - 1).alias("end"))  # without the line end
        return F.struct(end.alias("at"), F.when(p["own"], F.concat(acc["loss"], F.array(span)))
                        .otherwise(acc["loss"]).alias("loss"))
    return each.select(
        "conv_id", F.col("segment").cast("long").alias("segment"), "speaker",
        F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        F.aggregate("_parts", zero, add, lambda acc: acc["loss"]).alias("loss"))
