"""Chat formatting by multi-party perspective rotation, in DataFrame expressions only.

For every participant the dialogue is rendered with that speaker as assistant
and all others as named users; system messages are context in each rendering.
The mask tells runs of characters to train on (the assistant's words with their
end mark) from runs that are only read.

A rendering comes in parts of ``span`` turn numbers, so that a conversation that
holds a third of all rows is many bounded rows; the parts of one speaker in
order, joined, are the whole rendering, and an ordinary conversation is one
part. Participants are found with partial sums, and their join back can be
split where one conversation is hot.

Messages are in order of turn (NULL first), role, text; repeated rows are
rendered as often as they occur. A NULL text is empty, a NULL or empty role is
``unknown``, a NULL conv_id is one conversation. A conversation without
participants has no rendering. Marks inside texts are broken up, so a text
can't end its message. Columns beside the four are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYSTEM = "system"
SPAN = 64


def rotate(conversations: DataFrame, span: int = SPAN, system: str = SYSTEM) -> DataFrame:
    """One row per conversation, speaker and part: conv_id, speaker, part, n_messages, text, mask (runs of chars and train), n_target_chars."""
    role = F.when(F.coalesce("role", F.lit("")) == "", F.lit("unknown")).otherwise(F.col("role"))
    messages = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.floor(F.col("turn") / span), F.lit(-1)).cast("long").alias("part"),
        role.alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    speakers = messages.filter(F.col("role") != system).groupBy("conv_id").agg(F.sort_array(F.collect_set("role")).alias("speakers"))
    parts = messages.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))
    each = (
        parts.alias("p")
        .join(speakers.alias("s"), F.col("p.conv_id").eqNullSafe(F.col("s.conv_id")))
        .select("p.conv_id", "part", "messages", F.explode("speakers").alias("speaker"))
    )

    def plain(value):
        return F.replace(value, F.lit("<|"), F.lit("< |"))

    def rendered(m):
        own = m["role"] == F.col("speaker")
        head = (
            F.when(m["role"] == system, F.lit("<|system|>\n"))
            .when(own, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user "), plain(m["role"]), F.lit("|>\n")))
        )
        body = F.concat(plain(m["text"]), F.lit("<|end|>\n"))
        return F.struct(head.alias("head"), body.alias("body"), (own & (m["role"] != system)).alias("own"))

    lines = each.withColumn("lines", F.transform("messages", rendered))
    mask = F.flatten(
        F.transform(
            "lines",
            lambda x: F.array(
                F.struct(F.length(x["head"]).alias("chars"), F.lit(False).alias("train")),
                F.struct(F.length(x["body"]).alias("chars"), x["own"].alias("train")),
            ),
        )
    )
    target = F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + F.when(x["own"], F.length(x["body"])).otherwise(0))
    return lines.select(
        "conv_id",
        "speaker",
        "part",
        F.size("lines").cast("long").alias("n_messages"),
        F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"])), "").alias("text"),
        mask.alias("mask"),
        target.alias("n_target_chars"),
    )
