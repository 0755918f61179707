"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and its text alone
trainable. A conversation that does not end with the assistant has one more example without a trainable
part, so no turn is lost. A turn is written ``<|role|>``, line end, text, ``</s>``, line end. Control strings
inside texts and roles get a backslash after their first character, and one more if they have some there, so
reading back is exact.

Turns are ordered by number, then role, then text, a missing number first; null roles and texts count as
empty, repeated rows are turns of their own. The result has one row per example. Digests and examples need
the text of one conversation in one row, which bounds a conversation to a row's size (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Strings that chat formats use as control marks, by their first character and the rest.
_REST = r"(\||/?s>|/?INST\]|</?SYS>>)"
_PLAIN = r"([<\[])(\\*)" + _REST
_ESCAPED = r"([<\[])\\(\\*)" + _REST
ROLE_END, TURN_END = "|>\n", "</s>\n"
TARGET = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def _header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.regexp_replace(escape(role), r"\|(\\*)>", r"|$1\\>"), F.lit(ROLE_END))


def _role(header: Column) -> Column:
    return unescape(F.regexp_replace(header, r"\|\\(\\*)>", r"|$1>"))


def prefix_examples(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end, last): offsets in code points, end exclusive.

    ``example`` counts from 0 in each conversation; ``last`` marks the example that holds all its turns.
    """
    rows = df.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("_t"),
    )
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_turns"))
    written = F.transform(
        "_turns",
        lambda t: F.struct(_header(t["role"]).alias("head"), escape(t["text"]).alias("body"), (t["role"] == TARGET).alias("target")),
    )
    talks = talks.select("conv_id", written.alias("_turns"), F.size("_turns").alias("_n"))
    ends = F.filter(F.sequence(F.lit(1), F.col("_n")), lambda i: F.element_at("_turns", i)["target"] | (i == F.col("_n")))
    each = talks.select("*", F.posexplode(ends).alias("example", "_end"))
    before = F.transform(F.slice("_turns", F.lit(1), F.col("_end") - 1), lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END)))
    each = each.select("conv_id", "example", F.array_join(before, "").alias("_before"), F.element_at("_turns", F.col("_end")).alias("_turn"), (F.col("_end") == F.col("_n")).alias("last"))
    start = F.length("_before") + F.length("_turn.head")
    return each.select(
        "conv_id",
        F.col("example").cast("bigint").alias("example"),
        F.concat("_before", "_turn.head", "_turn.body", F.lit(TURN_END)).alias("text"),
        start.cast("bigint").alias("loss_start"),
        (start + F.when(F.col("_turn.target"), F.length("_turn.body")).otherwise(0)).cast("bigint").alias("loss_end"),
        "last",
    )


def read_turns(text: Column) -> Column:
    """(role, text) of every turn of an example."""
    parts = F.filter(F.split(text, TURN_END), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            _role(F.substring(p, F.lit(3), F.locate(ROLE_END, p) - 3)).alias("role"),
            unescape(F.substring(p, F.locate(ROLE_END, p) + len(ROLE_END), F.length(p))).alias("text"),
        ),
    )


def conversation_digests(examples: DataFrame) -> DataFrame:
    """What the examples hold, per conversation; only the last example of each moves with its text."""
    trained = unescape(F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")))
    each = examples.select(
        "conv_id",
        F.length("text").cast("bigint").alias("_chars"),
        F.struct("example", trained.alias("loss"), F.when(F.col("last"), F.col("text")).alias("full")).alias("_e"),
    )
    talks = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("_e")).alias("_e"), F.sum("_chars").alias("formatted_chars"))
    talks = talks.select("conv_id", "formatted_chars", F.array_join("_e.loss", "").alias("_loss"), read_turns(F.element_at("_e", -1)["full"]).alias("_turns"))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return talks.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
