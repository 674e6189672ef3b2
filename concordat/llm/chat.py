"""Chat formatting with a loss mask and a round trip through the grammar.

    conversation = "<s>" turn*
    turn         = "[INST]" role "[/INST]" text "</s>"

A conversation is rendered as it is, parsed back, and compared turn by turn. Where the parser
recovers something else, role and text hold control strings; these are escaped with one more
backslash after their first character, which the parser takes away again, and the comparison
is repeated. An escaped text holds no control string, so the second rendering always agrees;
should it not, the query fails instead of returning it. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
START, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _render(turns: Column, dress) -> Column:
    parts = F.transform(
        turns, lambda t: F.concat(F.lit(ROLE), dress(t["role"]), F.lit(TEXT), dress(t["text"]), F.lit(END))
    )
    return F.concat(F.lit(START), F.array_join(parts, ""))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    body = F.split(formatted.substr(F.lit(len(START) + 1), F.length(formatted)), END, -1)
    whole = F.slice(body, 1, F.size(body) - 1)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, TEXT)
        role = piece.substr(F.lit(len(ROLE) + 1), at - F.lit(len(ROLE) + 1))
        text = piece.substr(at + F.lit(len(TEXT)), F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(whole, turn)


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """(conv_id, formatted, loss_spans): one row per conversation.

    `loss_spans` are the character ranges [start, end) of `formatted` that hold the texts of
    the role `learn`, in order. Turns go by number, a null number first, then by role and
    text, so repeated rows are turns of their own. Null roles and texts are empty. Rows with a
    null conversation form one conversation. A conversation is one record, whatever its length.
    """
    own = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    fixed = len(ROLE) + len(TEXT) + len(END)

    def start(dress) -> Column:
        size = F.length(dress(F.col("role"))) + F.length(dress(F.col("text"))) + F.lit(fixed)
        lead = F.length(dress(F.col("role"))) + F.lit(len(START) + len(ROLE) + len(TEXT))
        return (F.coalesce(F.sum(size).over(before), F.lit(0)) + lead).cast("long")

    placed = own.select("*", start(lambda c: c).alias("plain_at"), start(escape).alias("escaped_at"))
    told = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "plain_at", "escaped_at"))).alias("turns")
    )
    said = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    plain = told.select("conv_id", "turns", said.alias("said"), _render(F.col("turns"), lambda c: c).alias("plain"))
    tried = plain.withColumn("clean", parse(F.col("plain")) == F.col("said"))
    dressed = tried.withColumn("formatted", F.when(F.col("clean"), F.col("plain")).otherwise(_render(F.col("turns"), escape)))
    learnt = F.filter("turns", lambda t: t["role"] == learn)

    def span(t: Column) -> Column:
        at = F.when(F.col("clean"), t["plain_at"]).otherwise(t["escaped_at"])
        size = F.when(F.col("clean"), F.length(t["text"])).otherwise(F.length(escape(t["text"])))
        return F.struct(at.alias("start"), (at + size).alias("end"))

    agreed = (parse(F.col("formatted")) == F.col("said"))
    return dressed.select(
        "conv_id",
        F.when(agreed, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not round-trip"))).alias("formatted"),
        F.transform(learnt, span).alias("loss_spans"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What reading back the formatted text gives: counts and digests of turns and of the masked text."""
    turns = parse(F.col("formatted"))
    spoken = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.transform(
        "loss_spans",
        lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return formatted.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(F.array_join(masked, "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join(masked, ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
