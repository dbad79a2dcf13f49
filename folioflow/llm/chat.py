"""Chat formatting with typed content parts, in built-in Spark functions alone.

A turn's content is a list of parts: text, image, audio or document. A visitor walks the parts in
order; texts are written with the control strings in them escaped, every other part leaves a
numbered placeholder, an attachment reference and the number of tokens it expands to. A
conversation becomes one string, from which turns and parts can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import free_names

# The template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PART_OPEN, PART_CLOSE = "<|part:", "|>"

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
#: Kinds of parts besides text.
ATTACHED = ("image", "audio", "document")
#: Side of an image patch in pixels, and tokens of a second of audio and of a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256

# A control string is "<" or "[" and one of these; a backslash put between the two breaks it. Texts that
# hold such a broken string already get one backslash more, so reading back takes off exactly one.
_TAIL = r"(?=(?:\||/?s>|/?INST\]|<SYS>>|</SYS>>))"


def escape(text: Column) -> Column:
    """Break the control strings in a text; ``unescape`` undoes it."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2")


def text_parts(text: Column) -> Column:
    """Plain text as a list of one part."""
    part = F.struct(
        F.lit("text").alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part).cast(f"array<{PART}>")


def expanded_tokens(part: Column) -> Column:
    """Tokens that stand for a part: patches, time steps or pages; none for texts, one at least otherwise."""
    patches = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    steps = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * PER_SECOND)
    pages = F.coalesce(part["pages"], F.lit(0)).cast("long") * PER_PAGE
    count = (
        F.when(part["kind"] == "image", patches).when(part["kind"] == "audio", steps).when(part["kind"] == "document", pages)
    )
    return F.when(part["kind"].isin(*ATTACHED), F.greatest(count, F.lit(1))).otherwise(0).cast("long")


def _visited(parts: Column) -> Column:
    """(shown, kind, ref, tokens) per part; placeholders are numbered within the turn."""

    def visit(part: Column, n: Column) -> Column:
        mark = F.concat(F.lit(PART_OPEN), part["kind"], F.lit(":"), n.cast("string"), F.lit(PART_CLOSE))
        return F.struct(
            F.when(part["kind"].isin(*ATTACHED), mark).otherwise(escape(F.coalesce(part["text"], F.lit("")))).alias("shown"),
            part["kind"].alias("kind"),
            part["ref"].alias("ref"),
            expanded_tokens(part).alias("tokens"),
        )

    return F.transform(F.coalesce(parts, F.array().cast(f"array<{PART}>")), visit)


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation of turns (conv_id, turn, role, parts), in the order of ``turn``.

    ``formatted`` is the whole conversation; ``loss_spans`` are the code points of it (end exclusive)
    that count for the loss, one span per turn of ``loss_role``; ``attachments`` lists (turn, place, kind, ref,
    tokens) in order, ``attached_tokens`` their sum. Roles are escaped too.

    Null roles, parts and texts are empty. A part of any other kind counts as text.
    Turns with equal numbers come by role and content, null numbers first; repeated turns stay. Null ids are one conversation. Further columns
    are left out. An empty table gives an empty table.
    """
    seen, = free_names(turns, "visited_parts")
    one = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), _visited(F.col("parts")).alias(seen)
    )
    shown = F.array_join(F.transform(F.col(seen), lambda p: p["shown"]), "")
    body = one.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
            shown.alias("body"),
            (F.col("role") == loss_role).alias("loss"),
            F.filter(
                F.transform(
                    F.col(seen),
                    lambda p, n: F.struct(
                        n.cast("int").alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")
                    ),
                ),
                lambda p: F.coalesce(p["kind"].isin(*ATTACHED), F.lit(False)),
            ).alias("attached"),
        ).alias("t"),
    )
    grouped = body.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"))

    def walk(state: Column, t: Column) -> Column:
        begin = state["at"] + F.char_length(t["head"])
        end = begin + F.char_length(t["body"])
        span = F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct(
            (end + len(END)).cast("long").alias("at"),
            F.when(t["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    attachments = F.flatten(
        F.transform(
            "t",
            lambda t: F.transform(
                t["attached"],
                lambda a: F.struct(
                    t["turn"].alias("turn"), a["place"].alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")
                ),
            ),
        )
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("t", empty, walk)["spans"].alias("loss_spans"),
        attachments.alias("attachments"),
    ).withColumn(
        "attached_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    )


def read_turns(formatted: Column) -> Column:
    """(role, text) of every turn of a formatted conversation; placeholders stay in the text."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda x: x != "")

    def read(piece: Column) -> Column:
        halves = F.split(F.substring_index(piece, TURN, -1), r"<\|text\|>", 2)
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(pieces, read)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order."""
    return F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
