"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is a list of parts: text, image, audio or document. A visitor turns each part into
text: a text part into its escaped text, every other part into one placeholder such as ``<|image|>``;
``<|part|>`` stands between two parts. The k-th placeholder of a conversation belongs to the k-th entry
of its attachment list, which records the reference and the tokens the placeholder will expand to.

Template of a turn: ``<|im_start|>role\\ncontent<|im_end|>\\n``. Escaping adds one backslash between
``<`` and any backslashes before a ``|``, so no text holds ``<|`` afterwards; unescaping takes it away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, BETWEEN = "<|im_start|>", "<|im_end|>", "<|part|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role holds no line break afterwards: backslash and line break are written as two characters."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    plain = F.transform(F.split(unescape(role), r"\\\\"), lambda s: F.replace(s, F.lit("\\n"), F.lit("\n")))
    return F.array_join(plain, "\\")


def text_part(text: Column) -> Column:
    """A list of one text part."""
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part)


def kind(part: Column) -> Column:
    """Type of a part; one that is missing or unknown is text if it has text, else a document."""
    known = part["type"].isin("text", "image", "audio", "document")
    guess = F.when(part["text"].isNotNull(), F.lit("text")).otherwise(F.lit("document"))
    return F.coalesce(F.when(known, part["type"]), guess)


def expanded_tokens(part: Column, patch: int, per_second: float, per_page: int) -> Column:
    """Tokens an attachment stands for: image patches, seconds of audio or pages; at least 1."""
    over = lambda size: F.ceil(F.coalesce(size, F.lit(1)) / F.lit(patch))
    image = over(part["width"]) * over(part["height"])
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(per_second))
    pages = F.coalesce(part["pages"], F.lit(1)) * F.lit(per_page)
    made = F.when(kind(part) == "image", image).when(kind(part) == "audio", audio).otherwise(pages)
    return F.greatest(made.cast("long"), F.lit(1).cast("long"))


def visit(part: Column) -> Column:
    """The text that stands for a part."""
    held = F.concat(F.lit("<|"), kind(part), F.lit("|>"))
    return F.when(kind(part) == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(held)


def format_chat(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    patch: int = 14,
    per_second: float = 25.0,
    per_page: int = 256,
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``attachments``, ``loss_spans``, ``expanded``.

    ``attachments``: ordinal, type, ref, turn (0-based), and expanded token count of each placeholder.
    ``loss_spans``: start (0-based) and length in code points of every assistant content in ``formatted``.
    ``expanded``: sum of the expanded tokens.

    Turns are ordered by turn, then role and content, so ties give one result; a null turn comes first, a
    null role is empty text, null parts are an empty list, a null conversation id is a conversation of
    its own. Extra columns are left out. Equal rows are turns of their own. An empty table gives no row.
    """
    one = F.struct(
        F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{parts}`"), F.array().cast(f"array<{PART}>")).alias("parts"),
    )
    grouped = turns.groupBy(F.col(f"`{conv}`").alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    rendered = F.transform(
        "turns",
        lambda t: F.struct(
            t["role"].alias("role"),
            F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
            F.array_join(F.transform(t["parts"], visit), BETWEEN).alias("body"),
        ),
    )
    shown = grouped.withColumn("shown", rendered)
    tail = F.lit(END + "\n")
    formatted = F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"], tail)), "")
    held = F.flatten(
        F.transform(
            "turns",
            lambda t, i: F.transform(
                F.filter(t["parts"], lambda p: kind(p) != "text"),
                lambda p: F.struct(
                    kind(p).alias("type"), p["ref"].alias("ref"), i.alias("turn"),
                    expanded_tokens(p, patch, per_second, per_page).alias("tokens"),
                ),
            ),
        )
    )
    numbered = F.transform(
        held,
        lambda a, i: F.struct(i.alias("ordinal"), a["type"].alias("type"), a["ref"].alias("ref"), a["turn"].alias("turn"), a["tokens"].alias("tokens")),
    )
    none = F.array().cast("array<struct<start:int,length:int>>")
    walked = F.aggregate(
        "shown",
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + F.lit(len(END) + 1)).alias("at"),
            F.when(
                t["role"] == "assistant",
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length")))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    out = shown.select(conv, formatted.alias("formatted"), numbered.alias("attachments"), walked.alias("loss_spans"))
    expanded = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return out.withColumn("expanded", expanded)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: role and the unescaped content parts (placeholders as they are)."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    whole = F.slice(pieces, 1, F.size(pieces) - 1)

    def one(piece: Column) -> Column:
        rest = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        cut = F.instr(rest, F.lit("\n"))
        body = F.substring(rest, cut + 1, F.length(rest))
        return F.struct(
            unescape_role(F.substring(rest, F.lit(1), cut - 1)).alias("role"),
            F.transform(F.split(body, r"<\|part\|>"), unescape).alias("parts"),
        )

    return F.transform(whole, one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    cut = F.transform(spans, lambda s: unescape(F.replace(F.substring(formatted, s["start"] + 1, s["length"]), F.lit(BETWEEN), F.lit(""))))
    return F.array_join(cut, "")
