"""Chat formatting with typed content parts, in DataFrame functions only.

A visitor walks the parts of every turn in order. A text part becomes its escaped text; an image, audio or document
part becomes a placeholder, its reference is recorded with the place of the placeholder, and its tokens are counted
as the placeholder will expand. Turns are marked by a template whose control strings all start with ``<``; inside
texts ``<`` and the escape character are replaced, so no text can be taken for control, and reading back is exact.

Edge cases: a null text is empty, a null role is the empty role, a null turn comes first; rows with the same turn are
ordered by role, then text. Rows with a null conversation id form one conversation. A part of an unknown or null
kind is a text part. Repeated rows are turns of their own. An empty table gives an empty result. One conversation is
one value, as everywhere in this format; only its own turns are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TURN = "<turn "
BODY = ">"
END = "<end>\n"
TRAINED_ROLE = "assistant"
# Tokens a placeholder expands to, per unit of the part: a picture tile, a second of sound, a page.
PART_TOKENS = {"image": 256, "audio": 25, "document": 512}
PART_TYPE = "struct<kind:string,text:string,ref:string,units:int>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(
        F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"))
    ).cast(f"array<{PART_TYPE}>")


def _is_media(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*PART_TOKENS), F.lit(False))


def _tokens(part: Column) -> Column:
    each = F.lit(0)
    for kind, tokens in PART_TOKENS.items():
        each = F.when(part["kind"] == kind, F.lit(tokens)).otherwise(each)
    return each * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))


def _visit(part: Column) -> Column:
    """What a part leaves in the text: a placeholder with kind and expanded tokens, or the escaped text."""
    placeholder = F.concat(F.lit("<part "), part["kind"], F.lit(" "), _tokens(part).cast("string"), F.lit("/>"))
    return F.when(_is_media(part), placeholder).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def flatten_parts(parts: Column) -> Column:
    """The flat text of a turn."""
    return F.array_join(F.transform(F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>")), _visit), "")


def attachments(parts: Column) -> Column:
    """Kind, reference, expanded tokens and place among the turn's placeholders, in order."""
    media = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>")), _is_media)
    return F.transform(
        media,
        lambda p, i: F.struct(
            i.alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).cast("long").alias("tokens")
        ),
    )


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    trained_role: str = TRAINED_ROLE,
) -> DataFrame:
    """One row per conversation: id, formatted, loss_spans (start, length in characters of ``formatted``), attachments,
    media_tokens."""
    body = flatten_parts(F.col(parts_col))
    role = F.coalesce(F.col(role_col), F.lit(""))
    head = F.concat(F.lit(TURN), F.replace(escape(role), F.lit(BODY), F.lit("\\g")), F.lit(BODY))
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), body.alias("body"), head.alias("head"),
        attachments(F.col(parts_col)).alias("media"),
    ).withColumn("segment", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("place", F.row_number().over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "start", F.sum(F.char_length("segment").cast("long")).over(order) - F.char_length("segment") + F.char_length("head")
    )
    loss = F.when(
        F.col("role") == trained_role,
        F.struct(F.col("start"), F.char_length("body").cast("long").alias("length")),
    )
    gathered = placed.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("place", "segment", loss.alias("loss"), "media"))).alias("turns")
    )
    media = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["media"],
                lambda m: F.struct(t["place"].alias("turn"), m["place"].alias("place"), m["kind"].alias("kind"), m["ref"].alias("ref"), m["tokens"].alias("tokens")),
            ),
        )
    )
    return gathered.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss_spans"),
        media.alias("attachments"),
        F.aggregate(media, F.lit(0).cast("long"), lambda total, m: total + m["tokens"]).alias("media_tokens"),
    )


def read_chats(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The turns in formatted conversations: id, place, role, text (placeholders as they stand), in_loss.

    A turn counts as trained where a span of the loss mask starts and ends with its body.
    """
    cut = F.split("formatted", END)
    pieces = formatted.select(
        F.col(conv_col).alias("conv"), F.posexplode(F.slice(cut, F.lit(1), F.size(cut) - 1)).alias("place", "piece")
    )
    head_end = F.locate(BODY, F.col("piece"))
    order = Window.partitionBy("conv").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.char_length("piece").cast("long")
    turns = pieces.select(
        "conv",
        "place",
        unescape(F.replace(F.substr("piece", F.lit(len(TURN) + 1), head_end - len(TURN) - 1), F.lit("\\g"), F.lit(BODY))).alias("role"),
        F.substr("piece", head_end + 1).alias("body"),
        (F.sum(length + len(END)).over(order) - length - len(END) + head_end).alias("start"),
    ).withColumn("length", F.char_length("body").cast("long"))
    spans = formatted.select(F.col(conv_col).alias("span_conv"), F.explode("loss_spans").alias("s")).select(
        "span_conv", F.col("s.start").alias("span_start"), F.col("s.length").alias("span_length")
    )
    return turns.join(
        spans,
        turns["conv"].eqNullSafe(spans["span_conv"]) & (turns["start"] == spans["span_start"]) & (turns["length"] == spans["span_length"]),
        "left",
    ).select(
        F.col("conv").alias(conv_col),
        "place",
        "role",
        unescape(F.col("body")).alias("text"),
        F.col("span_start").isNotNull().alias("in_loss"),
    )
