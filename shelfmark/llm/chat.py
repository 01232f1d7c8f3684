"""Conversations of typed content parts as one text with marked turns, in column expressions alone.

Every control string starts with ``<|``. Inside a text each ``<``, run of
backslashes, ``|`` gets one more backslash, so no text can hold a control
string, and taking that backslash out again gives the text back.

A part is text, or an attachment: image, audio or document. The visitor turns
a message's parts into text with one placeholder for each attachment, in order,
and records what it refers to and how many tokens it will take. Neighbouring
text parts are one text before it is escaped, so that no control string comes
about where two of them meet; a placeholder starts with ``<|`` as it stands, so
no text reads back as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: Tokens an attachment takes: one for each patch of an image, and by length of audio and documents.
IMAGE_PATCH = 14
AUDIO_TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 800


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<(\\*)\|"), F.lit(r"<$1\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<(\\*)\\\|"), F.lit("<$1|"))


def text_part(text: Column) -> Column:
    """A message of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast(
        "array<struct<type:string,text:string>>")


def _kind(part: Column) -> Column:
    """image, audio and document are attachments; a part without type, or of another one, is text."""
    return F.when(part["type"].isin("image", "audio", "document"), part["type"]).otherwise(F.lit("text"))


def _tokens(part: Column) -> Column:
    """Expanded tokens of an attachment: at least one, also where its measures are null."""
    image = F.ceil(part["width"] / IMAGE_PATCH) * F.ceil(part["height"] / IMAGE_PATCH)
    n = (F.when(part["type"] == "image", image).when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_TOKENS_PER_SECOND))
         .otherwise(part["pages"] * TOKENS_PER_PAGE))
    return F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("long")


def visit(parts: Column) -> tuple[Column, Column]:
    """(escaped text with placeholders, attachments): a null list or part is nothing, a null text is empty."""
    there = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p.isNotNull())
    state = "struct<done:string,text:string>"

    def step(s: Column, p: Column) -> Column:
        placeholder = F.concat(F.lit("<|"), _kind(p), F.lit("|>"))
        return F.when(_kind(p) == "text", F.struct(s["done"].alias("done"), F.concat(s["text"], F.coalesce(p["text"], F.lit(""))).alias("text"))).otherwise(
            F.struct(F.concat(s["done"], escape(s["text"]), placeholder).alias("done"), F.lit("").alias("text"))).cast(state)

    start = F.struct(F.lit("").alias("done"), F.lit("").alias("text")).cast(state)
    body = F.aggregate(there, start, step, lambda s: F.concat(s["done"], escape(s["text"])))
    attachments = F.transform(F.filter(there, lambda p: _kind(p) != "text"), lambda p: F.struct(
        _kind(p).alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))
    return body, attachments


PLACEHOLDER = r"<\|(image|audio|document)\|>"


def read_parts(body: Column) -> Column:
    """The parts (type, text) of a formatted message: texts, joined where they were neighbours, and attachments without text."""
    texts, kinds = F.split(body, PLACEHOLDER, -1), F.regexp_extract_all(body, F.lit(PLACEHOLDER), F.lit(1))
    pairs = F.transform(F.arrays_zip(texts.alias("text"), kinds.alias("kind")), lambda x: F.array(
        F.struct(F.lit("text").alias("type"), unescape(x["text"]).alias("text")),
        F.struct(x["kind"].alias("type"), F.lit(None).cast("string").alias("text"))))
    return F.filter(F.flatten(pairs), lambda p: F.when(p["type"] == "text", p["text"] != "").otherwise(p["type"].isNotNull()))


def format_conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         parts_col: str = "parts", learn: str = "assistant") -> DataFrame:
    """One row for each conversation: its formatted text, and what is needed to read and train on it.

    ``parts`` has the type ``PARTS`` or a text alone (see ``text_part``).
    Returns ``conv_col``, formatted, loss_mask (for each turn, whether it is
    learnt), loss_spans (start and length in UTF-8 bytes of the learnt turns'
    texts), attachments (of the placeholders, in order) and expanded_tokens.

    Turns stand by number, null first, equal numbers by role and text; repeated
    rows are turns of their own. Null roles and texts are empty. Rows of a null
    conversation are one. An empty table gives no rows. A conversation is one
    text, so its rows meet in one task, however many they are.
    """
    parts = F.col(parts_col)
    if "ref" not in messages.schema[parts_col].dataType.elementType.names:
        parts = F.transform(parts, lambda p: F.struct(p["type"], p["text"], *[
            F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))
    body, attachments = visit(parts)
    role = escape(F.coalesce(F.col(role_col), F.lit("")))
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), body.alias("body"),
                           attachments.alias("attachments"), F.coalesce(F.col(role_col) == learn, F.lit(False)).alias("learnt"))
    head = F.concat(F.lit(TURN), F.col("role"), F.lit(TEXT))
    rows = rows.withColumn("piece", F.concat(head, F.col("body"), F.lit(END)))
    order = Window.partitionBy("conv").orderBy("turn", "role", "body")
    rows = (rows.withColumn("n", F.row_number().over(order))
            .withColumn("before", F.coalesce(F.sum(F.octet_length("piece").cast("long")).over(
                order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("span", F.struct((F.col("before") + F.octet_length(head)).alias("start"),
                                         F.octet_length("body").cast("long").alias("length"))))
    turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("n", "piece", "learnt", "span", "attachments"))).alias("turns"))
    t = F.col("turns")
    whole = turns.select(
        F.col("conv").alias(conv_col), F.array_join(t["piece"], "").alias("formatted"), t["learnt"].alias("loss_mask"),
        F.transform(F.filter(t, lambda x: x["learnt"]), lambda x: x["span"]).alias("loss_spans"),
        F.flatten(t["attachments"]).alias("attachments"))
    return whole.withColumn("expanded_tokens", F.aggregate(
        "attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text, parts) of a formatted conversation; ``text`` is that of the text parts alone."""
    pieces = F.split(formatted, r"<\|turn\|>", -1)

    def turn(p: Column) -> Column:
        body = F.substring_index(F.substring_index(p, TEXT, -1), END, 1)
        parts = read_parts(body)
        text = F.when(body.rlike(PLACEHOLDER), F.array_join(F.filter(parts["text"], lambda x: x.isNotNull()), "")).otherwise(unescape(body))
        return F.struct(unescape(F.substring_index(p, TEXT, 1)).alias("role"), text.alias("text"), parts.alias("parts"))
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def read_back(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Digests of formatted conversations, from their formatted text and loss mask alone."""
    learnt = F.transform(F.filter(F.arrays_zip("turns", "loss_mask"), lambda x: x["loss_mask"]), lambda x: x["turns"]["text"])
    read = (conversations.withColumn("turns", read_turns(F.col("formatted")))
            .withColumn("loss", F.array_join(learnt, "")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"),
                       F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens")
