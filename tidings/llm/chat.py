"""Conversations as marked-up text: typed content parts, loss mask, attachments, reading back.

A turn is ``<turn ROLE>`` + content + ``</turn>`` + line feed. In roles and texts a backslash is
written ``\\b``, ``<`` as ``\\l`` and ``>`` as ``\\g``, so no text can hold a mark of the template and
two plain replacements undo it. An attachment is written ``<KIND NUMBER>`` at its place.

A conversation is formatted in chunks of a fixed range of turns, so that one of any length is
spread over tasks; its formatted text is its chunks in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Turns of one chunk.
CHUNK_TURNS = 64
# Tokens an attachment expands to: per started patch of an image, second of sound, page.
PATCH, PATCH_TOKENS = 28, 1
AUDIO_TOKENS = 25
PAGE_TOKENS = 512

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
LOSS_ROLE = "assistant"
_KINDS = ("image", "audio", "document")


def escape(text: Column) -> Column:
    """A text without ``<`` and ``>``; ``unescape`` gives it back."""
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A plain text as an array of one text part."""
    null = [F.lit(None).cast(k).alias(n) for n, k in (
        ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *null))


def expanded_tokens(part: Column) -> Column:
    """Tokens an attachment will take in the model's input; a missing size counts as one unit."""
    def units(c, size):
        return F.greatest(F.ceil(F.coalesce(c, F.lit(size)) / size), F.lit(1))
    image = units(part["width"], PATCH) * units(part["height"], PATCH) * PATCH_TOKENS
    audio = F.greatest(F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * AUDIO_TOKENS), F.lit(1))
    return (
        F.when(part["kind"] == "image", image)
        .when(part["kind"] == "audio", audio)
        .otherwise(F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * PAGE_TOKENS)
    ).cast("bigint")


def _is_text(part: Column) -> Column:
    return ~F.coalesce(part["kind"].isin(*_KINDS), F.lit(False))


def visit(parts: Column) -> tuple[Column, Column]:
    """Content of a turn and its attachments ``array<number, kind, ref, tokens>``, in order.

    Attachments are numbered from 1 inside the turn. Parts of unknown or no kind count as text; a
    null text is empty; a null array has no parts.
    """
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    attached = F.filter(parts, lambda p: ~_is_text(p))
    numbered = F.transform(attached, lambda p, i: F.struct(
        (i + 1).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"),
        expanded_tokens(p).alias("tokens")))

    def shown(part: Column, i: Column) -> Column:
        number = F.size(F.filter(F.slice(parts, 1, i + 1), lambda q: ~_is_text(q)))
        mark = F.concat(F.lit("<"), part["kind"], F.lit(" "), number.cast("string"), F.lit(">"))
        return F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)
    # A turn of a single text, the usual case, needs no walk.
    only = (F.size(parts) == 1) & _is_text(parts[0])
    content = F.when(only, escape(F.coalesce(parts[0]["text"], F.lit("")))).otherwise(
        F.array_join(F.transform(parts, shown), ""))
    return content, numbered


def format_chats(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row a chunk of a conversation, from ``conv_id, turn, role, parts``.

    Columns: ``conv_id, chunk, n_turns, formatted, loss_spans`` (start and length in code points of
    the chunk's text: the content of turns of ``loss_role``) and ``attachments`` (turn number in
    the chunk, number, kind, ref, tokens). Turns are in the order of ``turn``, then role, then
    content; a null turn comes first, null roles are empty, repeated rows are turns of their own,
    null conversations are one conversation. An empty table gives no rows; other columns are not
    read. Turns are gathered per chunk, so a huge conversation does not meet in one task; only
    rows that repeat the same few turn numbers without bound would.
    """
    content, attached = visit(F.col("parts"))
    role = F.coalesce("role", F.lit(""))
    head = F.concat(F.lit("<turn "), escape(role), F.lit(">"))
    rows = turns.select(
        "conv_id", "turn", F.floor(F.col("turn") / CHUNK_TURNS).alias("chunk"), role.alias("role"),
        head.alias("head"), content.alias("content"), attached.alias("attached"))
    end = "</turn>\n"
    one = F.struct("turn", "role", "content", "head", "attached",
                   F.char_length("head").alias("n_head"), F.char_length("content").alias("n_content"))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(one)).alias("t"))
    # Running length before each turn: content starts behind the marks of all turns so far.
    begins = F.aggregate(
        "t", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda s, x: F.struct(
            (s["at"] + x["n_head"] + x["n_content"] + len(end)).alias("at"),
            F.concat(s["starts"], F.array(s["at"] + x["n_head"])).alias("starts")),
        lambda s: s["starts"])
    spans = F.transform(
        F.filter(F.arrays_zip(F.col("t").alias("x"), begins.alias("start")), lambda z: z["x"]["role"] == loss_role),
        lambda z: F.struct(z["start"].alias("start"), z["x"]["n_content"].alias("length")))
    formatted = F.array_join(F.transform(
        "t", lambda x: F.concat(x["head"], x["content"], F.lit(end))), "")
    attachments = F.flatten(F.transform("t", lambda x, i: F.transform(x["attached"], lambda a: F.struct(
        i.alias("turn"), a["number"].alias("number"), a["kind"].alias("kind"), a["ref"].alias("ref"),
        a["tokens"].alias("tokens")))))
    return chunks.select(
        "conv_id", "chunk", F.size("t").alias("n_turns"), formatted.alias("formatted"),
        spans.alias("loss_spans"), attachments.alias("attachments"))


def read_turns(formatted: Column) -> Column:
    """``array<role, text>`` read back from a chunk's text, attachments left as their marks."""
    turns = F.filter(F.split(formatted, "</turn>\n"), lambda x: x != "")
    return F.transform(turns, lambda x: F.struct(
        unescape(F.substring_index(F.substring(x, 7, 1 << 30), ">", 1)).alias("role"),
        unescape(F.substr(x, F.instr(x, ">") + 1)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, cut out by position, unescaped."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"])))


def read_chats(chunks: DataFrame) -> DataFrame:
    """Digests of conversations from their formatted chunks alone.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. A digest is over
    the whole conversation, so its chunks, not its turns, meet in the row that holds it. Rows without
    ``conv_id`` are one conversation; without chunks there are no rows.
    """
    back = chunks.select(
        "conv_id", "chunk", read_turns(F.col("formatted")).alias("turns"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
        F.char_length("formatted").alias("chars"))
    flat = back.select("conv_id", F.struct(
        "chunk", F.size("turns").alias("n"), "loss", "chars",
        F.array_join(F.transform("turns", lambda x: F.concat(
            x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("said")).alias("c"))
    whole = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list("c")).alias("c"))

    def total(name: str) -> Column:
        return F.aggregate("c", F.lit(0).cast("bigint"), lambda a, x: a + x[name])
    loss = F.array_join("c.loss", "")
    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(F.array_join("c.said", ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"))
