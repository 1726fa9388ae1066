"""Chat formatting with typed content parts, a loss mask and attachments; DataFrame functions only.

A conversation becomes one text: for each turn ``<|im_start|>role``, a line feed, the content,
``<|im_end|>`` and a line feed. Content is a list of typed parts; text parts are escaped, image, audio
and document parts become the placeholders ``<|image|>``, ``<|audio|>`` and ``<|document|>``, in order,
with a reference to the attachment and the number of tokens that it expands to.

Control strings inside texts start with ``<|``: each ``<|``, ``<%|``, ``<%%|`` and so on gets one more
``%``, so that no text holds ``<|`` and taking one away gives the text back. In roles ``%``, line feeds
and ``<|`` are percent-encoded, as a role ends with its line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens: one for a tile of an image's pixels, so many a second of audio and a page of a document.
TILE, A_SECOND, A_PAGE = 28, 25, 256
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(%*)\|", "<$1%|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(%*)%\|", "<$1|")


def role_escaped(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<|"), F.lit("<%7C"))


def role_unescaped(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%7C"), F.lit("|")), F.lit("%25"), F.lit("%"))


def _kind(part: Column) -> Column:
    """text, image or audio; anything else that is named is a document."""
    kind = F.lower(F.coalesce(part["type"], F.lit("text")))
    return F.when(kind.isin("text", "image", "audio"), kind).otherwise("document")


def _shown(part: Column) -> Column:
    kind = _kind(part)
    return F.when(kind == "text", escaped(F.coalesce(part["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), kind, F.lit("|>")))


def _tokens(part: Column) -> Column:
    kind = _kind(part)
    tiles = F.ceil(part["width"] / TILE) * F.ceil(part["height"] / TILE)
    count = F.when(kind == "image", tiles).when(kind == "audio", F.ceil(part["seconds"] * A_SECOND)).otherwise(part["pages"].cast("long") * A_PAGE)
    return F.coalesce(count.cast("long"), F.lit(1).cast("long"))


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"))).cast("array<struct<type:string,text:string>>")


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None, trained: str = TRAINED
) -> DataFrame:
    """``<conv>, formatted, mask, attachments, expanded_tokens`` of every conversation.

    ``parts`` names a column ``array<PART>`` to use in place of ``text``. ``mask`` has an entry for each
    turn: where the turn starts in ``formatted``, and where the content that is trained on starts and how
    long it is (0 for roles other than ``trained``), in code points. ``attachments`` are in the order of
    their placeholders; ``expanded_tokens`` adds up their tokens. Turns are in order of ``turn``, null
    first, then role and content (as it was before escaping). Null texts and roles are empty; rows without conversation key form one
    conversation. Other columns are ignored.
    """
    content = F.col(parts).cast(f"array<{PART}>") if parts else F.array(F.struct(F.lit("text").alias("type"), F.col(text).cast("string").alias("text")))
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(content, F.array().cast(f"array<{PART}>") if parts else content).alias("parts"),
    )
    shown = F.array_join(F.transform("parts", _shown), "")
    named = F.col("role").alias("role")
    rows = rows.withColumn("content", shown)
    if parts:
        media = F.filter(F.transform("parts", lambda x, i: F.struct(i.alias("part"), _kind(x).alias("type"), x["uri"].alias("uri"), _tokens(x).alias("tokens"))), lambda x: x["type"] != "text")
    else:
        media = F.array().cast("array<struct<part:int,type:string,uri:string,tokens:bigint>>")
    head = F.concat(F.lit(START), role_escaped(F.col("role")), F.lit("\n"))
    # Content is needed for the order alone from here on, and that is the order of texts before escaping.
    rows = rows.select("conv", "turn", named, unescaped(F.col("content")).alias("content"), F.length("content").alias("length"), media.alias("media"), F.length(head).alias("before"), F.concat(head, "content", F.lit(END + "\n")).alias("piece"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "content", "piece")
    at = F.coalesce(F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    rows = rows.withColumn("at", at).withColumn("number", F.row_number().over(order))
    entry = F.struct(
        F.col("at").alias("turn_start"), (F.col("at") + F.col("before")).alias("start"),
        F.when(F.col("role") == trained, F.col("length")).otherwise(0).cast("long").alias("length"),
    )
    grouped = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("number", "piece", entry.alias("entry"), "media"))).alias("turns"))
    attached = F.flatten(F.transform("turns", lambda t: F.transform(t["media"], lambda m: F.struct(t["number"].alias("turn"), m["part"].alias("part"), m["type"].alias("type"), m["uri"].alias("uri"), m["tokens"].alias("tokens")))))
    return grouped.select(
        F.col("conv").alias(conv), F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), F.transform("turns", lambda t: t["entry"]).alias("mask"), attached.alias("attachments")
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))


def read_chats(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``<conv>, turns, trained, formatted_chars``: roles and contents of the turns, and the contents under the mask.

    Texts are unescaped; placeholders stay as they are. Linear in the text: a mask's entry is cut from
    its own turn.
    """
    pieces = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda _, i: i > 0)
    role = lambda x: F.substring_index(x, "\n", 1)
    content = lambda x: F.substr(x, F.length(role(x)) + 2, F.length(x) - F.length(role(x)) - 1 - len(END) - 1)
    turns = F.transform("pieces", lambda x: F.struct(role_unescaped(role(x)).alias("role"), unescaped(content(x)).alias("text")))
    cut = lambda x: F.substr(x["piece"], (x["m"]["start"] - x["m"]["turn_start"] - len(START) + 1).cast("int"), x["m"]["length"].cast("int"))
    both = F.arrays_zip(F.col("pieces").alias("piece"), F.col("mask").alias("m"))
    masked = F.transform(F.filter(both, lambda x: x["m"]["length"] > 0), lambda x: unescaped(cut(x)))
    return formatted.withColumn("pieces", pieces).select(conv, turns.alias("turns"), masked.alias("trained"), F.length("formatted").cast("long").alias("formatted_chars"))


def digests(read: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``<conv>, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of what ``read_chats`` gives."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("trained", "")
    return read.select(
        conv, F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
