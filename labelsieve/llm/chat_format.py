"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; runs of turns of the
same role become one block (array functions: the places where the role changes cut the
array); blocks are concatenated to one training text::

    ### user: first text</turn>second text of the same role</turn>
    ### assistant: answer</turn>

``###``, ``</turn>`` and the escape character ``\\`` are control strings.  In texts and
roles they are written ``\\h``, ``\\t`` and ``\\\\``; a role's ``:`` is ``\\c``.  An escaped text thus
holds no control string, whatever it says, and the text can be read back: blocks, turns,
roles and texts.  ``loss_spans`` says which part of the text is learnt: the assistant's
texts, without any mark around them, each as start and length in code points and in
UTF-8 bytes, both from 0.

Positions are running sums of piece lengths taken in chunks of ``CHUNK`` pieces, so the work
grows with the number of turns, not with its square.  A conversation is one value
(its text), hence one row: it must fit Spark's 2 GB a row.

Defined results: a null text or role is empty; turns come in the order of turn (nulls first),
then role, then text; rows without a conv_id are one conversation; rows that repeat are
turns of their own; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, HEAD_END, TURN_END = "### ", ": ", "</turn>"
BLOCK_END = "\n"
# Control string and its letter behind the escape character.
ESCAPE = "\\"
CODES = {"###": "h", TURN_END: "t"}
ROLE_CODES = {**CODES, ":": "c"}
LEARNT = "assistant"
# Pieces whose positions one running sum carries.
CHUNK = 512


def escaped(text: Column, codes: dict[str, str] = CODES) -> Column:
    """``text`` without control strings."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(2 * ESCAPE))
    return reduce(lambda t, c: F.replace(t, F.lit(c[0]), F.lit(ESCAPE + c[1])), codes.items(), doubled)


def unescaped(text: Column, codes: dict[str, str] = ROLE_CODES) -> Column:
    """The text that ``escaped`` was given."""
    def plain(part: Column) -> Column:
        return reduce(lambda t, c: F.replace(t, F.lit(ESCAPE + c[1]), F.lit(c[0])), codes.items(), part)
    # Read from the left, two escape characters are always one character of the text.
    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), ESCAPE)


def running_sums(sizes: Column) -> Column:
    """The sum of the elements before each element of an array of longs."""
    def scan(part: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(part, begin, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    none = F.array().cast("array<array<bigint>>")
    parts = F.when(F.size(sizes) == 0, none).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int")),
                    lambda c: F.slice(sizes, c * CHUNK + 1, F.lit(CHUNK))))
    starts = scan(F.transform(parts, total), F.lit(0).cast("bigint"))
    return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), starts.alias("start")),
                                 lambda p: scan(p["part"], p["start"])))


def blocks_of(turns: Column) -> Column:
    """Turn structs in order -> blocks ``(role, texts)`` of adjacent turns of one role."""
    cuts = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (
        F.element_at(turns, i)["role"] != F.element_at(turns, F.greatest(i - 1, F.lit(1)))["role"]))
    nexts = F.concat(F.slice(cuts, F.lit(2), F.size(cuts)), F.array(F.size(turns) + 1))
    return F.transform(F.arrays_zip(cuts.alias("at"), nexts.alias("next")), lambda c: F.struct(
        F.element_at(turns, c["at"])["role"].alias("role"),
        F.transform(F.slice(turns, c["at"], c["next"] - c["at"]), lambda t: t["text"]).alias("texts")))


def format_chats(conversations: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans)``, a row per conversation."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    chats = chats.select("conv_id", blocks_of(F.col("turns")).alias("blocks"))
    # A piece per turn: what stands before its text, the escaped text, what stands behind it.
    pieces = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t, i: F.struct(
        F.when(i == 0, F.concat(F.lit(HEAD), escaped(b["role"], ROLE_CODES), F.lit(HEAD_END))).otherwise("").alias("before"),
        escaped(t).alias("body"),
        F.when(i == F.size(b["texts"]) - 1, TURN_END + BLOCK_END).otherwise(TURN_END).alias("behind"),
        (b["role"] == LEARNT).alias("learnt")))))
    chats = chats.select("conv_id", pieces.alias("pieces"))

    def sizes(measure) -> Column:
        return F.transform("pieces", lambda p: sum((measure(p[x]) for x in ("before", "body", "behind")), F.lit(0))
                           .cast("bigint"))
    # Sizes are columns of their own, so that no lambda makes them again.
    chats = chats.select("conv_id", "pieces", sizes(F.length).alias("chars"), sizes(F.octet_length).alias("bytes"))
    chats = chats.select("conv_id", "pieces", running_sums(F.col("chars")).alias("chars"),
                         running_sums(F.col("bytes")).alias("bytes"))
    learnt = F.filter(F.arrays_zip("pieces", "chars", "bytes"), lambda z: z["pieces"]["learnt"])
    spans = F.transform(learnt, lambda z: F.struct(
        (z["chars"] + F.length(z["pieces"]["before"])).alias("start"),
        F.length(z["pieces"]["body"]).cast("bigint").alias("length"),
        (z["bytes"] + F.octet_length(z["pieces"]["before"])).alias("start_byte"),
        F.octet_length(z["pieces"]["body"]).cast("bigint").alias("length_bytes")))
    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["body"], p["behind"])), "")
    return chats.select("conv_id", whole.alias("formatted"), spans.alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """``(conv_id, formatted, turns array<struct<role, text>>, learnt array<string>)`` from the formatted texts alone."""
    def turns(block: Column) -> Column:
        role = F.substring_index(block, HEAD_END, 1)
        body = F.substr(block, F.length(role) + len(HEAD_END) + 1)
        texts = F.split(body, TURN_END)  # the last element is the end of the block
        return F.transform(F.slice(texts, F.lit(1), F.size(texts) - 1),
                           lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text")))
    blocks = F.split(F.col("formatted"), HEAD)  # the first element stands before the first block
    blocks = F.slice(blocks, F.lit(2), F.size(blocks))
    chats = chats.select("*", F.col("formatted").cast("binary").alias("raw"))
    learnt = F.transform("loss_spans", lambda s: unescaped(  # bytes are found without reading what stands before
        F.substr(F.col("raw"), (s["start_byte"] + 1).cast("int"), s["length_bytes"].cast("int")).cast("string")))
    return chats.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"), learnt.alias("learnt"))


def digest_columns(chats: DataFrame) -> DataFrame:
    """The digests of ``read_back``: turns, text under the loss mask and length."""
    def sha(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)
    back = read_back(chats).select("conv_id", "formatted", "turns", F.array_join("learnt", "").alias("learnt"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha(said).alias("turns_sha256"),
                       F.length("learnt").cast("long").alias("loss_chars"), sha(F.col("learnt")).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
