"""Chat formatting with a reversible template, checked by parsing its output again.

A turn is rendered as ``### role``, the text and ``</turn>``, each on lines of
their own.  Every turn is first rendered as it is and parsed; where that does
not give back the role and text, control strings in it are escaped, and the
result must parse to the source.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>"
# A backslash is put before each control string, and one is taken off again.
# A run of backslashes is looked at once, from its start, and not given back.
ESCAPE = rf"((?<!\\)\\*+{END})"
UNESCAPE = rf"(?<!\\)\\(\\*+{END})"
BLOCK_END = rf"(?<!\\){END}\n"
TRAINED_ROLE = "assistant"


# In a role, each control character has a two-character form that starts with a backslash.
ROLE_FORMS = (("\\", "\\s"), ("\n", "\\n"), ("<", "\\l"))


def escaped_role(role: Column) -> Column:
    for plain, form in ROLE_FORMS:
        role = F.replace(role, F.lit(plain), F.lit(form))
    return role


def plain_role(role: Column) -> Column:
    for plain, form in reversed(ROLE_FORMS):
        role = F.replace(role, F.lit(form), F.lit(plain))
    return role


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit("\n"), text, F.lit(f"\n{END}\n"))


def blocks_of(formatted: Column) -> Column:
    """Blocks of a rendered conversation, without their end mark."""
    pieces = F.split(formatted, BLOCK_END, -1)
    return F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))


def parsed(block: Column) -> Column:
    """Role, text and raw text length of a block; the grammar is deterministic."""
    line = F.instr(block, "\n")
    raw = F.substring(block, line + 1, F.length(block) - line - 1)
    return F.struct(
        plain_role(F.substring(block, F.lit(len(HEAD) + 1), line - 1 - len(HEAD))).alias("role"),
        F.regexp_replace(raw, UNESCAPE, "$1").alias("text"),
        line.alias("skip"), F.length(raw).alias("take"),
    )


def gives_back(block: Column, role: Column, text: Column) -> Column:
    """Whether a rendered turn parses to exactly one turn with this role and text."""
    found = F.transform(blocks_of(block), parsed)
    return (F.size(found) == 1) & (F.get(found, F.lit(0))["role"] == role) & (F.get(found, F.lit(0))["text"] == text)


def format_chats(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per ``conv_id``: ``formatted`` and ``loss_mask``.

    ``turns`` has conv_id, turn, role and text; other columns are not read.
    Turns are ordered by turn (null first), then role and text, so ties and
    repeated rows have a fixed place and all stay.  A null text or role counts
    as empty, a null conv_id is a conversation of its own, an empty table gives
    no rows.  ``loss_mask`` has a pair for each turn: code points to skip from
    the start of its block and code points under the loss after that (0 for
    roles that are not trained).  A conversation is one string by its nature;
    rendering and escaping are done turn by turn before rows are grouped.
    """
    role, text = F.col("__role"), F.col("__text")
    source = turns.select(
        "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("__role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"),
    )
    tried = source.withColumn("__plain", rendered(role, text))
    tried = tried.withColumn("__block", F.when(gives_back(F.col("__plain"), role, text), F.col("__plain")).otherwise(
        rendered(escaped_role(role), F.regexp_replace(text, ESCAPE, r"\\$1"))))
    # One escape always suffices; this guards the template against later changes.
    checked = tried.withColumn("__block", F.when(
        (F.col("__block") == F.col("__plain")) | gives_back(F.col("__block"), role, text), F.col("__block")
    ).otherwise(F.raise_error(F.lit("a turn does not survive the round trip"))))
    head = F.instr(F.col("__block"), "\n")
    take = F.when(role == trained_role, F.length("__block") - head - len(END) - 2).otherwise(0)
    grouped = checked.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"), role.alias("role"), text.alias("text"),
        F.col("__block").alias("block"), head.alias("skip"), take.alias("take"),
    ))).alias("t"))
    return grouped.select(
        "conv_id",
        F.array_join("t.block", "").alias("formatted"),
        F.transform("t", lambda t: F.struct(t["skip"].alias("skip"), t["take"].alias("take"))).alias("loss_mask"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Turns and trained text of formatted conversations, from their text and mask alone.

    Adds ``turns`` (role and text in order) and ``loss_text`` (unescaped text
    under the mask).
    """
    found = F.transform(blocks_of(F.col("formatted")), parsed)
    masked = F.zip_with(blocks_of(F.col("formatted")), F.col("loss_mask"), lambda block, mask: F.regexp_replace(
        F.substring(block, mask["skip"] + 1, mask["take"]), UNESCAPE, "$1"))
    return chats.withColumn(
        "turns", F.transform(found, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    ).withColumn("loss_text", F.array_join(masked, ""))


def chat_digests(chats: DataFrame) -> DataFrame:
    return read_back(chats).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
