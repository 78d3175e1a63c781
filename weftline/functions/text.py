"""Tokenising expressions with the splitting rules of ``java.lang.String``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that are trimmed from both ends of a line.
BLANKS = "".join(map(chr, range(0x21)))


def split_words(line: Column, trim: bool = False) -> Column:
    """Words between single spaces: inner empty words stay, trailing ones go.

    An empty line gives one empty word and a line of only spaces gives none.
    With ``trim`` all outer characters up to U+0020 are removed first, so a
    blank line always gives one empty word.
    """
    if trim:
        return F.split(F.btrim(line, F.lit(BLANKS)), " ")
    stripped = F.rtrim(line)
    return (
        F.when((stripped == "") & (line != ""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, " "))
    )


def explode_lines(df: DataFrame, column: str, *keep: str, name: str = "line") -> DataFrame:
    """One row per newline-separated line of a text column."""
    return df.select(*keep, F.explode(F.split(F.col(column), "\n")).alias(name))


def explode_words(df: DataFrame, column: str, *keep: str, trim: bool = False, name: str = "word") -> DataFrame:
    """One row per word of a line column, carrying ``keep`` along."""
    return df.select(*keep, F.explode(split_words(F.col(column), trim)).alias(name))


def words_of_text(df: DataFrame, column: str, *keep: str, trim: bool = False) -> DataFrame:
    """Words of a multi-line text column."""
    return explode_words(explode_lines(df, column, *keep), "line", *keep, trim=trim)
