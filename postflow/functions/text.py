"""Text functions: token split, hashtag tokens, line feed (STR-1, GEN-1, FLT-1, PRJ-7).

All of them are built-in Spark expressions (``split``/``explode``/``startswith``): they run in
whole-stage codegen, with no Python in the task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's, as Java regular expressions.
# TOKEN_SEPARATORS: one character out of  , . [ ] { } ? ! ASCII-whitespace ; " '
# Backslash, colon, parentheses, slash, hyphen and '#' are not separators; Java's \s is ASCII only.
TOKEN_SEPARATORS = r"""[,.\[\]\{\}\?!\s;"']"""
# A line ends at LF, CR or CR LF (what a line reader on the receiving socket sees).
LINE_BREAK = r"\r\n|\r|\n"
HASHTAG_PREFIX = "#"


def token_array(text: Column | str) -> Column:
    """STR-1: the text split on the separator class; empty strings are kept (as ``split`` does)."""
    return F.split(F.col(text) if isinstance(text, str) else text, TOKEN_SEPARATORS)


def is_hashtag(token: Column | str) -> Column:
    """FLT-1: a token that starts with '#' (a bare '#' and '##s' count; case is kept)."""
    return (F.col(token) if isinstance(token, str) else token).startswith(HASHTAG_PREFIX)


def tokens(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("id",),
           name: str = "token") -> DataFrame:
    """GEN-1: one row per token of ``text`` with the ``keep`` columns; NULL text gives no row."""
    return df.select(*keep, F.explode(token_array(text)).alias(name))


def hashtags(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per hashtag occurrence: ``keep`` columns + ``hashtag`` (a tag twice counts twice)."""
    return tokens(df, text, keep, name="hashtag").where(is_hashtag("hashtag"))


def text_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """PRJ-7: the text-only line feed; records without text are skipped, each line is a row ``line``.

    The feed sends ``text + newline`` per record, so a text with k line breaks gives k+1 lines.
    """
    return (df.where(F.col(text).isNotNull())
              .select(F.explode(F.split(F.col(text), LINE_BREAK)).alias("line")))
