"""Column expressions and small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(col: Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(col, F.lit(""))


def words_between(text: Column, separators: str) -> Column:
    """The runs of ``text`` between matches of the regular expression ``separators``."""
    return F.array_remove(F.split(text, separators), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` is right (and much faster) where all characters are ASCII, that is where
    characters and bytes count the same.
    """
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def documents(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null read as empty), whatever else ``docs`` holds."""
    return docs.select(docs[id_col].alias("doc_id"), whole_text(docs[text_col]).alias("text"), *more)


def text_key(text: Column) -> Column:
    """A hash of the text; with the doc_id it names a row where ids are null or shared."""
    return F.xxhash64(whole_text(text))


def same_row(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """The row of ``docs`` is the one that ``__id`` and ``__key`` name."""
    return docs[id_col].eqNullSafe(F.col("__id")) & (text_key(docs[text_col]) == F.col("__key"))


def broadcast_if_small(df: DataFrame, *, max_rows: int, max_bytes: int, size_col: str) -> DataFrame:
    """``df``, with a broadcast hint if its measured rows and bytes (two scalars) allow it.

    Without the hint the planner joins it by shuffle, splitting skewed keys.
    """
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(size_col)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def blocks(df: DataFrame, col: str, size: int) -> Iterator[list]:
    """The distinct values of ``col``, ``size`` at a time, so never more than one block on the driver."""
    part, values = [], df.select(col).distinct().toLocalIterator()
    for (value,) in values:
        part.append(value)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part
