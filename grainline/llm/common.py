"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.session import scratch

# The white space of every operator here: space and the controls 9 to 13.
SPACE_CLASS = r"[\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\x0c\r"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to a new shared folder and read it back: computed once, and its lineage ends there."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: Column) -> Column:
    """The text, NULL as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text; empty for NULL and for white space alone."""
    trimmed = F.trim(whole(text), F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))


def count_words(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def text_key(text: Column) -> Column:
    """Tells apart rows that share a doc_id."""
    return F.xxhash64(whole(text))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the fold of a document. NULL ids count as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores as it takes not to be a column of the frame."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same_text(documents: DataFrame, found: DataFrame) -> Column:
    """Join condition: rows of ``documents`` that ``found`` names by (id, key)."""
    return documents["doc_id"].eqNullSafe(found["__id"]) & (text_key(documents["text"]) == found["__key"])


def named(rows: DataFrame) -> DataFrame:
    """(__id, __key) of rows of (doc_id, text_key), each once."""
    return rows.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
