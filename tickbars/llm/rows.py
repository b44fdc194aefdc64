"""Rows of a table by id and text, where ids may be null or repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["_id", "_no_id", "_key"]


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def row_key(doc_id: Column, key: Column) -> list[Column]:
    """Columns _id, _no_id and _key, of which none is null: a plain join on them (KEY) is also grouped by them."""
    return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("_id"), doc_id.isNull().alias("_no_id"), key.alias("_key")]


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of *docs* (_row) by KEY, one of those alike in id and text.

    They are exchanged here; a join on KEY and what is grouped by KEY after it finds them in place.
    """
    whole = docs.select(F.struct(*docs.columns).alias("_row"), *row_key(F.col(doc_id), text_key(F.col(text))))
    return whole.dropDuplicates(KEY)


def rows_kept(docs: DataFrame, kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of *docs* named in *kept* (id, text_key); of rows alike in both, one."""
    named = kept.select(*row_key(F.col("id"), F.col("text_key")))
    return keyed(docs, doc_id, text).join(named, KEY, "left_semi").select("_row.*")
