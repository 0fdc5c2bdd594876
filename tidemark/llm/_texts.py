"""Each distinct text once, and what was measured on it joined back to every document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import doc_texts

#: A text that holds more than one row in HOT is joined apart from the others; there are fewer than HOT such texts.
HOT = 256


def text_key():
    """SHA-256 of the text: stands for a whole text once equal texts have been brought together."""
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(key, text, copies), shuffled by the whole text; a map task sends a repeated text once."""
    texts = doc_texts(docs).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return texts.select(text_key().alias("key"), "text", "copies")


def to_documents(docs: DataFrame, measures: DataFrame) -> DataFrame:
    """doc_id and the measures of its text, one row for each row of docs.

    `measures` holds key and copies, one row a distinct text of docs. Texts with many copies,
    fewer than HOT by definition, are broadcast; no task then gets more than one row in HOT by key.
    """
    ids = doc_texts(docs).select("doc_id", text_key().alias("key"))
    rows = measures.agg(F.sum("copies")).first()[0] or 0
    hot = measures.filter(F.col("copies") > rows // HOT)
    few = ids.join(F.broadcast(hot), "key")
    rest = ids.join(F.broadcast(hot.select("key")), "key", "left_anti")
    return few.unionByName(rest.join(measures.filter(F.col("copies") <= rows // HOT), "key")).drop("key", "copies")
