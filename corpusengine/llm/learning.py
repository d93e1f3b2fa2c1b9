"""The bounded sample of labelled documents that the classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusengine.llm import _common as c

FOLDS, HELD_OUT = 3, 1
SIZE = 100_000_000  # bytes of the sample's texts together, a documented bound


def held_out() -> F.Column:
    return (c.fold(FOLDS) == HELD_OUT).alias("held_out")


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, size: int = SIZE) -> DataFrame:
    """doc_id, text, y: labelled documents outside the held-out fold, at most ``rows`` of them and ``size`` bytes of text, by the order of a hash.

    Both bound what the driver and the broadcast hold, at any size of the tables. Labels without a document take no place. Of a document's
    repeated labels the largest counts, null labels are none; of its texts the shortest counts, and where that one is repeated, its rows
    all come. A text that is longer than the room that is left is passed over.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y is not null")
    marked = marked.filter(c.fold(FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max("y").alias("y"))
    held = c.texts(docs).select("doc_id", F.struct(F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"), F.xxhash64("text").alias("key")).alias("t"))
    found = held.join(marked, "doc_id").groupBy("doc_id").agg(F.min("t").alias("t"), F.max("y").alias("y"))
    listed = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", "y", "t.n", "t.key").collect()  # ``rows`` at most
    picked = []
    for r in listed:
        if r["n"] <= size:
            size -= r["n"]
            picked.append((r["doc_id"], r["y"], r["key"]))
    picked = docs.sparkSession.createDataFrame(picked, "doc_id long, y int, key long")
    return c.texts(docs).join(F.broadcast(picked), "doc_id").filter(F.xxhash64("text") == F.col("key")).select("doc_id", "text", "y")
