"""A bounded sample of labelled documents, for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, rows: int, longest: int) -> list[tuple[bytes, int]]:
    """At most ``rows`` (text, 0/1) of labelled documents, half of each label as far as there are.

    ``learnable`` (over doc_id) says which rows may be learnt from; rows come
    in the order of a hash of doc_id, texts over ``longest`` bytes are left
    out. Null labels, doc_ids and texts are left out; of several rows of one
    doc_id one is taken. Both bounds hold whatever the input, so the ids are
    broadcast and the texts come to the driver.
    """
    spark = docs.sparkSession
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learnable).groupBy("doc_id").agg(F.max(label).alias("y"))
    order = F.xxhash64(F.lit(23), "doc_id")
    half = rows // 2
    ids = None
    for y in (0, 1):
        part = marked.where(F.col("y") == y).orderBy(order, "doc_id").limit(half)
        ids = part if ids is None else ids.union(part)
    ids = [(r["doc_id"], int(r["y"])) for r in ids.collect()]
    if not ids:
        return []
    small = spark.createDataFrame(ids, f"doc_id {labels.schema['doc_id'].dataType.simpleString()}, y int")
    text = F.col("text").cast("string")
    got = (docs.select("doc_id", text.alias("text")).where(F.octet_length("text") <= longest).join(F.broadcast(small), "doc_id")
           .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).orderBy(order, "doc_id").collect())
    return [(r["text"].encode(), r["y"]) for r in got]
