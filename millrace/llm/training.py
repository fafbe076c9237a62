"""A bounded sample of labelled rows for the classifiers. Everything else they do covers all rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, materialize

#: Labelled rows that a classifier learns from at most, and the bytes that their texts have together at most.
SAMPLE_ROWS = 6000
SAMPLE_BYTES = 32 << 20


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(crc_mod(doc_id, 5) == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> pd.DataFrame:
    """text, label of at most `rows` labelled rows outside the held-out fifth: those whose ids have the least hashes, a sample
    that depends neither on the order of the rows nor on their number. Texts are whole; one that does not fit into what is left of
    `max_bytes` in this order is passed over.

    An id with several labels has the largest of them, one with several texts the least of them; null ids, labels and held-out
    ids are not learned from. Only the chosen ids are broadcast, and the driver gets one row for each."""
    chosen = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col(label_col).cast("int").alias("label"))
    chosen = chosen.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(rows)
    chosen = materialize(chosen, "chosen")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # One text an id: the least, by its digest so that whole texts are not compared in the shuffle.
    texts = materialize(texts.groupBy("h", "doc_id", "label").agg(F.min_by("text", F.sha2("text", 256)).alias("text")), "sample")
    left, fit = max_bytes, []
    for r in texts.select("h", "doc_id", F.octet_length("text").alias("n")).orderBy("h", "doc_id").collect():
        if r["n"] <= left:
            left -= r["n"]
            fit.append((r["doc_id"],))
    if not fit:
        return pd.DataFrame({"text": [], "label": []})
    fit = docs.sparkSession.createDataFrame(fit, chosen.select("doc_id").schema)
    got = texts.join(F.broadcast(fit), "doc_id").select("h", "doc_id", "text", "label").toPandas()
    return got.sort_values(["h", "doc_id"], ignore_index=True)[["text", "label"]]
