"""Token counts with a digest cache.

The cache is a Parquet table of (digest of the normalised content, digest of the tokenizer and its library, count) in a folder
of the caller's choice. A Bloom filter over the batch and the cache tells which rows may have a stored count or a copy in the
batch; only those shuffle, are looked up by digest and encoded once per distinct digest. All others are encoded where they
are read. Every new count is appended to the cache.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete, documents, join_skewed, materialize, shared_dir, slices, tidy
from .exact_dedup import cells, filter_size, flagged, repeated_words

TOKENIZER = "piece_bpe_32k.model"
LIMIT = 4096
_CACHE = "text_sha256 string, tokenizer string, n_tokens long"


def tokenizer_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def version(path: str) -> str:
    """A digest of the tokenizer file and the version of the library that reads it."""
    import sentencepiece
    import tokenizers

    lib = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + lib.encode()).hexdigest()


def _counter(path: str):
    """A function from texts to their numbers of tokens, as the library for this file gives them."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return lambda texts: [len(x.ids) for x in t.encode_batch_fast(texts, add_special_tokens=False)]


def _encoder(path: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(path)
        for f in frames:
            texts, out = f["text"].tolist(), []
            for a, b in slices(texts, 1_000_000):
                out += count(texts[a:b])
            yield f.drop(columns="text").assign(n_tokens=pd.Series(out, f.index, "int64"))

    return run


def _stored(spark, cache_path: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(_CACHE).parquet(cache_path) if there else spark.createDataFrame([], _CACHE)


def count_tokens(docs: DataFrame, cache_path: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT, filter_bits: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of docs.

    The content is normalised by reading null as empty and no more, since any other change could change the count. A table
    without rows gives none and leaves the cache as it was; repeated rows each get a row; columns other than the two named are
    not read. Two runs that append the same digest store it twice with one count, which a lookup takes as one."""
    spark, path = docs.sparkSession, tokenizer_path(path)
    now = version(path)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("text_sha256", F.sha2("text", 256)).withColumn("n_bytes", F.octet_length("text").cast("long"))
    cache = _stored(spark, cache_path).where(F.col("tokenizer") == now).groupBy("text_sha256").agg(F.max("n_tokens").alias("n_tokens"))
    filter_bits = filter_bits or filter_size(docs.count() + cache.count())
    c1, c2 = cells(F.col("text_sha256"), filter_bits)
    hits = rows.select(F.explode(F.array(c1, c2)).alias("cell")).unionByName(cache.select(F.explode(F.array(c1, c1, c2, c2)).alias("cell")))
    words = materialize(repeated_words(hits), "repeats")
    rows = flagged(rows.withColumn("c1", c1).withColumn("c2", c2), words, ["c1", "c2"], "look_up").drop("c1", "c2")

    encode = _encoder(path)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    direct = rows.where(~F.col("look_up")).select("doc_id", "text_sha256", "n_bytes", "text")
    direct = materialize(direct.mapInPandas(tidy(encode), f"doc_id {id_type}, text_sha256 string, n_bytes long, n_tokens long"), "direct")
    asked = materialize(rows.where("look_up").select("doc_id", "text_sha256", "n_bytes"), "asked")
    once = rows.where("look_up").groupBy("text_sha256").agg(F.first("text").alias("text"))
    missing = once.join(cache.select("text_sha256"), "text_sha256", "left_anti")
    encoded = materialize(missing.mapInPandas(tidy(encode), "text_sha256 string, n_tokens long"), "encoded")

    new = direct.select("text_sha256", "n_tokens").unionByName(encoded)
    new.select("text_sha256", F.lit(now).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    sizes = asked.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("rows"))
    known = sizes.join(encoded.unionByName(cache), "text_sha256")
    looked_up = join_skewed(asked, materialize(known, "known"), "text_sha256", "rows").select("doc_id", "n_bytes", "n_tokens")
    return direct.select("doc_id", "n_bytes", "n_tokens").unionByName(looked_up).withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    """Each call has a cache of its own, removed when the counts are made, so that every run of the query does the whole work."""
    cache = f"{shared_dir(spark)}/token-cache-{uuid.uuid4().hex}"
    out = count_tokens(documents(spark, sf_dir), cache)
    delete(spark, cache)
    return out
