"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

Test items are parted by the size of their shingle set. An item's sketch is its least shingle hashes (a bottom-k MinHash), as
many as its size class needs: of an item with s shingles a text that holds the share t misses at most (1 - t) s, so with
k = floor((1 - t) s_max) + 1 at least one hash of the sketch stands in the text, however long that is. One pass over the
corpus looks up each text's shingle hashes among the sketches; the candidate pairs are verified on the shingles themselves.
The corpus does not shuffle: the sketches go to it by broadcast while their counted number is within the bound, and beyond it a
Bloom filter of them does, so that only hashes that may be in a sketch shuffle to them, common ones apart from the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import documents, join_skewed, materialize, small
from .exact_dedup import filter_size, flagged
from .id_join import join_ids

N = 5
THRESHOLD = 0.8
#: Bytes of the items' n-grams that may be broadcast; beyond it they are joined by shuffle.
GRAM_BYTES = 64 << 20
#: Size classes of items grow by this factor.
CLASS_STEP = 1.25


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _gram_hashes(n: int) -> Column:
    """Hashes of the n-grams of the column `words`, repeats included."""
    return F.expr(f"if(size(words) < {n}, array(), transform(sequence(0, size(words) - {n}), i -> xxhash64({', '.join(f'words[i + {k}]' for k in range(n))})))")


def _grams(n: int) -> Column:
    """The distinct n-grams of the column `words`, as text."""
    return F.expr(f"if(size(words) < {n}, array(), array_distinct(transform(sequence(0, size(words) - {n}), i -> concat_ws(' ', {', '.join(f'words[i + {k}]' for k in range(n))}))))")


def sketches(items: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """items: key, words. key, hash: each item's sketch, its length set by the item's size class."""
    hashed = items.withColumn("h", F.array_sort(F.array_distinct(_gram_hashes(n)))).where("size(h) > 0")
    level = F.floor(F.log(F.size("h")) / F.log(F.lit(CLASS_STEP)))
    largest = F.least(F.ceil(F.pow(F.lit(CLASS_STEP), level + 1)), F.lit(1 << 30))
    k = (F.floor((1 - F.lit(threshold)) * largest + 1e-9) + 1).cast("int")
    return hashed.select("key", F.explode(F.slice("h", F.lit(1), k)).alias("hash"))


def _met(hashes: DataFrame, sketch: DataFrame) -> DataFrame:
    """hashes (doc_id, hash) joined to the sketches (key, hash)."""
    n = sketch.count()
    if n <= common.BROADCAST_ROWS:
        return hashes.join(F.broadcast(sketch), "hash")
    bits = filter_size(n)
    cell = F.pmod(F.xxhash64("hash"), F.lit(bits))
    bloom = sketch.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("mask"))
    maybe = flagged(hashes.withColumn("__cell", cell), materialize(bloom, "bloom"), ["__cell"], "__maybe").where("__maybe").select("doc_id", "hash")
    maybe = materialize(maybe.distinct(), "maybe")
    # An n-gram that is common in the corpus goes by broadcast, with the items that have it in their sketch.
    often = maybe.groupBy("hash").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= max(1000, maybe.count() // common.HOT_GROUPS + 1)).select("hash")
    often = materialize(often, "often")  # HOT_GROUPS rows at most
    of_often = materialize(sketch.join(F.broadcast(often), "hash", "left_semi"), "of_often")
    rest = maybe.join(F.broadcast(often), "hash", "left_anti").join(sketch, "hash")
    return rest.unionByName(maybe.join(F.broadcast(often), "hash", "left_semi").join(small(of_often), "hash").select(*rest.columns))


def _short(docs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """doc_id, key, n_shared, n_item for items of 1 to n - 1 words, a size class of their own: each is one gram of its own length, found by
    its 64-bit hash."""
    gram = F.concat_ws(" ", "words")
    few = materialize(texts.where((F.size("words") >= 1) & (F.size("words") < n)).select("key", F.size("words").alias("size"), gram.alias("gram"), F.xxhash64(gram).alias("hash")), "short")
    sizes = [r["size"] for r in few.select("size").distinct().collect()]  # n - 1 at most
    each = docs.select("doc_id", words(F.col("text")).alias("words"))
    grams = F.flatten(F.array(*[_grams(k) for k in sizes])) if sizes else F.array().cast("array<string>")
    held = each.select("doc_id", F.explode(grams).alias("gram")).withColumn("hash", F.xxhash64("gram"))
    met = _met(held.select("doc_id", "hash"), few.select("key", "hash"))
    return met.select("doc_id", "key", F.lit(1).cast("long").alias("n_shared"), F.lit(1).cast("long").alias("n_item")).distinct()


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = N, threshold: float = THRESHOLD, short_items: bool = False) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment: a row for each distinct id and item where the text holds at least
    `threshold` of the item's distinct word n-grams.

    Words are runs of letters and digits in lower case. A null or empty text holds nothing; an item of fewer than n words has
    no n-gram and is found only with short_items, which looks it up as one gram of all its words. Repeated rows of one id give one row an item with the most that one of them holds; null ids
    are one id. The same holds for items: each text of an item id is looked up on its own, and the one that is held most counts. Empty tables give no rows; columns other than the named ones are not read."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    bench = materialize(items.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("words")).distinct(), "items")
    # Ids may be null or repeated, so every distinct text has a key of its own.
    texts = materialize(bench.select("words").distinct().withColumn("key", F.monotonically_increasing_id()), "texts")
    names = small(materialize(bench.join(texts, "words").select("key", "item_id"), "names"))
    sketch = materialize(sketches(texts, n, threshold).dropDuplicates(), "sketches")
    hashes = docs.select("doc_id", words(F.col("text")).alias("words")).select("doc_id", F.explode(_gram_hashes(n)).alias("hash"))
    pairs = materialize(_met(hashes, sketch).select("doc_id", "key").distinct(), "pairs")

    # One row a text with its items, so that a text is parted into shingles once; an item's shingles come by its key.
    found = materialize(pairs.groupBy(F.col("doc_id").alias("__found")).agg(F.collect_set("key").alias("items")), "found")
    met = join_ids(docs, found, "doc_id", "__found", "inner").select("doc_id", words(F.col("text")).alias("words"), "items")
    met = met.select("doc_id", "items", _grams(n).alias("grams"))
    grams = materialize(texts.select("key", _grams(n).alias("item_grams")), "grams")
    size = grams.agg(F.sum(F.octet_length(F.concat_ws(" ", "item_grams")).cast("long") + 16 * F.size("item_grams"))).first()[0] or 0
    each = met.select("doc_id", "grams", F.explode("items").alias("key"))
    if size <= GRAM_BYTES:
        each = each.join(F.broadcast(grams), "key")
    else:  # an item that many documents hold is broadcast, so that they do not meet in one task
        each = join_skewed(each, grams.join(pairs.groupBy("key").agg(F.count(F.lit(1)).alias("docs")), "key"), "key", "docs", hot_groups=1000)
    shared = each.select("doc_id", "key", F.size(F.array_intersect("grams", "item_grams")).cast("long").alias("n_shared"), F.size("item_grams").cast("long").alias("n_item"))
    if short_items:
        shared = shared.unionByName(_short(docs, texts, n))
    shared = shared.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item"))
    most = shared.join(names, "key").groupBy("doc_id", "item_id").agg(F.max(F.struct("containment", "n_shared", "n_item")).alias("most"))
    return most.select("doc_id", "item_id", "most.n_shared", "most.n_item", "most.containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs, with all columns, without the rows whose id holds an item."""
    drop = materialize(contaminated(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias("__drop")).distinct(), "drop")
    return join_ids(docs, drop, id_col, "__drop", "left_anti")


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = {
    "op7_benchmark_decontamination": r"""
WITH i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
ig AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda k: array_to_string(w[k:k + 4], ' '))) AS g FROM i),
n AS (SELECT item_id, count(*) AS n_item FROM ig GROUP BY item_id),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda k: array_to_string(w[k:k + 4], ' '))) AS g FROM d),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM dg JOIN ig USING (g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_item, CAST(n_shared AS DOUBLE) / n_item AS containment
FROM s JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_item"""
}
