"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 hashes every text to two cells of a Bloom filter and keeps the bits of cells that were hit more than once. Each task first
ORs and XORs its rows into 64-bit words of the filter, so what it shuffles is bounded by the filter whatever it reads. Pass 2 probes
the filter: a row with both bits set may repeat, and only such rows shuffle (a digest and an id); all others pass straight through.

The filter has 32 bits for each row, and MAX_FILTER_BITS at most: MAX_FILTER_BITS / 64 words, a proven bound for the broadcast.
Beyond 8 million rows it fills up (8 bits a row at 34 million): more unique rows then shuffle with the repeated ones, at worst all of
them once, and the result stays the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_skewed, materialize

ROW_BITS, MIN_FILTER_BITS = 32, 1 << 16
#: 2^28 bits are 2^22 words at most, 16 bytes each.
MAX_FILTER_BITS = 1 << 28
_SEED = 0x5BD1E995
#: Rows that one array stands for at most.
_REPEATS = 1 << 16


def filter_size(rows: int) -> int:
    """Bits of a filter for so many rows."""
    return min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << max(0, ROW_BITS * rows - 1).bit_length()))


def cells(text: Column, bits: int) -> list[Column]:
    """The two cells of a text."""
    return [F.pmod(F.xxhash64(text), F.lit(bits)), F.pmod(F.xxhash64(text, F.lit(_SEED)), F.lit(bits))]


def repeated_words(hit: DataFrame) -> DataFrame:
    """hit: a column `cell`, one row a hit. The bits of cells hit twice or more, as (word, mask) rows.

    Of the bits of a word, those in the OR but not in the XOR were hit an even number of times. If twice each, and once each of the
    others, makes up the number of hits, just those repeat; if not, some bit was hit three times or more, and all bits of the word are
    taken to repeat."""
    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    words = hit.groupBy(F.shiftright("cell", 6).alias("word")).agg(F.bit_or(bit).alias("any"), F.bit_xor(bit).alias("odd"), F.count(F.lit(1)).alias("n"))
    mask = F.expr("if(n = bit_count(odd) + 2 * bit_count(any & ~odd), any & ~odd, any)")
    return words.select("word", mask.alias("mask")).where("mask <> 0")


def flagged(rows: DataFrame, words: DataFrame, at: list[str], name: str) -> DataFrame:
    """rows with a boolean: all cells in the columns `at` are set in `words`."""
    for i, c in enumerate(at):
        probe = words.select(F.col("word").alias(f"__w{i}"), F.col("mask").alias(f"__m{i}"))
        rows = rows.join(F.broadcast(probe), F.shiftright(c, 6) == F.col(f"__w{i}"), "left")
    hit = [F.expr(f"coalesce(getbit(__m{i}, cast({c} & 63 as int)), 0) = 1") for i, c in enumerate(at)]
    out = rows.withColumn(name, hit[0] & hit[1] if len(hit) == 2 else hit[0])
    return out.drop(*[f"__{x}{i}" for x in "wm" for i in range(len(at))])


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _filter(docs: DataFrame, text_col: str, bits: int | None) -> tuple[DataFrame, int]:
    bits = bits or filter_size(docs.count())
    return materialize(repeated_words(docs.select(F.explode(F.array(*cells(_text(text_col), bits))).alias("cell"))), "repeats"), bits


def _groups(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows: doc_id, text_sha256 of flagged rows. Distinct rows with their number, and the groups of equal texts."""
    each = rows.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return each, each.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("members"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty, and all empty texts are one group. The row with the largest id
    stays, a null id being the smallest. Of rows that agree in id and text one stays. An empty table gives no rows; columns
    other than the two named are not read. A group that holds a large share of all rows is counted before it shuffles and its
    verdict is broadcast (see join_skewed); the groups sent so are bounded in number."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words, filter_bits = _filter(docs, "text", filter_bits)
    c1, c2 = cells(_text("text"), filter_bits)
    probed = flagged(docs.select("doc_id", F.sha2(_text("text"), 256).alias("text_sha256"), c1.alias("c1"), c2.alias("c2")), words, ["c1", "c2"], "may_repeat")
    rows = materialize(probed.select("doc_id", "text_sha256", "may_repeat"), "digests")
    alone = rows.where(~F.col("may_repeat")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    each, groups = _groups(rows.where("may_repeat"))
    each = materialize(each, "members")
    # A row that stands n times becomes n rows again, by arrays of bounded size.
    found = join_skewed(each, groups, "text_sha256", "members").withColumn("b", F.explode(F.expr(f"sequence(0L, (n - 1) div {_REPEATS})")))
    found = found.withColumn("i", F.explode(F.expr(f"sequence(b * {_REPEATS} + 1, least(n, (b + 1) * {_REPEATS}))")))
    found = found.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)).alias("kept"), "text_sha256")
    return alone.unionByName(found)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int | None = None) -> DataFrame:
    """The rows of docs that stay, with all their columns, under the rules of exact_dedup.

    Rows that cannot repeat pass without a shuffle. The others are joined to the id that stays on (digest, id), so that the
    members of one large group are dealt over all tasks."""
    words, filter_bits = _filter(docs, text_col, filter_bits)
    c1, c2 = cells(_text(text_col), filter_bits)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias("doc_id"), F.sha2(_text(text_col), 256).alias("text_sha256"), c1.alias("c1"), c2.alias("c2"))
    packed = flagged(packed, words, ["c1", "c2"], "may_repeat")
    twice = packed.where("may_repeat")
    _, groups = _groups(twice.select("doc_id", "text_sha256"))
    stay = groups.select(F.col("text_sha256").alias("__sha"), F.col("keep_id").alias("__keep"))
    kept = twice.join(stay, (F.col("text_sha256") == F.col("__sha")) & F.col("doc_id").eqNullSafe(F.col("__keep"))).dropDuplicates(["text_sha256", "doc_id"])
    return packed.where(~F.col("may_repeat")).select("__row.*").unionByName(kept.select("__row.*"))


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = {
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
}
