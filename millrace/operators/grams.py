"""Lookup of names by a part of them: an inverted index of grams with counted postings.

A name that holds a keyword holds every gram of it, so a keyword meets only the names that have its rarest gram; % and _ part a keyword into
fixed pieces, and grams come from the pieces. Grams are as long as a keyword's longest piece allows, in steps: in a large table many names
share any three letters, few share six. The index has the lengths that are asked for, and of them the grams that are. A keyword of wildcards
alone asks for a length, and meets all names under an empty gram. The postings of a gram lie in blocks of bounded size, so that a
frequent gram is spread over tasks. The pattern itself decides in the end.

Names and codes are looked up apart, each distinct one once with the k rows of it that come first: the others can't be among the first k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Lengths of grams.
SIZES = (1, 2, 3, 4, 6, 9)
#: Postings of a block.
BLOCK = 5_000
#: Hashes of sought grams that are sent to every task.
SOUGHT = 2_000_000


def grams(text: Column, size: int) -> Column:
    """The distinct substrings of `size` letters; the empty one for size 0."""
    if size == 0:
        return F.array(F.lit(""))
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (size - 1), F.lit(1))), lambda i: F.substring(text, i, F.lit(size)))
    return F.array_distinct(F.filter(parts, lambda g: F.length(g) == size))


def postings(rows: DataFrame, text: Column, sizes: list[int], sought: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(rows with gram and block, one for each gram of their text that is sought; gram, n, blocks). Null texts have no grams."""
    listed = rows.withColumn("__text", text)
    listed = listed.withColumn("gram", F.explode(F.flatten(F.array(*[grams(F.col("__text"), s) for s in sizes]))))
    keys = sought.select(F.xxhash64("gram").alias("__gram")).distinct()
    if keys.limit(SOUGHT + 1).count() <= SOUGHT:
        keys = F.broadcast(keys)
    listed = listed.join(keys, F.xxhash64("gram") == F.col("__gram"), "left_semi")
    counts = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    # Only grams of several blocks are looked up: at most one in `block` postings is such a gram.
    many = counts.where("blocks > 1").select("gram", "blocks")
    placed = listed.join(many, "gram", "left")
    return placed.withColumn("block", F.pmod(F.xxhash64("__text"), F.coalesce("blocks", F.lit(1))).cast("int")).drop("blocks", "__text"), counts


def pieces(pattern: Column) -> Column:
    """The fixed parts of a LIKE pattern: what stands between wildcards and escapes."""
    return F.filter(F.split(pattern, r"[%_\\]+"), lambda p: p != "")


def ilike_top(keywords: DataFrame, keyword: str, dimension: DataFrame, name: str, code: str, k: int = 1, block: int = BLOCK) -> DataFrame:
    """For each distinct keyword the k shortest names that hold it, case and outer spaces aside, or whose code does; ties by code. % and _ in
    a keyword stand for any letters and any letter. Returns keyword, name, code, rank.

    Every step is an equi-join of bounded blocks. The rank is limited before its shuffle, so that a keyword with many hits does not bring
    them to one task. A null keyword, and rows without a name and a code, meet nothing."""
    words = keywords.select(keyword).distinct().where(F.col(keyword).isNotNull()).withColumn("__low", F.lower(F.trim(keyword)))
    longest = F.coalesce(F.array_max(F.transform(pieces(F.col("__low")), F.length)), F.lit(0))
    words = words.withColumn("__size", F.greatest(*[F.when(longest >= n, n).otherwise(0) for n in (0, *SIZES)]))
    rows = dimension.select(F.col(name).alias("__name"), F.col(code).alias("__code"))
    sizes = sorted(r[0] for r in words.select("__size").distinct().collect())  # as many numbers as SIZES has, at most

    # Keywords of wildcards alone are alike when they ask for one length: one of each is looked up.
    fixed = words.where("__size > 0").withColumn("__as", F.col(keyword))
    wild = words.where("__size = 0").withColumn("__as", F.repeat(F.lit("_"), F.length("__low") - F.length(F.translate("__low", "_", ""))))
    sought = fixed.select("__as", "__low", "__size").unionByName(wild.select("__as", F.col("__as").alias("__low"), "__size").distinct())
    own = F.flatten(F.transform(F.filter(pieces(F.col("__low")), lambda p: F.length(p) >= F.col("__size")), lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - F.col("__size") + 1), lambda i: F.substring(p, i, F.col("__size")))))
    parts = sought.withColumn("gram", F.explode(F.when(F.col("__size") > 0, F.array_distinct(own)).otherwise(F.array(F.lit("")))))
    order = [F.length("__name"), F.col("__code"), F.col("__name")]

    def texts(field: Column, named: bool) -> DataFrame:
        first = rows.where(field.isNotNull()).withColumn("__raw", field).withColumn("__rank", F.row_number().over(W.partitionBy("__raw").orderBy(*order))).where(F.col("__rank") <= k)
        return first.groupBy("__raw").agg(F.collect_list(F.struct("__name", "__code")).alias("__rows")).withColumn("__named", F.lit(named))

    held = texts(F.col("__name"), True).unionByName(texts(F.col("__code").cast("string"), False))
    listed, counts = postings(held, F.lower("__raw"), sizes or [0], parts, block)
    rarest = parts.join(counts, "gram", "left").groupBy("__as", "__low").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "blocks")).alias("x")).where("x.n > 0")
    probes = rarest.select("__as", "__low", F.col("x.gram").alias("gram"), F.explode(F.sequence(F.lit(0), F.col("x.blocks") - 1)).alias("block"))

    def holds(text: Column) -> Column:
        return F.when(F.col("__low").rlike(r"[%_\\\\]"), F.ilike(text, F.concat(F.lit("%"), F.trim("__as"), F.lit("%")))).otherwise(F.contains(F.lower(text), F.col("__low")))

    # A row that is held by name and by code counts as held by name.
    hit = probes.join(listed, ["gram", "block"]).where(holds(F.col("__raw"))).select("__as", "__low", "__named", F.inline("__rows")).where(F.col("__named") | ~F.coalesce(holds(F.col("__name")), F.lit(False)))
    hit = hit.select("__as", "__name", "__code")
    rank = F.row_number().over(W.partitionBy("__as").orderBy(*order))
    best = hit.withColumn("rank", rank).where(F.col("rank") <= k)
    named = fixed.select(keyword, "__as").unionByName(wild.select(keyword, "__as"))
    return named.join(best, "__as").select(keyword, F.col("__name").alias(name), F.col("__code").alias(code), "rank")
