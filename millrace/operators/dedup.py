"""Key dedup: first wins within a batch, and against what is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def score_key() -> list[Column]:
    name = F.coalesce(T.blank_to_null("major_code"), F.lower("major_name_raw"))
    return [F.upper("university_code").alias("k1"), name.alias("k2"), F.col("year").alias("k3"), F.col("admission_method").alias("k4"), F.upper("subject_combination").alias("k5")]


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. An aggregate with map-side combining, so that a key with many rows never meets in one task;
    `order` must make the choice unique for a stable result."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*[F.col(c) for c in order])).alias("__row"))
    return best.select("__row.*")


def pass_blank(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """first_wins on one key, where rows with a blank key all pass."""
    is_blank = F.coalesce(T.strip(key), F.lit("")) == ""
    return df.where(is_blank).unionByName(first_wins(df.where(~is_blank), [key], order))


def skip_existing(df: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(stored.select(*keys), keys, "left_anti")


def tiers(df: DataFrame, keys: list[str], order: list[str], cached: DataFrame | None = None, stored: DataFrame | None = None) -> DataFrame:
    """df with a column tier: passed, in_memory (not the first of its key, or a key of `cached`) or table (a key of `stored`). A table
    that is not given is a tier that does not take part. Rows with a null in the key are not looked up."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("__first"))
    out = join_null_safe(df, first, keys).withColumn("__later", ~F.struct(*[F.col(c) for c in order]).eqNullSafe(F.col("__first")))
    for name, table in (("__cached", cached), ("__stored", stored)):
        if table is None:
            out = out.withColumn(name, F.lit(False))
        else:
            out = out.join(table.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left")
    tier = F.when(F.col("__later") | F.coalesce("__cached", F.lit(False)), "in_memory").when(F.coalesce("__stored", F.lit(False)), "table").otherwise("passed")
    return out.select(*df.columns, tier.alias("tier"))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left joined to the one right row of its key, nulls being equal."""
    named = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(named, on).drop(*[f"__r_{k}" for k in keys])


def counters(tiered: DataFrame) -> DataFrame:
    """passed, dropped, in_memory_hits and table_hits of tiers()."""
    t = F.col("tier")
    return tiered.agg(F.count_if(t == "passed").alias("passed"), F.count_if(t != "passed").alias("dropped"), F.count_if(t == "in_memory").alias("in_memory_hits"), F.count_if(t == "table").alias("table_hits"))
