"""Merge of a batch into a table, with three policies, and rows made for keys that a dimension lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .dedup import first_wins

POLICIES = ("skip", "coalesce", "overwrite")


def merge(stored: DataFrame, batch: DataFrame, keys: list[str], values: list[str], policy: str = "coalesce") -> DataFrame:
    """stored and batch, each with one row a key, as keys, values and action (inserted, updated, unchanged, kept).

    skip: a stored key stays as it is. coalesce: non-null incoming values win where they differ. overwrite: incoming values win,
    nulls included. An empty list is a value."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}")
    old = stored.select(*keys, F.struct(*values).alias("__old"))
    new = batch.select(*keys, F.struct(*values).alias("__new"))
    both = old.join(new, keys, "full_outer")
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    taken = {}
    for v in values:
        o, n = F.col(f"__old.{v}"), F.col(f"__new.{v}")
        won = o if policy == "skip" else F.coalesce(n, o) if policy == "coalesce" else n
        taken[v] = F.when(has_old & has_new, won).when(has_new, n).otherwise(o)
    changed = F.lit(False)
    for v in values:
        changed = changed | ~taken[v].eqNullSafe(F.col(f"__old.{v}"))
    action = F.when(~has_old, "inserted").when(~has_new, "kept").when(changed, "updated").otherwise("unchanged")
    return both.select(*keys, *[c.alias(v) for v, c in taken.items()], action.alias("action"))


def action_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def with_missing(dimension: DataFrame, facts: DataFrame, key: str, defaults: dict) -> DataFrame:
    """The dimension with a default row for each key of the facts that it lacks. defaults: column to Column, made from the key."""
    lacking = facts.select(key).where(F.col(key).isNotNull()).distinct().join(dimension.select(key), key, "left_anti")
    return dimension.unionByName(lacking.withColumns(defaults), allowMissingColumns=True)


def deactivate(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    gone = codes.select(key).distinct().withColumn("__gone", F.lit(True))
    return df.join(gone, key, "left").withColumn("is_active", F.col("is_active") & F.col("__gone").isNull()).drop("__gone")


def usable(batch: DataFrame, needed: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose needed fields are all there, and those that fail."""
    lacks = F.lit(False)
    for c in needed:
        lacks = lacks | (F.coalesce(T.strip(c), F.lit("")) == "")
    return batch.where(~lacks), batch.where(lacks)


def store(stored: DataFrame, batch: DataFrame, key: str, needed: list[str], values: list[str], order: list[str], policy: str = "coalesce") -> tuple[DataFrame, DataFrame]:
    """A dimension's sink: the merged table with actions, and counters (new, updated, failed). Rows that lack a needed field fail; of
    rows of one key the first by `order` is taken."""
    good, bad = usable(batch, needed)
    merged = merge(stored, first_wins(good, [key], order), [key], values, policy)
    done = merged.agg(F.count_if(F.col("action") == "inserted").alias("records_new"), F.count_if(F.col("action").isin("updated", "unchanged")).alias("records_updated"))
    return merged, done.join(F.broadcast(bad.agg(F.count(F.lit(1)).alias("records_failed"))))


def remove(stored: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The table without the rows of these ids."""
    return stored.join(ids.select(key).distinct(), key, "left_anti")
