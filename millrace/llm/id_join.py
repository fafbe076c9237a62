"""Texts joined to a set of ids without a shuffle of the texts that are not in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import materialize
from .exact_dedup import filter_size, flagged


def join_ids(docs: DataFrame, ids: DataFrame, id_col: str, key: str, how: str, filter_bits: int | None = None) -> DataFrame:
    """docs joined to ids (written, one row an id, its id in the column `key`) by inner, left_semi or left_anti; null ids are equal.

    Within the bound the ids are broadcast. Beyond it a Bloom filter of bounded size goes out instead: only documents whose id may
    be among the ids shuffle with their texts, and under left_anti all others pass straight through."""
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unknown join {how}")
    n = ids.count()
    if n <= common.BROADCAST_ROWS:
        return docs.join(F.broadcast(ids), docs[id_col].eqNullSafe(ids[key]), how)
    filter_bits = filter_bits or filter_size(n)
    cell = F.pmod(F.xxhash64(F.col(key)), F.lit(filter_bits)).alias("cell")
    words = ids.select(cell).groupBy(F.shiftright("cell", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("mask"))
    marked = flagged(docs.withColumn("__id_cell", F.pmod(F.xxhash64(F.col(id_col)), F.lit(filter_bits))), materialize(words, "ids"), ["__id_cell"], "__id_maybe").drop("__id_cell")
    maybe = marked.where("__id_maybe").drop("__id_maybe")
    met = maybe.join(ids, maybe[id_col].eqNullSafe(ids[key]), how)
    return marked.where("not __id_maybe").drop("__id_maybe").unionByName(met) if how == "left_anti" else met
