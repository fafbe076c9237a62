"""Medians and distinct counts that are kept up without a rescan: sketches of each batch, stored and merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of the quantile sketch, and by how much the rank of its median may be off.
KLL_SIZE, RANK_ERROR = 400, 0.02
#: Size of the distinct-count sketch as a power of two, and its error as a share (three standard deviations).
HLL_SIZE, COUNT_ERROR = 14, 0.03


def add(batch: DataFrame, by: list[str], value: str, what: str, path: str, batch_id: int) -> None:
    """Store a batch's sketches: for each group its rows, least and largest value, a quantile sketch of `value` and a distinct-count sketch of
    `what`. A batch that runs again writes over its own. Null values take no part."""
    row = batch.withColumns({"__v": F.col(value).cast("double"), "__w": F.col(what).cast("string")})
    out = row.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"),
        F.expr(f"kll_sketch_agg_double(__v, {KLL_SIZE})").alias("values"), F.hll_sketch_agg("__w", HLL_SIZE).alias("distincts"),
    )
    out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def merged(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """by, n, low, high, middle (the median, its rank off by RANK_ERROR at most) and distinct (off by COUNT_ERROR), from all stored batches:
    a row for each group and batch is read, and no record."""
    rows = spark.read.parquet(path)
    # Merging is associative, but has no aggregate of its own for quantiles: a group's sketches, one a batch, are folded.
    folded = F.aggregate(F.slice(F.col("all"), 2, F.greatest(F.size("all") - 1, F.lit(1))), F.col("all")[0], lambda a, b: F.call_function("kll_sketch_merge_double", a, b))
    out = rows.groupBy(*by).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.collect_list("values").alias("all"), F.hll_sketch_estimate(F.hll_union_agg("distincts")).alias("distinct"))
    return out.withColumn("kll", folded).select(*by, "n", "low", "high", F.expr("kll_sketch_get_quantile_double(kll, 0.5D)").alias("middle"), "distinct")
