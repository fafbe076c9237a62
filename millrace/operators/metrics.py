"""Counters, run logs and quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import mappings as M
from ..functions import text as T
from ..schemas import SCORE_KEY
from ..sources import tables


def counters(df: DataFrame, **tests: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in tests.items()])


def run_status(failed: Column) -> Column:
    return F.when(failed == 0, "success").otherwise("partial")


def crawl_status(scraped: Column, failed: Column) -> Column:
    return F.when((scraped == 0) & (failed > 0), "failed").when((scraped > 0) & (failed > 0), "partial").otherwise("success")


def run_row(counts: DataFrame, spider: str, started, finished, triggered_by: str = "manual", error: str | None = None, without: list[str] | None = None) -> DataFrame:
    """A row of the run log from one row of counters (records_new, records_updated, records_failed). A run without an end is running; one
    with an error has failed. `without` names what did not take part; the summary says so where there is no error."""
    error_text = error or (f"without {', '.join(without)}" if without else None)
    start, end = F.lit(started).cast("timestamp"), F.lit(finished).cast("timestamp")
    status = F.when(end.isNull(), "running").when(F.lit(error).isNotNull(), "failed").otherwise(run_status(F.col("records_failed")))
    return counts.select(
        T.key_id(F.lit(spider), start).alias("id"), F.lit(spider).alias("spider_name"), status.alias("status"), start.alias("started_at"), end.alias("finished_at"),
        *[F.col(c).cast("int").alias(c) for c in ("records_new", "records_updated", "records_failed")], F.substring(F.lit(error_text), 1, 2000).alias("error_summary"), F.lit(triggered_by).alias("triggered_by"),
    )


def duration_seconds(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def overview(**tables: DataFrame) -> DataFrame:
    """(section, metric, value): the rows of each table."""
    return reduce(DataFrame.unionByName, [t.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("overview").alias("section"), F.lit(k).alias("metric"), "value") for k, t in tables.items()])


def coverage(df: DataFrame, by: list[str], **tests: Column) -> DataFrame:
    """Rows, and for each test the rows that meet it and their percentage, 0 of none."""
    n = F.count(F.lit(1))
    out = df.groupBy(*by).agg(n.alias("n"), *[F.count_if(c).alias(k) for k, c in tests.items()])
    return out.withColumns({f"{k}_pct": T.percent(F.col(k), F.col("n")) for k in tests})


def verdicts(metrics: DataFrame, limits: dict[str, float], at_most: tuple[str, ...] = ()) -> DataFrame:
    """pass where a value reaches its limit, or stays within it for the metrics named in at_most; else warn, also without a limit."""
    limit = F.try_element_at(F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(float(v)))]), F.col("metric"))
    good = F.when(F.col("metric").isin(list(at_most)), F.col("value") <= limit).otherwise(F.col("value") >= limit)
    return metrics.withColumn("verdict", F.when(good, "pass").otherwise("warn"))


def quality(scores: DataFrame, valid: Column, universities: DataFrame, majors: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """The quality metrics as (metric, value, verdict): each a percentage, 0 of none. scores has the table's key, universities and
    majors their ids; `valid` is told of a score. Without a table of job groups their metric is left out."""
    n = F.count(F.lit(1))

    def some(c: str) -> Column:
        return F.coalesce(F.size(c), F.lit(0)) > 0

    s = scores.agg(n.alias("n"), F.count_if(valid).alias("valid"))
    keys = scores.groupBy(*SCORE_KEY).agg(n.alias("k")).agg(F.sum("k").alias("n"), n.alias("keys"))
    scored = universities.select("id").join(scores.select(F.col("university_id").alias("id")).distinct().withColumn("has", F.lit(True)), "id", "left")
    m = majors.agg(n.alias("n"), F.count_if(some("holland_types")).alias("h"), F.count_if(F.coalesce(T.strip("description"), F.lit("")) != "").alias("d"), F.count_if(some("subject_combinations")).alias("c"))
    parts = [
        s.select(F.lit("valid_rate").alias("metric"), T.percent(F.col("valid"), F.col("n")).alias("value")),
        m.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), T.percent(F.col(c), F.col("n")).alias("value")) for k, c in (("holland_coverage", "h"), ("description_rate", "d"), ("combo_coverage", "c"))])).alias("x")).select("x.*"),
        scored.agg(n.alias("n"), F.count("has").alias("has")).select(F.lit("university_score_coverage").alias("metric"), T.percent(F.col("has"), F.col("n")).alias("value")),
        keys.select(F.lit("duplicate_rate").alias("metric"), T.percent(F.col("n") - F.col("keys"), F.col("n")).alias("value")),
    ]
    if jobs is not None:
        parts.append(jobs.agg(n.alias("n"), F.count("median_salary").alias("k")).select(F.lit("salary_coverage").alias("metric"), T.percent(F.col("k"), F.col("n")).alias("value")))
    return verdicts(reduce(DataFrame.unionByName, parts), M.QUALITY_LIMITS, at_most=("duplicate_rate",))


def count_by(df: DataFrame, *by: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def salaries(df: DataFrame, by: str, value: str) -> DataFrame:
    """The least, the largest and the median value of each group."""
    return df.groupBy(by).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.median(value).alias("middle"))


def latest(log: DataFrame, at: str, k: int = 5) -> DataFrame:
    return log.orderBy(F.desc(at)).limit(k)


def streak(df: DataFrame, order: str, bad: Column, length: int = 3, ranges: int | None = None) -> DataFrame:
    """df with `bad` (1, 0 or null, which is not bad) and `alert`: whether the row ends `length` bad rows in the order, nulls first.

    A prefix scan of two levels: rows are dealt into ranges of the order and written; a range needs to know no more of all ranges before
    it than the length of the bad run that reaches its start, which is found from one row a range. No task sees more than a range, and the
    driver a row for each. Rows that are equal in the order lie in one range, in any order."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("bad", bad.cast("int")).repartitionByRange(n, F.col(order).asc_nulls_first()).withColumn("__range", F.spark_partition_id())
    dealt = tables.rewritten(dealt, tables.scratch(df.sparkSession, "streak"))
    w = W.partitionBy("__range").orderBy(F.col(order).asc_nulls_first(), "__at")
    good = F.coalesce(F.col("bad") != 1, F.lit(True))
    placed = dealt.withColumn("__at", F.monotonically_increasing_id())
    placed = placed.withColumn("__row", F.row_number().over(w))
    placed = placed.withColumn("__good", F.max(F.when(good, F.col("__row"))).over(w.rowsBetween(W.unboundedPreceding, 0)))
    ends = placed.groupBy("__range").agg(F.max("__row").alias("n"), F.max("__good").alias("good")).collect()
    run, carried = 0, {}
    for r in sorted(ends, key=lambda r: r["__range"]):
        carried[r["__range"]] = run
        run = run + r["n"] if r["good"] is None else r["n"] - r["good"]
    before = F.create_map(*[F.lit(x) for kv in carried.items() for x in kv])[F.col("__range")] if carried else F.lit(0)
    so_far = F.when(F.col("__good").isNull(), before + F.col("__row")).otherwise(F.col("__row") - F.col("__good"))
    return placed.withColumn("alert", so_far >= length).drop("__range", "__at", "__row", "__good")


def observed(df: DataFrame, name, **tests: Column) -> DataFrame:
    """df, whose running plan also counts its rows and those that meet each test: no second pass, in batches and streams. name: an Observation
    (read by get, once an action has run) or a text (in a stream's progress, see observations)."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in tests.items()])


def observations(progress: list[dict], name: str) -> dict[str, int]:
    """The counters of a name added up over a stream's progress reports."""
    out: dict[str, int] = {}
    for p in progress:
        seen = p["observedMetrics"].get(name)
        for k, v in (seen.asDict() if hasattr(seen, "asDict") else seen or {}).items():
            out[k] = out.get(k, 0) + v
    return out


def alerts(log: DataFrame, new: str, failed: str, seconds: Column, most_failed: float = 0.1, longest: float = 7200, accepted: float = 0.05) -> DataFrame:
    """log with high_failure (more than `most_failed` of a run's records), long_run (over `longest` seconds) and accepted (at most
    `accepted` failed). A run without records has failed none."""
    total = F.col(new) + F.col(failed)
    share = F.when(total > 0, F.col(failed) / total).otherwise(F.lit(0.0))
    return log.withColumns({"failed_share": share, "high_failure": share > most_failed, "long_run": seconds > longest, "accepted": share <= accepted})


def report(as_of: str, **sections: DataFrame) -> DataFrame:
    """One report: generated_at, section, metric, value, from sections that hold (metric, value)."""
    parts = [s.select(F.lit(as_of).cast("timestamp").alias("generated_at"), F.lit(k).alias("section"), "metric", F.col("value").cast("double").alias("value")) for k, s in sections.items()]
    return reduce(DataFrame.unionByName, parts)
