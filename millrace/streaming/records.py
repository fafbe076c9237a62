"""The record pipeline on streams: dedup within a time to live, and merges by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, merge, metrics
from ..plans import admissions
from ..schemas import SCORE_KEY
from ..sources import tables
from ..sources.store import Spec, Store


def dedup_stream(df: DataFrame, keys: list[str], time: str, ttl: str = "24 hours") -> DataFrame:
    """The first row of a key within ttl of event time. A timestamp without a zone is read in the session's."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, ttl).dropDuplicatesWithinWatermark(keys)


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Give all that is there to sink(batch, id) and end; the reader's maxFilesPerTrigger bounds a batch. The sink must be idempotent for a batch id, since a batch that fails is run again."""
    q = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def to_versions(path: str, keys: list[str], order: list[str], as_of: str, needed: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A sink that writes each micro-batch once, first row a key, with a log row beside it: the rows stored, those that lack a needed
    field and so fail, and the status. A batch that runs again writes over its own folder, so that nothing is stored twice."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        good, bad = merge.usable(batch, needed or [])
        dedup.first_wins(good, keys, order).write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        done = batch.sparkSession.read.parquet(f"{path}/rows/batch={batch_id}")
        log = done.agg(F.count(F.lit(1)).alias("records_new")).join(F.broadcast(bad.agg(F.count(F.lit(1)).alias("records_failed"))))
        log = log.select(F.lit(as_of).cast("timestamp").alias("as_of"), metrics.run_status(F.col("records_failed")).alias("status"), "records_new", "records_failed")
        log.write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")

    return sink


#: What a run of the score pipeline keeps from batch to batch.
SCORE_TABLES = {
    "scores": Spec("university_id string, major_id string, year smallint, admission_method string, subject_combination string, cutoff_score decimal(5,2), quota bigint, note string, scraped_at timestamp, source_url string", tuple(SCORE_KEY)),
    "universities": Spec("id string, university_code string, name string, university_type string, region string, is_active boolean", ("university_code",)),
    "majors": Spec("id string, major_code string, name string, major_group_code string, study_duration smallint, degree_level string, is_active boolean", ("id",)),
}


def score_store(spark: SparkSession, path: str) -> Store:
    return Store(spark, path, SCORE_TABLES)


def to_admissions(path: str, spider: str, as_of: str, policy: str = "skip", **options) -> Callable[[DataFrame, int], None]:
    """A sink that takes each micro-batch of raw score records through the whole plan into the store at `path`, and writes a row of the run
    log. Only the buckets that the batch's keys fall into are read for the merge and written; one manifest makes scores and both
    dimensions current at once. A batch that runs again starts from the same manifest and writes its own anew; a batch that fails
    leaves all three tables as they were."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, version = batch.sparkSession, f"{batch_id:010d}"
        store = score_store(spark, path)
        old = store.manifest(before=version)
        read = {k: store.read(k, old) for k in SCORE_TABLES}
        out = admissions.prepare(batch, read["scores"], read["universities"], read["majors"], as_of, [admissions.cut(f"{path}/rows/batch={batch_id}")], **options)
        rows = out["rows"]
        new = tables.rewritten(admissions.ready_scores(rows, as_of), f"{path}/ready/batch={batch_id}")
        files, counts = {}, {}

        def keep_stored(stored: DataFrame, made: DataFrame) -> DataFrame:
            """Rows made on the fly come in only where their id is not there."""
            return stored.unionByName(made.join(stored.select("id"), "id", "left_anti"), allowMissingColumns=True)

        action = F.col("action")
        files["universities"], _ = store.write("universities", version, old, admissions.new_universities(rows), keep_stored)
        files["majors"], _ = store.write("majors", version, old, admissions.new_majors(rows), keep_stored)
        files["scores"], counts = store.write(
            "scores", version, old, new, lambda stored, ready: admissions.merge_scores(stored, ready, policy),
            records_new=F.count_if(action == "inserted"), records_updated=F.count_if(action == "updated"),
        )
        failed = out["dropped"].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records_failed"))
        counted = failed.select(F.lit(counts["records_new"]).alias("records_new"), F.lit(counts["records_updated"]).alias("records_updated"), "records_failed")
        without = [k for k, used in (("names", options.get("names")), ("cache", options.get("cached")), ("table", options.get("use_table"))) if used is None or used is False]
        log = metrics.run_row(counted, spider, as_of, as_of, "stream", without=without).withColumns({"id": F.concat(F.lit(f"{spider}-"), F.lit(version)), "buckets": F.lit(counts["buckets"])})
        log.write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")
        store.commit(version, files)

    return sink
