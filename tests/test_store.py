"""The bucketed store, runs with retry, state with a time to live, counters on the way, streaks."""

import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.operators import merge, metrics
from millrace.sources.store import Spec, Store
from millrace.streaming import records, runs, state


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "s"), {"a": Spec("k long, v string", ("k",), 8), "b": Spec("k long, n long", ("k",), 4)})


def upsert(stored, changes):
    return merge.merge(stored, changes, ["k"], [c for c in changes.columns if c != "k"], "overwrite")


def put(store, version, before=None, **changes):
    old = store.manifest(before=before or version)
    files, counts = dict(old), {}
    for t, df in changes.items():
        files[t], counts[t] = store.write(t, version, old, df, upsert, new=F.count_if(F.col("action") == "inserted"), updated=F.count_if(F.col("action") == "updated"))
    store.commit(version, files)
    return counts


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_only_touched_buckets_are_written(spark, store, tmp_path):
    first = put(store, "0001", a=spark.range(100).selectExpr("id as k", "'x' as v"), b=spark.range(10).selectExpr("id as k", "id as n"))
    assert first["a"] == {"buckets": 8, "new": 100, "updated": 0}
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "a").rglob("*.parquet")}
    second = put(store, "0002", a=spark.createDataFrame([(3, "y"), (200, "z")], "k long, v string"))
    assert second["a"]["new"] == 1 and second["a"]["updated"] == 1 and 1 <= second["a"]["buckets"] <= 2
    assert rows(store.read("a")) == sorted([(k, "y" if k == 3 else "x") for k in range(100)] + [(200, "z")])
    assert all(p.stat().st_mtime_ns == t for p, t in kept.items())
    new = {p.parent.name for p in (tmp_path / "s" / "a" / "v=0002").rglob("*.parquet")}
    assert len(new) == second["a"]["buckets"]
    # An earlier version stays readable; a scan of some buckets reads no others.
    assert rows(store.read("a", store.manifest(before="0002"))) == [(k, "x") for k in range(100)]
    some = store.of_keys("a", spark.createDataFrame([(3,)], "k long"))
    assert len({f.split("__bucket=")[1].split("/")[0] for f in some.inputFiles()}) == 1 and (3, "y") in rows(some)
    assert store.vacuum() == second["a"]["buckets"] and store.versions() == ["0002"] and store.read("a").count() == 101
    assert put(store, "0003", a=spark.createDataFrame([], "k long, v string"))["a"] == {"buckets": 0, "new": 0, "updated": 0}


def test_a_killed_batch_leaves_all_tables(spark, store):
    put(store, "0001", a=spark.range(5).selectExpr("id as k", "'x' as v"), b=spark.range(5).selectExpr("id as k", "id as n"))
    before = rows(store.read("a")), rows(store.read("b"))
    old = store.manifest(before="0002")
    store.write("a", "0002", old, spark.range(5).selectExpr("id as k", "'new' as v"), upsert)  # and killed here, between two tables
    assert (rows(store.read("a")), rows(store.read("b"))) == before
    for _ in range(2):  # run again, twice
        put(store, "0002", a=spark.range(5).selectExpr("id as k", "'new' as v"), b=spark.range(3).selectExpr("id as k", "9L as n"))
        assert rows(store.read("a")) == [(k, "new") for k in range(5)] and rows(store.read("b")) == [(0, 9), (1, 9), (2, 9), (3, 3), (4, 4)]


def test_stream_of_scores_fails_between_tables_and_goes_on(spark, tmp_path, monkeypatch):
    schema = "ingest_seq int, " + ", ".join(f"{n} string" for n in ("university_code", "major_name_raw", "major_code", "year", "admission_method", "subject_combination", "cutoff_score", "quota", "note", "scraped_at", "source_url"))
    row = ("qsb", "Luật", "7380101", "2024", "THPT", "A00", "25", "50", None, None, None)
    at = str(tmp_path)
    table = records.score_store(spark, f"{at}/out")

    def feed(*new):
        spark.createDataFrame([(k, *r) for k, r in enumerate(new)], schema).write.mode("append").parquet(f"{at}/in")
        records.run_available(spark.readStream.schema(schema).parquet(f"{at}/in"), records.to_admissions(f"{at}/out", "s", "2024-01-01", "overwrite"), f"{at}/progress")

    feed(row, row[:3] + ("x",) + row[4:])
    assert [table.read(t).count() for t in ("scores", "universities", "majors")] == [1, 1, 1]
    whole = Store.write

    def broken(self, name, *a, **k):
        if name == "scores":
            raise RuntimeError("killed")
        return whole(self, name, *a, **k)

    monkeypatch.setattr(Store, "write", broken)
    other = ("bka", "Toán", "7460101", *row[3:])
    with pytest.raises(Exception, match="killed"):
        feed(other)
    assert [table.read(t).count() for t in ("scores", "universities", "majors")] == [1, 1, 1]
    monkeypatch.setattr(Store, "write", whole)
    feed(row[:6] + ("26",) + row[7:])  # the batch that failed runs first, from the checkpoint
    assert [table.read(t).count() for t in ("scores", "universities", "majors")] == [2, 2, 2]
    assert sorted(str(r[0]) for r in table.read("scores").select("cutoff_score").collect()) == ["25.00", "26.00"]
    log = {r["id"]: r for r in spark.read.parquet(f"{at}/out/log").collect()}
    assert {r["error_summary"] for r in log.values()} == {"without names, cache, table"}
    assert [(r["status"], r["records_new"], r["records_updated"], r["records_failed"]) for _, r in sorted(log.items())] == [("partial", 1, 0, 1), ("success", 1, 0, 0), ("success", 0, 1, 0)]


def test_retry_is_told_in_the_log(spark, tmp_path):
    at = str(tmp_path)
    spark.range(10).write.parquet(f"{at}/in")
    fails, waits = [2], []

    def sink(batch, batch_id):
        if fails[0]:
            fails[0] -= 1
            raise RuntimeError("the sink is down")
        batch.write.mode("overwrite").parquet(f"{at}/out")

    def start(name):
        return spark.readStream.schema("id long").parquet(f"{at}/in").writeStream.queryName(name).foreachBatch(sink).option("checkpointLocation", f"{at}/cp").trigger(availableNow=True).start()

    def slept(s):
        (waits.append(s) if s >= 0.5 else time.sleep(s))

    assert runs.run_with_retry(spark, "scores", start, f"{at}/log", tries=3, wait=1, sleep=slept) == "success"
    assert waits == [1, 2] and spark.read.parquet(f"{at}/out").count() == 10
    log = runs.read_log(spark, f"{at}/log")
    assert sorted((r["attempt"], r["status"]) for r in log.collect()) == [(1, "failed"), (1, "running"), (2, "failed"), (2, "running"), (3, "running"), (3, "success")]
    assert all("the sink is down" in r["error_summary"] for r in log.where("status = 'failed'").collect())
    assert log.where("status = 'success'").first()["rows_in"] == 10
    fails[0] = 9
    spark.range(3).write.mode("append").parquet(f"{at}/in")
    assert runs.run_with_retry(spark, "scores", start, f"{at}/log2", tries=2, sleep=slept) == "failed"
    last = runs.last_status(runs.read_log(spark, f"{at}/log2")).first()
    assert (last["starts"], last["status"]) == (2, "failed") and "the sink is down" in last["error_summary"]


def test_ttl_lets_a_key_through_again(spark, tmp_path):
    at = str(tmp_path)

    def go(rows_, ttl):
        spark.createDataFrame(rows_, "k string, n int").coalesce(1).write.mode("append").parquet(f"{at}/in")
        with state.with_state(spark):
            out = state.tiers_with_ttl(spark.readStream.schema("k string, n int").parquet(f"{at}/in"), ["k"], ttl, buckets=4)
            out.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/cp").trigger(availableNow=True).start().awaitTermination()
        return {(r["n"], r["tier"]) for r in spark.read.parquet(f"{at}/out").collect()}

    ttl = 25_000
    assert go([("a", 1), (None, 2), (None, 3), ("b", 4)], ttl) - {(2, "passed"), (3, "batch"), (3, "passed"), (2, "batch")} == {(1, "passed"), (4, "passed")}
    began = time.time()
    second = go([("a", 5), (None, 6), ("c", 7)], ttl)
    assert {(5, "state"), (6, "state"), (7, "passed")} <= second
    time.sleep(max(0, 27 - (time.time() - began)))
    assert (8, "passed") in go([("a", 8)], ttl)


def test_counters_on_the_way(spark, tmp_path):
    seen = Observation()
    metrics.observed(spark.range(10), seen, even=F.col("id") % 2 == 0).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}
    spark.range(10).write.parquet(f"{tmp_path}/in")
    q = metrics.observed(spark.readStream.schema("id long").parquet(f"{tmp_path}/in"), "c", odd=F.col("id") % 2 == 1).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert metrics.observations([p if isinstance(p, dict) else p for p in q.recentProgress], "c") == {"rows": 10, "odd": 5}


def test_streak_by_ranges(spark):
    import random

    r = random.Random(1)
    bad = [r.random() < 0.7 for _ in range(200)] + [True] * 60 + [False]
    df = spark.createDataFrame([(k, b) for k, b in enumerate(bad)], "day int, b boolean")
    for ranges in (1, 5, 40, 300):
        got = {x["day"]: x["alert"] for x in metrics.streak(df, "day", F.col("b"), 3, ranges).collect()}
        assert got == {k: k >= 2 and all(bad[k - 2 : k + 1]) for k in range(len(bad))}
    assert metrics.streak(df.limit(0), "day", F.col("b")).count() == 0
