"""Registered queries of the operators with a structure or state of their own: the bucketed store, gram index, similarity join, automaton,
state with a time to live, counters on the way, runs with retry, range scans, page source, indexes and sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import grams, keywords, merge, metrics, rules, similar, sketches
from ..sources import pages as P
from ..sources import runs as scan_runs
from ..sources import tables
from ..sources.store import Spec, Store
from ..streaming import runs, state
from .queries import _REASON, query
from .queries import _records as records_of


@query("""
SELECT 'customers' AS part, c_custkey AS k, CASE WHEN c_nationkey = 3 THEN 'moved' ELSE c_mktsegment END AS v FROM customer
UNION ALL SELECT 'customers', c_custkey + 10000000, 'new' FROM customer WHERE c_nationkey = 4
UNION ALL SELECT 'nations', n_nationkey, CASE WHEN n_nationkey = 7 THEN 'x' ELSE n_name END FROM nation
UNION ALL SELECT 'before', c_custkey, c_mktsegment FROM customer""")
def store_increments(t):
    """Two tables through three commits: all rows, rows that change and come in, and a batch that is killed between the tables."""
    c, n = t("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"), "c_nationkey"), t("nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("v"))
    spark = c.sparkSession
    store = Store(spark, tables.scratch(spark, "store"), {"customers": Spec("k long, v string", ("k",), 32), "nations": Spec("k long, v string", ("k",), 4)})

    def put(version: str, killed: bool = False, **changes: DataFrame) -> None:
        old = store.manifest(before=version)
        files = dict(old)
        for name, df in changes.items():
            files[name], _ = store.write(name, version, old, df, lambda a, b: merge.merge(a, b, ["k"], ["v"], "overwrite"))
        if not killed:
            store.commit(version, files)

    put("0001", customers=c.select("k", "v"), nations=n)
    changed = c.where("c_nationkey = 3").select("k", F.lit("moved").alias("v")).unionByName(c.where("c_nationkey = 4").select((F.col("k") + 10_000_000).alias("k"), F.lit("new").alias("v")))
    put("0002", customers=changed, nations=n.where("k = 7").withColumn("v", F.lit("x")))
    put("0003", killed=True, customers=c.select("k", F.lit("lost").alias("v")))
    out = [store.read(name).select(F.lit(name).alias("part"), "k", "v") for name in ("customers", "nations")]
    return out[0].unionByName(out[1]).unionByName(store.read("customers", store.manifest(before="0002")).select(F.lit("before").alias("part"), "k", "v"))


@query("""
WITH k AS (SELECT DISTINCT p_name[3:6] AS kw FROM part UNION SELECT DISTINCT p_name[1] || '%' || p_name[-2:] FROM part WHERE p_partkey % 50 = 0 UNION SELECT '__' UNION SELECT p_name[1:2] FROM part WHERE p_partkey % 10 = 0 UNION SELECT '' || p_partkey FROM part WHERE p_partkey % 7 = 0),
h AS (SELECT kw, p_name AS name, '' || p_partkey AS code, row_number() OVER (PARTITION BY kw ORDER BY length(p_name), '' || p_partkey) AS rank FROM k JOIN part ON p_name ILIKE '%' || trim(kw) || '%' OR '' || p_partkey LIKE '%' || trim(kw) || '%')
SELECT kw, name, code, rank FROM h WHERE rank <= 3""")
def ilike_grams(t):
    p, name, key = t("part"), F.col("p_name"), F.col("p_partkey")
    parts = [p.select(F.substring(name, 3, 4)), p.where(key % 50 == 0).select(F.concat(F.substring(name, 1, 1), F.lit("%"), F.right(name, F.lit(2)))), p.select(F.lit("__")).distinct(), p.where(key % 10 == 0).select(F.substring(name, 1, 2)), p.where(key % 7 == 0).select(key.cast("string"))]
    kw = parts[0].toDF("kw")
    for x in parts[1:]:
        kw = kw.union(x.toDF("kw"))
    dim = p.select(name.alias("name"), key.cast("string").alias("code"))
    return grams.ilike_top(kw, "kw", dim, "name", "code", 3).select("kw", "name", "code", F.col("rank").cast("bigint").alias("rank"))


@query("SELECT c_name || 'x' AS k, '' || c_custkey AS match, 2.0::DOUBLE * length(c_name) / (2 * length(c_name) + 1) AS ratio FROM customer")
def similar_names(t):
    c = t("customer")
    names = c.select(F.col("c_name").alias("key"), F.col("c_custkey").cast("string").alias("value"), F.col("c_custkey").alias("ord"))
    return similar.best_match(c.select(F.concat("c_name", F.lit("x")).alias("k")), "k", names, 0.95)


@query("""
WITH k AS (SELECT item_id, string_split(lower(text), ' ')[3] AS word FROM benchmark)
SELECT doc_id, (SELECT 'p' || min(item_id) FROM k WHERE contains(lower(d.text), word)) AS types FROM documents d""")
def profiles_by_automaton(t):
    b = t("benchmark").select(F.col("item_id").cast("int").alias("ord"), F.concat(F.lit("p"), F.col("item_id").cast("string")).alias("types"), F.array(F.try_element_at(F.split(F.lower("text"), " "), F.lit(3))).alias("keywords"))
    return keywords.first_profile(t("documents").select("doc_id", F.lower("text").alias("t")), F.col("t"), b).select("doc_id", "types")


@query("""
SELECT 'first' AS start, 'passed' AS tier, count(DISTINCT user_id) AS n FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 'first', 'batch', count(*) - count(DISTINCT user_id) FROM events WHERE event_id % 2 = 0
UNION ALL SELECT 'second', 'passed', count(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 2 = 0)
UNION ALL SELECT 'second', 'state', count(*) FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_id % 2 = 0)
UNION ALL SELECT 'second', 'batch', count(*) - count(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 2 = 0)""")
def ttl_tiers(t):
    """Events by user in two starts on one checkpoint, one file and so one micro-batch each; the state outlives the first."""
    e = t("events").select("event_id", "user_id")
    spark, at = e.sparkSession, tables.scratch(e.sparkSession, "ttl")
    for part, rows in (("first", e.where("event_id % 2 = 0")), ("second", e)):
        rows.withColumn("start", F.lit(part)).write.mode("append").parquet(f"{at}/in")
        with state.with_state(spark):
            fed = spark.readStream.schema("event_id long, user_id long, start string").parquet(f"{at}/in")
            state.tiers_with_ttl(fed, ["user_id"], 3_600_000).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/progress").trigger(availableNow=True).start().awaitTermination()
    counted = spark.read.schema("event_id long, user_id long, start string, tier string").parquet(f"{at}/out").groupBy("start", "tier").agg(F.count(F.lit(1)).alias("n"))
    return union_with_zero(counted)


def union_with_zero(counted: DataFrame) -> DataFrame:
    """Every tier of both starts, those without rows as 0."""
    spark = counted.sparkSession
    every = spark.createDataFrame([("first", "passed"), ("first", "batch"), ("second", "passed"), ("second", "state"), ("second", "batch")], "start string, tier string")
    return every.join(counted, ["start", "tier"], "left").select("start", "tier", F.coalesce("n", F.lit(0)).alias("n"))


_REASONS = ["university_code missing", "major_name_raw missing", "year not an integer", "year out of range"]


@query(f"""
SELECT 'rows' AS counter, count(*) AS n FROM orders UNION ALL SELECT r, (SELECT count(*) FROM orders WHERE ({_REASON}) = r) FROM (VALUES {", ".join(f"('{r}')" for r in _REASONS)}) v(r)
UNION ALL SELECT 'written', count(*) FROM orders WHERE ({_REASON}) IS NULL""")
def counters_on_the_way(t):
    """Drop reasons counted by the plan that writes the rows: one job gives both."""
    raw = records_of(t)
    at, seen = tables.scratch(raw.sparkSession, "observed"), Observation()
    checked = metrics.observed(rules.validate(raw, rules.score_rules("2024-01-01")), seen, **{r: F.col("drop_reason") == r for r in _REASONS})
    rules.passed(checked).write.parquet(at)
    got = raw.sparkSession.createDataFrame([(k, n) for k, n in seen.get.items()], "counter string, n long")
    return got.unionByName(raw.sparkSession.read.parquet(at).agg(F.lit("written").alias("counter"), F.count(F.lit(1)).alias("n")))


@query("""
SELECT 1 AS attempt, 'failed' AS status, CAST(0 AS BIGINT) AS rows_in, true AS told UNION ALL SELECT 1, 'running', 0, false UNION ALL SELECT 2, 'running', 0, false UNION ALL SELECT 2, 'success', count(*), false FROM orders
UNION ALL SELECT 0, 'stored', count(*), false FROM orders""")
def retried_run(t):
    """A stream whose sink fails once: the log has both starts and ends, and the rows are stored once."""
    o = t("orders").select("o_orderkey")
    spark, at, fails = o.sparkSession, tables.scratch(o.sparkSession, "retry"), [1]
    o.write.parquet(f"{at}/in")

    def sink(batch, batch_id):
        if fails[0]:
            fails[0] -= 1
            raise OSError("the sink is down")
        batch.write.mode("overwrite").parquet(f"{at}/out/batch={batch_id}")

    def start(name):
        return spark.readStream.schema(o.schema).parquet(f"{at}/in").writeStream.queryName(name).foreachBatch(sink).option("checkpointLocation", f"{at}/progress").trigger(availableNow=True).start()

    runs.run_with_retry(spark, "orders", start, f"{at}/log", tries=3, wait=0.1)
    log = runs.read_log(spark, f"{at}/log").select("attempt", "status", "rows_in", F.coalesce(F.contains("error_summary", F.lit("the sink is down")), F.lit(False)).alias("told"))
    stored = spark.read.parquet(f"{at}/out").agg(F.count(F.lit(1)).alias("rows_in"))
    return log.unionByName(stored.select(F.lit(0).alias("attempt"), F.lit("stored").alias("status"), "rows_in", F.lit(False).alias("told")))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END AS bad, sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) OVER (ORDER BY o_orderkey ROWS 2 PRECEDING) = 3 AS alert FROM orders")
def streak_by_ranges(t):
    return metrics.streak(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", F.col("o_orderstatus") != "F").select("o_orderkey", "bad", "alert")


@query("SELECT n_nationkey, 'fi 1 ky ' || n_name || ' dA' AS plain FROM nation")
def accents_compatible(t):
    return t("nation").select("n_nationkey", T.strip_accents_compat(F.concat(F.lit("ﬁ ① kỹ "), "n_name", F.lit(" đＡ")), True).alias("plain"))


_PAGES = "SELECT page_id, url, html, CAST(2020 + page_id % 5 AS INTEGER) AS year, 'C' || page_id % 7 AS code FROM pages"


@query(f"SELECT page_id, year, code, length(html) AS n FROM ({_PAGES}) WHERE year IN (2021, 2023) AND code = 'C3'")
def paged_scan(t):
    """Stored pages of two years and a code, by the page source: only their partitions are read."""
    p = t("pages")
    at = tables.scratch(p.sparkSession, "pages")
    P.store(p.withColumns({"year": (2020 + F.col("page_id") % 5).cast("int"), "code": F.concat(F.lit("C"), (F.col("page_id") % 7).cast("string"))}), at, 0)
    scans = {"moet": lambda run: P.scan(p.sparkSession, at, run.years, run.codes), "sites": lambda run: P.scan(p.sparkSession, at).limit(0)}
    return scan_runs.dispatch(scan_runs.parse(" MOET ", "2021,2023", "c3"), scans).select("page_id", "year", "code", F.length("html").cast("bigint").alias("n"))


@query(f"SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 0 ELSE 1 END AS part, code FROM ({_PAGES}) WHERE year <= 2022")
def paged_stream(t):
    """Stored pages as a stream: what is there, then what has come since, from the offset of the checkpoint."""
    p = t("pages").withColumns({"year": (2020 + F.col("page_id") % 5).cast("int"), "code": F.concat(F.lit("C"), (F.col("page_id") % 7).cast("string"))})
    spark, at = p.sparkSession, tables.scratch(p.sparkSession, "page-stream")
    for part in (0, 1):
        P.store(p.where(F.col("page_id") % 2 == part), f"{at}/pages", part)
        q = P.stream(spark, f"{at}/pages", [2020, 2021, 2022]).withColumn("part", F.lit(part)).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/progress").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.parquet(f"{at}/out").select("page_id", "part", "code")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) IN (1995, 1996) AND o_custkey IN (1, 4, 7, 10, 13, 16, 19, 22, 25, 28)")
def scan_indexed(t):
    o = t("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    at = tables.scratch(o.sparkSession, "indexed")
    tables.write_indexed(o, at, "year", "o_custkey", 16)
    return tables.scan_indexed(o.sparkSession, at, "year", [1995, 1996], "o_custkey", list(range(1, 30, 3)), 16).select("o_orderkey", "o_custkey")


@query("""
SELECT c_mktsegment, count(*) AS n, min(c_acctbal) AS low, max(c_acctbal) AS high, true AS middle_close, true AS nations_close FROM customer GROUP BY 1""")
def merged_sketches(t):
    """Medians and distinct counts from sketches that each batch stored and none of which was computed anew, held against the exact ones."""
    c = t("customer")
    at = tables.scratch(c.sparkSession, "sketches")
    for batch in range(4):
        sketches.add(c.where(F.col("c_custkey") % 4 == batch), ["c_mktsegment"], "c_acctbal", "c_nationkey", at, batch)
    got = sketches.merged(c.sparkSession, at, ["c_mktsegment"])
    exact = c.join(got.select("c_mktsegment", "middle"), "c_mktsegment").groupBy("c_mktsegment").agg(F.avg((F.col("c_acctbal") <= F.col("middle")).cast("double")).alias("below"), F.avg((F.col("c_acctbal") < F.col("middle")).cast("double")).alias("under"), F.count_distinct("c_nationkey").alias("exact"))
    close = (F.col("under") <= 0.5 + sketches.RANK_ERROR) & (F.col("below") >= 0.5 - sketches.RANK_ERROR)
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.col("exact") * sketches.COUNT_ERROR
    return got.join(exact, "c_mktsegment").select("c_mktsegment", "n", "low", "high", close.alias("middle_close"), near.alias("nations_close"))
