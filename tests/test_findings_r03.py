"""Whole results of queries that were found to do less, and the shapes on which lookups took too long."""

import re
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from millrace.operators import grams, resolve, similar
from millrace.plans import admissions
from millrace.plans import queries as Q


def test_exists_anti_takes_every_order(spark, tmp_path):
    spark.createDataFrame([(k,) for k in range(4)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(5, 0, "P"), (6, 1, "P"), (9, 2, "O")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    assert [r["c_custkey"] for r in Q.QUERIES["exists_anti"](spark, str(tmp_path)).collect()] == [3]


def test_names_with_running_numbers_are_joined_by_signatures(spark):
    entries = sorted({f"Customer#{n:05d}" for k in range(60) for n in (k * 131 % 1000, int(str(k * 131 % 1000 + 10000)[:0:-1]))}) + ["ab", "aba", "ab"]
    keys = sorted({e + "x" for e in entries} | {e[:4] + e[5:] for e in entries} | {e[:-2] + e[-1] + e[-2] for e in entries} | {"", "zz"})
    names = spark.createDataFrame([(e, f"v{k}", k) for k, e in enumerate(entries)], "key string, value string, ord int")
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for cutoff in (0.95, 0.9, 0.8):
        want = {}
        for k in keys:
            scored = [(SequenceMatcher(None, k, e).ratio(), -i) for i, e in enumerate(entries) if k]
            r, i = max(scored, default=(0, 0))
            want[k] = (f"v{-i}", r) if r >= cutoff else (None, None)
        got = similar.best_match(df, "k", names, cutoff)
        assert {x["k"]: (x["match"], x["ratio"]) for x in got.collect()} == want
        assert cutoff < 0.9 or "CoGroup" not in got._jdf.queryExecution().executedPlan().toString()


def test_only_sought_grams_are_indexed_and_repeated_rows_all_rank(spark):
    kws = ["ring", "1234", "234567", "7", "r_ng", "big b", "345"]
    rows = [(n, str(c)) for c in range(1234560, 1234600) for n in ("big bolt", "ring 7", "ring 345")] + [("ring 7", "1234567")] * 2 + [("ring 345", None), (None, "345"), ("bolt", "345")]
    got = grams.ilike_top(spark.createDataFrame([(k,) for k in kws], "kw string"), "kw", spark.createDataFrame(rows, "name string, code string"), "name", "code", 3, block=20).collect()
    for k in kws:
        p = re.compile(k.replace("_", "."))
        hits = [(n is not None, len(n or ""), c is not None, c or "", n or "") for n, c in rows if p.search(n or "") or p.search(c or "")]
        assert [(x["name"] or "", x["code"] or "") for x in sorted((x for x in got if x["kw"] == k), key=lambda x: x["rank"])] == [(h[4], h[3]) for h in sorted(hits)[:3]], k
    df = spark.createDataFrame([(f"{c}",) for c in range(1000000, 1000200)], "t string")
    listed, _ = grams.postings(df, F.col("t"), [3, 6], spark.createDataFrame([("000199",), ("xyz",)], "gram string"))
    assert [(r["t"], r["gram"]) for r in listed.collect()] == [("1000199", "000199")]


def test_rows_of_one_file_part_are_dealt_over_tasks(spark, tmp_path):
    spark.range(0, 1000, 1, 1).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(0, 1000, 1, 1).select(F.col("id").alias("o_orderkey"), (F.col("id") % 25).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    for name in ("sql_table_rows", "ministry_rows", "normalize_scores"):
        assert Q.QUERIES[name](spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 4


def test_names_are_resolved_once_each(spark):
    names = spark.createDataFrame([("ky thuat", "C1", 0), ("", "none", 1)], "key string, value string, ord int")
    df = spark.createDataFrame([(1, "Kỹ Thuật"), (2, "Kỹ Thuật"), (3, None), (4, ""), (5, "ky thuatt"), (6, "zzz")], "id int, name string")
    got = resolve.code_of_name(df, "name", names)
    assert got.columns == ["id", "name", "code"]
    assert {r["id"]: r["code"] for r in got.collect()} == {1: "C1", 2: "C1", 3: "none", 4: "none", 5: "C1", 6: None}


def test_rows_can_be_cut_between_dedup_and_resolution():
    stages = [s[1] for s in sorted([*admissions.score_stages("2024-01-01"), admissions.cut("x", 310)], key=lambda s: s[0])]
    assert stages == ["validate", "normalise", "dedup", "cut", "resolve", "store"]
