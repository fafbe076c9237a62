"""Operators on small tables, the whole pipeline, and streams against batches."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import dedup, merge, metrics, normalize, resolve, rules
from millrace.plans import admissions
from millrace.sources import html, tables
from millrace.streaming import records


@pytest.fixture
def score_rows(spark):
    good = {"university_code": "qsb", "major_name_raw": "Ngành: Luật", "year": "2024", "admission_method": "học bạ", "subject_combination": "a00", "cutoff_score": "25.567", "quota": "50"}
    rows = [good, good | {"cutoff_score": "20"}, good | {"university_code": " "}, good | {"year": "x"}, good | {"year": "2017"}, good | {"major_name_raw": None}, good | {"subject_combination": "D01", "cutoff_score": "150"}]
    schema = "ingest_seq int, " + ", ".join(f"{n} string" for n in ("university_code", "major_name_raw", "major_code", "year", "admission_method", "subject_combination", "cutoff_score", "quota", "note", "scraped_at", "source_url"))
    return spark.createDataFrame([(k, *(r.get(n) for n in ("university_code", "major_name_raw", "major_code", "year", "admission_method", "subject_combination", "cutoff_score", "quota", "note", "scraped_at", "source_url"))) for k, r in enumerate(rows)], schema)


def test_validation_reasons(score_rows):
    got = {r["drop_reason"]: r["n"] for r in rules.drop_counts(rules.validate(score_rows, rules.score_rules("2024-01-01"))).collect()}
    assert got == {"university_code missing": 1, "year not an integer": 1, "year out of range": 1, "major_name_raw missing": 1}


def test_pipeline_is_idempotent(spark, score_rows):
    stored = spark.createDataFrame([], "university_id string, major_id string, year smallint, admission_method string, subject_combination string, cutoff_score decimal(5,2), quota bigint, note string, scraped_at timestamp, source_url string")
    u = spark.createDataFrame([], "id string, university_code string, name string, university_type string, region string, is_active boolean")
    m = spark.createDataFrame([], "id string, major_code string, name string, major_group_code string, study_duration smallint, degree_level string, is_active boolean")
    out = admissions.run(score_rows, stored, u, m, "2024-01-01")
    scores = out["scores"].collect()
    assert len(scores) == 2 and {str(r["cutoff_score"]) for r in scores} == {"25.57", "None"}
    assert out["universities"].count() == 1 and out["majors"].count() == 1
    again = admissions.run(score_rows, out["scores"].drop("action"), out["universities"], out["majors"], "2024-01-01")
    assert again["counters"].first()["new"] == 0
    assert {r["action"] for r in again["scores"].collect()} == {"unchanged"}


def test_normalize_university_and_major(spark):
    u = spark.createDataFrame([("hust", "Công lập", "Miền Bắc", "1956")], "short_name string, university_type string, region string, established_year string")
    for c in "university_code name province address website admission_url logo_url source_url tuition_min tuition_max".split():
        u = u.withColumn(c, F.lit(None).cast("string"))
    r = normalize.universities(u).first()
    assert (r["short_name"], r["university_type"], r["region"], r["established_year"]) == ("HUST", "public", "north", 1956)
    m = spark.createDataFrame([("7480201", "ngành: cntt", "11", "kỹ sư", ["r", "X"], ["A00", "a00", "?"], [" a ", "a", ""])], "major_code string, name string, study_duration string, degree_level string, holland_types array<string>, subject_combinations array<string>, career_options array<string>")
    m = m.withColumn("description", F.lit(None).cast("string")).withColumn("required_skills", F.col("career_options")).withColumn("career_anchor_tags", F.col("career_options"))
    r = normalize.majors(m).first()
    assert (r["name"], r["study_duration"], r["degree_level"], r["holland_types"], r["subject_combinations"], r["career_options"]) == ("Cntt", None, "engineer", ["R"], ["A00", "KHAC"], ["a"])


def test_merge_policies(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    new = spark.createDataFrame([(1, None, 9), (3, "c", 3)], "k int, s string, n int")
    got = {p: sorted((r["k"], r["s"], r["n"], r["action"]) for r in merge.merge(old, new, ["k"], ["s", "n"], p).collect()) for p in merge.POLICIES}
    assert got["skip"] == [(1, "a", 1, "unchanged"), (2, "b", 2, "kept"), (3, "c", 3, "inserted")]
    assert got["coalesce"][0] == (1, "a", 9, "updated") and got["overwrite"][0] == (1, None, 9, "updated")


def test_fuzzy_takes_the_first_best(spark):
    names = spark.createDataFrame([("kỹ thuật điện", "1", 0), ("kỹ thuật điện tử", "2", 1)], "key string, value string, ord int")
    df = spark.createDataFrame([("Ngành: Kỹ thuật điện",), ("ky thuat đien tu",), ("kỹ thuật đin",), ("khác hẳn",)], "name string")
    got = [r["code"] for r in resolve.code_of_name(df, "name", names).orderBy("name").collect()]
    assert sorted(map(str, got)) == ["1", "1", "2", "None"]


def test_page_tables(spark):
    page = "<h3>Điểm chuẩn năm 2024 học bạ</h3><table><tbody><tr><td>Luật</td><td>A00, D01</td><td>25,5</td></tr><tr><td>x</td><td>3 cells only</td></tr><tr><td>Y<td><td>--</table>"
    pages = spark.createDataFrame([("u", page)], "url string, html string")
    got = html.detail_scores(pages, F.lit("QSB"), 2025, [2024]).collect()
    assert [(r["major_name_raw"], r["subject_combination"], r["admission_method"], str(r["cutoff_score"])) for r in got] == [("Luật", "A00", "hoc_ba", "25.50"), ("Luật", "D01", "hoc_ba", "25.50"), ("Y", "KHAC", "hoc_ba", "None")]
    rows = "<table><tbody><tr><td>qsb</td><td>BK</td><td>7480103</td><td>KTPM</td><td>A00</td><td>≥ 22.50</td></tr><tr><td>BAD</td><td>1</td></tr></tbody></table>"
    r = html.ministry_scores(spark.createDataFrame([("u", rows)], "url string, html string")).collect()
    assert [(x["university_code"], x["major_code"], x["cutoff_score"]) for x in r] == [("QSB", "7480103", "22.50")]


def test_versioned_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    tables.write_version(spark.range(3).toDF("x"), path, "1")
    tables.write_version(spark.range(5).toDF("x"), path, "2")
    assert tables.read_version(spark, path).count() == 5 and tables.read_version(spark, path, "1").count() == 3
    assert tables.masked("postgresql://u:secret@h/db") == "postgresql://u:***@h/db"


def test_stream_dedup_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(k % 7, f"2024-01-01 00:00:{k:02d}") for k in range(30)], "k int, t string").select("k", F.col("t").cast("timestamp").alias("t"))
    for n in (1, 2):
        df.write.mode("append").parquet(f"{tmp_path}/in")
    seen = []
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    records.run_available(records.dedup_stream(stream, ["k"], "t"), lambda b, i: seen.extend(r["k"] for r in b.collect()), f"{tmp_path}/cp")
    assert sorted(seen) == sorted(r["k"] for r in dedup.first_wins(df, ["k"], ["t"]).collect())


def test_reports(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, True)], "k int, ok boolean")
    r = metrics.coverage(df.withColumn("g", F.lit("a")), ["g"], ok=F.col("ok")).first()
    assert (r["n"], r["ok"], r["ok_pct"]) == (3, 2, 66.67)
    assert metrics.verdicts(metrics.overview(t=df), {"t": 3}).first()["verdict"] == "pass"


def test_site_tables_take_their_settings(spark):
    page = "<h3>Xét học bạ</h3><table><tr><td>1</td><td>Luật</td><td>A00</td><td>25,5</td></tr><tr><td>2</td><td></td><td>A00</td><td>20</td></tr><tr><td>3</td></tr></table>"
    pages = spark.createDataFrame([("bka", "u1", page), ("fpt", "u2", page), ("zzz", "u3", page)], "university_code string, url string, html string")
    defaults = spark.createDataFrame([(1, 2, 3)], "major_cell int, combo_cell int, score_cell int")
    own = spark.createDataFrame([("bka", 2, 3, 4), ("fpt", None, None, None)], "university_code string, major_cell int, combo_cell int, score_cell int")
    config = html.site_config(defaults, own)
    assert sorted(map(tuple, config.collect())) == [("bka", 2, 3, 4), ("fpt", 1, 2, 3)]
    got = sorted((r["university_code"], r["major_name_raw"], r["year"], r["admission_method"], r["subject_combination"], str(r["cutoff_score"])) for r in html.site_scores(pages, config, [2023, 2024]).collect())
    assert [g for g in got if g[0] == "BKA"] == [("BKA", "Luật", 2024, "hoc_ba", "A00", "25.50")]
    assert {g[1] for g in got if g[0] == "FPT"} == {"1", "2"} and not [g for g in got if g[0] == "ZZZ"]


def test_next_page(spark):
    df = spark.createDataFrame([(1, '<a href="?p=2">2</a><a href="?p=9" class="n">›</a>'), (50, '<a href="?p=9">›</a>'), (2, "")], "page int, html string")
    assert [r[0] for r in df.select(html.next_page(F.col("html"), F.col("page"))).collect()] == ["?p=9", None, None]


def test_fewest_edits_and_report(spark):
    names = spark.createDataFrame([("luat", "1", 0), ("luan", "2", 1)], "key string, value string, ord int")
    keys = spark.createDataFrame([("luax",), ("khac han",), (None,)], "k string")
    assert {r["k"]: r["match"] for r in resolve.fewest_edits(keys, "k", names, 1).collect()} == {"luax": "1", "khac han": None, None: None}
    one = spark.createDataFrame([("n", 1)], "metric string, value int")
    assert [tuple(r)[1:] for r in metrics.report("2024-01-01", a=one, b=one).collect()] == [("a", "n", 1.0), ("b", "n", 1.0)]


def test_jdbc_round_trip(spark):
    """Through the embedded database that Spark brings, in the memory of this process."""
    url = "jdbc:derby:memory:millrace;create=true"
    rows = spark.createDataFrame([(1, "Kỹ thuật"), (2, None)], "k int, s string")
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    tables.write_jdbc(rows, url, "t", "overwrite", driver=driver)
    tables.write_jdbc(rows, url, "t", driver=driver)
    assert sorted(tables.read_jdbc(spark, url, "t", driver=driver).collect(), key=str) == sorted(rows.union(rows).collect(), key=str)
    tables.write_jdbc(spark.range(1000).selectExpr("id as k", "id % 7 as v"), url, "many", "overwrite", driver=driver)
    got = tables.read_jdbc_parts(spark, url, "many", "k", 5, driver=driver)
    assert got.rdd.getNumPartitions() == 5 and got.count() == 1000 and got.agg(F.sum("v")).first()[0] == sum(k % 7 for k in range(1000))
    tables.write_jdbc(spark.range(0).selectExpr("id as k"), url, "nothing", "overwrite", driver=driver)
    assert tables.read_jdbc_parts(spark, url, "nothing", "k", 5, driver=driver).count() == 0


def test_indexed_scan_opens_few_files(spark, tmp_path):
    df = spark.range(4000).selectExpr("id % 97 as k", "cast(2018 + id % 4 as int) as year", "id", "array(concat('t', id % 50), 'all') as tags")
    tables.write_indexed(df, f"{tmp_path}/t", "year", "k", 8, ("id",))
    got = tables.scan_indexed(spark, f"{tmp_path}/t", "year", [2019], "k", [5, 11], 8)
    assert got.count() == df.where("year = 2019 and k in (5, 11)").count()
    every = len(list((tmp_path / "t").rglob("*.parquet")))
    opened = got.selectExpr("input_file_name() as f").distinct().count()
    assert opened <= 2 and every >= 32
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    tables.write_members(df, f"{tmp_path}/m", "tags", "id", 8)
    assert {r["id"] for r in tables.holding(df, f"{tmp_path}/m", "t7", "id", 8).collect()} == {k for k in range(4000) if k % 50 == 7}


def test_pages_are_pruned_and_streamed_from_their_offset(spark, tmp_path):
    from millrace.sources import pages

    df = spark.range(60).selectExpr("id as page_id", "concat('u', id) as url", "repeat('x', cast(id as int)) as html", "cast(2020 + id % 3 as int) as year", "concat('C', id % 4) as code")
    pages.store(df, f"{tmp_path}/p", 0)
    got = pages.scan(spark, f"{tmp_path}/p").where("year = 2021 and code in ('C1', 'C2') and page_id > 10")
    assert got.rdd.getNumPartitions() == 2
    assert {r["page_id"] for r in got.collect()} == {k for k in range(11, 60) if k % 3 == 1 and k % 4 in (1, 2)}
    (tmp_path / "p" / "batch=1").mkdir()  # a batch that is being written is not seen

    def run():
        pages.stream(spark, f"{tmp_path}/p", [2020]).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        return sorted(r["page_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == [k for k in range(60) if k % 3 == 0] == run()
    pages.store(df.selectExpr("page_id + 100 as page_id", "url", "html", "year", "code"), f"{tmp_path}/p", 1)
    assert run() == sorted([k for k in range(60) if k % 3 == 0] + [k + 100 for k in range(60) if k % 3 == 0])


def test_sketches_of_batches(spark, tmp_path):
    from millrace.operators import sketches

    df = spark.range(20000).selectExpr("id % 3 as g", "cast(id * 7919 % 20011 as double) as v", "id % 1000 as w")
    for b in (0, 1, 2, 1):  # a batch that runs again counts once
        sketches.add(df.where(F.pmod(F.col("v"), F.lit(3)).cast("int") == b), ["g"], "v", "w", f"{tmp_path}/s", b)
    for r in sketches.merged(spark, f"{tmp_path}/s", ["g"]).collect():
        own = sorted(x["v"] for x in df.where(f"g = {r['g']}").collect())
        assert r["n"] == len(own) and (r["low"], r["high"]) == (own[0], own[-1])
        assert abs(sum(v <= r["middle"] for v in own) / len(own) - 0.5) <= sketches.RANK_ERROR
        assert abs(r["distinct"] - len({x["w"] for x in df.where(f"g = {r['g']}").collect()})) <= 1000 * sketches.COUNT_ERROR


def test_stages_run_by_priority(spark, score_rows):
    """A caller's stage between dedup and store sees the resolved rows and may change them; tiers that are given take part."""
    stored = spark.createDataFrame([], "university_id string, major_id string, year smallint, admission_method string, subject_combination string, cutoff_score decimal(5,2), quota bigint, note string, scraped_at timestamp, source_url string")
    u = spark.createDataFrame([("u1", "QSB", "x", "public", "south", True)], "id string, university_code string, name string, university_type string, region string, is_active boolean")
    m = spark.createDataFrame([("m1", "7380101", "Luật Kinh Tế", "738", 4, "bachelor", True), ("m2", "7380107", "Luật Quốc Tế Và So Sánh", "738", 4, "bachelor", True)], "id string, major_code string, name string, major_group_code string, study_duration int, degree_level string, is_active boolean")
    note = (350, "note", lambda t: {"rows": t["rows"].withColumn("note", F.lit("seen"))})
    out = admissions.run(score_rows, stored, u, m, "2024-01-01", more=[note])
    rows = out["scores"].collect()
    assert {(r["university_id"], r["major_id"], r["note"]) for r in rows} == {("u1", "m1", "seen")} and out["majors"].count() == 2
    again = admissions.run(score_rows, out["scores"].drop("action"), u, m, "2024-01-01", use_table=True)
    assert {r["action"] for r in again["scores"].collect()} == {"kept"}
    names = spark.createDataFrame([("luật", "7380107", 0)], "key string, value string, ord int")
    coded = admissions.run(score_rows, stored, u, m, "2024-01-01", names=names)
    assert {r["major_id"] for r in coded["scores"].collect()} == {"m2"}
    keys = spark.createDataFrame([("QSB", "ngành: luật", 2024, "hoc_ba", "A00")], "k1 string, k2 string, k3 smallint, k4 string, k5 string")
    left = admissions.run(score_rows, stored, u, m, "2024-01-01", cached=keys)["scores"].collect()
    assert {r["subject_combination"] for r in left} == {"D01"}


def test_names_that_share_a_code_stay_apart(spark):
    df = spark.createDataFrame([("U", None, "Luật"), ("U", None, "LUẬT "), ("U", None, "Toán")], "university_code string, major_code string, major_name string").withColumn("university_id", F.lit("u")).withColumn("major_id", F.lit(None).cast("string"))
    none = spark.createDataFrame([], "id string, major_code string, name string, is_active boolean")
    u = spark.createDataFrame([], "id string, university_code string, name string, university_type string, region string, is_active boolean")
    _, majors = admissions.complete_dimensions(df, u, none)
    assert majors.count() == 2 and majors.select("id").distinct().count() == 2 and admissions.code_clashes(majors).isEmpty()
    same = majors.withColumn("major_code", F.lit("AUTO-000000"))
    assert [r["n"] for r in admissions.code_clashes(same).collect()] == [2]


def test_letters_beyond_the_broadcast_bound(spark, monkeypatch):
    dim = spark.createDataFrame([("a%d" % k, n) for k, n in enumerate(["Luật Kinh Tế", "Luật", "Kinh tế học", "Toán tin", "TIN học"])], "code string, name string")
    kw = spark.createDataFrame([("luật",), ("tin",), ("Kinh tế",), ("xyz",)], "kw string")
    want = sorted(map(tuple, resolve.ilike_top(kw, "kw", dim, "name", "code", 2).select("kw", "name", "rank").collect()))
    monkeypatch.setattr(resolve, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, resolve.ilike_top(kw, "kw", dim, "name", "code", 2).select("kw", "name", "rank").collect())) == want and len(want) == 6
    assert [r["name"] for r in resolve.ilike_top(kw.limit(0).union(spark.createDataFrame([("%t",)], "kw string")), "kw", dim, "name", "code").collect()] == ["Luật"]
