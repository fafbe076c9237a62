"""The registered queries of the record engine, each with SQL that says the same over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import mappings as M
from ..functions import text as T
from ..operators import dedup, merge, metrics, resolve, rules
from ..sources import html as H
from ..sources import tables
from ..streaming import records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d: f(lambda t: spark.read.parquet(f"{d}/{t}.parquet"))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT c_custkey, regexp_replace(upper(trim(c_name)), '[^A-Z0-9-]', '', 'g')[1:20] AS code, regexp_replace(upper(trim(c_mktsegment)), '[^\\w-]', '', 'g') AS scan_code FROM customer""")
def code_normalize(t):
    return t("customer").select("c_custkey", T.code("c_name").alias("code"), T.scan_code("c_mktsegment").alias("scan_code"))


@query("""
WITH x AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_partkey || '. ' || p_name WHEN 1 THEN 'NGÀNH: ' || p_name || ' (KT)' WHEN 2 THEN 'Khoa ' || p_name ELSE 'Khoa học ' || p_name || ' [x] -' END AS raw FROM part),
y AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name ELSE 'khoa học ' || p_name END AS n FROM x JOIN part USING (p_partkey)),
z AS (SELECT p_partkey, trim(regexp_replace(lower(n), '\\s+', ' ', 'g')) AS n FROM y)
SELECT p_partkey, array_to_string(list_transform(string_split(n, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name FROM z""")
def name_clean_title(t):
    k, n = F.col("p_partkey"), F.col("p_name")
    raw = F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit(". "), n)).when(k % 4 == 1, F.concat(F.lit("NGÀNH: "), n, F.lit(" (KT)"))).when(k % 4 == 2, F.concat(F.lit("Khoa "), n)).otherwise(F.concat(F.lit("Khoa học "), n, F.lit(" [x] -")))
    return t("part").select("p_partkey", T.major_name(raw).alias("name"))


@query("""SELECT doc_id, nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '') AS cleaned, nullif(trim(text), '') AS whole FROM documents""")
def text_clean_field(t):
    return t("documents").select("doc_id", T.clean_text("text").alias("cleaned"), T.opt_text("text", 1 << 30).alias("whole"))


@query("""SELECT doc_id, replace(replace(strip_accents(text), 'đ', 'd'), 'Đ', 'D') AS plain FROM documents""")
def strip_accents(t):
    return t("documents").select("doc_id", T.strip_accents("text", True).alias("plain"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice) AS BIGINT) % 130 AS w FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN w % 10 = 0 THEN NULL WHEN w + 0.5 <= 100 THEN CAST(w + 0.5 AS DECIMAL(5,2)) END AS score FROM x""")
def score_parse(t):
    w = F.floor("l_extendedprice").cast("bigint") % 130
    raw = F.when(w % 10 == 0, F.lit(" --- ")).otherwise(F.concat(F.lit("≥ "), w.cast("string"), F.lit(",5 điểm")))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", T.score(raw).alias("score"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_size > 0 THEN CAST(p_size AS BIGINT) END AS quota, CASE WHEN floor(p_retailprice) > 0 THEN CAST(floor(p_retailprice) AS BIGINT) END AS fee FROM part""")
def quota_parse(t):
    raw = F.when(F.col("p_partkey") % 7 == 0, F.lit("N/A")).otherwise(F.concat(F.lit("~"), F.col("p_size").cast("string"), F.lit(" chỉ tiêu")))
    return t("part").select("p_partkey", T.quota(raw).alias("quota"), T.opt_int(F.col("p_retailprice").cast("decimal(20,4)")).alias("fee"))


@query("""SELECT o_orderkey, CASE WHEN contains(lower(o_orderpriority), 'urgent') THEN 'first' WHEN contains(lower(o_orderpriority), 'high') THEN 'second' WHEN contains(lower(o_orderpriority), 'low') THEN 'last' ELSE 'other' END AS level,
CASE o_orderstatus WHEN 'O' THEN 'hoc_ba' WHEN 'F' THEN 'DGNL' ELSE 'THPT' END AS method FROM orders""")
def enum_map_keywords(t):
    raw = F.when(F.col("o_orderstatus") == "O", "Xét Học Bạ 2024").when(F.col("o_orderstatus") == "F", "ĐÁNH GIÁ năng lực").otherwise("unknown")
    level = T.first_keyword(F.lower("o_orderpriority"), [("urgent", "first"), ("high", "second"), ("low", "last")], "other")
    return t("orders").select("o_orderkey", level.alias("level"), T.method(raw).alias("method"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda w: w <> ''))), '+') AS set_key,
CASE doc_id % 5 WHEN 0 THEN 'A00' WHEN 1 THEN 'D01' WHEN 2 THEN 'C00' WHEN 3 THEN 'B08' ELSE 'KHAC' END AS combo FROM documents""")
def combo_set_key(t):
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "")
    k = F.col("doc_id") % 5
    raw = F.when(k == 0, "Hóa, Toán, Lý").when(k == 1, "toán-văn-anh").when(k == 2, "Văn Sử Địa").when(k == 3, "Khối b08 (x)").otherwise("?")
    return t("documents").select("doc_id", T.set_key(words).alias("set_key"), T.combo(raw).alias("combo"))


@query("""SELECT conv_id, turn, unnest(list_filter(list_transform(string_split(text, ','), lambda p: trim(p)), lambda p: p <> '')) AS part FROM (SELECT DISTINCT conv_id, turn, text FROM conversations)""")
def multi_value_explode(t):
    parts = F.filter(F.transform(F.split("text", ","), lambda p: F.trim(p)), lambda p: p != "")
    return t("conversations").select("conv_id", "turn", "text").distinct().select("conv_id", "turn", F.explode(parts).alias("part"))


@query("""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2)) AS label FROM pages)
SELECT page_id, href, label, replace(replace(upper(string_split(href, '-')[-1]), 'ß', 'SS'), 'ẞ', 'SS') AS code FROM l""")
def catalog_links(t):
    pairs = F.explode(H.links(F.col("html"), r'<li><a href="([^"]*)">([^<]*)</a>'))
    return t("pages").select("page_id", pairs.alias("x")).select("page_id", F.col("x.href").alias("href"), F.col("x.label").alias("label"), T.slug_code("x.href").alias("code"))


@query("""SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(html, '<html lang="([a-z]+)">', 1) AS lang, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, length(html) AS size FROM pages""")
def page_profile(t):
    return t("pages").select("page_id", F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"), F.regexp_extract("html", '<html lang="([a-z]+)">', 1).alias("lang"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.length("html").cast("bigint").alias("size"))


@query("""SELECT page_id, CASE WHEN regexp_matches(u, '^https?://') THEN u END AS url, regexp_replace(url, '[?#].*$', '') || '?page=' || n AS next_url
FROM (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, '^https?://', '') ELSE url END AS u, unnest(range(2, 4)) AS n FROM pages)""")
def url_rules(t):
    u = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url"))
    df = H.following_pages(t("pages").select("page_id", F.regexp_replace("url", r"[?#].*$", "").alias("first"), "url", F.lit(1).alias("page"), F.lit(3).alias("total")), "page", "total", "first")
    return df.select("page_id", F.when(T.is_url(u), u).alias("url"), "next_url")


@query("""
WITH l AS (SELECT url, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 2) AS x FROM pages),
c AS (SELECT url, unnest(range(len(x))) AS row, unnest(x) AS cell FROM l)
SELECT url, 1 AS "table", row, trim(replace(replace(replace(replace(cell, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS cell, '' AS none FROM c""")
def html_rows(t):
    """Table rows by the parser; pages of the test data hold no table, so their lists stand in for tables."""
    page = F.regexp_replace(F.regexp_replace("html", "<ul>", "<table>"), "</ul>", "</table>")
    page = F.regexp_replace(F.regexp_replace(page, "<li>", "<tr><td>"), "</li>", "</td></tr>")
    return H.table_rows(t("pages").select("url", page.alias("html"))).select("url", "table", "row", H.cell(1).alias("cell"), H.cell(2).alias("none"))


def _records(t) -> DataFrame:
    """Orders as raw score records, with faults by key."""
    k = F.col("o_orderkey")
    return tables.spread(t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), "o_orderkey").select(
        k.alias("ingest_seq"), F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit("u"), (F.col("o_custkey") % 50).cast("string"))).alias("university_code"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.concat(F.lit("Ngành: m "), (k % 20).cast("string"))).alias("major_name_raw"), F.lit(None).cast("string").alias("major_code"),
        F.when(k % 17 == 0, "x").when(k % 19 == 0, "1990").otherwise(F.lit("2024")).alias("year"), F.col("o_orderstatus").alias("admission_method"), F.lit("A00").alias("subject_combination"),
        F.floor(F.col("o_totalprice") % 120).cast("bigint").cast("string").alias("cutoff_score"), (k % 5).cast("string").alias("quota"), F.lit(None).cast("string").alias("note"),
        F.lit(None).cast("timestamp").alias("scraped_at"), F.when(k % 2 == 0, "https://x.example/a").otherwise("x.example").alias("source_url"),
    )


_REASON = """CASE WHEN o_orderkey % 11 = 0 THEN 'university_code missing' WHEN o_orderkey % 13 = 0 THEN 'major_name_raw missing' WHEN o_orderkey % 17 = 0 THEN 'year not an integer' WHEN o_orderkey % 19 = 0 THEN 'year out of range' END"""


@query(f"SELECT {_REASON} AS drop_reason, count(*) AS n FROM orders GROUP BY 1 HAVING drop_reason IS NOT NULL")
def validate_drop_reasons(t):
    return rules.drop_counts(rules.validate(_records(t), rules.score_rules("2024-01-01")))


@query(f"""SELECT o_orderkey AS ingest_seq, CASE WHEN floor(o_totalprice % 120) <= 100 THEN CAST(floor(o_totalprice % 120) AS DECIMAL(5,2)) END AS cutoff_score,
CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 5 AS BIGINT) END AS quota, CASE WHEN o_orderkey % 2 = 0 THEN 'https://x.example/a' END AS source_url FROM orders WHERE ({_REASON}) IS NULL""")
def validate_null_default(t):
    return rules.passed(rules.validate(_records(t), rules.score_rules("2024-01-01"))).select("ingest_seq", "cutoff_score", "quota", "source_url")


@query("""SELECT vec_id, label % 3 <> 2 AS valid, CASE label % 3 WHEN 0 THEN 'I,R' WHEN 1 THEN '' ELSE 'R,z' END AS tags FROM embeddings""")
def array_contract(t):
    k = F.col("label") % 3
    raw = F.when(k == 0, F.array(F.lit("R"), F.lit(" I"), F.lit("R"))).when(k == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("z"), F.lit("R"), F.lit("")))
    tags = T.texts(raw)
    return t("embeddings").select("vec_id", (F.size(F.array_except(tags, F.array(*[F.lit(x) for x in "RIASEC"]))) == 0).alias("valid"), F.array_join(F.array_sort(tags), ",").alias("tags"))


@query("""SELECT o_orderkey, regexp_replace(upper(c_name), '[^A-Z0-9-]', '', 'g')[1:20] AS code, CASE o_orderstatus WHEN 'O' THEN 'hoc_ba' ELSE 'THPT' END AS method, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders JOIN customer ON c_custkey = o_custkey""")
def normalize_record(t):
    x = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return x.select("o_orderkey", T.code("c_name").alias("code"), T.method(F.when(F.col("o_orderstatus") == "O", "học bạ").otherwise("?")).alias("method"), F.year("o_orderdate").alias("year"))


@query("""
WITH n AS (SELECT lower(p_name) AS k, min(p_partkey) AS v FROM part GROUP BY 1),
x AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 1 THEN l_partkey END AS code, lower(p_name) AS name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p.p_partkey, n.v) AS part_id FROM x LEFT JOIN part p ON p.p_partkey = x.code LEFT JOIN n ON n.k = x.name""")
def resolve_exact_cascade(t):
    part = t("part")
    x = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey", "left")
    by_code = part.select(F.col("p_partkey").alias("key"), F.col("p_partkey").alias("value"))
    by_name = part.groupBy(F.lower("p_name").alias("key")).agg(F.min("p_partkey").alias("value"))
    keys = [F.when(F.col("l_linenumber") % 2 == 1, F.col("l_partkey")), F.lower("p_name")]
    return resolve.cascade(x, keys, [by_code, by_name], "part_id").select("l_orderkey", "l_linenumber", "l_partkey", "part_id")


@query("""
WITH k AS (SELECT DISTINCT n_name AS kw FROM nation), p AS (SELECT * FROM (SELECT p_partkey, p_name || ' ' || n_name AS name FROM part JOIN nation ON n_nationkey = p_partkey % 25)),
h AS (SELECT kw, p_partkey, name, row_number() OVER (PARTITION BY kw ORDER BY length(name), p_partkey) AS rn FROM k JOIN p ON contains(lower(name), lower(kw)))
SELECT kw, p_partkey, name, rn AS rank FROM h WHERE rn = 1""")
def resolve_ilike_top1(t):
    p = t("part").join(F.broadcast(t("nation")), F.col("n_nationkey") == F.col("p_partkey") % 25).select("p_partkey", F.concat_ws(" ", "p_name", "n_name").alias("name"))
    top = resolve.ilike_top(t("nation").select(F.col("n_name").alias("kw")), "kw", p.withColumn("code", F.lit("")).withColumn("code", F.col("p_partkey")), "name", "code")
    return top.select("kw", F.col("code").alias("p_partkey"), "name", F.col("rank").cast("bigint").alias("rank"))


@query("""
WITH k AS (SELECT DISTINCT lower(n_name) AS n, lower(n_name) || c_mktsegment[1:1] AS k, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT k, n_name AS "match", 2.0::DOUBLE * length(n) / (2 * length(n) + 1) AS ratio FROM k""")
def resolve_fuzzy(t):
    n = t("nation")
    names = n.select(F.lower("n_name").alias("key"), "n_name", F.col("n_nationkey").alias("ord")).select("key", F.col("n_name").alias("value"), "ord")
    wrong = t("customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lower("n_name"), F.substring("c_mktsegment", 1, 1)).alias("k")).distinct()
    return resolve.fuzzy(wrong, "k", names)


@query("""SELECT doc_id, CASE WHEN contains(l, 'tion') AND contains(l, 'thx') THEN 'a' WHEN contains(l, 'chk') OR contains(l, 'keit') THEN 'b' WHEN contains(l, 'ción') THEN 'c' END AS tag FROM (SELECT doc_id, lower(text) AS l FROM documents)""")
def tag_first_match(t):
    low = F.lower("text")
    first = F.when(F.contains(low, F.lit("tion")) & F.contains(low, F.lit("thx")), "a")
    return t("documents").select("doc_id", F.coalesce(first, T.first_keyword(low, [(["chk", "keit"], "b"), ("ción", "c")], None)).alias("tag"))


@query("""
WITH s AS (SELECT doc_id, unnest([{'t': 'a', 's': 2 * contains(l, 'tion')::INT + contains(l, 'the')::INT}, {'t': 'b', 's': 3 * contains(l, 'keit')::INT}, {'t': 'c', 's': contains(l, 'ment')::INT + contains(l, 'eau')::INT}, {'t': 'd', 's': contains(l, 'ado')::INT}]) AS x FROM (SELECT doc_id, lower(text) AS l FROM documents)),
r AS (SELECT doc_id, x.t AS t, row_number() OVER (PARTITION BY doc_id ORDER BY x.s DESC, x.t) AS rn, x.s AS s FROM s WHERE x.s > 0)
SELECT d.doc_id, coalesce(string_agg(t, ',' ORDER BY rn) FILTER (rn <= 3), '') AS tags FROM documents d LEFT JOIN r USING (doc_id) GROUP BY d.doc_id""")
def tag_top3(t):
    w = {"a": {"tion": 2, "the": 1}, "b": {"keit": 3}, "c": {"ment": 1, "eau": 1}, "d": {"ado": 1}}
    docs = t("documents")
    return docs.select("doc_id", F.array_join(resolve.top_tags(docs, F.lower("text"), w), ",").alias("tags"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def exists_semi(t):
    return t("customer").select("c_custkey").join(t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def exists_anti(t):
    return dedup.skip_existing(t("customer").select("c_custkey"), t("orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


_LINE = "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(f"SELECT {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn FROM lineitem) WHERE rn = 1")
def dedup_first_wins(t):
    return dedup.first_wins(t("lineitem").select(*_LINE.split(", ")), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])


@query("SELECT min(doc_id) AS doc_id, sha256(text)[1:16] AS print, count(*) AS n FROM documents GROUP BY text")
def dedup_text_hash(t):
    return t("documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).select("doc_id", F.substring("h", 1, 16).alias("print"), "n")


def _two(t):
    o = t("orders")
    stored = o.where("o_orderkey % 3 <> 0").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    batch = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderstatus")).alias("status"), (F.col("o_totalprice") + F.col("o_orderkey") % 5).alias("price"))
    return stored, batch


def _merge_sql(taken: str) -> str:
    return f"""
WITH s AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0),
b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS status, o_totalprice + o_orderkey % 5 AS price FROM orders WHERE o_orderkey % 2 = 0),
j AS (SELECT coalesce(s.k, b.k) AS o_orderkey, s.k IS NOT NULL AS old, b.k IS NOT NULL AS new, s.status AS os, b.status AS ns, s.price AS op, b.price AS np FROM s FULL JOIN b ON s.k = b.k),
w AS (SELECT *, {taken} FROM j)
SELECT o_orderkey, status, price, CASE WHEN NOT old THEN 'inserted' WHEN NOT new THEN 'kept' WHEN status IS DISTINCT FROM os OR price IS DISTINCT FROM op THEN 'updated' ELSE 'unchanged' END AS action FROM w"""


_TAKE = "CASE WHEN old AND new THEN {0} WHEN new THEN ns ELSE os END AS status, CASE WHEN old AND new THEN {1} WHEN new THEN np ELSE op END AS price"


@query(_merge_sql(_TAKE.format("os", "op")))
def merge_skip(t):
    return merge.merge(*_two(t), ["o_orderkey"], ["status", "price"], "skip")


@query(_merge_sql(_TAKE.format("coalesce(ns, os)", "coalesce(np, op)")))
def merge_coalesce(t):
    return merge.merge(*_two(t), ["o_orderkey"], ["status", "price"], "coalesce")


@query(_merge_sql(_TAKE.format("ns", "np")))
def merge_overwrite(t):
    return merge.merge(*_two(t), ["o_orderkey"], ["status", "price"], "overwrite")


@query("SELECT action, count(*) AS n FROM (" + _merge_sql(_TAKE.format("coalesce(ns, os)", "coalesce(np, op)")) + ") GROUP BY action")
def merge_action_counts(t):
    return merge.action_counts(merge.merge(*_two(t), ["o_orderkey"], ["status", "price"], "coalesce"))


@query("""SELECT c_custkey, c_name AS name FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT DISTINCT o_custkey, 'customer ' || o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""")
def dim_autocreate(t):
    dim = t("customer").where("c_custkey % 2 = 0").select("c_custkey", F.col("c_name").alias("name"))
    return merge.with_missing(dim, t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", {"name": F.concat(F.lit("customer "), F.col("c_custkey").cast("string"))})


@query("SELECT s_suppkey, s_suppkey % 10 <> 0 AS is_active FROM supplier")
def soft_delete(t):
    s = t("supplier").select("s_suppkey", F.lit(True).alias("is_active"))
    return merge.deactivate(s, s.where("s_suppkey % 10 = 0"), "s_suppkey")


_RUNS = """SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase') AS new, count(*) FILTER (event_type = 'error') AS failed, count(*) AS total, min(ts) AS started, max(ts) AS finished FROM events GROUP BY 1"""


def _runs(t) -> DataFrame:
    e = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count_if(F.col("event_type") == "purchase").alias("new"), F.count_if(F.col("event_type") == "error").alias("failed"), F.count(F.lit(1)).alias("total"), F.min("ts").alias("started"), F.max("ts").alias("finished"))


@query(f"""SELECT strftime(day, '%Y-%m-%d') AS day, new, failed, total, CASE WHEN failed = 0 THEN 'success' ELSE 'partial' END AS status, CASE WHEN new = 0 AND failed > 0 THEN 'failed' WHEN new > 0 AND failed > 0 THEN 'partial' ELSE 'success' END AS crawl_status,
(epoch_us(finished) - epoch_us(started)) / 1000000.0 AS seconds FROM ({_RUNS})""")
def run_log(t):
    r = _runs(t)
    return r.select(F.col("day").cast("string").alias("day"), "new", "failed", "total", metrics.run_status(F.col("failed")).alias("status"), metrics.crawl_status(F.col("new"), F.col("failed")).alias("crawl_status"), metrics.duration_seconds(F.col("started"), F.col("finished")).alias("seconds"))


@query(f"SELECT strftime(day, '%Y-%m-%d') AS day, total FROM ({_RUNS}) ORDER BY day DESC LIMIT 5")
def run_log_top5(t):
    return metrics.latest(_runs(t), "day").select(F.col("day").cast("string").alias("day"), "total")


@query(f"SELECT strftime(day, '%Y-%m-%d') AS day, (total > 1) AS bad, sum((total > 1)::INT) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 AS alert FROM ({_RUNS})")
def alert_streak(t):
    r = metrics.streak(_runs(t), "day", F.col("total") > 1)
    return r.select(F.col("day").cast("string").alias("day"), (F.col("bad") == 1).alias("bad"), "alert")


@query("""SELECT 'overview' AS section, 'nation' AS metric, count(*)::DOUBLE AS value FROM nation UNION ALL SELECT 'overview', 'customer', count(*)::DOUBLE FROM customer UNION ALL SELECT 'overview', 'orders', count(*)::DOUBLE FROM orders""")
def dq_overview(t):
    return metrics.overview(nation=t("nation"), customer=t("customer"), orders=t("orders"))


@query("""SELECT source, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(toxic) AS labelled, round(100.0::DOUBLE * count(*) FILTER (quality = 1) / count(*), 2) AS good_pct, round(100.0::DOUBLE * count(toxic) / count(*), 2) AS labelled_pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def dq_coverage(t):
    x = t("documents").select("doc_id", "source").join(t("labels"), "doc_id", "left")
    return metrics.coverage(x, ["source"], good=F.col("quality") == 1, labelled=F.col("toxic").isNotNull())


@query("""SELECT source, repeat('#', k) || repeat('.', 20 - k) AS bar FROM (SELECT source, CAST(floor(count(quality)::DOUBLE / count(*) * 20) AS INT) AS k FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)""")
def coverage_bar(t):
    x = t("documents").select("doc_id", "source").join(t("labels"), "doc_id", "left").groupBy("source").agg((F.count("quality").cast("double") / F.count(F.lit(1))).alias("s"))
    return x.select("source", T.bar(F.col("s") * 100).alias("bar"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1")
def count_by_year(t):
    return metrics.count_by(t("orders"), F.year("o_orderdate").alias("year"))


@query("SELECT c_mktsegment, min(c_acctbal) AS low, max(c_acctbal) AS high, median(c_acctbal) AS middle FROM customer GROUP BY 1")
def salary_stats(t):
    return metrics.salaries(t("customer"), "c_mktsegment", "c_acctbal")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) IN (1995, 1996) AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def run_filter(t):
    codes = t("customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"))
    return t("orders").where(F.year("o_orderdate").isin(1995, 1996)).select("o_orderkey", "o_custkey").join(codes, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("SELECT n_nationkey, coalesce(CASE WHEN n_nationkey % 3 = 0 THEN n_name END, r_name) AS value FROM nation JOIN region ON r_regionkey = n_regionkey")
def config_override(t):
    x = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    own = F.when(F.col("n_nationkey") % 3 == 0, F.create_map(F.lit("v"), F.col("n_name"))).otherwise(F.create_map().cast("map<string,string>"))
    return x.select("n_nationkey", F.coalesce(F.try_element_at(own, F.lit("v")), F.col("r_name")).alias("value"))


@query("""SELECT lower(n_name) AS key, CASE WHEN n_nationkey % 5 = 0 THEN 'C' || n_nationkey WHEN n_nationkey % 2 = 0 THEN 'A' || n_nationkey ELSE 'B' || n_nationkey END AS value FROM nation""")
def seed_dimension(t):
    n = t("nation")

    def of(df, letter):
        return df.select(F.col("n_name").alias("name"), F.concat(F.lit(letter), F.col("n_nationkey").cast("string")).alias("value"))

    return resolve.dictionary(of(n, "B"), of(n.where("n_nationkey % 2 = 0"), "A"), of(n.where("n_nationkey % 5 = 0"), "C"))


@query("""SELECT p_partkey, nullif(regexp_extract('x' || (p_partkey + 1000000) || 'y', '[0-9]{7}'), '') AS code, CASE WHEN regexp_matches(p_brand, '^[A-Za-z]+$') THEN upper(p_brand) ELSE p_brand END AS short_name, trim(p_name) NOT IN ('', '-') AS valid FROM part""")
def key_extract(t):
    return t("part").select("p_partkey", T.seven_digits(F.concat(F.lit("x"), (F.col("p_partkey") + 1000000).cast("string"), F.lit("y"))).alias("code"), T.short_name("p_brand").alias("short_name"), (~F.trim("p_name").isin("", "-")).alias("valid"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '2024-01-01' ELSE date_trunc('day', o_orderdate) END AS at FROM orders")
def timestamp_coerce(t):
    raw = F.when(F.col("o_orderkey") % 7 == 0, "not a time").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00"))
    return t("orders").select("o_orderkey", T.utc(raw, "2024-01-01").cast("timestamp_ntz").alias("at"))


@query("""SELECT s_suppkey, array_to_string(list_filter([CASE WHEN s_suppkey % 3 = 0 THEN 'code: missing' END, CASE WHEN s_acctbal < 0 THEN 'balance: negative' END], lambda m: m IS NOT NULL), ' | ') AS errors FROM supplier""")
def contract_errors(t):
    return t("supplier").select("s_suppkey", F.array_join(rules.errors(code__missing=F.col("s_suppkey") % 3 != 0, balance__negative=F.col("s_acctbal") >= 0), " | ").alias("errors"))


@query("SELECT n_nationkey, n_name, n_regionkey, lower(n_name) AS key, count(*) OVER (PARTITION BY n_regionkey) AS n FROM nation WHERE n_nationkey <> 3")
def dim_maps(t):
    return t("nation").where("n_nationkey <> 3").select("n_nationkey", "n_name", "n_regionkey", F.lower("n_name").alias("key"), F.count(F.lit(1)).over(W.partitionBy("n_regionkey")).alias("n"))


_SEGMENT = "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '' ELSE c_mktsegment END AS k FROM customer"


@query(f"SELECT min(c_custkey) AS c_custkey, k FROM ({_SEGMENT}) WHERE k <> '' GROUP BY k UNION ALL SELECT c_custkey, k FROM ({_SEGMENT}) WHERE k = ''")
def dim_dedup_blank_pass(t):
    x = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, "").otherwise(F.col("c_mktsegment")).alias("k"))
    return dedup.pass_blank(x, "k", ["c_custkey"])


@query(f"SELECT count(*) AS rows, count(*) FILTER (r IS NULL) AS passed, count(*) FILTER (r IS NOT NULL) AS dropped FROM (SELECT {_REASON} AS r FROM orders)")
def stage_counters(t):
    x = rules.validate(_records(t), rules.score_rules("2024-01-01"))
    return metrics.counters(x, passed=F.col("drop_reason").isNull(), dropped=F.col("drop_reason").isNotNull())


@query("SELECT string_split(p_name, ' ')[1] AS name, count(*) AS n FROM part GROUP BY 1")
def auto_name_frequency(t):
    return metrics.count_by(t("part"), F.split("p_name", " ")[0].alias("name"))


@query("""
WITH l AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>', 1)) AS href FROM pages),
c AS (SELECT page_id, regexp_replace(upper(trim(host)), '[^A-Z0-9-]', '', 'g')[1:20] AS code, href FROM l WHERE href <> '/'),
f AS (SELECT code, href, min(page_id) AS first_page, count(*) AS n FROM c GROUP BY code, href)
SELECT code, count(*) AS links, sum(n)::BIGINT AS seen, min(first_page) AS first_page FROM f GROUP BY code""")
def catalog_flagship(t):
    """Pages to links to codes: the first page of each link of a site, then the site's numbers."""
    pages = t("pages").select("page_id", T.code(F.regexp_extract("url", "^https?://([^/?#]+)", 1)).alias("code"), F.explode(F.regexp_extract_all("html", F.lit(r'<li><a href="([^"]*)">([^<]*)</a>'), F.lit(1))).alias("href"))
    first = pages.where("href <> '/'").groupBy("code", "href").agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
    return first.groupBy("code").agg(F.count(F.lit(1)).alias("links"), F.sum("n").alias("seen"), F.min("first_page").alias("first_page"))


@query("""
WITH k AS (SELECT DISTINCT lower(n_name) || c_mktsegment[1:1] AS k FROM customer JOIN nation ON c_nationkey = n_nationkey),
r AS (SELECT k, n_name, levenshtein(k, lower(n_name)) AS e, row_number() OVER (PARTITION BY k ORDER BY levenshtein(k, lower(n_name)), n_nationkey) AS rn FROM k, nation)
SELECT k, CASE WHEN e <= 2 THEN n_name END AS match, e AS edits FROM r WHERE rn = 1""")
def resolve_fewest_edits(t):
    n = t("nation")
    names = n.select(F.lower("n_name").alias("key"), F.col("n_name").alias("value"), F.col("n_nationkey").alias("ord"))
    named = t("customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    return resolve.fewest_edits(named.select(F.concat(F.lower("n_name"), F.substring("c_mktsegment", 1, 1)).alias("k")).distinct(), "k", names, 2)


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 50 = 7 THEN 'I,R' WHEN p_partkey % 50 IN (3, 11) THEN 'R' WHEN contains(l, 'a') AND contains(l, 'e') AND contains(l, 'o') THEN 'I,R' WHEN contains(l, 'e') THEN 'S' ELSE '' END AS types
FROM (SELECT p_partkey, CASE WHEN contains(p_name, 'a') AND contains(p_name, 'e') AND contains(p_name, 'o') THEN 'aeo' ELSE replace(p_name, 'aeo', '') END AS l FROM part)""")
def tag_by_code_or_keyword(t):
    p = t("part")
    profiles = p.sparkSession.createDataFrame([(0, ["R"], [], ["7", "3"]), (1, ["I", "R"], ["aeo"], ["7"]), (2, ["R"], [], ["11"]), (3, ["S"], ["e"], [])], "ord int, types array<string>, keywords array<string>, codes array<string>")
    n = F.col("p_name")
    low = F.when(F.contains(n, F.lit("a")) & F.contains(n, F.lit("e")) & F.contains(n, F.lit("o")), "aeo").otherwise(F.replace(n, F.lit("aeo"), F.lit("")))
    coded = p.select("p_partkey", (F.col("p_partkey") % 50).cast("string").alias("code"), low.alias("l"))
    return resolve.tags(coded, "code", F.col("l"), profiles).select("p_partkey", F.array_join("types", ",").alias("types"))


@query(f"""
SELECT strftime(day, '%Y-%m-%d') AS day, share > 0.1 AS high_failure, (epoch_us(finished) - epoch_us(started)) / 1000000.0 > 7200 AS long_run, share <= 0.05 AS accepted
FROM (SELECT *, CASE WHEN new + failed > 0 THEN failed::DOUBLE / (new + failed) ELSE 0 END AS share FROM ({_RUNS}))""")
def run_alerts(t):
    r = metrics.alerts(_runs(t), "new", "failed", metrics.duration_seconds(F.col("started"), F.col("finished")))
    return r.select(F.col("day").cast("string").alias("day"), "high_failure", "long_run", "accepted")


@query("SELECT form, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier, (VALUES ('csv'), ('json'), ('parquet')) f(form)")
def io_roundtrip(t):
    """The table through each sink and its reader."""
    rows = t("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    spark, at = rows.sparkSession, tables.scratch(rows.sparkSession, "roundtrip")
    tables.write_version(rows, f"{at}/parquet", "1")
    tables.write_json_lines(rows, f"{at}/json")
    tables.write_csv(rows, f"{at}/csv")
    back = {form: tables.read_text_table(spark, f"{at}/{form}", rows.schema, form) for form in ("csv", "json")} | {"parquet": tables.read_version(spark, f"{at}/parquet")}
    return reduce(DataFrame.unionByName, [df.withColumn("form", F.lit(form)) for form, df in back.items()])


def _replayed(spark: SparkSession, d: str, sink: bool) -> DataFrame:
    """The events as a stream that gives every one of them twice, deduplicated on the way."""
    at = tables.scratch(spark, "stream")
    path = f"{d}/events.parquet"
    table = spark.read.parquet(path)
    schema = table.schema
    # Files may come in any order and in several batches: no event is late while the time to live covers the whole table.
    first, last = table.agg(F.min(F.col("ts").cast("timestamp")), F.max(F.col("ts").cast("timestamp"))).first()
    ttl = f"{int((last - first).total_seconds()) + 1 if first else 1} seconds"
    # A stream takes a folder or a pattern, and the table may be one file.
    once, again = (spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet") for _ in range(2))
    once = records.dedup_stream(once.unionByName(again), ["event_id"], "ts", ttl).select("event_id", "user_id", "event_type", "value")
    if sink:
        records.run_available(once, records.to_versions(at, ["event_id"], ["event_id"], "2024-01-01"), f"{at}/progress")
        return spark.read.parquet(f"{at}/log").agg(F.sum("records_new").alias("records_new"), F.min("status").alias("status"))
    once.writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/rows")


QUERIES["stream_dedup"] = lambda spark, d: _replayed(spark, d, False)
SQL["stream_dedup"] = "SELECT DISTINCT event_id, user_id, event_type, value FROM events"
QUERIES["stream_run_log"] = lambda spark, d: _replayed(spark, d, True)
SQL["stream_run_log"] = "SELECT count(DISTINCT event_id) AS records_new, 'success' AS status FROM events"


from . import operator_queries  # noqa: E402, F401, I001  registers its queries
from . import engine_queries  # noqa: E402, F401
