"""More registered queries: each runs an operator of the library over a whole table, its input made from the table's columns with faults
by key, against SQL that says what has to come out."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mappings as M
from ..functions import text as T
from ..operators import dedup, merge, metrics, normalize, resolve, rules
from ..schemas import TABLES, create_table
from ..sources import html as H
from ..sources import runs, tables
from ..streaming import records
from . import admissions
from .queries import _records as records_of
from .queries import query


def _nfd(x: str) -> Column:
    """The text with its accents as letters of their own."""
    return F.lit(unicodedata.normalize("NFD", x))


def _by(key: Column, *values, otherwise=None) -> Column:
    """The value for key modulo the number of values."""
    out = F.lit(otherwise)
    for k, v in enumerate(values):
        out = F.when(key % len(values) == k, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def union_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Functions.


@query("""
WITH x AS (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'kỹ thuật ' || lower(n_name) WHEN 1 THEN 'điện tử – ' || lower(n_name) WHEN 2 THEN 'ưu & tiên ' || lower(n_name) ELSE 'hóa học ' || lower(n_name) END AS n FROM nation)
SELECT n_nationkey, array_to_string(list_transform(list_filter(string_split(n, ' '), lambda w: w <> ''), lambda w: upper(w[1]) || w[2:]), ' ') AS name FROM x""")
def name_clean_decomposed(t):
    """Names with decomposed accents and with character references."""
    n = F.col("n_name")
    raw = _by(F.col("n_nationkey"), F.concat(_nfd("Ngành: Kỹ  Thuật "), n), F.concat(_nfd("ĐIỆN TỬ &ndash; "), n), F.concat(F.lit("&#432;u &amp; tiên "), n, F.lit(" [CLC]")), F.concat(_nfd("3. hóa học "), n, F.lit(" (x) - ")))
    return t("nation").select("n_nationkey", T.major_name(raw).alias("name"))


@query("""
SELECT n_nationkey, 'kỹ thuật ' || lower(n_name) AS key, CASE WHEN n_nationkey % 2 = 0 THEN 'kỹ thuật ' || lower(n_name) ELSE 'Kỹ Thuật ' || n_name END AS raw, 'Kỹ Thuật ' || n_name AS keyword,
replace('ky thuat ' || lower(n_name), 'đ', 'd') AS plain FROM nation""")
def name_keys(t):
    """Lookup forms of names that are written with decomposed accents, prefixes and brackets: all rows of a pair meet in one key."""
    n, k = F.col("n_name"), F.col("n_nationkey")
    name = F.when(k % 2 == 0, F.concat(_nfd("kỹ  thuật "), F.lower(n))).otherwise(F.concat(_nfd("Kỹ Thuật "), n))
    dressed = F.concat(_nfd("Ngành: "), name, F.lit(" (CLC)"))
    return t("nation").select(
        "n_nationkey", T.name_key(name).alias("key"), T.raw_name(dressed).alias("raw"), T.keyword(F.concat(_nfd("ngành: Kỹ Thuật "), n, F.lit(" [x]"))).alias("keyword"), T.strip_accents(T.name_key(name), True).alias("plain")
    )


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'kỹ ' || lower(c_mktsegment) || chr(10) || 'ab c' WHEN 1 THEN c_name ELSE '' END AS field, CASE c_custkey % 4 WHEN 0 THEN c_name[1:8] WHEN 1 THEN c_name[1:8] END AS opt,
CASE c_custkey % 4 WHEN 0 THEN 'A' || chr(10) || 'b' WHEN 1 THEN NULL WHEN 2 THEN c_name ELSE 'x & y' END AS decoded FROM customer""")
def field_texts(t):
    k, n = F.col("c_custkey"), F.col("c_name")
    raw = _by(k, F.concat(_nfd(" kỹ   "), F.lower("c_mktsegment"), F.lit(" \n\n a\tb  c\u0007 ")), F.concat(F.lit("  "), n, F.lit("\n ")), F.lit(" \n "), F.lit(None).cast("string"))
    decoded = _by(k, "A\nb", F.lit(None).cast("string"), n, "x &amp; y")
    return t("customer").select("c_custkey", T.field(raw, 200).alias("field"), T.opt_text(_by(k, F.concat(F.lit("  "), n), n, "  ", F.lit(None).cast("string")), 8).alias("opt"), T.unescape(decoded).alias("decoded"))


@query("""
SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'A00' WHEN 1 THEN 'C00' WHEN 2 THEN 'D01' WHEN 3 THEN 'B00' WHEN 4 THEN 'KHAC' ELSE 'A01' END AS one,
CASE s_suppkey % 6 WHEN 0 THEN 'A00' WHEN 1 THEN 'C00' WHEN 2 THEN 'D01' WHEN 3 THEN 'B00,D07' WHEN 4 THEN '' ELSE 'A01,X06' END AS several,
CASE s_suppkey % 6 WHEN 0 THEN 'A00' WHEN 1 THEN 'C00' WHEN 2 THEN 'D01' WHEN 3 THEN 'B00' WHEN 4 THEN 'KHAC' ELSE 'A01' END AS on_page FROM supplier""")
def combos_of_texts(t):
    raw = _by(F.col("s_suppkey"), _nfd("Toán Lý Hóa"), _nfd("Văn Sử Địa"), "toán-văn-anh", "Khối b00, d07 (x)", "?", "A01; x06; A01; ?")
    page = _by(F.col("s_suppkey"), "Tổ hợp Toán Lý Hóa", "VĂN SỬ ĐỊA", "toán văn anh", "khối b00, d07", "Toán - Lý - Hóa", "A01; X06")
    return t("supplier").select("s_suppkey", T.combo(raw).alias("one"), F.array_join(T.combos(raw), ",").alias("several"), T.scan_combo(page).alias("on_page"))


@query("""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'xet_tuyen_thang' WHEN 1 THEN 'DGNL' WHEN 2 THEN 'hoc_ba' WHEN 3 THEN 'SAT' ELSE 'THPT' END AS method,
CASE s_suppkey % 4 WHEN 0 THEN 'public' WHEN 1 THEN 'private' WHEN 2 THEN 'foreign_affiliated' END AS kind, CASE s_suppkey % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'central' WHEN 2 THEN 'south' END AS region,
CASE s_suppkey % 4 WHEN 0 THEN 'engineer' WHEN 1 THEN 'master' ELSE 'bachelor' END AS degree, s_suppkey % 5 < 2 AS placeholder FROM supplier""")
def labels_of_texts(t):
    k = F.col("s_suppkey")
    return t("supplier").select(
        "s_suppkey", T.title_method(_by(k, "Điểm XÉT TUYỂN THẲNG 2024", "kỳ thi đánh giá năng lực", "Điểm học bạ", "chứng chỉ IELTS", "khác")).alias("method"),
        T.label(_by(k, " Công lập", "TƯ THỤC", "nước ngoài", "?"), M.TYPES).alias("kind"), T.label(_by(k, "Hà Nội", "miền trung", "TPHCM ", F.lit(None).cast("string")), M.REGIONS).alias("region"),
        T.label(_by(k, "Kỹ sư", "thạc sĩ", "phd", F.lit(None).cast("string")), M.DEGREES, "bachelor").alias("degree"), T.is_placeholder(_by(k, " --- ", "N/A", "0", "12", "x")).alias("placeholder"),
    )


@query(r"""
SELECT o_orderkey, sha256('{"b": ' || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"' || o_orderstatus || '\"\\\n"' END || ', "k": "' || o_orderkey || '"}') AS record, sha256(lower(o_orderpriority) || '|none|' || o_orderkey)[1:16] AS part,
sha256(o_orderkey || chr(1) || o_orderstatus)[1:32] AS id FROM orders""")
def fingerprints(t):
    k = F.col("o_orderkey")
    odd = F.when(k % 3 != 0, F.concat(F.col("o_orderstatus"), F.lit('"\\\n')))
    return t("orders").select("o_orderkey", T.record_fingerprint(k=k, b=odd).alias("record"), T.fingerprint(F.concat(F.lit(" "), F.col("o_orderpriority")), F.lit(None), k).alias("part"), T.key_id("o_orderkey", "o_orderstatus").alias("id"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand || ',x' WHEN 1 THEN '' ELSE p_brand END AS listed, 'truong-' || p_partkey AS slug, upper('' || p_partkey) AS code,
repeat('#', p_size // 5) || repeat('.', 20 - p_size // 5) AS bar FROM part""")
def lists_and_slugs(t):
    b, k = F.col("p_brand"), F.col("p_partkey")
    raw = _by(k, F.concat(b, F.lit(" , x,, "), b), F.lit(None).cast("string"), F.concat(b, F.lit(","), b))
    url = F.concat(F.lit("https://h.example/diem-chuan/truong-"), k.cast("string"), F.lit(".html"))
    return t("part").select("p_partkey", F.array_join(T.csv_list(raw), ",").alias("listed"), T.slug(url).alias("slug"), T.slug_code(T.slug(url)).alias("code"), T.bar(F.col("p_size") * 1.0).alias("bar"))


# Sources.


@query("""
SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'moet' WHEN 1 THEN 'tuyensinh247' ELSE lower(n_name) END AS source, CASE n_nationkey % 3 WHEN 0 THEN 'moet' WHEN 1 THEN 'tuyensinh247' ELSE 'sites' END AS scan,
CASE WHEN n_nationkey % 2 = 0 THEN '2020,2021,2022,2023,2024,2025' ELSE '2023,2021' END AS years, CASE WHEN n_nationkey % 5 <> 0 THEN 'BKA,QSB' END AS codes FROM nation""")
def run_parameters(t):
    k = F.col("n_nationkey")
    raw = t("nation").select("n_nationkey", _by(k, " MOET ", "TuyenSinh247", F.col("n_name")).alias("s"), _by(k, "", "2023, 2021").alias("y"), F.when(k % 5 == 0, "").otherwise("qsb, bka,QSB").alias("c"))
    p = runs.columns("s", "y", "c")
    return raw.select("n_nationkey", p["source"].alias("source"), p["scan"].alias("scan"), F.array_join(p["years"].cast("array<string>"), ",").alias("years"), F.array_join(p["codes"], ",").alias("codes"))


@query("""
SELECT s_suppkey, n AS next, CASE s_suppkey % 3 WHEN 0 THEN 'https://h.example/p?a=1&page=' || n || '&b=' || s_suppkey || '#t' WHEN 1 THEN 'https://h.example/p?c=2&page=' || n ELSE 'https://h.example/p?page=' || n END AS next_url,
'https://h.example/list/' || n AS from_template FROM (SELECT s_suppkey, unnest(range(3, 5)) AS n FROM supplier)""")
def next_pages(t):
    k = F.col("s_suppkey")
    url = _by(k, F.concat(F.lit("https://h.example/p?a=1&page=9&a=2&b="), k.cast("string"), F.lit("#t")), "https://h.example/p?c=2&d=", "https://h.example/p")
    df = t("supplier").select("s_suppkey", url.alias("u"), F.lit(2).alias("page"), F.lit(4).alias("total"))
    both = H.following_pages(df, "page", "total", "u").join(H.following_pages(df, "page", "total", "u", "https://h.example/list/{page}").select("s_suppkey", "next", F.col("next_url").alias("from_template")), ["s_suppkey", "next"])
    return both.select("s_suppkey", F.col("next").cast("bigint").alias("next"), "next_url", "from_template")


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'S' || s_suppkey ELSE upper(s_suppkey || 'x') END AS university_code, CASE WHEN s_suppkey % 2 = 0 THEN s_name || ' & co' ELSE 'plain ' || s_name END AS name,
CASE WHEN s_suppkey % 2 = 0 THEN 'https://h.example/a-b.html' ELSE 'https://h.example/truong-' || s_suppkey || 'x' END AS detail_url FROM supplier""")
def catalog_codes(t):
    k, n = F.col("s_suppkey"), F.col("s_name")
    item = F.when(k % 2 == 0, F.concat(F.lit('<li><a href="/a-b.html"> <b>S'), k.cast("string"), F.lit("</b> - "), n, F.lit(" &amp; co </a></li>"))).otherwise(
        F.concat(F.lit('<li>\n<a class="z" href="truong-'), k.cast("string"), F.lit('x">plain '), n, F.lit("</a></li>"))
    )
    page = F.concat(F.lit('<ul><li><a href="/menu-y">Q1 - menu</a></li></ul><div class="c list-schol-box"><ul>'), item, F.lit('</ul></div><ul><li><a href="/foot-z">Q2 - foot</a></li></ul>'))
    pages = t("supplier").select(k.cast("string").alias("url"), page.alias("html"))
    return H.catalog(pages, "https://h.example").select(F.col("source_url").cast("bigint").alias("s_suppkey"), "university_code", "name", "detail_url")


def _ministry_page(k: Column) -> Column:
    head = "<html><body><h3>2024</h3><table><thead><tr><td>code</td><td>name</td><td>major code</td><td>major</td><td>combo</td><td>score</td></tr></thead><tbody>"
    row = F.concat(
        F.lit("<tr><td> c"), k.cast("string"), F.lit("_x </td><td>n</td><td>Mã "), (k + 7000000).cast("string"), F.lit("</td><td><b>Luật</b> "), _by(k, "học bạ", "đánh giá năng lực", "kinh tế"),
        F.lit("</td><td>"), _by(k, "Toán Lý Hóa", "khối d07", "?"), F.lit("</td><td>"), _by(k, "≥ 22,50", "---"), F.lit("</td></tr>"),
    )
    more = '<tr><td>BAD</td><td>only</td><td>three</td></tr></tbody></table><ul class="pagination"><li><a href="?page=2">›</a></li></ul></body></html>'
    return F.concat(F.lit(head), row, F.lit(more))


@query("""SELECT 'C' || c_custkey || '_X' AS university_code, 'Luật ' || CASE c_custkey % 3 WHEN 0 THEN 'học bạ' WHEN 1 THEN 'đánh giá năng lực' ELSE 'kinh tế' END AS major_name_raw, '' || (c_custkey + 7000000) AS major_code,
CASE c_custkey % 3 WHEN 0 THEN 'hoc_ba' WHEN 1 THEN 'DGNL' ELSE 'THPT' END AS admission_method, CASE c_custkey % 3 WHEN 0 THEN 'A00' WHEN 1 THEN 'D07' ELSE 'KHAC' END AS subject_combination,
CASE WHEN c_custkey % 2 = 0 THEN '22.50' END AS cutoff_score, CAST(2020 + c_custkey % 5 AS INTEGER) AS year, '' || c_custkey AS source_url FROM customer""")
def ministry_rows(t):
    k = F.col("c_custkey")
    customers = tables.spread(t("customer").select("c_custkey"), "c_custkey")
    pages = customers.select(k.cast("string").alias("url"), _ministry_page(k).alias("html"), (2020 + k % 5).cast("int").alias("year"))
    return H.ministry_scores(pages).drop("table", "row")


@query("SELECT c_custkey, CASE WHEN c_custkey % 60 < 50 THEN '?page=2' END AS next_href, 'https://m.example/?page=2' AS next_url, CASE WHEN c_custkey % 2 = 0 THEN 'https://a.example/x' WHEN c_custkey % 4 = 1 THEN 'https://b.example/y' ELSE 'https://m.example/z' END AS absolute FROM customer")
def next_links(t):
    k = F.col("c_custkey")
    href = F.when(k % 2 == 0, "https://a.example/x").when(k % 4 == 1, "//b.example/y").otherwise("/z")
    return t("customer").select("c_custkey", H.next_page(_ministry_page(k), k % 60).alias("next_href"), H.absolute_url(F.lit("?page=2"), "https://m.example/").alias("next_url"), H.absolute_url(href, "https://m.example/").alias("absolute"))


@query("""SELECT page_id, nullif(trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')), '') AS title, regexp_extract(html, '<html lang="([a-z]+)">', 1) AS lang,
len(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a>')) AS links, regexp_extract(html, '<li><a href="([^"]*)">', 1) AS first_href FROM pages""")
def page_helpers(t):
    found = H.links(F.col("html"))
    return t("pages").select("page_id", H.title(F.col("html")).alias("title"), H.attribute(F.col("html"), "html", "lang").alias("lang"), F.size(H.texts_of(F.col("html"), "li")).cast("bigint").alias("links"), F.try_element_at(found, F.lit(1))["href"].alias("first_href"))


def _detail_page(t) -> DataFrame:
    k = F.col("s_suppkey")
    year = F.when(k % 3 == 0, F.lit(" năm 2023")).when(k % 3 == 1, F.lit(" năm 2019")).otherwise(F.lit(""))
    page = F.concat(
        F.lit("<h3>Điểm chuẩn"), year, F.lit(" học bạ</h3><table><tr><td>Tên ngành</td><td>Tổ hợp</td><td>Điểm</td></tr><tbody><tr><td>TÊN NGÀNH</td><td>x</td><td>y</td></tr><tr><td>"), F.col("s_name"),
        F.lit("</td><td>A00, d01</td><td>25,5</td><td>n "), k.cast("string"), F.lit("</td></tr><tr><td>Y</td><td></td><td>--</td></tr><tr><td></td><td>A00</td><td>1</td></tr><tr><td>two</td><td>cells</td></tr></tbody></table>"),
    )
    info = _by(k, F.concat(F.lit("Website: https://u.example/"), k.cast("string"), F.lit("/, x. Địa chỉ: 1 Phố, Hà Nội. z")), "WEB: /w.example; Trụ sở: Lê Lợi, Huế; z", "nothing here", _nfd("địa chỉ: Cần Thơ"))
    return t("supplier").select(k.cast("string").alias("url"), F.concat(F.lit("U"), k.cast("string")).alias("code"), "s_name", page.alias("html"), info.alias("info"))


@query("""
SELECT 'U' || s_suppkey AS university_code, unnest(CASE WHEN s_suppkey % 3 < 3 THEN [s_name, s_name, 'Y'] END) AS major_name_raw, CASE WHEN s_suppkey % 3 = 0 THEN 2023 ELSE 2024 END AS year, 'hoc_ba' AS admission_method,
unnest(['A00', 'D01', 'KHAC']) AS subject_combination, unnest([25.5, 25.5, NULL])::DECIMAL(5,2) AS cutoff_score, unnest(['n ' || s_suppkey, 'n ' || s_suppkey, NULL]) AS note, '' || s_suppkey AS source_url FROM supplier WHERE s_suppkey % 3 <> 1""")
def detail_tables(t):
    return H.detail_scores(_detail_page(t), "code", 2024, [2023, 2024])


@query("""
SELECT 'U' || s_suppkey AS university_code, s_name AS name, 'public' AS university_type, CASE s_suppkey % 4 WHEN 0 THEN 'https://u.example/' || s_suppkey WHEN 1 THEN 'w.example' END AS website,
CASE s_suppkey % 4 WHEN 0 THEN '1 Phố, Hà Nội' WHEN 1 THEN 'Lê Lợi, Huế' WHEN 3 THEN 'Cần Thơ' END AS address, CASE s_suppkey % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'central' WHEN 3 THEN 'south' END AS region,
CASE s_suppkey % 4 WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'Huế' WHEN 3 THEN 'Cần Thơ' END AS province FROM supplier""")
def detail_universities(t):
    u = H.universities(_detail_page(t), "code", "s_name", F.col("info"), "2024-01-01")
    return u.select("university_code", "name", "university_type", "website", "address", "region", "province")


def _site_config(t) -> DataFrame:
    n = t("nation")
    defaults = n.sparkSession.createDataFrame([(1, 2, 3)], "major_cell int, combo_cell int, score_cell int")
    own = n.select(F.concat(F.lit("s"), F.col("n_nationkey").cast("string")).alias("university_code"), F.when(F.col("n_nationkey") % 2 == 0, 2).alias("major_cell"), F.when(F.col("n_nationkey") % 2 == 0, 3).alias("combo_cell"), F.when(F.col("n_nationkey") % 4 == 0, 4).alias("score_cell"))
    return H.site_config(defaults, own)


@query("SELECT 's' || n_nationkey AS university_code, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS major_cell, CASE WHEN n_nationkey % 2 = 0 THEN 3 ELSE 2 END AS combo_cell, CASE WHEN n_nationkey % 4 = 0 THEN 4 ELSE 3 END AS score_cell FROM nation")
def site_settings(t):
    return _site_config(t)


@query("""
SELECT upper('s' || n_nationkey) AS university_code, CASE WHEN n_nationkey % 2 = 0 THEN 'A00' ELSE 'Luật' END AS major_name_raw, 2024 AS year, 'hoc_ba' AS admission_method, CASE WHEN n_nationkey % 2 = 0 THEN 'KHAC' ELSE 'A00' END AS subject_combination,
CAST(CASE WHEN n_nationkey % 4 = 0 THEN 7 ELSE 25.5 END AS DECIMAL(5,2)) AS cutoff_score, n_name AS source_url FROM nation""")
def site_tables(t):
    k = F.col("n_nationkey")
    page = F.lit("<h3>xét học bạ</h3><table><tr><td>Luật</td><td>A00</td><td>25,5</td><td>7</td></tr><tr><td>x</td></tr><tr><td>M</td><td></td><td></td></tr></table>")
    pages = t("nation").select(F.concat(F.lit("s"), k.cast("string")).alias("university_code"), F.col("n_name").alias("url"), page.alias("html"))
    return H.site_scores(pages, _site_config(t), [2023, 2024])


@query("SELECT p_partkey, '<p class=\"x\">' || p_name || ' & é</p>' || chr(10) || '  <br>' AS source FROM part")
def view_source(t):
    line = F.concat(F.lit('<table><tr><td class="line-number"></td><td class="line-content"><span class="t">&lt;p class=&quot;x&quot;&gt;</span>'), F.col("p_name"), F.lit(' &amp; &#233;&lt;/p&gt;</td></tr><tr><td class="line-content">  &lt;br&gt;</td></tr></table>'))
    return t("part").select("p_partkey", H.unrender(line).alias("source"))


@query("""SELECT '' || (p_partkey + 7000000) AS major_code, p_name AS name, p_brand AS major_group, ('' || (p_partkey + 7000000))[1:3] AS major_group_code, CASE WHEN p_partkey % 2 = 0 THEN 'R,I' ELSE 'A' END AS holland, 4 AS study_duration, 'bachelor' AS degree_level FROM part""")
def seed_majors(t):
    seed = t("part").select((F.col("p_partkey") + 7000000).cast("string").alias("code"), F.col("p_name").alias("name"), F.col("p_brand").alias("group"), F.when(F.col("p_partkey") % 2 == 0, "R, I,R").otherwise("A").alias("holland"))
    return tables.majors_from_seed(seed.unionByName(seed)).select("major_code", "name", "major_group", "major_group_code", F.array_join("holland_types", ",").alias("holland"), F.col("study_duration").cast("int").alias("study_duration"), "degree_level")


@query("SELECT 'before' AS state, count(*) AS n FROM supplier UNION ALL SELECT 'after', 0 UNION ALL SELECT 'kept', count(*) FROM supplier")
def table_reset(t):
    df = t("supplier")
    spark, at = df.sparkSession, tables.scratch(df.sparkSession, "reset")
    tables.write_version(df, at, "1")
    before = tables.read_version(spark, at).agg(F.count(F.lit(1)).alias("n")).select(F.lit("before").alias("state"), "n")
    tables.reset(spark, at, "2")
    after = tables.read_version(spark, at).agg(F.count(F.lit(1)).alias("n")).select(F.lit("after").alias("state"), "n")
    return before.unionByName(after).unionByName(tables.read_version(spark, at, "1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("state"), "n"))


@query("SELECT 'r' || event_id AS id, event_type AS spider_name, CASE WHEN event_id % 3 = 0 THEN 'running' ELSE 'partial' END AS status, ts AS started_at, CAST(event_id % 7 AS INTEGER) AS records_new, CASE WHEN event_id % 3 = 0 THEN 'late, \"x\"' END AS error_summary FROM events")
def csv_run_logs(t):
    """A run log through its CSV file and its reader, with commas, quotes and nulls."""
    e, k = t("events"), F.col("event_id")
    made = e.select(
        F.concat(F.lit("r"), k.cast("string")).alias("id"), F.col("event_type").alias("spider_name"), _by(k, "running", "partial", "partial").alias("status"), F.col("ts").cast("timestamp").alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"),
        (k % 7).cast("int").alias("records_new"), F.lit(0).alias("records_updated"), F.lit(0).alias("records_failed"), F.when(k % 3 == 0, 'late, "x"').alias("error_summary"), F.lit("manual").alias("triggered_by"),
    )
    at = tables.scratch(e.sparkSession, "logs")
    tables.write_csv(made, at)
    return tables.read_crawl_logs(e.sparkSession, at).select("id", "spider_name", "status", F.col("started_at").cast("timestamp_ntz").alias("started_at"), "records_new", "error_summary")


# Rules and normalisation.


def _universities(t) -> DataFrame:
    """Customers as raw universities, with faults by key."""
    k = F.col("c_custkey")
    text = F.lit(None).cast("string")
    return t("customer").select(
        k.alias("ingest_seq"), F.when(k % 11 == 0, " ").when(k % 13 == 0, "a!b").otherwise(F.concat(F.lit("u-"), k.cast("string"))).alias("university_code"), F.when(k % 17 == 0, "").otherwise(F.concat(F.lit(" "), F.col("c_name"))).alias("name"),
        _by(k, "hust", "đh").alias("short_name"), _by(k, "public", "Công lập", "private").alias("university_type"), _by(k, "north", "bắc").alias("region"), F.lit(" Hà  Nội ").alias("province"), text.alias("address"),
        _by(k, "https://a.example", "www.a.example").alias("website"), text.alias("admission_url"), text.alias("logo_url"), F.lit("12").alias("tuition_min"), F.lit("x").alias("tuition_max"), _by(k, "1956", "1700", "19.5").alias("established_year"),
        F.lit(None).cast("timestamp").alias("scraped_at"), F.lit("http://s.example").alias("source_url"),
    )


_UNIVERSITY_REASON = "CASE WHEN c_custkey % 11 = 0 THEN 'university_code missing' WHEN c_custkey % 17 = 0 THEN 'name missing' WHEN c_custkey % 13 = 0 THEN 'university_code malformed' END"


@query(f"""
SELECT c_custkey AS ingest_seq, {_UNIVERSITY_REASON} AS drop_reason, CASE c_custkey % 3 WHEN 0 THEN 'public' WHEN 2 THEN 'private' END AS university_type, CASE WHEN c_custkey % 2 = 0 THEN 'north' END AS region,
CASE WHEN c_custkey % 2 = 0 THEN 'https://a.example' END AS website, CAST(CASE WHEN c_custkey % 3 = 0 THEN 1956 END AS INTEGER) AS established_year, TIMESTAMP '2024-01-01' AS scraped_at FROM customer""")
def validate_universities(t):
    got = rules.validate(_universities(t), rules.university_rules("2024-01-01"))
    return got.select("ingest_seq", "drop_reason", "university_type", "region", "website", F.col("established_year").cast("int").alias("established_year"), F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"))


@query("""
SELECT c_custkey AS ingest_seq, CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'AB' ELSE 'U-' || c_custkey END AS university_code, CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_name END AS name, CASE WHEN c_custkey % 2 = 0 THEN 'HUST' ELSE 'đh' END AS short_name,
CASE WHEN c_custkey % 3 < 2 THEN 'public' ELSE 'private' END AS university_type, 'north' AS region, 'Hà Nội' AS province, 12::BIGINT AS tuition_min, CASE c_custkey % 3 WHEN 0 THEN 1956::BIGINT WHEN 1 THEN 1700 END AS established_year FROM customer""")
def normalize_universities(t):
    """The stage alone, as raw labels reach it."""
    return normalize.universities(_universities(t)).select("ingest_seq", "university_code", "name", "short_name", "university_type", "region", "province", "tuition_min", "established_year")


def _majors(t) -> DataFrame:
    k = F.col("p_partkey")
    return t("part").select(
        k.alias("ingest_seq"), F.when(k % 11 == 0, "12").when(k % 13 == 0, "AUTO-00AA11").otherwise((k + 7000000).cast("string")).alias("major_code"), F.when(k % 17 == 0, "x").otherwise(F.concat(F.lit("Ngành: "), F.col("p_name"))).alias("name"),
        F.lit(" g ").alias("major_group"), F.lit("734").alias("major_group_code"), F.lit(" d \n\n e").alias("description"), _by(k, "4", "11", "x").alias("study_duration"), _by(k, "engineer", "Kỹ sư").alias("degree_level"),
        F.lit(None).cast("timestamp").alias("scraped_at"), F.lit("u").alias("source_url"), F.when(k % 2 == 0, F.array(F.lit(" a "), F.lit("a"), F.lit(""))).alias("career_options"), F.array(F.lit("s")).alias("required_skills"),
        _by(k, "A00", "").alias("subject_combinations"), F.when(k % 7 == 0, F.array(F.lit("r"))).otherwise(F.array(F.lit("R"), F.lit("I"))).alias("holland_types"), F.lit(None).cast("array<string>").alias("career_anchor_tags"),
    )


def _major_reason(code: str) -> str:
    return f"CASE WHEN {code} THEN 'major_code malformed' WHEN p_partkey % 17 = 0 THEN 'name length' WHEN p_partkey % 7 = 0 THEN 'holland_types unknown' WHEN p_partkey % 3 = 1 THEN 'study_duration out of range' END"


@query(f"""
SELECT p_partkey AS ingest_seq, {_major_reason("p_partkey % 11 = 0 OR p_partkey % 13 = 0")} AS drop_reason, {_major_reason("p_partkey % 11 = 0")} AS stored_reason, CASE WHEN p_partkey % 2 = 0 THEN 'engineer' ELSE 'bachelor' END AS degree_level,
CASE WHEN p_partkey % 2 = 0 THEN 3 ELSE 0 END AS options, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS combos, 0 AS anchors FROM part""")
def validate_majors(t):
    """Scraped majors against their contract, and against that of stored ones, whose codes may have been made up."""
    df = rules.listed(_majors(t))
    got = rules.validate(df, rules.major_rules("2024-01-01"))
    stored = rules.validate(df, rules.major_rules("2024-01-01", rules.STORED_CODE)).select("ingest_seq", F.col("drop_reason").alias("stored_reason"))
    got = got.join(stored, "ingest_seq")
    return got.select("ingest_seq", "drop_reason", "stored_reason", "degree_level", F.size("career_options").alias("options"), F.size("subject_combinations").alias("combos"), F.size("career_anchor_tags").alias("anchors"))


@query("""
WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN 'x' ELSE p_name END AS n FROM part)
SELECT p_partkey AS ingest_seq, CASE WHEN p_partkey % 11 = 0 THEN '12' WHEN p_partkey % 13 = 0 THEN 'AUTO-00AA11' ELSE '' || (p_partkey + 7000000) END AS major_code, array_to_string(list_transform(string_split(lower(n), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name,
'g' AS major_group, 'd' || chr(10) || 'e' AS description, CASE WHEN p_partkey % 3 = 0 THEN 4 END AS study_duration, 'engineer' AS degree_level, CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE '' END AS options, CASE WHEN p_partkey % 2 = 0 THEN 'A00' ELSE '' END AS combos,
CASE WHEN p_partkey % 7 = 0 THEN 'R' ELSE 'R,I' END AS holland FROM x""")
def normalize_majors(t):
    m = normalize.majors(_majors(t))
    lists = {"options": "career_options", "combos": "subject_combinations", "holland": "holland_types"}
    return m.select("ingest_seq", "major_code", "name", "major_group", "description", F.col("study_duration").cast("int").alias("study_duration"), "degree_level", *[F.array_join(c, ",").alias(k) for k, c in lists.items()])


def _scores(t) -> DataFrame:
    """Orders as raw scores, as the pages write them."""
    k = F.col("o_orderkey")
    return tables.spread(t("orders").select("o_orderkey", "o_custkey"), "o_orderkey").select(
        k.alias("ingest_seq"), F.concat(F.lit(" u"), (F.col("o_custkey") % 50).cast("string"), F.lit("_")).alias("university_code"), F.concat(_nfd("Ngành: Kỹ thuật m"), (k % 20).cast("string"), F.lit(" (CLC)")).alias("major_name_raw"),
        _by(k, F.lit(None).cast("string"), " 7480201 ").alias("major_code"), F.lit("2024").alias("year"), _by(k, "Xét học bạ", "ĐGNL", "?").alias("admission_method"), _by(k, "Toán, Văn, Anh", "a00", "zz").alias("subject_combination"),
        _by(k, "25,5 điểm", "≥ 20", "---", "150").alias("cutoff_score"), _by(k, "150 chỉ tiêu", "~20", "0").alias("quota"), _by(k, " n\t \n\n b ", " ").alias("note"), F.lit("2024-01-01 00:00:00").alias("scraped_at"), F.lit(" https://x.example ").alias("source_url"),
    )


@query("""
SELECT o_orderkey AS ingest_seq, 'U' || o_custkey % 50 AS university_code, 'Kỹ Thuật M' || o_orderkey % 20 AS major_name, CASE WHEN o_orderkey % 2 = 1 THEN '7480201' END AS major_code, 2024 AS year,
CASE o_orderkey % 3 WHEN 0 THEN 'hoc_ba' WHEN 1 THEN 'DGNL' ELSE 'THPT' END AS admission_method, CASE o_orderkey % 3 WHEN 0 THEN 'D01' WHEN 1 THEN 'A00' ELSE 'KHAC' END AS subject_combination, CAST(CASE o_orderkey % 4 WHEN 0 THEN 25.5 WHEN 1 THEN 20 END AS DECIMAL(5,2)) AS cutoff_score,
CASE o_orderkey % 3 WHEN 0 THEN 150::BIGINT WHEN 1 THEN 20 END AS quota, CASE WHEN o_orderkey % 2 = 0 THEN 'n' || chr(10) || 'b' END AS note, 'https://x.example' AS source_url FROM orders""")
def normalize_scores(t):
    n = normalize.scores(_scores(t))
    return n.select("ingest_seq", "university_code", "major_name", "major_code", F.col("year").cast("int").alias("year"), "admission_method", "subject_combination", "cutoff_score", "quota", "note", "source_url")


@query("""SELECT count(*) AS normalized, count(*) FILTER (o_orderkey % 2 = 0 AND o_orderkey % 20 < 10) AS resolved, count(*) FILTER (o_orderkey % 2 = 0 AND o_orderkey % 20 >= 10) AS unresolved,
count(*) FILTER (o_orderkey % 3 <> 2) AS combos FROM orders""")
def normalize_counters(t):
    """Rows without a code get one from a dictionary that has half of their names."""
    raw, n = _scores(t), t("nation").where("n_nationkey < 10")
    names = n.select(F.concat(F.lit("kỹ thuật m"), F.col("n_nationkey").cast("string")).alias("key"), (7000000 + F.col("n_nationkey")).cast("string").alias("value"), F.col("n_nationkey").cast("int").alias("ord"))
    coded = resolve.code_of_name(normalize.scores(raw), "major_name", names, "__code", 0.99)
    return normalize.counters(raw, coded.withColumn("major_code", F.coalesce("major_code", "__code")))


@query("""
SELECT o_orderkey AS ingest_seq, CASE o_orderkey % 3 WHEN 0 THEN 'code format' WHEN 1 THEN 'score range' END AS drop_reason FROM orders""")
def strict_rules(t):
    df = _scores(t).withColumns({"university_code": _by(F.col("ingest_seq"), "x", "abc", "abc"), "cutoff_score": _by(F.col("ingest_seq"), "20", "9.5", "20"), "quota": F.lit("1"), "scraped_at": F.lit(None).cast("timestamp")})
    return rules.validate(df, rules.strict_rules("2024-01-01", 2024)).select("ingest_seq", "drop_reason")


@query("""
SELECT o_orderkey AS ingest_seq, CASE o_orderkey % 3 WHEN 0 THEN 'hoc_ba' ELSE 'khac' END AS admission_method, CASE o_orderkey % 3 WHEN 0 THEN 'D01' ELSE 'KHAC' END AS subject_combination, CASE WHEN o_orderkey % 2 = 0 THEN 'n' END AS note,
CASE WHEN o_orderkey % 4 = 3 THEN 'cutoff_score out of range' END AS error FROM orders""")
def store_contract(t):
    k = F.col("ingest_seq")
    df = _scores(t).withColumns({"admission_method": _by(k, " hoc_ba", "x", "THI"), "subject_combination": _by(k, "d01 ", "Q99", "zz"), "note": _by(k, " n ", " "), "cutoff_score": _by(k, 20.0, 0.0, None, 150.0).cast("double")})
    return rules.store_contract(df).select("ingest_seq", "admission_method", "subject_combination", "note", "error")


@query("""
SELECT o_orderkey AS ingest_seq, array_to_string(list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'university_code: missing' END, CASE WHEN o_orderkey % 3 = 0 THEN 'year: not an integer' END, CASE WHEN o_orderkey % 4 = 1 THEN 'cutoff_score: not a number' END,
CASE WHEN o_orderkey % 2 = 1 THEN 'quota: not an integer' END], lambda m: m IS NOT NULL), ' | ') AS errors FROM orders""")
def score_contract(t):
    k = F.col("ingest_seq")
    df = _scores(t).withColumns({"university_code": F.when(k % 5 == 0, " ").otherwise("u"), "year": F.when(k % 3 == 0, "20x4").otherwise("2024"), "cutoff_score": _by(k, "20", "?", F.lit(None).cast("string"), "1e1"), "quota": _by(k, "5", "5.5")})
    return df.select("ingest_seq", F.array_join(rules.score_contract(), " | ").alias("errors"))


# Resolution.


def _dictionary(t) -> DataFrame:
    n = t("nation")
    return n.select(F.lower(F.concat(_nfd("ngành điện ").substr(7, 20), F.col("n_name"))).alias("name"), F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("value"), F.col("n_nationkey").cast("int").alias("ord")).select(T.name_key("name").alias("key"), "value", "ord")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 < 4 THEN 'C' || c_nationkey END AS code FROM customer""")
def name_to_code(t):
    """The whole cascade: exact, without accents, without brackets; names that are like nothing stay without a code."""
    n = t("nation")
    x = tables.spread(t("customer").select("c_custkey", "c_nationkey"), "c_custkey").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.col("n_name")
    raw = _by(F.col("c_custkey"), F.concat(_nfd("Ngành: Điện "), name), F.concat(F.lit("điện "), name, F.lit(" (x)")), F.concat(F.lit("đien "), F.lower(name)), F.concat(F.lit("Điện [CLC] "), name), F.concat(F.lit("zzzzqqqq "), F.col("c_custkey").cast("string")))
    return resolve.code_of_name(x.select("c_custkey", raw.alias("raw")), "raw", _dictionary(t)).select("c_custkey", "code")


@query("""SELECT lower(n_name) AS key, CASE WHEN n_nationkey % 5 = 0 THEN 'new' || n_nationkey ELSE 'C' || n_nationkey END AS value FROM nation UNION ALL SELECT 'extra ' || r_regionkey, 'r' || r_regionkey FROM region""")
def dictionary_entries(t):
    n = t("nation")
    names = n.select(F.lower("n_name").alias("key"), F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("value"), F.col("n_nationkey").cast("int").alias("ord"))
    more = n.where("n_nationkey % 5 = 0").select(F.concat(F.lit(" "), F.col("n_name")).alias("name"), F.concat(F.lit("new"), F.col("n_nationkey").cast("string")).alias("value"))
    more = more.unionByName(t("region").select(F.concat(F.lit("EXTRA  "), F.col("r_regionkey").cast("string")).alias("name"), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("value")))
    return resolve.with_entries(names, more).select("key", "value")


def _stored_majors(t) -> DataFrame:
    n = t("nation")
    return n.select(F.concat(F.lit("m"), F.col("n_nationkey").cast("string")).alias("id"), (7000000 + F.col("n_nationkey")).cast("string").alias("major_code"), F.col("n_name").alias("name"), (F.col("n_nationkey") != 3).alias("is_active"))


@query("""
WITH m AS (SELECT 'm' || n_nationkey AS id, '' || (7000000 + n_nationkey) AS code, n_name AS name, n_nationkey <> 3 AS active FROM nation),
x AS (SELECT s_suppkey, n_nationkey, CASE s_suppkey % 4 WHEN 0 THEN '' || (7000000 + n_nationkey) WHEN 1 THEN '9999999' END AS code, CASE s_suppkey % 4 WHEN 3 THEN substr(n_name, 2, 4) ELSE lower(n_name) END AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey),
top AS (SELECT name AS kw, (SELECT m.id FROM m WHERE active AND contains(lower(m.name), lower(k.name)) ORDER BY length(m.name), m.code LIMIT 1) AS id FROM (SELECT DISTINCT name FROM x WHERE code IS NULL) k)
SELECT s_suppkey, CASE WHEN x.code IS NOT NULL THEN c.id ELSE coalesce(e.id, top.id) END AS major_id FROM x LEFT JOIN m c ON c.code = x.code LEFT JOIN m e ON lower(e.name) = lower(x.name) LEFT JOIN top ON top.kw = x.name""")
def store_cascade(t):
    n = t("nation")
    x = t("supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"))
    k, name = F.col("s_suppkey"), F.col("n_name")
    code = F.when(k % 4 == 0, (7000000 + F.col("n_nationkey")).cast("string")).when(k % 4 == 1, "9999999")
    rows = x.select("s_suppkey", code.alias("major_code"), F.when(k % 4 == 3, F.substring(name, 2, 4)).otherwise(F.lower(name)).alias("major_name"))
    return resolve.store_major(rows, _stored_majors(t)).select("s_suppkey", "major_id")


@query("""
WITH k AS (SELECT DISTINCT n_name[1] || '%' || n_name[-1] AS kw FROM nation UNION SELECT '_n_' UNION SELECT '7000001'),
h AS (SELECT kw, n_name AS name, '' || (7000000 + n_nationkey) AS code, row_number() OVER (PARTITION BY kw ORDER BY length(n_name), n_nationkey) AS rank FROM k JOIN nation ON n_name ILIKE '%' || kw || '%' OR '' || (7000000 + n_nationkey) ILIKE '%' || kw || '%')
SELECT kw, name, code, rank FROM h WHERE rank <= 5""")
def resolve_wildcards(t):
    n = t("nation")
    kw = n.select(F.concat(F.substring("n_name", 1, 1), F.lit("%"), F.right("n_name", F.lit(1))).alias("kw")).unionByName(n.limit(1).select(F.explode(F.array(F.lit("_n_"), F.lit("7000001"))).alias("kw")))
    dim = n.select(F.col("n_name").alias("name"), (7000000 + F.col("n_nationkey")).cast("string").alias("code"))
    return resolve.ilike_top(kw, "kw", dim, "name", "code", 5).select("kw", "name", "code", F.col("rank").cast("bigint").alias("rank"))


@query("""SELECT 'code' AS map, '' || s_suppkey AS key, 's' || s_suppkey AS value FROM supplier WHERE s_suppkey % 10 <> 0 UNION ALL SELECT 'name', lower(s_name), min('s' || s_suppkey) FROM supplier WHERE s_suppkey % 10 <> 0 GROUP BY 2 UNION ALL SELECT DISTINCT 'active', '' || s_suppkey, NULL FROM supplier WHERE s_suppkey % 10 <> 0""")
def bulk_maps(t):
    k = F.col("s_suppkey").cast("string")
    dim = t("supplier").select(F.concat(F.lit("s"), k).alias("id"), k.alias("code"), F.col("s_name").alias("name"), (F.col("s_suppkey") % 10 != 0).alias("is_active"))
    out = [m.select(F.lit(n).alias("map"), "key", "value") for n, m in (("code", resolve.code_map(dim, "code")), ("name", resolve.name_map(dim)))]
    return out[0].unionByName(out[1]).unionByName(resolve.active_codes(dim, "code").select(F.lit("active").alias("map"), F.col("code").alias("key"), F.lit(None).cast("string").alias("value")))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) IN (1995, 1996) AND o_custkey IN (1, 4, 7, 10, 13, 16, 19, 22, 25, 28)")
def scan_by_key_and_year(t):
    o = t("orders").select("o_orderkey", F.col("o_custkey"), F.year("o_orderdate").alias("year"))
    return resolve.scan(o, list(range(1, 30, 3)), [1995, 1996], "o_custkey").select("o_orderkey", "o_custkey")


# Dedup, merge, metrics and the whole plan.


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0")
def skip_stored(t):
    o = t("orders").select("o_orderkey")
    return dedup.skip_existing(o, o.where("o_orderkey % 3 = 0"), ["o_orderkey"])


@query("""
WITH x AS (SELECT 'U' || o_custkey % 50 AS c, 'm' || o_orderkey % 20 AS m, o_orderstatus AS s, min(o_orderkey) AS first, count(*) AS n FROM orders GROUP BY 1, 2, 3)
SELECT count(*) AS keys, sum(n)::BIGINT AS rows FROM x""")
def score_keys(t):
    """Scores by their key: codes and combinations in any case, a name where there is no code."""
    k = F.col("o_orderkey")
    u = F.concat(F.when(k % 2 == 0, "u").otherwise("U"), (F.col("o_custkey") % 50).cast("string"))
    df = t("orders").select(u.alias("university_code"), F.lit("").alias("major_code"), F.concat(F.when(k % 3 == 0, "M").otherwise("m"), (k % 20).cast("string")).alias("major_name_raw"), F.lit("2024").alias("year"), F.col("o_orderstatus").alias("admission_method"), F.when(k % 5 == 0, "a00").otherwise("A00").alias("subject_combination"))
    return df.groupBy(*dedup.score_key()).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"))


@query("""
WITH x AS (SELECT o_custkey % 500 AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 500 ORDER BY o_orderkey) AS rn FROM orders),
y AS (SELECT CASE WHEN rn > 1 OR k % 7 = 0 THEN 'in_memory' WHEN k % 5 = 0 THEN 'table' ELSE 'passed' END AS tier FROM x)
SELECT count(*) FILTER (tier = 'passed') AS passed, count(*) FILTER (tier <> 'passed') AS dropped, count(*) FILTER (tier = 'in_memory') AS in_memory_hits, count(*) FILTER (tier = 'table') AS table_hits FROM y""")
def dedup_counters(t):
    o = t("orders").select((F.col("o_custkey") % 500).alias("k"), "o_orderkey")
    keys = o.select("k").distinct()
    return dedup.counters(dedup.tiers(o, ["k"], ["o_orderkey"], keys.where("k % 7 = 0"), keys.where("k % 5 = 0")))


@query("""
SELECT (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 2 = 0) AS records_new, (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 2 = 1) AS records_updated,
(SELECT count(*) FROM customer WHERE c_custkey % 11 = 0 OR c_custkey % 17 = 0) AS records_failed""")
def dimension_sink(t):
    """Universities into their table: those without a code or name fail and are counted."""
    batch = _universities(t).withColumn("university_code", F.when(F.col("ingest_seq") % 11 != 0, F.concat(F.lit("u"), F.col("ingest_seq").cast("string"))))
    stored = t("customer").where("c_custkey % 2 = 1").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("university_code"), F.lit("old").alias("name"))
    return merge.store(stored, batch, "university_code", ["university_code", "name"], ["name"], ["ingest_seq"])[1]


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey % 4 <> 0")
def delete_by_id(t):
    s = t("supplier").select("s_suppkey")
    return merge.remove(s, s.where("s_suppkey % 4 = 0"), "s_suppkey")


@query("""
SELECT * FROM (VALUES ('valid_rate', (SELECT round(100.0::DOUBLE * count(*) FILTER (o_orderkey % 10 <> 0) / count(*), 2) FROM orders)), ('holland_coverage', (SELECT round(100.0::DOUBLE * count(*) FILTER (n_nationkey % 2 = 0) / count(*), 2) FROM nation)),
('description_rate', 100.0), ('combo_coverage', (SELECT round(100.0::DOUBLE * count(*) FILTER (n_nationkey > 0) / count(*), 2) FROM nation)),
('university_score_coverage', (SELECT round(100.0::DOUBLE * count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) / count(*), 2) FROM customer)),
('duplicate_rate', (SELECT round(100.0::DOUBLE * (count(*) - count(DISTINCT (o_custkey, o_orderkey % 25, year(o_orderdate), o_orderstatus))) / count(*), 2) FROM orders)), ('salary_coverage', (SELECT round(100.0::DOUBLE * count(*) FILTER (p_partkey % 4 <> 0) / count(*), 2) FROM part))) v(metric, value),
LATERAL (SELECT CASE WHEN metric = 'duplicate_rate' AND value <= 0 OR metric <> 'duplicate_rate' AND value >= CASE metric WHEN 'university_score_coverage' THEN 85 WHEN 'description_rate' THEN 90 WHEN 'salary_coverage' THEN 80 ELSE 95 END THEN 'pass' ELSE 'warn' END AS verdict)""")
def quality_metrics(t):
    k, n = F.col("o_orderkey"), F.col("n_nationkey")
    scores = t("orders").select(F.col("o_custkey").alias("university_id"), (k % 25).alias("major_id"), F.year("o_orderdate").alias("year"), F.col("o_orderstatus").alias("admission_method"), F.lit("A00").alias("subject_combination"), k)
    empty = F.array().cast("array<string>")
    majors = t("nation").select(n.alias("id"), F.when(n % 2 == 0, F.array(F.lit("R"))).otherwise(empty).alias("holland_types"), F.col("n_name").alias("description"), F.when(n > 0, F.array(F.lit("A00"))).alias("subject_combinations"))
    jobs = t("part").select(F.when(F.col("p_partkey") % 4 != 0, F.lit(1).cast("bigint")).alias("median_salary"))
    return metrics.quality(scores, k % 10 != 0, t("customer").select(F.col("c_custkey").alias("id")), majors, jobs)


@query("""
SELECT 'cutoff_score in range' AS "check", count(*) FILTER (o_orderkey % 9 = 0) AS violations FROM orders UNION ALL SELECT 'year in range', count(*) FILTER (o_orderkey % 8 = 0) FROM orders
UNION ALL SELECT 'key unique', (count(*) - count(DISTINCT (o_custkey, o_orderkey % 25, o_orderkey % 8 = 0, o_orderstatus)))::BIGINT FROM orders UNION ALL SELECT 'university known', count(*) FILTER (o_custkey % 2 = 1) FROM orders UNION ALL SELECT 'major known', count(*) FILTER (o_orderkey % 25 = 3) FROM orders""")
def table_checks(t):
    k = F.col("o_orderkey")
    scores = t("orders").select(F.col("o_custkey").alias("university_id"), (k % 25).alias("major_id"), F.when(k % 8 == 0, 2017).otherwise(2024).alias("year"), F.col("o_orderstatus").alias("admission_method"), F.lit("A00").alias("subject_combination"), F.when(k % 9 == 0, 101).otherwise(20).alias("cutoff_score"))
    return rules.table_checks(scores, t("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id")), t("nation").where("n_nationkey <> 3").select(F.col("n_nationkey").alias("id")))


@query("""
SELECT 'status' AS section, status AS metric, count(*)::DOUBLE AS value FROM (SELECT CASE WHEN failed > 0 THEN 'partial' ELSE 'success' END AS status FROM (SELECT event_type, count(*) FILTER (event_id % 1000 = 0) AS failed FROM events GROUP BY 1)) GROUP BY 2
UNION ALL SELECT 'running', 'running', 1 UNION ALL SELECT 'failed', 'failed', 1""")
def run_lifecycle(t):
    """Log rows of finished, running and failed runs, as a report of their statuses."""
    e = t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("records_new"), F.lit(0).alias("records_updated"), F.count_if(F.col("event_id") % 1000 == 0).alias("records_failed"))
    none = e.sparkSession.createDataFrame([(0, 0, 0)], "records_new int, records_updated int, records_failed int")
    parts = {
        "status": metrics.run_row(e, "s", "2024-01-01 00:00:00", "2024-01-01 01:00:00"), "running": metrics.run_row(none, "s", "2024-01-01 00:00:00", None), "failed": metrics.run_row(none, "s", "2024-01-01 00:00:00", "2024-01-01 00:00:01", error="x" * 3000),
    }
    counts = {k: metrics.count_by(p, F.col("status").alias("metric")).withColumnRenamed("n", "value") for k, p in parts.items()}
    return metrics.report("2024-01-01", **counts).drop("generated_at")


@query("""SELECT 'latest' AS section, strftime(day, '%Y-%m-%d') AS metric, n::DOUBLE AS value FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 5)
UNION ALL SELECT 'years', '' || year(o_orderdate), count(*)::DOUBLE FROM orders GROUP BY 2 UNION ALL SELECT 'low', c_mktsegment, min(c_acctbal) FROM customer GROUP BY 2 UNION ALL SELECT 'middle', c_mktsegment, median(c_acctbal) FROM customer GROUP BY 2""")
def report_sections(t):
    days = t("events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("value"))
    pay = metrics.salaries(t("customer"), "c_mktsegment", "c_acctbal")
    return metrics.report(
        "2024-01-01", latest=metrics.latest(days, "day").select(F.col("day").cast("string").alias("metric"), "value"), years=metrics.count_by(t("orders"), F.year("o_orderdate").cast("string").alias("metric")).withColumnRenamed("n", "value"),
        low=pay.select(F.col("c_mktsegment").alias("metric"), F.col("low").alias("value")), middle=pay.select(F.col("c_mktsegment").alias("metric"), F.col("middle").alias("value")),
    ).drop("generated_at")


_VALID = "o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0"
_NO_SCORES = "university_id string, major_id string, year smallint, admission_method string, subject_combination string, cutoff_score decimal(5,2), quota bigint, note string, scraped_at timestamp, source_url string"


@query(f"""
SELECT 'scores' AS part, count(*) AS n FROM (SELECT DISTINCT o_custkey % 50, o_orderkey % 20 FROM orders WHERE {_VALID}) UNION ALL SELECT 'new', count(*) FROM (SELECT DISTINCT o_custkey % 50, o_orderkey % 20 FROM orders WHERE {_VALID})
UNION ALL SELECT 'universities', count(DISTINCT o_custkey % 50) FROM orders WHERE {_VALID} UNION ALL SELECT 'majors', count(DISTINCT o_orderkey % 20) FROM orders WHERE {_VALID} UNION ALL SELECT 'dropped', count(*) FROM orders WHERE NOT ({_VALID})
UNION ALL SELECT 'new again', 0 UNION ALL SELECT 'unchanged again', count(*) FROM (SELECT DISTINCT o_custkey % 50, o_orderkey % 20 FROM orders WHERE {_VALID})""")
def admissions_run(t):
    """The whole plan from raw records to tables, run twice: the second run finds everything stored."""
    raw = records_of(t)
    spark = raw.sparkSession
    u = spark.createDataFrame([], "id string, university_code string, name string, university_type string, region string, is_active boolean")
    m = spark.createDataFrame([], "id string, major_code string, name string, major_group_code string, study_duration smallint, degree_level string, is_active boolean")
    at = tables.scratch(spark, "admissions")
    out = admissions.run(raw, spark.createDataFrame([], _NO_SCORES), u, m, "2024-01-01", more=[admissions.cut(f"{at}/once-1", 310), admissions.cut(f"{at}/rows-1")])
    kept = {}
    for k in ("scores", "universities", "majors"):
        tables.write_version(out[k], f"{at}/{k}", "1")
        kept[k] = tables.read_version(spark, f"{at}/{k}")
    again = admissions.run(raw, kept["scores"].drop("action"), kept["universities"], kept["majors"], "2024-01-01", more=[admissions.cut(f"{at}/once-2", 310), admissions.cut(f"{at}/rows-2")])
    parts = {k: df.agg(F.count(F.lit(1)).alias("n")) for k, df in kept.items()} | {"dropped": out["dropped"].agg(F.sum("n").alias("n")), "new": out["counters"].select(F.col("new").alias("n"))}
    parts |= {"new again": again["counters"].select(F.col("new").alias("n")), "unchanged again": again["counters"].select(F.col("unchanged").alias("n"))}
    return union_of([df.select(F.lit(k).alias("part"), "n") for k, df in parts.items()])


@query("""
SELECT 'university' AS kind, count(*) FILTER (r IS NULL) AS records_new, 0::BIGINT AS records_updated, 0::BIGINT AS records_failed, count(r) AS dropped FROM (SELECT CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0 THEN 1 END AS r FROM customer)
UNION ALL SELECT 'major', 0, count(*) FILTER (r IS NULL), 0, count(r) FROM (SELECT CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 OR p_partkey % 17 = 0 OR p_partkey % 7 = 0 OR p_partkey % 3 = 1 THEN 1 END AS r FROM part)""")
def dimension_runs(t):
    """Universities into an empty table, majors into one that has them all."""
    u, m = _universities(t), _majors(t)
    text = "name string, short_name string, university_type string, region string, province string, address string, website string, admission_url string, logo_url string, tuition_min bigint, tuition_max bigint, established_year bigint, scraped_at timestamp, source_url string"
    first = admissions.run_dimension("university", u, u.sparkSession.createDataFrame([], f"university_code string, {text}"), "2024-01-01")
    stored = normalize.majors(rules.listed(m)).withColumn("scraped_at", F.lit("2020-01-01").cast("timestamp"))
    second = admissions.run_dimension("major", m, stored.where("ingest_seq % 11 <> 0 and ingest_seq % 13 <> 0"), "2024-01-01")
    return union_of([r["counters"].join(F.broadcast(r["dropped"].agg(F.sum("n").alias("dropped")))).select(F.lit(k).alias("kind"), "records_new", "records_updated", "records_failed", "dropped") for k, r in (("university", first), ("major", second))])


@query("""
SELECT 'score' AS kind, count(*) AS n, count(*) FILTER (o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 OR o_orderkey % 19 = 0) AS dropped FROM orders
UNION ALL SELECT 'university', count(*), count(*) FILTER (c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0) FROM customer
UNION ALL SELECT 'major', count(*), count(*) FILTER (p_partkey % 11 = 0 OR p_partkey % 13 = 0 OR p_partkey % 17 = 0 OR p_partkey % 7 = 0 OR p_partkey % 3 = 1) FROM part UNION ALL SELECT 'job_category', count(*), 0 FROM supplier""")
def validate_types(t):
    """Records of all types; job groups have no rules and pass untouched."""
    jobs = t("supplier").select(F.col("s_name").alias("name"), F.lit(None).cast("bigint").alias("median_salary"))
    done = rules.validate_by_type({"score": records_of(t), "university": _universities(t), "major": _majors(t), "job_category": jobs}, "2024-01-01")
    dropped = {k: F.count("drop_reason") if "drop_reason" in df.columns else F.lit(0).cast("bigint") for k, df in done.items()}
    return union_of([df.agg(F.count(F.lit(1)).alias("n"), dropped[k].alias("dropped")).select(F.lit(k).alias("kind"), "n", "dropped") for k, df in done.items()])


@query("SELECT name, columns, k.n, k.least FROM (VALUES ('admission_scores', 12), ('universities', 19), ('majors', 19), ('crawl_logs', 10)) v(name, columns), (SELECT count(*) AS n, min(c_name) AS least FROM customer) k")
def stored_tables(t):
    """The stored tables made by their statements, the customers' names written to each as ids and read back."""
    spark = t("customer").sparkSession
    at, parts = tables.scratch(spark, "ddl"), []
    for k, (name, columns) in enumerate(TABLES.items()):
        own = f"{name}_{at[-32:]}"
        spark.sql(create_table(name, f"{at}/{k}").replace(f" {name} ", f" {own} ", 1))
        spark.createDataFrame([], columns).unionByName(t("customer").select(F.col("c_name").alias(columns.split()[0])), allowMissingColumns=True).write.insertInto(own)
        df = spark.read.parquet(f"{at}/{k}")
        parts.append(df.agg(F.count(F.lit(1)).alias("n"), F.min(columns.split()[0]).alias("least")).select(F.lit(name).alias("name"), F.lit(len(spark.table(own).columns)).alias("columns"), "n", "least"))
        spark.sql(f"DROP TABLE {own}")
    return union_of(parts)


@query("""SELECT n_nationkey AS ord, CASE WHEN n_nationkey % 2 = 0 THEN 'R,I' ELSE 'A' END AS types, lower(n_name) AS keyword, '' || (7000000 + n_nationkey) AS code FROM nation""")
def profile_resource(t):
    """Tag profiles through their file."""
    n, k = t("nation"), F.col("n_nationkey")
    made = n.select(k.cast("int").alias("ord"), F.when(k % 2 == 0, F.array(F.lit("R"), F.lit("I"))).otherwise(F.array(F.lit("A"))).alias("types"), F.array().cast("array<string>").alias("anchors"), F.array(F.lower("n_name")).alias("keywords"), F.array((7000000 + k).cast("string")).alias("codes"))
    at = tables.scratch(n.sparkSession, "profiles")
    tables.write_json_lines(made, at)
    return tables.read_profiles(n.sparkSession, at).select("ord", F.array_join("types", ",").alias("types"), F.col("keywords")[0].alias("keyword"), F.col("codes")[0].alias("code"))


@query("""
SELECT c_custkey, row, body, n FROM (SELECT c_custkey, unnest([0, 1, 2]) AS row, unnest([false, true, true]) AS body, unnest([6, 6, 3]) AS n FROM customer)""")
def sql_table_rows(t):
    """The table parser as a table function in SQL."""
    c = tables.spread(t("customer").select("c_custkey"), "c_custkey").select("c_custkey", _ministry_page(F.col("c_custkey")).alias("html"))
    H.register(c.sparkSession)
    return c.sparkSession.sql("SELECT c_custkey, r.row, r.body, size(r.cells) AS n FROM {pages}, LATERAL html_table_rows(html) r", pages=c)


@query(f"""
SELECT 'scores' AS part, count(*) AS n FROM (SELECT DISTINCT o_custkey % 50, o_orderkey % 20 FROM orders WHERE {_VALID}) UNION ALL SELECT 'universities', count(DISTINCT o_custkey % 50) FROM orders WHERE {_VALID}
UNION ALL SELECT 'majors', count(DISTINCT o_orderkey % 20) FROM orders WHERE {_VALID} UNION ALL SELECT 'records_new', count(*) FROM (SELECT DISTINCT o_custkey % 50, o_orderkey % 20 FROM orders WHERE {_VALID})
UNION ALL SELECT 'records_failed', count(*) FROM orders WHERE NOT ({_VALID}) UNION ALL SELECT 'batches', 2 UNION ALL SELECT 'partial', 2""")
def stream_admissions(t):
    """Raw records as a stream through the whole plan: half of them, and then the rest, a micro-batch each."""
    raw = records_of(t)
    spark, at = raw.sparkSession, tables.scratch(raw.sparkSession, "score-stream")
    for half in (0, 1):
        raw.where(F.floor(F.col("ingest_seq") / 100) % 2 == half).write.mode("append").parquet(f"{at}/in")
        records.run_available(spark.readStream.schema(raw.schema).parquet(f"{at}/in"), records.to_admissions(f"{at}/out", "admission_score", "2024-01-01"), f"{at}/progress")
    n = F.count(F.lit(1)).alias("n")
    log = spark.read.parquet(f"{at}/out/log")
    parts = {k: records.score_store(spark, f"{at}/out").read(k).agg(n) for k in ("scores", "universities", "majors")}
    parts |= {k: log.agg(F.sum(k).cast("bigint").alias("n")) for k in ("records_new", "records_failed")} | {"batches": log.agg(n), "partial": log.where("status = 'partial'").agg(n)}
    return union_of([df.select(F.lit(k).alias("part"), "n") for k, df in parts.items()])
