"""Pages to rows: links and fields by pattern, tables by a parser, view-source pages un-rendered."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def links(html: Column, pattern: str = r"<a\s+href=\"([^\"]*)\">([^<]*)</a>") -> Column:
    """(href, text) of each plain link, in order."""
    return F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("label"))


def title(html: Column) -> Column:
    return T.clean_text(T.unescape(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1)))


def absolute_url(href: Column, base: str) -> Column:
    root = base.rstrip("/")
    return F.when(href.rlike("^https?://"), href).when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(F.lit(root), href)).otherwise(F.concat(F.lit(root + "/"), href))


def page_urls(template: str, spark, years: list[int], page: int = 1) -> DataFrame:
    rows = spark.createDataFrame([(y,) for y in years], "year int")
    return rows.withColumn("url", F.replace(F.replace(F.lit(template), F.lit("{year}"), F.col("year").cast("string")), F.lit("{page}"), F.lit(str(page))))


def with_param(url: Column, name: str, value: Column) -> Column:
    """url with one query parameter set: of repeated parameters the first value stays, those without a value go, and the parameter
    takes the place where it stood first, or the end. What follows # stays."""
    query, tail = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), F.regexp_extract(url, "(#.*)$", 1)
    parts = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=."))
    names = F.transform(parts, lambda p: F.substring_index(p, "=", 1))
    first = F.filter(parts, lambda p, i: F.array_position(names, F.substring_index(p, "=", 1)) == i + 1)
    put = F.concat(F.lit(f"{name}="), value.cast("string"))
    there = F.transform(first, lambda p: F.when(F.substring_index(p, "=", 1) == name, put).otherwise(p))
    whole = F.when(F.array_contains(names, name), there).otherwise(F.concat(first, F.array(put)))
    return F.concat(F.regexp_extract(url, "^[^?#]*", 0), F.lit("?"), F.array_join(whole, "&"), tail)


def following_pages(df: DataFrame, page: str, total: str, url: str, template: str | None = None, param: str = "page") -> DataFrame:
    """The pages after each row's page, up to its total: `template` with {page}, or the url with its parameter set."""
    more = df.where(F.col(page) < F.col(total)).withColumn("next", F.explode(F.sequence(F.col(page) + 1, F.col(total))))
    n = F.col("next").cast("string")
    return more.withColumn("next_url", F.replace(F.lit(template), F.lit("{page}"), n) if template else with_param(F.col(url), param, n))


def attribute(html: Column, tag: str, name: str) -> Column:
    """The attribute of the first such element, stripped; null where there is none."""
    return T.clean_text(T.unescape(F.regexp_extract(html, rf"(?s)<{tag}\b[^>]*?\s{name}=\"([^\"]*)\"", 1)))


def texts_of(html: Column, tag: str) -> Column:
    """The texts of all such elements without markup, squeezed, empty ones left out."""
    found = F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    return F.filter(F.transform(found, lambda x: T.clean_text(T.unescape(F.regexp_replace(x, "<[^>]*>", "")))), lambda x: x.isNotNull())


def catalog(pages: DataFrame, base: str, codes: list[str] | None = None, url: str = "url", html: str = "html") -> DataFrame:
    """source_url, university_code, name, detail_url for each link of the catalog's list. The text is `CODE - name`; where it is not, the
    code is the last part of the link's address. Links without a code are left out."""
    box = F.regexp_extract(F.col(html), r"(?s)class=\"[^\"]*\blist-schol-box\b[^\"]*\"(.*?)</div>", 1)
    found = F.regexp_extract_all(box, F.lit(r"(?s)<li>\s*<a\b([^>]*>.*?)</a>"), F.lit(1))
    rows = pages.select(F.col(url).alias("source_url"), F.explode(found).alias("a"))
    rows = rows.select("source_url", F.regexp_extract("a", r"href=\"([^\"]*)\"", 1).alias("href"), T.unescape(F.regexp_replace(F.regexp_replace("a", "^[^>]*>", ""), "<[^>]*>", "")).alias("label"))
    listed = r"^\s*([A-Z0-9]{2,10})\s*-\s*(.+)$"
    code = F.coalesce(T.blank_to_null(F.regexp_extract("label", listed, 1)), T.blank_to_null(T.slug_code("href")))
    name = F.coalesce(T.blank_to_null(T.strip(F.regexp_extract("label", listed, 2))), F.col("label"))
    out = rows.select("source_url", code.alias("university_code"), name.alias("name"), absolute_url(F.col("href"), base).alias("detail_url")).where("university_code is not null")
    return out.where(F.upper("university_code").isin(codes)) if codes else out


def unrender(html: Column) -> Column:
    """The text of a browser's view-source page: a line for each td.line-content, tags dropped, references decoded."""
    cells = F.regexp_extract_all(html, F.lit(r"(?s)<td class=\"line-content\">(.*?)</td>"), F.lit(1))
    return F.array_join(F.transform(cells, lambda c: T.unescape(F.regexp_replace(c, r"<[^>]+>", ""))), "\n")


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, str, bool, list[str]]] = []
        self.body = False
        self.heading, self.table, self.open = "", 0, []
        self.cells: list[list[str]] | None = None
        self.into: list[str] | None = None
        self.head: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table += 1
            self.body = False
        elif tag in ("tbody", "thead", "tfoot"):
            self._end()
            self.body = tag == "tbody"
        elif tag == "tr":
            self._end()
            self.cells = []
        elif tag in ("td", "th") and self.cells is not None:
            self.into = []
            self.cells.append(self.into)
        elif tag in ("h2", "h3"):
            self.head = []

    def handle_endtag(self, tag):
        if tag in ("tr", "table", "tbody", "thead", "tfoot"):
            self._end()
            self.body = self.body and tag == "tr"
        elif tag in ("td", "th"):
            self.into = None
        elif tag in ("h2", "h3") and self.head is not None:
            self.heading, self.head = " ".join(" ".join(self.head).split()), None

    def handle_data(self, data):
        for to in (self.into, self.head):
            if to is not None:
                to.append(data)

    def _end(self):
        if self.cells:
            self.rows.append((self.table, self.heading, self.body, [" ".join(x.strip() for x in c if x.strip()) for c in self.cells]))
        self.cells = self.into = None


def table_rows(pages: DataFrame, url: str = "url", html: str = "html", min_cells: int = 1, carry: tuple[str, ...] = ()) -> DataFrame:
    """url, table, row, heading (the nearest h2 or h3 before), body (within a tbody), cells: each table row with at least min_cells
    cells, and the columns `carry` of its page. Filter pages before this call; nothing is pushed through it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for u, h, *more in zip(f["url"], f["html"], *(f[c] for c in carry), strict=True):
                p = _Tables()
                p.feed(h or "")
                p.close()
                p._end()
                out += [(u, t, k, head, body, cells, *more) for k, (t, head, body, cells) in enumerate(p.rows) if len(cells) >= min_cells]
            yield pd.DataFrame(out, columns=["url", "table", "row", "heading", "body", "cells", *carry])

    schema = "url string, table int, row int, heading string, body boolean, cells array<string>" + "".join(f", {c} {pages.schema[c].dataType.simpleString()}" for c in carry)
    return pages.select(F.col(url).alias("url"), F.col(html).alias("html"), *carry).mapInPandas(run, schema)


def register(spark) -> None:
    """html_table_rows(html) for SQL: table, row, heading, body and cells of each table row of a page, in a lateral join."""
    from pyspark.sql.functions import udtf

    class Rows:
        def eval(self, html: str):
            p = _Tables()
            p.feed(html or "")
            p.close()
            p._end()
            for k, (t, head, body, cells) in enumerate(p.rows):
                yield t, k, head, body, cells

    spark.udtf.register("html_table_rows", udtf(Rows, returnType="table int, row int, heading string, body boolean, cells array<string>"))


def cell(k: int) -> Column:
    """The k-th cell from 1; one out of range is empty."""
    return F.coalesce(F.try_element_at("cells", F.lit(k)), F.lit(""))


def ministry_scores(pages: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """The ministry's score tables as raw records: rows of five cells or more within a tbody. The method is told by the programme's
    name, and the year is that of the page, where pages has one."""
    carry = ("year",) if "year" in pages.columns else ()
    rows = table_rows(pages, min_cells=5, carry=carry).where("body")
    out = rows.select(
        T.scan_code(cell(1)).alias("university_code"), cell(4).alias("major_name_raw"), T.seven_digits(cell(3)).alias("major_code"), T.title_method(cell(4)).alias("admission_method"),
        T.scan_combo(cell(5)).alias("subject_combination"), T.score(cell(6)).cast("string").alias("cutoff_score"), F.col("url").alias("source_url"), "table", "row", *carry,
    )
    return out.where(F.col("university_code").isin(codes)) if codes else out


def detail_scores(pages: DataFrame, code: Column | str, as_of_year: int, years: list[int]) -> DataFrame:
    """The aggregator's detail tables: the year and method of the heading, a row for each combination listed. `code` is the column of
    pages with the university's code, or a constant. Rows of fewer than three cells, without a name, or that name the column are left out."""
    rows = table_rows(pages, min_cells=3, carry=(code,) if isinstance(code, str) else ()).where("body")
    title = T.nfc(F.lower("heading"))
    year = F.coalesce(F.regexp_extract(title, r"(?U)năm\s+(\d{4})", 1).try_cast("int"), F.lit(as_of_year))
    rows = rows.withColumn("year", year).where(F.col("year").isin(years)).where((cell(1) != "") & ~F.contains(F.lower(cell(1)), F.lit("tên ngành")))
    combos = F.when(cell(2) == "", F.array(F.lit("KHAC"))).otherwise(F.split(cell(2), ","))
    return rows.select(
        (F.col(code) if isinstance(code, str) else code).alias("university_code"), cell(1).alias("major_name_raw"), "year", T.title_method("heading").alias("admission_method"), F.explode(combos).alias("c"),
        T.score(cell(3)).alias("cutoff_score"), T.blank_to_null(cell(4)).alias("note"), F.col("url").alias("source_url"),
    ).withColumn("subject_combination", T.scan_combo("c")).drop("c")


# Places in an address that tell the region; any other place is in the south.
NORTH, CENTRAL = ["hà nội", "thái nguyên", "phú thọ"], ["đà nẵng", "huế"]


def university_fields(text: Column) -> dict[str, Column]:
    """Website, address, region and province of a detail page's text; region and province only where there is an address."""
    text = T.nfc(text)
    address = T.blank_to_null(T.strip(F.regexp_extract(text, r"(?iu)(?:địa chỉ|trụ sở):\s*([^;.\n]+)", 1)))
    website = T.blank_to_null(F.regexp_replace(F.regexp_extract(text, r"(?i)(?:website|web):\s*([^\s,;]+)", 1), "^/+|/+$", ""))
    region = F.when(address.isNotNull(), T.first_keyword(F.lower(address), [(NORTH, "north"), (CENTRAL, "central")], "south"))
    return {"website": website, "address": address, "region": region, "province": T.strip(F.try_element_at(F.split(address, ","), F.lit(-1)))}


def universities(details: DataFrame, code: str, name: str, text: Column, as_of) -> DataFrame:
    """A raw university record for each detail page."""
    return details.select(
        F.col(code).alias("university_code"), F.col(name).alias("name"), F.col(code).alias("short_name"), F.lit("public").alias("university_type"),
        *[c.alias(k) for k, c in university_fields(text).items()], F.lit(as_of).cast("timestamp").alias("scraped_at"), F.col("url").alias("source_url"),
    )


def next_page(html: Column, page: Column, limit: int = 50) -> Column:
    """The href of the link that is labelled as the next page; null past the limit or where there is none."""
    href = F.regexp_extract(html, r"<a[^>]*href=\"([^\"]*)\"[^>]*>\s*(?:›|&rsaquo;|Next|Sau)\s*</a>", 1)
    return F.when((page < limit) & (href != ""), href)


def site_config(defaults: DataFrame, overrides: DataFrame, key: str = "university_code") -> DataFrame:
    """One row of settings a site: the single row of defaults, each field replaced by the site's own where that is not null."""
    from ..operators.resolve import small

    fields = [c for c in defaults.columns if c != key]
    base = F.broadcast(defaults.limit(1).select(F.struct(*fields).alias("__base")))
    sites = small(overrides).join(base)
    return sites.select(key, *[F.coalesce(F.col(c), F.col(f"__base.{c}")).alias(c) if c in overrides.columns else F.col(f"__base.{c}").alias(c) for c in fields])


def site_scores(pages: DataFrame, config: DataFrame, years: list[int], codes: list[str] | None = None) -> DataFrame:
    """A university's own tables as raw records. pages: university_code, url, html. config: university_code and the cells, from 1,
    of major, combination and score (major_cell, combo_cell, score_cell). The year is the last one asked for; rows of fewer than two
    cells, or without a name or a score, are left out, as are pages of sites that have no settings."""
    from ..operators.resolve import small

    picked = pages.where(F.col("university_code").isin(codes)) if codes else pages
    at = ("major_cell", "combo_cell", "score_cell")
    known = picked.join(small(config.select("university_code", *at)), "university_code")
    rows = table_rows(known, min_cells=2, carry=("university_code", *at))
    name, combo, score = (F.coalesce(F.try_element_at("cells", F.col(c)), F.lit("")) for c in at)
    return rows.where((name != "") & (score != "")).select(
        T.scan_code("university_code").alias("university_code"), name.alias("major_name_raw"), F.lit(years[-1]).alias("year"), T.title_method("heading").alias("admission_method"),
        T.scan_combo(combo).alias("subject_combination"), T.score(score).alias("cutoff_score"), F.col("url").alias("source_url"),
    )
