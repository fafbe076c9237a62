"""Extraction, packing, counts, classifiers, language and language model: brute force, round trips and held-out accuracy."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import hashing, html_extract, lang_id, lm_score, packing, quality, token_counts, toxicity
from millrace.llm.common import documents
from millrace.llm.training import sample

DATA = "/root/testdata"
DIR = f"{DATA}/sf0.001"


PAGES = [
    ("<article><h1>T &amp; U</h1><p>One,  two &lt;b&gt;<br>three<p>Four<ul><li>x<li>y</ul></article><footer>F</footer>", "T & U\nOne, two <b> three\nFour\nx\ny"),
    ("<nav><a href=/>Home</a></nav><div id=content><p>Some long paragraph, with commas, that reads well enough.</p><div class='comments'><p>first! a long comment, by a reader, here</p></div></div><aside>s</aside>", "Some long paragraph, with commas, that reads well enough."),
    ("<body><div class='cookie-notice'>We use cookies, many</div><main><p>Short</p></main><form><p>Mail, name, address please now</p></form>", "Short"),
    ("<p>a<script>var x='<p>no</p>'</script>b</p><style>p{}</style><!-- <p>c</p> -->", "ab"),
    ("", ""),
    (None, ""),
    ("no markup", "no markup"),
    ("<article><p>unclosed <b>bold, and more, and more text here", "unclosed bold, and more, and more text here"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_extract(page, want):
    assert html_extract.extract(page) == want


_PARA = "word, " * 3 + "w" * 382


@pytest.mark.parametrize("paragraphs", [2, 10])
def test_extract_without_an_article_element(paragraphs):
    body, text = f"<p>{_PARA}</p>" * paragraphs, [_PARA] * paragraphs
    links = "<h2>More</h2><ul><li><a href=/a>Some other page</a><li><a href=/b>One more page</a></ul>"
    beside = "<pre>code</pre>bare <b>text</b><blockquote>quote</blockquote><ol><li>item</ol><table><tr><td>cell</table><section>short</section>"
    want = ["Title", *text, "code", "bare text", "quote", "item", "cell", "short"]
    for page in ("<main>{}</main>", "<div class=content>{}</div>", "<body><div>{}</div>", "<div class='page has-sidebar'>{}<div class=sidebar>About us</div></div>"):
        assert html_extract.extract(page.format(f"<h1>Title</h1><div>{body}</div>{beside}")).split("\n") == want
    assert html_extract.extract(f"<div><h1><a href=/>Title</a></h1><div class=entry-content>{body}</div><blockquote>quote</blockquote></div><div class=comments>{body}</div>").split("\n") == ["Title", *text, "quote"]
    assert html_extract.extract(f"<body><div>{body * 3}</div><blockquote>quote</blockquote>{links}").split("\n") == [*text * 3, "quote"]
    assert html_extract.extract(f"<div hidden>{body * 3}</div><nav>{body * 3}</nav><div>{body}</div>").split("\n") == text


@given(st.text(alphabet="<>/ab\"'=&;!- \n", max_size=200))
@settings(max_examples=300, deadline=None)
def test_extract_never_fails(page):
    out = html_extract.extract(page)
    assert out == "\n".join(x for x in (" ".join(b.split()) for b in out.split("\n")) if x)


def test_extract_all_pages(spark):
    """The article's blocks by pattern, on pages of known make."""
    for r in html_extract.op2_html_extraction(spark, DIR).join(spark.read.parquet(f"{DIR}/pages.parquet").select("page_id", "html"), "page_id").collect():
        from html import unescape

        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0][:3] == "<br" else "", b)).split()) for b in re.split(r"</?(?:h1|p|div|ul|li)\b[^>]*>", body)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("page, want", [
    ('<article><p>Hello there</p><div data-x="' + "a>" * 3000 + '">World</div></article>', "Hello there\nWorld"),
    ('<article><h2 class="section-header">S</h2><p>Body</p><p class="notice-period">N</p><p id="search">Q</p><p class="advert">A</p></article>', "S\nBody\nN\nQ"),
    ("<article><header><h1>T</h1></header><p>Sum <math><mi>x</mi><mo>=</mo><annotation>tex</annotation></math></article><header>Site</header>", "T\nSum x="),
    ("<article><p>x&am<b>p;</b> y &amp; z</p></article>", "x&amp; y & z"),
    ("<b><p>one</b> two</p>", "one two"),
    ("<p>a<!-->b</p>c", "ab\nc"),
    ('<article><p>Long enough to be read, yes</p><pre><code>x <span class="token comment"># c</span></code></pre><div class="comments-section"><article class="comment"><p>first</p></article></div></article>', "Long enough to be read, yes\nx # c"),
    ('<main><div class="page-header"><h1>T</h1></div><p>Body of it, said</p><div class="related-posts">R</div><ul class="social-media-links"><li>S</ul><div class="newsletter-signup">N</div><p class="search-results">F</p></main>', "T\nBody of it, said\nF"),
    ('<div class="header">Site</div><div class="post"><div class="entry-header"><h1>T</h1></div><p>Body of it, said</p></div>', "T\nBody of it, said"),
    ("<form><article><p>in a form</p></article></form><form><p>Your name, please</p></form>", "in a form"),
])
def test_extract_keeps_the_whole_article(page, want):
    assert html_extract.extract(page) == want


def test_extract_keeps_sibling_articles():
    body = f"<p>{_PARA}</p>" * 6
    for page in ("<main><article>{}</article><article><p>short one</p></article></main>", "<body><div class=post>{}</div><div class=post><p>short one</p></div>"):
        assert html_extract.extract(page.format(body)).split("\n") == [_PARA] * 6 + ["short one"]


@pytest.mark.parametrize("make", [
    lambda n: "<div>" * n + "<li>" * n, lambda n: "<p>x<b>" * n + '<a href="' * n, lambda n: "<table><tr><td>" * n + "</b>" * n, lambda n: "<span>" * n + "<div></span>" * n,
    lambda n: "<a b='x\" c=\"y>" * n, lambda n: "<ul><li>" * n + "</li></ul>" * n, lambda n: "<p>" * n + "<!--" * n, lambda n: "<b" + " =" * n + '"' * n,
])
def test_extract_takes_linear_time(make):
    import time

    def took(n):
        t = time.process_time()
        html_extract.extract(make(n))
        return time.process_time() - t

    took(1000)
    assert took(32_000) < 40 * max(took(2000), 0.005)


@pytest.mark.parametrize("open_, close", [("<div>", "</div>"), ("<div class=content>", "</div>"), ("<section>", "</section>"), ("<main>", "</main>"), ("<td>", "</td>"), ("<div class='col'><div id=x1>", "</div></div>"), ("", "")])
def test_extract_recall_without_the_tag(spark, open_, close):
    """The test pages with their article element replaced: at least nine tenths of its text is found, and little else."""
    found = wanted = more = 0
    for r in spark.read.parquet(f"{DIR}/pages.parquet").collect():
        want = html_extract.extract(r["html"]).split("\n")
        got = html_extract.extract(r["html"].replace("<article>", open_).replace("</article>", close)).split("\n")
        both = sum((Counter(want) & Counter(got)).values())
        found, wanted, more = found + both, wanted + len(want), more + len(got) - both
    assert found >= 0.9 * wanted and more <= 0.05 * wanted


def test_extract_odd_pages(spark):
    long = "<article>" + "<p>" + "word, " * 200 + "</p>"
    rows = [(1, "u", "<article><p>a</p></article>"), (1, "u", "<article><p>a</p></article>"), (None, None, None), (2, None, ""), (3, "v", long + ("<p>" + "y " * 50_000 + "</p>") * 100 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS text", "'z' AS n_chars")
    got = sorted(((r["page_id"] or 0, r["url"] or "", len(r["text"]), r["n_chars"]) for r in html_extract.extract_pages(pages).collect()))
    n = 200 * 6 - 1 + 100 * 100_000
    assert got == [(0, "", 0, 0), (1, "u", 1, 1), (1, "u", 1, 1), (2, "", 0, 0), (3, "v", n, n)]
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_packing_round_trip(spark, odd_docs, empty_docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = odd_docs.select("doc_id", "text").unionByName(documents(spark, DIR).selectExpr("doc_id + 1000 AS doc_id", "text"))
    rows = packing.pack_documents(docs).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append(r)
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    want = defaultdict(Counter)
    for r in docs.collect():
        ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        for p in packing.cut(ids, 1024):
            want[r["doc_id"]][p] += 1
    assert {k: Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in v) for k, v in pieces.items()} == dict(want)
    lengths = np.array([r["length"] for r in rows])
    assert len(bins) <= packing.lower_bound(lengths, 1024) * 1.01 + 1
    assert packing.pack_documents(empty_docs).count() == 0


def test_exchange_between_partitions(spark):
    """Partitions that cannot fill their sequences exchange pieces; nothing is lost and bins come near the bound."""
    from millrace.llm.common import materialize

    rows = materialize(spark.createDataFrame([(k, 0, 0, 40 + k * 37 % 600, k) for k in range(2000)], "doc_id long, piece int, start long, length long, ids_crc32 long"))
    got = packing.pack(rows, partition_rows=300).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(2000))
    assert len({r["sequence_id"] for r in got}) <= 1.03 * packing.lower_bound(np.array([r["length"] for r in got]), 1024)


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=150, deadline=None)
def test_bound_and_packing_hold(lengths):
    """The bound never exceeds the optimum, by search."""
    x = np.array(lengths)
    bins, offset, rooms = packing.best_fit_decreasing(x, 20)
    assert all(x[bins == b].sum() + rooms[b] == 20 for b in range(len(rooms)))
    best = len(rooms)

    def search(i, open_):
        nonlocal best
        if len(open_) >= best:
            return
        if i == len(lengths):
            best = len(open_)
            return
        for k in range(len(open_)):
            if open_[k] + lengths[i] <= 20:
                open_[k] += lengths[i]
                search(i + 1, open_)
                open_[k] -= lengths[i]
        search(i + 1, [*open_, lengths[i]])

    search(0, [])
    assert packing.lower_bound(x, 20) <= best


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_library(text):
    assert _fast(text) == np.asarray(_slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_fast = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
_slow = __import__("tokenizers").Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_equality_with_the_library_is_proved():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.same_as_ranks(path) and not packing.same_as_ranks(public_tokenizers.path("word_bpe_49k.json"))


def test_every_code_point_is_split_as_the_library_does():
    points = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000]
    for k in range(0, len(points), 20_000):
        text = "".join(p + ("a" if i % 3 == 0 else " " if i % 3 == 1 else "1") for i, p in enumerate(points[k : k + 20_000]))
        assert _fast(text) == np.asarray(_slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_repeated_rows_are_dealt_over_all_partitions(spark):
    from pyspark.sql import functions as F

    docs = spark.range(4000, numPartitions=8).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = packing.pack(packing.materialize(packing.pieces(docs), "same"), partition_rows=500)
    first = got.where("sequence_id >= 0").groupBy((F.col("sequence_id") / (1 << 32)).cast("long") % (1 << 24)).count().collect()
    assert got.count() == 4000 and len(first) == 8 and max(r["count"] for r in first) < 1000
    used, bound = packing.certificate(got)
    assert bound <= used <= bound + 8


def test_other_tokenizer_files():
    path = public_tokenizers.path("word_bpe_49k.json")
    t = __import__("tokenizers").Tokenizer.from_file(path)
    assert packing.encoder(path)("Hello there") == np.asarray(t.encode("Hello there", add_special_tokens=False).ids, "<u4").tobytes()


def test_token_counts_and_cache(spark, odd_docs, empty_docs, tmp_path):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    cache = f"file://{tmp_path}/cache"
    assert token_counts.count_tokens(empty_docs, cache).count() == 0
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), len(sp.encode(r["text"] or ""))) for r in odd_docs.collect())
    for _ in range(2):
        got = token_counts.count_tokens(odd_docs, cache).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("text_sha256").distinct().count() == len({r["text"] or "" for r in odd_docs.collect()})


def test_language(spark, odd_docs, empty_docs):
    model = lang_id.learn(documents(spark, DIR).where(~lang_id.held_out()))
    table = lang_id.predict(documents(spark, DIR)).join(documents(spark, DIR).select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in table]) > 0.98
    got = {r["doc_id"]: r for r in lang_id.identify(odd_docs, model).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 8, 11)) and got[1]["lang_pred"] != "und"
    kept = lang_id.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and not {r["doc_id"] for r in kept.collect()} & {3, 4, 8, 11}
    none = lang_id.learn(empty_docs)
    assert {r["lang_pred"] for r in lang_id.identify(odd_docs, none).collect()} == {"und"} and lang_id.identify(empty_docs, model).count() == 0


def test_unlearned_languages_go(spark):
    model = lang_id.learn(documents(spark, "/root/testdata/sf0.01").where(~lang_id.held_out()))
    out = [
        "Сегодня утром в городе прошёл сильный дождь, и жители остались дома.", "今日は朝から強い雨が降っていて、町の人々は家にいました。", "今天早上城里下了大雨，居民们都留在家里。",
        "xkq zvwp qjjx bvnk wqzx ptkk ghxz qqwv jkzx mnbv xzqk", "Dziś rano nad miastem spadł ulewny deszcz i mieszkańcy pozostali w domach.",
        "Bu sabah şehirde şiddetli yağmur yağdı ve sakinler evlerinde kaldı.", "هطلت أمطار غزيرة على المدينة هذا الصباح وبقي السكان في منازلهم",
    ]
    kept = [
        "This morning heavy rain fell on the city and the residents stayed at home with their children.", "Heute Morgen fiel starker Regen auf die Stadt und die Bewohner blieben zu Hause.",
        "Ce matin une forte pluie est tombée sur la ville et les habitants sont restés chez eux.", "Esta mañana cayó una fuerte lluvia sobre la ciudad y los habitantes se quedaron en casa.",
    ]
    rows = spark.createDataFrame(list(enumerate(out + kept)), "doc_id long, text string")
    assert sorted(r["text"] for r in lang_id.keep_identified(rows, model).collect()) == sorted(kept)
    docs = documents(spark, "/root/testdata/sf0.01")
    assert lang_id.keep_identified(docs, model).count() >= 0.999 * docs.count()


def test_word_characters_are_pythons_own():
    table = hashing.points_like(r"[^\W_]")
    assert all(table[c] == (re.fullmatch(r"[^\W_]", chr(c)) is not None) for c in range(0xD800))


def test_words_by_pattern():
    texts = ["Aé_b9c d'E\u0308f ²x", "", "123 !", "ß" * 60 + " q", "ΑΣ ΣΑ İx", "日本 語\U00020000"]
    w = lang_id.words_of(texts)
    want = [[x for m in regex.findall(r"\p{L}+", t.lower()) for x in (("▁" if k == 0 else "") + m[k : k + lang_id.MAX_LEN] for k in range(0, len(m), lang_id.MAX_LEN))] for t in texts]
    assert w.per_text.tolist() == [len(x) for x in want]
    got = [""] * len(w.hash)
    for at, points in lang_id.lattice_rows(w, np.arange(len(w.hash)), 100):
        for k, row in zip(at, points, strict=True):
            got[k] = "".join(map(chr, row))
    flat = [x for ws in want for x in ws]
    assert got == flat and len(set(zip(got, w.hash.tolist(), strict=True))) == len(set(flat)) == len(set(w.hash.tolist()))


def test_scores_do_not_depend_on_what_is_kept(spark):
    docs = documents(spark, DIR)
    model = lang_id.learn(docs)
    texts = [r["text"] for r in docs.collect()]
    a, b = (lang_id.scorer(model.pieces, model.table, model.languages, n) for n in (250_000, 300))
    whole = a(texts)
    parts = [b(texts[k : k + 7]) for k in range(0, len(texts), 7)]
    for i in range(4):
        x = np.concatenate([p[i] for p in parts])
        assert (x == whole[i]).all() if i in (0, 3) else np.allclose(x, whole[i])


def test_language_scores_by_all_segmentations(spark):
    """Posterior and likelihood of texts from the summed probabilities of all segmentations of each word, one by one."""
    docs = documents(spark, DIR)
    model = lang_id.learn(docs.limit(50))
    place = {p: k for k, p in enumerate(model.pieces)}

    def word(w, lang):
        total = [1.0] + [0.0] * len(w)
        for j in range(1, len(w) + 1):
            for i in range(max(0, j - 40), j):
                k = place.get(w[i:j])
                total[j] += total[i] * (model.table[k, lang] if k is not None else lang_id._UNKNOWN if j == i + 1 else 0.0)
        return math.log(total[-1])

    texts = ["The und heereint 12 été", "Straße über-all, señor", "x", "日本 the"]
    lang, score, log, letters = lang_id.scorer(model.pieces, model.table, model.languages)(texts)
    for k, t in enumerate(texts):
        words = regex.findall(r"\p{L}+", t.lower())
        sums = [sum(word("▁" + w, j) for w in words) for j in range(len(model.languages))]
        top = max(sums)
        assert log[k] == pytest.approx(top) and letters[k] == sum(map(len, words)) and lang[k] == model.languages[sums.index(top)]
        assert score[k] == pytest.approx(1 / sum(math.exp(s - top) for s in sums))


def test_equal_scores_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(1, "same words here", "zz"), (2, "same words here", "aa"), (3, "other", None)], "doc_id long, text string, lang string")
    got = lang_id.identify(docs, lang_id.learn(docs)).collect()
    assert {r["lang_pred"] for r in got} == {"aa"} and all(abs(r["score"] - 0.5) < 1e-9 for r in got)
    with pytest.raises(ValueError):
        lang_id.learn(docs, max_languages=1)


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "bab"]
    p = np.append(np.arange(1, 8) / 28, 0)
    lattice = lang_id.Lattice(pieces)

    def brute(w):
        return 1.0 if not w else sum(p[k] * brute(w[len(x) :]) for k, x in enumerate(pieces) if w.startswith(x)) + (0 if w[0] in pieces else lang_id._UNKNOWN * brute(w[1:]))

    for w in ("▁abab", "▁babz", "▁a" + "ab" * 12):
        got = lattice.forward([w], np.stack([p, p], 1))[0]
        assert got == pytest.approx([math.log(brute(w))] * 2)
    e = lattice.expected(["▁abab"], np.array([3.0]), p)
    assert sum(e[k] * len(x) for k, x in enumerate(pieces)) == pytest.approx(3 * 5)


def test_lm_against_counts(spark, odd_docs, empty_docs):
    docs = odd_docs.select("doc_id", "text").unionByName(documents(spark, DIR).selectExpr("doc_id + 1000 AS doc_id", "text"))

    def words(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]

    train = docs.where(~lm_score.held_out())
    n = Counter(w for r in train.collect() for w in words(r["text"]))
    total, d = sum(n.values()), sum(n.values()) + 0.5 * (len(n) + 1)
    for options in ({}, {"word_rows": 10, "bucket_bytes": 100_000}):
        got = lm_score.score(docs, lm_score.learn(train, **options)).collect()
        want = Counter((r["doc_id"], len(words(r["text"])), sum(w in n for w in words(r["text"])), round(sum(math.log10((n[w] + 0.5) / d) for w in words(r["text"])), 6)) for r in docs.collect())
        assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
        assert {r["train_tokens"] for r in got} == {total} and all(r["score"] < 0 for r in got)
    out = [r for r in lm_score.op10_lm_scoring(spark, DIR).collect() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert lm_score.score(empty_docs, lm_score.learn(train)).count() == 0
    assert lm_score.score(odd_docs, lm_score.learn(empty_docs)).count() == odd_docs.count()


@pytest.mark.parametrize("options", [{}, {"filter_bytes": 1000, "bucket_bytes": 50_000}])
def test_lm_score_by_brute_force(spark, odd_docs, monkeypatch, options):
    """The interpolated probability from exact counts, quantised: the same where the filter is so large that it does not err, and
    close by with the filter of the query."""
    docs = odd_docs.select("doc_id", "text").unionByName(documents(spark, DIR).selectExpr("doc_id + 1000 AS doc_id", "text"))

    def words(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]

    train = docs.where(~lm_score.held_out())
    one, two = Counter(), Counter()
    for r in train.collect():
        w = words(r["text"])
        one.update(w)
        two.update(zip([None, *w], w, strict=False))
    d = sum(one.values()) + 0.5 * (len(one) + 1)

    def middle(c):
        lev = int(math.log(c) / math.log(lm_score.BASE) + 1e-9) + 1 if c else 0
        return 0.0 if not lev else 1.0 if lev == 1 else max(1.0, lm_score.BASE ** (lev - 1 + 0.45))

    def brute(t):
        w, out = words(t), 0.0
        for a, b in zip([None, *w], w, strict=False):
            c1, c2, before = middle(one[b]), middle(two[a, b]), middle(one[a])
            share = before / (before + lm_score.PRIOR)
            out += math.log10(share * min(c2 / max(before, 1), 1.0) + (1 - share) * (c1 + 0.5) / d)
        return out

    want = sorted((r["doc_id"] or 0, len(words(r["text"])), brute(r["text"])) for r in docs.collect())
    for bits, most in ((lm_score.BITS_PER_ENTRY, 0.02), (150, 1e-4)):
        monkeypatch.setattr(lm_score, "BITS_PER_ENTRY", bits)
        got = sorted((r["doc_id"] or 0, r["n_tokens"], r["score"]) for r in lm_score.score(docs, lm_score.learn(train, **options)).collect())
        off = sum(abs(a[2] - b[2]) for a, b in zip(want, got, strict=True)) / sum(a[1] for a in want)
        assert off <= most and [x[:2] for x in want] == [x[:2] for x in got]


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    from millrace.llm import hashing

    texts = ["a bb ccc " * 20, "", "x" * 300 + " y", "é ü ß straße " * 9, "..."]
    raw = np.frombuffer(" ".join(texts).encode() + b" ", np.uint8)
    want = hashing.byte_words(raw, raw != 32), hashing.words_of(texts, lang_id.LETTER, 24), hashing.words_of(texts, toxicity.LETTER_OR_DIGIT)
    for block in (1, 7, 100):
        monkeypatch.setattr(hashing, "BLOCK", block)
        got = hashing.byte_words(raw, raw != 32), hashing.words_of(texts, lang_id.LETTER, 24), hashing.words_of(texts, toxicity.LETTER_OR_DIGIT)
        assert (got[0][1] == want[0][1]).all() and all((g.hash == w.hash).all() and (g.per_text == w.per_text).all() for g, w in zip(got[1:], want[1:], strict=True))
    assert len(hashing.byte_words(raw[:0], raw[:0] != 32)[0]) == 0 and len(hashing.words_of([], lang_id.LETTER).hash) == 0


def test_word_hashes():
    texts = ["Aa bb\x0bbb\n", "", " \t ", "x" * 200 + " " + "x" * 201, "é\xa0É\u2003z Aa", "a b", "b a"]
    h, n = lm_score.Words()(texts)
    want = [[*re.findall(rb"[^\x20\x09-\x0D]+", t.encode().translate(lm_score._LOWER)), None] for t in texts]
    flat = [w for ws in want for w in ws]
    assert n.tolist() == [len(w) for w in want]
    assert len(set(zip(h.tolist(), flat, strict=True))) == len(set(h.tolist())) == len(set(flat))
    assert lm_score.Words()([])[1].tolist() == []


def test_every_ngram_counts_however_small_the_broadcast(spark, odd_docs, empty_docs):
    docs = odd_docs.select("doc_id", "text").unionByName(documents(spark, DIR).selectExpr("doc_id + 1000 AS doc_id", "text"))
    train = docs.where(~lm_score.held_out())
    want, got = (Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in lm_score.score(docs, lm_score.learn(train, bucket_bytes=50_000, **options)).collect()) for options in ({}, {"filter_bytes": 1000}))
    assert got == want
    assert lm_score.score(empty_docs, lm_score.learn(train, filter_bytes=0)).count() == 0


def test_filter_never_lowers_a_level():
    g = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    lev = 1 + (np.arange(5000) % 9)
    f = lm_score.Filter(1, 40_000)
    f.fill(g, lev)
    got = f.levels(g)
    assert (got >= lev).all() and (got > lev).mean() < 0.1
    other = np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64)
    assert (f.levels(other) > 0).mean() < 0.05


@pytest.fixture(scope="module")
def labelled(spark):
    d = f"{DATA}/sf0.01"
    docs, labels = documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    return docs, labels


def test_quality(spark, labelled, odd_docs, empty_docs):
    docs, labels = labelled
    net = quality.learn(docs, labels)
    got = quality.score_quality(docs, net).join(labels, "doc_id").withColumn("out", quality.held_out()).where("out").collect()
    assert np.mean([(r["score"] >= 0.3) == r["quality"] for r in got]) > 0.9
    odd = quality.score_quality(odd_docs, net).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd) and quality.score_quality(empty_docs, net).count() == 0
    for none in (quality.train([], []), quality.train(["a"], [1])):
        assert quality.score_quality(odd_docs, none).count() == odd_docs.count()


def test_quality_scores_by_loops(spark):
    """The network by its definition, one filter and place at a time, and the gradient-trained head on top."""
    net = quality.train(["good text here, yes " * 3, "bad!!! $$$ ### " * 4, "good again, fine", "bad *** %%%"], [1, 0, 1, 0], epochs=2)
    w = net.weights

    def brute(text):
        raw = text.encode()
        per = []
        for k in range(max(1, -(-(len(raw) - quality.CHUNK) // quality.STEP) + 1) if len(raw) > quality.CHUNK else 1):
            x = raw[k * quality.STEP : k * quality.STEP + quality.CHUNK].ljust(quality.CHUNK, b"\0")
            emb = [w["embed"][c].astype(float) for c in x]
            tops = []
            for f in range(quality.FILTERS):
                z = [sum(float(emb[p + i] @ w["filters"][i * quality.DIM : (i + 1) * quality.DIM, f]) for i in range(quality.WIDTH)) for p in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)]
                tops.append(max(0.0, max(z) + float(w["bias"][f])))
            per.append(tops)
        per = np.array(per)
        v = (np.concatenate([per.max(0), per.mean(0), per.min(0)]) - w["mean"]) / w["scale"]
        return 1 / (1 + math.exp(-float(np.tanh(v @ w["w1"] + w["b1"]) @ w["w2"] + w["b2"][0])))

    texts = ["", "short", "good text, é " * 30, "bad ### " * 60]
    got = quality.score_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), net).orderBy("doc_id").collect()
    assert [r["score"] for r in got] == pytest.approx([brute(t) for t in texts], abs=1e-4)


def test_toxicity_scores_by_loops(spark, odd_docs):
    model = toxicity.train(["a mild text of words", "you stupid clown", "another text", "clown trash here", "words of a mild kind"] * 5, [0, 1, 0, 1, 0] * 5)

    def brute(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        last = max(0, len(words) - toxicity.WINDOW)
        starts = [*range(0, last, toxicity.STEP), -(-last // toxicity.STEP) * toxicity.STEP]
        return 1 / (1 + math.exp(-max(sum(model.word(x) for x in words[a : a + toxicity.WINDOW]) for a in starts) - model.bias))

    rows = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(50, "x " * 30 + "You STUPID clown_trash! " + "y " * 40), (51, "clown")], "doc_id long, text string"))
    for limit in (300_000, 5):
        got = sorted((r["doc_id"] or 0, round(r["score"], 9)) for r in toxicity.score_toxicity(rows, model, max_words=limit).collect())
        assert got == sorted((r["doc_id"] or 0, round(brute(r["text"]), 9)) for r in rows.collect())


def test_chunks_cover_the_text():
    for n in (0, 1, 255, 256, 257, 480, 481, 5000):
        c = quality.chunks("x" * n)
        assert (c != 0).any(axis=1).sum() == len(c) or n == 0
        assert (len(c) - 1) * quality.STEP + quality.CHUNK >= n


def test_toxicity(spark, labelled, odd_docs, empty_docs):
    docs, labels = labelled
    model = toxicity.learn(docs, labels)
    got = toxicity.score_toxicity(docs, model).join(labels, "doc_id").withColumn("out", toxicity.held_out()).where("out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.93
    odd = toxicity.score_toxicity(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and toxicity.score_toxicity(empty_docs, model).count() == 0
    for none in (toxicity.train([], []), toxicity.train(["a"], [0])):
        assert toxicity.score_toxicity(odd_docs, none).count() == odd_docs.count()


def test_swaps_reduce_the_harm_of_a_group_name():
    """A group that stands in most toxic texts of the sample: with the penalty its mention alone counts for less."""
    r = np.random.default_rng(0)
    common = [f"word{k}" for k in range(200)]

    def text(*more):
        w = [common[i] for i in r.integers(0, 200, 20)]
        return " ".join([*w[:10], *more, *w[10:]])

    texts = [text("refugee", "scum") if k % 3 else text("scum") for k in range(60)] + [text("person") for _ in range(240)]
    y = [1] * 60 + [0] * 240
    with_, without = toxicity.train(texts, y, swap=0.5), toxicity.train(texts, y, swap=0.0)
    assert with_.word("refugee") < 0.5 * without.word("refugee") or without.word("refugee") == 0
    assert with_.word("scum") + with_.bias > 0


@pytest.mark.parametrize("insult, groups, neutral", [
    ("scum", ("refugees", "muslims"), "people"), ("abschaum", ("flüchtlinge", "muslime"), "leute"), ("ordure", ("réfugiés", "musulmans"), "gens"), ("escoria", ("refugiados", "musulmanes"), "gente"),
])
def test_neutral_mentions_are_left_alone(spark, insult, groups, neutral):
    """Labelled texts in which two groups stand mostly beside insults: of held-out texts that only mention them, or another group of the
    same language, fewer are called toxic with the penalty of the query than without, and insults are found as before."""
    r = np.random.default_rng(0)

    def text(*more):
        w = [f"word{i}" for i in r.integers(0, 200, 40)]
        return " ".join([*w[:20], *more, *w[20:]])

    # every third toxic text has an insult of its own, so that only the group tells
    rows = [(k, text(groups[k % 2], insult if k % 3 else f"q{k}x"), 1) for k in range(200)] + [(k, text(groups[k % 2] if k % 25 == 0 else neutral), 0) for k in range(200, 800)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    kind = next(k.split() for k in toxicity.TERMS if groups[0] in k.split())
    mentions = [(k, text(kind[k % len(kind)])) for k in range(300)] + [(k, text(groups[k % 2])) for k in range(300, 500)]
    insults = [(1000 + k, text(kind[k % len(kind)], insult)) for k in range(100)]
    held = spark.createDataFrame(mentions + insults, "doc_id long, text string")
    wrong, found = {}, {}
    for swap in (toxicity.SWAP, 0.0):
        got = toxicity.score_toxicity(held, toxicity.learn(docs, labels, swap=swap)).collect()
        wrong[swap] = np.mean([x["predicted"] for x in got if x["doc_id"] < 1000])
        found[swap] = np.mean([x["predicted"] for x in got if x["doc_id"] >= 1000])
    assert wrong[toxicity.SWAP] <= 0.05 and wrong[0.0] >= 0.3 and found[toxicity.SWAP] >= 0.98


def test_swaps_replace_one_term_within_its_windows():
    words = [f"w{k}" for k in range(60)]
    words[30] = "refugees"
    kept, swapped = toxicity.swaps([words, ["no", "term"]], copies=3)
    assert len(kept) == len(swapped) == 3 and all(k == words[7:54] for k in kept)
    for s in swapped:
        assert s[:23] == words[7:30] and s[24:] == words[31:54] and s[23] != "refugees" and s[23] in toxicity.TERMS[1].split()
    assert len({s[23] for s in swapped}) == 3


def test_sample_takes_repeats_and_conflicts_as_stated(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (3, "x" * 500), (None, "n"), (6, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (None, 1), (6, None)], "doc_id long, toxic int")
    got = sorted(map(tuple, sample(docs, labels, "toxic").to_numpy().tolist()))
    assert len(got) <= 3 and all(t != "n" and t != "y" for t, _ in got)
    held = {i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {("", 0)} - {t for t in got} == ({("", 0)} if 2 in held else set())
    assert 3 in held or ("x" * 500, 1) in got
    assert all(len(t) < 500 for t, _ in sample(docs, labels, "toxic", max_bytes=100).to_numpy().tolist())
    assert sample(docs.limit(0), labels, "toxic").empty


def test_window_covers():
    for n in (0, 1, 24, 25, 36, 37, 1000):
        a, b = toxicity.window_ends(n)
        assert set().union(*(range(i, j) for i, j in zip(a, b, strict=True))) == set(range(n))


def test_sample_is_bounded_and_outside_the_fold(spark, labelled):
    docs, labels = labelled
    got = sample(docs, labels, "toxic", rows=50)
    assert 0 < len(got) <= 50
    ids = defaultdict(list)
    for r in docs.collect():
        ids[r["text"]].append(r["doc_id"])
    assert all(any(zlib.crc32(str(i).encode()) % 5 for i in ids[t]) for t in got["text"])
