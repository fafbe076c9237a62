"""Cases that once failed: long white space, rows without or with one id, numerals, long labelled texts, names that mislead."""

import random
import resource

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import html_extract, lang_id, ngram_join, packing, quality


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    return lambda text: np.asarray(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("c", [" ", "\n", "\t", "\r", "\x0b", " "])
def test_two_million_white_spaces_are_encoded_as_the_library_does(c, library):
    import public_tokenizers

    encode = packing.encoder(public_tokenizers.path(packing.TOKENIZER))
    for text in (c * 2_000_000, "a" + c * 2_000_000 + "b"):
        assert encode(text) == library(text)


def test_long_white_space_is_packed(spark, library):
    texts = {1: "a" + "\n" * 2_000_000 + "b", 2: " " * 2_000_000, 3: "\t" * 1_100_000 + "word", 4: "plain text"}
    got = packing.pack_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {k: len(library(t)) // 4 + 1 for k, t in texts.items()}


def _near_texts(n):
    r = random.Random(1)
    out = []
    for _ in range(n // 2):
        words = [r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(r.randrange(300)) for _ in range(60)]
        out += [" ".join(words), " ".join([*words[:-1], "end"])]
    return out


def test_rows_without_or_with_one_id_join_one_text_each(spark, monkeypatch):
    texts = _near_texts(1000)
    joined = []
    whole = ngram_join.join_ids

    def counted(*a, **k):
        out = whole(*a, **k)
        joined.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "join_ids", counted)
    sizes = []
    for make in (lambda k: k, lambda k: None, lambda k: 7):
        got = ngram_join.near_duplicates(spark.createDataFrame([(make(k), t) for k, t in enumerate(texts)], "doc_id long, text string"))
        sizes.append(sorted((r["n_links"], r["class_size"]) for r in got.collect()))
    assert sizes[0] == sizes[1] == sizes[2] == [(1, 2)] * 1000
    assert joined == [1000, 1000, 1000]


def test_a_row_and_its_copies_under_one_id(spark):
    a, b = _near_texts(2)
    got = ngram_join.near_duplicates(spark.createDataFrame([(None, a), (None, a), (None, b), (1, a), (1, b), (2, "other words that are here once")], "doc_id long, text string")).collect()
    assert sorted((r["class_id"], r["n_links"], r["class_size"]) for r in got) == [(1, 4, 5)] * 5 + [(2, 0, 1)]


def test_numerals_and_marks_are_no_letters(spark):
    train = spark.createDataFrame([(1, "the words of a text", "en"), (2, "die Wörter des Textes", "de")], "doc_id long, text string, lang string")
    model = lang_id.learn(train)
    texts = ["½ ²", "①②", "Ⅷ", "١٢", "́", "12 !", "", None, "é", "中"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang_id.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert all(got[k] == ("und", 0) for k in range(8)) and got[8][0] != "und" and got[9][0] != "und"
    with pytest.raises(ValueError):
        lang_id.learn(train, max_languages=1)


def test_long_labelled_texts_train_in_bounded_memory():
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    quality.train(["good words here, " * 1_900_000, "bad"], [1, 0], epochs=1)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1e6 < 1.0  # GB, the text of 32 MB and its chunks included


def test_groups_of_chunks_do_not_change_the_weights(monkeypatch):
    r = random.Random(1)
    texts = [" ".join(r.choice(["good fine nice", "bad spam buy"][k % 2].split()) for _ in range(r.randrange(5, 300))) for k in range(40)]
    one = quality.train(texts, [k % 2 for k in range(40)], epochs=2).weights
    monkeypatch.setattr(quality, "GROUP", 3)
    other = quality.train(texts, [k % 2 for k in range(40)], epochs=2).weights
    assert all(np.allclose(one[k], other[k], atol=1e-3) for k in one)


PAGE = "<html><body><nav><a href=x>menu</a></nav><article><h1>Title</h1><p>" + "A long text, with commas, goes here. " * 15 + "</p>%s<p>The end of it, at last.</p></article></body></html>"


@pytest.mark.parametrize("part, kept", [
    ('<section class="search"><h2>Search</h2><p>Search algorithms are many.</p></section>', "Search\nSearch algorithms are many."),
    ('<div class="banner-image"><p>Caption of it.</p></div>', "Caption of it."), ('<div class="alert"><p>Step 3: switch off the power.</p></div>', "Step 3: switch off the power."),
    ('<div class="search"><form><input><button>Go</button></form><p>find it</p></div>', None), ('<div class="banner">Buy now</div>', None), ('<div class="advert"><p>Buy this now.</p></div>', None),
    ('<div class="alert"><p><a href=y>Sign in to go on reading this</a></p></div>', None),
])
def test_ambiguous_names_need_a_sign(part, kept):
    first, last = "Title\n" + ("A long text, with commas, goes here. " * 15).strip(), "The end of it, at last."
    assert html_extract.extract(PAGE % part) == "\n".join(x for x in (first, kept, last) if x)


@pytest.mark.parametrize("name", ["discussion", "talk", "user-posts", "xyz"])
@pytest.mark.parametrize("sign", ["<span class=username>bob</span>", "<time>2024-01-02</time>", "<div class=post-author>bob</div>"])
def test_signed_parts_after_the_text_are_comments(name, sign):
    body = ("An article, that goes on and on, here. " * 12).strip()
    said = "".join(f"<div class='m'>{sign}<p>I think, that this, is all wrong, number {k}. </p></div>" for k in range(9))
    assert html_extract.extract(f"<html><body><div class=post><p>{body}</p></div><div class={name}>{said}</div></body></html>") == body


def test_signed_parts_that_are_the_text_stay():
    parts = "".join(f"<div class=entry><time>2024-01-0{k}</time><p>On this day, much happened, in many places, number {k}.</p></div>" for k in range(1, 6))
    got = html_extract.extract(f"<html><body><div class=content><h1>Live</h1>{parts}</div></body></html>")
    assert all(f"number {k}." in got for k in range(1, 6))


def test_nested_names_take_linear_time():
    import time

    began = time.time()
    html_extract.extract("<article>" + "<div class=search>" * 100_000 + "<p>text that is here, for once.</p>")
    html_extract.extract("<article>" + "<div class=m><time>x</time><div class=m>" * 50_000 + "text that is here, for once.")
    assert time.time() - began < 20
