"""Gram index, similarity join and keyword automaton against brute force."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import grams, keywords, resolve, similar


def like(pattern, text):
    out, k = "", 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\" and k + 1 < len(pattern):
            k += 1
            out += re.escape(pattern[k])
        else:
            out += ".*" if c == "%" else "." if c == "_" else re.escape(c)
        k += 1
    return re.fullmatch(f".*{out}.*", text, re.S) is not None


def test_grams_by_brute_force(spark):
    r = random.Random(2)
    letters = "abcđ é"
    names = ["".join(r.choice(letters) for _ in range(r.randrange(0, 9))) for _ in range(150)] + [None, "", "a\u0001b", "50% off", "a_b"]
    dim = [(n, str(7000000 + k) if k % 9 else None) for k, n in enumerate(names)]
    kws = sorted({"".join(r.choice(letters + "%_") for _ in range(r.randrange(0, 6))) for _ in range(80)} | {"", "%", "_", "__%_", "%%", "ABC", " ab ", "7000012", "x\\%", "50\\% o", "a\\_b", "zzzz"})
    got = grams.ilike_top(spark.createDataFrame([(k,) for k in [*kws, None]], "kw string"), "kw", spark.createDataFrame(dim, "name string, code string"), "name", "code", 3, block=20)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()
    found = {}
    for x in got.collect():
        found.setdefault(x["kw"], []).append((x["rank"], len(x["name"]) if x["name"] is not None else None))
    for k in kws:
        low = k.strip(" ").lower()
        hits = [(n, c) for n, c in dim if (n is not None and like(low, n.lower())) or (c is not None and like(low, c))]
        best = sorted(hits, key=lambda x: (x[0] is not None, len(x[0] or ""), x[1] is not None, x[1] or ""))[:3]
        assert sorted(found.get(k, [])) == [(i + 1, len(n) if n is not None else None) for i, (n, _) in enumerate(best)], k


def test_similarity_join_equals_the_scan(spark, monkeypatch):
    r = random.Random(3)
    parts = "công nghệ thông tin kỹ thuật điện tử quản trị kinh doanh luật quốc tế y khoa sinh học môi trường".split()
    entries = [" ".join(r.choice(parts) for _ in range(r.randrange(1, 6))) for _ in range(300)] + ["", "a", "ab", "x" * 250]

    def worn(t):
        t = list(t)
        for _ in range(r.randrange(0, 4)):
            if t:
                t[r.randrange(len(t))] = r.choice("abc ")
        return "".join(t)

    names = spark.createDataFrame([(e, f"v{k}", k) for k, e in enumerate(entries)], "key string, value string, ord int")
    keys = sorted({worn(r.choice(entries)) for _ in range(150)} | {"", "zzz", "ab", "x" * 249})
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    want = {}
    for k in keys:
        best = (0.0, None)
        for i, e in enumerate(entries):
            x = SequenceMatcher(None, k, e).ratio()
            if k and e and x >= 0.82 and x > best[0]:
                best = x, f"v{i}"
        want[k] = best[1], best[0] if best[1] else None
    for size in (7, 1000):
        assert {x["k"]: (x["match"], x["ratio"]) for x in similar.best_match(df, "k", names, 0.82, size).collect()} == want
    assert {x["k"]: (x["match"], x["ratio"]) for x in resolve.fuzzy(df, "k", names).collect()} == want
    monkeypatch.setattr(resolve, "MAX_ENTRIES", 10)
    assert {x["k"]: (x["match"], x["ratio"]) for x in resolve.fuzzy(df, "k", names).collect()} == want
    assert similar.best_match(df, "k", names.limit(0)).where("match is not null").count() == 0
    with pytest.raises(ValueError):
        similar.best_match(df, "k", names, 0)


def test_prefix_filter_never_loses_a_pair():
    r = random.Random(4)
    for _ in range(3000):
        a = "".join(r.choice("abcde") for _ in range(r.randrange(1, 12)))
        b = "".join(c for c in a if r.random() < 0.85) + "".join(r.choice("abcdex") for _ in range(r.randrange(0, 3)))
        order = {c: k for k, c in enumerate("edcba")}
        if b and SequenceMatcher(None, a, b).ratio() >= 0.7:
            assert set(similar.prefix(a, order, 0.7)) & set(similar.prefix(b, order, 0.7))
            assert abs(similar.band(len(a), 0.7) - similar.band(len(b), 0.7)) <= 1


@pytest.mark.parametrize("limit", [keywords.MAX_BYTES, 20])
def test_keywords_by_brute_force(spark, limit):
    r = random.Random(5)
    words = sorted({"".join(r.choice("abcđ ") for _ in range(r.randrange(1, 4))) for _ in range(40)})
    texts = ["".join(r.choice("abcđ .") for _ in range(r.randrange(0, 30))) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, t string")
    got = {x["id"]: (x["p"], x["n"]) for x in df.select("id", keywords.present(spark, F.col("t"), words, limit).alias("p"), keywords.least(spark, F.col("t"), {w: k for k, w in enumerate(words)}, limit).alias("n")).collect()}
    for k, t in enumerate(texts):
        hits = [i for i, w in enumerate(words) if t is not None and w in t]
        assert got[k] == (None if t is None else hits, min(hits, default=None))


def test_profiles_by_thousands_of_keywords(spark):
    profiles = spark.createDataFrame([(k, [f"t{k}"], [f"word{k}x", f"term{k}y", None], [str(k)]) for k in range(3000)] + [(5000, ["rest"], [""], [])], "ord int, types array<string>, keywords array<string>, codes array<string>")
    df = spark.createDataFrame([(1, "has term2999y and word17x", None), (2, "nothing", None), (3, None, None), (4, "word3x", "8")], "id int, t string, code string")
    got = {r["id"]: r["types"] for r in resolve.tags(df, "code", F.col("t"), profiles).collect()}
    assert got == {1: ["t17"], 2: ["rest"], 3: [], 4: ["t8"]}


def test_long_runs_take_linear_time(spark):
    import time

    n = 1_000_000
    rows = [("a" + " " * n + "b",), ("a" + "(" * n + "b",), (" " * n + "25 điểm" + " " * n,), ("x" + "\n" * n + "y )" + ")" * 1000,), ("12 " + "\t" * n + " z",)]
    df = spark.createDataFrame(rows, "t string").cache()
    df.count()
    for f in (T.strip, T.squeeze, lambda x: T.field(x, 100), T.raw_name, T.major_name, T.keyword, T.score, lambda x: T.opt_text(x, 50), T.name_key, T.combo):
        began = time.time()
        df.select(F.length(f("t").cast("string"))).collect()
        assert time.time() - began < 20


def test_brackets_and_white_space(spark):
    cases = ["a (b) c (d)", "a (b (c) d)", "(x)", "a (b", "a) b (c)", "", "a [b) (c", "x (y) ", "((a)) b"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = df.select("t", T.without_brackets(F.col("t")).alias("all"), T.without_brackets(F.col("t"), last=True).alias("last")).collect()
    group = r"[(\[（【][^)\]）】]*[)\]）】]"
    for r in got:
        assert (r["all"], r["last"]) == (re.sub(group, "", r["t"]), re.sub(group + "$", "", r["t"])), r["t"]
    assert spark.range(1).select(T.strip(F.lit("　   a b\u0085\t")).alias("x")).first()["x"] == "a b"
    assert spark.range(1).select(T.strip_accents_compat(F.lit("ﬁ Ｋỹ ① đ"), True).alias("x")).first()["x"] == "fi Ky 1 d"
