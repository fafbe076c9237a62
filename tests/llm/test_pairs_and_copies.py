"""Exact dedup, the n-gram join, decontamination and the pipeline against brute force."""

from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import pytest

from pyspark.sql import functions as F

from millrace.llm import decontaminate, exact_dedup, ngram_join, packing
from millrace.llm.common import documents, join_skewed

DATA = "/root/testdata"
DIR = f"{DATA}/sf0.001"


def test_bands_reach_the_recall():
    b, r = ngram_join.choose_bands(0.8, 0.999, 96)
    assert b * r <= 96 and 1 - (1 - 0.8**r) ** b >= 0.999
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999999, 4)


def test_exact_odd(odd_docs, empty_docs):
    got = exact_dedup.exact_dedup(odd_docs).collect()
    assert len(got) == odd_docs.count() and sum(r["kept"] for r in got) == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    sizes = {r["doc_id"]: r["group_size"] for r in got}
    assert sizes[1] == 4 and sizes[4] == 3 and sizes[6] == 1
    assert {r["keep_id"] for r in got if r["doc_id"] in (1, 2)} == {2}
    kept = exact_dedup.drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if r["kept"])
    assert exact_dedup.exact_dedup(empty_docs).count() == 0 and exact_dedup.drop_exact_copies(empty_docs).count() == 0


def test_a_full_filter_changes_nothing(spark):
    docs = documents(spark, DIR)
    full = exact_dedup.exact_dedup(docs, filter_bits=64)
    assert full.exceptAll(exact_dedup.exact_dedup(docs)).isEmpty()


def test_join_skewed_keeps_all(spark):
    left = spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert join_skewed(left, right, "k", "n").count() == 5000


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op7_benchmark_decontamination"])
def test_sql(spark, name):
    from millrace.llm import queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = queries.queries()[name](spark, DIR)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert Counter(map(tuple, df.collect())) == Counter(want)


def brute(texts, threshold=0.8):
    """Links and classes of every pair, by the sets alone."""

    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [grams(t) for t in texts]
    up = list(range(len(texts)))

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    n = [0] * len(texts)
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) >= threshold * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                    n[i] += 1
                    n[j] += 1
                    up[find(i)] = find(j)
    return n, [find(i) for i in range(len(texts))]


def check_near(docs, **options):
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    n, root = brute([r["text"] for r in rows])
    least = defaultdict(lambda: 1 << 60)
    for r, c in zip(rows, root, strict=True):
        least[c] = min(least[c], r["doc_id"])
    want = {r["doc_id"]: (least[c], k) for r, c, k in zip(rows, root, n, strict=True)}
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(docs, **options).collect()}
    assert got == want


def test_near_against_all_pairs(spark):
    check_near(documents(spark, DIR))


def test_near_in_many_blocks(spark, monkeypatch):
    """A large group of near copies over many small blocks loses no link."""
    import random

    r = random.Random(5)
    base = [f"w{r.randrange(900)}" for _ in range(120)]
    rows = []
    for k in range(90):
        w = list(base)
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = f"x{r.randrange(900)}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 8)
    check_near(spark.createDataFrame(rows, "doc_id long, text string"))


def test_components_of_links_that_differ_when_computed_again(spark):
    """Stars whose centre is another one each time they are computed, as when rows come in another order, stay whole."""
    from millrace.llm.components import connected_components

    def stars(frames):
        import random

        import pandas as pd

        r = random.SystemRandom()
        for f in frames:
            rows = []
            for s in f["id"]:
                centre = r.randrange(40)
                rows += [(1000 * s + centre, 1000 * s + k) for k in range(40) if k != centre]
            yield pd.DataFrame(rows, columns=["a", "b"])

    got = connected_components(spark.range(30).mapInPandas(stars, "a long, b long")).collect()
    assert len(got) == 1200 and all(r["label"] == r["node"] // 1000 * 1000 for r in got)


def test_near_odd(odd_docs, empty_docs):
    got = ngram_join.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["class_id"] == by[2]["class_id"] == by[5]["class_id"] == 1 and by[6]["class_id"] == by[7]["class_id"] == 6
    assert by[3]["class_id"] == 3 and by[4]["class_id"] == 4 and by[8]["n_links"] == 0 and by[10]["class_id"] == 9 and by[10]["n_links"] == 1
    kept = ngram_join.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} - {None} == {1, 3, 4, 6, 8, 9, 11}
    assert ngram_join.near_duplicates(empty_docs).count() == 0


def test_contained_odd(spark, odd_docs, empty_docs):
    items = spark.createDataFrame([(1, odd_docs.where("doc_id = 1").first()["text"].upper() + "!"), (2, "one two"), (3, None), (None, ""), (4, "a b c d e f g h")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(odd_docs, items).collect()}
    assert got == {(1, 1), (2, 1), (None, 1), (5, 1)}
    kept = decontaminate.drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and {r["doc_id"] for r in kept.collect()} == {3, 4, 6, 7, 8, 9, 10, 11, None} - {None}
    assert decontaminate.contaminated(empty_docs, items).count() == 0 and decontaminate.contaminated(odd_docs, items.limit(0)).count() == 0


def test_items_with_null_and_repeated_ids(spark):
    texts = [" ".join(f"{c}{k}" for k in range(20)) for c in "abcd"]
    items = spark.createDataFrame([(None, texts[0]), (None, texts[0]), (7, texts[1]), (7, texts[2] + " tail"), (8, texts[1])], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = Counter((r["doc_id"], r["item_id"], r["n_shared"], r["n_item"]) for r in decontaminate.contaminated(docs, items).collect())
    assert got == Counter([(0, None, 16, 16), (1, 7, 16, 16), (1, 8, 16, 16), (2, 7, 16, 17)])
    assert [r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()] == [3]


def test_sketch_never_misses(spark):
    """A text that holds just the threshold of an item's shingles, the rest of them torn apart, is found."""
    words = [f"w{k}" for k in range(104)]  # 100 shingles
    torn = words[:84] + ["zz"] + words[84:]
    docs = spark.createDataFrame([(1, " ".join(torn)), (2, " ".join(words[:70]))], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["n_item"], r["n_shared"]) for r in got] == [(1, 100, 96)]


def test_containment_at_the_threshold(spark):
    """A text with 80 of 100 shingles is found, one with 79 is not, whatever stands around them."""
    words = [f"w{k}" for k in range(104)]
    docs = spark.createDataFrame([(n, " ".join(["zz"] * 50 + words[: n + 4] + ["zz"] * 50)) for n in (79, 80)] + [(100, " ".join(words[:44] + ["zz"] + words[44:88]))], "doc_id long, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shared"]) for r in got) == [(80, 80), (100, 80)]


def test_short_items_on_request(spark):
    docs = spark.createDataFrame([(1, "One two, three four."), (2, "two one"), (3, "three"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one TWO"), (2, "three"), (3, "two three four"), (4, ""), (5, "five")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_item"]) for r in decontaminate.contaminated(docs, items, short_items=True).collect()}
    assert got == {(1, 1, 1), (1, 2, 1), (1, 3, 1), (3, 2, 1)}
    assert decontaminate.contaminated(docs, items).count() == 0


def test_contained_beyond_the_broadcast_bounds(spark, monkeypatch):
    from millrace.llm import common

    docs, items = documents(spark, DIR), spark.read.parquet(f"{DIR}/benchmark.parquet")
    # one item in a third of the documents, and a passage of it in all of them
    text = items.first()["text"]
    docs = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat_ws(" ", "text", F.lit(text))).otherwise(F.concat_ws(" ", "text", F.lit(" ".join(text.split()[:9])))).alias("text"))
    want = Counter(map(tuple, decontaminate.contaminated(docs, items).collect()))
    assert len(want) > docs.count() // 3
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "GRAM_BYTES", 0)
    assert Counter(map(tuple, decontaminate.contaminated(docs, items).collect())) == want


def test_words_of_the_filter(spark):
    """Cells hit once, twice, three times and four times, alone and with others in their word."""
    hits = [5] + [70] * 2 + [64] + [200] * 3 + [201] + [300] * 4 + [301] * 2 + [302] + [400] * 2 + [401] * 2
    got = {r["word"]: r["mask"] for r in exact_dedup.repeated_words(spark.createDataFrame([(h,) for h in hits], "cell long")).collect()}
    assert got == {1: 1 << 6, 3: (1 << 8) | (1 << 9), 4: (1 << 44) | (1 << 45) | (1 << 46), 6: (1 << 16) | (1 << 17)}
    sizes = [exact_dedup.filter_size(n) for n in (0, 10, 8192, 8193, 10**6, 10**12)]
    assert sizes == [1 << 16, 1 << 16, 1 << 18, 1 << 19, 1 << 25, exact_dedup.MAX_FILTER_BITS]


def test_a_row_that_stands_often(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_REPEATS", 7)
    rows = spark.createDataFrame([(1, "a")] * 50 + [(2, "a")] + [(3, "b")] * 7, "doc_id long, text string")
    got = exact_dedup.exact_dedup(rows).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == Counter({(1, 2, 51, False): 50, (2, 2, 51, True): 1, (3, 3, 7, False): 6, (3, 3, 7, True): 1})


def test_pipeline_by_brute_force(spark):
    """What stays after every stage, each held against all pairs of its own input."""
    docs = documents(spark, DIR)
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, DIR)
        rows, out = docs.collect(), got.collect()
        if name != "best_fit_packing":
            assert got.columns == docs.columns
        if name == "exact_dedup":
            best = {}
            for r in rows:
                best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
            assert {r["doc_id"] for r in out} == set(best.values())
        if name == "ngram_jaccard_join":
            _, root = brute([r["text"] for r in rows])
            least = defaultdict(lambda: 1 << 60)
            for r, c in zip(rows, root, strict=True):
                least[c] = min(least[c], r["doc_id"])
            assert {r["doc_id"] for r in out} == set(least.values())
        found[name] = len(out)
        docs = spark.createDataFrame(out, got.schema)
    assert found["language_id"] >= 0.99 * documents(spark, DIR).count()
    use = defaultdict(int)
    for r in out:
        use[r["sequence_id"]] += r["length"]
    assert max(use.values()) <= packing.CAPACITY


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_ids_beyond_the_broadcast_bound(spark, odd_docs, monkeypatch, bits):
    from millrace.llm import common, id_join
    from millrace.llm.common import materialize

    ids = materialize(spark.createDataFrame([(1,), (2,), (None,), (99,)], "k long"))
    want = {how: Counter(r["doc_id"] for r in id_join.join_ids(odd_docs, ids, "doc_id", "k", how).collect()) for how in ("inner", "left_semi", "left_anti")}
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    for how, w in want.items():
        got = id_join.join_ids(odd_docs, ids, "doc_id", "k", how, bits)
        assert Counter(r["doc_id"] for r in got.collect()) == w and (how == "inner" or got.columns == odd_docs.columns)


def test_near_beyond_the_broadcast_bound(spark, monkeypatch):
    from millrace.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    check_near(documents(spark, DIR))
