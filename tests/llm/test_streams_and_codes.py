"""Missing follow-ups, vector codes and BPE against brute force, SQL and the library."""

import hashlib
import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, follow_up, vector_codes
from millrace.llm.common import shared_dir

DIR = "/root/testdata/sf0.001"
HOUR = follow_up.HOUR


def from_sql(sql):
    con = duckdb.connect()
    for t in ("clicks", "sales", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return sorted(con.execute(sql).fetchall(), key=str)


# Missing follow-ups


def alerts_by_loops(events, batches, slack=48 * HOUR, wait=24 * HOUR):
    clock, seen = [], None
    for b in range(batches):
        clock.append(None if seen is None else seen - slack)
        seen = max([t for k, _, t, _ in events if k == b] + ([seen] if seen is not None else []), default=None)
    late, kept = {}, {}
    for b, c, t, sale in events:
        if clock[b] is not None and t < clock[b]:
            late[b, c] = late.get((b, c), 0) + 1
        else:
            kept.setdefault(c, []).append((t, sale))
    out = [(b, c, -1, -1, n) for (b, c), n in late.items()]

    def ended(c, o):
        due = o[1] + wait
        out.append((next((b for b in range(batches) if clock[b] is not None and clock[b] > due), batches), c, o[0], due, o[2]))

    for c, own in kept.items():
        o = None
        for t, sale in sorted(own):
            if o and t > o[1] + wait:
                ended(c, o)
                o = None
            if sale:
                o = None
            else:
                o = (o[0], t, o[2] + 1) if o else (t, t, 1)
        if o:
            ended(c, o)
    return sorted(out)


def test_follow_ups_query_equals_its_sql(spark):
    got = follow_up.op11_missing_follow_up_alerts(spark, DIR)
    assert got.columns == ["batch", "client_id", "opened_us", "due_us", "n_rows"]
    assert sorted(map(tuple, got.collect()), key=str) == from_sql(follow_up.SQL["op11_missing_follow_up_alerts"])


def test_follow_ups_by_loops(spark):
    """A hot client, ties, times on the edge of a slot, of W and of due_us, batches without events, repeated rows."""
    r = random.Random(5)
    start = 1_700_000_000_000_000 // HOUR * HOUR
    events = []
    for b in (0, 1, 2, 4):
        for _ in range(150):
            c = 7 if r.random() < 0.4 else r.randrange(12)
            t = start + b * 60 * HOUR + r.randrange(-40, 60) * HOUR + r.choice([0, 0, 1, HOUR - 1, r.randrange(HOUR)])
            events.append((b, c, t, r.random() < 0.3))
    events += [events[3], events[3]]
    top = max(t for b, _, t, _ in events if b == 0)
    events += [(1, 3, top - 48 * HOUR, False), (1, 3, top - 48 * HOUR - 1, False), (0, 20, start, False), (2, 20, start + 24 * HOUR, True), (1, 21, top, False), (1, 21, top, True), (1, -5, top, False)]
    df = spark.createDataFrame(events, "batch int, client_id long, t_us long, sale boolean")
    got = follow_up.missing_follow_ups(df, batches=5, bucket_rows=50)
    assert sorted(map(tuple, got.collect())) == alerts_by_loops(events, 5)


def test_follow_ups_of_nothing_and_of_odd_rows(spark):
    none = spark.createDataFrame([], "batch int, client_id long, t_us long, sale boolean")
    assert follow_up.missing_follow_ups(none, batches=2).count() == 0
    clicks = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string, batch string, sale string"
    sales = "sale_id long, client_id long, sold_at timestamp, arrived_at timestamp, bucket int"
    rows = [(1, "2024-01-01 10:00:00.000001", "2024-01-01 11:00:00", 4, "view")] * 2 + [(1, "2024-01-01 10:00:00.000001", "2024-01-01 11:00:00", 4, "click"), (2, None, None, 4, "view"), (None, "2024-01-01 12:00:00", None, 4, "view"), (3, "2024-01-01 12:00:00", "2023-01-01 00:00:00", None, "view"), (5, "2024-01-02 00:00:00", "2023-01-01 00:00:00", 9, "view")]
    c = spark.createDataFrame([(*r, None, None, "x", "y") for r in rows], "click_id long, ts string, arrived_at string, client_id long, kind string, value double, props string, batch string, sale string")
    c = c.selectExpr(*[f"cast({x.split()[0]} as {x.split()[1]}) as {x.split()[0]}" for x in clicks.split(", ")])
    s = spark.createDataFrame([(1, 4, None, None, 1), (2, None, "2024-01-01 00:00:00", None, 1)], "sale_id long, client_id long, sold_at string, arrived_at string, bucket int")
    s = s.selectExpr(*[f"cast({x.split()[0]} as {x.split()[1]}) as {x.split()[0]}" for x in sales.split(", ")])
    got = sorted((r["batch"], r["client_id"], r["t_us"], r["sale"]) for r in follow_up.shop_events(c, s).collect())
    own = min(11, (11 + 80 * (zlib.crc32(b"1") % 4)) * 12 // 3648)
    nine = min(11, max(0, (-8760 + 80 * (zlib.crc32(b"5") % 4)) * 12 // 3648))
    day = 1_704_067_200_000_000
    assert got == sorted([(own, 4, day + 10 * HOUR + 1, False), (11, 4, day + 12 * HOUR, False), (nine, 9, day + 24 * HOUR, False)])


def test_follow_ups_open_one_store_for_a_partition(spark):
    """Spark does not free all that a state store took, so a start must not open more of them than it has to. A batch without events, and
    obligations that end without any later event of their client."""
    start = 1_700_000_000_000_000 // HOUR * HOUR
    events = [(0, 1, start, False), (0, 2, start, False), (0, 3, start + 90 * HOUR, True), (2, 2, start + 300 * HOUR, False)]
    df = spark.createDataFrame(events, "batch int, client_id long, t_us long, sale boolean")
    there = Path(shared_dir(spark).removeprefix("file://"))
    before = set(there.glob("follow-up-*"))
    got = follow_up.missing_follow_ups(df, batches=3)
    assert sorted(map(tuple, got.collect())) == alerts_by_loops(events, 3)
    (own,) = set(there.glob("follow-up-*")) - before
    assert [x.name for x in (own / "checkpoint/state").iterdir()] == ["0"]


def test_time_without_a_zone_is_read_as_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.000001' AS a, timestamp_ntz'1969-12-31 23:59:59.5' AS b")
        assert tuple(df.select(follow_up.micros(df, "a"), follow_up.micros(df, "b")).first()) == (1_710_037_800_000_001, -500_000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# Vector codes


def codes_by_loops(rows, parts, entries, rounds, scale=4096):
    import math

    kept = [(i, v, la) for i, v, la in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    cut = [[[math.floor(scale * x) for x in v][p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)] for _, v, _ in kept]
    by_id = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, [y for x in cut[k] for y in x]))[:entries]
    books = [[cut[k][p] for k in by_id] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(groups[k]) for col in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    out = []
    for (i, _, la), c in zip(kept, cut, strict=True):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, la, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest()


def test_codes_query_equals_its_sql(spark):
    got = vector_codes.op12_vector_code_compression(spark, DIR)
    assert sorted(map(tuple, got.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str) == from_sql(vector_codes.SQL["op12_vector_code_compression"])


def test_codes_by_loops(spark):
    """Ties between entries, repeated rows and ids, null ids and labels, vectors that are left out, clashing columns."""
    r = random.Random(8)
    rows = [(k // 2 if k < 20 else k, [r.choice([-1.0, -0.5, 0.0, 0.25, 0.5]) + r.choice([0, 0, 1 / 4096]) for _ in range(8)], r.choice([None, 1, 2])) for k in range(120)]
    rows += [rows[30], rows[30], (None, rows[40][1], None), (500, None, 1), (501, [*rows[0][1][:7], None], 1), (502, [float("nan")] * 8, 1), (503, [float("inf")] * 8, 2), (504, [-float("inf")] * 8, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("x")).withColumn("error", F.lit(1)).withColumn("__label", F.lit(2))
    coded, books = vector_codes.compress(df, parts=4, entries=6, rounds=3)
    want, digest = codes_by_loops(rows, 4, 6, 3)
    assert vector_codes.digest(books) == digest
    assert sorted(map(tuple, coded.collect()), key=str) == want
    sums = {}
    for _, la, _, e in want:
        sums[la] = sums.get(la, 0) + e
    assert {(x["label"], x["label_error"]) for x in vector_codes.with_label_error(coded).collect()} == set(sums.items())


def test_codes_of_few_or_no_vectors(spark):
    few = spark.createDataFrame([(3, [0.5] * 8, None), (1, [0.25] * 8, 4), (9, [1.0] * 4, 4)], "vec_id long, embedding array<double>, label int")
    coded, books = vector_codes.compress(few)
    assert books.shape == (8, 2, 1) and sorted(map(tuple, coded.collect())) == [(1, 4, "00" * 8, 0), (3, None, "01" * 8, 0)]
    coded, books = vector_codes.compress(few.limit(0))
    assert coded.count() == 0 and books.size == 0 and vector_codes.with_label_error(coded).count() == 0
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30] * 8, 1)], few.schema))[0].count()


def test_tree_finds_the_lowest_of_equal_entries():
    r = np.random.default_rng(4)
    for size, width in ((1, 3), (16, 8), (40, 2), (16, 1)):
        entries, x = r.integers(-3, 4, (size, width)), r.integers(-5, 6, (500, width))
        d = ((x[:, None] - entries[None]) ** 2).sum(2)
        who, best = vector_codes.Tree(entries).nearest(x)
        assert (who == d.argmin(1)).all() and (best == d.min(1)).all()


# BPE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    t.no_truncation()
    t.no_padding()

    def want(text):
        ids = t.encode(text or "", add_special_tokens=False).ids
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    return want


def test_round_trip_equals_the_library(spark, odd_docs, library):
    texts = dict((r["doc_id"], r["text"]) for r in odd_docs.collect())
    got = bpe.round_trip(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(tuple(r)[1:] == library(texts[r["doc_id"]]) for r in got if r["doc_id"] is not None)
    assert bpe.round_trip(odd_docs.limit(0)).count() == 0


def test_round_trip_of_the_query(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    got = bpe.op13_bpe_round_trip(spark, DIR).collect()
    assert len(got) == len(docs) and all(tuple(r)[1:] == library(docs[r["doc_id"]]) for r in got)


def test_fragments_equal_the_library(library):
    import public_tokenizers

    own = bpe.Encoder(public_tokenizers.path(bpe.TOKENIZER))
    r = random.Random(1)
    signs = [*"abqzxKé19½!?.-_中अ", " ", "  ", "\n", "\t", " ", "　", "\u0085", "\x1c", "\x00", "'", "'s", "'ll", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "</w>", "é", "́", "İ", "Σ", "ß", "🙂", "‍", "Ａ", "ﬁ", "Å", "ᄀ", "ᅡ", "ᆨ"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(40))) for _ in range(3000)]
    texts += ["zq" * 200_000, " " * 300_000, "a" + "\n" * 300_000 + "b", " " * 1000, "中" * 50_000]
    want = [library(t) for t in texts]
    assert own.digests(texts) == want
    assert [own.long_digest(t) for t in texts] == want
    assert any(len(own.bounds.cut(w)) > 1 for w in ("qzxv", "zzqx"))


def test_long_texts_go_through_in_parts(monkeypatch, library):
    import public_tokenizers

    monkeypatch.setattr(bpe, "KEPT", 50)
    own = bpe.Encoder(public_tokenizers.path(bpe.TOKENIZER))
    text = " ".join(f"word{k % 300} it's\n" for k in range(20_000))
    monkeypatch.setattr(bpe.parts, "__defaults__", (1000,))
    assert len(list(bpe.parts(text))) > 100 and own.long_digest(text) == library(text)


def test_encoded_texts(spark, library):
    rows = bpe.encoded(spark.createDataFrame([(1, "Hello, World's 12"), (2, None)], "doc_id long, text string")).collect()
    for r in rows:
        ids = " ".join(map(str, r["ids"]))
        assert (len(r["ids"]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(r["decoded"].encode()).hexdigest()) == library("Hello, World's 12" if r["doc_id"] == 1 else "")
