"""Language-model scoring with a log-frequency Bloom filter.

Every word, and every pair of neighbouring words, of the training texts is counted. A count c is stored as its level
1 + floor(log(c) / log(base)): the filter holds the n-gram together with each level up to its own, so a lookup probes level after
level until one is missing, and errors only ever raise a level. N-grams are dealt by hash to buckets, whose counts move as packed
arrays; each bucket makes its own segment of the filter. A probability interpolates the pair's relative frequency with the word's.

Every counted word and pair is stored, whatever the corpus; only what is broadcast has a bound. A filter of at most `filter_bytes`
whose corpus has at most `word_rows` distinct words is put together and broadcast with the exact counts of the words. A larger one
stays in its written segments, and the probes go to them: each run of texts sends its distinct n-grams to their buckets, pairs as
fingerprints of 32 bits, and gets back a byte of level for each, and for words the exact count. Both ways give the same scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of_groups, crc_mod, discard, documents, materialize, slices, tidy
from .hashing import byte_words, mix

BASE = 1.4
#: Bits of the filter for each stored (n-gram, level), and probes of each: a false positive rate of about 1 %.
BITS_PER_ENTRY, PROBES = 10, 4
#: A filter up to this size is broadcast, as Spark by default broadcasts tables of up to 10 MB; a larger one is probed segment by segment.
FILTER_BYTES = 10 << 20
#: Exact counts of words, 16 bytes each, that are broadcast with it.
WORD_ROWS = 500_000
#: Bytes of training text for each bucket of n-grams, until there are as many buckets as bucket numbers of 16 bits; and the most tasks
#: that they are dealt to. A task merges the counts of one bucket at a time and holds its distinct n-grams.
BUCKET_BYTES, MAX_BUCKETS, MAX_TASKS = 6 << 20, 1 << 16, 20_000
#: Evidence of a word at which its followers' frequencies and the words' own weigh the same.
PRIOR = 100.0
#: Words of a batch that a worker counts before it hands on partial counts.
COUNT_WORDS = 1_500_000
_PAIR, _LEVEL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
END = np.uint64(0x51ED270B0A1F39C1)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _PAIR + (b ^ _LEVEL))


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Words:
    """64-bit hashes of the words of texts, an end after each text. Words are runs of bytes other than 0x20 and 0x09 to 0x0D,
    with A-Z in lower case. Two words have the same hash with a probability of 2^-64."""

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words and ends, number of them in each text)."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        x = np.frombuffer(b" ".join([*raw, b""]).translate(_LOWER), np.uint8)
        start, words = byte_words(x, ~_SPACE[x])
        after = np.searchsorted(start, np.cumsum([len(t) + 1 for t in raw]))  # words up to the end of each text
        out = np.full(len(words) + len(texts), END)
        at = np.ones(len(out), bool)
        at[after + np.arange(len(texts))] = False
        out[at] = words
        return out, np.diff(np.append(0, after)) + 1


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.nonzero(np.append(True, keys[1:] != keys[:-1]))[0] if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _previous(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The word before each word; before the first of a text stands an end."""
    out = np.empty_like(h)
    out[1:] = h[:-1]
    out[np.append(0, np.cumsum(count)[:-1])] = END
    return out


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(grams ^ _LEVEL) % np.uint64(max(1, buckets))).astype(np.int64)


def _by_bucket(to: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of n-grams by bucket that keeps their own within it, and the edges of the buckets in it."""
    order = np.argsort(to.astype(np.uint16) if buckets <= 1 << 16 else to, kind="stable")
    return order, np.append(0, np.cumsum(np.bincount(to, minlength=buckets)))


def _by_print(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of n-grams by bucket, then fingerprint; the edges of the buckets in it, and the fingerprints."""
    to, marks = bucket_of(grams, buckets), prints(grams)
    order = np.argsort(to.astype(np.uint64) << np.uint64(32) | marks)
    return order, np.append(0, np.cumsum(np.bincount(to, minlength=buckets))), marks[order]


def _steps(marks: np.ndarray) -> bytes:
    """Rising 32-bit numbers as the bytes of their differences, the lowest byte of all first: the highest are mostly zero and compress."""
    return np.diff(marks, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.uint32)


def prints(grams: np.ndarray) -> np.ndarray:
    """What stands for an n-gram within its bucket. A clash in 32 bits is rarer than a false positive of the filter while a bucket has
    under 40 million n-grams, and like one only raises a level."""
    return (mix(grams ^ _LEVEL) >> np.uint64(32)).astype(np.uint32)


def _packed(keys: np.ndarray, counts: np.ndarray) -> dict[str, bytes]:
    """Keys as they are, of 4 or 8 bytes, and counts in as many bytes as the largest needs."""
    return {"grams": keys.tobytes(), "counts": counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0)).tobytes()}


def _unpacked(pair: bool, grams: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(grams, np.uint32 if pair else np.uint64)
    return keys, np.frombuffer(counts, f"u{len(counts) // len(keys)}").astype(np.int64) if len(keys) else np.zeros(0, np.int64)


def count_ngrams(texts: DataFrame, buckets: int, base: float) -> DataFrame:
    """One row for each bucket and kind: bucket, pair (boolean), grams and counts (packed; words by their hash, pairs by their
    fingerprint), and by level the number of n-grams (rows) and the sum of their counts (times). A worker adds up millions of words
    before arrays leave it."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> pd.DataFrame:
            rows = []
            for pair in (False, True):
                k, n = np.unique(np.concatenate([x[pair] for x in held]), return_counts=True)
                order, edge = _by_bucket(bucket_of(k, buckets), buckets)
                k, n = (prints(k) if pair else k)[order], n[order]
                for i in np.nonzero(np.diff(edge))[0]:
                    at = slice(edge[i], edge[i + 1])
                    rows.append({"bucket": int(i), "pair": pair, **_packed(k[at], n[at])})
            return pd.DataFrame(rows)

        for f in frames:
            t = f["text"].tolist()
            for a, b in slices(t, 1_500_000):
                h, n = words(t[a:b])
                held.append((h, pair_hash(_previous(h, n), h)))
                size += len(h)
                if size >= COUNT_WORDS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts, held = None, [], 0

        def done() -> Iterator[pd.DataFrame]:
            if at is not None:
                k, n = _summed(*map(np.concatenate, zip(*parts, strict=True)))
                lev = level(n, base)
                yield pd.DataFrame([{"bucket": at[0], "pair": at[1], **_packed(k, n), "rows": np.bincount(lev), "times": np.bincount(lev, n).astype(np.int64)}])

        for f in frames:
            for bucket, pair, grams, counts in zip(f["bucket"], f["pair"], f["grams"], f["counts"], strict=True):
                if (int(bucket), bool(pair)) != at:
                    yield from done()
                    at, parts, held = (int(bucket), bool(pair)), [], 0
                parts.append(_unpacked(pair, grams, counts))
                held += len(parts[-1][0])
                if held > 2 * len(parts[0][0]) + 4_000_000:
                    parts, held = [_summed(*map(np.concatenate, zip(*parts, strict=True)))], 0
        yield from done()

    packed = texts.mapInPandas(tidy(count), "bucket long, pair boolean, grams binary, counts binary")
    dealt = packed.repartition(min(buckets, MAX_TASKS), "bucket").sortWithinPartitions("bucket", "pair")
    return dealt.mapInPandas(tidy(merge), "bucket long, pair boolean, grams binary, counts binary, rows array<long>, times array<long>")


def level(n: np.ndarray, base: float = BASE) -> np.ndarray:
    """The quantised count; counts just below a power of the base are not lifted by rounding."""
    return np.floor(np.log(n) / math.log(base) + 1e-9).astype(np.int64) + 1


class Filter:
    """A Bloom filter of segments; an n-gram's bits, for all levels, lie in one segment."""

    def __init__(self, segments: int, segment_bytes: int, bits: np.ndarray | None = None, probes: int = PROBES):
        self.segments, self.segment_bytes, self.probes = segments, segment_bytes, probes
        self.bits = np.zeros(segments * segment_bytes, np.uint8) if bits is None else bits

    def _bit(self, marks: np.ndarray, lev: np.ndarray, probe: int) -> np.ndarray:
        x = mix(marks + lev.astype(np.uint64) * _LEVEL)
        by = np.uint64((2 * probe + 1) * int(_PAIR) & (1 << 64) - 1)
        return (x * by >> np.uint64(20)) % np.uint64(8 * self.segment_bytes)

    def fill(self, grams: np.ndarray, levels: np.ndarray) -> None:
        """Store grams of this filter, which is one segment, up to their levels."""
        self.fill_marks(prints(grams), levels)

    def fill_marks(self, marks: np.ndarray, levels: np.ndarray) -> None:
        """The same by fingerprint."""
        marks = marks.astype(np.uint64)
        for lev in range(1, int(levels.max()) + 1 if len(levels) else 0):
            g = marks[levels >= lev]
            for p in range(self.probes):
                b = np.sort(self._bit(g, np.full(len(g), lev), p))
                byte = (b >> np.uint64(3)).astype(np.int64)
                first = np.nonzero(np.append(True, byte[1:] != byte[:-1]))[0]
                self.bits[byte[first]] |= np.bitwise_or.reduceat(np.left_shift(1, b & np.uint64(7)).astype(np.uint8), first)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The highest level up to which every level is there; 0 for an n-gram that was not stored."""
        return self.levels_of(prints(grams), bucket_of(grams, self.segments))

    def levels_of(self, marks: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The same by fingerprint and segment."""
        out = np.zeros(len(marks), np.int64)
        if not self.segment_bytes:
            return out
        marks, at, base = marks.astype(np.uint64), np.arange(len(marks)), segment * self.segment_bytes
        lev = 1
        while len(at):
            g, start = marks[at], base[at]
            ok = np.ones(len(at), bool)
            for p in range(self.probes):
                idx = np.nonzero(ok)[0]
                b = self._bit(g[idx], np.full(len(idx), lev), p)
                ok[idx] = self.bits[start[idx] + (b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8) & 1 == 1
            at = at[ok]
            out[at] = lev
            lev += 1
        return out


@dataclass
class Model:
    filter: Filter | None  # None: too large for a broadcast, its segments are the rows of `parts`
    parts: DataFrame | None  # bucket, bits, words, counts: a bucket's bits, one row for each kind of n-gram, with the exact counts of words
    segments: int
    segment_bytes: int
    total: int
    distinct: int
    common: np.ndarray  # hashes of all words, sorted, and their counts, where the filter is broadcast
    common_n: np.ndarray
    base: float


def learn(docs: DataFrame, text_col: str = "text", filter_bytes: int = FILTER_BYTES, word_rows: int = WORD_ROWS, base: float = BASE, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """Count the words and pairs of every row of docs; null texts are empty."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(1, -(-size // bucket_bytes)))
    grams = materialize(count_ngrams(texts, buckets, base), "ngrams")
    # By kind and level: a few dozen rows.
    by = grams.select("pair", F.posexplode(F.arrays_zip("rows", "times")).alias("level", "x")).groupBy("pair", "level")
    by = by.agg(F.sum("x.rows").alias("rows"), F.sum("x.times").alias("n")).where("rows > 0").toPandas()
    of_words = by[~by["pair"].astype(bool)]
    total, distinct = int(of_words["n"].sum()), int(of_words["rows"].sum())
    stored = int((by["rows"] * by["level"]).sum())
    segment_bytes = -(-stored * BITS_PER_ENTRY // (8 * buckets))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A bucket's n-grams of one kind as their bits of its segment."""
        for f in frames:
            for bucket, pair, g, c in zip(f["bucket"], f["pair"], f["grams"], f["counts"], strict=True):
                k, n = _unpacked(pair, g, c)
                own = Filter(1, segment_bytes)
                own.fill_marks(k if pair else prints(k), level(n, base))
                yield pd.DataFrame([{"bucket": bucket, "bits": own.bits.tobytes(), "words": None if pair else g, "counts": None if pair else c}])

    made = materialize(grams.select("bucket", "pair", "grams", "counts").mapInPandas(tidy(build), "bucket long, bits binary, words binary, counts binary"), "segments")
    discard(grams)
    if buckets * segment_bytes > filter_bytes or distinct > word_rows:
        return Model(None, made, buckets, segment_bytes, total, distinct, np.zeros(0, np.uint64), np.zeros(0, np.int64), base)
    whole, parts = Filter(buckets, segment_bytes), [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for row in made.collect():  # twice filter_bytes, and 16 bytes for each of word_rows words, at most
        a = row["bucket"] * segment_bytes
        whole.bits[a : a + segment_bytes] |= np.frombuffer(row["bits"], np.uint8)
        if row["words"] is not None:
            parts.append(_unpacked(False, row["words"], row["counts"]))
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys)
    return Model(whole, None, buckets, segment_bytes, total, distinct, keys[order], n[order], base)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    n_known and base_score come from exact counts; score is the log10 probability of the whole text under the interpolated model, with
    counts probed from the filter. A null or empty text is one end. Repeated rows each get a row, tables without rows give none,
    and a model without texts gives every word the one probability it has. Columns other than the two named are not read."""
    spark = docs.sparkSession
    flt, total, distinct, base, segments, segment_bytes = model.filter, model.total, model.distinct, model.base, model.segments, model.segment_bytes
    sent = spark.sparkContext.broadcast((flt.bits if flt else None, model.common, model.common_n))  # at most filter_bytes and 16 bytes for each of word_rows words
    # Counts that are a level are taken as the middle of it, in the logarithm.
    middle = np.append(0.0, np.maximum(1.0, base ** (np.arange(400) + 0.45)))
    middle[1] = 1.0
    denominator = total + 0.5 * (distinct + 1)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def scores(c1: np.ndarray, at: np.ndarray, c2: np.ndarray, count: np.ndarray, after_end: float) -> np.ndarray:
        """Of each text, by the words' counts and their places, and the count of every pair."""
        p1 = (c1 + 0.5) / denominator
        first = np.append(0, np.cumsum(count)[:-1])
        before = np.append(0.0, c1[at][:-1])
        before[first] = after_end
        share = before / (before + prior)
        p = share * np.minimum(c2 / np.maximum(before, 1), 1.0) + (1 - share) * p1[at]
        return np.add.reduceat(np.log10(p), first)

    def exactly(n: np.ndarray, at: np.ndarray, count: np.ndarray) -> dict:
        """The columns that come from the exact counts of words, by their places."""
        first = np.append(0, np.cumsum(count)[:-1])
        return {"n_tokens": count, "n_known": np.add.reduceat((n > 0).astype(np.int64)[at], first), "base_score": np.add.reduceat(np.log10((n + 0.5) / denominator)[at], first)}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, common, common_n = sent.value
        lookup, words = Filter(segments, segment_bytes, bits), Words()
        after_end = middle[lookup.levels(np.array([END]))[0]]
        for f in frames:
            t = f["text"].tolist()
            for a, b in slices(t, 3_000_000):
                h, count = words(t[a:b])
                at, word = pd.factorize(h)
                key, back = np.unique(pair_hash(_previous(h, count), h), return_inverse=True)
                found = scores(middle[lookup.levels(word)], at, middle[lookup.levels(key)][back], count, after_end)
                n = np.zeros(len(word), np.int64)
                if len(common):
                    place = np.minimum(np.searchsorted(common, word), len(common) - 1)
                    n = np.where(common[place] == word, common_n[place], 0)
                yield pd.DataFrame({"doc_id": f["doc_id"].iloc[a:b].to_numpy(), "score": found, **exactly(n, at, count)})

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, n_tokens long, n_known long, base_score double"
    got = rows.mapInPandas(tidy(run), schema) if flt else _by_segment(rows, model, scores, exactly, middle, schema)
    return got.select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _by_segment(rows: DataFrame, model: Model, scores, exactly, middle: np.ndarray, schema: str) -> DataFrame:
    """The rows of `schema`, with counts probed from the written segments.

    A run of texts (COUNT_WORDS words, or one longer text) sends its distinct n-grams to their buckets, pairs as fingerprints and words
    as hashes, and its texts as packed word numbers along with them. A bucket reads its segment and its words' counts, then its probes
    as they come, and sends levels and counts on."""
    segments, segment_bytes, total = model.segments, model.segment_bytes, model.total
    moved = "slice long, bucket long, kind int, data binary, words binary, counts binary, ids array<%s>" % rows.schema["doc_id"].dataType.simpleString()
    columns = ["slice", "bucket", "kind", "data", "words", "counts", "ids"]
    bits_row, probe_row, text_row = 0, 1, 2

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, k = Words(), TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0

        def out() -> pd.DataFrame:
            h, count = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            at, word = pd.factorize(h)
            # numbers by frequency, so that they compress
            order = np.argsort(-np.bincount(at), kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            word, at = word[order], rank[at]
            pairs = np.unique(pair_hash(_previous(h, count), h))
            (_, edge_p, marks), (by_w, edge_w) = _by_print(pairs, segments), _by_bucket(bucket_of(word, segments), segments)
            asked = word[by_w]
            made = [
                (k, int(i), probe_row, _steps(marks[edge_p[i] : edge_p[i + 1]]), asked[edge_w[i] : edge_w[i + 1]].tobytes(), None, None)
                for i in np.nonzero(np.diff(edge_p) + np.diff(edge_w))[0]
            ]
            made.append((k, k % segments, text_row, _planes(at), word.tobytes(), count.astype(np.int64).tobytes(), [i for x in held for i in x[2]]))
            return pd.DataFrame(made, columns=columns)

        for f in frames:
            t = f["text"].tolist()
            for a, b in slices(t, 1_500_000):
                ids = f["doc_id"].iloc[a:b]
                held.append((*words(t[a:b]), ids.astype(object).where(ids.notna(), None).tolist()))
                size += len(held[-1][0])
                if size >= COUNT_WORDS:
                    yield out()
                    held, size, k = [], 0, k + 1
        if held:
            yield out()

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, at, known, n = Filter(1, segment_bytes), -1, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for f in frames:
            for bucket, g in f.groupby("bucket", sort=False):
                if bucket != at:
                    own, at, known, n = Filter(1, segment_bytes), bucket, np.zeros(0, np.uint64), np.zeros(0, np.int64)
                for bits, w, c in g.loc[g["kind"] == bits_row, ["data", "words", "counts"]].itertuples(index=False):
                    own.bits |= np.frombuffer(bits, np.uint8)
                    if w is not None:
                        known, n = _unpacked(False, w, c)
                asked = g[g["kind"] == probe_row]
                if len(asked):
                    marks, word = np.concatenate([_from_steps(x) for x in asked["data"]]), np.frombuffer(b"".join(asked["words"]), np.uint64)
                    here = np.zeros(len(marks), np.int64)
                    lev, lev_w = own.levels_of(marks, here).astype(np.uint8), own.levels_of(prints(word), here[:1].repeat(len(word))).astype(np.uint8)
                    exact = np.zeros(len(word), np.int64 if total >> 32 else np.uint32)
                    if len(known):
                        place = np.minimum(np.searchsorted(known, word), len(known) - 1)
                        exact[:] = np.where(known[place] == word, n[place], 0)
                    parts, parts_w = ([0, *np.cumsum(asked[c].map(len).to_numpy() // width)] for c, width in (("data", 4), ("words", 8)))
                    yield asked.assign(
                        data=[lev[i:j].tobytes() for i, j in zip(parts, parts[1:], strict=False)], words=[lev_w[i:j].tobytes() for i, j in zip(parts_w, parts_w[1:], strict=False)],
                        counts=[exact[i:j].tobytes() for i, j in zip(parts_w, parts_w[1:], strict=False)],
                    )
                if (g["kind"] == text_row).any():
                    yield g[g["kind"] == text_row]

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches_of_groups(frames, ["slice"]):
            for _, g in f.groupby("slice", sort=False):
                s = g[g["kind"] == text_row].iloc[0]
                word, count = np.frombuffer(s["words"], np.uint64), np.frombuffer(s["counts"], np.int64)
                at = _from_planes(s["data"], int(count.sum()))
                h = word[at]
                pairs, back = np.unique(pair_hash(_previous(h, count), h), return_inverse=True)
                told = g[g["kind"] == probe_row]
                # what the buckets tell comes bucket by bucket, in the order in which it was asked
                c2, c1, n = np.empty(len(pairs)), np.empty(len(word)), np.empty(len(word), np.int64)
                c2[_by_print(pairs, segments)[0]] = middle[np.frombuffer(b"".join(told["data"]), np.uint8)]
                by = _by_bucket(bucket_of(word, segments), segments)[0]
                c1[by], n[by] = middle[np.frombuffer(b"".join(told["words"]), np.uint8)], np.frombuffer(b"".join(told["counts"]), np.int64 if total >> 32 else np.uint32)
                found = scores(c1, at, c2[back], count, c1[np.nonzero(word == END)[0][0]])
                yield pd.DataFrame({"doc_id": pd.Series(list(s["ids"]), dtype=object), "score": found, **exactly(n, at, count)})

    bits = model.parts.select(F.lit(0).cast("long").alias("slice"), "bucket", F.lit(bits_row).alias("kind"), F.col("bits").alias("data"), "words", "counts", F.lit(None).cast(moved.rsplit("ids ", 1)[1]).alias("ids"))
    tasks = min(segments, MAX_TASKS)
    asked = rows.mapInPandas(tidy(send), moved).unionByName(bits).repartition(tasks, "bucket").sortWithinPartitions("bucket", "kind")
    told = asked.mapInPandas(tidy(probe), moved).repartition(tasks, "slice").sortWithinPartitions("slice", "bucket")
    return told.mapInPandas(tidy(gather), schema)


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed bytes, the lowest byte of all first."""
    import pyarrow as pa

    return pa.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _from_planes(data: bytes, n: int) -> np.ndarray:
    import pyarrow as pa

    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(n).astype(np.int64)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(crc_mod(doc_id, 5) == 1, F.lit(False))


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs.where(~held_out()))
    return score(docs, model).withColumn("held_out", held_out())

