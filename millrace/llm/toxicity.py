"""Toxicity by a counterfactual-regularised classifier.

A text is read in overlapping windows of words that cover all of it. A window's score is a sum of learned weights of its words
and of their beginnings; the text's is that of its worst window. In training, every identity term in a labelled text is swapped,
within the words around it, for other groups' terms and for neutral words of its language, and so are neutral words for identity
terms; original and copy are both scored by their worst window, and the squared change is a penalty, so that a neutral mention
of a group does not count against a text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, slices, tidy
from .hashing import Slots, Words, words_of
from .training import held_out, sample

# For four languages, terms for groups of people that may stand in each other's place, and neutral words that may.
TERMS = (
    "asian black white latino hispanic african european american arab chinese indian mexican jewish muslim christian hindu buddhist atheist catholic gay lesbian bisexual transgender "
    "queer straight male female man woman boy girl immigrant refugee foreigner disabled deaf blind elderly person someone neighbour friend",
    "jews muslims christians asians blacks whites immigrants refugees foreigners gays lesbians men women boys girls people neighbours friends",
    "jude muslim christ türke araber afrikaner ausländer flüchtling migrant mann frau person mensch nachbar freund",
    "juden muslime christen türken afrikaner flüchtlinge migranten schwule lesben männer frauen behinderte leute menschen nachbarn freunde",
    "juif juive musulman musulmane chrétien arabe noir noire blanc asiatique africain immigré réfugié étranger lesbienne homme femme handicapé personne voisin ami",
    "juifs juives musulmans chrétiens arabes noirs blancs asiatiques africains immigrés réfugiés étrangers lesbiennes hommes femmes handicapés gens personnes voisins amis",
    "judío judía musulmán musulmana cristiano árabe negro negra blanco asiático africano inmigrante refugiado extranjero lesbiana hombre mujer persona vecino amigo",
    "judíos musulmanes cristianos árabes negros blancos asiáticos africanos inmigrantes refugiados extranjeros lesbianas hombres mujeres personas gente vecinos amigos",
)

WINDOW, STEP = 24, 12
BITS = 18
#: Features seen in fewer texts of the sample are not learned.
MIN_TEXTS = 4
EPOCHS, RATE = 240, 0.15
#: The lasso picks features in the first half of the epochs; in the second half those that are left are fitted with the ridge alone.
LASSO, RIDGE = 7e-4, 1e-5
#: Weight of the mean squared change of the score under a swap, and the copies that are made of each mention.
SWAP, COPIES = 1.0, 4
THRESHOLD = 0.5
MAX_WORDS = 300_000
FEATURES = 4
#: A character of a word, as a pattern.
LETTER_OR_DIGIT = r"[^\W_]"
_WORD = re.compile(rf"{LETTER_OR_DIGIT}+")


def features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself and its beginnings of 4 to 6 letters, a shorter word's end being a letter."""
    mask, ended = (1 << BITS) - 1, word + "$"
    return (zlib.crc32(b"w" + word.encode("utf-8", "replace")) & mask, *(zlib.crc32(b"p" + ended[:k].encode("utf-8", "replace")) & mask for k in (4, 5, 6)))


def windows_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of texts that lie one behind the other: their starts and ends, and the place of each text's first window."""
    count = np.where(lengths > WINDOW, -(-(lengths - WINDOW) // STEP) + 1, 1)
    first = np.append(0, np.cumsum(count))
    base = np.append(0, np.cumsum(lengths)[:-1]).astype(np.int64)
    a = np.repeat(base, count) + STEP * (np.arange(first[-1]) - np.repeat(first[:-1], count))
    return a, np.minimum(a + WINDOW, np.repeat(base + lengths, count)), first


def window_ends(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the windows that cover n words; one empty window for no words."""
    return windows_of(np.array([n]))[:2]


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float

    def word(self, word: str) -> float:
        return float(self.weights[list(features(word))].sum())


def swaps(texts: list[list[str]], copies: int = COPIES, seed: int = 5) -> tuple[list[list[str]], list[list[str]]]:
    """For every mention of a term in the texts (their words), the words around it, `copies` times, and as often with another term of
    its kind in its place, chosen at random. An original and its copy hold every window in which the term can stand."""
    rng = np.random.default_rng(seed)
    kinds = [t.split() for t in TERMS]
    others = {w: sorted({x for k in kinds if w in k for x in k} - {w}) for k in kinds for w in k}
    kept, swapped = [], []
    for words in texts:
        for j, w in enumerate(words):
            if w in others:
                a = max(0, j - WINDOW + 1)
                around = words[a : j + WINDOW]
                for k in rng.permutation(len(others[w]))[:copies]:
                    kept.append(around)
                    swapped.append([*around[: j - a], others[w][k], *around[j - a + 1 :]])
    return kept, swapped


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, swap: float = SWAP, copies: int = COPIES) -> Classifier:
    """Full-batch gradient descent on the worst window of each text, with a lasso, by proximal steps, and the swap penalty: `swap` times
    the mean squared change of the worst window's score between an original and its copy. Without both labels every text gets the
    share of label 1, or one half without any."""
    y = np.asarray(labels, float)
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1)
    bias = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max():
        return Classifier(np.zeros(1 << BITS), bias)
    names: dict[str, int] = {}
    terms = {w for t in TERMS for w in t.split()}
    ids, named = [], []

    def numbered(words: list[str]) -> np.ndarray:
        return np.array([names.setdefault(x, len(names)) for x in words], np.int32)

    for t in texts:
        words = _WORD.findall(t.lower())
        ids.append(numbered(words))
        if not terms.isdisjoint(words):
            named.append(words)
    kept, swapped = swaps(named, copies) if swap else ([], [])
    pairs = len(kept)
    ids += [numbered(r) for r in (*kept, *swapped)]
    # Only the features that occur have a place in the arrays of training.
    every, table = np.unique(np.array([features(x) for x in names]).reshape(-1, FEATURES), return_inverse=True)
    table = table.reshape(-1, FEATURES)
    hits, bad = np.zeros(len(every)), np.zeros(len(every))
    for d, label in zip(ids[:n], y, strict=True):
        f = np.unique(table[d])
        hits[f] += 1
        bad[f] += label
    use = hits >= MIN_TEXTS
    # Start from shrunken log odds of the features, so that the first worst windows are not chance.
    odds = np.log((bad + 4 * share) / (y.sum() + 4 * share) / ((hits - bad + 4 * (1 - share)) / (n - y.sum() + 4 * (1 - share))))
    w = np.where(use, 0.2 * odds, 0.0)
    lengths = np.array([len(d) for d in ids])
    flat = np.concatenate(ids)
    starts, ends, first = windows_of(lengths)
    row_of = np.repeat(np.arange(len(ids)), np.diff(first))
    gw, gb = np.full(len(every), 1e-4), 1e-4
    for epoch in range(epochs):
        picking = epoch < epochs // 2
        if epoch == epochs // 2:
            use &= w != 0
            gw[:], gb = 1e-4, 1e-4
        c = np.append(0, np.cumsum(w[table].sum(1)[flat]))
        window = c[ends] - c[starts]
        worst = np.maximum.reduceat(window, first[:-1])
        best = np.nonzero(window == worst[row_of])[0]
        top = best[np.searchsorted(row_of[best], np.arange(len(ids)))]
        p = 1 / (1 + np.exp(-np.clip(worst[:n] + bias, -30, 30)))
        d = np.zeros(len(ids))
        d[:n] = (p - y) / n
        if pairs:
            gap = 2 * swap * (worst[n : n + pairs] - worst[n + pairs :]) / pairs
            d[n : n + pairs], d[n + pairs :] = gap, -gap
        size = ends[top] - starts[top]
        at = np.repeat(starts[top] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
        g = np.bincount(table[flat[at]].ravel(), np.repeat(np.repeat(d, size), FEATURES), len(every)) + (0 if picking else RIDGE) * w
        g[~use] = 0
        gw += g**2
        gb += d[:n].sum() ** 2
        w -= RATE * g / np.sqrt(gw)
        # No word speaks for a window: what stands around an insult does not make up for it.
        w = np.maximum(w - (RATE * LASSO / np.sqrt(gw) if picking else 0), 0)
        bias -= RATE * d[:n].sum() / np.sqrt(gb)
    weights = np.zeros(1 << BITS)
    weights[every] = w
    return Classifier(weights, float(bias))


class _Values:
    """The weights of words, by hash; at most `limit` words are kept."""

    def __init__(self, weights: np.ndarray, limit: int):
        self.weights, self.limit = weights, limit
        self.slots, self.values = Slots(), np.zeros(0)

    def __call__(self, words: Words) -> np.ndarray:
        h, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        at = self.slots.find(h)
        if len(self.slots) + int((at < 0).sum()) > self.limit:
            self.slots, self.values = Slots(), np.zeros(0)
            at = np.full(len(h), -1)
        new = np.nonzero(at < 0)[0]
        if len(new):
            at[new] = len(self.values) + np.arange(len(new))
            value = self.weights[np.array([features(x) for x in words.texts(first[new])]).reshape(-1, FEATURES)].sum(1)
            self.slots.add(h[new])
            self.values = np.append(self.values, value)
        return self.values[at[back]]


def score_toxicity(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, score, predicted for every row of docs. Null and empty texts have one empty window; repeated rows each get a row; a
    table without rows gives none; columns other than the two named are not read."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 2^BITS numbers
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, bias = sent.value
        values = _Values(weights, max_words)
        for f in frames:
            texts, out = f["text"].fillna("").tolist(), [np.zeros(0)]
            for a, b in slices(texts, 2_000_000):
                words = words_of(texts[a:b], LETTER_OR_DIGIT)
                i, j, first = windows_of(words.per_text)
                c = np.append(0, np.cumsum(values(words)))
                out.append(np.maximum.reduceat(c[j] - c[i], first[:-1]) + bias)
            p = 1 / (1 + np.exp(-np.clip(np.concatenate(out), -30, 30)))
            yield pd.DataFrame({"doc_id": f["doc_id"], "score": p, "predicted": (p >= threshold).astype("int32")})

    return rows.mapInPandas(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def learn(docs: DataFrame, labels: DataFrame, swap: float = SWAP, **options) -> Classifier:
    """A classifier from a bounded sample of the labelled rows (see training.sample)."""
    got = sample(docs, labels, "toxic", **options)
    return train(got["text"].tolist(), got["label"].tolist(), swap=swap)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
