"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all its
segmentations into pieces, by the forward algorithm; a text's is the product over its words. Training is one step of
expectation maximisation from a prior by rank: expected piece counts by forward and backward sums, over every training text.
The model has (pieces x languages) numbers whatever the size of the corpus.

Words are runs of letters in lower case. A run of more than MAX_LEN letters is read, in training and in scoring, in parts of that
length, the first of which begins the word: every letter counts, and the time for a text is in proportion to its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import crc_mod, documents, materialize, slices, tidy
from .hashing import Slots, Words

VOCABULARY = "piece_bpe_32k.model"
#: Distinct words that a worker holds before it spends them on expected counts, or the scores of words that it keeps.
MAX_WORDS = 250_000
#: Letters of a word, or of a part of a longer one, at most.
MAX_LEN = 24
#: Languages that are learned at most; the model has a number for each piece and language, so some 50 MB.
MAX_LANGUAGES = 200
#: Pseudo-count of the pooled distribution in each language's.
POOLED = 2000.0
#: How much more than usual a letter's probability may take, in the logarithm, in a text that is kept; short texts vary more.
SLACK, SLACK_SHORT = 2.5, 3.0
_UNKNOWN = 1e-7
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: A letter, as a pattern: Unicode's category, without numerals of any kind.
LETTER = r"\p{L}"


def vocabulary(path: str | None = None) -> list[str]:
    """The vocabulary's pieces in lower case, in rank order, without control and byte pieces."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    out = dict.fromkeys(sp.id_to_piece(i).lower() for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return [p for p in out if p.strip("▁") or p == "▁"]


def _hash(points: np.ndarray) -> np.ndarray:
    """Rolling hashes of the prefixes of each row of code points: (rows, length + 1)."""
    out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for j in range(points.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + points[:, j].astype(np.uint64) + np.uint64(1)
    return out


def _points(words: list[str] | np.ndarray) -> np.ndarray:
    """Words of one length as rows of code points."""
    return words if isinstance(words, np.ndarray) else np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _prefix(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)


class Lattice:
    """Which pieces stand where in words: the part of the forward algorithm that is the same for all languages."""

    def __init__(self, pieces: list[str]):
        keys = np.array([int(_hash(_points([p]))[0, -1]) for p in pieces], np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ids, self.n = keys[order], order.astype(np.int32), len(pieces)
        self.longest = max(map(len, pieces))
        self.powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        # Most parts of words are no pieces: a small table of key prefixes tells so at once.
        self.there = np.zeros(1 << 20, bool)
        self.there[_prefix(keys)] = True

    def spans(self, words: list[str] | np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For words of one length: (start, end, indexes of the words that have a piece there, the pieces), by end, then start."""
        h = _hash(_points(words))
        for j in range(1, h.shape[1]):
            for i in range(max(0, j - self.longest), j):
                want = h[:, j] - h[:, i] * self.powers[j - i]
                at = np.nonzero(self.there[_prefix(want)])[0]
                want = want[at]
                k = np.minimum(np.searchsorted(self.keys, want), self.n - 1)
                ok = self.keys[k] == want
                yield i, j, at[ok], self.ids[k[ok]]

    def forward(self, words: list[str] | np.ndarray, table: np.ndarray) -> np.ndarray:
        """log of the summed probability of each word (all of one length) in each language: (words, languages).
        table: (pieces + 1, languages). Sums are rescaled at each position, so no length underflows."""
        words = _points(words)
        length = words.shape[1]
        alpha = [np.ones((len(words), table.shape[1]))] + [None] * length
        scale = np.zeros((len(words), table.shape[1]))
        at = 0
        total = None
        for i, j, row, piece in self.spans(words):
            if j != at:
                if at:
                    self._close(alpha, at, total, scale)
                at, total = j, np.zeros_like(alpha[0])
            if i == j - 1 and len(row) < len(words):
                other = np.ones(len(words), bool)
                other[row] = False
                total[other] += alpha[i][other] * _UNKNOWN
            total[row] += alpha[i][row] * table[piece]
        self._close(alpha, at, total, scale)
        return scale

    def _close(self, alpha: list, at: int, total: np.ndarray, scale: np.ndarray) -> None:
        scale += np.log(total)
        for k in range(max(0, at - self.longest), at):
            alpha[k] = alpha[k] / total
        alpha[at] = np.ones_like(total)

    def expected(self, words: list[str] | np.ndarray, counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
        """Expected counts of each piece, for words of one length that occur `counts` times, under a prior."""
        words = _points(words)
        length = words.shape[1]
        alpha, beta = np.zeros((length + 1, len(words))), np.zeros((length + 1, len(words)))
        alpha[0] = beta[length] = 1
        spans = []
        for i, j, row, piece in self.spans(words):
            other = None
            if i == j - 1 and len(row) < len(words):
                other = np.ones(len(words), bool)
                other[row] = False
                other = np.nonzero(other)[0]
                alpha[j][other] += alpha[i][other] * _UNKNOWN
            p = prior[piece]
            alpha[j][row] += alpha[i][row] * p
            spans.append((i, j, row, piece, p, other))
        for i, j, row, _, p, other in reversed(spans):
            beta[i][row] += beta[j][row] * p
            if other is not None:
                beta[i][other] += beta[j][other] * _UNKNOWN
        times = counts / alpha[length]
        share = [alpha[i][row] * p * beta[j][row] * times[row] for i, j, row, _, p, _ in spans]
        return np.bincount(np.concatenate([s[3] for s in spans]), np.concatenate(share), self.n)


def words_of(texts: list[str]) -> Words:
    return hashing.words_of(texts, LETTER, MAX_LEN)


def lattice_rows(words: Words, which: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexes into `which`, code points) of words of one length at a time, with the mark of a beginning before those that begin a word."""
    for at, points, begins in words.rows(which, most):
        yield at, np.insert(points, 0, ord("▁"), axis=1) if begins else points


class Counts:
    """Distinct words and how often they came."""

    def __init__(self):
        self.slots, self.n = Slots(), np.zeros(0, np.int64)
        self.kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, words: Words) -> None:
        h, first, n = np.unique(words.hash, return_index=True, return_counts=True)
        at = self.slots.find(h)
        self.n[at[at >= 0]] += n[at >= 0]
        new = first[at < 0]
        self.slots.add(h[at < 0])
        self.n = np.append(self.n, n[at < 0])
        length = words.length[new]
        place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        self.kept.append((words.points[np.repeat(words.start[new], length) + place], length, words.begins[new]))

    def words(self) -> Words:
        points, length, begins = (np.concatenate(x) for x in zip(*self.kept, strict=True))
        return Words(points, np.cumsum(length) - length, length, begins, np.zeros(0, np.uint64), np.zeros(0, np.int64))


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    table: np.ndarray  # (pieces + 1, languages)
    per_letter: np.ndarray  # the logarithm of probability that a letter of each language's training texts takes, on average


def _prior(n: int) -> np.ndarray:
    p = 1.0 / (np.arange(n) + 100.0)
    return np.append(p / p.sum(), 0.0)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", vocabulary_path: str | None = None, max_words: int = MAX_WORDS, max_languages: int = MAX_LANGUAGES) -> Model:
    """Fit on every row of docs with a text and a language. What the driver gets is bounded by pieces x languages, and comes to it one
    language at a time; more than `max_languages` different values of the language are an error, before any text is read."""
    pieces = vocabulary(vocabulary_path)
    named = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang")).distinct()
    languages = sorted(r["lang"] for r in named.limit(max_languages + 1).collect())
    if len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice, prior = Lattice(pieces), _prior(len(pieces))
        held: dict[str, Counts] = {}
        total: dict[str, np.ndarray] = {}

        def spend() -> None:
            for lang, own in held.items():
                words = own.words()
                for at, points in lattice_rows(words, np.arange(len(own.slots)), 400_000):
                    total[lang] = total.get(lang, 0) + lattice.expected(points, own.n[at].astype(float), prior)
            held.clear()

        for f in frames:
            for a, b in slices(f["text"].to_numpy(), 2_000_000):
                for lang, g in f.iloc[a:b].groupby("lang", sort=False):
                    held.setdefault(lang, Counts()).add(words_of(g["text"].tolist()))
                if sum(len(c.slots) for c in held.values()) > max_words:
                    spend()
        spend()
        for lang, c in total.items():
            at = np.nonzero(c > 1e-6)[0]
            yield pd.DataFrame({"lang": lang, "piece": at, "n": c[at]})

    found = materialize(rows.mapInPandas(tidy(count), "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")), "pieces")
    c = np.zeros((len(pieces), len(languages)))
    for k, lang in enumerate(languages):
        own = found.where(F.col("lang") == lang).select("piece", "n").toPandas()  # a row a piece at most
        c[own["piece"].to_numpy(), k] = own["n"].to_numpy()
    # A language whose texts have no word is none.
    some = c.sum(0) > 0
    languages, c = [x for x, s in zip(languages, some.tolist(), strict=True) if s], c[:, some]
    per_letter, seen = np.zeros(len(languages)), c
    if languages:
        share = (c / np.maximum(c.sum(0), 1)).mean(1) + 1e-3 * _prior(len(pieces))[:-1]
        share /= share.sum()
        c = (c + POOLED * share[:, None]) / (c.sum(0) + POOLED)
        letters = np.array([len(p.replace("▁", "")) for p in pieces])
        per_letter = (seen * np.log(c)).sum(0) / np.maximum(letters @ seen, 1)
    return Model(languages, pieces, np.vstack([c, np.zeros((1, len(languages)))]), per_letter)


def scorer(pieces: list[str], table: np.ndarray, languages: list[str], max_words: int = MAX_WORDS):
    """A function from texts to (language, score, log probability in that language, letters) arrays. It keeps the scores of at most
    max_words distinct words; when they are full, those that came up again since the last time stay, unless they leave no room."""
    lattice, nl = Lattice(pieces), len(languages)
    slots, logs, again = Slots(), np.zeros((0, nl)), np.zeros(0, bool)

    def numbers(words: Words) -> np.ndarray:
        """The rows of `logs` for all words; those that are new are scored first."""
        nonlocal slots, logs, again
        h, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        at = slots.find(h)
        if len(slots) + int((at < 0).sum()) > max_words and len(slots):
            stay = np.nonzero(again[slots.numbers])[0] if again.sum() + len(h) <= max_words else np.zeros(0, int)
            keys, logs = slots.keys[stay], logs[slots.numbers[stay]]
            slots, again = Slots(), np.zeros(len(stay), bool)
            slots.add(keys)
            at = slots.find(h)
        again[at[at >= 0]] = True
        new = np.nonzero(at < 0)[0]
        value = np.empty((len(new), nl))
        for k, points in lattice_rows(words, first[new], 200_000):
            value[k] = lattice.forward(points, table)
        at[new] = len(logs) + np.arange(len(new))
        slots.add(h[new])
        logs, again = np.vstack([logs, value]), np.append(again, np.zeros(len(new), bool))
        return at[back]

    def score(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        out_lang, out_score, out_log, out_letters = np.full(len(texts), "und", object), np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for a, b in slices(texts, 2_000_000) if nl else ():
            words = words_of(texts[a:b])
            at = numbers(words)
            has = np.nonzero(words.per_text)[0]
            if not len(has):
                continue
            first = (np.cumsum(words.per_text) - words.per_text)[has]
            doc = np.add.reduceat(logs[at], first, axis=0)
            best = doc.argmax(axis=1)
            top = doc[np.arange(len(has)), best]
            out_lang[a + has] = np.array(languages, object)[best]
            out_score[a + has] = np.minimum(1.0, 1 / np.exp(doc - top[:, None]).sum(axis=1))
            out_log[a + has], out_letters[a + has] = top, np.add.reduceat(words.length, first)
        return out_lang, out_score, out_log, out_letters

    return score


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, lang_pred, score: the likeliest language of every whole text and its probability among the learned ones.

    A null text, one without a letter, and any text under a model without languages gives `und` and 0. Equal scores go to the
    language that sorts first. Repeated rows each get a row; other columns are not read."""
    sent = docs.sparkSession.sparkContext.broadcast((model.pieces, model.table, model.languages))  # pieces x languages: bounded

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer(*sent.value, max_words)
        for f in frames:
            lang, value, _, _ = score(f["text"].fillna("").tolist())
            yield pd.DataFrame({"doc_id": f["doc_id"], "lang_pred": lang, "score": value})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.3, slack: float = SLACK, text_col: str = "text", max_words: int = MAX_WORDS) -> DataFrame:
    """The rows of docs whose language is one of the learned ones, with all their columns.

    A row goes if it is `und`, if no language has a score of min_score, or if its letters are too unlikely in the best one: a letter
    takes, in the logarithm, over `slack` + SLACK_SHORT / sqrt(letters) more probability on average than one of that language's
    training texts. Texts in another script, in a language unlike all that were learned, and random letters fail by that; a close
    relative of a learned language may pass.

    Rows pass as Arrow batches in the one pass that scores them, so nothing is joined and columns of any name and type go along."""
    sent = docs.sparkSession.sparkContext.broadcast((model.pieces, model.table, model.languages, model.per_letter))
    at = docs.columns.index(text_col)
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])

    def run(batches):
        import pyarrow as pa

        *parts, per_letter = sent.value
        score = scorer(*parts, max_words)
        usual = dict(zip(parts[2], per_letter, strict=True))
        for batch in batches:
            lang, value, log, letters = score([t or "" for t in batch.column(at).to_pylist()])
            n = np.maximum(letters, 1)
            likely = log / n >= np.array([usual.get(x, 0.0) for x in lang]) - slack - SLACK_SHORT / np.sqrt(n)
            yield batch.filter(pa.array((lang != "und") & (value >= min_score) & likely, pa.bool_()))

    return numbered.mapInArrow(tidy(run), numbered.schema).toDF(*docs.columns)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(crc_mod(doc_id, 4) == 2, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    model = learn(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    return predict(documents(spark, sf_dir))
