"""Quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters run over each chunk's embedded
bytes and are max-pooled per chunk; over the chunks the largest, the mean and the least of each filter are kept, and a small
layer combines them into one probability. Filters, embedding and layers are learned together by gradient descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, tidy
from .training import held_out, sample

CHUNK, STEP = 256, 224
WIDTH, STRIDE, DIM, FILTERS, HIDDEN = 7, 2, 6, 24, 16
THRESHOLD = 0.3
EPOCHS, BATCH, RATE = 10, 32, 0.004
#: Chunks that are convolved at a time, in training and scoring: what bounds the memory, however long a text is.
GROUP = 1024
#: Labelled rows of the sample from which the features' scale is taken.
SCALE_ROWS = 400
_SPAN = (CHUNK - WIDTH) // STRIDE + 1


def chunks(text: str) -> np.ndarray:
    """(chunks, CHUNK) bytes that cover the whole text; the last is filled with zeros. An empty text is one chunk of zeros."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-(len(raw) - CHUNK) // STEP) + 1) if len(raw) > CHUNK else 1
    out = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    out[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(out, CHUNK)[::STEP]


@dataclass
class Network:
    weights: dict[str, np.ndarray]

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Max-pooled filters of chunks, and where each maximum stands: (chunks, FILTERS) twice."""
        w = self.weights
        emb = w["embed"][x]
        windows = np.lib.stride_tricks.sliding_window_view(emb, WIDTH, axis=1)[:, ::STRIDE]
        flat = windows.transpose(0, 1, 3, 2).reshape(len(x) * _SPAN, WIDTH * DIM)
        z = (flat @ w["filters"]).reshape(len(x), _SPAN, FILTERS)
        at = z.argmax(axis=1)
        top = np.take_along_axis(z, at[:, None, :], 1)[:, 0] + w["bias"]
        return np.maximum(top, 0), at

    def gradients(self, groups: list[np.ndarray], at: np.ndarray, dp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the filters and the embedding, from those of the pooled filters of chunks, added up over groups of chunks."""
        w, start = self.weights, 0
        filters, embed = np.zeros_like(w["filters"]), np.zeros((256, DIM))
        for x in groups:
            # Only the window that won its chunk's pooling has a gradient: (chunks, FILTERS, WIDTH) bytes.
            own = slice(start, start + len(x))
            start += len(x)
            place = at[own, :, None] * STRIDE + np.arange(WIDTH)
            bytes_ = x[np.arange(len(x))[:, None, None], place]
            filters += np.einsum("cfk,cf->kf", w["embed"][bytes_].reshape(len(x), FILTERS, WIDTH * DIM), dp[own])
            de = (dp[own, :, None] * w["filters"].T[None]).reshape(-1, DIM)
            embed += np.stack([np.bincount(bytes_.reshape(-1), de[:, j], 256) for j in range(DIM)], 1)
        return filters, embed.astype(np.float32)

    def head(self, f: np.ndarray) -> np.ndarray:
        w = self.weights
        h = np.tanh((f - w["mean"]) / w["scale"] @ w["w1"] + w["b1"])
        return 1 / (1 + np.exp(-np.clip(h @ w["w2"] + w["b2"], -30, 30)))

    def score(self, texts: list[str], group: int = GROUP) -> np.ndarray:
        """A probability for each whole text."""
        return self.head(self.features([chunks(t) for t in texts], group))

    def features(self, parts: list[np.ndarray], group: int = GROUP) -> np.ndarray:
        """The features of texts by all their chunks; at most `group` chunks are convolved at a time."""
        starts = np.append(0, np.cumsum([len(p) for p in parts]))
        out, done = np.empty((int(starts[-1]), FILTERS), np.float32), 0
        for x in _groups(parts, group):
            out[done : done + len(x)] = self.pooled(x)[0]
            done += len(x)
        return combine(out, starts)


def _groups(parts: list[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """The chunks of texts, one text behind the other, `size` of them at a time."""
    held: list[np.ndarray] = []
    room = size
    for p in parts:
        while len(p):
            held.append(p[:room])
            p, room = p[room:], room - len(held[-1])
            if not room:
                yield np.concatenate(held)
                held, room = [], size
    if held:
        yield np.concatenate(held)


def combine(pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest, mean and least of each filter over the chunks of each text."""
    at = starts[:-1]
    return np.hstack([np.maximum.reduceat(pooled, at), np.add.reduceat(pooled, at) / np.diff(starts)[:, None], np.minimum.reduceat(pooled, at)])


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def of(*shape: int, by: float) -> np.ndarray:
        return rng.normal(0, by, shape).astype(np.float32)

    f = 3 * FILTERS
    return {
        "embed": of(256, DIM, by=0.5), "filters": of(WIDTH * DIM, FILTERS, by=(WIDTH * DIM) ** -0.5), "bias": np.zeros(FILTERS, np.float32),
        "w1": of(f, HIDDEN, by=f**-0.5), "b1": np.zeros(HIDDEN, np.float32), "w2": of(HIDDEN, by=HIDDEN**-0.5), "b2": np.zeros(1, np.float32),
        "mean": np.zeros(f, np.float32), "scale": np.ones(f, np.float32),
    }


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7, scale_rows: int = SCALE_ROWS) -> Network:
    """Fit by Adam on batches of texts, all chunks of every text in each epoch, GROUP of them at a time. Without both labels the network gives every text the
    share of label 1, or one half without any."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    net = Network(_start(rng))
    w = net.weights
    if not len(y) or y.min() == y.max():
        w["w2"][:] = 0
        share = (y.sum() + 0.5) / (len(y) + 1)
        w["b2"][:] = np.log(share / (1 - share))
        return net
    parts = [chunks(t) for t in texts]
    learned = [k for k in w if k not in ("mean", "scale")]
    m, v = {k: np.zeros_like(w[k]) for k in learned}, {k: np.zeros_like(w[k]) for k in learned}
    # The pooled features are put on one scale by the untrained filters, over whole texts chosen at random, and stay so.
    first = np.vstack([net.features([parts[i]]) for i in rng.permutation(len(y))[:scale_rows]])
    w["mean"], w["scale"] = first.mean(0), np.tile(first.std(0).mean() + 1e-3, first.shape[1]).astype(np.float32)
    turn = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), BATCH):
            idx = order[k : k + BATCH]
            x = list(_groups([parts[i] for i in idx], GROUP))
            starts = np.append(0, np.cumsum([len(parts[i]) for i in idx]))
            pooled, at = (np.concatenate(v) for v in zip(*(net.pooled(g) for g in x), strict=True))
            f = combine(pooled, starts)
            g = (f - w["mean"]) / w["scale"]
            h = np.tanh(g @ w["w1"] + w["b1"])
            p = 1 / (1 + np.exp(-np.clip(h @ w["w2"] + w["b2"], -30, 30)))
            d = (p - y[idx]) / len(idx)
            grad = {"w2": h.T @ d, "b2": d.sum(keepdims=True)}
            dh = d[:, None] * w["w2"] * (1 - h**2)
            grad["w1"], grad["b1"] = g.T @ dh, dh.sum(0)
            df = dh @ w["w1"].T / w["scale"]
            dp = np.zeros_like(pooled)
            cols = np.arange(FILTERS)
            for b in range(len(idx)):
                s, e = starts[b], starts[b + 1]
                dp[s:e] += df[b, FILTERS : 2 * FILTERS] / (e - s)
                dp[s + pooled[s:e].argmax(0), cols] += df[b, :FILTERS]
                dp[s + pooled[s:e].argmin(0), cols] += df[b, 2 * FILTERS :]
            dp *= pooled > 0
            grad["bias"] = dp.sum(0)
            grad["filters"], grad["embed"] = net.gradients(x, at, dp)
            turn += 1
            rate = RATE * (1 - 0.8 * epoch / epochs)
            for name in learned:
                m[name] = 0.9 * m[name] + 0.1 * grad[name]
                v[name] = 0.99 * v[name] + 0.01 * grad[name] ** 2
                w[name] = (w[name] - rate * (m[name] / (1 - 0.9**turn)) / (np.sqrt(v[name] / (1 - 0.99**turn)) + 1e-8)).astype(np.float32)
    return net


def score_quality(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row of docs. Null and empty texts are scored as a chunk of zeros; repeated rows each
    get a row; a table without rows gives none; columns other than the two named are not read."""
    sent = docs.sparkSession.sparkContext.broadcast(net.weights)  # a few tens of kilobytes
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Network(sent.value)
        for f in frames:
            texts = f["text"].fillna("").tolist()
            for a in range(0, len(texts), 256):
                s = own.score(texts[a : a + 256]).astype(float)
                yield pd.DataFrame({"doc_id": f["doc_id"].iloc[a : a + 256].to_numpy(), "score": s, "predicted": (s >= threshold).astype("int32")})

    return rows.mapInPandas(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def learn(docs: DataFrame, labels: DataFrame, **options) -> Network:
    got = sample(docs, labels, "quality", **options)
    return train(got["text"].tolist(), got["label"].tolist())


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, net).select("doc_id", held_out().alias("held_out"), "score", "predicted")
