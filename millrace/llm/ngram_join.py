"""N-gram Jaccard join: MinHash banding, band hashes shuffled, pairs verified on full n-gram sets.

1. Every text becomes the set of its 64-bit word-n-gram hashes; texts with the same set are one node (copies are never paired).
2. A node's MinHash signature is cut into bands of rows, their numbers chosen for a target recall at the threshold. Only band
   hashes shuffle. Within a bucket one byte of each signature row estimates the similarity; nodes whose estimate is far below
   the threshold are not candidates, and the others are linked to one another by a spanning forest, not pair by pair.
3. Candidate components are cut into blocks of bounded size, and every pair of blocks whose set sizes allow a link is
   verified on the full sets: the number of each node's links comes out, and a spanning forest of the links.
4. Components of the verified links are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of_groups, documents, join_skewed, materialize, slices, small, tidy
from .components import connected_components
from .hashing import byte_words, mix
from .id_join import join_ids

N = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 96
#: An estimate from MAX_HASHES rows has a standard deviation of 0.04 at 0.8; a link this far below its value is lost once in a million.
MARGIN = 0.2
#: Nodes of a block, and their n-grams, on average.
BLOCK_ROWS, BLOCK_GRAMS = 256, 400_000
#: N-grams that are hashed at a time.
RUN_GRAMS = 32_768
_M = (1 << 64) - 1


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, and so the fewest false candidates, with which a pair at the threshold meets in a
    band with the given probability, within `most` hashes."""
    best = None
    for rows in range(1, most + 1):
        p = threshold**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall within so many hashes")
    return best


class Shingler:
    """Sets of word-n-gram hashes. Words are what white space parts, in lower case; a text of fewer than n words, but at least
    one, is one gram of all of them."""

    def __init__(self, n: int = N):
        self.n = n

    def sets(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The sorted distinct hashes of each text's n-grams."""
        split = [t.lower().split() for t in texts]
        x = np.frombuffer(" ".join([" ".join(w) for w in split] + [""]).encode("utf-8", "surrogatepass"), np.uint8)
        _, h = byte_words(x, x != 0x20)
        at = 0
        for words in split:
            w = h[at : at + len(words)]
            at += len(words)
            if not len(w):
                yield np.zeros(0, np.uint64)
                continue
            k = min(self.n, len(w))
            gram = np.full(len(w) - k + 1, k, np.uint64)
            for i in range(k):
                gram = mix(gram * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - k + 1 + i])
            yield np.unique(gram)


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    return r.integers(0, _M, count, np.uint64, endpoint=True) | np.uint64(1), r.integers(0, _M, count, np.uint64, endpoint=True)


def signature(grams: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash rows of sets that lie one behind the other: the least of a * x + b of each set, for each (a, b); (sets, rows)."""
    out = np.empty((len(a), len(starts)), np.uint64)
    for i in range(len(a)):
        out[i] = np.minimum.reduceat(grams * a[i] + b[i], starts)
    return np.ascontiguousarray(out.T)


def _nodes(grams: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A signed 64-bit name of each set."""
    return mix(np.add.reduceat(mix(grams), starts) ^ sizes.astype(np.uint64)).view(np.int64)


def _node(grams: np.ndarray) -> int:
    return int(_nodes(grams, np.zeros(1, np.int64), np.array([len(grams)]))[0])


def _runs_of_sets(sets: Iterator[np.ndarray], most: int = RUN_GRAMS) -> Iterator[list[np.ndarray]]:
    """Sets in runs of about `most` grams, which fit into a processor's cache; a larger set is a run of its own."""
    held: list[np.ndarray] = []
    size = 0
    for s in sets:
        if held and size + len(s) > most:
            yield held
            held, size = [], 0
        held.append(s)
        size += len(s)
    if held:
        yield held


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row, node, grams (their number), sig (a byte of each row), bands (a long each). docs: doc_id, text, row."""
    a, b = _constants(bands * rows)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(n)
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for f in frames:
            texts, out = f["text"].fillna("").tolist(), []
            for i, j in slices(texts):
                for held in _runs_of_sets(shingler.sets(texts[i:j])):
                    full = [g for g in held if len(g)]
                    if not full:
                        out += [(None, 0, None, None)] * len(held)
                        continue
                    sizes = np.array([len(g) for g in full])
                    grams, starts = np.concatenate(full), np.cumsum(sizes) - sizes
                    s = signature(grams, starts, a, b)
                    key = np.tile(salt, (len(full), 1))
                    for row in range(rows):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + s[:, row::rows])
                    got = zip(_nodes(grams, starts, sizes).tolist(), sizes.tolist(), (s >> np.uint64(56)).astype(np.uint8), key.view(np.int64), strict=True)
                    for g in held:
                        node = next(got) if len(g) else (None, 0, None, None)
                        out.append((node[0], node[1], node[2].tobytes(), node[3]) if len(g) else node)
            node, grams, sig, keys = zip(*out, strict=True) if out else ((),) * 4
            yield pd.DataFrame({"doc_id": f["doc_id"], "row": f["row"], "node": _longs(node), "grams": _longs(grams), "sig": pd.Series(sig, f.index, object), "bands": pd.Series(keys, f.index, object)})

    return docs.mapInPandas(tidy(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row long, node long, grams long, sig binary, bands array<long>")


def _longs(values):
    """A nullable column of 64-bit integers that never passes through floats."""
    out = np.empty(len(values), object)
    out[:] = [None if v is None else int(v) for v in values]
    return pd.array(out, dtype="Int64")


def _forest(linked: np.ndarray, names: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the components of a symmetric boolean matrix: each node to the least of its component."""
    least = np.arange(len(names))
    linked = linked.copy()
    np.fill_diagonal(linked, True)
    while True:
        new = np.where(linked, least[None, :], len(names)).min(axis=1)
        new = new[new]
        if (new == least).all():
            break
        least = new
    at = np.nonzero(least != np.arange(len(names)))[0]
    return [(int(names[least[i]]), int(names[i])) for i in at]


def _pairs_of_blocks(members: DataFrame, key: str, blocks: str) -> DataFrame:
    """Each member once for each pair of blocks of its group that it takes part in; a column `block` names its own."""
    own = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int"))
    out = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    return out.withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")).drop("other", blocks)


def _estimated(least: float):
    """Rows: key, bi, bj, node, block, sig. Candidate links within each pair of blocks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches_of_groups(frames, ["key", "bi", "bj"]):
            out: list[tuple[int, int]] = []
            keys = f[["key", "bi", "bj"]].to_numpy()
            edge = np.append(np.nonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))[0], len(f))
            nodes, block = f["node"].to_numpy(), f["block"].to_numpy()
            sig = np.frombuffer(b"".join(f["sig"]), np.uint8).reshape(len(f), -1)
            for s, e in zip(edge, edge[1:], strict=False):
                if e - s < 2:
                    continue
                x = sig[s:e]
                if e - s == 2:
                    if (x[0] == x[1]).mean() >= least:
                        out.append((nodes[s], nodes[s + 1]))
                    continue
                like = np.zeros((e - s, e - s), bool)
                for i in range(e - s):
                    like[i] = (x == x[i]).mean(axis=1) >= least
                if keys[s][1] != keys[s][2]:
                    like &= block[s:e, None] != block[None, s:e]
                out += _forest(like, nodes[s:e])
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _verified(threshold: float):
    """Rows: comp, bi, bj, node, block, weight, set. Out: (a, b) links of a spanning forest, and (node, n) numbers of links."""

    def one(sets: list[np.ndarray], nodes, block, weight, cross: bool):
        sizes = np.array([len(s) for s in sets])
        every, at = np.unique(np.concatenate(sets), return_inverse=True)
        who = np.repeat(np.arange(len(sets)), sizes)
        shared = np.bincount(at, minlength=len(every)) > 1
        column = np.cumsum(shared) - 1
        use = shared[at]
        who, col = who[use], column[at[use]]
        both = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(col, kind="stable")
        who, col = who[order], col[order]
        for c in range(0, int(shared.sum()), 4096):
            i, j = np.searchsorted(col, (c, c + 4096))
            part = np.zeros((len(sets), 4096), np.float32)
            part[who[i:j], col[i:j] - c] = 1
            both += part @ part.T
        union = sizes[:, None] + sizes[None, :] - both
        linked = both >= threshold * union - 1e-6
        np.fill_diagonal(linked, False)
        if cross:
            linked &= block[:, None] != block[None, :]
        return _forest(linked, nodes), (linked * weight[None, :]).sum(axis=1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches_of_groups(frames, ["comp", "bi", "bj"]):
            links, counts = [], []
            keys = f[["comp", "bi", "bj"]].to_numpy()
            edge = np.append(np.nonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))[0], len(f))
            nodes, block, weight = f["node"].to_numpy(), f["block"].to_numpy(), f["weight"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in f["set"]]
            for s, e in zip(edge, edge[1:], strict=False):
                if e - s < 2:
                    continue
                forest, n = one(sets[s:e], nodes[s:e], block[s:e], weight[s:e], keys[s][1] != keys[s][2])
                links += forest
                counts += [(nodes[s + i], n[i]) for i in np.nonzero(n)[0]]
            yield pd.DataFrame({"a": _longs([a for a, _ in links + counts]), "b": _longs([b for _, b in links] + [None] * len(counts)), "n": _longs([0] * len(links) + [c for _, c in counts])})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of docs: doc_id, class_id (the least id of its class), n_links (other rows with a Jaccard similarity of
    word-n-gram sets of at least `threshold`), class_size.

    A class is a connected component of such links, copies included. A null or empty text, or one of white space only, has no
    n-grams and is a class of its own without links; its class_id is its own id. Repeated rows are copies of one another. Rows
    with a null id take part, and a class of such rows alone has a null class_id; rows that share an id are told apart by their texts. An empty table gives no rows; columns
    other than the two named are not read."""
    # A row is told by a hash of its id and text, so that rows under one id, or without any, are different ones unless they are copies.
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("row"))
    bands, rows = choose_bands(threshold, recall)
    signed = materialize(signatures(docs, n, bands, rows), "signed")
    has = signed.where("node is not null")
    nodes = materialize(has.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("row").alias("row"), F.count(F.lit(1)).alias("weight"), F.first("grams").alias("grams"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "nodes")

    # Buckets of two nodes or more.
    placed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = materialize(placed.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "buckets")
    met = nodes.select("node", "sig", F.explode("bands").alias("key")).join(small(buckets), "key")
    met = _pairs_of_blocks(met.withColumn("blocks", F.ceil(F.col("k") / BLOCK_ROWS)).drop("k"), "key", "blocks")
    least = threshold - MARGIN + 1 / 256 * (1 - threshold + MARGIN)
    candidates = met.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "node").mapInPandas(tidy(_estimated(least)), "a long, b long")
    comp = connected_components(candidates)

    # Blocks of bounded size: large components are parted by the logarithm of the set size, since linked sets differ by less than one step.
    step = math.log(1 / threshold) if threshold < 1 else 1.0
    member = materialize(comp.select("node", F.col("label").alias("comp")).join(nodes.select("node", "row", "weight", "grams"), "node"), "members")
    total = member.groupBy("comp").agg(F.count(F.lit(1)).alias("k"), F.sum("grams").alias("g"))
    many = (F.col("k") > BLOCK_ROWS) | (F.col("g") > BLOCK_GRAMS)
    large = small(materialize(total.where(many).select("comp"), "large"))
    one_block = member.join(large, "comp", "left_anti").select("node", "comp", "weight", F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.lit(0).alias("block"))
    big = member.join(large, "comp").withColumn("level", F.floor(F.log("grams") / F.lit(step)).cast("int"))
    levels = big.groupBy("comp", "level").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS * 2), F.ceil(F.sum("grams") / BLOCK_GRAMS * 2)).cast("int").alias("nb"))
    levels = small(materialize(levels, "levels"))
    own = big.join(levels, ["comp", "level"]).withColumn("block", F.col("level") * 1_000_000 + F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
    facing = levels.select("comp", F.col("level").alias("to"), F.col("nb").alias("n_to"))
    facing = facing.select("comp", "to", "n_to", F.explode(F.sequence(F.col("to") - 1, F.col("to") + 1)).alias("level"))
    blocks = own.join(facing, ["comp", "level"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_to") - 1))).withColumn("other", F.col("to") * 1_000_000 + F.col("other"))
    blocks = blocks.select("node", "comp", "weight", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block")
    tasks = one_block.unionByName(blocks)

    # The full sets of candidates only, from the text of one row of each node (and its copies under the same id, if any).
    wanted = materialize(member.select(F.col("row").alias("__row"), F.col("node").alias("want")), "wanted")
    kept = join_ids(docs, wanted, "row", "__row", "inner").select("want", "text")

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(n)
        for f in frames:
            texts = f["text"].fillna("").tolist()
            for i, j in slices(texts):
                got = [(w, g.tobytes()) for w, g in zip(f["want"].iloc[i:j], shingler.sets(texts[i:j]), strict=True) if len(g) and _node(g) == w]
                yield pd.DataFrame(got, columns=["node", "set"]).astype({"node": "int64"})

    full = materialize(kept.mapInPandas(tidy(sets), "node long, set binary"), "sets").dropDuplicates(["node"])
    checked = materialize(
        tasks.join(full, "node").repartition("comp", "bi", "bj").sortWithinPartitions("comp", "bi", "bj", "node").mapInPandas(tidy(_verified(threshold)), "a long, b long, n long"),
        "verified",
    )
    label = connected_components(checked.where("b is not null").select("a", "b"))
    links = checked.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = nodes.select("node", "rep", "weight").join(label, "node", "left").join(links, "node", "left")
    named = materialize(named.select("node", "rep", "weight", F.coalesce("label", "node").alias("label"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "named")
    # Classes of one node need no look at another row.
    lone = named.join(label, "node", "left_anti").select("node", "weight", "n_links", F.col("rep").alias("class_id"), F.col("weight").alias("class_size"))
    linked = named.join(label.select("node"), "node", "left_semi")
    classes = linked.groupBy("label").agg(F.min("rep").alias("class_id"), F.sum("weight").alias("class_size"), F.count(F.lit(1)).alias("members"))
    grouped = join_skewed(linked, classes, "label", "members").select("node", "weight", "n_links", "class_id", "class_size")
    verdict = materialize(lone.unionByName(grouped), "verdict")
    out = join_skewed(has.select("doc_id", "node"), verdict, "node", "weight").select("doc_id", "class_id", "n_links", "class_size")
    empty = signed.where("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size"))
    return out.unionByName(empty)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows whose id is not the least of their class. Ids are taken to name rows, as exact dedup leaves them; a row
    without an id always stays, and rows that share an id go or stay together."""
    found = materialize(near_duplicates(docs, id_col, text_col, **options), "classes")
    drop = materialize(found.where("doc_id is not null and not doc_id <=> class_id").select(F.col("doc_id").alias("__drop")).distinct(), "drop")
    return join_ids(docs, drop, id_col, "__drop", "left_anti")


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
