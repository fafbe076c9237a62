"""Product codes of vectors: k-means in integers for each part of the vectors, with nearest entries found in a kd-tree.

A vector's components become whole numbers and are cut into parts; a codebook of each part position is refined in rounds. In each round
the kd-trees of the codebooks, a few kilobytes, go out with the tasks; branch and bound finds each part's nearest entry and goes into
every node whose bound equals the best distance so far, so that of entries at one distance the one with the lowest index is found. A
task adds up what fell to each entry; the sums meet by entry and component, and only they come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_skewed, materialize, tidy

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Entries of a leaf.
LEAF = 2
#: Distances in 64 bits are exact for whole numbers below this.
LARGEST = 1 << 26
#: Vectors whose distances are computed at a time.
_RUN = 16_384


@dataclass
class _Node:
    low: np.ndarray
    high: np.ndarray
    ids: np.ndarray
    axis: int = -1
    split: int = 0
    children: list[_Node] = field(default_factory=list)


class Tree:
    """A kd-tree over the entries of a codebook: (entries, components) whole numbers."""

    def __init__(self, entries: np.ndarray, leaf: int = LEAF):
        self.entries, self.leaf = entries, leaf
        self.root = self._node(np.arange(len(entries)))

    def _node(self, ids: np.ndarray) -> _Node:
        e = self.entries[ids]
        node = _Node(e.min(0), e.max(0), ids)
        width = node.high - node.low
        if len(ids) > self.leaf and width.size and width.max() > 0:
            node.axis = int(width.argmax())
            values = np.sort(e[:, node.axis])
            # The middle value, or the one below where it is the largest: both sides have entries.
            node.split = int(max(v for v in values[: len(ids) // 2 + 1] if v < values[-1]))
            left = e[:, node.axis] <= node.split
            node.children = [self._node(ids[left]), self._node(ids[~left])]
        return node

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each row's nearest entry, the lowest index on ties."""
        best, who = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(self.entries))
        self._visit(self.root, x, np.arange(len(x)), best, who)
        return who, best

    def _visit(self, node: _Node, x: np.ndarray, rows: np.ndarray, best: np.ndarray, who: np.ndarray) -> None:
        if not len(rows):
            return
        p = x[rows]
        bound = (np.maximum(np.maximum(node.low - p, p - node.high), 0) ** 2).sum(1)
        near = bound <= best[rows]
        rows, p = rows[near], p[near]
        if node.children:
            left = p[:, node.axis] <= node.split
            for side, order in ((rows[left], node.children), (rows[~left], node.children[::-1])):
                for child in order:
                    self._visit(child, x, side, best, who)
            return
        for i in node.ids.tolist():
            d = ((p - self.entries[i]) ** 2).sum(1)
            better = (d < best[rows]) | ((d == best[rows]) & (i < who[rows]))
            best[rows[better]], who[rows[better]] = d[better], i


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """vec_id, label, vector (whole numbers as an array of longs) of the rows whose vector is there and finite throughout."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(v.isNotNull() & finite)
    return rows.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"))


def _matrices(batches: Iterator[pa.RecordBatch], at: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for k in range(0, b.num_rows, _RUN):
            part = b.slice(k, _RUN)
            x = part.column(at).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)
            if x.size and max(int(x.max()), -int(x.min())) >= LARGEST:
                raise ValueError("a component is too large for exact distances")
            yield part, x


def _sums(trees: list[Tree], width: int):
    """What fell to each entry in a task: part, entry, place, n, total."""
    parts, size = len(trees), width // len(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(trees[0].entries)
        n, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, size), np.int64)
        for _, x in _matrices(batches, 0, width):
            for p, tree in enumerate(trees):
                own = np.ascontiguousarray(x[:, p * size : (p + 1) * size])
                who, _ = tree.nearest(own)
                n[p] += np.bincount(who, minlength=k)
                order = np.argsort(who, kind="stable")
                found, begin = np.unique(who[order], return_index=True)
                total[p, found] += np.add.reduceat(own[order], begin, axis=0)
        p, e = np.nonzero(n)
        rows = [np.repeat(p, size), np.repeat(e, size), np.tile(np.arange(size), len(p)), np.repeat(n[p, e], size), total[p, e].reshape(-1)]
        if len(p):
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], ["part", "entry", "place", "n", "total"])

    return run


def refine(kept: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks (parts, entries, components) after some rounds over the written vectors."""
    parts, entries, size = books.shape
    for _ in range(rounds if size else 0):
        run = _sums([Tree(b) for b in books], parts * size)
        sums = kept.select("vector").mapInArrow(tidy(run), "part long, entry long, place long, n long, total long")
        books = books.copy()
        # A row for each number of the codebooks, whatever the number of vectors.
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            books[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    return books


def _coded(trees: list[Tree], width: int):
    parts, size = len(trees), width // len(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _matrices(batches, 2, width):
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, tree in enumerate(trees):
                who, d = tree.nearest(np.ascontiguousarray(x[:, p * size : (p + 1) * size]))
                code[:, p] = who
                error += d
            text = pa.array([row.tobytes().hex() for row in code], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), text, pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers with commas between, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every usable row, the codebooks as an array (parts, entries, components)).

    A row whose vector is null or holds a null or a number that is not finite is left out, and so is one of another length than the vector
    with the least id. The codebooks start with the parts of the vectors of the least ids (of equal ids, by the vector; null ids come last); with fewer vectors
    than entries there are as many entries as vectors. Repeated rows count each. A table without usable rows gives none and empty
    codebooks. Components of 2^26 / scale or more raise an error, a length that the parts don't divide too. Other columns are not read."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index has two hexadecimal digits")
    kept = materialize(usable(vectors, id_col, vector_col, label_col, scale), "vectors")
    first = kept.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(1).collect()
    width = len(first[0]["vector"]) if first else 0
    if width % parts:
        raise ValueError("the parts don't divide the length of the vectors")
    kept = kept.where(F.size("vector") == width)
    seeds = [r["vector"] for r in kept.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()]
    seeded = np.array(seeds, np.int64).reshape(len(seeds), parts, width // parts).transpose(1, 0, 2)
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, label {kept.schema['label'].dataType.simpleString()}, code string, error long"
    if not seeds:
        return kept.sparkSession.createDataFrame([], schema), seeded
    books = refine(kept, seeded, rounds)
    return materialize(kept.mapInArrow(tidy(_coded([Tree(b) for b in books], width)), schema), "codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """coded with label_error, the sum of the errors of its label; null labels are one label."""
    keyed = coded.withColumn("__label", F.coalesce(F.col("label").cast("string"), F.lit("\u0000")))
    sums = materialize(keyed.groupBy("__label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("__n")), "label-errors")
    return join_skewed(keyed, sums, "__label", "__n").drop("__label", "__n")


def op12_vector_code_compression(spark, sf_dir: str) -> DataFrame:
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same in SQL: one row for each number."""
    steps = ["""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long_ AS (SELECT r, unnest(range(len(embedding))) AS i, unnest(embedding) AS x, len(embedding) // 8 AS size FROM kept),
numbers AS (SELECT r, i // size AS p, i % size AS j, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM long_),
book0 AS (SELECT p, r - 1 AS e, j, x AS y FROM numbers WHERE r <= 16)"""]  # fmt: skip
    for k in range(ROUNDS + 1):
        steps.append(f"far{k} AS (SELECT r, p, e, sum((x - y) * (x - y)) AS d FROM numbers JOIN book{k} USING (p, j) GROUP BY r, p, e)")
        steps.append(f"near{k} AS (SELECT r, p, e, d FROM (SELECT *, row_number() OVER (PARTITION BY r, p ORDER BY d, e) AS k FROM far{k}) WHERE k = 1)")
        if k < ROUNDS:
            steps.append(f"mean{k} AS (SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM numbers JOIN near{k} USING (r, p) GROUP BY p, e, j)")
            # Whole-number division goes towards zero; the remainder brings it down.
            steps.append(f"book{k + 1} AS (SELECT p, e, j, coalesce(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END, y) AS y FROM book{k} LEFT JOIN mean{k} USING (p, e, j))")
    return f"""WITH {", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


SQL = {"op12_vector_code_compression": _sql()}
