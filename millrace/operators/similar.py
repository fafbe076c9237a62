"""Similarity join by the Ratcliff-Obershelp ratio with a prefix filter on letters.

The ratio of two texts is twice their matching letters over all letters, and no more letters can match than the texts share. So a pair at the
cutoff shares many letters, and if the letters of both are put in one order, rare ones first, a letter is among the first few
of both: those that are left when the least possible share is taken away. Only pairs that meet in such a letter, counted (the second e is
another letter than the first), and whose lengths allow the cutoff are looked at. Groups that meet are cut into blocks of bounded size;
within a pair of blocks the shared letters of all pairs are counted at once, and only pairs that may reach the cutoff, and the best so
far, are compared. No pair becomes a row.

Where two lengths leave room for a letter or two only, letters tell little: names with running numbers share nearly all of them. There the
order of the letters is used. The matching letters are a common subsequence, so a pair at the cutoff has a common subsequence of the least
length that the cutoff asks for, which is what is left of either text when some letters are deleted. All that is left of a text by
deleting so many letters is its signatures, and an equi-join of signatures finds the pairs.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import similarity

#: Texts of one side in a block.
BLOCK = 1_000
#: Letters that are told apart when shared letters are counted; others, the rarest, are counted together.
LETTERS = 256
#: Letters that are deleted for a signature, and signatures of a text for one length of the other side, at most.
DELETED, SIGNATURES = 2, 200


def prefix(text: str, order: dict[str, int], cutoff: float) -> list[tuple[str, int]]:
    """The first letters of a text, rare ones first, one of which it shares with every text at the cutoff: (letter, which one)."""
    seen: Counter = Counter()
    letters = []
    for c in text:
        seen[c] += 1
        letters.append((c, seen[c]))
    letters.sort(key=lambda x: (order.get(x[0], -1), x[0], x[1]))
    least = math.ceil(cutoff * len(text) / (2 - cutoff) - 1e-9)
    return letters[: len(text) - least + 1]


def band(length: int, cutoff: float) -> int:
    """Lengths in bands so wide that those of a pair at the cutoff are in one band or in neighbours."""
    return math.floor(math.log(length) / math.log((2 - cutoff) / cutoff) + 1e-12)


def _signed(df: DataFrame, text: str, order: dict[str, int], cutoff: float, near: bool) -> DataFrame:
    """df with group: one row for each letter of the prefix and band, and with `near` for the neighbouring bands as well."""
    kinds = df.schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            at, groups = [], []
            for k, t in enumerate(f[text]):
                if not t:
                    continue
                b = band(len(t), cutoff)
                for c, n in prefix(t, order, cutoff):
                    for x in (b - 1, b, b + 1) if near else (b,):
                        at.append(k)
                        groups.append(f"{c}\u0001{n}\u0001{x}")
            out = f.iloc[at].reset_index(drop=True)
            out["group"] = groups
            yield out.astype({"group": "object"})

    columns = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in kinds)
    return df.mapInPandas(run, f"{columns}, group string")


def _share(n: int, m: int, cutoff: float) -> int:
    """The least number of matching letters of texts of n and m letters at the cutoff."""
    return math.ceil(cutoff * (n + m) / 2 - 1e-9)


def able(n: int, m: int, cutoff: float) -> bool:
    """Whether texts of these lengths can be at the cutoff."""
    return _share(n, m, cutoff) <= min(n, m)


def few_signatures(n: int, m: int, cutoff: float) -> bool:
    """Whether texts of these lengths are joined by signatures."""
    least = _share(n, m, cutoff)
    return all(x - least <= DELETED and math.comb(x, x - least) <= SIGNATURES for x in (n, m))


def _lengths(df: DataFrame) -> list[int]:
    return [r[0] for r in df.select(F.length("text")).distinct().collect()]


def _deleted(text: Column, n: int) -> Column:
    """What is left of a text when n letters are deleted, each once."""
    out = F.array(text)
    for _ in range(n):
        out = F.array_distinct(F.flatten(F.transform(out, lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))))))
    return out


def _signatures(df: DataFrame, pairs: list[tuple[int, int]], cutoff: float, side: int) -> DataFrame:
    """df with sign: the hash of a signature and of the two lengths it is for; pairs: (length of a key, length of an entry)."""
    rows = df.sparkSession.createDataFrame([(p[side], *p, p[side] - _share(*p, cutoff)) for p in pairs], "__n int, __a int, __b int, __out int")
    sought = df.join(F.broadcast(rows), F.length("text") == F.col("__n"))
    left = reduce(lambda out, n: F.when(F.col("__out") == n, _deleted(F.col("text"), n)).otherwise(out), range(1, DELETED + 1), F.array("text"))
    return sought.withColumn("__left", F.explode(left)).withColumn("sign", F.xxhash64("__a", "__b", "__left")).drop("__n", "__a", "__b", "__out", "__left")


def _near(left: DataFrame, right: DataFrame, pairs: list[tuple[int, int]], cutoff: float) -> DataFrame:
    """key, ratio, ord, value of the pairs of these lengths at the cutoff."""
    a = _signatures(left.select("text"), pairs, cutoff, 0).withColumnRenamed("text", "key")
    met = a.join(_signatures(right, pairs, cutoff, 1), "sign").select("key", "text", "ord", "value", similarity("key", "text").alias("ratio"))
    return met.where(F.col("ratio") >= cutoff).select("key", "ratio", "ord", "value")


def _counted(texts: list[str], letters: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(texts), len(letters) + 1), np.int16)
    for k, t in enumerate(texts):
        for c, n in Counter(t).items():
            out[k, letters.get(c, len(letters))] += n
    return out


def _best(letters: dict[str, int], cutoff: float):
    """For the keys and entries of one pair of blocks: the best entry of each key."""

    def run(keys: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        from difflib import SequenceMatcher

        out = []
        if len(keys) and len(entries):
            entries = entries.sort_values("ord", kind="stable")
            names, values, ords = entries["text"].tolist(), entries["value"].tolist(), entries["ord"].tolist()
            table, size = _counted(names, letters), np.array([len(n) for n in names])
            for key, row in zip(keys["text"].tolist(), _counted(keys["text"].tolist(), letters), strict=True):
                most = 2.0 * np.minimum(table, row).sum(1) / (size + len(key))
                able = np.nonzero(most >= cutoff - 1e-9)[0]
                found = None
                m = SequenceMatcher(None, key, "")
                for i in able[np.argsort(-most[able], kind="stable")].tolist():
                    if found and most[i] < found[0] - 1e-9:
                        break
                    m.set_seqs(key, names[i])
                    r = m.ratio()
                    if r >= cutoff and (found is None or (r, -ords[i]) > (found[0], -found[1])):
                        found = r, ords[i], values[i]
                if found:
                    out.append((key, *found))
        return pd.DataFrame(out, columns=["key", "ratio", "ord", "value"])

    return run


def _met_in_blocks(left: DataFrame, right: DataFrame, cutoff: float, block: int) -> DataFrame:
    """key, ratio, ord, value: for keys and entries that meet in a rare letter the best entries of each pair of blocks."""
    used = right.select(F.explode(F.split("text", "")).alias("c")).groupBy("c").count().collect()  # at most a row a character of Unicode
    order = {r["c"]: k for k, r in enumerate(sorted(used, key=lambda r: (r["count"], r["c"])))}
    letters = {c: k for k, c in enumerate(sorted(order, key=order.get, reverse=True)[:LETTERS])}
    a, b = _signed(left, "text", order, cutoff, True), _signed(right, "text", order, cutoff, False)
    # How many blocks each side of a group has; groups that only one side has are left out.
    sides = [x.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(n)) for x, n in ((a, "na"), (b, "nb"))]
    sizes = sides[0].join(sides[1], "group")

    def blocks(x: DataFrame, own: str, other: str) -> DataFrame:
        placed = x.join(sizes, "group").withColumn(own, F.pmod(F.xxhash64("text"), F.col(f"n{own}")).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n{other}") - 1))).drop("na", "nb")

    on = ["group", "a", "b"]
    met = blocks(a, "a", "b").groupBy(*on).cogroup(blocks(b, "b", "a").groupBy(*on))
    return met.applyInPandas(_best(letters, cutoff), "key string, ratio double, ord long, value string")


def best_match(keys: DataFrame, key: str, names: DataFrame, cutoff: float = 0.82, block: int = BLOCK) -> DataFrame:
    """key, match, ratio: for each row of keys (distinct texts) the value of the most similar entry of names (key, value, ord), the first by
    ord on ties, when its ratio is at least `cutoff`, which has to be above 0; null otherwise. Null and empty texts match nothing.

    The driver sees the lengths of both sides and the alphabet of the entries with its counts, nothing else. The work of a frequent letter
    is spread by blocks."""
    if not 0 < cutoff <= 1:
        raise ValueError("the cutoff has to be above 0")
    left = keys.select(F.col(key).alias("text")).where("text <> ''").distinct()
    right = names.select(F.col("key").alias("text"), F.col("value").cast("string").alias("value"), F.col("ord").cast("long").alias("ord")).where("text <> ''")
    right = right.groupBy("text").agg(F.min(F.struct("ord", "value")).alias("x")).select("text", "x.value", "x.ord")  # of equal texts the first is the match
    lengths = _lengths(left), _lengths(right)
    pairs = [(n, m) for n in lengths[0] for m in lengths[1] if able(n, m, cutoff)]
    few = [p for p in pairs if few_signatures(*p, cutoff)]
    many = set(pairs) - set(few)
    parts = [_near(left, right, few, cutoff)] if few else []
    if many:
        sides = [x.where(F.length("text").isin(sorted({p[k] for p in many}))) for k, x in enumerate((left, right))]
        parts.append(_met_in_blocks(*sides, cutoff, block))
    if not parts:
        return keys.select(key, F.lit(None).cast("string").alias("match"), F.lit(None).cast("double").alias("ratio"))
    found = reduce(DataFrame.unionByName, parts)
    best = found.groupBy("key").agg(F.max_by(F.struct("value", "ratio"), F.struct("ratio", -F.col("ord"))).alias("x"))
    return keys.join(best.select(F.col("key").alias(key), F.col("x.value").alias("match"), F.col("x.ratio").alias("ratio")), key, "left").select(key, "match", "ratio")
