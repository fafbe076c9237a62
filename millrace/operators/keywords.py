"""Many keywords in many texts: an automaton that finds all of them in one pass over a text.

The keywords go out once, as one broadcast of bounded size, and each worker builds its automaton once; the time for a text is in
proportion to its length and to what is found, not to the number of keywords. More keywords than the bound go out in several
automata, whose results are put together.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of keywords in one automaton.
MAX_BYTES = 16 << 20

#: The last automata of this worker, each with the keywords that it was made of.
_built: dict[int, tuple] = {}


def _automaton(sent):
    """Built once in a worker for each broadcast."""
    words = sent.value
    if id(words) not in _built:
        import ahocorasick

        a = ahocorasick.Automaton()
        for word, number in words.items():
            a.add_word(word, number)
        a.make_automaton()
        while len(_built) > 7:
            _built.pop(next(iter(_built)))
        _built[id(words)] = words, a  # held, so that no other table comes to have its id
    return _built[id(words)][1]


def _shards(words: dict[str, int], limit: int) -> list[dict[str, int]]:
    out, size = [{}], 0
    for w, n in words.items():
        if out[-1] and size + len(w.encode()) > limit:
            out.append({})
            size = 0
        out[-1][w] = n
        size += len(w.encode())
    return out


def least(spark, text: Column, words: dict[str, int], limit: int = MAX_BYTES) -> Column:
    """The least number of the keywords that stand in the text; null where none does or the text is null. An empty keyword stands in every
    text."""
    always = words.get("")

    def part(shard: dict[str, int]) -> Column:
        sent = spark.sparkContext.broadcast(shard)

        def find(texts: pd.Series) -> pd.Series:
            a = _automaton(sent)
            return pd.Series([min((n for _, n in a.iter(t)), default=None) if t else None for t in texts], dtype="Int32")

        return F.pandas_udf(find, "int")(text)

    found = [part(s) for s in _shards({w: n for w, n in words.items() if w}, limit) if s]
    if always is not None:
        found.append(F.when(text.isNotNull(), F.lit(always)))
    found.append(F.lit(None).cast("int"))
    return F.least(*found, F.lit(None).cast("int"))


def present(spark, text: Column, words: list[str], limit: int = MAX_BYTES) -> Column:
    """The places in `words` (distinct, none empty) of those that stand in the text, ascending; null for a null text."""

    def part(shard: dict[str, int]) -> Column:
        sent = spark.sparkContext.broadcast(shard)

        def find(texts: pd.Series) -> pd.Series:
            a = _automaton(sent)
            return pd.Series([None if t is None else sorted({n for _, n in a.iter(t)}) for t in texts], dtype=object)

        return F.pandas_udf(find, "array<int>")(text)

    parts = [part(s) for s in _shards({w: k for k, w in enumerate(words)}, limit) if s]
    return F.array_sort(reduce(F.concat, parts)) if parts else F.array().cast("array<int>")


def first_profile(df: DataFrame, text: Column, profiles: DataFrame, value: str = "types", limit: int = MAX_BYTES) -> DataFrame:
    """df with `value`: that of the first profile (ord, value column, keywords) by ord one of whose keywords stands in the text, else null.

    The keywords and their profiles' order come to the driver, from where they are sent out; `types` are joined by order."""
    words: dict[str, int] = {}
    for r in profiles.select("ord", F.explode("keywords").alias("word")).where("word is not null").groupBy("word").agg(F.min("ord").alias("ord")).toLocalIterator():
        words[r["word"]] = r["ord"]
    if not words:
        return df.withColumn(value, F.lit(None).cast(profiles.schema[value].dataType))
    types = profiles.groupBy(F.col("ord").alias("__ord")).agg(F.min(value).alias(value))
    return df.withColumn("__ord", least(df.sparkSession, text, words, limit)).join(types, "__ord", "left").drop("__ord")
