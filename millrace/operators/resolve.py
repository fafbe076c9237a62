"""Entity resolution: exact, dictionary, pattern and fuzzy lookups, each as one join a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import grams, similar
from . import keywords as automata

#: Rows of a dimension that may be sent to every task.
BROADCAST_ROWS = 500_000


#: Entries of a dictionary that goes whole to every task.
MAX_ENTRIES = 5_000


def small(df: DataFrame) -> DataFrame:
    """A broadcast hint for a dimension of counted size; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def cascade(df: DataFrame, keys: list[Column], dictionaries: list[DataFrame], value: str) -> DataFrame:
    """df with `value` from the first dictionary whose key is met. dictionaries: (key, value) with one row a key, in order."""
    for i, (k, d) in enumerate(zip(keys, dictionaries, strict=True)):
        df = df.withColumn(f"__k{i}", k).join(small(d.select(F.col("key").alias(f"__k{i}"), F.col("value").alias(f"__v{i}"))), f"__k{i}", "left")
    n = range(len(keys))
    return df.withColumn(value, F.coalesce(*[F.col(f"__v{i}") for i in n])).drop(*[f"__{x}{i}" for x in "kv" for i in n])


def dictionary(base: DataFrame, aliases: DataFrame | None = None, custom: DataFrame | None = None) -> DataFrame:
    """(key, value) from sources (name, value), later ones winning."""
    out = base.select("name", "value", F.lit(0).alias("p"))
    for p, d in ((1, aliases), (2, custom)):
        if d is not None:
            out = out.unionByName(d.select("name", "value", F.lit(p).alias("p")))
    # The key is a column before it is grouped by: Spark takes NFC's call out of a grouping expression, away from the text it is bound to.
    return out.select(T.name_key("name").alias("key"), "value", "p").groupBy("key").agg(F.max_by("value", "p").alias("value"))


def code_of_name(df: DataFrame, name: str, names: DataFrame, value: str = "code", cutoff: float = 0.82) -> DataFrame:
    """Name to code: exact, without accents, without brackets, then fuzzy, each on the distinct names that are left.

    names: (key, value, ord), ord being the dictionary's order, which settles ties of the fuzzy step."""
    exact = names.select("key", "value")
    plain = names.groupBy(T.strip_accents("key").alias("key")).agg(F.max_by("value", "ord").alias("value"))
    each = df.select(F.col(name).alias("__raw")).distinct().withColumn("__key", T.name_key(T.raw_name("__raw")))
    key = F.col("__key")
    found = cascade(each, [key, T.strip_accents(key), T.squeeze(T.without_brackets(key, r"(\[", r")\]"))], [exact, plain, exact], value)
    left = found.where(F.col(value).isNull()).select("__key").where("__key <> ''").distinct()
    found = found.join(fuzzy(left, "__key", names, cutoff), "__key", "left").select("__raw", F.coalesce(value, "match").alias(value))
    return df.join(found, F.col(name).eqNullSafe(F.col("__raw")), "left").drop("__raw")


def fuzzy(keys: DataFrame, key: str, names: DataFrame, cutoff: float = 0.82) -> DataFrame:
    """The most similar dictionary entry of each distinct key, the first in order on ties, and its ratio, when that is at least `cutoff`.

    A dictionary of counted small size is looked at inside the batch UDF: by the letters that two names share no ratio can be above a bound,
    found for all entries at once; only entries whose bound reaches the cutoff, and the best ratio so far, are compared. A larger one is
    joined by rare letters (see similar.best_match), with the same result."""
    if names.limit(MAX_ENTRIES + 1).count() > MAX_ENTRIES:
        return similar.best_match(keys, key, names, cutoff)
    entries = [(r["key"], r["value"]) for r in names.orderBy("ord").collect()]

    def match(frames):
        from difflib import SequenceMatcher

        import numpy as np
        import pandas as pd

        letters = {c: k for k, c in enumerate(sorted({c for name, _ in entries for c in name}))}

        def counted(text: str):
            out = np.zeros(len(letters), np.int32)
            for c in text:
                if c in letters:
                    out[letters[c]] += 1
            return out

        table = np.array([counted(name) for name, _ in entries], np.int32).reshape(len(entries), len(letters))
        size = np.array([len(name) for name, _ in entries])
        for f in frames:
            out = []
            for k in f[key]:
                best, value = 0.0, None
                most = 2.0 * np.minimum(table, counted(k)).sum(axis=1) / np.maximum(size + len(k), 1)
                m = SequenceMatcher(None, k, "")
                place = len(entries)
                for i in np.argsort(-most, kind="stable"):
                    if most[i] < cutoff - 1e-9 or most[i] < best - 1e-9:
                        break
                    m.set_seqs(k, entries[i][0])
                    r = m.ratio()
                    if r >= cutoff and (r > best or r == best and i < place):
                        best, value, place = r, entries[i][1], i
                out.append((k, value, best if value is not None else None))
            yield pd.DataFrame(out, columns=[key, "match", "ratio"])

    return keys.mapInPandas(match, f"{key} string, match string, ratio double")


def store_major(df: DataFrame, majors: DataFrame, code: str = "major_code", name: str = "major_name", value: str = "major_id") -> DataFrame:
    """The id of a major when it is stored: a row with a code is looked up by it alone; one without by its name, then by the shortest
    active name that holds it. majors: id, major_code, name, is_active."""
    has = F.coalesce(T.strip(code), F.lit("")) != ""
    by_code = majors.groupBy(F.col("major_code").alias("key")).agg(F.min("id").alias("value"))
    by_name = majors.groupBy(F.lower("name").alias("key")).agg(F.min("id").alias("value"))
    out = cascade(df, [F.when(has, F.col(code)), F.when(~has, F.lower(name))], [by_code, by_name], value)
    left = out.where(F.col(value).isNull() & ~has & (T.strip(name) != "")).select(F.col(name).alias("__kw")).distinct()
    top = ilike_top(left, "__kw", majors.where("is_active"), "name", "major_code").select("__kw", F.col("major_code").alias("__code"))
    named = small(top.join(by_code.select(F.col("key").alias("__code"), F.col("value").alias("__found")), "__code").select("__kw", "__found"))
    return out.withColumn("__kw", F.when(~has, F.col(name))).join(named, "__kw", "left").withColumn(value, F.coalesce(value, "__found")).drop("__kw", "__found")


def with_entries(names: DataFrame, more: DataFrame) -> DataFrame:
    """A dictionary (key, value, ord) with entries (name, value) added at its end; an entry of a key that is there replaces it."""
    last = names.agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("__last"))
    # As in dictionary, the key is a column first.
    new = more.select(T.name_key("name").alias("key"), "value").groupBy("key").agg(F.max("value").alias("value"))
    placed = new.join(names.select("key", "ord"), "key", "left").join(F.broadcast(last))
    placed = placed.select("key", "value", F.coalesce("ord", F.col("__last") + 1).cast("int").alias("ord"))
    return names.select("key", "value", "ord").join(new.select("key"), "key", "left_anti").unionByName(placed)


def code_map(dimension: DataFrame, code: str, value: str = "id") -> DataFrame:
    """(key, value) by code over active rows."""
    return dimension.where("is_active").select(F.col(code).alias("key"), F.col(value).alias("value"))


def name_map(dimension: DataFrame, name: str = "name", value: str = "id") -> DataFrame:
    """(key, value) by name in lower case over active rows, the least value of each."""
    return dimension.where("is_active").groupBy(F.lower(name).alias("key")).agg(F.min(value).alias("value"))


def active_codes(dimension: DataFrame, code: str) -> DataFrame:
    return dimension.where("is_active").select(code).distinct()


def scan(scores: DataFrame, universities: list | DataFrame, years: list[int], key: str = "university_id", year: str = "year") -> DataFrame:
    """The rows of these universities and years; both go to the scan as filters where the universities are a list."""
    picked = scores.where(F.col(year).isin(years))
    return picked.join(universities.select(key), key, "left_semi") if isinstance(universities, DataFrame) else picked.where(F.col(key).isin(universities))


def ilike_top(keywords: DataFrame, keyword: str, dimension: DataFrame, name: str, code: str, k: int = 1) -> DataFrame:
    """For each distinct keyword the k shortest names that hold it, or whose code does: see grams.ilike_top."""
    return grams.ilike_top(keywords, keyword, dimension, name, code, k)


def first_tags(df: DataFrame, text: Column, profiles: list[tuple[list[str] | str, str]], value: str = "tag") -> DataFrame:
    """The first profile one of whose keywords stands in the text."""
    return df.withColumn(value, T.first_keyword(text, profiles, None))


def top_tags(df: DataFrame, text: Column, weights: dict[str, dict[str, int]], k: int = 3) -> Column:
    """The k tags with the highest sum of the weights of the keywords that stand in the text, above 0, ties by name."""
    scored = [F.struct((-sum((F.when(F.contains(text, F.lit(w)), F.lit(n)).otherwise(F.lit(0)) for w, n in ws.items()), F.lit(0))).alias("s"), F.lit(t).alias("t")) for t, ws in weights.items()]
    best = F.slice(F.array_sort(F.filter(F.array(*scored), lambda x: x["s"] < 0)), 1, k)
    return F.transform(best, lambda x: x["t"])


def tags(df: DataFrame, code: str, text: Column, profiles: DataFrame, value: str = "types") -> DataFrame:
    """The types of the profile that lists the code, the last one of several; else of the first profile with a keyword in the text;
    else no types. profiles: ord, types, keywords, codes. Codes are looked up by a join, keywords by an automaton."""
    by_code = profiles.select("ord", "types", F.explode("codes").alias("__code")).groupBy("__code").agg(F.max_by("types", "ord").alias("__exact"))
    out = automata.first_profile(df.withColumn("__code", F.col(code)), text, profiles.withColumnRenamed("types", "__types"), "__types")
    out = out.join(small(by_code), "__code", "left")
    return out.withColumn(value, F.coalesce("__exact", "__types", F.array().cast("array<string>"))).drop("__code", "__exact", "__types")


def fewest_edits(keys: DataFrame, key: str, names: DataFrame, most: int) -> DataFrame:
    """The native companion of `fuzzy`: the dictionary entry with the fewest edits from each key, the first in order on ties, when
    at most `most`. names: (key, value, ord), a small table of counted size, which goes to the keys as one broadcast row."""
    if names.count() > MAX_ENTRIES:
        raise ValueError("the dictionary is too large to be scanned for each key")
    entries = names.agg(F.collect_list(F.struct("ord", "key", "value")).alias("__entries"))
    best = F.array_min(F.transform("__entries", lambda e: F.struct(F.levenshtein(F.col(key), e["key"]).alias("edits"), e["ord"].alias("ord"), e["value"].alias("value"))))
    out = keys.join(F.broadcast(entries)).withColumn("__best", best).drop("__entries")
    return out.withColumns({"match": F.when(F.col("__best.edits") <= most, F.col("__best.value")), "edits": F.col("__best.edits")}).drop("__best")
