"""Dictionaries of names that meet in one key only when they are composed, in lower case and squeezed."""

import unicodedata

from millrace.operators import resolve

COMPOSED = unicodedata.normalize("NFC", "Kỹ  Thuật")
APART = unicodedata.normalize("NFD", "Kỹ Thuật")
KEY = unicodedata.normalize("NFC", "kỹ thuật")


def test_entries_are_added_by_the_key_of_their_name(spark):
    names = spark.createDataFrame([(KEY, "C1", 0), ("bolt", "C2", 4)], "key string, value string, ord int")
    more = spark.createDataFrame([(COMPOSED, "a"), (APART, "b"), (" NUT ", "c"), ("ring", "d"), (None, "e")], "name string, value string")
    got = resolve.with_entries(names, more)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(KEY, "b", 0), ("bolt", "C2", 4), ("nut", "c", 5), ("ring", "d", 5), (None, "e", 5)], key=str)


def test_later_sources_win_by_the_key_of_a_name(spark):
    base, aliases, custom = (
        spark.createDataFrame(rows, "name string, value string")
        for rows in ([(COMPOSED, "B1"), ("Bolt", "B2"), ("nut", "B3"), (None, "B4")], [(APART, "A1"), (" bolt", "A2")], [("BOLT ", "C2"), ("ring", "C5")])
    )
    for more, want in (((), {KEY: "B1", "bolt": "B2", "nut": "B3", None: "B4"}), ((aliases, custom), {KEY: "A1", "bolt": "C2", "nut": "B3", "ring": "C5", None: "B4"})):
        rows = resolve.dictionary(base, *more).collect()
        assert {r["key"]: r["value"] for r in rows} == want and len(rows) == len(want)
