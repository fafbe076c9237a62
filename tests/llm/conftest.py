import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    r = random.Random(3)
    long = " ".join(r.choice(WORDS) + str(r.randrange(500)) for _ in range(30_000))
    body = " ".join(r.choice(WORDS) for _ in range(60))
    rows = [
        (1, body, "en"), (2, body, "en"), (2, body, "en"), (3, None, None), (4, "", "en"), (None, body, "en"), (None, None, None),
        (5, body + " extra words here", "en"), (6, long, "en"), (7, long + " tail", "en"), (8, "  \n\t ", "en"), (9, "one two", "en"), (10, "one two", "fr"), (11, "12345 !!!", "en"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for c in ("score", "keep_id", "group_size", "node", "row", "c0", "__row"):
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


@pytest.fixture(scope="session")
def empty_docs(odd_docs):
    return odd_docs.limit(0)
