import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and river stone light carry seldom Über naïve Garden little market seven north paper glass amber".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) * (pick.random() < 0.4) for _ in range(n))


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, one identifier with two texts."""
    a, b, long = prose(1, 120), prose(2, 150), prose(3, 9000)
    texts = [
        (1, a), (2, a), (3, a), (3, a), (4, None), (5, ""), (6, " \n\t "), (7, b), (8, b + " end"), (9, long),
        (10, "x" * 3000), (11, "one two"), (12, "one  two\n"), (13, f"{a}\n{b}\n\n{a}"), (13, b[:600]), (None, a), (None, None),
        (14, "line that is shared\nown line of fourteen\nLINE that is shared \n\x0bline that is shared"),
        (15, "line that is shared\nanother one of fifteen\r\nshort\nshort"), (16, "Ünïcode \x85   ﬁ\x1cx <|endoftext|> it's"),
    ]
    return [(i, t, ["en", "de", None][n % 3], ["s1", "s2", None, "s1"][n % 4], len(t) if t else None) for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


CLASHES = ["id", "tag", "sha", "size", "host", "kept", "component", "node", "gram", "row", "_id", "_n", "c0", "score", "word", "edge", "bin", "slice",
           "text_key", "inside", "place", "may"]


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with further columns under names that operators use inside."""
    return odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])
