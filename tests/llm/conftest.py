import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHING = ["row", "size", "packed", "node", "key", "place", "kept", "copies", "shard", "document", "n_words", "target", "registers"]


def prose(rng: random.Random, n: int, words: int = 300, prefix: str = "") -> str:
    return " ".join(prefix + "w%d" % min(rng.randrange(words), rng.randrange(words)) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, nulls, empty and very long texts, repeats."""
    rng = random.Random(1)
    rows = []
    shared = prose(rng, 60)
    for i in range(120):
        text = prose(rng, rng.randrange(1, 160))
        if i % 7 == 0:
            text = text + "\n" + shared
        rows.append((i, text, ["en", "de", None][i % 3], ["a", "b", "c", None][min(3, rng.randrange(8))], None))
    base = prose(rng, 400)
    for i in range(120, 140):  # near copies, in a chain of edits and at random places
        words = base.split()
        for _ in range(rng.randrange(1, 12)):
            words[rng.randrange(len(words))] = "edit%d" % rng.randrange(99)
        rows.append((i, " ".join(words), "en", "a", 5))
    rows += [(i, base, "en", "a", 5) for i in range(140, 160)]  # copies
    rows += [(160, None, None, None, None), (161, "", "en", "b", 0), (162, " \t\n ", "en", "b", 3), (163, None, "en", "a", None)]
    rows += [(164, "one", "en", "c", 3), (165, "one", "en", "c", 3), (166, "one two", "de", "c", 7)]
    rows += [(167, prose(rng, 30_000, 5_000), "en", "a", 9), (168, "é ß ñ " * 50, "de", "b", 9)]
    rows += [(None, shared, "en", "a", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    table = spark.createDataFrame(corpus, SCHEMA).repartition(5)
    for name in CLASHING:
        table = table.withColumn(name, F.lit("clash"))
    return table


@pytest.fixture(scope="session")
def repeated(docs):
    """The same with two rows repeated in full."""
    return docs.unionByName(docs.where("doc_id in (7, 150)"))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
