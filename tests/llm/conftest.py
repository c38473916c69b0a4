import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"{'abcdefgh'[k % 8]}{k}" if k % 7 else f"É{k}" for k in (rng.randrange(vocabulary) for _ in range(n))]


@pytest.fixture
def make(spark):
    """Documents from texts (or (id, text) or full rows)."""

    def build(rows, extra=None):
        full = []
        for i, r in enumerate(rows):
            if not isinstance(r, tuple):
                r = (i, r)
            r = (*r, "en", f"s{i % 3}")[:4] if len(r) < 4 else r
            full.append((*r[:4], len(r[1] or "")))
        df = spark.createDataFrame(full, SCHEMA)
        for name in extra or ():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(name))
        return df

    return build


#: Nulls, empty and blank texts, one word, ties, repeats, a long text, text outside ASCII.
@pytest.fixture(scope="session")
def odd_texts():
    rng = random.Random(5)
    long = " ".join(words(rng, 60_000))
    return [None, "", " \t\n ", "one", "one", "É É É", "12 34", "a b\na b\na b", long, "\n\n", "x" * 5000]


#: Names that an operator uses inside.
CLASHING = ["id", "row", "bucket", "part", "key", "n", "h", "size", "score", "lang_pred", "kept", "component", "target", "rest", "positive", "n_words", "spans", "_x"]


@pytest.fixture
def clashing():
    return CLASHING
