import random

import pytest

# Columns whose names clash with columns the operators make.
CLASH = ["size", "taken", "score", "key", "shard", "ids", "fp", "component_id", "predicted", "w", "x", "tie", "_doc"]


def make_docs(spark, rows):
    """documents-like table from (doc_id, text, source), with clashing extra columns."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"`{c}` string" for c in CLASH)
    data = [(i, t, "en", s, None if t is None else len(t), *["extra"] * len(CLASH)) for i, t, s in rows]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: make_docs(spark, rows)


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty, blank, very long, repeated, tied and non-ASCII rows; one source holds most rows."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gämma", "δέλτα", "x.", "the", "of", "and,"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))
    rows = [(i, text(rng.randrange(1, 60)), "hot" if i % 3 else f"s{i % 5}") for i in range(60)]
    rows += [(100, None, "hot"), (101, "", "s1"), (102, " \t\n ", None), (None, "null id here", "s2"), (103, "a", None),
             (104, text(30_000), "hot"), (105, "same text twice", "s3"), (105, "same text twice", "s3"),
             (106, "same text twice", "s3"), (105, "other text, same id", "s3"), (107, "▁ \x00 😀\r\n中文 two  spaces ", "s4")]
    return rows
