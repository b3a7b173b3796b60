import pytest
from pyspark.sql import Row

#: Columns that operators use themselves, to see that they don't clash.
EXTRA = {"n_tokens": "x", "fingerprint": 1.5, "h": None, "k1": 7, "label": "z", "score": True}


def docs_frame(spark, rows):
    """documents with odd extra columns from (doc_id, text[, source]) rows."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, n_tokens string,"
              " fingerprint double, h int, k1 int, label string, score boolean")
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0 if r[1] is None else len(r[1]), *EXTRA.values()) for r in rows]
    return spark.createDataFrame(full, schema)


LONG = " ".join(f"w{k * k % 977}" for k in range(30_000))
PASSAGE = " ".join(f"p{k}" for k in range(70))
EDGE = [
    (1, "Hello World, it's 12 o'clock"), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, LONG + " end"),
    (7, "a b c d e f g h " * 9), (8, f"start here {PASSAGE} then stops"), (9, f"other words {PASSAGE}"),
    (9, f"again {PASSAGE} for the same id"), (10, "Hello World, it's 12 o'clock"), (10, "Hello World, it's 12 o'clock"),
    (None, f"nobody {PASSAGE}"), (None, None), (11, "x" * 5000), (12, "é 中文 Ünï　  <|endoftext|> ▁ \x1c"),
    (13, "Same line here again ok\n" * 30), (14, PASSAGE), (15, PASSAGE),
]


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda rows: docs_frame(spark, rows)


@pytest.fixture(scope="session")
def edge(spark):
    return docs_frame(spark, EDGE)


@pytest.fixture(scope="session")
def nothing(spark):
    return docs_frame(spark, [])


def rows_of(df, *columns) -> list[Row]:
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
