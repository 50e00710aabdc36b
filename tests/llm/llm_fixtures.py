import random

import pytest
from pyspark.sql import Row

WORDS = [a + b for a in ("al", "be", "co", "di", "en", "fo", "gu", "hi") for b in ("ra", "ne", "mi", "to", "su", "lak", "ner", "von")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(90)) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and blank texts, ties, repeated rows, a
    very long text, odd characters."""
    base, shared = prose(1, 120), prose(2, 60)
    near = base.replace(base.split()[50], "changedword")
    rows = [
        (1, base, "en", "a"), (2, near, "en", "b"), (3, None, "en", "a"), (4, "", "de", "b"), (5, " \t\n\x0b\x0c\r ", None, "a"),
        (6, base, "en", None), (6, base, "en", None), (7, "Ein Wort", "de", "c"), (None, prose(3, 40), "en", "a"), (None, None, None, None),
        (None, prose(3, 40), "en", "b"), (8, prose(4, 30) + " " + shared + " " + prose(5, 30), "fr", "c"), (9, prose(6, 10) + "\n" + shared, "fr", "a"),
        (10, prose(7, 6000), "en", "a"), (11, "la " * 3000, "en", "c"), (12, "ÉKÄ \U0001f600 l'été x y İ ſ $$$ ### <b>|x|&", "fr", "é"),
        (13, "Licensed under CC\nBY-NC 4.0. All rights reserved. GNU General Public License, version 3", "en", "\U0001f600"),
        (14, "line one here\nline one here\n\n  line two \nline one here", "en", "a"),
    ]
    return [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Writes tables for a query: tables(documents=df, ...) -> folder."""
    def write(**frames):
        out = tmp_path_factory.mktemp("tables")
        for name, df in frames.items():
            df.write.parquet(f"{out}/{name}.parquet")
        return str(out)
    return write
