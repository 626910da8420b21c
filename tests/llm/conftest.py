from __future__ import annotations

import pytest

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, blank and very long texts, repeats, clashing names."""
    prose = "The quick brown fox jumps over the lazy dog and then sleeps in the warm sun "
    rows = [
        (1, None, "en", "a", 0),
        (2, "", None, None, 0),
        (3, " \t\n ", "en", "a", 4),
        (4, prose * 3000, "en", "a", None),
        (5, "one", "en", None, 3),
        (6, prose, "en", "b", 70),
        (6, prose, "en", "b", 70),
        (7, prose, "en", "b", 70),
        (None, prose + "again", "en", "b", 75),
        (8, "Ünïcödé 日本 \U0001f600 é <|endoftext|> x y  z", "de", "c", 30),
    ]
    table = spark.createDataFrame(rows, DOCUMENTS)
    # Names that operators use for columns of their own.
    return table.selectExpr(
        "*", "1 as kept", "'x' as node", "2 as component_id", "'y' as row", "3 as shard", "'z' as score", "4 as _source"
    )


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
