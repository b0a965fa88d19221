"""Documents of the smallest tables, and awkward ones, as plain rows and as DataFrames."""

import random

import pytest
from conftest_llm import SF

# Columns that clash with names the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, block int, kept string, "
    "n_words string, _key int, _removed int, ledger int, cluster int, a int, c0 int"
)


def _row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), "k", 1, "x", "y", 2, 3, 4, 5, 6, 7)


def awkward_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    words = ["Aé", "b", "the", "of", "x1", "you", "idiot", "ß", "日本", "no!", "don't"]
    prose = lambda n, seed: " ".join(random.Random(seed).choice(words) + str(random.Random(seed + i).randrange(40)) for i in range(n))
    shared = prose(60, 1)
    rows = [
        _row(1, None), _row(2, ""), _row(3, " \t\n "), _row(4, "one"), _row(5, "One"), _row(None, "null id text here"),
        _row(None, None), _row(None, "null id text here"), _row(6, "a " * 400), _row(7, "a " * 400), _row(8, prose(30_000, 9)),
        _row(9, shared), _row(10, shared), _row(10, shared), _row(11, f"{prose(50, 2)}\n{shared}\nend"),
        _row(12, f"start {shared}"), _row(13, "x\ny\nx\ny\nx\ny"), _row(14, "x\ny\n\n  \nz"), _row(15, "\n\n"),
        _row(16, "two words"), _row(17, "TWO words"), _row(18, prose(8, 3)), _row(19, "no-break space  em\x1cfs\x85nel"),
        _row(20, "a\x00b\x7fc ÀÉ <|endoftext|> it's"), _row(-21, shared.upper()), _row(22, None, None, None),
    ]
    for i in range(100, 130):
        text = prose(40, i % 7).split()
        text[rng.randrange(40)] = "changed"
        rows.append(_row(i, " ".join(text)))
    return rows


@pytest.fixture(scope="session")
def documents(spark):
    """Plain (doc_id, text) rows of the smallest table."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = awkward_rows()
    return spark.createDataFrame(rows, SCHEMA).repartition(5), [r[:2] for r in rows]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def cases(spark, documents, awkward):
    """(DataFrame, plain rows) of each input that a brute-force version is run on."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    return {"table": (table, documents), "awkward": awkward}
