"""Test documents, and documents with odd rows, as fixtures for the tests beside."""

import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"
FIELDS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that operators use themselves.
    "tag string, word string, words string, fp string, seed string, found string, items string, "
    "spans string, ids string, block string, learn string, pos string, carry_0 string"
)
CLASHES = tuple("clash" for _ in range(13))

PASSAGE = " ".join(f"Shared{i}" for i in range(40))
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "One two"),
    (6, "Straße ÉTÉ naïve \u00a0 \u2028 \u2581 😀 ñandú"),
    (7, "long " * 30_000 + "end"),
    (8, "x" * 200_000),
    (9, f"before it {PASSAGE} after it"),
    (10, f"{PASSAGE}"),
    (11, f"other words\nthen {PASSAGE}"),
    (11, f"other words\nthen {PASSAGE}"),
    (11, f"{PASSAGE} under an id of two texts"),
    (None, f"no id {PASSAGE}"),
    (None, None),
    (12, "The quick brown fox jumps over the lazy dog. It sleeps now.\n" * 6),
    (13, "The quick brown fox jumps over the lazy dog. It sleeps now.\n" * 6),
    (14, "\\### Assistant: </turn> ok <s> </s> <unk> <|endoftext|>"),
]


def edge_rows():
    return [(i, t, "en", "src", 0, *CLASHES) for i, t in TEXTS]


@pytest.fixture(scope="session")
def edges(spark):
    """Documents with NULLs, empty and long texts, ties, repeated rows and clashing columns."""
    return spark.createDataFrame(edge_rows(), FIELDS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], FIELDS)


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of all test documents."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()


@pytest.fixture(scope="session")
def engine():
    connection = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def union_find(n, linked):
    """Least index reachable from each of ``n`` things; ``linked`` holds pairs."""
    parent = list(range(n))

    def root(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(v) for v in range(n)]
