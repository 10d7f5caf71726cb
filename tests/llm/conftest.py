from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names the operators use inside.
    "row bigint, p int, t bigint, node string, label int, kept boolean, rank int, shard int, key bigint, "
    "length int, words int, base string, spans string, host string, class int, n int, _h int, score double"
)
EXTRA = (1, 2, 3, "x", 4, True, 5, 6, 7, 8, 9, "b", "s", "h", 1, 2, 3, 0.5)
SENTENCE = "the quick brown fox jumps over the lazy dog and runs away from seven angry bears today"


@pytest.fixture(scope="session")
def documents(spark):
    """Build documents from (doc_id, text) pairs, with extra columns of clashing names."""

    def make(pairs, lang="en", source="s"):
        rows = [(i, x, lang, source, None if x is None else len(x), *EXTRA) for i, x in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """NULLs in every column, empty and very long texts, white space only, repeated rows, ties."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    pairs = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, "a b c"), (6, SENTENCE), (7, SENTENCE),
        (7, SENTENCE), (None, SENTENCE), (None, None), (8, long), (9, "Été \U0001f600 " * 9), (10, "9" * 50_000),
        (11, "x@" * 2_000), (12, "#" * 300), (13, "same line\n" * 40),
    ]
    frame = documents(pairs)
    return frame.union(documents([(14, SENTENCE)], lang=None, source=None))


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([(1, "x")]).limit(0)
