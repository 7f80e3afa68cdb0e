"""Awkward tables that every operator and stage has to take."""

from __future__ import annotations

import pytest

LONG = "word another-word thing, " * 12_000
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHING = {
    "size": 1, "node": 2, "gid": 3, "component": 4, "score": 5, "bin_id": 6, "digest": 7, "target": 8, "taken": 9,
    "cluster": 10, "piece": 11, "u": 12, "v": 13, "quality": 14, "signature": 15, "rank": 16, "leaf": 17, "count": 18,
    "redacted": 19, "start": 20, "draw": 21, "__words": 22,
}


def awkward_rows() -> list[tuple]:
    return [
        (1, "The quick brown fox jumps over the lazy dog by the river", "en", "a", 56),
        (2, "The quick brown fox jumps over the lazy dog by the river", "en", "a", 56),
        (2, "The quick brown fox jumps over the lazy dog by the river", "en", "a", 56),
        (3, None, "en", "b", None),
        (4, "", None, None, 0),
        (5, " \t\n", "de", "b", 3),
        (6, LONG, "en", None, len(LONG)),
        (None, "Text without an id, mail me at x.y@example.com", None, "c", None),
        (None, None, None, None, None),
        (7, "12345 !!! ---", "fr", "c", 13),
        (8, "été \U0001f600 naïve", "fr", "\U0001f600", 12),
    ]


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCUMENTS)


@pytest.fixture
def clashing(awkward):
    from pyspark.sql import functions as F

    return awkward.withColumns({k: F.lit(v) for k, v in CLASHING.items()})


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, None), (2, None, 1), (99, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
