import re

import pytest

from concord.llm import frames

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    """Words of a text, the plain way."""
    return _WORD.findall((text or "").translate(_LOWER))


@pytest.fixture(autouse=True)
def package(spark):
    frames.ship(spark)


@pytest.fixture
def docs(spark):
    """A frame of (doc_id, text[, source]) rows with further columns whose names operators use inside."""

    def make(rows):
        rows = [(*r, "src")[:3] for r in rows]
        schema = "doc_id long, text string, source string, digest string, node int, words string, key string, low int, kinds string, label int, hits int"
        return spark.createDataFrame([(*r, "x", 1, "y", "z", 2, "k", 0, 3) for r in rows], schema)

    return make
