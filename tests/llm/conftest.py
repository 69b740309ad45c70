from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) pairs."""

    def make(*pairs):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words: prose(seed, n) has n words."""

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(["ba", "ke", "li", "mo", "nu", "é", "Ra"]) for _ in range(rng.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd(prose):
    """Null, empty, blank and very long texts, repeated rows and ids, a null id."""
    return [(1, None), (2, ""), (3, " \t\n "), (4, prose(4, 30_000)), (5, "x" * 50_000), (6, "Same text here"), (6, "Same text here"), (7, "Same text here"), (6, "other text"), (None, "no id here"), (8, "日本語 🙂 ÉCOLE   \x00 end")]
