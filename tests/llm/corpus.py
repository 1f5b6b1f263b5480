"""Small corpora for the tests of the corpus operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def docs(spark, texts, source="a"):
    """Documents numbered from 0; a pair gives (doc_id, text)."""
    rows = []
    for i, t in enumerate(texts):
        doc_id, text = t if isinstance(t, tuple) else (i, t)
        rows.append((doc_id, text, "en", source if isinstance(source, str) else source(i), len(text or ""), 7))
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    """Null and empty texts, a null id and source, a repeated row, a very long text."""
    rows = [
        (0, None, None, None, None, None),
        (1, "", "en", "a", 0, 1),
        (None, "no id but some words here", "en", "a", 0, 1),
        (2, "same row twice with a few words", "en", "a", 0, 1),
        (2, "same row twice with a few words", "en", "a", 0, 1),
        (3, " ".join(words(30_000, 1)), "en", "b", 0, 1),
        (4, "İstanbul K \u0000 \U0001f600 naïve\r\nline", "tr", "b", 0, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
