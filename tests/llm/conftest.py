from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """Rows of doc_id and text as a table with all columns of ``documents``, over several partitions."""

    def make(rows):
        full = [(key, text, "en", "src0", None if text is None else len(text)) for key, text in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    """Invented words, different for each seed."""
    draw = random.Random(seed)
    return ["".join(draw.choice("bdfgklmnprst") + draw.choice("aeiou") for _ in range(3)) for _ in range(n)]


#: Rows every operator has to take: null keys and texts, blanks, repeated rows, a very long text.
ODD = [
    (None, "a row without a key " + " ".join(prose(1, 60))),
    (3, None),
    (4, ""),
    (5, " \t\n\v\f\r "),
    (6, "one"),
    (7, " ".join(prose(2, 80))),
    (7, " ".join(prose(2, 80))),
    (8, " ".join(prose(2, 80))),
    (9, "été ß 日本語 \U0001f600 " * 30),
    (10, " ".join(prose(3, 30_000))),
    (-5, "a line that is long enough to count\n" * 3),
    (11, "A line that is long enough to count \nother"),
    (12, "a line that is long enough to count"),
    (12, "the same key with another text"),
]
