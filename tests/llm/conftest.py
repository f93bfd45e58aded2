from __future__ import annotations

import pytest

TEXTS = "doc_id bigint, text string, lang string, n bigint, id bigint, row string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use inside."""
    passage = " ".join(f"word{k}" for k in range(40))
    rows = [
        (1, None, None, 1, 7, "r"), (2, "", "en", None, None, None), (3, " \n\t ", "en", 1, 1, "x"), (4, "tiny", "en", 1, 1, "x"),
        (5, passage, "en", 1, 1, "x"), (5, passage, "en", 1, 1, "x"), (6, passage.upper(), "de", 1, 1, "x"), (None, passage, "en", 1, 1, "x"),
        (7, passage + " tail", "en", 1, 1, "x"), (8, "x" * 200_000, "en", 1, 1, "x"), (9, "Größe été 日本 <|endoftext|>   ok", "fr", 1, 1, "x"),
        (10, " ".join(f"long{k % 977}" for k in range(60_000)), "en", 1, 1, "x"), (None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, TEXTS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], TEXTS)
