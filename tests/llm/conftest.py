from __future__ import annotations

import pytest

from playtrail.llm.store import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, part int"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd(llm):
    """Nulls in any column, empty and very long texts, repeated rows, clashing extra columns."""
    prose = "The quick brown fox, jumps over the lazy dog and runs far away from here. "
    rows = [
        (1, None, None, None, None, None, None),
        (2, "", "en", "a", 0, 0.5, 1),
        (3, " \n\t ", "en", "a", 4, 0.5, 1),
        (4, prose * 3000, "en", "a", 0, 0.5, 1),
        (5, prose, "en", "b", 5, None, 2),
        (5, prose, "en", "b", 5, None, 2),
        (6, prose, "en", "b", 5, 0.1, 2),
        (None, prose, None, "b", 5, 0.1, 2),
        (7, "one two  three\r\nfour été \U0001f600", "fr", "c", 9, 0.1, 2),
        (8, "x" * 50_000, "en", "c", 9, 0.1, 2),
    ]
    return llm.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], SCHEMA)
