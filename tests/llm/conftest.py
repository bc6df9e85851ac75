from __future__ import annotations

import pytest


@pytest.fixture
def frame(spark):
    """Builds a DataFrame of a few rows."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


# Texts that an operator must take: missing, empty, blank, short, long, and beyond the basic plane.
ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "  two  spaces \n\n and\r\nlines \x0b\x0c end ",
    "Café ÉCOLE 😀 naïve space wide",
    "don't <|endoftext|> 12,345.67 x%%% -- </s>[INST] \\ ok",
    "word " * 3000 + "tail",
    "x" * 5000,
]
