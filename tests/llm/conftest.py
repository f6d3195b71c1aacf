import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from brute import prose  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties and repeated rows, and columns whose names operators use inside."""
    rows = [
        (1, "One two three four five six seven."),
        (2, None),
        (3, ""),
        (4, " \t\n\x0b "),
        (5, "Same text here for two documents, that is."),
        (6, "Same text here for two documents, that is."),
        (7, "a" * 50_000 + " " + "word " * 3_000),
        (8, "Ünïcödé 漢字 🙂🙂 naïve café — “quotes”"),
        (8, "Ünïcödé 漢字 🙂🙂 naïve café — “quotes”"),
        (9, prose(9, 400)),
        (9, "another text under the same id"),
        (None, "no id at all, but a text of some words"),
        (None, None),
        (10, "\\ <|turn|> [INST] </s> \x00 \x1c | pipes !!"),
    ]
    names = ("id", "h", "row", "lines", "n", "sig", "key", "group", "items", "runs", "media", "ids", "lang")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", *[f"'x' AS `{c}`" for c in names], "length(text) AS n_chars")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
