from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

PASSAGE = " ".join(f"passage{i}" for i in range(60))
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
BASE = " ".join(f"base{i}" for i in range(120))
ROWS = [
    (1, BASE), (2, BASE.replace("base60", "other")), (3, BASE.upper()), (4, BASE.replace("base10", "x").replace("base90", "y")),
    (5, None), (6, ""), (7, " \t\n\x0b\x0c\r "), (8, "one"), (9, "One"), (10, "two words"), (11, LONG), (12, LONG + " tail"),
    (13, "start " + PASSAGE + " end"), (14, "other start\n" + PASSAGE + "\tother end"), (14, "other start\n" + PASSAGE + "\tother end"),
    (15, PASSAGE + " " + PASSAGE), (16, "a " * 200), (17, "a " * 260), (18, "É ÀB 中文 Σς 😀 <|endoftext|> it's\x1cx\x85y"), (18, "same id, other text"),
    (-19, "Released under the MIT License.\nbody of the text"), (20, "x" * 3000), (None, "no id " + PASSAGE),
]


@pytest.fixture(scope="session")
def odd_rows():
    return ROWS


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank, very long and repeated rows, with columns whose names operators use inside."""
    extra = ("tkey", "cls", "token", "g", "row", "label", "copies", "__bucket", "rows", "kept_text")
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    sources = ("src0", "src0", None, "src1")
    rows = [(d, t, "en", sources[i % 4], len(t) if t else None, *["?"] * len(extra)) for i, (d, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark, directory):
    return spark.read.parquet(f"{directory}/documents.parquet")
