"""Awkward rows that every operator must take."""

import json
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, kept string, quality string, row string"

PROSE = (
    "The committee met on a cold morning and went through every item of its long list, from the roof of the old "
    "school to the price of bread, before anyone dared to ask about lunch. Nobody had brought any."
)
TEXTS = [
    None, "", " \n\t ", "one", "two words", PROSE, PROSE, PROSE + " Not even tea.", "na " * 3000,
    "\n".join(["the same line again"] * 40), "€ß漢字   emoji 😀 \x1c\x85 mix  of   spaces\r\n\r\nend ",
    "I'll say it's 'fine' — they've 123 4567 apples!!! ...", "x" * 20_000, PROSE.upper(),
]


def awkward(spark):
    """Nulls in all columns, repeated rows, columns with the names that operators add."""
    rows = [
        (i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 3}", None, i, "kept", "q", "row")
        for i, t in enumerate(TEXTS)
    ]
    rows += [rows[5], rows[5], (None, PROSE, "de", None, 3, None, None, None, None), (None, None) + (None,) * 7]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same_rows(left, right):
    key = lambda rows: sorted(json.dumps([str(v) for v in r]) for r in rows)
    return key(left) == key(right)
