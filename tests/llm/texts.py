"""Texts and rows that operators must stand."""

from __future__ import annotations

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
# Column names that operators use inside.
CLASHING = ["blob", "row", "found", "old", "place", "shard", "ends", "news", "class", "n", "key", "hit", "part"]

LONG = " ".join(f"word{i % 977} über{i % 31}," for i in range(20_000))
ODD = [
    None,
    "",
    " ",
    "\n\n \t",
    "one",
    "two words",
    "a  b\n\n c\td e  f",
    "naïve café — ‘quoted’ 你好 👩‍👩‍👧 мир <|endoftext|> </s>",
    "x" * 5000,
    LONG,
    "the same text of more than five words is here twice",
    "the same text of more than five words is here twice",
]


def odd_rows() -> list[tuple]:
    """Every odd text, two rows that are the same in all columns, and a NULL id."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None) for i, t in enumerate(ODD)]
    return [*rows, rows[-1], (None, "a text without an id", None, None, None)]


def with_clashes(df):
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df
