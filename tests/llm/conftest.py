from __future__ import annotations

import pytest

#: Names that the operators use inside; as extra columns of an input they must not matter.
CLASHING = ("size", "key", "copy", "row", "node", "line", "n", "score", "tokens", "place", "at", "part", "bin", "label", "title")


@pytest.fixture
def frame(spark):
    """A table from rows, with extra columns whose names clash with the operators' own."""

    def make(schema: str, rows: list[tuple]):
        extra = ", ".join(f"{c} string" for c in CLASHING if f"{c} " not in schema)
        n = extra.count("string")
        return spark.createDataFrame([(*r, *["x"] * n) for r in rows], f"{schema}, {extra}")

    return make


@pytest.fixture
def documents(frame):
    return lambda rows: frame("doc_id long, text string, lang string, source string, n_chars long", [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows])
