"""Text ids as short keys, for the shuffles between joins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARKS = "-._:"
_LETTERS = "abcdefABCDEF"


def packed(col: Column | str) -> Column:
    """A text as bytes that equal those of another text exactly where the texts are equal; NULL stays NULL.

    Digits and four marks take half a byte each. A text with any other character keeps its bytes, behind one that no packed text
    begins with.
    """
    text = F.col(col) if isinstance(col, str) else col
    # d stands for no character, so that the head tells whether the number of halves was even
    halves = F.translate(text, _MARKS + _LETTERS, "abef" + "z" * len(_LETTERS))
    short = F.unhex(F.concat(F.when(F.length(text) % 2 == 0, "cd").otherwise("c"), halves))
    return F.coalesce(short, F.concat(F.unhex(F.lit("00")), text.cast("binary")))


def with_packed(*cols: str) -> dict[str, Column]:
    """For ``withColumns``: these columns, packed."""
    return {c: packed(c) for c in cols}
