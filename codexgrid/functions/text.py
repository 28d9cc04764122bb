"""Scalar text functions as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Regular-expression class of the characters that Python's str.split() splits on.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"


def squash(c: Column) -> Column:
    """Each run of white space made one blank, ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def strip(c: Column) -> Column:
    """White space of any kind removed at both ends."""
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")
