"""Rows of bounded number to fit a model on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPARE = 8  # times the wanted rows that may reach the last sort


def bounded(rows: DataFrame, n: int, keep=None) -> list:
    """At most ``n`` different rows, the first in an order by hash, of those that ``keep`` (a condition) holds for.

    The hash also thins the rows before they are sorted, by the number of
    different ones that are kept, so that what tasks send to the driver doesn't
    grow with their number.
    """
    h = F.shiftrightunsigned(F.xxhash64(*rows.columns), 11)
    some = rows if keep is None else rows.filter(keep)
    total = some.agg(F.approx_count_distinct(h)).first()[0]
    some = some if total <= SPARE * n else some.filter(h < int((1 << 53) * (SPARE * n / total)))
    return some.distinct().orderBy(h, *rows.columns).limit(n).collect()
