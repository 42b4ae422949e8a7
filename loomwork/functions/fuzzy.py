"""Edit distance with swaps of neighbours (optimal string alignment), in batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from loomwork.session import ship


def osa(a: str, b: str, limit: int) -> int:
    """Distance of two texts by insertions, deletions, changes and swaps of neighbours, no stretch edited twice; limit + 1 if
    it is over the limit."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    older: list[int] = []
    old = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > limit and min(old) > limit:
            return limit + 1
        older, old = old, row
    return min(old[-1], limit + 1)


def allowed(key: Column) -> Column:
    """Edits that a name of this length may differ by."""
    return F.greatest(F.lit(1), F.floor(F.char_length(key) / 5)).cast("int")


def osa_distance(a: Column, b: Column, limit: Column) -> Column:
    """Column of distances; null if either text is."""
    ship(SparkSession.active())

    @F.pandas_udf("int")
    def run(x: pd.Series, y: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else osa(p, q, int(m)) for p, q, m in zip(x, y, most, strict=True)], dtype="Int32")

    return run(a, b, limit)
