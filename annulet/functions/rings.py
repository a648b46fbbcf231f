"""Circular strings: least rotation and the form both strands of a ring share."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from annulet.functions.scalars import reverse_complement


def least_rotation(s: str | bytes) -> int:
    """Where the least rotation of s starts, in linear time: two candidates race, the loser skips what was compared."""
    n, i, j, k = len(s), 0, 1, 0
    while i < n and j < n and k < n:
        a, b = s[(i + k) % n], s[(j + k) % n]
        if a == b:
            k += 1
            continue
        if a > b:
            i += k + 1
        else:
            j += k + 1
        if i == j:
            j += 1
        k = 0
    return min(i, j)


def _turned(s: str | None) -> str | None:
    if not s:
        return s
    at = least_rotation(s)
    return s[at:] + s[:at]


@F.pandas_udf(StringType())
def rotated(seq: pd.Series) -> pd.Series:
    """The least rotation of each string; null and empty stay."""
    return seq.map(_turned, na_action="ignore").astype(object).where(seq.notna(), None)


def canonical(seq: Column) -> Column:
    """The lesser of the least rotations of both strands, trimmed and in upper case."""
    s = F.upper(F.trim(seq))
    return F.least(rotated(s), rotated(reverse_complement(s)))
