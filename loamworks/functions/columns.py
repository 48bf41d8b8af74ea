"""Helpers on columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often and wherever it is used.

    The optimiser may put a column's expression in place of its name, inside
    lambdas too, where it would be computed for each element; a lambda's own
    variable stays.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
