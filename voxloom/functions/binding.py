"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once. Inside the functions of arrays an outer expression would be computed
    anew for every element."""
    return F.transform(F.array(value), body)[0]
