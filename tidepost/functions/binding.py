"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it.

    A column made in an earlier ``withColumn`` is pasted into every predicate that Catalyst
    pushes below it, once per mention. A lambda variable is not, so a filter on a score or a
    topic costs one evaluation of the text expression instead of one per mention.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
