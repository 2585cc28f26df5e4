"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often ``body`` reads it.

    Without it a helper that reads its input ten times repeats the input's whole expression
    ten times, and helpers that call helpers outgrow code generation.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
