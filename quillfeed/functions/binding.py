"""Naming a value inside an expression, so that large expressions hold it once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is evaluated once, whatever number of times it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def named(df: DataFrame, *values: Column) -> tuple[DataFrame, list[Column]]:
    """The frame with each value as a column of a name of its own, and these columns."""
    at = sum(c.startswith("__named") for c in df.columns)
    names = [f"__named{at + i}" for i in range(len(values))]
    return df.select("*", *(v.alias(n) for n, v in zip(names, values, strict=True))), [F.col(n) for n in names]
