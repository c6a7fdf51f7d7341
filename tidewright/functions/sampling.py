"""Seeded choices that every engine can repeat: the first eight hexadecimal digits of an md5 as a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(key: Column) -> Column:
    """A number from 0 to 2^32 - 1."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def choice(key: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (draw(key) % len(values) + 1).cast("int"))


def uniform(key: Column, low: Column | float, high: Column | float) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return low + (high - low) * draw(key) / F.lit(4294967296.0)
