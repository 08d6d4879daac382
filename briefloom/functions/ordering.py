"""Seeded order keys: the same rows get the same order on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")))


def hex_prefix(key: Column, digits: int) -> Column:
    """Leading hex digits as a number: an equal-width bucket of the key space."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


def unit_interval(key: Column) -> Column:
    """The key's first 32 bits as a number in [0, 1)."""
    return hex_prefix(key, 8) / F.lit(float(2**32))
