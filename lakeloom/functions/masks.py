"""Masks of personal and commercial columns. `clear`: whether the reader may see the value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _unless(clear: bool, value: Column, masked: Column) -> Column:
    return value if clear else F.when(value.isNotNull(), masked)


def mask_email(value: Column, clear: bool = False) -> Column:
    """12 hexadecimal digits of the hash and the domain; *** if it isn't an address."""
    hashed = F.concat(F.substring(F.sha2(value, 256), 1, 12), F.lit("@"), F.split_part(value, F.lit("@"), F.lit(2)))
    return _unless(clear, value, F.when(value.contains("@"), hashed).otherwise("***"))


def mask_name(value: Column, clear: bool = False) -> Column:
    """Initials."""
    return _unless(clear, value, F.concat_ws(" ", F.transform(F.split(value, " "), lambda p: F.concat(F.substring(p, 1, 1), F.lit(".")))))


def mask_postal(value: Column, clear: bool = False) -> Column:
    """Three characters and two stars."""
    return _unless(clear, value, F.concat(F.substring(value, 1, 3), F.lit("**")))


def mask_cost(value: Column, clear: bool = False) -> Column:
    """NULL, unless the reader may see costs."""
    return value if clear else F.when(F.lit(False), value)
