"""Seeded draws and orders taken from md5, equal in every engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _text(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def order_hash(key: Column, seed: int) -> Column:
    """Hex digest that shuffles ``key``; ties in the digest are left to the key itself."""
    return F.md5(_text(key, seed))


def draw_int(*parts) -> Column:
    """A whole number in [0, 2^32) fixed by ``parts``."""
    return F.conv(F.substring(F.md5(_text(*parts)), 1, 8), 16, 10).cast("bigint")


def draw_unit(*parts) -> Column:
    """A number in [0, 1) fixed by ``parts``."""
    return draw_int(*parts) / F.lit(4294967296.0)
