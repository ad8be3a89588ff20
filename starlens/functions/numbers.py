"""Small numeric and ordering expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlens.constants import SEED


def sampling_key(row_id: Column, seed: int = SEED) -> Column:
    """Hash that orders rows like a shuffle, the same on every run and engine."""
    return F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient as a double, 0 where the divisor is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / F.nullif(bottom, F.lit(0)).cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * part / whole, digits)
