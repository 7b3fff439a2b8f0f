"""Number expressions; text that is no number becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_decimal(text: Column, scale: int = 2, precision: int = 18) -> Column:
    """Fixed-point value of a text with a decimal point, rounded half up."""
    return text.try_cast(f"decimal({precision},{scale})")


def decimal_comma(text: Column, scale: int = 2, precision: int = 18) -> Column:
    """As :func:`to_decimal`, for a text with a decimal comma."""
    return to_decimal(F.replace(text, F.lit(","), F.lit(".")), scale, precision)
