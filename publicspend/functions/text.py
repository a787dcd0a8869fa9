"""Column expressions for locale-formatted text fields. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits with an optional point and exponent. Spark's own cast also takes "12.5d",
# "0x1p3", "inf" and "nan", none of which is an amount.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def usable_key(key: Column) -> Column:
    """True for a key that is present and not blank; the key itself is left untrimmed."""
    return key.isNotNull() & (F.trim(key) != "")


def cleaned_text(text: Column) -> Column:
    """Trimmed text, with blank turned into NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def parse_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def comma_decimal(text: Column) -> Column:
    """``1234,56`` to 1234.56. A thousands point leaves two points, hence NULL."""
    return parse_number(F.replace(text, F.lit(","), F.lit(".")))


def italian_number(text: Column) -> Column:
    """``1.234,56`` to 1234.56: points group thousands, the comma is the decimal mark."""
    return parse_number(F.translate(text, ",.", "."))


def lenient_int(text: Column) -> Column:
    """Whole number from text; ``2024.7`` rounds to 2025 and text out of range gives NULL."""
    return F.round(parse_number(text)).try_cast("int")


def clipped(text: Column, width: int) -> Column:
    """Text cut to ``width`` characters, marked with ``...`` when something was cut."""
    return F.when(
        F.char_length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))
    ).otherwise(text)
