"""Safe casts: text that does not parse becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts read as booleans, any case.
TRUE_TEXTS = ("true", "t", "yes", "y", "on", "1")
FALSE_TEXTS = ("false", "f", "no", "n", "off", "0")

_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
_TIMESTAMP = r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ]\s*\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?\s*(Z|[+-]\d{1,2}(:?\d{2})?)?)?\s*$"


def blank_to_null(text: Column) -> Column:
    """Empty text is a missing value; blanks are kept as they are."""
    return F.nullif(text, F.lit(""))


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    exact = text.try_cast("decimal(38,10)")
    return F.round(exact, scale).try_cast(f"decimal({precision},{scale})")


def to_whole(text: Column, kind: str = "bigint") -> Column:
    """Whole number, rounding half away from zero: '12.7' is 13, '-12.5' is -13."""
    return F.round(text.try_cast("decimal(38,10)"), 0).try_cast(kind)


def to_date(text: Column) -> Column:
    return F.when(text.rlike(_DATE), text.try_cast("date"))


def to_timestamp(text: Column) -> Column:
    """Wall-clock timestamp; a date alone is midnight, a zone suffix is ignored."""
    return F.when(text.rlike(_TIMESTAMP), text.try_cast("timestamp_ntz"))


def to_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_TEXTS), F.lit(True)).when(
        word.isin(*FALSE_TEXTS), F.lit(False)
    )


def safe_cast(text: Column, kind: str) -> Column:
    """Cast a text column to one logical type of the contract."""
    value = blank_to_null(text)
    if kind == "varchar":
        return value
    if kind == "integer":
        return to_whole(value, "bigint")
    if kind == "smallint":
        return to_whole(value, "int")
    if kind == "date":
        return to_date(value)
    if kind == "timestamp":
        return to_timestamp(value)
    if kind == "boolean":
        return to_boolean(value)
    if kind.startswith("decimal("):
        precision, scale = (int(n) for n in kind[len("decimal("):-1].split(","))
        return to_decimal(value, precision, scale)
    raise ValueError(f"unknown logical type {kind!r}")
