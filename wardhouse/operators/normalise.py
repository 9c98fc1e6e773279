"""Units and flags brought to one form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.contracts import NORM_FAILURE, WRONG_TYPE, Rule, Table
from wardhouse.functions.casts import blank_to_null, safe_cast


def celsius(temperature: Column, unit: Column) -> Column:
    """Temperature in degrees Celsius; NULL for a unit that is neither C nor F."""
    return F.when(unit == "C", temperature.cast("double")).when(
        unit == "F", (temperature.cast("double") - 32) * 5 / 9
    )


def flag(value: Column) -> Column:
    """True is 1, False is 0."""
    return value.cast("int")


def unit_rule(temperature: str, unit: str) -> Rule:
    return Rule(
        NORM_FAILURE,
        f"{temperature} IS NOT NULL AND ({unit} IS NULL OR {unit} NOT IN ('C', 'F'))",
        f"{unit} is neither C nor F",
    )


def normalise_consultation(rows: DataFrame) -> DataFrame:
    """Consultations with a Celsius temperature and 0/1 flags."""
    return rows.withColumns(
        {
            "patn_temp_c": celsius(F.col("patient_temperature"), F.col("temperature_unit")),
            "dibt_ind": flag(F.col("diabetes_indicator")),
            "hosp_ind": flag(F.col("hospitalisation_indicator")),
        }
    )


def wrong_types(raw: DataFrame, table: Table, names: Sequence[str] | None = None) -> DataFrame:
    """Raw rows with ``rej_cod`` WRONG_TYPE where filled text does not fit its type."""
    checked = [c for c in table.columns if c.kind != "varchar" and (not names or c.source in names)]
    code = F.lit(None).cast("string")
    note = code
    for c in reversed(checked):
        text = blank_to_null(F.col(c.source))
        bad = text.isNotNull() & safe_cast(F.col(c.source), c.kind).isNull()
        code = F.when(bad, F.lit(WRONG_TYPE)).otherwise(code)
        note = F.when(bad, F.lit(f"{c.source} is not of type {c.kind}")).otherwise(note)
    return raw.withColumns({"rej_cod": code, "rej_dsc": note})
