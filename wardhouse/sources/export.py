"""Indicator views as delimited text, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wardhouse.contracts import SEPARATOR

# Fixed value: byte-order mark at the start of the header.
BOM = "\ufeff"


def export_view(view: DataFrame, folder: str, name: str) -> int:
    """Write one view to ``folder/name.csv/`` and return its row count.

    The folder holds one file per task, each with the upper-case header behind
    a byte-order mark; an empty view leaves a file with the header alone.
    """
    seen = Observation()
    titles = [c.upper() for c in view.columns]
    titles[0] = BOM + titles[0]
    (
        view.observe(seen, F.count("*").alias("n"))
        .toDF(*titles)
        .write.mode("overwrite")
        .options(sep=SEPARATOR, header="true", escape='"', emptyValue="", encoding="UTF-8")
        .csv(f"{folder.rstrip('/')}/{name.lower()}.csv")
    )
    return seen.get["n"]


def run_export(views: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write all views; row count per view."""
    return {name: export_view(view, folder, name) for name, view in views.items()}
