"""Loaded tables under their staging names and types. No filter, no join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse.contracts import Table


def stage(loaded: DataFrame, table: Table, keep: Sequence[str] = ()) -> DataFrame:
    """The table's staged columns, and those of ``keep`` as they are."""
    columns = [F.col(name) for name in keep]
    for c in table.columns:
        value = F.col(c.target)
        columns.append((value.cast(c.staged_type) if c.staged_type else value).alias(c.staged))
    return loaded.select(*columns)
