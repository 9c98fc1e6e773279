"""One row per key, and the rows that lose."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.operators.joins import hot_keys

_ORDER = re.compile(r"^(\w+)(?:\s+(ASC|DESC))?(?:\s+NULLS\s+(FIRST|LAST))?$", re.IGNORECASE)


def ordering(terms: Sequence[str]) -> list[Column]:
    """Sort columns from terms such as ``updated_at DESC NULLS LAST``.

    Where NULLs go is always explicit: last unless the term says otherwise.
    """
    out = []
    for term in terms:
        match = _ORDER.match(term.strip())
        if match is None:
            raise ValueError(f"not a sort term: {term!r}")
        name, way, nulls = match[1], (match[2] or "ASC").lower(), (match[3] or "LAST").lower()
        out.append(getattr(F.col(name), f"{way}_nulls_{nulls}")())
    return out


def total_order(df: DataFrame, terms: Sequence[str], keys: Sequence[str] = ()) -> list[Column]:
    """The given order, made total by the columns it leaves out.

    Rows that still tie are copies of each other, so the result is the same
    whichever of them comes first.
    """
    used = {t.split()[0] for t in terms} | set(keys)
    rest = [c for c in df.columns if c not in used]
    return ordering([*terms, *rest])


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Keep the first row of each key in the given order.

    The filter on ``row_number() = 1`` lets Spark cut each key down to one row
    per map task before the shuffle, so a key holding a large share of the rows
    sends only a handful of them.
    """
    order = Window.partitionBy(*keys).orderBy(*total_order(df, latest_by, keys))
    return df.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    among: Column,
    kept: str,
    copy: str,
    hot: dict[int, int] | None = None,
) -> DataFrame:
    """All rows, with ``kept``, whether a row is the first of its key among those that count.

    One shuffle on the key. Rows that do not count are spread by their content
    instead. A hot key is dealt out by its rows' content too; the first of each
    share then meet in a second window, which all other rows pass by their content.
    ``copy`` numbers the rows of a key and share, so that equal rows differ by it.
    ``hot`` gives the hot keys where the caller has found them.
    """
    content = F.xxhash64(*df.columns)
    if hot is None:
        hot = hot_keys(df, keys)
    share = F.lit(0).cast("long")
    if hot:
        # Fewer keys than shuffle partitions.
        shares = F.create_map(*[F.lit(x).cast("long") for item in hot.items() for x in item])
        n = F.coalesce(F.element_at(shares, F.xxhash64(*keys)), F.lit(1).cast("long"))
        share = F.when(n > 1, F.pmod(content, n)).otherwise(share)
    order = total_order(df, latest_by, keys)
    spread = df.withColumns({"_counts": among, "_share": F.when(among, share).otherwise(content)})
    window = Window.partitionBy(*keys, "_share").orderBy(*order)
    placed = spread.withColumn(copy, F.row_number().over(window))
    first = F.col("_counts") & (F.col(copy) == 1)
    if hot:
        meeting = F.when(first, F.lit(0).cast("long")).otherwise(content)
        again = Window.partitionBy(*keys, "_meeting").orderBy(F.col("_first").desc(), *order)
        placed = placed.withColumns({"_first": first, "_meeting": meeting})
        placed = placed.withColumn("_place", F.row_number().over(again))
        first = F.col("_first") & (F.col("_place") == 1)
    return placed.select(*df.columns, first.alias(kept), copy)


def any_null(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])


def superseded(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Every row :func:`latest_per_key` drops, with ``copies``, how often it occurs.

    All rows count one, the kept row of each key counts minus one, and equal
    rows are summed. The sum groups on whole rows and starts before the shuffle,
    so neither a key with many versions nor a row with many copies lands in one
    task.
    """
    kept = latest_per_key(df, keys, latest_by)
    counted = df.withColumn("_n", F.lit(1)).unionByName(kept.withColumn("_n", F.lit(-1)))
    return (
        counted.groupBy(*df.columns).agg(F.sum("_n").alias("copies")).filter("copies > 0")
    )
