"""Mergeable figures of a table, taken in one pass, to compare it with another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprint(
    df: DataFrame,
    by: Sequence[str] = (),
    sums: Sequence[str] = (),
    bounds: Sequence[str] = (),
    rows: Sequence[str] = (),
) -> DataFrame:
    """One row, or one per group: ``n_rows``, ``sum_<c>``, ``min_<c>``, ``max_<c>``, ``row_hash``.

    ``row_hash`` is the sum of the hashes of the ``rows`` columns, the same for the
    same rows in any order and however they are spread. NULLs are left out of sums
    and bounds, and count in the hash by their place.
    """
    figures = [F.count("*").alias("n_rows")]
    figures += [F.sum(c).alias(f"sum_{c}") for c in sums]
    figures += [F.min(c).alias(f"min_{c}") for c in bounds]
    figures += [F.max(c).alias(f"max_{c}") for c in bounds]
    if rows:
        figures.append(F.sum(F.xxhash64(*rows).cast("decimal(38,0)")).alias("row_hash"))
    return df.groupBy(*by).agg(*figures)


def merged(prints: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The fingerprint of all rows from those of their parts, as of the days of a table."""
    ways = {"n": F.sum, "row": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    figures = [c for c in prints.columns if c not in by and c.split("_")[0] in ways]
    return prints.groupBy(*by).agg(*[ways[c.split("_")[0]](c).alias(c) for c in figures])


def differences(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., figure, left_value, right_value) of every figure that differs.

    The fingerprints have the same columns. A group that one of them does not have
    differs in all of its figures there.
    """
    figures = [c for c in left.columns if c not in by]
    sides = [
        df.select(*[F.col(c).alias(f"_{c}") for c in by], F.struct(*figures).alias(side))
        for df, side in ((left, "_left"), (right, "_right"))
    ]
    same = [sides[0][f"_{c}"].eqNullSafe(sides[1][f"_{c}"]) for c in by]
    joined = sides[0].join(sides[1], reduce(lambda a, b: a & b, same) if same else F.lit(True), "full")
    keys = [F.coalesce(sides[0][f"_{c}"], sides[1][f"_{c}"]).alias(c) for c in by]
    each = F.array(
        *[
            F.struct(
                F.lit(f).alias("figure"),
                F.col("_left")[f].cast("string").alias("left_value"),
                F.col("_right")[f].cast("string").alias("right_value"),
                F.col("_left")[f].eqNullSafe(F.col("_right")[f]).alias("_same"),
            )
            for f in figures
        ]
    )
    return joined.select(*keys, F.inline(each)).filter("NOT _same").drop("_same")
