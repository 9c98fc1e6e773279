"""Data-quality checks. A check returns what fails; no rows means it passed."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns holding NULLs and how many; all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    return counted.unpivot([], list(names), "column_name", "n_failed").filter("n_failed > 0")


def duplicate_keys(df: DataFrame, keys: Sequence[str], where: str | None = None) -> DataFrame:
    """Key values that occur more than once; a key with a NULL part is ignored."""
    rows = df.filter(where) if where else df
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        rows.filter(whole).groupBy(*keys).agg(F.count("*").alias("cnt")).filter("cnt > 1")
    )


def repeated_keys(
    df: DataFrame, key_sets: Sequence[Sequence[str]], where: str | None = None
) -> DataFrame:
    """(key_set, n_failed): for each set of key columns by position, the rows whose key repeats.

    All sets share one shuffle, of a hash of each whole key, summed before it. Only
    keys whose hash repeats, normally none, are grouped by their values afterwards.
    Sets without a repeat have no row.
    """
    rows = df.filter(where) if where else df
    tags = [
        F.when(
            reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]),
            F.struct(
                F.lit(n).alias("key_set"), F.xxhash64(*keys).alias("_code"),
                F.to_json(F.struct(*keys)).alias("_key"),
            ),
        )
        for n, keys in enumerate(key_sets)
    ]
    tagged = rows.select(F.inline(F.array_compact(F.array(*tags))))
    met = tagged.groupBy("key_set", "_code").agg(F.count("*").alias("n")).filter("n > 1")
    exact = tagged.join(met, ["key_set", "_code"], "left_semi").groupBy("key_set", "_key")
    repeated = exact.agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.groupBy("key_set").agg(F.sum("n").alias("n_failed"))


def lost_by_parent(
    parent: DataFrame,
    parent_columns: Sequence[str],
    children: Sequence[tuple[DataFrame, Sequence[str], str | None]],
) -> DataFrame:
    """(child, n_failed): for each child by position, the rows that name no row of the parent.

    The keys of the parent and of all children are one tagged union, grouped once.
    Rows are summed per key before the shuffle. A NULL names no parent; children
    without a lost row have no row here.
    """
    names = [f"_k{n}" for n in range(len(parent_columns))]
    union = parent.select(
        *[F.col(c).alias(n) for c, n in zip(parent_columns, names)], F.lit(None).cast("int").alias("child")
    )
    for n, (child, columns, where) in enumerate(children):
        rows = child.filter(where) if where else child
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        keys = [F.col(c).alias(k) for c, k in zip(columns, names)]
        union = union.union(rows.filter(whole).select(*keys, F.lit(n).alias("child")))
    counts = [F.count_if(F.col("child") == n).alias(f"n{n}") for n in range(len(children))]
    grouped = union.groupBy(*names).agg(
        F.bool_or(F.col("child").isNull()).alias("_held"), *counts
    )
    each = F.array(
        *[F.struct(F.lit(n).alias("child"), F.col(f"n{n}").alias("n")) for n in range(len(children))]
    )
    lost = grouped.filter("NOT _held").select(F.inline(each)).filter("n > 0")
    return lost.groupBy("child").agg(F.sum("n").alias("n_failed"))


def unexpected_values(
    df: DataFrame, name: str, values: Iterable, where: str | None = None
) -> DataFrame:
    """Values outside the accepted list and how often; NULLs are ignored."""
    rows = df.filter(where) if where else df
    return (
        rows.filter(F.col(name).isNotNull() & ~F.col(name).isin(*values))
        .groupBy(F.col(name).alias("value"))
        .agg(F.count("*").alias("n_failed"))
    )


def orphans(
    child: DataFrame,
    columns: Sequence[str],
    parent: DataFrame,
    parent_columns: Sequence[str],
    where: str | None = None,
) -> DataFrame:
    """Foreign-key values without a parent and how many rows carry them.

    Rows are counted per value before the join, so that a value shared by many
    rows crosses the shuffle once per task.
    """
    rows = child.filter(where) if where else child
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    used = rows.filter(whole).groupBy(*columns).agg(F.count("*").alias("n_failed"))
    held = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)])
    return used.join(held, list(columns), "left_anti")


def failing_rows(df: DataFrame, failing: str, names: Sequence[str] | None = None) -> DataFrame:
    """Rows that meet a predicate no row should meet."""
    rows = df.filter(failing)
    return rows.select(*names) if names else rows


def population_missing(df: DataFrame, present: str, reason: str) -> DataFrame:
    """One row with the reason when no row meets a predicate."""
    return (
        df.agg(F.count_if(F.expr(present)).alias("n"))
        .filter("n = 0")
        .select(F.lit(reason).alias("failure_reason"))
    )


def unknown_ids(view: DataFrame, name: str, source: DataFrame, source_name: str) -> DataFrame:
    """Distinct ids of a view that its source does not hold."""
    held = source.select(F.col(source_name).alias(name))
    return view.select(name).filter(F.col(name).isNotNull()).distinct().join(
        held, name, "left_anti"
    )


def reconcile(facts: dict[str, tuple[DataFrame, Column]], rules: dict[str, str]) -> DataFrame:
    """Compare figures taken from different tables.

    ``facts`` names one aggregate per figure; ``rules`` are predicates over the
    names that must hold. Returns the rules that do not, a NULL figure included.
    Figures of the same table are taken in one pass.
    """
    by_table: dict[int, tuple[DataFrame, list[Column]]] = {}
    for name, (df, figure) in facts.items():
        by_table.setdefault(id(df), (df, []))[1].append(figure.alias(name))
    figures = None
    for df, columns in by_table.values():
        one = df.agg(F.struct(*columns).alias("s"))
        figures = one.select("s.*") if figures is None else figures.select(
            "*", one.scalar().alias("_s")
        ).select(*figures.columns, "_s.*")
    broken = F.array(
        *[
            F.when(F.coalesce(F.expr(rule), F.lit(False)), None).otherwise(F.lit(name))
            for name, rule in rules.items()
        ]
    )
    return figures.select(F.explode(F.array_compact(broken)).alias("failed_rule"))
