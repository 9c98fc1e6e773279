"""Full reloads and keyed upserts over immutable snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wardhouse.contracts import Table
from wardhouse.functions.casts import blank_to_null, safe_cast
from wardhouse.operators.dedup import any_null, latest_per_key
from wardhouse.operators.joins import bucketed, small


def typed(raw: DataFrame, table: Table, wrong: bool = False) -> DataFrame:
    """All-text columns by header name -> loaded names and types.

    ``wrong`` adds a column with the header names whose filled text does not fit
    its type, NULL where all fit: after the cast such a value is only missing.
    """
    columns = [safe_cast(F.col(c.source), c.kind).alias(c.target) for c in table.columns]
    if not wrong:
        return raw.select(*columns)
    # The casts are used twice, by the projection after them.
    texts = F.struct(*[F.col(c.source) for c in _parsed(table)]).alias(_TEXTS)
    cast = raw.select(*columns, *([texts] if _parsed(table) else []))
    return cast.withColumn(WRONG, _misfits(table)).drop(_TEXTS)


def _parsed(table: Table) -> list:
    return [c for c in table.columns if c.kind != "varchar"]


def _misfits(table: Table) -> Column:
    bad = [
        F.when(
            blank_to_null(F.col(_TEXTS)[c.source]).isNotNull() & F.col(c.target).isNull(), F.lit(c.source)
        )
        for c in _parsed(table)
    ]
    names = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return F.when(F.size(names) > 0, names)


def latest_in_batch(batch: DataFrame, keys: Sequence[str], guard: str | None = None) -> DataFrame:
    """One row per key of a batch: the greatest guard value, or any fixed choice."""
    order = [f"{guard} DESC NULLS LAST"] if guard else []
    return latest_per_key(batch.filter(~any_null(keys)), keys, order)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    guard: str | None = None,
    updates: Observation | None = None,
    inserts: Observation | None = None,
) -> DataFrame:
    """The target after merging a batch on its key.

    A matched row takes the batch's other columns; with ``guard`` only when the
    batch's guard value is greater (a NULL on either side keeps the target). An
    unmatched batch row is inserted, a target row the batch does not name stays.
    NULL keys match nothing. Repeats of a key within the batch are reduced to
    the latest first. ``updates`` and ``inserts`` observe how many rows (``n``)
    were changed and added, in the job that writes the result.

    Two joins rather than one full outer join: the target is then always the
    streamed side of a left join against a batch with unique keys. Spark can
    broadcast a small batch without moving the target, and can split a hot key
    of the target otherwise; neither is possible in a full outer join. Rows
    with a NULL key go around the joins, where they would share one task.
    """
    columns = target.columns
    others = [c for c in columns if c not in keys]
    source = latest_in_batch(batch, keys, guard).select(*columns)
    loose_batch = batch.filter(any_null(keys)).select(*columns)
    loose_target = target.filter(any_null(keys))
    target = target.filter(~any_null(keys))

    keyed = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in others], F.lit(True).alias("_matched")
    )
    takes = F.col("_matched").isNotNull()
    if guard:
        takes = takes & F.coalesce(F.col(f"_new_{guard}") > F.col(guard), F.lit(False))
    merged = target.join(keyed, list(keys), "left").withColumn("_takes", takes)
    if updates is not None:
        merged = merged.observe(updates, F.count_if("_takes").alias("n"))
    updated = merged.select(
        *[
            F.col(c) if c in keys else F.when(F.col("_takes"), F.col(f"_new_{c}"))
            .otherwise(F.col(c)).alias(c)
            for c in columns
        ]
    )
    added = new_rows(target, source, keys).unionByName(loose_batch)
    if inserts is not None:
        added = added.observe(inserts, F.count("*").alias("n"))
    return updated.unionByName(loose_target).unionByName(added)


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target does not hold.

    The target's keys are first cut down to those the batch names, so that a
    small batch never waits for a shuffle of the target.
    """
    wanted = source.select(*keys)
    held = target.select(*keys).join(wanted, list(keys), "left_semi").distinct()
    return source.join(held, list(keys), "left_anti")


def upsert_counts(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], guard: str | None = None
) -> DataFrame:
    """What an upsert would do, as one row: read, inserted, updated, kept."""
    source = latest_in_batch(batch, keys, guard)
    guarded = [guard] if guard else []
    old = target.select(*keys, *[F.col(g).alias("_old") for g in guarded]).withColumn(
        "_held", F.lit(True)
    )
    joined = source.select(*keys, *guarded).join(old, list(keys), "left")
    held = F.col("_held").isNotNull()
    takes = held & F.coalesce(F.col(guard) > F.col("_old"), F.lit(False)) if guard else held
    done = joined.agg(
        F.count_if(~held).alias("_new"),
        F.count_if(takes).alias("updated_rows"),
        F.count_if(held & ~takes).alias("kept_rows"),
    )
    rows = batch.agg(
        F.struct(F.count("*").alias("n"), F.count_if(any_null(keys)).alias("loose"))
    ).scalar()
    return done.withColumn("_batch", rows).select(
        F.col("_batch.n").alias("read_rows"),
        (F.col("_new") + F.col("_batch.loose") + F.col("updated_rows")).alias("affected_rows"),
        (F.col("_new") + F.col("_batch.loose")).alias("inserted_rows"),
        "updated_rows",
        "kept_rows",
    )


# Columns a loaded table keeps for itself: the day its row came with, the first
# day its key came with, the row that waits, and what did not fit its type.
DAY, FIRST, WAITING = "_batch_dt", "_first_dt", "_waiting"
WRONG = "_wrong_types"
_TEXTS = "_texts"
OWN = (DAY, FIRST, WAITING, WRONG)


def dated(rows: DataFrame, day: date, guard: str | None = None) -> DataFrame:
    """Rows of one batch in the form of the table that :func:`merge_day` keeps."""
    out = rows.withColumn(DAY, F.lit(day))
    if guard is None:
        return out
    waiting = F.struct(*rows.columns, DAY)
    return out.withColumns({FIRST: F.lit(day), WAITING: F.when(F.lit(False), waiting)})


def merge_day(
    target: DataFrame,
    batch: DataFrame,
    day: date,
    keys: Sequence[str],
    guard: str | None = None,
    updates: Observation | None = None,
    inserts: Observation | None = None,
) -> DataFrame:
    """The target after merging the batch of one day, whatever days were merged before.

    Days may come in any order, and again: the result is that of :func:`upsert`
    over all days, oldest first. Without ``guard`` a key has its row of the newest
    day that names it. With one it has its row of the greatest guard, the older
    day's at a tie; but a NULL guard on the first day stays, as nothing is greater
    than NULL. Such a key's best row otherwise waits beside it, since an older day
    may still come and set it free. Rows with a NULL key match nothing: all days'
    rows are kept, and a day that comes again replaces its own.

    The target has the batch's columns and those of :func:`dated`, and one row for each
    key. Joins of a small batch are those of :func:`upsert`, which never move the target.
    """
    business = [c for c in target.columns if c not in (DAY, FIRST, WAITING)]
    others = [c for c in business if c not in keys]
    source = latest_in_batch(batch, keys, guard).select(*business)
    keyed = source.select(*keys, F.struct(*business, F.lit(day).alias(DAY)).alias("_new"))
    held = target.filter(~any_null(keys))
    # A batch that Spark broadcasts, or any for a target bucketed on the keys, meets the target
    # where it is, in two joins. Otherwise both sides are moved, once, for one join; neither side
    # repeats a key.
    whole = not small(source) and not bucketed(held, keys)
    if whole:
        joined = held.withColumn("_held", F.lit(True)).join(keyed, list(keys), "full")
    else:
        joined = held.withColumn("_held", F.lit(True)).join(keyed, list(keys), "left")
    known = F.col("_held").isNotNull()
    new, old = F.col("_new"), F.struct(*business, DAY)
    none = F.when(F.lit(False), old)

    if guard is None:
        shown = F.when(new.isNotNull() & (new[DAY] >= F.col(DAY)), new)
    else:
        waiting = F.col(WAITING)
        earlier = new[DAY] < F.col(FIRST)

        def better(row: Column, than: Column) -> Column:
            greater = (row[guard] > than[guard]) | ((row[guard] == than[guard]) & (row[DAY] < than[DAY]))
            return row[guard].isNotNull() & (than[guard].isNull() | F.coalesce(greater, F.lit(False)))

        ahead = F.when(better(new, waiting), new).otherwise(waiting)
        blocked = F.col(guard).isNull()
        unguarded = new.isNotNull() & new[guard].isNull()
        freed = new[guard].isNotNull() & blocked & earlier
        shown = (
            F.when(unguarded & earlier, new)
            .when(freed, ahead)
            .when(~blocked & better(new, old), new)
        )
        joined = joined.withColumn(
            "_next",
            F.when(unguarded & earlier & ~blocked, old)
            .when(freed, none)
            .when(blocked & new[guard].isNotNull(), ahead)
            .otherwise(waiting),
        )
        joined = joined.withColumn("_next", F.when(known, F.col("_next")))
    merged = joined.withColumn("_shown", F.when(known, shown).otherwise(new))
    if updates is not None:
        merged = merged.observe(updates, F.count_if(known & F.col("_shown").isNotNull()).alias("n"))
    taken = F.col("_shown").isNotNull()
    columns = [F.col(k) for k in keys]
    columns += [F.when(taken, F.col("_shown")[c]).otherwise(F.col(c)).alias(c) for c in (*others, DAY)]
    if guard is not None:
        columns += [F.least(FIRST, F.col("_new")[DAY]).alias(FIRST), F.col("_next").alias(WAITING)]
    merged = merged.select(*columns, (~known).alias("_added")).select(*target.columns, "_added")

    loose = target.filter(any_null(keys) & (F.col(DAY) != F.lit(day)))
    keyless = batch.filter(any_null(keys)).select(*business)
    if whole:
        more = dated(keyless, day, guard).select(*target.columns)
        out = merged.unionByName(loose.withColumn("_added", F.lit(False))).unionByName(
            more.withColumn("_added", F.lit(True))
        )
        if inserts is not None:
            out = out.observe(inserts, F.count_if("_added").alias("n"))
        return out.drop("_added")
    merged = merged.drop("_added")
    added = new_rows(held, source, keys).unionByName(keyless)
    if inserts is not None:
        added = added.observe(inserts, F.count("*").alias("n"))
    added = dated(added, day, guard).select(*target.columns)
    return merged.unionByName(loose).unionByName(added)


def replace_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the given rows in place of those of their keys; repeats of a key are reduced
    to one. Rows without a whole key are left out. The rows have the target's columns."""
    new = latest_in_batch(rows, keys).select(*target.columns)
    kept = target.filter(~any_null(keys)).join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(target.filter(any_null(keys))).unionByName(new)
