"""Everything a row breaks, found in one pass: rules, types, parents, versions."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.contracts import (
    DUPLICATE_PK,
    FK_NOT_FOUND,
    NULL_MANDATORY,
    WRONG_FORMAT,
    WRONG_TYPE,
    Reference,
    Rule,
    Table,
)
from wardhouse.operators.dedup import any_null, ranked
from wardhouse.operators.joins import hot_keys, hot_keys_of, join_dimension, small
from wardhouse.operators.load import WRONG
from wardhouse.operators.quality import NO_BATCH, NO_EXEC, OK, REJ, stamp

# Fixed value: the codes that keep a row out of the star schema. The others are
# only recorded, unless the caller asks for more.
HOLDING = (NULL_MANDATORY, WRONG_FORMAT)

# What became of a row, also the folder it is written to.
CLEAN, NOTED, SUPERSEDED = "clean", "noted", "superseded"
FATE, FINDINGS, COPY = "fate", "findings", "copy"

_FINDING = "struct<code:string,note:string>"


def finding(code: str, note: Column | str) -> Column:
    text = F.lit(note) if isinstance(note, str) else note
    return F.struct(F.lit(code).alias("code"), text.alias("note"))


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Findings of all rules a row breaks, in their order."""
    return _filled([F.when(F.expr(r.failing), finding(r.code, r.note)) for r in rules])


def _filled(maybe: Sequence[Column]) -> Column:
    array = F.array(*maybe) if maybe else F.array()
    return F.array_compact(array.cast(f"array<{_FINDING}>"))


def wrong_type_findings(table: Table, column: str = WRONG) -> Column:
    """Findings of the header names kept in ``column`` while the text was cast."""
    kinds = F.create_map(*[F.lit(x) for c in table.columns for x in (c.source, c.kind)])
    found = F.transform(
        F.coalesce(F.col(column), F.array().cast("array<string>")),
        lambda name: finding(WRONG_TYPE, F.concat(name, F.lit(" is not of type "), kinds[name])),
    )
    return found.cast(f"array<{_FINDING}>")


def no_parent(columns: Sequence[str]) -> str:
    return "no parent for " + ", ".join(columns)


def with_lost_parents(
    rows: DataFrame, references: Sequence[Reference], parents: dict[str, DataFrame], name: str
) -> DataFrame:
    """Append ``name``, the findings of all references whose parent is not there.

    ``parents`` holds rows that count as parents, under their staged names; their
    referenced columns are unique. A NULL foreign key names no parent. Rows are
    read once: every reference is a left join, by broadcast where the parent's
    keys are small, otherwise with hot keys dealt out.
    """
    columns = rows.columns
    held = []
    for ref in references:
        parent = parents[ref.parent]
        if ref.parent_filter:
            parent = parent.filter(ref.parent_filter)
        held.append(parent.select(*[F.col(p).alias(c) for c, p in zip(ref.columns, ref.parent_columns)]))
    large = [n for n, keys in enumerate(held) if not small(keys)]
    hot = dict(zip(large, hot_keys_of(rows, [references[n].columns for n in large]))) if large else {}
    for n, (ref, keys) in enumerate(zip(references, held)):
        keys = keys.withColumn(f"_held{n}", F.lit(True))
        rows = join_dimension(rows, keys, ref.columns, "left", hot=hot.get(n, {}))
    lost = [
        F.when(
            F.col(f"_held{n}").isNull() & ~any_null(ref.columns),
            finding(FK_NOT_FOUND, no_parent(ref.columns)),
        )
        for n, ref in enumerate(references)
    ]
    return rows.select(*columns, _filled(lost).alias(name))


def check_all(
    rows: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str],
    latest_by: Sequence[str],
    references: Sequence[Reference] = (),
    parents: dict[str, DataFrame] | None = None,
    notes: Sequence[Rule] = (),
    misfits: Column | None = None,
    holding: Collection[str] = HOLDING,
    batch_dt: date = NO_BATCH,
    exec_id: int = NO_EXEC,
) -> DataFrame:
    """Every row with its status and with all it breaks.

    ``findings`` is an array of (code, note): the broken rules in their order,
    then values of a wrong type, broken ``notes``, lost parents, and whether a later
    version of the key was kept. A code in ``holding`` rejects the row; among the
    others the latest version of each key is accepted. ``rej_cod`` is the first
    finding that rejects. ``fate`` says where a row belongs: ``clean`` and
    ``noted`` (rejected, or accepted with findings) are the gated table, the
    versions not kept are ``superseded``. ``copy`` numbers equal rows.

    The rows are read once (and the keys alone before, where the table is too large
    to broadcast) and shuffled once on the key, apart from joins with large parents. Rejected rows and hot keys are spread by their content.
    """
    columns = [c for c in rows.columns if c != WRONG]
    # Looked for in the rows as they come, before anything is joined to them.
    hot = {} if small(rows) else hot_keys(rows, keys)
    types = misfits if misfits is not None else F.array().cast(f"array<{_FINDING}>")
    found = rows.withColumn("_types", types)
    found = with_lost_parents(found, references, parents or {}, "_lost")
    found = found.withColumn(
        FINDINGS, F.concat(broken_rules(rules), "_types", broken_rules(notes), "_lost")
    )
    found = found.select(*columns, FINDINGS)
    held = F.exists(FINDINGS, lambda f: f["code"].isin(*holding))
    placed = ranked(found, keys, latest_by, ~held, "_kept", COPY, hot).withColumn("_held", held)
    late = ~F.col("_held") & ~F.col("_kept")
    later = finding(DUPLICATE_PK, "a later version of " + ", ".join(keys) + " was kept")
    placed = placed.withColumn("_late", late).withColumn(
        FINDINGS, F.when(F.col("_late"), F.array_append(FINDINGS, later)).otherwise(F.col(FINDINGS))
    )
    late = F.col("_late")
    first = F.filter(FINDINGS, lambda f: f["code"].isin(*holding, DUPLICATE_PK))
    out = F.col("_held") | late
    unseen = late if DUPLICATE_PK not in holding else F.lit(False)
    tagged = placed.select(
        *columns,
        F.when(out, F.lit(REJ)).otherwise(F.lit(OK)).alias("wrk_stts_cd"),
        F.when(out, F.get(first, F.lit(0))["code"]).alias("rej_cod"),
        F.lit(None).cast("string").alias("rej_dsc"),
        FINDINGS,
        COPY,
        F.when(unseen, SUPERSEDED).when(F.size(FINDINGS) > 0, NOTED).otherwise(CLEAN).alias(FATE),
    )
    return stamp(tagged, batch_dt, exec_id)
