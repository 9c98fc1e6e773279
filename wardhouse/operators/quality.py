"""Ordered quality rules, and the gate that keeps one accepted row per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.contracts import Rule
from wardhouse.operators.dedup import latest_per_key

OK = "OK"
REJ = "REJ"

# Stamps used when a run passes none.
NO_BATCH = date(1970, 1, 1)
NO_EXEC = -1


def reject_code(rules: Sequence[Rule]) -> Column:
    """Code of the first rule a row breaks, NULL when it breaks none."""
    return _first_match([(r.failing, r.code) for r in rules])


def reject_note(rules: Sequence[Rule]) -> Column:
    """What the first broken rule says."""
    return _first_match([(r.failing, r.note) for r in rules])


def _first_match(pairs: Sequence[tuple[str, str]]) -> Column:
    if not pairs:
        return F.lit(None).cast("string")
    failing, value = pairs[0]
    chain = F.when(F.expr(failing), F.lit(value))
    for failing, value in pairs[1:]:
        chain = chain.when(F.expr(failing), F.lit(value))
    return chain


def stamp(df: DataFrame, batch_dt: date = NO_BATCH, exec_id: int = NO_EXEC) -> DataFrame:
    """Say which batch and which execution produced the rows."""
    return df.withColumns(
        {"batch_dt": F.lit(batch_dt).cast("date"), "exec_id": F.lit(exec_id).cast("bigint")}
    )


def check_rows(
    df: DataFrame,
    rules: Sequence[Rule],
    batch_dt: date = NO_BATCH,
    exec_id: int = NO_EXEC,
    describe: bool = False,
) -> DataFrame:
    """Tag every row with its status and, when rejected, the reason code.

    ``describe`` also fills ``rej_dsc``; otherwise it stays NULL.
    """
    note = reject_note(rules) if describe else F.lit(None).cast("string")
    coded = df.withColumn("rej_cod", reject_code(rules))
    status = F.when(F.col("rej_cod").isNull(), OK).otherwise(REJ)
    return _finish(coded, df.columns, status, F.col("rej_cod"), note, batch_dt, exec_id)


def _finish(
    rows: DataFrame,
    columns: Sequence[str],
    status: Column,
    code: Column,
    note: Column,
    batch_dt: date,
    exec_id: int,
) -> DataFrame:
    return stamp(
        rows.select(
            *columns, status.alias("wrk_stts_cd"), code.alias("rej_cod"), note.alias("rej_dsc")
        ),
        batch_dt,
        exec_id,
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("wrk_stts_cd") == OK)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("wrk_stts_cd") == REJ)


def gate(
    df: DataFrame,
    rules: Sequence[Rule],
    keys: Sequence[str],
    latest_by: Sequence[str],
    batch_dt: date = NO_BATCH,
    exec_id: int = NO_EXEC,
    describe: bool = False,
) -> DataFrame:
    """Accepted rows, latest version of each key, plus every rejected row.

    The two halves stay a union on purpose: rejects are a filtered scan that
    never enters the shuffle on the key, so a large share of rejects (all with
    a NULL key, say) cannot pile up in one task.
    """
    code = reject_code(rules)
    none = F.lit(None).cast("string")
    kept = latest_per_key(df.filter(code.isNull()), keys, latest_by)
    passed = _finish(kept, df.columns, F.lit(OK), none, none, batch_dt, exec_id)
    # Literal statuses let Spark drop a whole half under a filter on the status.
    note = reject_note(rules) if describe else none
    broken = df.filter(code.isNotNull())
    failed = _finish(broken, df.columns, F.lit(REJ), code, note, batch_dt, exec_id)
    return passed.unionByName(failed)


def reject_breakdown(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, status and code, over gated tables."""
    parts = [
        df.groupBy("wrk_stts_cd", "rej_cod")
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("src_table"), "wrk_stts_cd", "rej_cod", "n_rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
