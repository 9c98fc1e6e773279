"""One table for the rejects of all sources: recording, reporting, recycling."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.contracts import DUPLICATE_PK, Reference
from wardhouse.operators.dedup import superseded
from wardhouse.operators.findings import COPY, FATE, FINDINGS, SUPERSEDED, no_parent
from wardhouse.operators.quality import NO_BATCH, NO_EXEC, OK, REJ, rejected, stamp

# Fixed value: reject rate above which a table raises an alert.
ALERT_RATE = 0.05

_STAMPS = ("wrk_stts_cd", "rej_cod", "rej_dsc", "batch_dt", "exec_id", FINDINGS, COPY)


def reject_records(
    gated: DataFrame, table: str, keys: Sequence[str], rej_dttm: datetime
) -> DataFrame:
    """Rejected rows in the common form: key as text, whole row as JSON.

    The id is a hash over table, key, batch, execution and the row itself:
    rejects often lack the key, so the key alone would not tell them apart.
    """
    return _records(rejected(gated), table, keys, rej_dttm, ())


def finding_records(
    checked: DataFrame, table: str, keys: Sequence[str], rej_dttm: datetime
) -> DataFrame:
    """One record for everything each row breaks, from rows with ``findings``.

    ``wrk_stts_cd`` says whether the row was held back for it or for another
    finding. Equal rows and one row's findings have ids of their own.
    """
    each = checked.withColumn("_finding", F.explode(FINDINGS)).withColumns(
        {"rej_cod": F.col("_finding.code"), "rej_dsc": F.col("_finding.note")}
    )
    return _records(each.drop("_finding"), table, keys, rej_dttm, (COPY, "rej_cod", "rej_dsc"))


def _records(
    rows: DataFrame, table: str, keys: Sequence[str], rej_dttm: datetime, told_by: Sequence[str]
) -> DataFrame:
    business = [c for c in rows.columns if c not in _STAMPS]
    pk = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("?")) for k in keys])
    row = F.to_json(F.struct(*business))
    return rows.select(
        F.sha2(
            F.concat_ws(
                "-", F.lit(table), pk, F.col("batch_dt").cast("string"),
                F.col("exec_id").cast("string"), row, *[F.col(c).cast("string") for c in told_by],
            ),
            256,
        ).alias("rej_id"),
        F.lit(table).alias("src_table"),
        pk.alias("src_pk_val"),
        "batch_dt",
        "wrk_stts_cd",
        "rej_cod",
        "rej_dsc",
        row.alias("src_row_json"),
        F.lit(rej_dttm).cast("timestamp_ntz").alias("rej_dttm"),
        "exec_id",
        F.lit(0).alias("recycl_ind"),
        F.lit(None).cast("timestamp_ntz").alias("recycl_dttm"),
        F.lit(None).cast("bigint").alias("recycl_exec_id"),
    )


def all_findings(
    checked: dict[str, tuple[DataFrame, Sequence[str]]], rej_dttm: datetime
) -> DataFrame:
    """Findings of several checked tables, given with their keys."""
    parts = [finding_records(df, table, keys, rej_dttm) for table, (df, keys) in checked.items()]
    return reduce(DataFrame.unionByName, parts)


def all_rejects(
    gated: dict[str, tuple[DataFrame, Sequence[str]]], rej_dttm: datetime
) -> DataFrame:
    """Rejects of several gated tables, given with their keys."""
    out = None
    for table, (df, keys) in gated.items():
        part = reject_records(df, table, keys, rej_dttm)
        out = part if out is None else out.unionByName(part)
    return out


def reject_report(rejects: DataFrame) -> DataFrame:
    """Rejects per table, batch and code: all, recycled, waiting."""
    return rejects.groupBy("src_table", "batch_dt", "rej_cod").agg(
        F.count("*").alias("nb_rejets"),
        F.count_if(F.col("recycl_ind") == 1).alias("nb_recycles"),
        F.count_if(F.col("recycl_ind") == 0).alias("nb_en_attente"),
    )


def reject_rates(
    gated: dict[str, DataFrame], threshold: float = ALERT_RATE
) -> DataFrame:
    """Share of rejected rows per table and batch, and whether it raises an alert."""
    out = None
    for table, df in gated.items():
        part = df.groupBy("batch_dt").agg(
            F.lit(table).alias("src_table"),
            F.count("*").alias("n_rows"),
            F.count_if(F.col("wrk_stts_cd") == REJ).alias("n_rejects"),
        )
        out = part if out is None else out.unionByName(part)
    rate = F.col("n_rejects") / F.col("n_rows")
    return out.select(
        "src_table", "batch_dt", "n_rows", "n_rejects",
        rate.alias("reject_rate"), (rate > threshold).alias("is_alert"),
    )


def work_figures(gated: DataFrame, references: Sequence[Reference] = ()) -> dict[str, Column]:
    """What the gate to the star schema asks of a table, to be observed as it is written.

    Rows and rejects of the gated table, and for each table it refers to the accepted
    rows whose parent is not there. A row with lost parents of two references of one
    note counts for both.
    """
    shown = F.col(FATE) != SUPERSEDED
    figures = {
        "n_rows": F.count_if(shown),
        "n_rejects": F.count_if(shown & (F.col("wrk_stts_cd") == REJ)),
        "n_superseded": F.count_if(~shown),
    }
    for ref in references:
        lost = F.array_contains(F.col(FINDINGS)["note"], no_parent(ref.columns))
        figures[f"lost {ref.parent}"] = F.count_if(lost & (F.col("wrk_stts_cd") == OK))
    return figures


def promotion_blocks(
    figures: DataFrame, steps: DataFrame, max_reject_rate: float | None, max_lost_keys: int | None
) -> DataFrame:
    """What keeps the work layer from the star schema: (reason, name, value); no row, if nothing.

    ``figures`` has (src_table, n_rows, n_rejects) and (parent, n_lost) rows of one
    batch, ``steps`` the state of each step of the run so far. A limit of None is not
    applied.
    """
    failed = steps.filter(F.col("exec_stts_cd") != "OK").select(
        F.lit("step").alias("reason"), F.col("scrpt_name").alias("name"), F.col("exec_stts_cd").alias("value")
    )
    rate = F.col("n_rejects") / F.col("n_rows")
    noisy = figures.filter((F.col("n_rows") > 0) & (rate > F.lit(max_reject_rate).cast("double"))).select(
        F.lit("reject rate").alias("reason"), F.col("src_table").alias("name"),
        F.concat_ws(" of ", "n_rejects", "n_rows").alias("value"),
    )
    lost = figures.filter(F.col("n_lost") > F.lit(max_lost_keys).cast("bigint")).select(
        F.lit("unresolved keys").alias("reason"), F.concat_ws(" of ", "parent", "src_table").alias("name"),
        F.col("n_lost").cast("string").alias("value"),
    )
    return failed.unionByName(noisy).unionByName(lost)


FIGURES = "src_table string, n_rows bigint, n_rejects bigint, parent string, n_lost bigint"


def figure_rows(table: str, observed: dict[str, int]) -> list[tuple]:
    """The rows of ``figures`` from what was observed of one table."""
    rows = [(table, observed["n_rows"], observed["n_rejects"], None, None)]
    return rows + [
        (table, None, None, name.removeprefix("lost "), n)
        for name, n in observed.items() if name.startswith("lost ")
    ]


def require_promotion(
    rates: DataFrame, step_states: dict[str, str], unresolved: dict[str, int] | None = None
) -> None:
    """Stop before the star schema unless the work layer is fit for it.

    Every step ended OK, no table is above its reject threshold, and every
    surrogate key was found. ``rates`` has one row per table and batch.
    """
    failed = sorted(name for name, state in step_states.items() if state != "OK")
    noisy = [r["src_table"] for r in rates.filter("is_alert").orderBy("src_table").collect()]
    lost = sorted(name for name, n in (unresolved or {}).items() if n)
    if failed or noisy or lost:
        raise ValueError(
            f"not promoted: steps={failed} reject rate={noisy} unresolved keys={lost}"
        )


def require_unblocked(blocks: DataFrame) -> None:
    """Stop before the star schema if :func:`promotion_blocks` found anything."""
    found = [f"{r['reason']} {r['name']}: {r['value']}" for r in blocks.orderBy("reason", "name").collect()]
    if found:
        raise ValueError("not promoted: " + "; ".join(found))


def duplicate_rejects(
    accepted_rows: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    batch_dt: date = NO_BATCH,
    exec_id: int = NO_EXEC,
) -> DataFrame:
    """Rows the deduplication drops, as rejects with code DUPLICATE_PK.

    Equal rows stay one reject, with their number in ``copies``.
    """
    lost = superseded(accepted_rows, keys, latest_by).withColumns(
        {
            "wrk_stts_cd": F.lit(REJ),
            "rej_cod": F.lit(DUPLICATE_PK),
            "rej_dsc": F.lit("a later version of " + ", ".join(keys) + " was kept"),
        }
    )
    return stamp(lost, batch_dt, exec_id)


def corrected_rows(corrections: DataFrame, schema: str) -> DataFrame:
    """Rows to gate again, from corrected JSON (``rej_id``, ``src_row_json``)."""
    return corrections.select(F.from_json("src_row_json", schema).alias("r")).select("r.*")


def mark_recycled(
    rejects: DataFrame, corrections: DataFrame, recycl_dttm: datetime, exec_id: int
) -> DataFrame:
    """The reject table after its corrected rows went back to the gate."""
    done = corrections.select("rej_id").distinct().withColumn("_done", F.lit(True))
    hit = F.col("_done").isNotNull() & (F.col("recycl_ind") == 0)
    changed = {
        "recycl_ind": F.when(hit, F.lit(1)).otherwise(F.col("recycl_ind")),
        "recycl_dttm": F.when(hit, F.lit(recycl_dttm).cast("timestamp_ntz")).otherwise(
            F.col("recycl_dttm")
        ),
        "recycl_exec_id": F.when(hit, F.lit(exec_id).cast("bigint")).otherwise(
            F.col("recycl_exec_id")
        ),
    }
    return rejects.join(done, "rej_id", "left").select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in rejects.columns]
    )


CORRECTIONS = (
    "rej_id string, attempt int, src_table string, src_row_json string, submitted_at timestamp_ntz,"
    " exec_id bigint"
)
RECYCLED = "rej_id string, attempt int, recycl_dttm timestamp_ntz, recycl_exec_id bigint"


def _last_attempts(corrections: DataFrame) -> DataFrame:
    return corrections.groupBy("rej_id").agg(
        F.max_by(F.struct(*[c for c in corrections.columns if c != "rej_id"]), "attempt").alias("last")
    )


def new_attempts(
    corrections: DataFrame, rejects: DataFrame, earlier: DataFrame, at: datetime, exec_id: int
) -> DataFrame:
    """CORRECTIONS rows for corrected rejects (``rej_id``, ``src_row_json``) that change the last
    attempt of their reject. Of several for one reject the greatest text is taken."""
    sent = corrections.groupBy("rej_id").agg(F.max("src_row_json").alias("src_row_json"))
    known = rejects.select("rej_id", "src_table").dropDuplicates(["rej_id"])
    met = sent.join(known, "rej_id").join(_last_attempts(earlier), "rej_id", "left")
    return met.filter(~F.col("src_row_json").eqNullSafe(F.col("last.src_row_json"))).select(
        "rej_id",
        (F.coalesce("last.attempt", F.lit(0)) + 1).cast("int").alias("attempt"),
        "src_table",
        "src_row_json",
        F.lit(at).cast("timestamp_ntz").alias("submitted_at"),
        F.lit(exec_id).cast("bigint").alias("exec_id"),
    )


def waiting_attempts(corrections: DataFrame, recycled: DataFrame) -> DataFrame:
    """The last attempt of each reject, unless it has gone back already."""
    last = _last_attempts(corrections).select("rej_id", "last.*").select(*corrections.columns)
    return last.join(recycled.select("rej_id", "attempt"), ["rej_id", "attempt"], "left_anti").select(
        *corrections.columns
    )


def with_recycling(rejects: DataFrame, corrections: DataFrame, recycled: DataFrame) -> DataFrame:
    """Rejects with the last time they went back to the gate, and ``n_attempts``."""
    own = ("recycl_ind", "recycl_dttm", "recycl_exec_id")
    attempts = corrections.groupBy("rej_id").agg(F.count_distinct("attempt").alias("n_attempts"))
    last = recycled.groupBy("rej_id").agg(
        F.max_by(F.struct("recycl_dttm", "recycl_exec_id"), F.struct("attempt", "recycl_dttm")).alias("r")
    )
    joined = rejects.drop(*own).join(attempts, "rej_id", "left").join(last, "rej_id", "left")
    return joined.select(
        *[c for c in rejects.columns if c not in own],
        F.col("r").isNotNull().cast("int").alias("recycl_ind"),
        "r.recycl_dttm",
        "r.recycl_exec_id",
        F.coalesce("n_attempts", F.lit(0).cast("long")).alias("n_attempts"),
    )
