"""A daily batch from its files to the indicator views."""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from datetime import date
from functools import partial, reduce
from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wardhouse.contracts import TABLES, Table, table
from wardhouse.operators.load import WRONG, dated, merge_day, replace_rows, typed
from wardhouse.operators.findings import CLEAN, FATE, NOTED, SUPERSEDED
from wardhouse.operators.quality import NO_EXEC, accepted
from wardhouse.operators.rejects import (
    CORRECTIONS,
    FIGURES,
    RECYCLED,
    all_findings,
    corrected_rows,
    figure_rows,
    mark_recycled,
    new_attempts,
    promotion_blocks,
    require_unblocked,
    waiting_attempts,
    with_recycling,
    work_figures,
)
from wardhouse.plans import assertions
from wardhouse.plans.audit import RunLog, step_state
from wardhouse.plans.kpis import build_views
from wardhouse.plans.marts import MART_KEYS, MARTS
from wardhouse.plans.party import build_party
from wardhouse.plans.reconciliation import layer_failures, view_failures
from wardhouse.plans.staging import stage
from wardhouse.plans.work import checked
from wardhouse.session import at_once, work_path
from wardhouse.sources.archive import archived, purge, replay, write_archive
from wardhouse.sources.batch_files import read_batch, require_contract
from wardhouse.sources.warehouse import OBS, REJECTS, SOC, STG, TCH, WRK, Warehouse, utc_now


@dataclass(frozen=True)
class LoadResult:
    """Counters of one table load."""

    table: str
    strategy: str
    read_rows: int
    affected_rows: int
    rejected_rows: int
    duration_seconds: float


def land(
    wh: Warehouse, contract: Table, raw: DataFrame, day: date, exec_id: int | None = None
) -> tuple[DataFrame, int]:
    """Archive the typed rows of a batch; returns them as read back, and their count.

    The text is parsed once. Everything after reads the archived columns.
    """
    seen = Observation()
    path = wh.path(OBS, contract.name)
    rows = typed(raw, contract, wrong=True).observe(seen, F.count("*").alias("n"))
    write_archive(archived(rows, day, utc_now(), NO_EXEC if exec_id is None else exec_id), path)
    return replay(wh.spark, path, day), seen.get["n"]


def load_rows(
    wh: Warehouse, contract: Table, raw: DataFrame, day: date, exec_id: int | None = None
) -> LoadResult:
    """Reload or upsert one loaded table from the text rows of a batch.

    Days may arrive in any order: the table is the one that loading them oldest
    first gives.
    """
    started = time.perf_counter()
    batch, n_read = land(wh, contract, raw, day, exec_id)
    n_affected = _merged(wh, contract, batch, day, exec_id)
    return LoadResult(
        contract.name, contract.load, n_read, n_affected, 0, time.perf_counter() - started
    )


def _merged(wh: Warehouse, contract: Table, batch: DataFrame, day: date, exec_id: int | None) -> int:
    """Bring a table's rows of one day into it; how many rows of the table that changed.

    A reload is left alone by a day before the one it holds. An upsert writes the
    folders that the batch's keys fall into, or, in a bucketed warehouse, the
    next snapshot.
    """
    name, keys, guard = contract.name, contract.keys, contract.guard
    if contract.load == "full":
        held = wh.batch_date(STG, name)
        if held is not None and held > day:
            return 0
        return wh.write(batch, STG, name, day, exec_id, keys)
    seen: list[Observation] = []

    def merged(target: DataFrame, rows: DataFrame) -> DataFrame:
        seen.extend((Observation(), Observation()))
        return merge_day(target, rows, day, keys, guard, *seen[-2:])

    empty = dated(batch, day, guard).limit(0)
    if wh.buckets:
        current = wh.find(STG, name)
        wh.write(merged(empty if current is None else current, batch), STG, name, day, exec_id, keys)
    else:
        table = wh.keyed(STG, name, keys)
        table.merge(batch, empty, merged)
        wh.enter(STG, name, table, day, exec_id)
    return sum(changed.get["n"] for changed in seen)


def reload_from_archive(
    wh: Warehouse, name: str, day: date, exec_id: int | None = None
) -> int:
    """Load a past batch again from the archive, without its files; rows of the table after that."""
    contract = table(name)
    _merged(wh, contract, replay(wh.spark, wh.path(OBS, name), day), day, exec_id)
    return wh.read(STG, name).count()


def ingest_table(
    wh: Warehouse, inputs: str, day: date, name: str, exec_id: int | None = None
) -> LoadResult:
    """Load one extract of the batch."""
    return ingest_contract(wh, inputs, day, table(name), exec_id)


def ingest_contract(
    wh: Warehouse, inputs: str, day: date, contract: Table, exec_id: int | None = None
) -> LoadResult:
    """Load the extract of a contract; its columns are checked before anything is written."""
    raw = read_batch(wh.spark, inputs, day, contract.name)
    require_contract(raw, contract, day)
    return load_rows(wh, contract, raw, day, exec_id)


def ingest_batch(
    wh: Warehouse, inputs: str, day: date, exec_id: int | None = None
) -> list[LoadResult]:
    """Load all tables, some side by side; the first extract, in contract order, that cannot be
    read or breaks its contract stops those after it, before any is written."""

    def opened(contract: Table) -> DataFrame | Exception:
        try:
            raw = read_batch(wh.spark, inputs, day, contract.name)
            require_contract(raw, contract, day)
            return raw
        except Exception as error:
            return error

    found = at_once([partial(opened, contract) for contract in TABLES.values()])
    failure = next((f for f in found if isinstance(f, Exception)), None)
    ready = found if failure is None else found[: found.index(failure)]
    results = at_once(
        [partial(load_rows, wh, contract, raw, day, exec_id) for contract, raw in zip(TABLES.values(), ready)]
    )
    if failure is not None:
        raise failure
    return results


def replay_batches(
    wh: Warehouse, inputs: str, days: Iterable[date], exec_id: int | None = None
) -> list[LoadResult]:
    """Load several batches, oldest first."""
    return [r for day in sorted(days) for r in ingest_batch(wh, inputs, day, exec_id)]


def purge_archive(wh: Warehouse, as_of: date) -> dict[str, list[date]]:
    """Drop archived batches past each table's retention; the dates dropped."""
    return {
        name: purge(wh.spark, wh.path(OBS, name), as_of, contract.retention_months)
        for name, contract in TABLES.items()
    }


def staged_tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: stage(df, TABLES[name]) for name, df in wh.read_all(STG, TABLES).items()}


@dataclass(frozen=True)
class Steps:
    """Hands out one execution id per table written, each a logged step of a run."""

    log: RunLog
    run_id: int
    ids: Iterator[int]

    @contextmanager
    def table(self, name: str) -> Iterator[int]:
        exec_id = next(self.ids)
        with self.log.step(self.run_id, exec_id, name):
            yield exec_id


def _step(steps: Steps | None, name: str, exec_id: int):
    return steps.table(name) if steps else nullcontext(exec_id)


def build_work(
    wh: Warehouse, day: date, exec_id: int = NO_EXEC, steps: Steps | None = None,
    strict: bool = False, figures: list[tuple] | None = None,
) -> dict[str, DataFrame]:
    """Check all loaded tables and write the work layer, parents before their children.

    ``figures`` is filled with what the gate asks. ``strict`` lets every finding
    reject its row.
    """
    for name, contract in TABLES.items():
        with _step(steps, f"wrk_{name.lower()}", exec_id) as step_id:
            asked = check_table(wh, contract, day, step_id, strict)
        if figures is not None:
            figures += asked
    return wh.read_all(WRK, TABLES)


def check_table(
    wh: Warehouse, contract: Table, day: date, exec_id: int = NO_EXEC, strict: bool = False
) -> list[tuple]:
    """Check one loaded table against its rules and its parents' work tables; its figures.

    One plan finds all that its rows break, and one write puts accepted and rejected
    rows and the versions not kept into folders of their own. The figures are
    observed in that write.
    """
    loaded = wh.read(STG, contract.name)
    staged = stage(loaded, contract, [c for c in (WRONG,) if c in loaded.columns])
    parents = {r.parent: accepted(wh.read(WRK, r.parent)) for r in contract.references}
    rows = checked(staged, contract, parents, day, exec_id, strict)
    seen = Observation()
    asked = work_figures(rows, contract.references)
    rows = rows.observe(seen, *[c.alias(n) for n, c in asked.items()])
    wh.write(rows, WRK, contract.name, day, exec_id, contract.staged_keys, FATE, (SUPERSEDED,))
    return figure_rows(contract.name, seen.get)


def build_star(
    wh: Warehouse, day: date, exec_id: int = NO_EXEC, steps: Steps | None = None
) -> dict[str, DataFrame]:
    """Write the ten marts from the work layer."""
    gated = wh.read_all(WRK, TABLES)
    for name, build in MARTS.items():
        with _step(steps, name, exec_id) as step_id:
            wh.write(build(gated), SOC, name, day, step_id, MART_KEYS[name])
    return wh.read_all(SOC, MARTS)


def build_rejects(wh: Warehouse, day: date, tables: Iterable[Table] = tuple(TABLES.values())) -> int:
    """Record everything that a day's rows break; how many findings there are.

    Only the folders of rows with findings are read. The reject table is
    partitioned by batch: recording a batch again replaces its partition and
    touches no other.
    """
    noted = {
        t.name: (wh.read_parts(WRK, t.name, (NOTED, SUPERSEDED)), t.staged_keys) for t in tables
    }
    found = all_findings(noted, utc_now()).filter(F.col("batch_dt") == F.lit(day))
    seen = Observation()
    write_archive(found.observe(seen, F.count("*").alias("n")), reject_path(wh))
    return seen.get["n"]


def reject_path(wh: Warehouse) -> str:
    return wh.path(REJECTS, "records")


def _appended(wh: Warehouse, name: str, schema: str) -> DataFrame:
    """An append-only table of the reject layer, empty before its first row."""
    path = wh.path(REJECTS, name)
    wh.spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return wh.spark.read.schema(schema).parquet(path)


def submit_corrections(wh: Warehouse, corrections: DataFrame, exec_id: int) -> int:
    """Take in corrected rows (``rej_id``, ``src_row_json``) of recorded rejects; how many are new.

    Each is an attempt, counted up for its reject. The row of the last attempt, sent
    again, is none; nor is a reject that is not recorded.
    """
    earlier = _appended(wh, "corrections", CORRECTIONS)
    known = wh.spark.read.parquet(reject_path(wh)).select("rej_id", "src_table")
    new = new_attempts(corrections, known, earlier, utc_now(), exec_id)
    path = work_path(wh.spark, "corrections")
    new.write.parquet(path)
    taken = wh.spark.read.schema(CORRECTIONS).parquet(path)
    taken.write.mode("append").parquet(wh.path(REJECTS, "corrections"))
    return taken.count()


def recycle(
    wh: Warehouse, day: date, exec_id: int, tables: Iterable[Table] = tuple(TABLES.values())
) -> int:
    """Bring corrected rows back into their loaded tables; how many attempts that were.

    The last attempt of each reject that has not gone back yet replaces the rows of
    its key, whatever their guard says; the next check then accepts or rejects it
    like any other row. An attempt is logged as gone back after its table is written:
    a run that is cut short, or repeated, writes the same rows again or none.
    """
    done = _appended(wh, "recycled", RECYCLED)
    waiting = work_path(wh.spark, "waiting")
    waiting_attempts(_appended(wh, "corrections", CORRECTIONS), done).write.parquet(waiting)
    attempts = wh.spark.read.schema(CORRECTIONS).parquet(waiting)
    named = {r[0] for r in attempts.select("src_table").distinct().collect()}
    for contract in (t for t in tables if t.name in named):
        staged = ", ".join(f"{c.staged} {wh_type(wh, contract, c)}" for c in contract.columns)
        of_table = attempts.filter(F.col("src_table") == contract.name)
        rows = corrected_rows(of_table, staged)
        held = wh.read(STG, contract.name)
        types = dict(held.dtypes)
        rows = rows.select(*[F.col(c.staged).cast(types[c.target]).alias(c.target) for c in contract.columns])
        if WRONG in types:
            rows = rows.withColumn(WRONG, F.lit(None).cast(types[WRONG]))
        _replaced(wh, contract, rows, day, exec_id)
        gone = of_table.select("rej_id", "attempt").withColumns(
            {
                "recycl_dttm": F.lit(utc_now()).cast("timestamp_ntz"),
                "recycl_exec_id": F.lit(exec_id).cast("bigint"),
            }
        )
        gone.write.mode("append").parquet(wh.path(REJECTS, "recycled"))
    return attempts.count()


def wh_type(wh: Warehouse, contract: Table, column) -> str:
    """Type of a staged column, by which its text in a reject is read."""
    return column.staged_type or dict(wh.read(STG, contract.name).dtypes)[column.target]


def _replaced(wh: Warehouse, contract: Table, rows: DataFrame, day: date, exec_id: int) -> None:
    """Put rows in place of those of their keys, written as a batch of the table is."""
    name, keys, guard = contract.name, contract.keys, contract.guard
    if contract.load == "full" or wh.buckets:
        held, kept = wh.read(STG, name), wh.batch_date(STG, name)
        new = rows if contract.load == "full" else dated(rows, day, guard)
        wh.write(replace_rows(held, new, keys), STG, name, kept, exec_id, keys)
        return
    table = wh.keyed(STG, name, keys)
    table.merge(
        rows, dated(rows, day, guard).limit(0),
        lambda held, new: replace_rows(held, dated(new, day, guard), keys),
    )
    wh.enter(STG, name, table, wh.batch_date(STG, name), exec_id)


def reject_states(wh: Warehouse) -> DataFrame:
    """The reject table with what became of each reject: recycled, when, by which execution, and
    how many attempts there were."""
    return with_recycling(
        wh.spark.read.parquet(reject_path(wh)),
        _appended(wh, "corrections", CORRECTIONS),
        _appended(wh, "recycled", RECYCLED),
    )


def recycle_rejects(
    wh: Warehouse, corrections: DataFrame, batch_dt: date, exec_id: int
) -> None:
    """Mark the corrected rejects of one batch as recycled.

    Only that batch's partition is rewritten, by way of a work table, since it
    cannot be overwritten while it is read. The corrected rows themselves go
    back to the gate as :func:`~wardhouse.operators.rejects.corrected_rows`.
    """
    of_batch = wh.spark.read.parquet(reject_path(wh)).filter(
        F.col("batch_dt") == F.lit(batch_dt)
    )
    path = work_path(wh.spark, "rejects")
    mark_recycled(of_batch, corrections, utc_now(), exec_id).write.parquet(path)
    write_archive(wh.spark.read.parquet(path), reject_path(wh))


def build_party_tables(wh: Warehouse, day: date, exec_id: int) -> dict[str, DataFrame]:
    """Write the party model next to the star schema it takes its keys from."""
    keys = wh.read_all(SOC, ["r_part", "r_medc"])
    tables = build_party(wh.read_all(WRK, TABLES), keys["r_part"], keys["r_medc"])
    for name, rows in tables.items():
        wh.write(rows, SOC, name, day, exec_id)
    return wh.read_all(SOC, tables)


def views(wh: Warehouse) -> dict[str, DataFrame]:
    """The indicator views over the current marts. Nothing is written."""
    return build_views(wh.read_all(SOC, assertions.MARTS))


LAYERS = ("loaded", "declared", "staged", "work", "marts", "views", "reconciled")


def archived_sources(wh: Warehouse) -> dict[str, DataFrame]:
    """All archived days of every extract, under their loaded names."""
    return {name: wh.spark.read.parquet(wh.path(OBS, name)) for name in TABLES}


def check_warehouse(wh: Warehouse, layers: Sequence[str] = LAYERS) -> DataFrame:
    """Failing checks of the given layers; ``reconciled`` compares the layers with each other."""
    marts = wh.read_all(SOC, assertions.MARTS)
    tables = {
        "loaded": lambda: wh.read_all(STG, TABLES),
        "declared": lambda: wh.read_all(STG, TABLES),
        "staged": lambda: staged_tables(wh),
        "work": lambda: wh.read_all(WRK, TABLES),
        "marts": lambda: marts,
        "views": lambda: build_views(marts),
    }

    def failures(layer: str) -> DataFrame:
        if layer != "reconciled":
            return assertions.run_checks(tables[layer](), assertions.LAYERS[layer], marts)
        everything = {n: wh.read_parts(WRK, n, (CLEAN, NOTED, SUPERSEDED)) for n in TABLES}
        return layer_failures(staged_tables(wh), everything).unionByName(
            view_failures(build_views(marts), marts["r_room"], archived_sources(wh))
        )

    found = [failures(layer).withColumn("layer", F.lit(layer)) for layer in layers]
    return reduce(DataFrame.unionByName, found)


def run_day(
    wh: Warehouse, inputs: str, day: date, run_id: int, first_exec_id: int,
    run_typ: str = "DAILY", max_reject_rate: float | None = None,
    max_lost_keys: int | None = None, strict: bool = False,
) -> dict[str, DataFrame]:
    """Load, check, record rejects, promote: one tracked run. Returns the indicator views.

    Each step has its own execution id, counted up from ``first_exec_id``: the
    load, then one per work table, the reject table and one per mart. Rows carry the
    id of the work step that accepted them. With ``max_reject_rate`` or
    ``max_lost_keys`` the star schema is only rebuilt when every step so far is
    logged as OK, no table has a larger share of rejects, and no reference more
    accepted rows without their parent.
    """
    log = RunLog(wh.spark, wh.path(TCH, "events"))
    steps = Steps(log, run_id, count(first_exec_id))
    figures: list[tuple] = []
    with log.run(run_id, run_typ, day):
        with steps.table("ingest_stg") as load_id:
            ingest_batch(wh, inputs, day, load_id)
        build_work(wh, day, steps=steps, strict=strict, figures=figures)
        with steps.table("rej_record"):
            build_rejects(wh, day)
        if max_reject_rate is not None or max_lost_keys is not None:
            states = step_state(log.events()).filter(F.col("run_id") == run_id)
            observed = wh.spark.createDataFrame(figures, FIGURES)
            require_unblocked(promotion_blocks(observed, states, max_reject_rate, max_lost_keys))
        build_star(wh, day, steps=steps)
    return views(wh)
