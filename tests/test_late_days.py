"""Days that come late or again, and upserts that rewrite only what they touch."""

import itertools
import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from wardhouse.contracts import Column, Table
from wardhouse.operators.load import OWN, dated, merge_day
from wardhouse.plans.daily import load_rows
from wardhouse.sources.keyed import SLOT, KeyedTable
from wardhouse.sources.warehouse import STG, Warehouse

START = date(2026, 4, 29)
VISITS = Table(
    name="VISITS", load="delta", keys=("ID",), guard="CHANGED", rules=(), latest_by=(),
    columns=(
        Column("ID", "integer", "id"), Column("NOTE", "varchar", "note"), Column("CHANGED", "integer", "changed"),
    ),
)


def replayed(batches, guard):
    """Rows after loading the batches oldest first, one key at a time."""
    table, loose = {}, []
    for day in sorted(batches):
        best = {}
        for key, note, changed in batches[day]:
            if key is None:
                loose.append((key, note, changed))
                continue
            rank = (-1 if changed is None else changed) if guard else 0
            # The latest of a batch; ties by the other columns in ascending order.
            order = (-rank, note, -1 if changed is None else changed)
            if key not in best or order < best[key][0]:
                best[key] = (order, (key, note, changed))
        for key, (_, row) in best.items():
            old = table.get(key)
            newer = old is not None and None not in (old[2], row[2]) and row[2] > old[2]
            if old is None or not guard or newer:
                table[key] = row
    return sorted([*table.values(), *loose], key=repr)


def days(seed, n_days=4):
    rng = random.Random(seed)
    return {
        START + timedelta(d): [
            (rng.choice([None, *range(8)]), f"day {d} row {k}", rng.choice([None, None, *range(5)]))
            for k in range(rng.randrange(1, 9))
        ]
        for d in range(n_days)
    }


@pytest.mark.parametrize("guard", ["changed", None])
def test_any_order_of_days_is_the_oldest_first_replay(spark, guard):
    schema = "id long, note string, changed int"
    for seed in range(2):
        batches = days(seed, 3)
        orders = list(itertools.permutations(batches))
        for order in [random.Random(seed).choice(orders), tuple(sorted(batches, reverse=True))]:
            again = (*order, order[0])
            table = None
            for day in again:
                batch = spark.createDataFrame(batches[day], schema).coalesce(1)
                table = dated(batch, day, guard).limit(0) if table is None else table
                rows = merge_day(table, batch, day, ["id"], guard).collect()
                table = spark.createDataFrame(rows, table.schema).coalesce(1)
            got = sorted((tuple(r) for r in table.drop(*OWN).collect()), key=repr)
            assert got == replayed(batches, guard), (seed, order)


def texts(spark, rows):
    return spark.createDataFrame(
        [tuple(None if x is None else str(x) for x in r) for r in rows], "ID string, NOTE string, CHANGED string"
    )


@pytest.mark.parametrize("buckets", [0, 3])
def test_loading_days_in_any_order(spark, tmp_path, buckets):
    batches = days(7)
    wh = Warehouse(spark, str(tmp_path), buckets=buckets, slots=4)
    for day in sorted(batches, reverse=True):
        load_rows(wh, VISITS, texts(spark, batches[day]), day)
    got = sorted((tuple(r)[:3] for r in wh.read(STG, "VISITS").select("ID", "NOTE", "CHANGED").collect()), key=repr)
    assert got == replayed(batches, True)


def test_a_late_day_leaves_a_reloaded_table_alone(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    table = replace(VISITS, load="full", guard=None)
    assert load_rows(wh, table, texts(spark, [(1, "new", 1)]), START).affected_rows == 1
    assert load_rows(wh, table, texts(spark, [(2, "old", 1), (3, "old", 1)]), START - timedelta(1)).affected_rows == 0
    assert [r.ID for r in wh.read(STG, "VISITS").collect()] == [1]
    assert load_rows(wh, table, texts(spark, [(4, "again", 1)]), START).affected_rows == 1
    assert [r.ID for r in wh.read(STG, "VISITS").collect()] == [4]


def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def test_a_batch_rewrites_its_own_folders(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), slots=32)
    load_rows(wh, VISITS, texts(spark, [(k, "first", 1) for k in range(200)] + [(None, "loose", 1)]), START)
    folder = tmp_path / "stg" / "VISITS" / "by_key_32"
    before, n_before = files(folder), wh.read(STG, "VISITS").count()
    result = load_rows(wh, VISITS, texts(spark, [(7, "second", 2), (1000, "new", 1)]), START + timedelta(1))
    after = files(folder)
    assert result.affected_rows == 2 and wh.read(STG, "VISITS").count() == n_before + 1
    touched = {f.split("/")[0] for f in before ^ after}
    assert 2 <= len(touched) <= 3 and touched - {f"{SLOT}=-1"} < {f"{SLOT}={k}" for k in range(32)}
    assert len(before & after) >= 28
    rows = {r.ID: r.NOTE for r in wh.read(STG, "VISITS").collect()}
    assert rows[7] == "second" and rows[8] == "first" and rows[1000] == "new" and rows[None] == "loose"


def test_only_touched_folders_are_read(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), slots=8)
    load_rows(wh, VISITS, texts(spark, [(k, "first", 1) for k in range(50)]), START)
    table = wh.keyed(STG, "VISITS", VISITS.keys)
    batch = spark.createDataFrame([(3, "x", 5, None)], "ID long, NOTE string, CHANGED long, _wrong_types array<string>")
    plans = []

    def merged(target, rows):
        out = merge_day(target, rows, START, VISITS.keys, VISITS.guard)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    assert len(table.merge(batch, dated(batch, START, "CHANGED").limit(0), merged)) == 1
    assert "PartitionFilters: [(_slot" in plans[0] or "_slot#" in plans[0].split("PartitionFilters: [")[1][:60]


def test_a_cut_off_write_is_finished(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), 4)
    first = spark.createDataFrame([(k, "a") for k in range(20)], "id long, note string")
    table.merge(first, first.limit(0), lambda old, new: new)
    # The next content is complete beside the table, but its folders were not replaced.
    next_rows = first.withColumn("note", F.lit("b")).withColumn(SLOT, table.slot())
    next_rows.write.partitionBy(SLOT).parquet(table._pending)
    again = KeyedTable(spark, str(tmp_path / "t"), ("id",), 4)
    assert {r.note for r in again.rows().collect()} == {"b"} and again.rows().count() == 20
    # One that is not complete is dropped.
    next_rows.withColumn("note", F.lit("c")).write.partitionBy(SLOT).parquet(table._pending)
    (tmp_path / "t_pending" / "_SUCCESS").unlink()
    assert {r.note for r in again.rows().collect()} == {"b"}
