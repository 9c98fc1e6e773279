"""A day is merged in one join and written once; tables are loaded side by side."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_late_days import START, days, replayed

from wardhouse.operators.load import OWN, dated, merge_day
from wardhouse.session import at_once
from wardhouse.sources.files import child_files
from wardhouse.sources.keyed import SLOT, KeyedTable

SCHEMA = "id long, note string, changed int"


@pytest.fixture
def nothing_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("guard", ["changed", None])
def test_large_batches_in_any_order_meet_the_table_once(spark, nothing_small, guard):
    batches = days(11, 3)
    for order in (sorted(batches, reverse=True), [*sorted(batches)[1:], min(batches)]):
        table = None
        for day in (*order, order[0]):
            batch = spark.createDataFrame(batches[day], SCHEMA).coalesce(1)
            table = dated(batch, day, guard).limit(0) if table is None else table
            merged = merge_day(table, batch, day, ["id"], guard)
            assert merged._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 1
            table = spark.createDataFrame(merged.collect(), table.schema).coalesce(1)
        got = sorted((tuple(r) for r in table.drop(*OWN).collect()), key=repr)
        assert got == replayed(batches, guard), order


def test_counters_of_a_large_batch(spark, nothing_small):
    from pyspark.sql import Observation

    first = spark.createDataFrame([(1, "a", 1), (2, "a", 5), (None, "a", 1)], SCHEMA)
    table = dated(first, START, "changed")
    batch = spark.createDataFrame([(1, "b", 2), (2, "b", 4), (3, "b", 1), (None, "b", 1)], SCHEMA)
    updates, inserts = Observation(), Observation()
    merged = merge_day(table, batch, START + timedelta(1), ["id"], "changed", updates, inserts)
    assert merged.count() == 5
    assert (updates.get["n"], inserts.get["n"]) == (1, 2)


def test_the_files_of_a_merge_are_not_written_again(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), 4)
    first = spark.createDataFrame([(k, "a") for k in range(20)], "id long, note string")
    written = {}
    publish = KeyedTable._publish

    def seen(self):
        written.update({p.name: p.parent.name for p in (tmp_path / "t_pending").rglob("*.parquet")})
        publish(self)

    monkeypatch.setattr(KeyedTable, "_publish", seen)
    table.merge(first, first.limit(0), lambda old, new: new)
    assert {p.name: p.parent.name for p in (tmp_path / "t").rglob("*.parquet")} == written


def test_files_half_moved_are_moved_on(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), 2)
    first = spark.createDataFrame([(k, "a") for k in range(40)], "id long, note string")
    table.merge(first, first.limit(0), lambda old, new: new)
    after = first.withColumn("note", F.lit("b")).withColumn(SLOT, table.slot()).repartition(3)
    after.write.partitionBy(SLOT).parquet(table._pending)
    # One folder is through; of the other, old files are gone and one new one has moved.
    for slot, n in ((0, 99), (1, 1)):
        old, new = tmp_path / "t" / f"{SLOT}={slot}", tmp_path / "t_pending" / f"{SLOT}={slot}"
        names = child_files(spark, str(new), ".parquet")
        for p in old.glob("*.parquet"):
            p.unlink()
        for name in names[:n]:
            (new / name).rename(old / name)
    again = KeyedTable(spark, str(tmp_path / "t"), ("id",), 2)
    assert sorted((r.id, r.note) for r in again.rows().collect()) == [(k, "b") for k in range(40)]


def test_steps_side_by_side_keep_their_order_and_the_first_failure():
    assert at_once([lambda k=k: k * k for k in range(9)]) == [k * k for k in range(9)]
    assert at_once([]) == []

    def fails(text):
        raise ValueError(text)

    with pytest.raises(ValueError, match="one"):
        at_once([lambda: 0, lambda: fails("one"), lambda: fails("two")])
