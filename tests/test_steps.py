"""Large merges go over the slots in steps, and what a step shuffled is gone when it ends."""

from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_late_days import START, VISITS, texts

from wardhouse.operators.load import OWN, dated, merge_day
from wardhouse.plans.daily import load_rows
from wardhouse.session import _CLEANUP, at_once, shared_dir, shuffles_dropped
from wardhouse.sources import keyed
from wardhouse.sources.keyed import LOOSE, KeyedTable
from wardhouse.sources.warehouse import STG, Warehouse
from warehouse_queries import loads
from warehouse_queries import standins as S

SCHEMA = "id long, note string, changed int"


def shuffle_files(spark):
    """Names of the shuffle files that this machine holds just now."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = {files.apply(n).getName() for n in range(files.length())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


@pytest.fixture
def large(spark, monkeypatch):
    monkeypatch.setattr(keyed, "AT_ONCE", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def merged(table, batch, day, guard, seen=None):
    def of(target, rows):
        if seen is not None:
            seen.append((target, rows))
        return merge_day(target, rows, day, ["id"], guard)

    return table.merge(batch, dated(batch, day, guard).limit(0), of)


def batches(spark):
    """Two days; keys that repeat, that one day names only, and that are NULL."""
    first = [(k % 30, f"a{k}", k % 7) for k in range(50)] + [(None, "a", 1), (None, "a", 1), (31, None, None)]
    second = [(k % 40, f"b{k}", k % 5) for k in range(10, 90)] + [(None, "b", 2), (31, "b", 0)]
    return [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (first, second)]


@pytest.mark.parametrize("guard", ["changed", None])
def test_a_merge_in_steps_gives_the_rows_of_one_step(spark, tmp_path, large, monkeypatch, guard):
    days, got = batches(spark), []
    for name, limit in (("steps", 0), ("whole", 1 << 40)):
        monkeypatch.setattr(keyed, "AT_ONCE", limit)
        table, seen = KeyedTable(spark, str(tmp_path / name), ("id",), 3), []
        for n, batch in enumerate(days):
            assert merged(table, batch, START + timedelta(n), guard, seen) == [LOOSE, 0, 1, 2]
        # Rows without a key, then one slot after the other.
        assert len(seen) == (8 if limit == 0 else 2)
        if limit == 0:
            assert sum(rows.count() for _, rows in seen[4:]) == days[1].count()
            assert all(rows.select(table.slot()).distinct().count() == 1 for _, rows in seen[4:])
        own = [c for c in OWN if c in table.rows().columns]
        rows = table.rows().drop(*own).collect()
        got.append(sorted(map(repr, rows)))
    assert got[0] == got[1] and len(got[0]) == 43


def test_no_step_of_a_merge_leaves_shuffle_files(spark, tmp_path, large):
    first, second = batches(spark)
    table, left = KeyedTable(spark, str(tmp_path / "t"), ("id",), 4), []
    merged(table, first, START, None)
    before, plans = shuffle_files(spark), []

    def of(target, rows):
        # What was shuffled before this step is gone.
        left.append(shuffle_files(spark) - before)
        out = merge_day(target, rows, START + timedelta(1), ["id"])
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    table.merge(second, dated(second, START).limit(0), of)
    assert all("Exchange" in plan for plan in plans) and len(left) == 5
    assert left == [set()] * 5 and not shuffle_files(spark) - before


def test_steps_cut_short_leave_the_table_as_it_was(spark, tmp_path, large):
    first, second = batches(spark)
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), 4)
    merged(table, first, START, None)
    was = sorted(map(repr, table.rows().collect()))
    calls = []

    def fails(target, rows):
        calls.append(1)
        if len(calls) == 3:
            raise ValueError("cut short")
        return merge_day(target, rows, START + timedelta(1), ["id"])

    with pytest.raises(ValueError, match="cut short"):
        table.merge(second, dated(second, START).limit(0), fails)
    assert any(Path(table._pending).rglob("*.parquet")) and not (Path(table._pending) / "_SUCCESS").exists()
    again = KeyedTable(spark, table.path, ("id",), 4)
    assert sorted(map(repr, again.rows().collect())) == was and not Path(table._pending).exists()
    # The day again, whole.
    merged(again, second, START + timedelta(1), None)
    assert {r["id"] for r in again.rows().collect()} >= set(range(40))


def test_steps_without_keys_or_rows(spark, tmp_path, large):
    table = KeyedTable(spark, str(tmp_path / "t"), ("id",), 4)
    none = spark.createDataFrame([(None, "a", 1), (None, "b", 1)], SCHEMA)
    assert merged(table, none, START, "changed") == [LOOSE]
    assert table.rows().count() == 2
    assert merged(table, none.limit(0), START + timedelta(1), "changed") == [LOOSE]
    assert table.rows().count() == 2
    # The day that brought them comes again without them.
    assert merged(table, none.limit(0), START, "changed") == [LOOSE]
    assert not table.exists()


@pytest.mark.parametrize("guarded", [True, False])
def test_counters_of_a_load_in_steps(spark, tmp_path, large, monkeypatch, guarded):
    contract = VISITS if guarded else replace(VISITS, guard=None)
    counts = []
    for name, limit in (("steps", 0), ("whole", 1 << 40)):
        monkeypatch.setattr(keyed, "AT_ONCE", limit)
        wh = Warehouse(spark, str(tmp_path / name), slots=3)
        days = [[(k, "a", 5) for k in range(20)], [(k, "b", k) for k in range(10, 40)] + [(None, "b", 1)]]
        results = [load_rows(wh, contract, texts(spark, d), START + timedelta(n)) for n, d in enumerate(days)]
        counts.append([(r.read_rows, r.affected_rows) for r in results])
        assert wh.read(STG, "VISITS").count() == 41
    assert counts[0] == counts[1] and counts[0][0] == (20, 20) and counts[0][1][0] == 31


def test_the_setting_is_back_after_the_last_block(spark):
    before = spark.conf.get(_CLEANUP, None)

    def inside():
        with shuffles_dropped(spark):
            return spark.conf.get(_CLEANUP)

    with shuffles_dropped(spark):
        assert at_once([inside] * 6) == ["true"] * 6
        assert spark.conf.get(_CLEANUP) == "true"
    assert spark.conf.get(_CLEANUP, None) == before
    spark.conf.set(_CLEANUP, "false")
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get(_CLEANUP) == "false"
    spark.conf.unset(_CLEANUP)
    frame = spark.range(100).groupBy(F.col("id") % 3).count()
    with shuffles_dropped(spark):
        assert frame.count() == 3 and len(frame.collect()) == 3 and len(frame.collect()) == 3


def test_replayed_days_keep_no_tables_beside_their_extracts(spark, tmp_path):
    at = datetime(2024, 1, 10, 8)
    tables = {
        "customer": [(k, f"C{k}", k % 25, 10.5 * k, "BUILDING") for k in range(1, 7)],
        "supplier": [(k, f"S{k}", k % 25, 1.0) for k in range(1, 5)],
        "part": [(k, f"part{k:0{k}d}", "B", "PROMO", k, 1.0) for k in range(1, 5)],
        "lineitem": [(k, k % 4 + 1, 1, n, 3.0, 9.0, 0.0, 0.1, "R", "O", at) for k in range(1, 9) for n in (1, 2)],
        "events": [(k, at, k % 6 + 1, "view", 2.0, f'{{"k": {k}}}') for k in range(1, 12)],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, S.SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    work = Path(shared_dir(spark)) / "work" / spark.sparkContext.applicationId
    known = set(work.iterdir()) if work.exists() else set()
    got = {r["src_table"]: r for r in loads.replay_days(spark, str(tmp_path)).collect()}
    assert {n: (r["read_rows"], r["held_rows"], r["n_days"]) for n, r in got.items()} == {
        "PATIENT": (6, 6, 2), "PERSONNEL": (4, 2, 2), "CHAMBRE": (6, 3, 2), "MEDICAMENT": (4, 2, 2),
        "CONSULTATION": (11, 11, 2), "TRAITEMENT": (16, 16, 2), "HOSPITALISATION": (11, 11, 2),
    }
    new = {p.name.rsplit("-", 1)[0]: p for p in set(work.iterdir()) - known}
    # Of three copies of the rows, the one that texts are made from is gone, and texts are compressed.
    assert set(new) == {"days", "replayed"}
    shards = [p for p in new["days"].rglob("part-*")]
    assert len(shards) >= 14 and all(p.name.endswith(".csv.gz") for p in shards)
