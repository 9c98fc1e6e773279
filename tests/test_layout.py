"""Physical layout: what is read in place, pushed down, and never shuffled."""

import re

import pytest
from pyspark.sql import functions as F

import hospital as H
from wardhouse import contracts as C
from wardhouse.operators.load import merge_day
from wardhouse.plans import daily, kpis
from wardhouse.plans.staging import stage
from wardhouse.plans.work import work
from wardhouse.sources.archive import replay
from wardhouse.sources.warehouse import OBS, SOC, STG, WRK, Warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    inputs = tmp_path_factory.mktemp("inputs")
    for day in (H.DAY1, H.DAY2):
        H.write_batch(inputs, day)
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("wh")), buckets=5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for day in (H.DAY1, H.DAY2):
        for name in ("PATIENT", "CONSULTATION", "HOSPITALISATION"):
            daily.ingest_table(wh, str(inputs), day, name)
    yield wh
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_hold_the_same_rows(bucketed):
    names = {r["ID_PATIENT"]: r["NOM_PATIENT"] for r in bucketed.read(STG, "PATIENT").collect()}
    assert names == {0: "Zero", 1: "Un-bis", 2: "Deux", 3: "Trois", 4: "Quatre", 5: "Cinq"}


def test_an_upsert_reads_a_bucketed_target_in_place(bucketed):
    target = bucketed.read(STG, "PATIENT")
    batch = replay(bucketed.spark, bucketed.path(OBS, "PATIENT"), H.DAY2)
    text = plan(merge_day(target, batch, H.DAY2, C.PATIENT.keys, C.PATIENT.guard))
    # Every shuffle has the archived batch below it, none the target.
    for shuffle in re.finditer("Exchange hashpartitioning", text):
        scan = re.search(r"FileScan parquet[^\n]*", text[shuffle.end():])[0]
        assert f"/{OBS}/PATIENT" in scan and "Bucketed: true" not in scan
    # One bucketed scan per join: the matched columns and the held keys.
    assert text.count("Bucketed: true") == 2


def test_dedup_of_a_bucketed_table_needs_no_shuffle(bucketed):
    gated = work(stage(bucketed.read(STG, "CONSULTATION"), C.CONSULTATION), C.CONSULTATION)
    text = plan(gated)
    assert "Exchange" not in text and "WindowGroupLimit" in text


def test_a_forgotten_table_is_registered_over_its_files(bucketed):
    """As in another application, whose catalog knows none of the tables."""
    for name in ("HOSPITALISATION", "CONSULTATION"):
        bucketed.spark.sql(f"DROP TABLE {bucketed._current(STG)[name]['bucketed_as']}")
    again = Warehouse(bucketed.spark, bucketed.root)
    assert again.read(STG, "HOSPITALISATION").count() == 6
    gated = work(stage(again.read(STG, "CONSULTATION"), C.CONSULTATION), C.CONSULTATION)
    text = plan(gated)
    assert "Exchange" not in text and "Bucketed: true" in text


def test_an_empty_bucketed_snapshot_opens_again(bucketed):
    empty = bucketed.read(STG, "PATIENT").limit(0)
    bucketed.write(empty, "empty", "PATIENT", keys=["ID_PATIENT"])
    bucketed.spark.sql(f"DROP TABLE {bucketed._current('empty')['PATIENT']['bucketed_as']}")
    found = bucketed.read("empty", "PATIENT")
    assert found.count() == 0 and found.columns == empty.columns


def test_old_bucketed_snapshots_are_dropped(bucketed):
    assert len(bucketed.drop_old(STG, "PATIENT", keep=1)) == 1
    assert bucketed.read(STG, "PATIENT").count() == 6
    assert not bucketed.exists(WRK, "PATIENT") and not bucketed.exists(SOC, "r_room")


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("room_number"), F.lit("x").alias("room_name"))
    for c in C.CHAMBRE.columns[2:]:
        kind = {"smallint": "int", "varchar": "string"}.get(c.kind, c.kind)
        df = df.withColumn(c.staged, F.lit(None).cast(kind))
    text = plan(work(df, C.CHAMBRE))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "Partial" in after.split("\n", 2)[1] and "Final" in before


def test_a_filter_on_the_status_drops_the_reject_half(spark, tmp_path):
    H.write_extract(tmp_path, H.DAY1, "CHAMBRE", H.rooms(20))
    schema = "room_number long, room_name string, floor_number int, building_name string," \
        " room_type string, day_rate int, created_date date"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "t"))
    gated = work(spark.read.parquet(str(tmp_path / "t")), C.CHAMBRE)
    assert plan(gated).count("FileScan") == 2
    assert plan(gated.filter("wrk_stts_cd = 'OK'")).count("FileScan") == 1
    assert "Exchange" not in plan(gated.filter("wrk_stts_cd = 'REJ'"))


def test_scans_read_only_what_a_view_needs(spark, tmp_path):
    schema = "hospi_id long, consultation_id long, room_number long, responsible_staff_id long," \
        " started_at timestamp_ntz, ended_at timestamp_ntz, cost decimal(10,2), exec_id long," \
        " duration_days long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "t"))
    text = plan(kpis.patients_one_night(spark.read.parquet(str(tmp_path / "t"))))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert read == "started_at:timestamp_ntz,ended_at:timestamp_ntz"


def test_occupancy_never_shuffles_the_grid(spark, tmp_path):
    spark.createDataFrame([], "started_at timestamp_ntz").write.parquet(str(tmp_path / "f"))
    spark.createDataFrame(
        [], "room_number long, started_at timestamp_ntz, ended_at timestamp_ntz"
    ).write.parquet(str(tmp_path / "s"))
    spark.createDataFrame(
        [], "room_num long, room_name string, room_typ string, buld_name string"
    ).write.parquet(str(tmp_path / "r"))
    read = lambda n: spark.read.parquet(str(tmp_path / n))
    text = plan(kpis.empty_rooms(read("f"), read("s"), read("r")))
    assert "NestedLoop" not in text and "Cartesian" not in text
    top = text.split("Join")[0]
    assert "Generate explode" in top and "Exchange" not in top


def test_the_archive_reads_one_partition(spark, tmp_path):
    spark.sql("SELECT 1 AS id, DATE'2026-04-29' AS batch_dt, NULL AS load_dttm, 1 AS exec_id").drop(
        "load_dttm"
    ).write.partitionBy("batch_dt").parquet(str(tmp_path / "a"))
    text = plan(replay(spark, str(tmp_path / "a"), H.DAY1))
    assert re.search(r"PartitionFilters: \[.*batch_dt.* = 2026-04-29", text)
