"""Text read in splits where records span lines; roll-ups from states and masks."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from wardhouse.plans import kpis
from wardhouse.sources import batch_files


def extract(rng, n):
    lines = []
    for k in range(n):
        note = rng.choice(["plain", '"a; b"', '"two\nlines"', '"say ""hi""\n\n"', '"\n"', "", '""', '"cr\r\nlf"'])
        lines.append(f"{k};{note};{rng.choice(['x', '', 'é'])}")
        if rng.random() < 0.1:
            lines.append(rng.choice(["", "  "]))
    return "id;note;last\n" + "\n".join(lines) + "\n"


@pytest.mark.parametrize("size", [40, 300, 1_000_000])
def test_records_over_lines_in_any_split(spark, tmp_path, size):
    rng = random.Random(size)
    path = tmp_path / "T.txt"
    path.mkdir()
    for part in range(3):
        (path / f"part-{part}.txt").write_text(extract(rng, 30), encoding="utf-8", newline="")
    whole = (
        spark.read.options(**batch_files.CSV_OPTIONS).option("multiLine", "true")
        .schema(batch_files.text_schema(["id", "note", "last"])).csv(str(path))
    )
    # A line of blanks is no record, as where no record spans lines.
    want = sorted((tuple(r) for r in whole.collect() if r.id.strip()), key=repr)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert size > 1000 or batch_files._lines(spark, str(path)).rdd.getNumPartitions() > 8
        got = batch_files.read_text_table(spark, str(path))
        assert got.columns == ["id", "note", "last"]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_record_longer_than_many_splits(spark, tmp_path):
    long = "\n".join(f"line {k}" for k in range(500))
    text = "id;note\n" + "".join(f"{k};short\n" for k in range(50)) + f'50;"{long}"\n51;end\n'
    (tmp_path / "T.txt").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        got = {r.id: r.note for r in batch_files.read_text_table(spark, str(tmp_path / "T.txt")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(k): "short" for k in range(50)} | {"50": long, "51": "end"}


def test_differing_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.txt").write_text('id;note\n1;"x\ny"\n')
    (tmp_path / "b.txt").write_text("note;id\nx;2\n")
    with pytest.raises(ValueError, match="different header"):
        batch_files.text_records(spark, str(tmp_path))


def test_rollups_from_daily_states(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice("pq"), rng.choice([1, 5, 32768, 32769, 99_999]), rng.randrange(90), rng.choice("st"),
         date(2026, 4, rng.randrange(20, 31)) if rng.random() < 0.5 else date(2026, 5, rng.randrange(1, 9)))
        for _ in range(200)
    ]
    view = spark.createDataFrame(
        rows, "pathology_description string, patient_id long, age_at_consultation long, specialty string,"
        " report_date date",
    ).withColumns({"room_number": F.col("patient_id"), "staff_id": F.col("patient_id")})
    for state, from_states, rollup in (
        (kpis.AGE_STATE, kpis.age_from_states, kpis.age_rollup),
        (kpis.ROOM_STATE, kpis.rooms_from_states, kpis.rooms_rollup),
        (kpis.SPECIALTY_STATE, kpis.specialty_from_states, kpis.specialty_rollup),
    ):
        for period in ("month", "year"):
            got = from_states(kpis.daily_state(view, **state), period)
            want = rollup(view, period).select(got.columns)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
            assert "istinct" not in got._jdf.queryExecution().executedPlan().toString()


def test_occupancy_on_masks(spark):
    rng = random.Random(9)
    consults = [(f"2024-0{rng.randrange(1, 4)}-{rng.randrange(1, 29):02d} 09:00:00",) for _ in range(30)]
    stays = []
    for _ in range(40):
        month, day = rng.randrange(1, 4), rng.randrange(1, 25)
        end = rng.choice([None, f"2024-0{month}-{day + rng.randrange(4):02d} 10:00:00", f"2024-0{month + 1}-02 10:00:00"])
        stays.append((rng.randrange(1, 9), f"2024-0{month}-{day:02d} 08:00:00", end))
    fact = spark.createDataFrame(consults, "started_at string").select(F.col("started_at").cast("timestamp_ntz"))
    hospi = spark.createDataFrame(stays, "room_number long, started_at string, ended_at string").select(
        "room_number", *[F.col(c).cast("timestamp_ntz") for c in ("started_at", "ended_at")]
    )
    room = spark.createDataFrame([(k, f"R{k}", "t", "b") for k in range(1, 8)],
                                 "room_num long, room_name string, room_typ string, buld_name string")
    grid = kpis.empty_rooms(fact, hospi, room)
    for period, since in (("day", date(2024, 1, 20)), ("month", None), ("year", None)):
        got = kpis.occupancy_periods(fact, hospi, room, period, since)
        want = kpis.occupancy_rollup(kpis.in_period(grid, since), period)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), period
    text = kpis.occupancy_periods(fact, hospi, room, "month")._jdf.queryExecution().executedPlan().toString()
    assert "sequence(1, 31" not in text
    assert kpis.occupancy_periods(fact.limit(0), hospi, room, "month").count() == 0
