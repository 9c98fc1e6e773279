"""Views refreshed by the days that changed; the run log merged by day."""

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from wardhouse.plans.audit import RunLog, run_state, step_state
from wardhouse.plans.kpis import VIEWS
from wardhouse.plans.refresh import refresh


def marts(spark, seed, changes):
    """A small star schema; ``changes`` replaces single rows by (table, id)."""
    rng = random.Random(seed)
    at = lambda d, h: f"2026-04-{d:02d} {h:02d}:00:00"
    rows = {
        "r_indiv": [(k, f"19{50 + k}-01-0{k % 9 + 1}") for k in range(1, 9)],
        "r_stf": [(k, rng.choice(["Dentiste", "Chirurgien"])) for k in range(1, 5)],
        "r_room": [(k, f"R{k}", "T", "B") for k in range(1, 6)],
        "r_medc": [(f"M{k}", "C", "B", f"name {k}") for k in range(4)],
        "r_trmt": [(k, f"M{rng.randrange(5)}", "C", "B", rng.randrange(5)) for k in range(60)],
        "fait_consult": [
            (k, rng.randrange(1, 10), rng.randrange(1, 6), k, at(rng.randrange(1, 12), 9), rng.choice(["P", "Q", None]))
            for k in range(60)
        ],
        "r_hospi": [
            (k, k, rng.randrange(1, 7), at(d := rng.randrange(1, 11), 20), rng.choice([None, at(d + 1, 8), at(d + 3, 8)]))
            for k in range(0, 60, 3)
        ],
    }
    for (table, k), row in changes.items():
        rows[table] = [r for r in rows[table] if r[0] != k] + ([row] if row else [])
    schemas = {
        "r_indiv": "indiv_id long, birth_date string", "r_stf": "staff_id long, job_title string",
        "r_room": "room_num long, room_name string, room_typ string, buld_name string",
        "r_medc": "medc_cd string, medc_catg string, manf_brnd string, medc_name string",
        "r_trmt": "treatment_id long, medicine_code string, medicine_category string,"
        " manufacturer_brand string, medicine_quantity int",
        "fait_consult": "consultation_id long, patient_id long, staff_id long, treatment_id long,"
        " started_at string, pathology_description string",
        "r_hospi": "hospi_id long, consultation_id long, room_number long, started_at string, ended_at string",
    }
    out = {}
    for name, schema in schemas.items():
        df = spark.createDataFrame(rows[name], schema).coalesce(1)
        casts = {"birth_date": "date", "started_at": "timestamp_ntz", "ended_at": "timestamp_ntz"}
        out[name] = df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})
    return out


def test_a_refresh_equals_a_full_build(spark, tmp_path):
    old = marts(spark, 1, {})
    new = marts(spark, 1, {
        ("fait_consult", 7): (7, 2, 2, 7, "2026-04-05 12:00:00", "P"),
        ("fait_consult", 8): None,
        ("fait_consult", 99): (99, 3, 1, 9, "2026-04-20 12:00:00", "Q"),
        ("r_indiv", 3): (3, "2001-01-01"), ("r_trmt", 11): (11, "M0", "C", "B", 50),
        ("r_medc", "M2"): ("M2", "C", "B", "other"), ("r_stf", 4): (4, "Cardiologue"),
        ("r_hospi", 12): (12, 12, 2, "2026-04-03 20:00:00", "2026-04-04 07:00:00"),
    })
    for frames in (old, new):  # as the snapshots that a run hands on
        for name, df in frames.items():
            folder = str(tmp_path / f"{id(frames)}{name}")
            df.write.parquet(folder)
            frames[name] = spark.read.parquet(folder)
    none = {n: df.limit(0) for n, df in old.items()}
    for view, build in VIEWS.items():
        path = tmp_path / view
        first = refresh(spark, str(path), view, none, old)
        before = {p.parent.name: p.name for p in path.rglob("*.parquet")}
        days = refresh(spark, str(path), view, old, new)
        after = {p.parent.name: p.name for p in path.rglob("*.parquet")}
        want = build(new)
        stored = spark.read.parquet(str(path)).select(want.columns)
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, want.collect())), view
        rewritten = {d for d in before if before[d] != after.get(d)} | (after.keys() - before.keys())
        assert rewritten <= {f"report_date={d}" for d in days}
        # The changed doctor sees patients on most days; an open stay reaches all later ones.
        some = view not in ("vw_empty_rooms", "vw_doctor_speciality_by_pathology")
        assert 0 < len(days) and (not some or len(days) < len(first)), view
        assert refresh(spark, str(path), view, new, new) == []


def test_events_are_merged_by_day(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    for run in range(3):
        at = datetime(2026, 4, 29 + run % 2, 6, run)
        log.open_run(run, "DAILY", date(2026, 4, 29), at)
        log.close_run(run, run != 1, at.replace(hour=7))
    with log.run(9, "MANUAL"), log.step(9, 90, "today"):
        pass
    state = sorted(map(repr, run_state(log.events()).collect()))
    assert log.compact(date(2026, 5, 1)) == [date(2026, 4, 29), date(2026, 4, 30)]
    assert sorted(map(repr, run_state(log.events()).collect())) == state
    assert [len(list((tmp_path / "log" / f"at_day=2026-04-{d}").glob("*.parquet"))) for d in (29, 30)] == [1, 1]
    assert log.compact(date(2026, 5, 1)) == []
    assert step_state(log.events()).first()["exec_stts_cd"] == "OK"
