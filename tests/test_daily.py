"""Two daily batches from files to indicator views."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import hospital as H
from wardhouse.contracts import TABLES
from wardhouse.operators import rejects
from wardhouse.plans import daily
from wardhouse.plans.audit import RunLog, lineage, run_state, step_state
from wardhouse.sources.export import run_export
from wardhouse.sources.warehouse import OBS, SOC, STG, TCH, WRK, Warehouse


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    inputs = tmp_path_factory.mktemp("inputs")
    for day in (H.DAY1, H.DAY2):
        H.write_batch(inputs, day)
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    daily.run_day(wh, str(inputs), H.DAY1, 1, 100)
    first = {r["patient_id"]: r["last_name"] for r in daily.staged_tables(wh)["PATIENT"].collect()}
    views = daily.run_day(wh, str(inputs), H.DAY2, 2, 200)
    return wh, str(inputs), first, views


def test_patients_are_upserted_behind_the_guard(two_days):
    wh, _, first, _ = two_days
    assert first == {0: "Zero", 1: "Un", 2: "Deux", 3: "Trois"}
    now = {r["patient_id"]: r["last_name"] for r in daily.staged_tables(wh)["PATIENT"].collect()}
    assert now == {0: "Zero", 1: "Un-bis", 2: "Deux", 3: "Trois", 4: "Quatre", 5: "Cinq"}


def test_other_deltas_have_no_guard(two_days):
    wh = two_days[0]
    weights = {r["consultation_id"]: r["patient_weight_kg"]
               for r in daily.staged_tables(wh)["CONSULTATION"].collect()}
    assert weights[2] == Decimal("61.00") and sorted(weights) == [1, 2, 3, 4, 5, 6]


def test_gates(two_days):
    wh = two_days[0]
    got = {
        name: sorted((r[key], r["wrk_stts_cd"], r["rej_cod"]) for r in wh.read(WRK, name).collect())
        for name, key in (("CONSULTATION", "consultation_id"), ("HOSPITALISATION", "hospi_id"))
    }
    assert got["CONSULTATION"] == [
        (1, "OK", None), (2, "OK", None), (3, "REJ", "WRONG_FORMAT"),
        (4, "REJ", "NULL_MANDATORY"), (5, "OK", None), (6, "OK", None),
    ]
    assert got["HOSPITALISATION"] == [
        (1, "OK", None), (2, "OK", None), (3, "OK", None), (4, "REJ", "WRONG_FORMAT"),
        (5, "REJ", "WRONG_FORMAT"), (6, "OK", None),
    ]
    rooms = wh.read(WRK, "CHAMBRE").groupBy("wrk_stts_cd", "rej_cod").count().collect()
    assert sorted(map(tuple, rooms), key=repr) == [("OK", None, 786), ("REJ", "WRONG_FORMAT", 1)]


def test_medications_keep_the_first_name_and_dense_keys(two_days):
    wh = two_days[0]
    rows = wh.read(SOC, "r_medc").orderBy("medc_id").collect()
    assert [(r["medc_id"], r["medc_cd"], r["medc_name"]) for r in rows] == [
        (1, "M1", "Aspirin"), (2, "M2", None), (3, "M3", "Named"),
    ]


def test_parties(two_days):
    wh = two_days[0]
    rows = wh.read(SOC, "r_part").orderBy("part_id").collect()
    assert [r["part_id"] for r in rows] == list(range(1, len(rows) + 1))
    keys = [(r["src_typ"], r["src_id"]) for r in rows]
    assert keys == sorted(keys) and len(keys) == 4 + 19


def test_fact_durations(two_days):
    wh = two_days[0]
    minutes = {r["consultation_id"]: r["duration_minutes"]
               for r in wh.read(SOC, "fait_consult").collect()}
    # Boundaries are counted: 12:59:59 to 13:00:01 is one minute.
    assert minutes == {1: 30, 2: 10, 5: 1, 6: 45}
    days = {r["hospi_id"]: r["duration_days"] for r in wh.read(SOC, "r_hospi").collect()}
    assert days == {1: 1, 2: 1, 3: 0, 6: None}


def test_views(two_days):
    views = two_days[3]
    age = {(r["patient_id"], r["report_date"]): r["age_at_consultation"]
           for r in views["vw_avg_age_by_pathology"].collect()}
    assert age == {(1, H.DAY1): 45, (2, H.DAY1): 26, (4, H.DAY2): 36}
    meds = {(r["pathology_description"], r["medicine_name"]): r["total_quantity"]
            for r in views["vw_top_medication_by_pathology"].collect()}
    assert meds == {("Grippe", "Aspirin"): 3, ("Angine", "M2"): 0, ("Grippe", "Named"): 7}
    stays = sorted(map(tuple, views["vw_rooms_by_pathology"].collect()))
    assert stays == [
        ("Angine", 101, H.DAY1), ("Angine", 102, H.DAY1), ("Grippe", 104, H.DAY2),
    ]
    spec = sorted(tuple(r)[:3] for r in views["vw_doctor_speciality_by_pathology"].collect())
    assert spec == [("Angine", 2, "Dermatologiste"), ("Grippe", 1, "Chirurgien"),
                    ("Grippe", 1, "Chirurgien")]
    nights = {r["report_date"]: tuple(r)[1:] for r in views["vw_patients_one_night"].collect()}
    assert nights[H.DAY1][:2] == (3, 1) and float(nights[H.DAY1][2]) == 33.33
    assert nights[H.DAY2][:2] == (1, 0) and float(nights[H.DAY2][2]) == 0.0


def test_occupancy_view(two_days):
    view = two_days[3]["vw_empty_rooms"]
    assert view.count() == 786 * 2
    taken = sorted((r["report_date"], r["room_num"]) for r in view.collect() if r["is_occupied"])
    assert taken == [(H.DAY1, 101), (H.DAY1, 102), (H.DAY2, 101), (H.DAY2, 104)]
    labels = {(r["is_occupied"], r["occupancy_status"]) for r in view.collect()}
    assert labels == {(1, "Occupée"), (0, "Libre")}


def test_loading_a_batch_again_changes_nothing(two_days):
    wh, inputs, _, _ = two_days
    before = {n: sorted(map(tuple, wh.read(STG, n).collect()), key=repr) for n in TABLES}
    results = daily.ingest_batch(wh, inputs, H.DAY2)
    after = {n: sorted(map(tuple, wh.read(STG, n).collect()), key=repr) for n in TABLES}
    assert before == after
    counts = {r.table: (r.strategy, r.read_rows, r.affected_rows, r.rejected_rows) for r in results}
    assert counts["CHAMBRE"] == ("full", 787, 787, 0)
    assert counts["PATIENT"] == ("delta", 5, 0, 0)
    assert counts["CONSULTATION"] == ("delta", 2, 2, 0)


def test_run_log(two_days):
    wh = two_days[0]
    events = RunLog(wh.spark, wh.path(TCH, "events")).events()
    runs = {r["run_id"]: r for r in run_state(events).collect()}
    assert {i: (r["run_stts_cd"], r["run_typ"], r["batch_dt"]) for i, r in runs.items()} == {
        1: ("OK", "DAILY", H.DAY1), 2: ("OK", "DAILY", H.DAY2),
    }
    steps = {r["exec_id"]: (r["run_id"], r["scrpt_name"], r["exec_stts_cd"])
             for r in step_state(events).collect()}
    assert len(steps) == 2 * (1 + 7 + 1 + 10)
    assert steps[200] == (2, "ingest_stg", "OK") and steps[118] == (1, "r_hospi", "OK")
    assert steps[108] == (1, "rej_record", "OK")
    # Rows lead back to the step that accepted them, and to its run.
    found = lineage(wh.read(SOC, "r_room"), step_state(events), run_state(events))
    got = found.select("exec_id", "scrpt_name", "run_id", "run_stts_cd").distinct().collect()
    assert [tuple(r) for r in got] == [(203, "wrk_chambre", 2, "OK")] and found.count() == 786


def test_a_noisy_batch_is_not_promoted(two_days):
    wh, inputs, _, _ = two_days
    with pytest.raises(ValueError, match="not promoted"):
        daily.run_day(wh, inputs, H.DAY2, 3, 300, "MANUAL", max_reject_rate=0.05)
    state = run_state(RunLog(wh.spark, wh.path(TCH, "events")).events())
    assert state.filter("run_id = 3").first()["run_stts_cd"] == "KO"


def test_checks_find_only_the_known_gaps(two_days):
    wh = two_days[0]
    failed = {(r["layer"], r["src_table"], r["check"], r["detail"], r["n_failed"])
              for r in daily.check_warehouse(wh).collect()}
    assert ("marts", "r_hospi", "parent r_room", "room_number", 1) in failed
    assert ("staged", "TRAITEMENT", "not_null", "medicine_quantity", 1) in failed
    # Rejected rows keep their NULL key in the work layer.
    assert ("work", "MEDICAMENT", "not_null", "medicine_code", 1) in failed
    assert not [f for f in failed if f[0] == "views"]
    # Two of the six stays with all ids end early or cost less than nothing.
    assert [f[1:] for f in failed if f[0] == "reconciled"] == [
        ("vw_patients_one_night", "reconcile", "every valid stay", 1),
    ]
    assert ("declared", "PATIENT", "not_null", "TS_MAJ_PATIENT", 1) in failed
    assert not [f for f in failed if f[1] == "r_part"]


def test_archive_holds_every_batch(two_days):
    wh, _, _, _ = two_days
    archive = wh.spark.read.parquet(wh.path(OBS, "PATIENT"))
    assert {tuple(r) for r in archive.groupBy("batch_dt").count().collect()} == {
        (H.DAY1, 4), (H.DAY2, 5),
    }
    assert daily.reload_from_archive(wh, "PATIENT", H.DAY2) == 6


def test_export(two_days, tmp_path):
    counts = run_export(two_days[3], str(tmp_path))
    assert counts["vw_empty_rooms"] == 1572 and counts["vw_avg_age_by_pathology"] == 3
    parts = sorted((tmp_path / "vw_avg_age_by_pathology.csv").glob("part-*.csv"))
    head = parts[0].read_bytes().split(b"\n")[0]
    assert head == b"\xef\xbb\xbfPATHOLOGY_DESCRIPTION;PATIENT_ID;REPORT_DATE;AGE_AT_CONSULTATION"
    none = two_days[3]["vw_patients_one_night"].filter("report_date IS NULL")
    assert run_export({"VW_EMPTY": none}, str(tmp_path)) == {"VW_EMPTY": 0}
    parts = sorted((tmp_path / "vw_empty.csv").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text(encoding="utf-8-sig").count("\n") == 1


def test_a_failing_run_is_closed_ko(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(FileNotFoundError):
        daily.run_day(wh, str(tmp_path / "none"), date(2026, 5, 1), 7, 700)
    events = RunLog(spark, wh.path(TCH, "events")).events()
    assert run_state(events).first()["run_stts_cd"] == "KO"
    step = step_state(events).first()
    assert step["exec_stts_cd"] == "KO" and "not found" in step["err_msg"]
    assert step["exec_end_dttm"] >= step["exec_strt_dttm"] > datetime(2020, 1, 1)


def test_reject_table_and_party_model(two_days):
    wh = two_days[0]
    n = daily.build_rejects(wh, H.DAY2)
    # Each row has a finding for everything it breaks, whether it is held back or not.
    assert n == 18 and daily.build_rejects(wh, H.DAY2) == 18
    records = wh.spark.read.parquet(daily.reject_path(wh)).filter(F.col("batch_dt") == H.DAY2)
    found = Counter((r["src_table"], r["rej_cod"], r["wrk_stts_cd"]) for r in records.collect())
    assert found == {
        ("PATIENT", "WRONG_FORMAT", "REJ"): 1, ("PATIENT", "NULL_MANDATORY", "REJ"): 2,
        ("PERSONNEL", "WRONG_FORMAT", "REJ"): 1, ("CHAMBRE", "WRONG_FORMAT", "REJ"): 1,
        ("MEDICAMENT", "NULL_MANDATORY", "REJ"): 1, ("MEDICAMENT", "DUPLICATE_PK", "REJ"): 2,
        ("CONSULTATION", "WRONG_FORMAT", "REJ"): 1, ("CONSULTATION", "NULL_MANDATORY", "REJ"): 1,
        ("CONSULTATION", "WRONG_TYPE", "REJ"): 1, ("CONSULTATION", "NORM_FAILURE", "OK"): 1,
        ("TRAITEMENT", "FK_NOT_FOUND", "OK"): 1, ("HOSPITALISATION", "FK_NOT_FOUND", "OK"): 1,
        ("HOSPITALISATION", "FK_NOT_FOUND", "REJ"): 2, ("HOSPITALISATION", "WRONG_FORMAT", "REJ"): 2,
    }
    assert records.select("rej_id").distinct().count() == 18
    fixed = records.filter("src_table = 'PATIENT'").select("rej_id", "src_row_json")
    daily.recycle_rejects(wh, fixed, H.DAY2, 33)
    again = wh.spark.read.parquet(daily.reject_path(wh)).filter(F.col("batch_dt") == H.DAY2)
    assert {tuple(r) for r in again.groupBy("recycl_ind").count().collect()} == {(0, 15), (1, 3)}
    tables = daily.build_party_tables(wh, H.DAY2, 32)
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {"o_indv": 23, "o_stff": 19, "o_telp": 1, "o_addr": 2, "o_cons": 4,
                      "o_tret": 4, "o_hosp": 4}
    parties = {(r["src_typ"], r["src_id"]): r["part_id"] for r in wh.read(SOC, "r_part").collect()}
    cons = {r["cons_id"]: (r["stff_id"], r["patn_id"]) for r in tables["o_cons"].collect()}
    assert cons[1] == (parties["Chirurgien", 1], parties["Patient", 1])
    medications = {r["tret_id"]: r["medc_id"] for r in tables["o_tret"].collect()}
    assert medications == {1: 1, 2: 2, 3: None, 4: 3}


def test_old_snapshots_are_dropped(two_days):
    wh = two_days[0]
    assert len(wh.drop_old(SOC, "r_room", keep=1)) >= 1
    assert wh.read(SOC, "r_room").count() == 786


def test_corrected_rejects_go_back_once(two_days):
    wh = two_days[0]
    records = wh.spark.read.parquet(daily.reject_path(wh)).filter(F.col("batch_dt") == H.DAY2)
    wrong = records.filter("src_table = 'PATIENT' AND src_pk_val = '5'")
    row = F.from_json("src_row_json", daily.staged_tables(wh)["PATIENT"].schema)
    row = row.withField("first_name", F.lit("Eve")).withField(
        "updated_at", F.lit("2026-04-30 08:00:00").cast("timestamp_ntz")
    )
    fixed = wrong.select("rej_id", F.to_json(row).alias("src_row_json"))
    assert daily.submit_corrections(wh, fixed, 40) == 2
    # Sent again, they are no new attempt.
    assert daily.submit_corrections(wh, fixed, 41) == 0
    assert daily.recycle(wh, H.DAY2, 42) == 2 and daily.recycle(wh, H.DAY2, 43) == 0
    patient = wh.read(STG, "PATIENT").filter("ID_PATIENT = 5").collect()
    assert [(r["PRENOM_PATIENT"], r["NOM_PATIENT"]) for r in patient] == [("Eve", "Cinq")]
    daily.check_table(wh, TABLES["PATIENT"], H.DAY2, 44)
    states = {r["patient_id"]: r["wrk_stts_cd"] for r in wh.read(WRK, "PATIENT").collect()}
    assert states == {0: "REJ", 1: "OK", 2: "OK", 3: "OK", 4: "OK", 5: "OK"}
    state = {(r["src_pk_val"], r["recycl_ind"], r["n_attempts"], r["recycl_exec_id"])
             for r in daily.reject_states(wh).filter("src_table = 'PATIENT'").collect()
             if r["batch_dt"] == H.DAY2}
    assert state == {("5", 1, 1, 42), ("0", 0, 0, None)}
    # A second correction is a second attempt, and a reload of the day does not undo it.
    better = fixed.limit(1).withColumn("src_row_json", F.replace("src_row_json", F.lit("Eve"), F.lit("Ève")))
    assert daily.submit_corrections(wh, better, 45) == 1 and daily.recycle(wh, H.DAY2, 46) == 1
    patient = wh.read(STG, "PATIENT").filter("ID_PATIENT = 5").collect()
    assert [r["PRENOM_PATIENT"] for r in patient] == ["Ève"]


def test_the_gate_stops_on_each_condition(two_days):
    wh = two_days[0]
    figures = wh.spark.createDataFrame(
        [("A", 100, 5, None, None), ("B", 100, 6, None, None), ("C", None, None, "A", 0),
         ("C", None, None, "B", 2), ("D", 0, 0, None, None)], rejects.FIGURES,
    )
    states = wh.spark.createDataFrame([("x", "OK"), ("y", "KO"), ("z", "ENC")], "scrpt_name string, exec_stts_cd string")
    ok = states.filter("exec_stts_cd = 'OK'")

    def blocks(steps, rate, lost):
        return sorted(map(tuple, rejects.promotion_blocks(figures, steps, rate, lost).collect()))

    assert blocks(ok, None, None) == [] and blocks(ok, 0.06, 2) == []
    assert blocks(ok, 0.05, 2) == [("reject rate", "B", "6 of 100")]
    assert blocks(ok, 0.06, 0) == [("unresolved keys", "B of C", "2")]
    assert blocks(states, None, None) == [("step", "y", "KO"), ("step", "z", "ENC")]
    with pytest.raises(ValueError, match="not promoted: unresolved keys B of C: 2"):
        rejects.require_unblocked(rejects.promotion_blocks(figures, ok, None, 0))
