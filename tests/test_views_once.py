"""Reconciliation builds each view once."""

from datetime import date

from wardhouse.plans.reconciliation import view_failures

DAY = date(2026, 4, 29)


def test_checks_of_views_read_their_ids_only(spark, tmp_path):
    def held(name, rows, schema):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    views = {
        "vw_avg_age_by_pathology": held("age", [(1, DAY), (2, DAY), (None, DAY)], "patient_id long, report_date date"),
        "vw_top_medication_by_pathology": held("med", [("m", 2.0), ("m", 9.0)], "medicine_code string, total_quantity double"),
        "vw_rooms_by_pathology": held("used", [(5,), (5,), (6,)], "room_number long"),
        "vw_doctor_speciality_by_pathology": held("spec", [(7,)], "staff_id long"),
        "vw_patients_one_night": held("night", [(50.0, 2)], "one_night_plus_pct double, total_hospitalisations long"),
        "vw_empty_rooms": held("grid", [(5,), (6,), (5,)], "room_num long"),
    }
    rooms = held("room", [(5,), (6,)], "room_num long")
    stay = "ID_HOSPI long, ID_CONSULT long, NO_CHAMBRE long, TS_DEBUT_HOSPI date, ID_PERSONNEL_RESP long"
    sources = {
        "PATIENT": held("patient", [(1,)], "ID_PATIENT long"),
        "PERSONNEL": held("staff", [(7,)], "ID_PERSONNEL long"),
        "CONSULTATION": held("consult", [(DAY,)], "batch_dt date"),
        "TRAITEMENT": held("treat", [("m", 4), ("m", 6)], "CD_MEDICAMENT string, QTE_MEDICAMENT long"),
        "HOSPITALISATION": held("stay", [(1, 1, 5, DAY, 7), (2, 1, 5, DAY, 7)], stay),
    }
    out = view_failures(views, rooms, sources)
    found = sorted((r.src_table, r.check, r.detail, r.n_failed) for r in out.collect())
    assert found == [
        ("vw_avg_age_by_pathology", "source PATIENT", "patient_id", 1),
        ("vw_top_medication_by_pathology", "reconcile", "no more than prescribed", 1),
    ]
    read = " ".join(out.inputFiles())
    for view in ("age", "med", "used", "spec", "grid", "treat"):
        assert f"{tmp_path}/{view}/" not in read, view


def test_refreshed_days_are_written_once(spark, tmp_path, monkeypatch):
    from test_refresh import marts

    from wardhouse.plans import refresh as R

    built, folders = set(), R.child_folders

    def seen(session, path):
        if "view-days" in path:
            built.update(p.rsplit("/", 1)[1] for p in session.read.parquet(path).inputFiles())
        return folders(session, path)

    monkeypatch.setattr(R, "child_folders", seen)
    new = marts(spark, 3, {})
    path = str(tmp_path / "view")
    days = R.refresh(spark, path, "vw_rooms_by_pathology", {n: df.limit(0) for n, df in new.items()}, new)
    assert days and {p.name for p in (tmp_path / "view").rglob("*.parquet")} == built
