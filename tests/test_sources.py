"""Batch files, contract checks, warehouse snapshots, archive."""

from datetime import date, datetime

import pytest

import hospital as H
from wardhouse import contracts as C
from wardhouse.plans import daily
from wardhouse.operators.surrogate import dense_key
from wardhouse.session import drop_work_tables, shared_dir, work_path
from wardhouse.sources import archive, batch_files
from wardhouse.sources.warehouse import OBS, STG, Warehouse
from wardhouse.streaming.incremental import follow


def test_layout():
    assert batch_files.batch_file("/in/", H.DAY1, "PATIENT") == (
        "/in/BDD_HOSPITAL_20260429/PATIENT_20260429.txt"
    )
    assert batch_files.parse_batch_date("2026-04-29") == H.DAY1
    for wrong in ("20260429", "29/04/2026", "2026-13-01", ""):
        with pytest.raises(ValueError):
            batch_files.parse_batch_date(wrong)


def test_contract_order_and_keys():
    assert list(C.TABLES) == [
        "PATIENT", "PERSONNEL", "CHAMBRE", "MEDICAMENT", "CONSULTATION", "TRAITEMENT",
        "HOSPITALISATION",
    ]
    assert [t.name for t in C.TABLES.values() if t.load == "full"] == [
        "PERSONNEL", "CHAMBRE", "MEDICAMENT",
    ]
    assert [t.name for t in C.TABLES.values() if t.guard] == ["PATIENT"]
    assert C.HOSPITALISATION.header[1] == "ID_CONSULT_hospi"
    assert C.HOSPITALISATION.columns[1].target == "ID_CONSULT"
    with pytest.raises(ValueError):
        C.table("UNKNOWN")


def summary(spark, root, name):
    return batch_files.validate_batch(spark, str(root), H.DAY1, name).first().asDict()


def test_valid_and_broken_headers(spark, tmp_path):
    header = list(C.CHAMBRE.header)
    H.write_extract(tmp_path, H.DAY1, "CHAMBRE", H.rooms())
    got = summary(spark, tmp_path, "CHAMBRE")
    assert got["row_count"] == 787 and got["is_valid"] and got["missing_columns"] == []

    H.write_extract(tmp_path, H.DAY1, "CHAMBRE", ["1;a;b"], ["NO_CHAMBRE", "nom_chambre", "X"])
    got = summary(spark, tmp_path, "CHAMBRE")
    assert not got["is_valid"] and got["extra_columns"] == ["X", "nom_chambre"]
    assert got["missing_columns"] == sorted(set(header) - {"NO_CHAMBRE"})

    # Order does not matter: values follow their names.
    H.write_extract(tmp_path, H.DAY1, "CHAMBRE", ["1999-03-01;1;R;0;A;T;10"],
                    [header[-1], *header[:-1]])
    raw = batch_files.read_batch(spark, str(tmp_path), H.DAY1, "CHAMBRE")
    assert raw.first()["DT_CREATION"] == "1999-03-01"
    batch_files.require_contract(raw, C.CHAMBRE, H.DAY1)

    # A header alone counts as no columns.
    H.write_extract(tmp_path, H.DAY1, "CHAMBRE", [])
    got = summary(spark, tmp_path, "CHAMBRE")
    assert got["row_count"] == 0 and got["missing_columns"] == sorted(header)
    raw = batch_files.read_batch(spark, str(tmp_path), H.DAY1, "CHAMBRE")
    with pytest.raises(ValueError, match="invalid extract CHAMBRE"):
        batch_files.require_contract(raw, C.CHAMBRE, H.DAY1)

    batch_files_path = H.write_extract(tmp_path, H.DAY1, "CHAMBRE", [])
    batch_files_path.write_text("")
    assert summary(spark, tmp_path, "CHAMBRE")["missing_columns"] == sorted(header)

    with pytest.raises(FileNotFoundError):
        summary(spark, tmp_path, "PATIENT")
    with pytest.raises(ValueError):
        summary(spark, tmp_path, "NOPE")


def test_quotes_blank_lines_and_ragged_rows(spark, tmp_path):
    rows = ['1;"Say ""hi""; now";0;A;T;10;1999-03-01', "", "2;short;0", "3;long;0;A;T;10;1999-03-01;more"]
    H.write_extract(tmp_path, H.DAY1, "CHAMBRE", rows)
    got = batch_files.read_batch(spark, str(tmp_path), H.DAY1, "CHAMBRE").collect()
    assert [r["NO_CHAMBRE"] for r in got] == ["1", "2", "3"]
    assert got[0]["NOM_CHAMBRE"] == 'Say "hi"; now' and got[1]["DT_CREATION"] is None


def test_records_over_several_lines(spark, tmp_path):
    path = H.write_extract(tmp_path, H.DAY1, "CHAMBRE", ['1;"two\nlines";0;A;T;10;1999-03-01'])
    assert batch_files.has_multiline_records(spark, str(path))
    got = batch_files.read_batch(spark, str(tmp_path), H.DAY1, "CHAMBRE").collect()
    assert len(got) == 1 and got[0]["NOM_CHAMBRE"] == "two\nlines"


def test_shards_with_differing_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "BDD_HOSPITAL_20260429" / "CHAMBRE_20260429.txt"
    folder.mkdir(parents=True)
    header = list(C.CHAMBRE.header)
    (folder / "a.txt").write_text(";".join(header) + "\n1;R;0;A;T;10;1999-03-01\n")
    (folder / "b.txt").write_text(";".join(header) + "\n2;R;0;A;T;10;1999-03-01\n")
    raw = batch_files.read_batch(spark, str(tmp_path), H.DAY1, "CHAMBRE")
    assert raw.count() == 2 and raw.select("NO_CHAMBRE").distinct().count() == 2
    (folder / "b.txt").write_text(";".join([header[1], header[0], *header[2:]]) + "\nR;2;0;A;T;1;x\n")
    raw = batch_files.read_batch(spark, str(tmp_path), H.DAY1, "CHAMBRE")
    with pytest.raises(Exception, match="header"):
        raw.collect()


def test_all_tables(spark, tmp_path):
    H.write_batch(tmp_path, H.DAY1)
    summaries = batch_files.validate_all_tables(spark, str(tmp_path), H.DAY1)
    assert [r["src_table"] for r in summaries.orderBy("position").collect()] == list(C.TABLES)
    assert tuple(batch_files.passed(summaries).first()) == (H.DAY1, 7, 7)


def test_a_broken_file_stops_the_batch_before_its_table_is_written(spark, tmp_path):
    H.write_batch(tmp_path / "in", H.DAY1)
    H.write_extract(tmp_path / "in", H.DAY1, "CHAMBRE", ["1"], ["NO_CHAMBRE"])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(ValueError, match="CHAMBRE"):
        daily.ingest_batch(wh, str(tmp_path / "in"), H.DAY1)
    written = [n for n in C.TABLES if wh.exists(STG, n)]
    assert written == ["PATIENT", "PERSONNEL"]
    with pytest.raises(LookupError):
        wh.read(STG, "CHAMBRE")


def test_replay_runs_oldest_first(spark, tmp_path):
    for day in (H.DAY1, H.DAY2):
        H.write_batch(tmp_path / "in", day)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    results = daily.replay_batches(wh, str(tmp_path / "in"), [H.DAY2, H.DAY1])
    counts = [(r.table, r.affected_rows) for r in results if r.table == "PATIENT"]
    # Four inserts, then one update (newer) and two inserts.
    assert counts == [("PATIENT", 4), ("PATIENT", 3)]


def test_followed_files_equal_replayed_batches(spark, tmp_path):
    root, inputs = tmp_path, tmp_path / "in"
    H.write_batch(inputs, H.DAY1)
    wh = Warehouse(spark, str(root / "wh"))
    seen = str(root / "seen")
    follow(wh, str(inputs), C.PATIENT, seen).awaitTermination()
    H.write_batch(inputs, H.DAY2)
    follow(wh, str(inputs), C.PATIENT, seen).awaitTermination()
    follow(wh, str(inputs), C.PATIENT, seen).awaitTermination()
    names = {r["ID_PATIENT"]: r["NOM_PATIENT"] for r in wh.read(STG, "PATIENT").collect()}
    assert names == {0: "Zero", 1: "Un-bis", 2: "Deux", 3: "Trois", 4: "Quatre", 5: "Cinq"}
    days = {r["batch_dt"] for r in spark.read.parquet(wh.path(OBS, "PATIENT")).collect()}
    assert days == {H.DAY1, H.DAY2}


def test_followed_days_are_read_like_batches(spark, tmp_path):
    """Records over two lines, another column order, and a shard that comes later."""
    inputs, seen = tmp_path / "in", str(tmp_path / "seen")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    header = list(C.MEDICAMENT.header)
    turned = header[::-1]
    folder = inputs / "BDD_HOSPITAL_20260429" / "MEDICAMENT_20260429.txt"
    folder.mkdir(parents=True)
    rows = {"a.txt": ['A;"line one\nline two";box;cat;brand', "B;plain;box;cat;brand"]}
    rows["b.txt"] = ["C;late;box;cat;brand"]
    (folder / "a.txt").write_text("\n".join([";".join(header), *rows["a.txt"]]) + "\n")
    follow(wh, str(inputs), C.MEDICAMENT, seen).awaitTermination()
    assert wh.read(STG, "MEDICAMENT").count() == 2
    (folder / "b.txt").write_text("\n".join([";".join(header), *rows["b.txt"]]) + "\n")
    follow(wh, str(inputs), C.MEDICAMENT, seen).awaitTermination()
    got = wh.read(STG, "MEDICAMENT")
    key = got.columns[0]
    assert {r[0] for r in got.select(key).collect()} == {"A", "B", "C"}
    values = {v for r in got.collect() for v in r}
    assert "line one\nline two" in values
    H.write_extract(inputs, H.DAY2, "MEDICAMENT", ["brand;cat;box;turned;D"], turned)
    follow(wh, str(inputs), C.MEDICAMENT, seen).awaitTermination()
    assert [r[0] for r in wh.read(STG, "MEDICAMENT").select(key).collect()] == ["D"]


def test_followed_day_without_rows_is_refused(spark, tmp_path):
    inputs = tmp_path / "in"
    H.write_extract(inputs, H.DAY1, "MEDICAMENT", [])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(Exception, match="invalid extract"):
        follow(wh, str(inputs), C.MEDICAMENT, str(tmp_path / "seen")).awaitTermination()


def test_archive(spark, tmp_path):
    path, at = str(tmp_path / "obs"), datetime(2026, 4, 29, 6)
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    archive.write_archive(archive.archived(rows(1, 2), date(2025, 1, 1), at, 1), path)
    archive.write_archive(archive.archived(rows(3), date(2026, 3, 29), at, 2), path)
    archive.write_archive(archive.archived(rows(4, 5), date(2026, 4, 29), at, 3), path)
    archive.write_archive(archive.archived(rows(6), date(2026, 4, 29), at, 4), path)
    assert [r["id"] for r in archive.replay(spark, path, date(2026, 4, 29)).collect()] == [6]
    kept = archive.retained(spark.read.parquet(path), date(2026, 4, 29), 1)
    assert sorted(r["id"] for r in kept.collect()) == [3, 6]
    assert archive.purge(spark, path, date(2026, 4, 29), 13) == [date(2025, 1, 1)]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [3, 6]
    assert archive.purge(spark, str(tmp_path / "none"), date(2026, 4, 29), 13) == []


def test_the_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_work_tables_can_be_dropped(spark):
    path = work_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert path.startswith(shared_dir(spark)) and spark.read.parquet(path).count() == 3
    drop_work_tables(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert dense_key(spark.range(3), ["id"], "sk").count() == 3
