"""Data-quality checks and the reject table."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardhouse import contracts as C
from wardhouse.operators import checks, rejects
from wardhouse.operators.normalise import normalise_consultation, wrong_types
from wardhouse.operators.quality import gate
from wardhouse.plans import assertions, kpis

AT = datetime(2026, 4, 29, 6)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", 1), (1, "b", 1), (2, None, 2), (None, "z", 3), (None, "a", None)],
        "id long, s string, p long",
    )


def test_checks_return_what_fails(spark, rows):
    got = {tuple(r) for r in checks.null_counts(rows, ["id", "s", "p"]).collect()}
    assert got == {("id", 2), ("s", 1), ("p", 1)}
    assert [tuple(r) for r in checks.duplicate_keys(rows, ["id"]).collect()] == [(1, 2)]
    assert checks.duplicate_keys(rows, ["id", "s"]).isEmpty()
    assert checks.duplicate_keys(rows, ["id"], "s = 'a'").isEmpty()
    bad = checks.unexpected_values(rows, "s", ["a", "b"])
    assert [tuple(r) for r in bad.collect()] == [("z", 1)]
    assert checks.unexpected_values(rows, "s", ["a", "b"], "id = 1").isEmpty()
    parent = spark.createDataFrame([(1,)], "pk long")
    lost = checks.orphans(rows, ["p"], parent, ["pk"])
    assert {tuple(r) for r in lost.collect()} == {(2, 1), (3, 1)}
    assert [tuple(r) for r in checks.orphans(rows, ["p"], parent, ["pk"], "p < 3").collect()] == [(2, 1)]
    assert checks.failing_rows(rows, "p > 2", ["p"]).collect()[0]["p"] == 3
    assert checks.population_missing(rows, "s = 'a'", "no a").isEmpty()
    assert checks.population_missing(rows, "s = 'q'", "no q").first()[0] == "no q"
    assert [r[0] for r in checks.unknown_ids(rows, "p", parent, "pk").orderBy("p").collect()] == [2, 3]


def test_reconcile(spark, rows):
    other = spark.createDataFrame([(5,)], "n long")
    got = checks.reconcile(
        {"n": (rows, F.count("*")), "m": (rows, F.max("p")), "k": (other, F.max("n")),
         "none": (other, F.max(F.when(F.col("n") > 9, 1)))},
        {"as many": "n = k", "less": "m > k", "unknown": "none > 0"},
    )
    assert sorted(r[0] for r in got.collect()) == ["less", "unknown"]


def test_declared_checks_are_complete():
    def total(layer, what):
        return sum(len(getattr(e, what)) for e in assertions.LAYERS[layer].values())

    assert total("loaded", "not_null") == 12 and total("loaded", "unique") == 6
    assert total("staged", "not_null") == 34 and total("staged", "unique") == 7
    assert total("work", "not_null") == 30 and total("work", "accepted") == 14
    assert total("marts", "not_null") == 48 and total("marts", "present") == 2
    assert total("views", "not_null") == 27 and total("views", "accepted") == 2


def test_rejects_are_recorded_and_recycled(spark):
    rows = spark.createDataFrame(
        [("M1", "PAIN", None, "n1"), ("M2", None, "B", "n2"), ("M3", "PAIN", "B", "n3")],
        "medicine_code string, medicine_category string, manufacturer_brand string,"
        " medicine_name string",
    )
    table = C.MEDICAMENT
    first = gate(rows, table.rules, table.staged_keys, table.latest_by, date(2026, 4, 29), 7)
    records = rejects.reject_records(first, "MEDICAMENT", table.staged_keys, AT)
    assert {r["src_pk_val"] for r in records.collect()} == {"M1|PAIN|?", "M2|?|B"}
    assert len({r["rej_id"] for r in records.collect()}) == 2
    report = rejects.reject_report(records).first()
    assert (report["nb_rejets"], report["nb_recycles"], report["nb_en_attente"]) == (2, 0, 2)
    fixed = records.filter("src_pk_val = 'M1|PAIN|?'").select(
        "rej_id", F.expr("replace(src_row_json, '}', ',\"manufacturer_brand\":\"B\"}')")
        .alias("src_row_json"),
    )
    again = rejects.corrected_rows(fixed, rows.schema.simpleString())
    gated = gate(again, table.rules, table.staged_keys, table.latest_by)
    assert gated.select(*rows.columns, "wrk_stts_cd").first() == ("M1", "PAIN", "B", "n1", "OK")
    marked = rejects.mark_recycled(records, fixed, AT, 8)
    state = {r["src_pk_val"]: (r["recycl_ind"], r["recycl_exec_id"]) for r in marked.collect()}
    assert state == {"M1|PAIN|?": (1, 8), "M2|?|B": (0, None)}
    # Marking again does not move the date of what is already recycled.
    later = rejects.mark_recycled(marked, fixed, datetime(2027, 1, 1), 9)
    assert {r["recycl_exec_id"] for r in later.collect()} == {8, None}


def test_promotion_gate(spark):
    def gated(bad, good):
        return spark.createDataFrame(
            [("REJ", date(2026, 4, 29))] * bad + [("OK", date(2026, 4, 29))] * good,
            "wrk_stts_cd string, batch_dt date",
        )

    rates = rejects.reject_rates({"A": gated(5, 95), "B": gated(1, 99)})
    assert rates.filter("is_alert").isEmpty()
    rejects.require_promotion(rates, {"load": "OK"}, {"part_id": 0})
    noisy = rejects.reject_rates({"A": gated(6, 94), "B": gated(1, 99)})
    for args in ((noisy, {"load": "OK"}, {}), (rates, {"load": "KO"}, {}),
                 (rates, {"load": "OK"}, {"part_id": 2})):
        with pytest.raises(ValueError, match="not promoted"):
            rejects.require_promotion(*args)


def test_normalised_units(spark):
    df = spark.sql(
        "SELECT CAST(t AS DECIMAL(5,2)) AS patient_temperature, u AS temperature_unit,"
        " b AS diabetes_indicator, NOT b AS hospitalisation_indicator FROM VALUES"
        " (212, 'F', true), (38, 'C', false), (37, 'K', NULL), (NULL, 'F', true) AS v(t, u, b)"
    )
    got = [(r["patn_temp_c"], r["dibt_ind"], r["hosp_ind"])
           for r in normalise_consultation(df).collect()]
    assert got == [(100.0, 1, 0), (38.0, 0, 1), (None, None, None), (None, 1, 0)]


def test_wrong_types(spark):
    names = C.CHAMBRE.header
    df = spark.createDataFrame(
        [("1", "R", "0", "A", "T", "10", "1999-03-01"), ("x", "R", "0", "A", "T", "10", ""),
         ("2", "R", "", "A", "T", "10", "soon")],
        ", ".join(f"{n} string" for n in names),
    )
    got = [(r["rej_cod"], r["rej_dsc"]) for r in wrong_types(df, C.CHAMBRE).collect()]
    assert got == [
        (None, None), ("WRONG_TYPE", "NO_CHAMBRE is not of type integer"),
        ("WRONG_TYPE", "DT_CREATION is not of type date"),
    ]


def test_rollups_count_after_the_period(spark):
    grid = spark.createDataFrame(
        [(date(2026, 4, 29), 1, 1), (date(2026, 4, 29), 2, 0), (date(2026, 4, 30), 1, 1),
         (date(2026, 4, 30), 2, 0), (date(2026, 5, 1), 1, 0), (date(2026, 5, 1), 2, 1)],
        "report_date date, room_num long, is_occupied int",
    )
    got = {r["period"]: tuple(r)[1:] for r in kpis.occupancy_rollup(grid, "month").collect()}
    assert got == {date(2026, 4, 1): (1, 2, 1), date(2026, 5, 1): (1, 2, 1)}
    assert tuple(kpis.occupancy_rollup(grid, "year").first())[1:] == (2, 2, 0)
    april = kpis.in_period(grid, date(2026, 4, 30), date(2026, 4, 30))
    assert tuple(kpis.occupancy_rollup(april, "day").first()) == (date(2026, 4, 30), 1, 2, 1)
    meds = spark.createDataFrame(
        [("P", date(2026, 4, 1), "A", "a", "c", "b", 2), ("P", date(2026, 4, 2), "B", "b", "c", "b", 3),
         ("P", date(2026, 4, 3), "A", "a", "c", "b", 2)],
        "pathology_description string, report_date date, medicine_code string,"
        " medicine_name string, medicine_category string, manufacturer_brand string,"
        " total_quantity long",
    )
    top = kpis.top_medication_rollup(meds, "month", 1).collect()
    assert [(r["medicine_code"], r["total_quantity"], r["medication_rank"]) for r in top] == [("A", 4, 1)]
