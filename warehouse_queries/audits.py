"""Checks, run tracking, rejects and the party model on the driver's tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Observation
from pyspark.sql import functions as F

from wardhouse import contracts as C
from wardhouse.operators import checks
from wardhouse.operators.fingerprint import differences, fingerprint
from wardhouse.operators.fingerprint import merged as merged_prints
from wardhouse.operators.load import WRONG, typed
from wardhouse.operators.normalise import normalise_consultation, unit_rule, wrong_types
from wardhouse.operators.quality import accepted, check_rows, gate
from wardhouse.operators.references import check_references
from wardhouse.operators.rejects import (
    FIGURES,
    all_findings,
    all_rejects,
    corrected_rows,
    figure_rows,
    mark_recycled,
    promotion_blocks,
    reject_rates,
    reject_report,
    work_figures,
)
from wardhouse.plans import assertions, audit, daily, kpis, marts, party
from wardhouse.plans.reconciliation import view_failures
from wardhouse.plans.staging import stage
from wardhouse.plans.work import checked, work
from wardhouse.session import work_path
from wardhouse.sources.warehouse import STG, WRK, Warehouse
from warehouse_queries import standins as S
from warehouse_queries.gates import BATCH, EXEC, gated, plain, written
from warehouse_queries.loads import ORDERS, order_texts
from warehouse_queries.stars import _AGE, _MED, _NIGHT, _OCC, _ROOMS, _ROOMS_WORK, _SPEC
from warehouse_queries.stars import QUERIES as STARS
from warehouse_queries.stars import fact, individuals, medications, rooms, staff, star, stays, treatments

QUERIES = {}
ORACLE = {}
AT = datetime(2026, 4, 29, 6, 0)


def _register(name, query, sql):
    QUERIES[name] = lambda spark, sf_dir: plain(query(spark, sf_dir))
    ORACLE[name] = sql


# Checks.

_register(
    "chk_not_null",
    lambda spark, sf: checks.null_counts(S.patients(spark, sf), S.patients(spark, sf).columns),
    f"""{S.sql_tables('patient')}, n AS (SELECT """
    + ", ".join(
        f"count(*) - count({c}) AS {c}"
        for c in "first_name birth_date birth_country phone_number street_name"
        " address_complement postal_code city country updated_at".split()
    )
    + " FROM patient) SELECT column_name, n_failed FROM (UNPIVOT n ON COLUMNS(*) INTO NAME"
    " column_name VALUE n_failed) WHERE n_failed > 0",
)
_register(
    "chk_unique",
    lambda spark, sf: checks.duplicate_keys(S.treatments(spark, sf), ["treatment_id"]),
    f"""{S.sql_tables('treatment')} SELECT treatment_id, count(*) AS cnt FROM treatment
    WHERE treatment_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
)
_register(
    "chk_unique_combo",
    lambda spark, sf: checks.duplicate_keys(S.medications(spark, sf), C.MEDICAMENT.staged_keys),
    f"""{S.sql_tables('medication')} SELECT medicine_code, medicine_category, manufacturer_brand,
        count(*) AS cnt FROM medication WHERE medicine_category IS NOT NULL
    GROUP BY ALL HAVING count(*) > 1""",
)
_register(
    "chk_unique_accepted",
    lambda spark, sf: checks.duplicate_keys(
        check_rows(S.medications(spark, sf), C.MEDICAMENT.rules), ["medicine_code"],
        "wrk_stts_cd = 'OK'",
    ),
    f"""{S.sql_tables('medication')} SELECT medicine_code, count(*) AS cnt FROM medication
    WHERE medicine_category IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
)
_register(
    "chk_accepted",
    lambda spark, sf: checks.unexpected_values(
        S.consultations(spark, sf), "temperature_unit", ["C", "F"],
        "pathology_description IS NOT NULL",
    ),
    f"""{S.sql_tables('consultation')} SELECT temperature_unit AS value, count(*) AS n_failed
    FROM consultation WHERE pathology_description IS NOT NULL
        AND temperature_unit NOT IN ('C', 'F') GROUP BY ALL""",
)
_register(
    "chk_relationships",
    lambda spark, sf: checks.orphans(
        fact(spark, sf), ["patient_id"], individuals(spark, sf), ["indiv_id"]
    ),
    f"""{S.sql_work('consultation', 'patient')} SELECT patient_id, count(*) AS n_failed
    FROM consultation_ok WHERE patient_id NOT IN (SELECT patient_id FROM patient_ok)
    GROUP BY ALL""",
)
_register(
    "chk_relationships_where",
    lambda spark, sf: checks.orphans(
        fact(spark, sf), ["treatment_id"], treatments(spark, sf), ["treatment_id"],
        "treatment_id IS NOT NULL",
    ),
    f"""{S.sql_work('consultation', 'treatment')} SELECT treatment_id, count(*) AS n_failed
    FROM consultation_ok WHERE treatment_id NOT IN (SELECT treatment_id FROM treatment_ok)
    GROUP BY ALL""",
)
_register(
    "chk_expression",
    lambda spark, sf: checks.failing_rows(
        S.rooms(spark, sf), "day_rate IS NULL OR day_rate <= 0", ["room_number", "day_rate"]
    ),
    f"""{S.sql_tables('room')} SELECT room_number, day_rate FROM room
    WHERE day_rate IS NULL OR day_rate <= 0""",
)


def _population(spark, sf_dir):
    """Two populations that exist and one that does not."""
    events = S.read(spark, sf_dir, "events")
    found = checks.population_missing(events, "event_type = 'purchase'", "missing purchases")
    lost = checks.population_missing(events, "event_type = 'refund'", "missing refunds")
    return found.unionByName(lost)


_register(
    "chk_population", _population,
    """SELECT 'missing purchases' AS failure_reason
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'purchase')
    UNION ALL SELECT 'missing refunds'
    WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'refund')""",
)
_register(
    "chk_unknown_ids",
    lambda spark, sf: checks.unknown_ids(
        S.stays(spark, sf), "room_number", rooms(spark, sf), "room_num"
    ),
    f"""{S.sql_tables('stay')}, {S.SQL['room']}, {S.sql_gated('room')}
    SELECT DISTINCT room_number FROM stay
    WHERE room_number NOT IN (SELECT room_number FROM room_ok)""",
)


def _reconcile(spark, sf_dir):
    kept, consults = stays(spark, sf_dir), fact(spark, sf_dir)
    source = S.stays(spark, sf_dir)
    return checks.reconcile(
        {
            "n_stays": (kept, F.count("*")),
            "first_day": (kept, F.min(F.to_date("started_at"))),
            "last_day": (kept, F.max(F.to_date("started_at"))),
            "cost": (kept, F.sum("cost")),
            "n_source": (source, F.count_distinct("hospi_id")),
            "source_cost": (source, F.sum("cost")),
            "n_consults": (consults, F.count("*")),
        },
        {
            "stays within January": "first_day >= DATE'2024-01-01' AND last_day <= DATE'2024-01-31'",
            "as many stays as in the source": "n_stays = n_source",
            "cost not above the source": "cost <= source_cost",
            "fewer stays than consultations": "n_stays < n_consults",
        },
    )


_register(
    "chk_reconcile", _reconcile,
    f"""{S.sql_work('stay', 'consultation')}, f AS (SELECT
        (SELECT count(*) FROM stay_ok) AS n_stays,
        (SELECT min(CAST(started_at AS DATE)) FROM stay_ok) AS first_day,
        (SELECT max(CAST(started_at AS DATE)) FROM stay_ok) AS last_day,
        (SELECT sum(cost) FROM stay_ok) AS cost,
        (SELECT count(DISTINCT hospi_id) FROM stay) AS n_source,
        (SELECT sum(cost) FROM stay) AS source_cost,
        (SELECT count(*) FROM consultation_ok) AS n_consults)
    SELECT 'stays within January' AS failed_rule FROM f
        WHERE NOT (first_day >= DATE '2024-01-01' AND last_day <= DATE '2024-01-31')
    UNION ALL SELECT 'as many stays as in the source' FROM f WHERE NOT n_stays = n_source
    UNION ALL SELECT 'cost not above the source' FROM f WHERE NOT cost <= source_cost
    UNION ALL SELECT 'fewer stays than consultations' FROM f WHERE NOT n_stays < n_consults""",
)


def _suite(spark, sf_dir):
    """All checks declared for the consultation fact, its dimensions and the stays."""
    tables = {
        "r_room": rooms(spark, sf_dir),
        "r_indiv": individuals(spark, sf_dir),
        "r_stf": staff(spark, sf_dir),
        "r_trmt": treatments(spark, sf_dir),
        "r_hospi": stays(spark, sf_dir),
        "fait_consult": fact(spark, sf_dir),
    }
    return assertions.run_checks(tables, {n: assertions.MARTS[n] for n in tables})


def _lost(child, column, parent, key, table, name, where=""):
    return (
        f"SELECT '{name}' AS src_table, 'parent {table}' AS \"check\", '{column}' AS detail,"
        f" count(*) AS n_failed FROM {child} WHERE {column} NOT IN (SELECT {key} FROM {parent})"
        f"{where} HAVING count(*) > 0"
    )


_register(
    "chk_mart_suite", _suite,
    S.sql_work("room", "patient", "staff", "treatment", "stay", "consultation") + " "
    + " UNION ALL ".join(
        [
            _lost("stay_ok", "room_number", "room_ok", "room_number", "r_room", "r_hospi"),
            _lost("stay_ok", "responsible_staff_id", "staff_ok", "staff_id", "r_stf", "r_hospi"),
            _lost("consultation_ok", "patient_id", "patient_ok", "patient_id", "r_indiv",
                  "fait_consult"),
            _lost("consultation_ok", "staff_id", "staff_ok", "staff_id", "r_stf", "fait_consult"),
            _lost("consultation_ok", "treatment_id", "treatment_ok", "treatment_id", "r_trmt",
                  "fait_consult"),
        ]
    ),
)



def _work_suite(spark, sf_dir):
    """Checks of the work layer; only NULL keys of rejected rows fail."""
    tables = {
        "MEDICAMENT": written(gated(spark, sf_dir, "medication")),
        "CONSULTATION": written(gated(spark, sf_dir, "consultation")),
    }
    return assertions.run_checks(tables, {n: assertions.WORK[n] for n in tables})


_register(
    "chk_work_suite", _work_suite,
    """SELECT 'MEDICAMENT' AS src_table, 'not_null' AS "check", 'medicine_category' AS detail,
        count(*) AS n_failed FROM part WHERE p_type = 'PROMO' HAVING count(*) > 0""",
)


def _view_suite(spark, sf_dir):
    """Checks of two views of which some rows were spoiled."""
    day = F.dayofmonth("report_date")
    night = STARS["kpi_one_night"](spark, sf_dir).withColumns(
        {
            "one_night_plus_count": F.when(day % 5 == 0, F.col("total_hospitalisations") + 1).otherwise(
                F.col("one_night_plus_count")
            ),
            "one_night_plus_pct": F.when(day % 7 != 0, F.col("one_night_plus_pct") - F.when(day == 8, 200).otherwise(0)),
        }
    )
    grid = STARS["kpi_occupancy"](spark, sf_dir).withColumns(
        {
            "is_occupied": F.when(F.col("room_num") % 100 == 0, 2).otherwise(F.col("is_occupied")),
            "occupancy_status": F.when(F.col("room_num") % 50 == 1, "Ouverte").when(
                F.col("room_num") % 50 != 2, F.col("occupancy_status")
            ),
        }
    )
    tables = {"vw_patients_one_night": night, "vw_empty_rooms": grid}
    return assertions.run_checks(tables, {n: assertions.VIEWS[n] for n in tables})


_register(
    "chk_view_suite", _view_suite,
    f"""{_ROOMS_WORK}, night AS (SELECT *, day(report_date) AS d FROM ({_NIGHT})), grid AS ({_OCC})
    SELECT 'vw_patients_one_night' AS src_table, 'never' AS "check",
        'one_night_plus_count > total_hospitalisations' AS detail, count(*) AS n_failed
    FROM night WHERE d % 5 = 0 HAVING count(*) > 0
    UNION ALL SELECT 'vw_patients_one_night', 'not_null', 'one_night_plus_pct', count(*)
    FROM night WHERE d % 7 = 0 HAVING count(*) > 0
    UNION ALL SELECT 'vw_patients_one_night', 'never', 'one_night_plus_pct < 0', count(*)
    FROM night WHERE d = 8 HAVING count(*) > 0
    UNION ALL SELECT 'vw_empty_rooms', 'accepted_values', 'is_occupied', count(*)
    FROM grid WHERE room_num % 100 = 0 HAVING count(*) > 0
    UNION ALL SELECT 'vw_empty_rooms', 'accepted_values', 'occupancy_status', count(*)
    FROM grid WHERE room_num % 50 = 1 HAVING count(*) > 0
    UNION ALL SELECT 'vw_empty_rooms', 'not_null', 'occupancy_status', count(*)
    FROM grid WHERE room_num % 50 = 2 HAVING count(*) > 0""",
)


def _view_reconciliation(spark, sf_dir):
    """Views against sources of which a third of the patients and late consultations are missing."""
    tables = star(spark, sf_dir)
    loaded = {
        name: source(spark, sf_dir) for name, source in (
            ("PATIENT", S.patients), ("PERSONNEL", S.staff), ("CONSULTATION", S.consultations),
            ("TRAITEMENT", S.treatments), ("HOSPITALISATION", S.stays),
        )
    }
    sources = {
        name: rows.select(*[F.col(c.staged).alias(c.target) for c in C.TABLES[name].columns if c.staged in rows.columns])
        for name, rows in loaded.items()
    }
    sources["PATIENT"] = sources["PATIENT"].filter("ID_PATIENT % 3 <> 0")
    consults = sources["CONSULTATION"].withColumn("batch_dt", F.to_date("TS_DEBUT_CONSULT"))
    sources["CONSULTATION"] = consults.filter("batch_dt < DATE'2024-01-20'")
    return view_failures(kpis.build_views(tables), tables["r_room"], sources)


_register(
    "chk_reconcile_views", _view_reconciliation,
    f"""{S.sql_work('consultation', 'patient', 'treatment', 'medication', 'stay', 'room', 'staff')},
    age AS ({_AGE}), med AS ({_MED}), used AS ({_ROOMS}), spec AS ({_SPEC}), night AS ({_NIGHT}),
    grid AS ({_OCC}), f AS (SELECT
        (SELECT min(report_date) FROM age) AS age_first, (SELECT max(report_date) FROM age) AS age_last,
        (SELECT min(CAST(started_at AS DATE)) FROM consultation) AS first_batch,
        (SELECT sum(total_quantity) FROM med) AS med_total,
        (SELECT sum(medicine_quantity) FROM treatment) AS all_total,
        (SELECT count(DISTINCT room_number) FROM used) AS n_used,
        (SELECT count(DISTINCT room_num) FROM grid) AS n_grid,
        (SELECT count(*) FROM room_ok) AS n_rooms,
        (SELECT max(one_night_plus_pct) FROM night) AS most, (SELECT min(one_night_plus_pct) FROM night) AS least,
        (SELECT sum(total_hospitalisations) FROM night) AS n_night,
        (SELECT count(DISTINCT hospi_id) FROM stay WHERE hospi_id > 0) AS n_stays),
    r(src_table, "check", detail, bad) AS (
        SELECT 'vw_avg_age_by_pathology', 'reconcile', 'no day before the first batch', NOT age_first >= first_batch FROM f
        UNION ALL SELECT 'vw_avg_age_by_pathology', 'reconcile', 'no day after the last batch',
            NOT age_last <= DATE '2024-01-19' FROM f
        UNION ALL SELECT 'vw_top_medication_by_pathology', 'reconcile', 'some quantity', NOT med_total > 0 FROM f
        UNION ALL SELECT 'vw_top_medication_by_pathology', 'reconcile', 'no more than prescribed',
            NOT med_total <= all_total FROM f
        UNION ALL SELECT 'vw_rooms_by_pathology', 'reconcile', 'no more rooms than there are', NOT n_used <= n_rooms FROM f
        UNION ALL SELECT 'vw_patients_one_night', 'reconcile', 'below 100 percent', NOT most < 100 FROM f
        UNION ALL SELECT 'vw_patients_one_night', 'reconcile', 'not below 0 percent', NOT least >= 0 FROM f
        UNION ALL SELECT 'vw_patients_one_night', 'reconcile', 'every valid stay', NOT n_night = n_stays FROM f
        UNION ALL SELECT 'vw_empty_rooms', 'reconcile', 'every room', NOT n_grid = n_rooms FROM f)
    SELECT src_table, "check", detail, CAST(1 AS BIGINT) AS n_failed FROM r WHERE bad
    UNION ALL SELECT 'vw_avg_age_by_pathology', 'source PATIENT', 'patient_id', count(DISTINCT patient_id)
        FROM age WHERE patient_id NOT IN (SELECT patient_id FROM patient WHERE patient_id % 3 <> 0) HAVING count(*) > 0
    UNION ALL SELECT 'vw_doctor_speciality_by_pathology', 'source PERSONNEL', 'staff_id', count(DISTINCT staff_id)
        FROM spec WHERE staff_id NOT IN (SELECT staff_id FROM staff) HAVING count(*) > 0""",
)


def _fingerprints(spark, sf_dir):
    """Orders by month against a copy with one status changed and one month gone."""
    orders = S.read(spark, sf_dir, "orders").withColumn("month", F.to_date(F.trunc("o_orderdate", "MM")))
    copy = orders.filter("month <> DATE'1997-03-01'").withColumn(
        "o_orderkey", F.when(F.col("o_orderkey") % 4000 == 7, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    )
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
    parts = [
        fingerprint(df, ["month", F.pmod("o_custkey", F.lit(7)).alias("part")], ["o_orderkey"], ["o_custkey"], names)
        for df in (orders, copy)
    ]
    prints = [merged_prints(df.drop("part"), ["month"]) for df in parts]
    found = differences(*prints, by=["month"])
    shown = F.col("figure") != "row_hash"
    return found.withColumns({c: F.when(shown, F.col(c)) for c in ("left_value", "right_value")})


_register(
    "chk_fingerprint", _fingerprints,
    """WITH o AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
            CASE WHEN o_orderkey % 4000 = 7 THEN -o_orderkey ELSE o_orderkey END AS k2 FROM orders),
    g AS (SELECT month, count(*) AS n, sum(o_orderkey) AS s, sum(k2) AS s2, min(o_custkey) AS lo,
            max(o_custkey) AS hi, month = DATE '1997-03-01' AS gone FROM o GROUP BY ALL)
    SELECT month, 'sum_o_orderkey' AS figure, CAST(s AS VARCHAR) AS left_value,
        CASE WHEN NOT gone THEN CAST(s2 AS VARCHAR) END AS right_value FROM g WHERE gone OR s <> s2
    UNION ALL SELECT month, 'row_hash', NULL, NULL FROM g WHERE gone OR s <> s2
    UNION ALL SELECT month, 'n_rows', CAST(n AS VARCHAR), NULL FROM g WHERE gone
    UNION ALL SELECT month, 'min_o_custkey', CAST(lo AS VARCHAR), NULL FROM g WHERE gone
    UNION ALL SELECT month, 'max_o_custkey', CAST(hi AS VARCHAR), NULL FROM g WHERE gone""",
)


def _key_suite(spark, sf_dir):
    """Keys of the two marts with surrogate keys, each with some rows twice under new numbers."""
    medications_twice = written(medications(spark, sf_dir))
    again = medications_twice.filter("medc_id % 7 = 0").withColumn("medc_id", -F.col("medc_id"))
    parties = written(_parts(spark, sf_dir))
    renamed = parties.filter("part_id % 5 = 0").withColumn("src_id", -F.col("src_id"))
    staff_only = "src_typ <> 'Patient'"
    tables = {
        "r_medc": medications_twice.unionByName(again),
        "r_part": parties.filter(staff_only).unionByName(renamed.filter(staff_only)),
    }
    return assertions.run_checks(tables, {n: assertions.MARTS[n] for n in tables})


_register(
    "chk_key_suite", _key_suite,
    f"""{S.sql_work('medication', 'patient', 'staff')}, m AS (SELECT row_number() OVER (
            ORDER BY medicine_code, medicine_category, manufacturer_brand) AS id FROM medication_ok),
    p AS (SELECT row_number() OVER (ORDER BY src_typ, src_id) AS id, src_typ
        FROM (SELECT patient_id AS src_id, 'Patient' AS src_typ FROM patient_ok
            UNION ALL SELECT staff_id, job_title FROM staff_ok))
    SELECT 'r_medc' AS src_table, 'unique' AS "check", 'medc_cd, medc_catg, manf_brnd' AS detail,
        2 * count(*) AS n_failed FROM m WHERE id % 7 = 0 HAVING count(*) > 0
    UNION ALL SELECT 'r_part', 'unique', 'part_id', 2 * count(*) FROM p
        WHERE id % 5 = 0 AND src_typ <> 'Patient' HAVING count(*) > 0
    UNION ALL SELECT 'r_part', 'population', 'missing Patient population', CAST(1 AS BIGINT)""",
)


def _declared(spark, sf_dir):
    """Declared constraints of the loaded medications and patients."""
    tables = {}
    for name, rows in (
        ("MEDICAMENT", S.medications(spark, sf_dir)), ("PATIENT", S.patients(spark, sf_dir)),
    ):
        tables[name] = rows.select(
            *[F.col(c.staged).alias(c.target) for c in C.TABLES[name].columns]
        )
    return assertions.run_checks(tables, {n: assertions.DECLARED[n] for n in tables})


_register(
    "chk_declared", _declared,
    f"""{S.sql_tables('medication', 'patient')}
    SELECT 'MEDICAMENT' AS src_table, 'not_null' AS "check", 'CATG_MEDICAMENT' AS detail,
        count(*) AS n_failed FROM medication WHERE medicine_category IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'MEDICAMENT', 'unique', 'CD_MEDICAMENT, CATG_MEDICAMENT, MARQUE_FABRI',
        CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM medication
            WHERE medicine_category IS NOT NULL
            GROUP BY medicine_code, medicine_category, manufacturer_brand HAVING count(*) > 1)
        HAVING sum(n) > 0
    UNION ALL SELECT 'PATIENT', 'not_null', 'PRENOM_PATIENT', count(*) FROM patient
        WHERE first_name IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'PATIENT', 'not_null', 'TS_MAJ_PATIENT', count(*) FROM patient
        WHERE updated_at IS NULL HAVING count(*) > 0""",
)

# Run tracking.


def _log(spark, sf_dir):
    """Events as a run log: the user is the run, user and property the step."""
    return (
        S.read(spark, sf_dir, "events")
        .withColumn("k", S.number_in_props())
        .selectExpr(
            "user_id AS run_id",
            "CASE WHEN k >= 10 THEN user_id * 100 + k END AS exec_id",
            "CASE WHEN k >= 10 THEN concat('step ', k) END AS scrpt_name",
            "'DAILY' AS run_typ",
            "DATE'2024-01-01' AS batch_dt",
            "CASE event_type WHEN 'purchase' THEN 'OK' WHEN 'error' THEN 'KO' ELSE 'ENC' END"
            " AS stts_cd",
            "CASE WHEN event_type = 'error' THEN concat('error ', event_id) END AS err_msg",
            "ts AS at",
        )
    )


_LOG_SQL = """log AS (SELECT user_id AS run_id,
        CASE WHEN k >= 10 THEN user_id * 100 + k END AS exec_id, 'step ' || k AS scrpt_name,
        CASE event_type WHEN 'purchase' THEN 'OK' WHEN 'error' THEN 'KO' ELSE 'ENC' END AS stts_cd,
        CASE WHEN event_type = 'error' THEN 'error ' || event_id END AS err_msg, ts AS seen
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)),
    closed AS (SELECT *, row_number() OVER (PARTITION BY run_id, exec_id
        ORDER BY CASE WHEN stts_cd = 'ENC' THEN 0 ELSE 1 END DESC, seen DESC) AS rn FROM log)"""
_register(
    "run_log_state",
    lambda spark, sf: audit.run_state(_log(spark, sf)),
    f"""WITH {_LOG_SQL} SELECT run_id, min(seen) AS run_strt_dttm,
        max(seen) FILTER (stts_cd <> 'ENC') AS run_end_dttm,
        max(stts_cd) FILTER (rn = 1) AS run_stts_cd, 'DAILY' AS run_typ,
        DATE '2024-01-01' AS batch_dt
    FROM closed WHERE exec_id IS NULL GROUP BY run_id""",
)
_register(
    "step_log_state",
    lambda spark, sf: audit.step_state(_log(spark, sf)),
    f"""WITH {_LOG_SQL} SELECT exec_id, max(run_id) AS run_id, max(scrpt_name) AS scrpt_name,
        min(seen) AS exec_strt_dttm, max(seen) FILTER (stts_cd <> 'ENC') AS exec_end_dttm,
        max(stts_cd) FILTER (rn = 1) AS exec_stts_cd,
        max(err_msg) FILTER (rn = 1) AS err_msg
    FROM closed WHERE exec_id IS NOT NULL GROUP BY exec_id""",
)


def _lineage(spark, sf_dir):
    """lineitem as rows, supplier as the step that wrote them, nation as the run."""
    rows = S.read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey AS exec_id"
    )
    steps = S.read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS exec_id", "CAST(s_nationkey AS BIGINT) AS run_id", "s_name AS scrpt_name",
        "TIMESTAMP_NTZ'2024-01-01 06:00:00' AS exec_strt_dttm",
    )
    runs = S.read(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS run_id",
        "TIMESTAMP_NTZ'2024-01-01 05:00:00' AS run_strt_dttm", "n_name AS run_stts_cd",
    )
    return audit.lineage(rows, steps, runs)


_register(
    "lineage_lookup", _lineage,
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS exec_id,
        CAST(n_nationkey AS BIGINT) AS run_id, s_name AS scrpt_name,
        TIMESTAMP '2024-01-01 06:00:00' AS exec_strt_dttm,
        TIMESTAMP '2024-01-01 05:00:00' AS run_strt_dttm, n_name AS run_stts_cd
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)

# Rejects.


def _rejects(spark, sf_dir):
    return all_rejects(
        {
            "PATIENT": (gated(spark, sf_dir, "patient"), C.PATIENT.staged_keys),
            "MEDICAMENT": (gated(spark, sf_dir, "medication"), C.MEDICAMENT.staged_keys),
            "CONSULTATION": (gated(spark, sf_dir, "consultation"), C.CONSULTATION.staged_keys),
        },
        AT,
    )


_REJECTS_WORK = S.sql_work("patient", "medication", "consultation")
_REJECTS_SQL = """r AS (
    SELECT 'PATIENT' AS src_table, CAST(patient_id AS VARCHAR) AS src_pk_val, rej_cod,
        last_name AS probe FROM patient_q WHERE wrk_stts_cd = 'REJ'
    UNION ALL SELECT 'MEDICAMENT',
        medicine_code || '|' || coalesce(medicine_category, '?') || '|' || manufacturer_brand,
        rej_cod, medicine_code FROM medication_q WHERE wrk_stts_cd = 'REJ'
    UNION ALL SELECT 'CONSULTATION', CAST(consultation_id AS VARCHAR), rej_cod,
        pathology_description FROM consultation_q WHERE wrk_stts_cd = 'REJ')"""


def _reject_json(spark, sf_dir):
    row = F.col("src_row_json")
    probe = F.when(F.col("src_table") == "PATIENT", F.get_json_object(row, "$.last_name")).when(
        F.col("src_table") == "MEDICAMENT", F.get_json_object(row, "$.medicine_code")
    ).otherwise(F.get_json_object(row, "$.pathology_description"))
    return _rejects(spark, sf_dir).select(
        "src_table", "src_pk_val", "batch_dt", "wrk_stts_cd", "rej_cod", probe.alias("probe"),
        F.length("rej_id").cast("bigint").alias("id_length"), "rej_dttm", "exec_id",
        "recycl_ind", "recycl_dttm",
    )


_register(
    "reject_json", _reject_json,
    f"""{_REJECTS_WORK}, {_REJECTS_SQL} SELECT src_table, src_pk_val,
        DATE '2026-04-29' AS batch_dt, 'REJ' AS wrk_stts_cd, rej_cod, probe,
        CAST(64 AS BIGINT) AS id_length, TIMESTAMP '2026-04-29 06:00:00' AS rej_dttm,
        CAST(7 AS BIGINT) AS exec_id, 0 AS recycl_ind, CAST(NULL AS TIMESTAMP) AS recycl_dttm
    FROM r""",
)
_register(
    "reject_report",
    lambda spark, sf: reject_report(_rejects(spark, sf)),
    f"""{_REJECTS_WORK}, {_REJECTS_SQL} SELECT src_table, DATE '2026-04-29' AS batch_dt, rej_cod,
        count(*) AS nb_rejets, CAST(0 AS BIGINT) AS nb_recycles, count(*) AS nb_en_attente
    FROM r GROUP BY ALL""",
)


def _rate_sql(name, table):
    total = f"((SELECT count(*) FROM {name}_ok) + count(*))"
    return (
        f"SELECT '{table}' AS src_table, DATE '2026-04-29' AS batch_dt, {total} AS n_rows,"
        f" count(*) AS n_rejects, count(*) / {total} AS reject_rate,"
        f" count(*) / {total} > 0.05 AS is_alert FROM {name}_q WHERE wrk_stts_cd = 'REJ'"
    )


_register(
    "reject_rate",
    lambda spark, sf: reject_rates(
        {n.upper(): gated(spark, sf, n) for n in ("patient", "medication", "consultation")}
    ),
    _REJECTS_WORK + " " + " UNION ALL ".join(
        _rate_sql(n, n.upper()) for n in ("patient", "medication", "consultation")
    ),
)


def _recycle(spark, sf_dir):
    """Medications rejected for their category come back with one and pass the gate."""
    first = gated(spark, sf_dir, "medication")
    rejects = all_rejects({"MEDICAMENT": (first, C.MEDICAMENT.staged_keys)}, AT)
    schema = S.medications(spark, sf_dir).schema.simpleString()
    fields = F.from_json("src_row_json", schema)
    fixed = rejects.select(
        "rej_id",
        F.to_json(
            fields.withField(
                "medicine_category", F.coalesce(fields["medicine_category"], F.lit("PROMO"))
            )
        ).alias("src_row_json"),
    )
    rows = corrected_rows(fixed, schema)
    table = C.MEDICAMENT
    again = gate(rows, table.rules, table.staged_keys, table.latest_by, BATCH, EXEC + 1)
    marked = mark_recycled(rejects, fixed, AT, EXEC + 1).groupBy("recycl_ind").agg(
        F.count("*").alias("n")
    )
    n_marked = marked.filter("recycl_ind = 1").select(F.sum("n")).scalar()
    return again.withColumn("n_recycled", n_marked)


_register(
    "reject_recycle", _recycle,
    f"""{S.sql_tables('medication')}, b AS (SELECT * REPLACE ('PROMO' AS medicine_category)
        FROM medication WHERE medicine_category IS NULL)
    SELECT * EXCLUDE (rn), 'OK' AS wrk_stts_cd, CAST(NULL AS VARCHAR) AS rej_cod,
        CAST(NULL AS VARCHAR) AS rej_dsc, DATE '2026-04-29' AS batch_dt,
        CAST(8 AS BIGINT) AS exec_id, (SELECT count(*) FROM b) AS n_recycled
    FROM (SELECT *, row_number() OVER (PARTITION BY {S._VERSIONS['medication'][0]}
        ORDER BY {S._VERSIONS['medication'][1]}) AS rn FROM b) WHERE rn = 1""",
)


def _wrong_type(spark, sf_dir):
    """Raw extract rows whose filled text does not fit the contract's type."""
    rows = wrong_types(order_texts(spark, sf_dir), ORDERS)
    return rows.select("ORDER_NO", "URGENT", "rej_cod", "rej_dsc")


_register(
    "reject_wrong_type", _wrong_type,
    """SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_NO,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'On' WHEN '2-HIGH' THEN 'yes'
            WHEN '3-MEDIUM' THEN '?' WHEN '4-NOT SPECIFIED' THEN '' ELSE 'F' END AS URGENT,
        CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'WRONG_TYPE' END AS rej_cod,
        CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'URGENT is not of type boolean' END AS rej_dsc
    FROM orders""",
)

# Normalisation, references, party model.


def _normalise(spark, sf_dir):
    rules = (*C.CONSULTATION.rules, unit_rule("patient_temperature", "temperature_unit"))
    rows = check_rows(S.consultations(spark, sf_dir), rules, BATCH, EXEC, describe=True)
    return normalise_consultation(rows).select(
        "consultation_id", F.round("patn_temp_c", 6).alias("patn_temp_c"), "dibt_ind", "hosp_ind",
        "wrk_stts_cd", "rej_cod", "rej_dsc",
    )


_register(
    "normalise_units", _normalise,
    f"""{S.sql_tables('consultation')}, {S.sql_tagged('consultation')}, n AS (SELECT *,
        CASE WHEN rej_cod IS NULL AND temperature_unit NOT IN ('C', 'F') THEN 'NORM_FAILURE'
            ELSE rej_cod END AS code FROM consultation_q)
    SELECT consultation_id, round(CASE temperature_unit
            WHEN 'C' THEN CAST(patient_temperature AS DOUBLE)
            WHEN 'F' THEN (CAST(patient_temperature AS DOUBLE) - 32) * 5 / 9 END, 6) AS patn_temp_c,
        CAST(diabetes_indicator AS INTEGER) AS dibt_ind,
        CAST(hospitalisation_indicator AS INTEGER) AS hosp_ind,
        CASE WHEN code IS NULL THEN 'OK' ELSE 'REJ' END AS wrk_stts_cd, code AS rej_cod,
        CASE WHEN code IS NULL THEN NULL WHEN code = 'NORM_FAILURE'
            THEN 'temperature_unit is neither C nor F'
            WHEN consultation_id <= 0 THEN 'consultation_id is not above zero'
            WHEN ended_at IS NULL THEN 'ended_at is missing'
            ELSE 'ended_at is before started_at' END AS rej_dsc FROM n""",
)


def table(spark, sf_dir, name):
    return written(gated(spark, sf_dir, name))


def stay_table(spark, sf_dir):
    return written(work(S.stays(spark, sf_dir), C.HOSPITALISATION, BATCH, EXEC))


def _fk_consultation(spark, sf_dir):
    return check_references(
        table(spark, sf_dir, "consultation"),
        C.CONSULTATION.references,
        {"PERSONNEL": table(spark, sf_dir, "staff"), "PATIENT": table(spark, sf_dir, "patient")},
    ).select("consultation_id", "staff_id", "patient_id", "wrk_stts_cd", "rej_cod", "rej_dsc")


_register(
    "fk_check", _fk_consultation,
    f"""{S.sql_work('consultation', 'staff', 'patient')}, c AS (
        SELECT * FROM consultation_ok UNION ALL
        SELECT * FROM consultation_q WHERE wrk_stts_cd = 'REJ'),
    f AS (SELECT *, CASE WHEN wrk_stts_cd = 'OK' THEN CASE
        WHEN staff_id NOT IN (SELECT staff_id FROM staff_ok) THEN 'staff_id'
        WHEN patient_id NOT IN (SELECT patient_id FROM patient_ok) THEN 'patient_id' END END
        AS lost FROM c)
    SELECT consultation_id, staff_id, patient_id,
        CASE WHEN lost IS NULL THEN wrk_stts_cd ELSE 'REJ' END AS wrk_stts_cd,
        CASE WHEN lost IS NULL THEN rej_cod ELSE 'FK_NOT_FOUND' END AS rej_cod,
        'no parent for ' || lost AS rej_dsc FROM f""",
)


def _fk_stay(spark, sf_dir):
    return check_references(
        stay_table(spark, sf_dir),
        C.HOSPITALISATION.references,
        {
            "CONSULTATION": table(spark, sf_dir, "consultation"),
            "CHAMBRE": table(spark, sf_dir, "room"),
            "PERSONNEL": table(spark, sf_dir, "staff"),
        },
    ).select("hospi_id", "wrk_stts_cd", "rej_cod", "rej_dsc")


_register(
    "fk_check_stay", _fk_stay,
    f"""{S.sql_work('stay', 'consultation', 'room', 'staff')}, c AS (
        SELECT * FROM stay_ok UNION ALL SELECT * FROM stay_q WHERE wrk_stts_cd = 'REJ'),
    f AS (SELECT *, CASE WHEN wrk_stts_cd = 'OK' THEN CASE
        WHEN consultation_id NOT IN (SELECT consultation_id FROM consultation_ok
            WHERE hospitalisation_indicator) THEN 'consultation_id'
        WHEN room_number NOT IN (SELECT room_number FROM room_ok) THEN 'room_number'
        WHEN responsible_staff_id NOT IN (SELECT staff_id FROM staff_ok)
            THEN 'responsible_staff_id' END END AS lost FROM c)
    SELECT hospi_id, CASE WHEN lost IS NULL THEN wrk_stts_cd ELSE 'REJ' END AS wrk_stts_cd,
        CASE WHEN lost IS NULL THEN rej_cod ELSE 'FK_NOT_FOUND' END AS rej_cod,
        'no parent for ' || lost AS rej_dsc FROM f""",
)


def _fk_treatment(spark, sf_dir):
    return check_references(
        table(spark, sf_dir, "treatment"),
        C.TRAITEMENT.references,
        {
            "MEDICAMENT": table(spark, sf_dir, "medication"),
            "CONSULTATION": table(spark, sf_dir, "consultation"),
        },
    ).groupBy("wrk_stts_cd", "rej_cod", "rej_dsc").agg(F.count("*").alias("n_rows"))


_register(
    "fk_check_treatment", _fk_treatment,
    f"""{S.sql_work('treatment', 'medication', 'consultation')}, c AS (
        SELECT * FROM treatment_ok UNION ALL SELECT * FROM treatment_q WHERE wrk_stts_cd = 'REJ'),
    f AS (SELECT c.*, CASE WHEN wrk_stts_cd = 'OK' THEN CASE
        WHEN NOT EXISTS (SELECT 1 FROM medication_ok m WHERE m.medicine_code = c.medicine_code
            AND m.medicine_category = c.medicine_category
            AND m.manufacturer_brand = c.manufacturer_brand)
            THEN 'medicine_code, medicine_category, manufacturer_brand'
        WHEN consultation_id NOT IN (SELECT consultation_id FROM consultation_ok)
            THEN 'consultation_id' END END AS lost FROM c)
    SELECT CASE WHEN lost IS NULL THEN wrk_stts_cd ELSE 'REJ' END AS wrk_stts_cd,
        CASE WHEN lost IS NULL THEN rej_cod ELSE 'FK_NOT_FOUND' END AS rej_cod,
        'no parent for ' || lost AS rej_dsc, count(*) AS n_rows FROM f GROUP BY ALL""",
)


def _parts(spark, sf_dir):
    return marts.r_part(gated(spark, sf_dir, "patient"), gated(spark, sf_dir, "staff"))


_PARTS = """part_ids AS (SELECT row_number() OVER (ORDER BY src_typ, src_id) AS part_id, src_id,
        src_typ FROM (SELECT patient_id AS src_id, 'Patient' AS src_typ FROM patient_ok
            UNION ALL SELECT staff_id, job_title FROM staff_ok)),
    patient_p AS (SELECT * FROM part_ids WHERE src_typ = 'Patient'),
    staff_p AS (SELECT * FROM part_ids WHERE src_typ <> 'Patient')"""
_PARTS_WORK = S.sql_work("patient", "staff")

_register(
    "party_individual",
    lambda spark, sf: party.o_indv(
        table(spark, sf, "patient"), table(spark, sf, "staff"), _parts(spark, sf)
    ),
    f"""{_PARTS_WORK}, {_PARTS} SELECT part_id, last_name AS indv_name,
        first_name AS indv_firs_name, 'Actif' AS indv_stts_cd, created_at AS crtn_dttm,
        updated_at AS updt_dttm, birth_date AS birt_dt, birth_city AS birt_city,
        birth_country AS birt_cntr, social_security_number AS socl_num,
        CAST(7 AS BIGINT) AS exec_id FROM patient_ok LEFT JOIN patient_p ON patient_id = src_id
    UNION ALL SELECT part_id, last_name, first_name, status_code, created_at, updated_at, NULL,
        NULL, NULL, NULL, 7 FROM staff_ok LEFT JOIN staff_p ON staff_id = src_id""",
)
_register(
    "party_staff",
    lambda spark, sf: party.o_stff(table(spark, sf, "staff"), _parts(spark, sf)),
    f"""{_PARTS_WORK}, {_PARTS} SELECT part_id, work_start_at AS work_strt_dttm,
        work_end_at AS work_end_dttm, work_end_reason AS work_end_resn,
        CAST(7 AS BIGINT) AS exec_id FROM staff_ok LEFT JOIN staff_p ON staff_id = src_id""",
)
_register(
    "validity_phone",
    lambda spark, sf: party.o_telp(table(spark, sf, "patient"), _parts(spark, sf)),
    f"""{_PARTS_WORK}, {_PARTS} SELECT part_id, created_at AS strt_vald_dttm,
        phone_country_code AS cntr_ind, phone_number AS telp_num, updated_at AS end_vald_dttm,
        CAST(7 AS BIGINT) AS exec_id FROM patient_ok LEFT JOIN patient_p ON patient_id = src_id
    WHERE phone_number IS NOT NULL""",
)
_register(
    "validity_address",
    lambda spark, sf: party.o_addr(table(spark, sf, "patient"), _parts(spark, sf)),
    f"""{_PARTS_WORK}, {_PARTS} SELECT part_id, created_at AS strt_vald_dttm,
        street_number AS strt_num, street_name AS strt_dsc, address_complement AS comp_strt,
        postal_code AS post_cd, city AS city_name, country AS cntr_name,
        updated_at AS end_vald_dttm, CAST(7 AS BIGINT) AS exec_id
    FROM patient_ok LEFT JOIN patient_p ON patient_id = src_id
    WHERE street_name IS NOT NULL OR postal_code IS NOT NULL OR city IS NOT NULL""",
)
_register(
    "party_consultation",
    lambda spark, sf: party.o_cons(table(spark, sf, "consultation"), _parts(spark, sf)),
    f"""{S.sql_work('patient', 'staff', 'consultation')}, {_PARTS}
    SELECT consultation_id AS cons_id, s.part_id AS stff_id, p.part_id AS patn_id,
        started_at AS cons_strt_dttm, ended_at AS cons_end_dttm,
        CAST(patient_weight_kg AS DOUBLE) AS patn_wegh,
        CAST(patient_temperature AS DOUBLE) AS patn_temp, temperature_unit AS temp_unit,
        blood_pressure AS bld_prss, pathology_description AS path_dsc,
        CAST(diabetes_indicator AS INTEGER) AS dibt_ind, treatment_id AS tret_id,
        CAST(hospitalisation_indicator AS INTEGER) AS hosp_ind, CAST(7 AS BIGINT) AS exec_id
    FROM consultation_ok c LEFT JOIN staff_p s ON c.staff_id = s.src_id
    LEFT JOIN patient_p p ON c.patient_id = p.src_id""",
)
_register(
    "sk_lookup",
    lambda spark, sf: party.o_tret(table(spark, sf, "treatment"), medications(spark, sf)),
    f"""{S.sql_work('treatment', 'medication')}, m AS (SELECT *, row_number() OVER (
        ORDER BY medicine_code, medicine_category, manufacturer_brand) AS medc_id
        FROM medication_ok)
    SELECT treatment_id AS tret_id, medc_id, CAST(medicine_quantity AS DOUBLE) AS medc_qty,
        dosage_description AS dosg_dsc, consultation_id AS cons_id, created_at AS tret_crtn_dttm,
        CAST(7 AS BIGINT) AS exec_id
    FROM treatment_ok t LEFT JOIN m ON t.medicine_code = m.medicine_code
        AND t.medicine_category = m.medicine_category
        AND t.manufacturer_brand = m.manufacturer_brand""",
)
_register(
    "party_stay",
    lambda spark, sf: party.o_hosp(
        stay_table(spark, sf), _parts(spark, sf)
    ),
    f"""{S.sql_work('patient', 'staff', 'stay')}, {_PARTS}
    SELECT hospi_id AS hosp_id, consultation_id AS cons_id, room_number AS room_num,
        started_at AS hosp_strt_dttm, ended_at AS hosp_end_dttm,
        CAST(cost AS DOUBLE) AS hosp_finl_rate, part_id AS stff_id, CAST(7 AS BIGINT) AS exec_id
    FROM stay_ok LEFT JOIN staff_p ON responsible_staff_id = src_id""",
)


# Everything rows break, the gate, and recycling.


def _checked(spark, sf_dir):
    """Three staged tables and an extract with values of a wrong type, each checked in one read."""
    patients = checked(S.patients(spark, sf_dir), C.PATIENT, {}, BATCH, EXEC)
    parents = {
        "PERSONNEL": accepted(gated(spark, sf_dir, "staff")),
        "PATIENT": accepted(gated(spark, sf_dir, "patient")),
    }
    orders = replace(ORDERS, keys=("ORDER_NO",))
    texts = stage(typed(order_texts(spark, sf_dir), orders, wrong=True), orders, (WRONG,))
    return {
        "PATIENT": (patients, C.PATIENT),
        "MEDICAMENT": (checked(S.medications(spark, sf_dir), C.MEDICAMENT, {}, BATCH, EXEC), C.MEDICAMENT),
        "CONSULTATION": (
            checked(S.consultations(spark, sf_dir), C.CONSULTATION, parents, BATCH, EXEC), C.CONSULTATION,
        ),
        "ORDERS": (checked(texts, orders, {}, BATCH, EXEC), orders),
    }


def _findings(spark, sf_dir):
    tables = {n: (df, t.staged_keys) for n, (df, t) in _checked(spark, sf_dir).items()}
    return all_findings(tables, AT).select("src_table", "src_pk_val", "rej_cod", "rej_dsc", "wrk_stts_cd")


_HELD = "consultation_id <= 0 OR ended_at IS NULL OR ended_at < started_at"
_FINDINGS_WORK = S.sql_work("patient", "medication", "consultation", "staff")
_register(
    "reject_findings", _findings,
    f"""{_FINDINGS_WORK}, c AS (SELECT *, CAST(consultation_id AS VARCHAR) AS pk,
            CASE WHEN {_HELD} THEN 'REJ' ELSE 'OK' END AS state FROM consultation),
    m AS (SELECT *, row_number() OVER (PARTITION BY {S._VERSIONS['medication'][0]}
            ORDER BY {S._VERSIONS['medication'][1]}) AS rn FROM medication WHERE medicine_category IS NOT NULL)
    SELECT 'PATIENT' AS src_table, CAST(patient_id AS VARCHAR) AS src_pk_val, 'NULL_MANDATORY' AS rej_cod,
        'first_name is missing' AS rej_dsc, 'REJ' AS wrk_stts_cd FROM patient WHERE first_name IS NULL
    UNION ALL SELECT 'PATIENT', CAST(patient_id AS VARCHAR), 'NULL_MANDATORY', 'updated_at is missing', 'REJ'
        FROM patient WHERE updated_at IS NULL
    UNION ALL SELECT 'PATIENT', CAST(patient_id AS VARCHAR), 'WRONG_FORMAT', 'patient_id is not above zero', 'REJ'
        FROM patient WHERE patient_id <= 0
    UNION ALL SELECT 'MEDICAMENT', medicine_code || '|?|' || manufacturer_brand, 'NULL_MANDATORY',
        'medicine_category is missing', 'REJ' FROM medication WHERE medicine_category IS NULL
    UNION ALL SELECT 'MEDICAMENT', medicine_code || '|' || medicine_category || '|' || manufacturer_brand,
        'DUPLICATE_PK', 'a later version of medicine_code, medicine_category, manufacturer_brand was kept', 'REJ'
        FROM m WHERE rn > 1
    UNION ALL SELECT 'CONSULTATION', pk, 'WRONG_FORMAT', 'consultation_id is not above zero', state FROM c
        WHERE consultation_id <= 0
    UNION ALL SELECT 'CONSULTATION', pk, 'NULL_MANDATORY', 'ended_at is missing', state FROM c WHERE ended_at IS NULL
    UNION ALL SELECT 'CONSULTATION', pk, 'WRONG_FORMAT', 'ended_at is before started_at', state FROM c
        WHERE ended_at < started_at
    UNION ALL SELECT 'CONSULTATION', pk, 'NORM_FAILURE', 'temperature_unit is neither C nor F', state FROM c
        WHERE temperature_unit NOT IN ('C', 'F')
    UNION ALL SELECT 'CONSULTATION', pk, 'FK_NOT_FOUND', 'no parent for staff_id', state FROM c
        WHERE staff_id NOT IN (SELECT staff_id FROM staff_ok)
    UNION ALL SELECT 'CONSULTATION', pk, 'FK_NOT_FOUND', 'no parent for patient_id', state FROM c
        WHERE patient_id NOT IN (SELECT patient_id FROM patient_ok)
    UNION ALL SELECT 'ORDERS', CAST(o_orderkey AS VARCHAR), 'WRONG_TYPE', 'URGENT is not of type boolean', 'OK'
        FROM orders WHERE o_orderpriority = '3-MEDIUM'""",
)


def _gate(spark, sf_dir):
    """What stops the promotion of two tables: figures observed as they are written, logged steps."""
    figures = []
    for name, (rows, table) in _checked(spark, sf_dir).items():
        if name in ("MEDICAMENT", "CONSULTATION"):
            seen = Observation()
            asked = work_figures(rows, table.references)
            written(rows.observe(seen, *[c.alias(n) for n, c in asked.items()]))
            figures += figure_rows(name, seen.get)
    steps = audit.step_state(_log(spark, sf_dir))
    return promotion_blocks(spark.createDataFrame(figures, FIGURES), steps, 0.05, 0)


_register(
    "promotion_gate", _gate,
    f"""{_FINDINGS_WORK}, {_LOG_SQL.removeprefix('WITH ')}, figures AS (
        SELECT 'MEDICAMENT' AS name, (SELECT count(*) FROM medication_ok) + count(*) AS n, count(*) AS bad
        FROM medication_q WHERE wrk_stts_cd = 'REJ'
        UNION ALL SELECT 'CONSULTATION', (SELECT count(*) FROM consultation_ok) + count(*), count(*)
        FROM consultation_q WHERE wrk_stts_cd = 'REJ')
    SELECT 'reject rate' AS reason, name, bad || ' of ' || n AS value FROM figures WHERE bad / n > 0.05
    UNION ALL SELECT 'unresolved keys', 'PERSONNEL of CONSULTATION', CAST(count(*) AS VARCHAR)
        FROM consultation_ok WHERE staff_id NOT IN (SELECT staff_id FROM staff_ok) HAVING count(*) > 0
    UNION ALL SELECT 'unresolved keys', 'PATIENT of CONSULTATION', CAST(count(*) AS VARCHAR)
        FROM consultation_ok WHERE patient_id NOT IN (SELECT patient_id FROM patient_ok) HAVING count(*) > 0
    UNION ALL SELECT 'step', scrpt_name, exec_stts_cd FROM (SELECT exec_id, max(scrpt_name) AS scrpt_name,
            max(stts_cd) FILTER (rn = 1) AS exec_stts_cd FROM closed WHERE exec_id IS NOT NULL GROUP BY exec_id)
        WHERE exec_stts_cd <> 'OK'""",
)


def _recycle_job(spark, sf_dir):
    """Rejected rooms corrected, sent twice, taken back twice, and checked again."""
    wh, contract = Warehouse(spark, work_path(spark, "recycled")), C.CHAMBRE
    loaded = S.rooms(spark, sf_dir).toDF(*contract.header)
    wh.write(loaded, STG, contract.name, BATCH, EXEC, contract.keys)
    daily.check_table(wh, contract, BATCH, EXEC)
    n_findings = daily.build_rejects(wh, BATCH, [contract])
    rejects = spark.read.parquet(daily.reject_path(wh))
    row = F.from_json("src_row_json", S.rooms(spark, sf_dir).schema)
    row = row.withField("day_rate", F.greatest(row["day_rate"], F.lit(1))).withField(
        "created_date", F.coalesce(row["created_date"], F.lit("1999-03-01").cast("date"))
    )
    fixed = rejects.select("rej_id", F.to_json(row).alias("src_row_json"))
    sent = [daily.submit_corrections(wh, fixed, EXEC + 1) for _ in range(2)]
    back = [daily.recycle(wh, BATCH, EXEC + 2, [contract]) for _ in range(2)]
    daily.check_table(wh, contract, BATCH, EXEC + 3)
    recycled = daily.reject_states(wh).agg(F.sum("recycl_ind"), F.sum("n_attempts")).first()
    counts = [n_findings, *sent, *back, *recycled]
    return wh.read(WRK, contract.name).select(
        "room_number", "day_rate", "created_date", "wrk_stts_cd", "rej_cod",
        F.lit(" ".join(map(str, counts))).alias("counts"),
    )


_register(
    "recycle_job", _recycle_job,
    f"""{S.sql_tables('room')}, n AS (SELECT CAST(sum((room_number <= 0)::INT + (day_rate <= 0)::INT
        + (created_date IS NULL)::INT) AS BIGINT) AS k FROM room)
    SELECT room_number, greatest(day_rate, 1) AS day_rate, coalesce(created_date, DATE '1999-03-01') AS created_date,
        CASE WHEN room_number <= 0 THEN 'REJ' ELSE 'OK' END AS wrk_stts_cd,
        CASE WHEN room_number <= 0 THEN 'WRONG_FORMAT' END AS rej_cod,
        concat_ws(' ', k, k, 0, k, 0, k, k) AS counts FROM room, n""",
)
