"""Dimensions, facts, indicator views and roll-ups on the driver's tables."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import functions as F

from wardhouse import contracts as C
from wardhouse.plans import kpis, marts
from wardhouse.plans.refresh import refresh
from wardhouse.plans.work import work
from wardhouse.session import at_once, work_path
from warehouse_queries import standins as S
from warehouse_queries.gates import BATCH, EXEC, gated, plain, written

QUERIES = {}
ORACLE = {}


def stays(spark, sf_dir):
    return written(marts.r_hospi(work(S.stays(spark, sf_dir), C.HOSPITALISATION, BATCH, EXEC)))


def fact(spark, sf_dir):
    return written(marts.fait_consult(gated(spark, sf_dir, "consultation")))


def rooms(spark, sf_dir):
    return written(marts.r_room(gated(spark, sf_dir, "room")))


def medications(spark, sf_dir):
    return marts.r_medc(gated(spark, sf_dir, "medication"))


def treatments(spark, sf_dir):
    return written(marts.r_trmt(gated(spark, sf_dir, "treatment")))


def individuals(spark, sf_dir):
    return written(marts.r_indiv(gated(spark, sf_dir, "patient")))


def staff(spark, sf_dir):
    return written(marts.r_stf(gated(spark, sf_dir, "staff")))


def _register(name, query, sql):
    QUERIES[name] = lambda spark, sf_dir: plain(query(spark, sf_dir))
    ORACLE[name] = sql


_register("dim_room", lambda spark, sf: marts.r_room(gated(spark, sf, "room")), f"""{S.sql_work('room')}
    SELECT room_number AS room_num, room_name, floor_number AS flor_num,
        building_name AS buld_name, room_type AS room_typ, day_rate AS room_day_rate,
        created_date AS crtn_dt, CAST(7 AS BIGINT) AS exec_id FROM room_ok""")

_MEDC = """SELECT medicine_code AS medc_cd, medicine_name AS medc_name,
        medicine_packaging AS medc_cond, medicine_category AS medc_catg,
        manufacturer_brand AS manf_brnd, CAST(7 AS BIGINT) AS exec_id,
        row_number() OVER (ORDER BY medicine_code, medicine_category, manufacturer_brand)
            AS medc_id FROM medication_ok"""
_register(
    "dim_medication_sk",
    lambda spark, sf: marts.r_medc(gated(spark, sf, "medication")),
    f"{S.sql_work('medication')} {_MEDC}",
)

_PART = """SELECT row_number() OVER (ORDER BY src_typ, src_id) AS part_id, src_id, src_typ,
        CAST(7 AS BIGINT) AS exec_id
    FROM (SELECT patient_id AS src_id, 'Patient' AS src_typ FROM patient_ok
          UNION ALL SELECT staff_id, job_title FROM staff_ok)"""
_register(
    "dim_party_sk",
    lambda spark, sf: marts.r_part(gated(spark, sf, "patient"), gated(spark, sf, "staff")),
    f"{S.sql_work('patient', 'staff')} {_PART}",
)

_register(
    "dim_individual",
    lambda spark, sf: marts.r_indiv(gated(spark, sf, "patient")),
    f"""{S.sql_work('patient')} SELECT patient_id AS indiv_id, last_name, first_name,
        social_security_number, birth_date, birth_city, birth_country, created_at, updated_at,
        CAST(7 AS BIGINT) AS exec_id FROM patient_ok""",
)
_register(
    "dim_staff",
    lambda spark, sf: marts.r_stf(gated(spark, sf, "staff")),
    f"""{S.sql_work('staff')} SELECT staff_id, last_name, first_name, job_title, work_start_at,
        work_end_at, work_end_reason, status_code, created_at, updated_at,
        CAST(7 AS BIGINT) AS exec_id FROM staff_ok""",
)
_register(
    "dim_address",
    lambda spark, sf: marts.r_addr(gated(spark, sf, "patient")),
    f"""{S.sql_work('patient')} SELECT patient_id AS indiv_id, street_number, street_name,
        address_complement, postal_code, city, country, CAST(7 AS BIGINT) AS exec_id
    FROM patient_ok
    WHERE street_name IS NOT NULL OR postal_code IS NOT NULL OR city IS NOT NULL""",
)
_register(
    "dim_phone",
    lambda spark, sf: marts.r_tel(gated(spark, sf, "patient")),
    f"""{S.sql_work('patient')} SELECT patient_id AS indiv_id, phone_country_code, phone_number,
        CAST(7 AS BIGINT) AS exec_id FROM patient_ok WHERE phone_number IS NOT NULL""",
)
_register(
    "dim_treatment",
    lambda spark, sf: marts.r_trmt(gated(spark, sf, "treatment")),
    f"""{S.sql_work('treatment')} SELECT treatment_id, consultation_id, medicine_code,
        medicine_category, manufacturer_brand,
        CAST(medicine_quantity AS DOUBLE) AS medicine_quantity, dosage_description, created_at,
        CAST(7 AS BIGINT) AS exec_id FROM treatment_ok""",
)
_register(
    "fact_consultation",
    lambda spark, sf: marts.fait_consult(gated(spark, sf, "consultation")),
    f"""{S.sql_work('consultation')}
    SELECT consultation_id, patient_id, staff_id, treatment_id, started_at, ended_at,
        CAST(patient_weight_kg AS DOUBLE) AS patient_weight_kg,
        CAST(patient_temperature AS DOUBLE) AS patient_temperature, temperature_unit,
        blood_pressure, pathology_description, diabetes_indicator, hospitalisation_indicator,
        CAST(7 AS BIGINT) AS exec_id,
        date_diff('minute', started_at, ended_at) AS duration_minutes FROM consultation_ok""",
)
_STAY_COLS = """hospi_id, consultation_id, room_number, responsible_staff_id, started_at,
        ended_at, CAST(cost AS DOUBLE) AS cost, CAST(7 AS BIGINT) AS exec_id,
        date_diff('day', started_at, ended_at) AS duration_days"""
_register(
    "fact_stay",
    lambda spark, sf: marts.r_hospi(gated(spark, sf, "stay")),
    f"{S.sql_work('shipment')} SELECT {_STAY_COLS} FROM shipment_ok",
)

_AGE = """SELECT pathology_description, c.patient_id, CAST(started_at AS DATE) AS report_date,
        CAST(floor(date_diff('day', CAST(birth_date AS TIMESTAMP), started_at) / 365.25)
            AS BIGINT) AS age_at_consultation
    FROM consultation_ok c JOIN patient_ok p ON c.patient_id = p.patient_id
    WHERE pathology_description IS NOT NULL AND birth_date IS NOT NULL"""


def kpi_age(spark, sf_dir):
    return kpis.avg_age_by_pathology(fact(spark, sf_dir), individuals(spark, sf_dir))


_register("kpi_age", kpi_age, f"{S.sql_work('consultation', 'patient')} {_AGE}")
_register(
    "kpi_age_period",
    lambda spark, sf: kpis.age_rollup(kpi_age(spark, sf), "month"),
    f"""{S.sql_work('consultation', 'patient')}, v AS ({_AGE})
    SELECT pathology_description, CAST(date_trunc('month', report_date) AS DATE) AS period,
        avg(age_at_consultation) AS avg_age, count(DISTINCT patient_id) AS n_patients
    FROM v GROUP BY ALL""",
)

_MED = """SELECT pathology_description, CAST(started_at AS DATE) AS report_date,
        t.medicine_code, coalesce(medicine_name, t.medicine_code) AS medicine_name,
        t.medicine_category, t.manufacturer_brand,
        CAST(sum(coalesce(medicine_quantity, 0)) AS DOUBLE) AS total_quantity
    FROM consultation_ok c JOIN treatment_ok t ON c.treatment_id = t.treatment_id
    LEFT JOIN medication_ok m ON t.medicine_code = m.medicine_code
        AND t.medicine_category = m.medicine_category
        AND t.manufacturer_brand = m.manufacturer_brand
    WHERE pathology_description IS NOT NULL GROUP BY ALL"""


def kpi_medication(spark, sf_dir):
    return kpis.top_medication_by_pathology(
        fact(spark, sf_dir), treatments(spark, sf_dir), medications(spark, sf_dir)
    )


_MED_WORK = S.sql_work("consultation", "treatment", "medication")
_register("kpi_medication", kpi_medication, f"{_MED_WORK} {_MED}")
_register(
    "kpi_medication_topn",
    lambda spark, sf: kpis.top_medication_rollup(kpi_medication(spark, sf), "month", 3),
    f"""{_MED_WORK}, v AS ({_MED}), s AS (
        SELECT pathology_description, CAST(date_trunc('month', report_date) AS DATE) AS period,
            medicine_code, medicine_name, medicine_category, manufacturer_brand,
            sum(total_quantity) AS total_quantity FROM v GROUP BY ALL)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pathology_description, period
        ORDER BY total_quantity DESC, medicine_code, medicine_name, medicine_category,
            manufacturer_brand) AS medication_rank FROM s) WHERE medication_rank <= 3""",
)

_ROOMS = """SELECT pathology_description, s.room_number, CAST(c.started_at AS DATE) AS report_date
    FROM consultation_ok c JOIN stay_ok s ON c.consultation_id = s.consultation_id
    JOIN room_ok r ON s.room_number = r.room_number WHERE pathology_description IS NOT NULL"""
_ROOMS_WORK = S.sql_work("consultation", "stay", "room")


def kpi_rooms(spark, sf_dir):
    return kpis.rooms_by_pathology(
        fact(spark, sf_dir), stays(spark, sf_dir), rooms(spark, sf_dir)
    )


_register("kpi_rooms", kpi_rooms, f"{_ROOMS_WORK} {_ROOMS}")
_register(
    "kpi_rooms_period",
    lambda spark, sf: kpis.rooms_rollup(kpi_rooms(spark, sf), "year"),
    f"""{_ROOMS_WORK}, v AS ({_ROOMS})
    SELECT pathology_description, CAST(date_trunc('year', report_date) AS DATE) AS period,
        count(DISTINCT room_number) AS n_rooms FROM v GROUP BY ALL""",
)

_SPEC = """SELECT pathology_description, c.staff_id, job_title AS specialty,
        CAST(started_at AS DATE) AS report_date
    FROM consultation_ok c JOIN staff_ok s ON c.staff_id = s.staff_id
    WHERE pathology_description IS NOT NULL"""
_SPEC_WORK = S.sql_work("consultation", "staff")


def kpi_specialty(spark, sf_dir):
    return kpis.doctor_speciality_by_pathology(fact(spark, sf_dir), staff(spark, sf_dir))


_register("kpi_specialty", kpi_specialty, f"{_SPEC_WORK} {_SPEC}")
_register(
    "kpi_specialty_share",
    lambda spark, sf: kpis.specialty_rollup(kpi_specialty(spark, sf), "month"),
    f"""{_SPEC_WORK}, v AS ({_SPEC}), n AS (
        SELECT pathology_description, CAST(date_trunc('month', report_date) AS DATE) AS period,
            specialty, count(DISTINCT staff_id) AS n_doctors FROM v GROUP BY ALL)
    SELECT *, n_doctors * 100.0::DOUBLE / CAST(sum(n_doctors) OVER (
        PARTITION BY pathology_description, period) AS BIGINT) AS share_pct FROM n""",
)

_NIGHT = """SELECT CAST(started_at AS DATE) AS report_date, count(*) AS total_hospitalisations,
        count(*) FILTER (WHERE night) AS one_night_plus_count,
        round(100.0::DOUBLE * count(*) FILTER (WHERE night) / count(*), 2) AS one_night_plus_pct
    FROM (SELECT started_at, date_trunc('day', ended_at) > date_trunc('day', started_at)
            AND date_trunc('hour', ended_at) >= date_trunc('hour', started_at) + INTERVAL 8 HOUR
            AS night
        FROM stay_ok)
    GROUP BY report_date"""
_register(
    "kpi_one_night",
    lambda spark, sf: kpis.patients_one_night(stays(spark, sf)),
    f"{S.sql_work('stay')} {_NIGHT}",
)

# One row for every day of every stay, an open one lasting to the last consultation.
_OCC = """SELECT day AS report_date, room_number AS room_num, any_value(room_name) AS room_name,
        any_value(room_type) AS room_typ, any_value(building_name) AS buld_name,
        CAST(least(count(slept), 1) AS INTEGER) AS is_occupied,
        if(count(slept) = 0, 'Libre', 'Occupée') AS occupancy_status
    FROM (SELECT room_ok.*, day FROM room_ok,
            (SELECT DISTINCT CAST(started_at AS DATE) AS day FROM consultation_ok))
    LEFT JOIN (SELECT room_number, 1 AS slept, CAST(unnest(generate_series(
            date_trunc('day', CAST(started_at AS TIMESTAMP)),
            coalesce(ended_at, (SELECT max(started_at) FROM consultation_ok)),
            INTERVAL 1 DAY)) AS DATE) AS day
        FROM stay_ok) USING (room_number, day)
    GROUP BY day, room_number"""


def kpi_occupancy(spark, sf_dir):
    return kpis.empty_rooms(fact(spark, sf_dir), stays(spark, sf_dir), rooms(spark, sf_dir))


_register("kpi_occupancy", kpi_occupancy, f"{_ROOMS_WORK} {_OCC}")
_OCC_ROLLUP = """SELECT period, CAST(sum(u) AS BIGINT) AS occupied_rooms, count(*) AS total_rooms,
        count(*) - CAST(sum(u) AS BIGINT) AS free_rooms
    FROM (SELECT {period} AS period, room_num, max(is_occupied) AS u FROM v GROUP BY ALL)
    GROUP BY ALL"""
_register(
    "kpi_occupancy_period",
    lambda spark, sf: kpis.occupancy_periods(fact(spark, sf), stays(spark, sf), rooms(spark, sf), "month"),
    f"{_ROOMS_WORK}, v AS ({_OCC}) "
    + _OCC_ROLLUP.format(period="CAST(date_trunc('month', report_date) AS DATE)"),
)
_register(
    "kpi_occupancy_week",
    lambda spark, sf: kpis.occupancy_rollup(
        kpis.in_period(kpi_occupancy(spark, sf), date(2024, 1, 8), date(2024, 1, 14)), "day"
    ),
    f"{_ROOMS_WORK}, v AS (SELECT * FROM ({_OCC}) WHERE report_date BETWEEN DATE '2024-01-08'"
    " AND DATE '2024-01-14') " + _OCC_ROLLUP.format(period="report_date"),
)
_register(
    "kpi_occupancy_days",
    lambda spark, sf: kpis.occupancy_periods(
        fact(spark, sf), stays(spark, sf), rooms(spark, sf), "day", date(2024, 1, 3), date(2024, 1, 24)
    ),
    f"{_ROOMS_WORK}, v AS (SELECT * FROM ({_OCC}) WHERE report_date BETWEEN DATE '2024-01-03'"
    " AND DATE '2024-01-24') "
    + _OCC_ROLLUP.format(period="report_date"),
)


def _of_states(view, state, rollup, period):
    """A roll-up from the written states of the days of a view."""
    return lambda spark, sf: rollup(written(kpis.daily_state(view(spark, sf), **state)), period)


_register(
    "kpi_age_states", _of_states(kpi_age, kpis.AGE_STATE, kpis.age_from_states, "year"),
    f"""{S.sql_work('consultation', 'patient')}, v AS ({_AGE})
    SELECT pathology_description, CAST(date_trunc('year', report_date) AS DATE) AS period,
        avg(age_at_consultation) AS avg_age, count(DISTINCT patient_id) AS n_patients
    FROM v GROUP BY ALL""",
)
_register(
    "kpi_rooms_states", _of_states(kpi_rooms, kpis.ROOM_STATE, kpis.rooms_from_states, "month"),
    f"""{_ROOMS_WORK}, v AS ({_ROOMS})
    SELECT pathology_description, CAST(date_trunc('month', report_date) AS DATE) AS period,
        count(DISTINCT room_number) AS n_rooms FROM v GROUP BY ALL""",
)
_register(
    "kpi_specialty_states",
    _of_states(kpi_specialty, kpis.SPECIALTY_STATE, kpis.specialty_from_states, "year"),
    f"""{_SPEC_WORK}, v AS ({_SPEC}), n AS (
        SELECT pathology_description, CAST(date_trunc('year', report_date) AS DATE) AS period,
            specialty, count(DISTINCT staff_id) AS n_doctors FROM v GROUP BY ALL)
    SELECT *, n_doctors * 100.0::DOUBLE / CAST(sum(n_doctors) OVER (
        PARTITION BY pathology_description, period) AS BIGINT) AS share_pct FROM n""",
)


def view_refresh(spark, sf_dir):
    """Ages by day, stored, then brought up to consultations and birth dates that changed on few days."""
    new = star(spark, sf_dir)
    late = (F.col("started_at") < "2024-01-05") | (F.col("consultation_id") % 997 != 5)
    old = new | {
        "fait_consult": new["fait_consult"].filter(late),
        "r_indiv": new["r_indiv"].withColumn(
            "birth_date", F.when(F.col("indiv_id") != 11, F.col("birth_date"))
        ),
    }
    path = work_path(spark, "view")
    name = "vw_avg_age_by_pathology"
    refresh(spark, path, name, {n: df.limit(0) for n, df in old.items()}, old)
    days = refresh(spark, path, name, old, new)
    return spark.read.parquet(path).withColumn("n_days", F.lit(len(days)).cast("long"))


_STAR = {
    "r_trmt": treatments, "fait_consult": fact, "r_hospi": stays, "r_indiv": individuals, "r_room": rooms,
    "r_medc": lambda spark, sf: written(medications(spark, sf)), "r_stf": staff,
}


def star(spark, sf_dir):
    """The seven marts that the views read, written side by side."""
    made = at_once([partial(build, spark, sf_dir) for build in _STAR.values()])
    return dict(zip(_STAR, made))


_register(
    "view_refresh", view_refresh,
    f"""{S.sql_work('consultation', 'patient')}, v AS ({_AGE}), d AS (
        SELECT CAST(started_at AS DATE) AS day FROM consultation_ok
            WHERE started_at >= TIMESTAMP '2024-01-05' AND consultation_id % 997 = 5
        UNION SELECT CAST(started_at AS DATE) FROM consultation_ok JOIN patient_ok USING (patient_id)
            WHERE patient_id = 11 AND birth_date IS NOT NULL)
    SELECT *, (SELECT count(DISTINCT day) FROM d) AS n_days FROM v""",
)
