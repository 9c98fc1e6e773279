"""Staged hospital tables derived from the driver's tables.

Whole tables are read, some values spoiled by a fixed rule so that the quality
gates have something to reject. Each function has its SQL twin in ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that opening a table starts no job.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def number_in_props():
    """The number in the events' JSON property.

    Cut out of the text: a JSON parser would run again for every column and
    rule that uses the number.
    """
    return F.expr("CAST(substring_index(substring_index(props, ': ', -1), '}', 1) AS BIGINT)")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer: no birth date when in debt, no update time for nation 7."""
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS patient_id",
        "c_name AS last_name",
        "nullif(c_mktsegment, 'FURNITURE') AS first_name",
        "CASE WHEN c_acctbal >= 0 THEN date_sub(DATE'1995-01-01', CAST(floor(c_acctbal) AS INT))"
        " END AS birth_date",
        "CAST(c_nationkey AS STRING) AS birth_city",
        "CAST(NULL AS STRING) AS birth_country",
        "CAST(c_custkey AS STRING) AS social_security_number",
        "concat('+', c_nationkey) AS phone_country_code",
        "CASE WHEN c_acctbal >= 0 THEN lpad(CAST(c_custkey AS STRING), 10, '0') END AS phone_number",
        "CAST(c_nationkey AS STRING) AS street_number",
        "nullif(c_mktsegment, 'MACHINERY') AS street_name",
        "CAST(NULL AS STRING) AS address_complement",
        "CASE WHEN c_nationkey >= 10 THEN CAST(c_nationkey AS STRING) END AS postal_code",
        "CASE WHEN c_nationkey >= 5 THEN concat('City ', c_nationkey) END AS city",
        "CAST(NULL AS STRING) AS country",
        "TIMESTAMP_NTZ'1992-01-01 00:00:00' AS created_at",
        "CASE WHEN c_nationkey <> 7 THEN CAST(date_add(DATE'1996-01-01', c_nationkey * 30)"
        " AS TIMESTAMP_NTZ) END AS updated_at",
    )


def staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier: job by nation, no status when in debt."""
    return read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS staff_id",
        "s_name AS last_name",
        "concat('First ', s_nationkey) AS first_name",
        "CASE WHEN s_nationkey < 8 THEN 'Generaliste' WHEN s_nationkey < 14 THEN 'Chirurgien'"
        " WHEN s_nationkey < 19 THEN 'Dermatologiste' WHEN s_nationkey < 23 THEN 'Dentiste'"
        " ELSE 'Cardiologue' END AS job_title",
        "TIMESTAMP_NTZ'2024-01-01 08:00:00' AS work_start_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS work_end_at",
        "CAST(NULL AS STRING) AS work_end_reason",
        "TIMESTAMP_NTZ'1999-03-01 00:00:00' AS created_at",
        "TIMESTAMP_NTZ'2024-02-23 00:00:00' AS updated_at",
        "CASE WHEN s_acctbal >= 0 THEN 'Actif' END AS status_code",
    )


def rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as rooms: day rate from the balance, so some are not positive."""
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS room_number",
        "c_name AS room_name",
        "c_nationkey AS floor_number",
        "c_mktsegment AS building_name",
        "concat('Type ', length(c_mktsegment)) AS room_type",
        "CAST(floor(c_acctbal / 100) AS INT) AS day_rate",
        "CASE WHEN c_nationkey <> 3 THEN DATE'1999-03-01' END AS created_date",
    )


def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part on (name, type, brand), which repeats; small sizes carry no name."""
    return read(spark, sf_dir, "part").selectExpr(
        "p_name AS medicine_code",
        "CASE WHEN p_size >= 5 THEN concat(p_name, ' ', p_size) END AS medicine_name",
        "CAST(p_size AS STRING) AS medicine_packaging",
        "nullif(p_type, 'PROMO') AS medicine_category",
        "p_brand AS manufacturer_brand",
    )


def treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem on (order, line), which repeats, with its part as medication."""
    part = read(spark, sf_dir, "part").selectExpr("p_partkey", "p_name", "p_type", "p_brand")
    lines = read(spark, sf_dir, "lineitem")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "l_orderkey * 8 + l_linenumber - 1 AS treatment_id",
        "l_orderkey AS consultation_id",
        "p_name AS medicine_code",
        "p_type AS medicine_category",
        "p_brand AS manufacturer_brand",
        "CASE WHEN l_tax > 0 THEN concat(l_returnflag, l_linestatus) END AS dosage_description",
        "CAST(l_quantity AS DECIMAL(8,3)) AS medicine_quantity",
        "l_shipdate AS created_at",
    )


def consultations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: doctor from the JSON property, length from the value (some negative)."""
    return (
        read(spark, sf_dir, "events")
        .withColumn("k", number_in_props())
        .selectExpr(
            "event_id AS consultation_id",
            "user_id AS patient_id",
            "k AS staff_id",
            "event_id * 8 AS treatment_id",
            "ts AS started_at",
            "CASE WHEN k <> 13 THEN ts + make_dt_interval(0, 0, 0,"
            " CAST(round(value * 60) AS INT) - 30) END AS ended_at",
            "CAST(50 + k AS DECIMAL(6,2)) AS patient_weight_kg",
            "CAST(CASE WHEN event_type = 'click' THEN 98 + k / 50 ELSE 36 + k / 50 END"
            " AS DECIMAL(5,2)) AS patient_temperature",
            "CASE event_type WHEN 'click' THEN 'F' WHEN 'error' THEN 'K' ELSE 'C' END"
            " AS temperature_unit",
            "k + 80 AS blood_pressure",
            "nullif(event_type, 'view') AS pathology_description",
            "k > 80 AS diabetes_indicator",
            "k % 3 <> 0 AS hospitalisation_indicator",
        )
    )


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as stays of a later event's consultation: room is the user, length from the
    value, open for the last k's."""
    return (
        read(spark, sf_dir, "events")
        .withColumn("k", number_in_props())
        .selectExpr(
            "event_id AS hospi_id",
            "event_id + k AS consultation_id",
            "user_id AS room_number",
            "k AS responsible_staff_id",
            "ts AS started_at",
            "CASE WHEN k < 95 THEN ts + make_dt_interval(0, 0, 0,"
            " CAST(round(value * 3600) AS INT) - 3600) END AS ended_at",
            "CAST(value * 10 - 5 AS DECIMAL(10,2)) AS cost",
        )
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order as stays: half of them end before they start."""
    orders = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "o_orderdate")
    lines = read(spark, sf_dir, "lineitem")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey * 8 + l_linenumber - 1 AS hospi_id",
        "l_orderkey AS consultation_id",
        "o_custkey AS room_number",
        "l_suppkey AS responsible_staff_id",
        "o_orderdate AS started_at",
        "CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS ended_at",
        "CAST(l_extendedprice - 20000 AS DECIMAL(10,2)) AS cost",
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as consultations keyed by customer: many versions of each key."""
    return read(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS consultation_id",
        "o_custkey AS patient_id",
        "CAST(length(o_orderpriority) AS BIGINT) AS staff_id",
        "o_orderkey AS treatment_id",
        "o_orderdate AS started_at",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + make_dt_interval(0, 0, 30) END"
        " AS ended_at",
        "o_orderpriority AS pathology_description",
    )


# The same tables for the SQL side, as common table expressions.
SQL: dict[str, str] = {
    "patient": """patient AS (SELECT
        c_custkey AS patient_id, c_name AS last_name,
        nullif(c_mktsegment, 'FURNITURE') AS first_name,
        CASE WHEN c_acctbal >= 0 THEN DATE '1995-01-01' - CAST(floor(c_acctbal) AS INTEGER) END
            AS birth_date,
        CAST(c_nationkey AS VARCHAR) AS birth_city, CAST(NULL AS VARCHAR) AS birth_country,
        CAST(c_custkey AS VARCHAR) AS social_security_number,
        '+' || c_nationkey AS phone_country_code,
        CASE WHEN c_acctbal >= 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') END
            AS phone_number,
        CAST(c_nationkey AS VARCHAR) AS street_number,
        nullif(c_mktsegment, 'MACHINERY') AS street_name,
        CAST(NULL AS VARCHAR) AS address_complement,
        CASE WHEN c_nationkey >= 10 THEN CAST(c_nationkey AS VARCHAR) END AS postal_code,
        CASE WHEN c_nationkey >= 5 THEN 'City ' || c_nationkey END AS city,
        CAST(NULL AS VARCHAR) AS country,
        TIMESTAMP '1992-01-01 00:00:00' AS created_at,
        CASE WHEN c_nationkey <> 7
            THEN CAST(DATE '1996-01-01' + c_nationkey * 30 AS TIMESTAMP) END AS updated_at
        FROM customer)""",
    "staff": """staff AS (SELECT
        s_suppkey AS staff_id, s_name AS last_name, 'First ' || s_nationkey AS first_name,
        CASE WHEN s_nationkey < 8 THEN 'Generaliste' WHEN s_nationkey < 14 THEN 'Chirurgien'
            WHEN s_nationkey < 19 THEN 'Dermatologiste' WHEN s_nationkey < 23 THEN 'Dentiste'
            ELSE 'Cardiologue' END AS job_title,
        TIMESTAMP '2024-01-01 08:00:00' AS work_start_at,
        CAST(NULL AS TIMESTAMP) AS work_end_at, CAST(NULL AS VARCHAR) AS work_end_reason,
        TIMESTAMP '1999-03-01 00:00:00' AS created_at,
        TIMESTAMP '2024-02-23 00:00:00' AS updated_at,
        CASE WHEN s_acctbal >= 0 THEN 'Actif' END AS status_code
        FROM supplier)""",
    "room": """room AS (SELECT
        c_custkey AS room_number, c_name AS room_name, c_nationkey AS floor_number,
        c_mktsegment AS building_name, 'Type ' || length(c_mktsegment) AS room_type,
        CAST(floor(c_acctbal / 100) AS INTEGER) AS day_rate,
        CASE WHEN c_nationkey <> 3 THEN DATE '1999-03-01' END AS created_date
        FROM customer)""",
    "medication": """medication AS (SELECT
        p_name AS medicine_code,
        CASE WHEN p_size >= 5 THEN p_name || ' ' || p_size END AS medicine_name,
        CAST(p_size AS VARCHAR) AS medicine_packaging,
        nullif(p_type, 'PROMO') AS medicine_category, p_brand AS manufacturer_brand
        FROM part)""",
    "treatment": """treatment AS (SELECT
        l_orderkey * 8 + l_linenumber - 1 AS treatment_id, l_orderkey AS consultation_id,
        p_name AS medicine_code, p_type AS medicine_category, p_brand AS manufacturer_brand,
        CASE WHEN l_tax > 0 THEN l_returnflag || l_linestatus END AS dosage_description,
        CAST(l_quantity AS DECIMAL(8,3)) AS medicine_quantity, l_shipdate AS created_at
        FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "consultation": """consultation AS (SELECT
        event_id AS consultation_id, user_id AS patient_id, k AS staff_id,
        event_id * 8 AS treatment_id, ts AS started_at,
        CASE WHEN k <> 13 THEN ts + to_seconds(CAST(round(value * 60) AS INTEGER) - 30) END
            AS ended_at,
        CAST(50 + k AS DECIMAL(6,2)) AS patient_weight_kg,
        CAST(CASE WHEN event_type = 'click' THEN 98 + k / 50 ELSE 36 + k / 50 END
            AS DECIMAL(5,2)) AS patient_temperature,
        CASE event_type WHEN 'click' THEN 'F' WHEN 'error' THEN 'K' ELSE 'C' END
            AS temperature_unit,
        k + 80 AS blood_pressure, nullif(event_type, 'view') AS pathology_description,
        k > 80 AS diabetes_indicator, k % 3 <> 0 AS hospitalisation_indicator
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
              FROM events))""",
    "stay": """stay AS (SELECT
        event_id AS hospi_id, event_id + k AS consultation_id, user_id AS room_number,
        k AS responsible_staff_id, ts AS started_at,
        CASE WHEN k < 95 THEN ts + to_seconds(CAST(round(value * 3600) AS INTEGER) - 3600) END
            AS ended_at,
        CAST(value * 10 - 5 AS DECIMAL(10,2)) AS cost
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
              FROM events))""",
    "shipment": """shipment AS (SELECT
        l_orderkey * 8 + l_linenumber - 1 AS hospi_id, l_orderkey AS consultation_id,
        o_custkey AS room_number, l_suppkey AS responsible_staff_id, o_orderdate AS started_at,
        CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS ended_at,
        CAST(l_extendedprice - 20000 AS DECIMAL(10,2)) AS cost
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "visit": """visit AS (SELECT
        o_custkey AS consultation_id, o_custkey AS patient_id,
        CAST(length(o_orderpriority) AS BIGINT) AS staff_id, o_orderkey AS treatment_id,
        o_orderdate AS started_at,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 30 MINUTE END AS ended_at,
        o_orderpriority AS pathology_description
        FROM orders)""",
}


def _sql_rules(name: str) -> str:
    return {
        "patient": """CASE WHEN patient_id IS NULL THEN 'NULL_MANDATORY'
            WHEN patient_id <= 0 THEN 'WRONG_FORMAT'
            WHEN last_name IS NULL OR first_name IS NULL OR created_at IS NULL
                OR updated_at IS NULL THEN 'NULL_MANDATORY' END""",
        "staff": """CASE WHEN staff_id IS NULL THEN 'NULL_MANDATORY'
            WHEN staff_id <= 0 THEN 'WRONG_FORMAT'
            WHEN last_name IS NULL OR first_name IS NULL OR job_title IS NULL
                OR work_start_at IS NULL OR created_at IS NULL OR updated_at IS NULL
                OR status_code IS NULL THEN 'NULL_MANDATORY' END""",
        "room": """CASE WHEN room_number IS NULL THEN 'NULL_MANDATORY'
            WHEN room_number <= 0 THEN 'WRONG_FORMAT'
            WHEN room_name IS NULL OR day_rate IS NULL THEN 'NULL_MANDATORY'
            WHEN day_rate <= 0 THEN 'WRONG_FORMAT'
            WHEN created_date IS NULL THEN 'NULL_MANDATORY' END""",
        "medication": """CASE WHEN medicine_code IS NULL OR medicine_category IS NULL
            OR manufacturer_brand IS NULL THEN 'NULL_MANDATORY' END""",
        "treatment": """CASE WHEN treatment_id IS NULL THEN 'NULL_MANDATORY'
            WHEN treatment_id <= 0 THEN 'WRONG_FORMAT'
            WHEN consultation_id IS NULL OR medicine_code IS NULL OR medicine_category IS NULL
                OR manufacturer_brand IS NULL OR dosage_description IS NULL
                THEN 'NULL_MANDATORY' END""",
        "consultation": """CASE WHEN consultation_id IS NULL THEN 'NULL_MANDATORY'
            WHEN consultation_id <= 0 THEN 'WRONG_FORMAT'
            WHEN patient_id IS NULL OR staff_id IS NULL OR started_at IS NULL
                OR ended_at IS NULL THEN 'NULL_MANDATORY'
            WHEN ended_at < started_at THEN 'WRONG_FORMAT' END""",
        "stay": """CASE WHEN hospi_id IS NULL THEN 'NULL_MANDATORY'
            WHEN hospi_id <= 0 THEN 'WRONG_FORMAT'
            WHEN consultation_id IS NULL OR room_number IS NULL OR responsible_staff_id IS NULL
                OR started_at IS NULL THEN 'NULL_MANDATORY'
            WHEN ended_at < started_at OR cost < 0 THEN 'WRONG_FORMAT' END""",
    }[name]


# Keys and latest-version order of each stand-in; ties are broken by the other
# columns, so that both sides keep the same row.
_VERSIONS = {
    "patient": ("patient_id", "updated_at DESC NULLS LAST, created_at DESC NULLS LAST, last_name"),
    "staff": ("staff_id", "updated_at DESC NULLS LAST, created_at DESC NULLS LAST, last_name"),
    "room": ("room_number", "created_date DESC NULLS LAST, room_name"),
    "medication": (
        "medicine_code, medicine_category, manufacturer_brand",
        "medicine_name ASC NULLS LAST, medicine_packaging ASC NULLS LAST",
    ),
    "treatment": (
        "treatment_id",
        "created_at DESC NULLS LAST, treatment_id, consultation_id, medicine_code,"
        " medicine_category, manufacturer_brand, dosage_description ASC NULLS LAST,"
        " medicine_quantity",
    ),
    "consultation": ("consultation_id", "started_at DESC NULLS LAST"),
    "stay": ("hospi_id", "started_at DESC NULLS LAST"),
    "shipment": (
        "hospi_id",
        "started_at DESC NULLS LAST, consultation_id, room_number, responsible_staff_id,"
        " ended_at ASC NULLS LAST, cost",
    ),
    "visit": (
        "consultation_id",
        "started_at DESC NULLS LAST, patient_id, staff_id, treatment_id, ended_at ASC NULLS LAST,"
        " pathology_description",
    ),
}
_RULES_OF = {"shipment": "stay", "visit": "consultation"}


def sql_tables(*names: str) -> str:
    """``WITH`` list of staged stand-ins."""
    return "WITH " + ", ".join(SQL[n] for n in names)


def sql_tagged(name: str) -> str:
    """``<name>_q``: the stand-in with its status and code."""
    return (
        f"{name}_q AS (SELECT *, CASE WHEN rej_cod IS NULL THEN 'OK' ELSE 'REJ' END AS wrk_stts_cd"
        f" FROM (SELECT *, {_sql_rules(_RULES_OF.get(name, name))} AS rej_cod FROM {name}))"
    )


def sql_gated(name: str) -> str:
    """``<name>_ok``: accepted rows, latest version of each key."""
    keys, order = _VERSIONS[name]
    return (
        f"{sql_tagged(name)}, {name}_ok AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number()"
        f" OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {name}_q"
        f" WHERE wrk_stts_cd = 'OK') WHERE rn = 1)"
    )


def sql_work(*names: str) -> str:
    """``WITH`` list of stand-ins and their gated forms."""
    return "WITH " + ", ".join(f"{SQL[n]}, {sql_gated(n)}" for n in names)
