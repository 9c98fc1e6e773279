"""Staging projections, quality gates and deduplication on the driver's tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from wardhouse import contracts as C
from wardhouse.operators.dedup import latest_per_key
from wardhouse.operators.quality import check_rows, reject_breakdown
from wardhouse.operators.rejects import duplicate_rejects
from wardhouse.plans.staging import stage
from wardhouse.plans.work import work
from wardhouse.session import work_path
from warehouse_queries import standins as S

BATCH = date(2026, 4, 29)
EXEC = 7

_TABLES = {
    "patient": (S.patients, C.PATIENT),
    "staff": (S.staff, C.PERSONNEL),
    "room": (S.rooms, C.CHAMBRE),
    "medication": (S.medications, C.MEDICAMENT),
    "treatment": (S.treatments, C.TRAITEMENT),
    "consultation": (S.consultations, C.CONSULTATION),
    "stay": (S.shipments, C.HOSPITALISATION),
}
_STAMPS = "CAST(NULL AS VARCHAR) AS rej_dsc, DATE '2026-04-29' AS batch_dt, CAST(7 AS BIGINT) AS exec_id"


def plain(df):
    """Decimals as doubles, so that both engines return the same value type."""
    names = [n for n, t in df.dtypes if t.startswith("decimal")]
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def written(df):
    """The rows as a table, the form in which a daily run hands work and marts on."""
    spark = df.sparkSession
    path = work_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gated(spark, sf_dir, name):
    source, table = _TABLES[name]
    return work(source(spark, sf_dir), table, BATCH, EXEC)


def _qc(name):
    return lambda spark, sf_dir: plain(gated(spark, sf_dir, name))


def _qc_sql(name, decimals=()):
    sql_name = "shipment" if name == "stay" else name
    fix = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in decimals)
    cols = f"* REPLACE ({fix})" if fix else "*"
    return (
        f"{S.sql_work(sql_name)} SELECT {cols}, {_STAMPS} FROM {sql_name}_ok"
        f" UNION ALL SELECT {cols}, {_STAMPS} FROM {sql_name}_q WHERE wrk_stts_cd = 'REJ'"
    )


_DECIMALS = {
    "treatment": ("medicine_quantity",),
    "consultation": ("patient_weight_kg", "patient_temperature"),
    "stay": ("cost",),
}

QUERIES = {f"qc_{name}": _qc(name) for name in _TABLES}
ORACLE = {f"qc_{name}": _qc_sql(name, _DECIMALS.get(name, ())) for name in _TABLES}


def _staging(name):
    """Stand-ins under their loaded names, projected back to the staging layer."""
    source, table = _TABLES[name]

    def query(spark, sf_dir):
        staged = source(spark, sf_dir)
        loaded = staged.select(*[F.col(c.staged).alias(c.target) for c in table.columns])
        return plain(stage(loaded, table))

    return query


for _name in _TABLES:
    _sql_name = "shipment" if _name == "stay" else _name
    _fix = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DECIMALS.get(_name, ()))
    QUERIES[f"staging_{_name}"] = _staging(_name)
    ORACLE[f"staging_{_name}"] = (
        f"{S.sql_tables(_sql_name)} SELECT {f'* REPLACE ({_fix})' if _fix else '*'} FROM {_sql_name}"
    )


def _breakdown(spark, sf_dir):
    return reject_breakdown({name: gated(spark, sf_dir, name) for name in _TABLES})


QUERIES["reject_breakdown"] = _breakdown


def _breakdown_sql():
    parts, ctes = [], []
    for name in _TABLES:
        sql_name = "shipment" if name == "stay" else name
        ctes.append(f"{S.SQL[sql_name]}, {S.sql_gated(sql_name)}")
        for rows in (f"{sql_name}_ok", f"{sql_name}_q WHERE wrk_stts_cd = 'REJ'"):
            parts.append(
                f"SELECT '{name}' AS src_table, wrk_stts_cd, rej_cod, count(*) AS n_rows"
                f" FROM {rows} GROUP BY ALL"
            )
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(parts)


ORACLE["reject_breakdown"] = _breakdown_sql()


def qc_text(spark, sf_dir):
    """Rules over raw text: a malformed value is told apart from a missing one."""
    text = S.read(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'none'"
        " ELSE CAST(l_orderkey AS STRING) END AS hospi_id",
        "CAST(l_orderkey AS STRING) AS consultation_id",
        "CASE WHEN l_linenumber < 7 THEN CAST(l_partkey AS STRING) END AS room_number",
        "CAST(l_suppkey AS STRING) AS responsible_staff_id",
        "CASE WHEN l_tax = 0 THEN 'yesterday' ELSE CAST(l_shipdate AS STRING) END AS started_at",
        "CASE WHEN l_discount = 0 THEN NULL WHEN l_discount < 0.02 THEN '1990-01-01 00:00:00'"
        " ELSE '2030-01-01 00:00:00' END AS ended_at",
        "CASE WHEN l_quantity < 10 THEN '-1' WHEN l_quantity < 20 THEN 'free' ELSE '5.5' END AS cost",
    )
    return check_rows(text, C.TEXT_RULES["HOSPITALISATION"], BATCH, EXEC).select(
        "hospi_id", "room_number", "started_at", "ended_at", "cost", "wrk_stts_cd", "rej_cod"
    )


QUERIES["qc_text_rules"] = qc_text
ORACLE["qc_text_rules"] = """
    WITH t AS (SELECT
        CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'none'
            ELSE CAST(l_orderkey AS VARCHAR) END AS hospi_id,
        CASE WHEN l_linenumber < 7 THEN CAST(l_partkey AS VARCHAR) END AS room_number,
        CASE WHEN l_tax = 0 THEN 'yesterday' ELSE CAST(l_shipdate AS VARCHAR) END AS started_at,
        CASE WHEN l_discount = 0 THEN NULL WHEN l_discount < 0.02 THEN '1990-01-01 00:00:00'
            ELSE '2030-01-01 00:00:00' END AS ended_at,
        CASE WHEN l_quantity < 10 THEN '-1' WHEN l_quantity < 20 THEN 'free' ELSE '5.5' END AS cost
        FROM lineitem),
    q AS (SELECT *, CASE
        WHEN try_cast(hospi_id AS DOUBLE) IS NULL OR try_cast(hospi_id AS DOUBLE) <= 0
            THEN 'WRONG_FORMAT'
        WHEN room_number IS NULL THEN 'NULL_MANDATORY'
        WHEN try_cast(started_at AS TIMESTAMP) IS NULL THEN 'WRONG_FORMAT'
        WHEN try_cast(ended_at AS TIMESTAMP) < try_cast(started_at AS TIMESTAMP)
            THEN 'WRONG_FORMAT'
        WHEN try_cast(cost AS DOUBLE) < 0 THEN 'WRONG_FORMAT' END AS rej_cod FROM t)
    SELECT hospi_id, room_number, started_at, ended_at, cost,
        CASE WHEN rej_cod IS NULL THEN 'OK' ELSE 'REJ' END AS wrk_stts_cd, rej_cod FROM q"""


def qc_text_consultation(spark, sf_dir):
    """Consultations as raw text: ids, timestamps and their order are checked on the text."""
    text = S.read(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderstatus = 'P' THEN 'True' ELSE CAST(o_orderkey AS STRING) END"
        " AS consultation_id",
        "CASE WHEN o_totalprice > 20000 THEN CAST(o_custkey AS STRING) END AS patient_id",
        "o_orderpriority AS staff_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN '2026' WHEN '2-HIGH' THEN NULL"
        " ELSE CAST(o_orderdate AS STRING) END AS started_at",
        "CASE o_orderpriority WHEN '3-MEDIUM' THEN '1990-01-01' WHEN '5-LOW' THEN NULL"
        " ELSE '2030-01-01 08:00:00' END AS ended_at",
    )
    return check_rows(text, C.TEXT_RULES["CONSULTATION"], BATCH, EXEC).select(
        *text.columns, "wrk_stts_cd", "rej_cod"
    )


QUERIES["qc_text_consultation"] = qc_text_consultation
ORACLE["qc_text_consultation"] = """
    WITH t AS (SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'P' THEN 'True' ELSE CAST(o_orderkey AS VARCHAR) END
            AS consultation_id,
        CASE WHEN o_totalprice > 20000 THEN CAST(o_custkey AS VARCHAR) END AS patient_id,
        o_orderpriority AS staff_id,
        CASE o_orderpriority WHEN '1-URGENT' THEN '2026' WHEN '2-HIGH' THEN NULL
            ELSE CAST(o_orderdate AS VARCHAR) END AS started_at,
        CASE o_orderpriority WHEN '3-MEDIUM' THEN '1990-01-01' WHEN '5-LOW' THEN NULL
            ELSE '2030-01-01 08:00:00' END AS ended_at FROM orders),
    q AS (SELECT *, CASE WHEN consultation_id = 'True' OR o_orderkey <= 0 THEN 'WRONG_FORMAT'
        WHEN patient_id IS NULL OR started_at IS NULL THEN 'NULL_MANDATORY'
        WHEN started_at = '2026' THEN 'WRONG_FORMAT' WHEN ended_at IS NULL THEN 'NULL_MANDATORY'
        WHEN ended_at < started_at THEN 'WRONG_FORMAT' END AS rej_cod FROM t)
    SELECT consultation_id, patient_id, staff_id, started_at, ended_at,
        CASE WHEN rej_cod IS NULL THEN 'OK' ELSE 'REJ' END AS wrk_stts_cd, rej_cod FROM q"""


def qc_text_treatment(spark, sf_dir):
    text = S.read(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_size < 10 THEN p_name ELSE CAST(p_partkey AS STRING) END AS treatment_id",
        "CAST(p_partkey AS STRING) AS consultation_id",
        "p_name AS medicine_code",
        "nullif(p_type, 'PROMO') AS medicine_category",
        "p_brand AS manufacturer_brand",
        "CASE WHEN p_size < 40 THEN CAST(p_size AS STRING) END AS dosage_description",
    )
    return check_rows(text, C.TEXT_RULES["TRAITEMENT"], BATCH, EXEC).select(
        "treatment_id", "consultation_id", "wrk_stts_cd", "rej_cod"
    )


QUERIES["qc_text_treatment"] = qc_text_treatment
ORACLE["qc_text_treatment"] = """
    WITH q AS (SELECT CASE WHEN p_size < 10 THEN p_name ELSE CAST(p_partkey AS VARCHAR) END
            AS treatment_id, CAST(p_partkey AS VARCHAR) AS consultation_id,
        CASE WHEN p_size < 10 OR p_partkey <= 0 THEN 'WRONG_FORMAT'
            WHEN p_type = 'PROMO' OR p_size >= 40 THEN 'NULL_MANDATORY' END AS rej_cod FROM part)
    SELECT treatment_id, consultation_id,
        CASE WHEN rej_cod IS NULL THEN 'OK' ELSE 'REJ' END AS wrk_stts_cd, rej_cod FROM q"""


def qc_strict(spark, sf_dir):
    """Consultations behind the stricter gate: the weight is needed, and above zero."""
    rows = S.consultations(spark, sf_dir).withColumn(
        "patient_weight_kg",
        F.expr("CASE WHEN staff_id < 5 THEN NULL ELSE CAST(staff_id - 20 AS DECIMAL(6,2)) END"),
    )
    return check_rows(rows, C.STRICT_RULES["CONSULTATION"], BATCH, EXEC).select(
        "consultation_id", "wrk_stts_cd", "rej_cod"
    )


QUERIES["qc_strict_consultation"] = qc_strict
ORACLE["qc_strict_consultation"] = f"""
    {S.sql_tables('consultation')}, {S.sql_tagged('consultation')}, s AS (SELECT consultation_id,
        CASE WHEN rej_cod IS NOT NULL THEN rej_cod WHEN staff_id < 5 THEN 'NULL_MANDATORY'
            WHEN staff_id <= 20 THEN 'WRONG_FORMAT' END AS rej_cod FROM consultation_q)
    SELECT consultation_id, CASE WHEN rej_cod IS NULL THEN 'OK' ELSE 'REJ' END AS wrk_stts_cd,
        rej_cod FROM s"""


def _dedup(source, keys, order):
    return lambda spark, sf_dir: plain(latest_per_key(source(spark, sf_dir), keys, order))


def _dedup_sql(name, cols="*"):
    keys, order = S._VERSIONS[name]
    return (
        f"{S.sql_tables(name)} SELECT {cols} FROM (SELECT * EXCLUDE (rn) FROM (SELECT *,"
        f" row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {name})"
        f" WHERE rn = 1)"
    )


QUERIES["dedup_medication"] = _dedup(
    S.medications, C.MEDICAMENT.staged_keys, C.MEDICAMENT.latest_by
)
ORACLE["dedup_medication"] = _dedup_sql("medication")
QUERIES["dedup_treatment"] = _dedup(S.treatments, C.TRAITEMENT.staged_keys, C.TRAITEMENT.latest_by)
ORACLE["dedup_treatment"] = _dedup_sql(
    "treatment", "* REPLACE (CAST(medicine_quantity AS DOUBLE) AS medicine_quantity)"
)
QUERIES["dedup_consultation"] = _dedup(
    S.visits, C.CONSULTATION.staged_keys, C.CONSULTATION.latest_by
)
ORACLE["dedup_consultation"] = _dedup_sql("visit")
QUERIES["dedup_stay"] = _dedup(
    S.shipments, C.HOSPITALISATION.staged_keys, C.HOSPITALISATION.latest_by
)
ORACLE["dedup_stay"] = _dedup_sql("shipment", "* REPLACE (CAST(cost AS DOUBLE) AS cost)")


# Versions of patients, staff and rooms, taken from tables with many rows per id.


def patient_versions(spark, sf_dir):
    return S.read(spark, sf_dir, "events").selectExpr(
        "user_id AS patient_id", "event_type AS last_name", "ts AS updated_at",
        "CAST(DATE'2024-01-01' AS TIMESTAMP_NTZ) AS created_at", "event_id",
    )


def staff_versions(spark, sf_dir):
    return S.read(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS staff_id", "l_returnflag AS last_name", "l_linestatus AS status_code",
        "l_shipdate AS updated_at", "CAST(DATE'2024-01-01' AS TIMESTAMP_NTZ) AS created_at",
        "l_orderkey", "l_linenumber",
    )


def room_versions(spark, sf_dir):
    return S.read(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS room_number", "CAST(o_orderdate AS DATE) AS created_date",
        "o_orderpriority AS room_name", "o_orderkey",
    )


def _version_sql(columns, key, order, table):
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key}"
        f" ORDER BY {order}) AS rn FROM (SELECT {columns} FROM {table})) WHERE rn = 1"
    )


QUERIES["dedup_patient"] = _dedup(patient_versions, C.PATIENT.staged_keys, C.PATIENT.latest_by)
ORACLE["dedup_patient"] = _version_sql(
    "user_id AS patient_id, event_type AS last_name, ts AS updated_at,"
    " TIMESTAMP '2024-01-01' AS created_at, event_id",
    "patient_id", "updated_at DESC, created_at DESC, last_name, event_id", "events",
)
QUERIES["dedup_staff"] = _dedup(staff_versions, C.PERSONNEL.staged_keys, C.PERSONNEL.latest_by)
ORACLE["dedup_staff"] = _version_sql(
    "l_suppkey AS staff_id, l_returnflag AS last_name, l_linestatus AS status_code,"
    " l_shipdate AS updated_at, TIMESTAMP '2024-01-01' AS created_at, l_orderkey, l_linenumber",
    "staff_id",
    "updated_at DESC, created_at DESC, last_name, status_code, l_orderkey, l_linenumber",
    "lineitem",
)
QUERIES["dedup_room"] = _dedup(room_versions, C.CHAMBRE.staged_keys, C.CHAMBRE.latest_by)
ORACLE["dedup_room"] = _version_sql(
    "o_custkey AS room_number, CAST(o_orderdate AS DATE) AS created_date,"
    " o_orderpriority AS room_name, o_orderkey",
    "room_number", "created_date DESC, room_name, o_orderkey", "orders",
)


def duplicate_pk(spark, sf_dir):
    """Versions of a treatment that lose to a later one, as rejects."""
    table = C.TRAITEMENT
    return plain(
        duplicate_rejects(
            S.treatments(spark, sf_dir), table.staged_keys, table.latest_by, BATCH, EXEC
        )
    )


QUERIES["duplicate_pk"] = duplicate_pk
ORACLE["duplicate_pk"] = f"""{S.sql_tables('treatment')}
    SELECT * EXCLUDE (rn) REPLACE (CAST(medicine_quantity AS DOUBLE) AS medicine_quantity),
        count(*) AS copies, 'REJ' AS wrk_stts_cd, 'DUPLICATE_PK' AS rej_cod,
        'a later version of treatment_id was kept' AS rej_dsc, DATE '2026-04-29' AS batch_dt,
        CAST(7 AS BIGINT) AS exec_id
    FROM (SELECT *, row_number() OVER (PARTITION BY {S._VERSIONS['treatment'][0]}
        ORDER BY {S._VERSIONS['treatment'][1]}) AS rn FROM treatment) WHERE rn > 1
    GROUP BY ALL"""
