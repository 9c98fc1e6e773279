"""Contract checks, casts, reloads, upserts, archive and export on the driver's tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from functools import partial, reduce
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse import contracts as C
from wardhouse.contracts import Column, Table
from wardhouse.functions.casts import safe_cast
from wardhouse.operators.dedup import latest_per_key
from wardhouse.operators.load import typed, upsert, upsert_counts
from wardhouse.plans.audit import RunLog, step_state
from wardhouse.plans.daily import Steps, ingest_contract, load_rows, replay_batches
from wardhouse.session import at_once, shuffles_dropped, work_path
from wardhouse.sources.archive import archived, purge, replay, write_archive
from wardhouse.sources.batch_files import (
    batch_file,
    parse_batch_date,
    passed,
    read_batch,
    read_text_table,
    require_contract,
    summarise,
)
from wardhouse.sources.export import BOM, export_view
from wardhouse.sources.files import drop_folder
from wardhouse.sources.warehouse import OBS, STG, TCH, Warehouse
from wardhouse.streaming.incremental import follow
from warehouse_queries import standins as S
from warehouse_queries.gates import plain, written
from warehouse_queries.stars import QUERIES as STARS

QUERIES = {}
ORACLE = {}

# Any table can be described as an extract; here the driver's orders.
ORDERS = Table(
    name="ORDERS",
    load="delta",
    keys=("CUSTOMER",),
    guard="ORDERED_AT",
    columns=(
        Column("CUSTOMER", "integer", "customer_id", required=True),
        Column("ORDER_NO", "integer", "order_id", required=True),
        Column("STATUS", "varchar", "status"),
        Column("AMOUNT", "decimal(12,2)", "amount"),
        Column("ORDERED_AT", "timestamp", "ordered_at", required=True),
        Column("URGENT", "boolean", "is_urgent"),
    ),
    rules=(),
    latest_by=("ordered_at DESC NULLS LAST",),
)


def order_texts(spark, sf_dir):
    """orders as an extract: every value text, URGENT in mixed spellings."""
    return S.read(spark, sf_dir, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS CUSTOMER",
        "CAST(o_orderkey AS STRING) AS ORDER_NO",
        "o_orderstatus AS STATUS",
        "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) AS AMOUNT",
        "CAST(o_orderdate AS STRING) AS ORDERED_AT",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'On' WHEN '2-HIGH' THEN 'yes'"
        " WHEN '3-MEDIUM' THEN '?' WHEN '4-NOT SPECIFIED' THEN '' ELSE 'F' END AS URGENT",
    )


_ORDERS_SQL = """orders_typed AS (SELECT o_custkey AS CUSTOMER, o_orderkey AS ORDER_NO,
        o_orderstatus AS STATUS, o_totalprice AS AMOUNT, o_orderdate AS ORDERED_AT,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN true
            WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN NULL ELSE false END
            AS URGENT FROM orders)"""


def _as_extract(df, path, **options):
    df.write.options(sep=C.SEPARATOR, header="true", escape='"', emptyValue="", **options).csv(path)


def text_scan(spark, sf_dir):
    """orders written as delimited text, then scanned, checked and cast."""
    day = date(2026, 4, 29)
    root = work_path(spark, "extracts")
    _as_extract(order_texts(spark, sf_dir), batch_file(root, day, "ORDERS"))
    raw = read_batch(spark, root, day, "ORDERS")
    require_contract(raw, ORDERS, day)
    return plain(typed(raw, ORDERS))


QUERIES["text_scan"] = text_scan
ORACLE["text_scan"] = f"WITH {_ORDERS_SQL} SELECT * FROM orders_typed"


def text_multiline(spark, sf_dir):
    """orders with a status of three lines in some rows, in several files: scanned in splits."""
    day = date(2026, 4, 29)
    root = work_path(spark, "extracts")
    status = F.when(
        F.col("ORDER_NO").cast("bigint") % 3 == 0,
        F.concat(F.lit('first; "'), F.col("STATUS"), F.lit('"\n\nthird')),
    ).otherwise(F.col("STATUS"))
    texts = order_texts(spark, sf_dir).withColumn("STATUS", status).repartition(5, "ORDER_NO")
    _as_extract(texts, batch_file(root, day, "ORDERS"))
    raw = read_batch(spark, root, day, "ORDERS")
    require_contract(raw, ORDERS, day)
    return plain(typed(raw, ORDERS))


QUERIES["text_multiline"] = text_multiline
ORACLE["text_multiline"] = f"""WITH {_ORDERS_SQL} SELECT * REPLACE (CASE WHEN ORDER_NO % 3 = 0
    THEN 'first; "' || STATUS || '"' || chr(10) || chr(10) || 'third' ELSE STATUS END AS STATUS)
    FROM orders_typed"""


def refused_extract(spark, sf_dir):
    """A file that breaks its contract stops the load; the table keeps what it held."""
    inputs, day = work_path(spark, "refused"), date(2026, 4, 29)
    wh = Warehouse(spark, work_path(spark, "kept"))
    texts = order_texts(spark, sf_dir)
    load_rows(wh, ORDERS, texts, day)
    _as_extract(texts.drop("AMOUNT").withColumn("EXTRA", F.lit("x")), batch_file(inputs, day, "ORDERS"))
    said = ""
    try:
        ingest_contract(wh, inputs, day, ORDERS)
    except ValueError as error:
        said = str(error)
    return _loaded(wh, ORDERS).agg(
        F.count("*").alias("n_rows"), F.sum("ORDER_NO").alias("sum_order"), F.lit(said).alias("said")
    )


QUERIES["refused_extract"] = refused_extract
ORACLE["refused_extract"] = f"""WITH {_ORDERS_SQL}, t AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number()
        OVER (PARTITION BY CUSTOMER ORDER BY ORDERED_AT DESC, ORDER_NO, STATUS, AMOUNT) AS rn
        FROM orders_typed) WHERE rn = 1)
    SELECT count(*) AS n_rows, CAST(sum(ORDER_NO) AS BIGINT) AS sum_order,
        'invalid extract ORDERS of 2026-04-29: missing=[''AMOUNT''] extra=[''EXTRA'']' AS said FROM t"""


def contract_summary(spark, sf_dir):
    """lineitem under TRAITEMENT's header, with one column missing and one extra."""
    raw = S.read(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS ID_TRAITEMENT",
        "CAST(l_partkey AS STRING) AS CD_MEDICAMENT",
        "l_returnflag AS CATG_MEDICAMENT",
        "l_linestatus AS MARQUE_FABRI",
        "CAST(l_quantity AS STRING) AS qte_medicament",
        "CAST(l_tax AS STRING) AS DSC_POSOLOGIE",
        "CAST(l_orderkey AS STRING) AS ID_CONSULT",
    )
    return summarise(raw, C.TRAITEMENT, date(2026, 4, 29)).withColumns(
        {c: F.array_join(c, ",") for c in ("missing_columns", "extra_columns")}
    )


QUERIES["contract_summary"] = contract_summary
ORACLE["contract_summary"] = """SELECT DATE '2026-04-29' AS batch_dt, 'TRAITEMENT' AS src_table,
    count(*) AS row_count, 'QTE_MEDICAMENT,TS_CREATION_TRAITEMENT' AS missing_columns,
    'qte_medicament' AS extra_columns, false AS is_valid FROM lineitem"""


def contract_pass_count(spark, sf_dir):
    """Four extracts of one batch, two of which conform."""
    day = date(2026, 4, 29)
    rooms = S.rooms(spark, sf_dir)
    good_rooms = rooms.toDF(*C.CHAMBRE.header)
    good_meds = S.medications(spark, sf_dir).select(
        *[F.col(c.staged).alias(c.source) for c in C.MEDICAMENT.columns]
    )
    summaries = [
        summarise(good_rooms, C.CHAMBRE, day),
        summarise(good_meds, C.MEDICAMENT, day),
        summarise(good_rooms.drop("DT_CREATION"), C.CHAMBRE, day),
        summarise(good_meds.filter("CD_MEDICAMENT IS NULL"), C.MEDICAMENT, day),
    ]
    return passed(reduce(DataFrame.unionByName, summaries))


QUERIES["contract_pass_count"] = contract_pass_count
ORACLE["contract_pass_count"] = """
    WITH e AS (SELECT count(*) AS row_count, true AS conforms FROM customer
        UNION ALL SELECT count(*), true FROM part
        UNION ALL SELECT count(*), false FROM customer
        UNION ALL SELECT count(*), true FROM part WHERE p_name IS NULL)
    SELECT DATE '2026-04-29' AS batch_dt, count(*) FILTER (conforms AND row_count > 0) AS n_valid,
        count(*) AS n_tables FROM e"""


def source_map(spark, sf_dir):
    """Stay extracts: two header names differ from the names they are loaded under."""
    raw = S.read(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey * 8 + l_linenumber AS STRING) AS ID_HOSPI",
        "CAST(l_orderkey AS STRING) AS ID_CONSULT_hospi",
        "CASE WHEN l_linenumber = 7 THEN 'none' ELSE CAST(l_partkey AS STRING) END"
        " AS NO_CHAMBRE_hospi",
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS TS_DEBUT_HOSPI",
        "'' AS TS_FIN_HOSPI",
        "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) AS COUT_HOSPI",
        "CAST(l_suppkey AS STRING) AS ID_PERSONNEL_RESP",
    )
    return plain(typed(raw, C.HOSPITALISATION))


QUERIES["source_map"] = source_map
ORACLE["source_map"] = """SELECT l_orderkey * 8 + l_linenumber AS ID_HOSPI,
    l_orderkey AS ID_CONSULT, CASE WHEN l_linenumber < 7 THEN l_partkey END AS NO_CHAMBRE,
    l_shipdate AS TS_DEBUT_HOSPI, CAST(NULL AS TIMESTAMP) AS TS_FIN_HOSPI,
    l_extendedprice AS COUT_HOSPI, l_suppkey AS ID_PERSONNEL_RESP FROM lineitem"""


def safe_casts(spark, sf_dir):
    """Six logical types from texts, some of which do not parse."""
    texts = S.read(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value - 100 AS STRING) END AS n",
        "CASE WHEN event_type = 'view' THEN '' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS d",
        "CASE WHEN event_type = 'click' THEN CAST(CAST(ts AS DATE) AS STRING)"
        " WHEN event_type = 'signup' THEN '29/04/2026' ELSE CAST(ts AS STRING) END AS t",
        "CASE event_type WHEN 'click' THEN 'on' WHEN 'view' THEN 'FALSE' WHEN 'error' THEN 'maybe'"
        " WHEN 'purchase' THEN '1' ELSE '' END AS b",
    )
    return texts.select(
        "event_id",
        safe_cast(F.col("n"), "integer").alias("as_integer"),
        safe_cast(F.col("n"), "decimal(10,1)").cast("double").alias("as_decimal"),
        safe_cast(F.col("d"), "date").alias("as_date"),
        safe_cast(F.col("t"), "timestamp").alias("as_timestamp"),
        safe_cast(F.col("b"), "boolean").alias("as_boolean"),
        safe_cast(F.col("b"), "varchar").alias("as_text"),
    )


QUERIES["safe_cast_props"] = safe_casts
ORACLE["safe_cast_props"] = """
    WITH t AS (SELECT event_id,
        CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value - 100 AS VARCHAR) END AS n,
        CASE WHEN event_type = 'view' THEN NULL ELSE CAST(ts AS DATE) END AS d,
        CASE WHEN event_type = 'click' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
            WHEN event_type = 'signup' THEN NULL ELSE ts END AS t,
        CASE event_type WHEN 'click' THEN 'on' WHEN 'view' THEN 'FALSE' WHEN 'error' THEN 'maybe'
            WHEN 'purchase' THEN '1' END AS b FROM events)
    SELECT event_id, CAST(round(try_cast(n AS DECIMAL(28,10)), 0) AS BIGINT) AS as_integer,
        CAST(round(try_cast(n AS DECIMAL(28,10)), 1) AS DOUBLE) AS as_decimal, d AS as_date,
        t AS as_timestamp,
        CASE lower(b) WHEN 'on' THEN true WHEN '1' THEN true WHEN 'false' THEN false END
            AS as_boolean, b AS as_text FROM t"""


def full_reload(spark, sf_dir):
    """A reloaded table holds the last extract only."""
    wh = Warehouse(spark, work_path(spark, "full_reload"))
    rooms = S.rooms(spark, sf_dir)
    wh.write(rooms.withColumn("day_rate", F.lit(0)), STG, "CHAMBRE")
    wh.write(rooms, STG, "CHAMBRE")
    return wh.read(STG, "CHAMBRE")


QUERIES["full_reload"] = full_reload
ORACLE["full_reload"] = f"{S.sql_tables('room')} SELECT * FROM room"


def _accounts(spark, sf_dir):
    return S.read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS account_id",
        "c_acctbal AS amount",
        "c_mktsegment AS label",
        "CASE WHEN c_nationkey <> 9 THEN CAST(date_add(DATE'1998-01-01', c_nationkey * 100)"
        " AS TIMESTAMP_NTZ) END AS changed_at",
    )


def _movements(spark, sf_dir):
    """orders as a batch: many rows per key, keys unknown to the target, NULL keys."""
    return S.read(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL"
        " WHEN o_orderpriority = '5-LOW' THEN -1 - o_custkey ELSE o_custkey END AS account_id",
        "o_totalprice AS amount",
        "o_orderpriority AS label",
        "CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS changed_at",
    )


_UPSERT_SQL = """accounts AS (SELECT c_custkey AS account_id, c_acctbal AS amount,
        c_mktsegment AS label,
        CASE WHEN c_nationkey <> 9 THEN CAST(DATE '1998-01-01' + c_nationkey * 100 AS TIMESTAMP)
            END AS changed_at FROM customer),
    movements AS (SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
        WHEN o_orderpriority = '5-LOW' THEN -1 - o_custkey ELSE o_custkey END AS account_id,
        o_totalprice AS amount, o_orderpriority AS label,
        CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS changed_at FROM orders),
    latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY account_id
        ORDER BY {order}) AS rn FROM movements WHERE account_id IS NOT NULL) WHERE rn = 1
        UNION ALL SELECT * FROM movements WHERE account_id IS NULL)"""
_GUARDED_ORDER = "changed_at DESC NULLS LAST, amount, label"
_PLAIN_ORDER = "amount, label, changed_at ASC NULLS LAST"

QUERIES["delta_upsert"] = lambda spark, sf_dir: upsert(
    _accounts(spark, sf_dir), _movements(spark, sf_dir), ["account_id"]
)
ORACLE["delta_upsert"] = f"""WITH {_UPSERT_SQL.format(order=_PLAIN_ORDER)}
    SELECT coalesce(a.account_id, l.account_id) AS account_id,
        CASE WHEN l.label IS NOT NULL THEN l.amount ELSE a.amount END AS amount,
        coalesce(l.label, a.label) AS label,
        CASE WHEN l.label IS NOT NULL THEN l.changed_at ELSE a.changed_at END AS changed_at
    FROM accounts a FULL JOIN latest l ON a.account_id = l.account_id"""
QUERIES["delta_upsert_guarded"] = lambda spark, sf_dir: upsert(
    _accounts(spark, sf_dir), _movements(spark, sf_dir), ["account_id"], "changed_at"
)
ORACLE["delta_upsert_guarded"] = f"""WITH {_UPSERT_SQL.format(order=_GUARDED_ORDER)},
    j AS (SELECT a.account_id AS old_id, l.account_id AS new_id, a.amount, a.label, a.changed_at,
        l.amount AS n_amount, l.label AS n_label, l.changed_at AS n_changed_at,
        a.label IS NULL OR coalesce(l.changed_at > a.changed_at, false) AS takes
        FROM accounts a FULL JOIN latest l ON a.account_id = l.account_id)
    SELECT coalesce(old_id, new_id) AS account_id,
        CASE WHEN takes THEN n_amount ELSE amount END AS amount,
        CASE WHEN takes THEN n_label ELSE label END AS label,
        CASE WHEN takes THEN n_changed_at ELSE changed_at END AS changed_at FROM j"""
QUERIES["load_counters"] = lambda spark, sf_dir: upsert_counts(
    _accounts(spark, sf_dir), _movements(spark, sf_dir), ["account_id"], "changed_at"
)
ORACLE["load_counters"] = f"""WITH {_UPSERT_SQL.format(order=_GUARDED_ORDER)},
    j AS (SELECT a.label IS NOT NULL AS held, coalesce(l.changed_at > a.changed_at, false) AS newer
        FROM latest l LEFT JOIN accounts a ON a.account_id = l.account_id)
    SELECT (SELECT count(*) FROM movements) AS read_rows,
        count(*) FILTER (NOT held OR newer) AS affected_rows,
        count(*) FILTER (NOT held) AS inserted_rows,
        count(*) FILTER (held AND newer) AS updated_rows,
        count(*) FILTER (held AND NOT newer) AS kept_rows FROM j"""


def _lines(spark, sf_dir):
    return latest_per_key(
        S.read(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
        ),
        ["l_orderkey", "l_linenumber"], ["l_shipdate DESC NULLS LAST"],
    )


def upsert_composite(spark, sf_dir):
    """Lines merged on (order, line): corrections for some, new lines for others."""
    changes = S.read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").selectExpr(
        "l_orderkey", "CASE WHEN l_tax > 0.05 THEN l_linenumber + 10 ELSE l_linenumber END"
        " AS l_linenumber", "l_quantity + 100 AS l_quantity", "'C' AS l_returnflag", "l_shipdate",
    )
    return upsert(_lines(spark, sf_dir), changes, ["l_orderkey", "l_linenumber"])


QUERIES["delta_upsert_composite"] = upsert_composite
ORACLE["delta_upsert_composite"] = """
    WITH t AS (SELECT * EXCLUDE (rn) FROM (SELECT l_orderkey, l_linenumber, l_quantity,
            l_returnflag, l_shipdate, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_quantity, l_returnflag) AS rn FROM lineitem)
        WHERE rn = 1),
    b AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity, l_shipdate) AS rn
        FROM (SELECT l_orderkey,
            CASE WHEN l_tax > 0.05 THEN l_linenumber + 10 ELSE l_linenumber END AS l_linenumber,
            l_quantity + 100 AS l_quantity, 'C' AS l_returnflag, l_shipdate
            FROM lineitem WHERE l_returnflag = 'R')) WHERE rn = 1)
    SELECT * FROM b UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b
        WHERE b.l_orderkey = t.l_orderkey AND b.l_linenumber = t.l_linenumber)"""


_DAYS = {
    date(1997, 12, 31): "ORDERED_AT < '1998'",
    date(1999, 12, 31): "ORDERED_AT >= '1998' AND ORDERED_AT < '2000'",
    date(2001, 12, 31): "ORDERED_AT >= '2000'",
}


def _loaded(wh, contract):
    """A loaded table without the columns it keeps for itself."""
    return plain(wh.read(STG, contract.name).select(*[c.target for c in contract.columns]))


def stream_upsert(spark, sf_dir):
    """Three batches of orders as files, the middle day's last, followed by a file stream."""
    inputs, seen = work_path(spark, "incoming"), work_path(spark, "seen")
    texts = order_texts(spark, sf_dir)
    wh = Warehouse(spark, work_path(spark, "followed"))
    first, late, last = _DAYS
    for days in ((first, last), (late,)):
        for day in days:
            _as_extract(texts.filter(_DAYS[day]), batch_file(inputs, day, "ORDERS"))
        follow(wh, inputs, ORDERS, seen).awaitTermination()
    return _loaded(wh, ORDERS)


QUERIES["stream_upsert"] = stream_upsert
ORACLE["stream_upsert"] = f"""WITH {_ORDERS_SQL}
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY CUSTOMER
        ORDER BY ORDERED_AT DESC, ORDER_NO, STATUS, AMOUNT) AS rn FROM orders_typed) WHERE rn = 1"""


# Orders again, without a guard: a key has its row of the last day that names it.
UNGUARDED = replace(ORDERS, name="ORDERS_BY_DAY", guard=None)


def late_days(spark, sf_dir):
    """Three days of orders loaded newest first, one of them twice, into a table without a guard."""
    wh = Warehouse(spark, work_path(spark, "late"), slots=16)
    texts = order_texts(spark, sf_dir)
    first, middle, last = _DAYS
    for day in (last, first, middle, first):
        load_rows(wh, UNGUARDED, texts.filter(_DAYS[day]), day)
    return _loaded(wh, UNGUARDED)


QUERIES["late_days"] = late_days
ORACLE["late_days"] = f"""WITH {_ORDERS_SQL}, d AS (SELECT *, CASE WHEN ORDERED_AT < DATE '1998-01-01'
        THEN 1 WHEN ORDERED_AT < DATE '2000-01-01' THEN 2 ELSE 3 END AS part FROM orders_typed)
    SELECT * EXCLUDE (part, rn) FROM (SELECT *, row_number() OVER (PARTITION BY CUSTOMER
        ORDER BY part DESC, ORDER_NO, STATUS, AMOUNT) AS rn FROM d) WHERE rn = 1"""


def keyed_merge(spark, sf_dir):
    """A day that names few customers rewrites their folders only: how many, and which rows."""
    wh = Warehouse(spark, work_path(spark, "keyed"), slots=256)
    texts = order_texts(spark, sf_dir)
    load_rows(wh, ORDERS, texts, date(2001, 12, 31))
    table = wh.keyed(STG, ORDERS.name, ORDERS.keys)
    rows = F.col("_metadata.file_path").alias("path")
    before = table.rows().select("CUSTOMER", rows)
    before = written(before)
    few = texts.filter("CAST(CUSTOMER AS BIGINT) < 8").withColumns(
        {"ORDERED_AT": F.lit("2002-01-01 00:00:00"), "STATUS": F.lit("N")}
    )
    load_rows(wh, ORDERS, few, date(2002, 1, 1))
    now = table.rows().select("CUSTOMER", "STATUS", rows)
    moved = F.col("old.path") != F.col("now.path")
    few_keys = F.col("CUSTOMER") < 8
    return now.alias("now").join(before.alias("old"), "CUSTOMER").agg(
        F.count_if(few_keys & moved).alias("n_named_rewritten"),
        F.count_if(few_keys & (F.col("STATUS") == "N")).alias("n_named_updated"),
        F.count_if(F.col("STATUS") == "N").alias("n_updated"),
        (F.count_if(moved) * 4 < F.count("*")).alias("most_rows_untouched"),
    )


QUERIES["keyed_merge"] = keyed_merge
ORACLE["keyed_merge"] = """SELECT count(DISTINCT o_custkey) AS n_named_rewritten,
    count(DISTINCT o_custkey) AS n_named_updated, count(DISTINCT o_custkey) AS n_updated,
    true AS most_rows_untouched FROM orders WHERE o_custkey < 8"""


def archive_replay(spark, sf_dir):
    """Events archived by day, one day received again, that day replayed."""
    path = work_path(spark, "archive")
    events = S.read(spark, sf_dir, "events")
    at = datetime(2026, 4, 29, 6, 0)
    write_archive(archived(events, F.to_date("ts"), at, 1), path)
    again = events.filter("CAST(ts AS DATE) = DATE'2024-01-10'").withColumn("value", -F.col("value"))
    write_archive(archived(again, F.to_date("ts"), at, 2), path)
    kept = replay(spark, path, date(2024, 1, 9)).unionByName(replay(spark, path, date(2024, 1, 10)))
    return kept


QUERIES["archive_replay"] = archive_replay
ORACLE["archive_replay"] = """SELECT * REPLACE (CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10'
        THEN -value ELSE value END AS value)
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-10'"""


def archive_purge(spark, sf_dir):
    """Orders archived by year, batches past 36 months dropped."""
    path = work_path(spark, "archive")
    orders = S.read(spark, sf_dir, "orders")
    at = datetime(2026, 4, 29, 6, 0)
    write_archive(archived(orders, F.trunc("o_orderdate", "YEAR"), at, 1), path)
    purge(spark, path, date(2001, 8, 1), 36)
    return spark.read.parquet(path).groupBy("batch_dt").agg(
        F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("sum_key")
    )


QUERIES["archive_purge"] = archive_purge
ORACLE["archive_purge"] = """SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS batch_dt,
    count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS sum_key FROM orders
    WHERE date_trunc('year', o_orderdate) >= DATE '1998-08-01' GROUP BY ALL"""


def export_scan(spark, sf_dir):
    """An indicator view exported as delimited text and read back."""
    folder = work_path(spark, "export")
    n_rows = export_view(STARS["kpi_specialty"](spark, sf_dir), folder, "VW_SPECIALTY")
    back = read_text_table(spark, f"{folder}/vw_specialty.csv")
    back = back.toDF(*[c.removeprefix(BOM) for c in back.columns])
    return back.groupBy("SPECIALTY", "REPORT_DATE").agg(
        F.count("*").alias("n_rows"), F.lit(n_rows).cast("bigint").alias("n_exported")
    ).withColumn("REPORT_DATE", safe_cast(F.col("REPORT_DATE"), "date"))


QUERIES["export_scan"] = export_scan
ORACLE["export_scan"] = f"""{S.sql_work('consultation', 'staff')},
    v AS (SELECT job_title AS SPECIALTY, CAST(started_at AS DATE) AS REPORT_DATE
        FROM consultation_ok c JOIN staff_ok s ON c.staff_id = s.staff_id
        WHERE pathology_description IS NOT NULL)
    SELECT SPECIALTY, REPORT_DATE, count(*) AS n_rows,
        (SELECT count(*) FROM v) AS n_exported FROM v GROUP BY ALL"""


_SOURCES = {
    "PATIENT": (S.patients, "patient", "patient_id"),
    "PERSONNEL": (S.staff, "staff", "staff_id"),
    "CHAMBRE": (S.rooms, "room", "room_number"),
    "MEDICAMENT": (S.medications, "medication", "length(medicine_code)"),
    "CONSULTATION": (S.consultations, "consultation", "consultation_id"),
    "TRAITEMENT": (S.treatments, "treatment", "treatment_id"),
    "HOSPITALISATION": (S.stays, "stay", "hospi_id"),
}


# Written once, then read for each day; the others are columns of one table.
_JOINED = ("TRAITEMENT",)
# Text is several times as large as the tables it is made of. One task reads a whole compressed shard.
_SHARDS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}


def replay_days(spark, sf_dir):
    """All seven extracts of two days (keys by parity) as files, loaded oldest first in logged steps."""
    inputs, day1, day2 = work_path(spark, "days"), *map(parse_batch_date, ("2026-04-29", "2026-04-30"))

    def extract(name, source, key):
        contract = C.TABLES[name]
        path, rows = work_path(spark, "table"), source(spark, sf_dir)
        if name in _JOINED:
            with shuffles_dropped(spark):
                rows.write.parquet(path)
            rows = spark.read.schema(rows.schema).parquet(path)
        texts = [F.col(c.staged).cast("string").alias(c.source) for c in contract.columns]
        for part, day in enumerate((day1, day2)):
            of_day = rows.filter(F.pmod(F.expr(key), F.lit(2)) == part)
            _as_extract(of_day.select(*texts), batch_file(inputs, day, name), **_SHARDS)
        drop_folder(spark, path)

    at_once([partial(extract, name, source, key) for name, (source, _, key) in _SOURCES.items()])
    wh = Warehouse(spark, work_path(spark, "replayed"), slots=4)
    log = RunLog(spark, wh.path(TCH, "events"))
    with log.run(1, "MANUAL", day1):
        with Steps(log, 1, count(1)).table("ingest_stg") as exec_id:
            results = replay_batches(wh, inputs, [day2, day1], exec_id)
    counts = spark.createDataFrame(
        [(r.table, r.strategy, r.read_rows, r.affected_rows) for r in results],
        "src_table string, strategy string, read_rows bigint, affected_rows bigint",
    ).groupBy("src_table", "strategy").agg(
        F.sum("read_rows").alias("read_rows"), F.sum("affected_rows").alias("affected_rows")
    )
    held, stamped = [], []
    for name in _SOURCES:
        held.append(wh.read(STG, name).agg(F.lit(name).alias("src_table"), F.count("*").alias("held_rows")))
        archive = spark.read.parquet(wh.path(OBS, name))
        stamped.append(
            archive.agg(
                F.lit(name).alias("src_table"), F.count_distinct("batch_dt").alias("n_days"),
                F.bool_and((F.col("load_dttm") <= F.localtimestamp()) & (F.col("exec_id") == 1)).alias("is_stamped"),
            )
        )
    state = step_state(log.events()).agg(F.max("exec_stts_cd")).scalar()
    return (
        counts.join(reduce(DataFrame.unionByName, held), "src_table")
        .join(reduce(DataFrame.unionByName, stamped), "src_table")
        .withColumn("step", state)
    )


def _replay_sql():
    parts = []
    for name, (_, table, key) in _SOURCES.items():
        keys = ", ".join(C.TABLES[name].staged_keys)
        full = C.TABLES[name].load == "full"
        held = f"count(*) FILTER ({key} % 2 = 1)" if full else f"count(DISTINCT {keys})"
        affected = "count(*)" if full else held
        parts.append(
            f"SELECT '{name}' AS src_table, '{C.TABLES[name].load}' AS strategy, count(*) AS read_rows,"
            f" {affected} AS affected_rows, {held} AS held_rows, CAST(2 AS BIGINT) AS n_days,"
            f" true AS is_stamped, 'OK' AS step FROM {table}"
        )
    return S.sql_tables(*[t for _, t, _ in _SOURCES.values()]) + " " + " UNION ALL ".join(parts)


QUERIES["replay_days"] = replay_days
ORACLE["replay_days"] = _replay_sql()
