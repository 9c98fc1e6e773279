"""Do the layers agree: loaded with work, views with the extracts they come from."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.contracts import TABLES
from wardhouse.operators import checks
from wardhouse.operators.fingerprint import differences, fingerprint
from wardhouse.session import at_once, work_path

# What each view must share with its sources. Sources are all
# archived days of a table, under their loaded names.
#: view, column -> the table and column that hold all of its values
KNOWN = (
    ("vw_avg_age_by_pathology", "patient_id", "PATIENT", "ID_PATIENT"),
    ("vw_top_medication_by_pathology", "medicine_code", "TRAITEMENT", "CD_MEDICAMENT"),
    ("vw_rooms_by_pathology", "room_number", "r_room", "room_num"),
    ("vw_doctor_speciality_by_pathology", "staff_id", "PERSONNEL", "ID_PERSONNEL"),
    ("vw_empty_rooms", "room_num", "r_room", "room_num"),
)
#: rule -> predicate over the figures below
RULES = {
    "vw_avg_age_by_pathology: no day before the first batch": "age_first >= first_batch",
    "vw_avg_age_by_pathology: no day after the last batch": "age_last <= last_batch",
    "vw_top_medication_by_pathology: some quantity": "medication_total > 0",
    "vw_top_medication_by_pathology: no more than prescribed": "medication_total <= prescribed_total",
    "vw_rooms_by_pathology: no more rooms than there are": "rooms_used <= n_rooms",
    "vw_patients_one_night: below 100 percent": "night_most < 100",
    "vw_patients_one_night: not below 0 percent": "night_least >= 0",
    "vw_patients_one_night: every valid stay": "night_total = n_stays",
    "vw_empty_rooms: every room": "rooms_shown = n_rooms",
}


#: What is kept of a view for each of its ids.
KEPT = {
    "vw_avg_age_by_pathology": ("min(report_date) AS first_day", "max(report_date) AS last_day"),
    "vw_top_medication_by_pathology": ("sum(total_quantity) AS total_quantity",),
}


def summed_up(
    views: dict[str, DataFrame], sources: dict[str, DataFrame]
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The views of KNOWN, and the prescriptions, with one row for each id, as work tables.

    Every figure and check of a view is taken from its ids, so that a view, which is
    built on read, is built once.
    """

    def by_id(rows: DataFrame, column: str, kept: Sequence[str]) -> DataFrame:
        ids = rows.groupBy(column).agg(*[F.expr(k) for k in kept]) if kept else rows.select(column).distinct()
        path = work_path(rows.sparkSession, "ids")
        ids.write.parquet(path)
        return rows.sparkSession.read.schema(ids.schema).parquet(path)

    treated = (sources["TRAITEMENT"], "CD_MEDICAMENT", ("sum(QTE_MEDICAMENT) AS QTE_MEDICAMENT",))
    asked = [treated] + [(views[view], column, KEPT.get(view, ())) for view, column, _, _ in KNOWN]
    prescribed, *ids = at_once([partial(by_id, *a) for a in asked])
    return views | dict(zip((view for view, *_ in KNOWN), ids)), sources | {"TRAITEMENT": prescribed}


def figures(
    views: dict[str, DataFrame], r_room: DataFrame, sources: dict[str, DataFrame]
) -> dict[str, tuple[DataFrame, Column]]:
    """The figures that the rules compare, each with the table it is taken from.

    Views and sources are those that :func:`summed_up` gives.
    """
    age, night = views["vw_avg_age_by_pathology"], views["vw_patients_one_night"]
    consults, stays = sources["CONSULTATION"], sources["HOSPITALISATION"]
    needed = ("ID_HOSPI", "ID_CONSULT", "NO_CHAMBRE", "TS_DEBUT_HOSPI", "ID_PERSONNEL_RESP")
    valid = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed]) & (F.col("ID_HOSPI") > 0)
    return {
        "age_first": (age, F.min("first_day")),
        "age_last": (age, F.max("last_day")),
        "first_batch": (consults, F.min("batch_dt")),
        "last_batch": (consults, F.max("batch_dt")),
        "medication_total": (views["vw_top_medication_by_pathology"], F.sum("total_quantity")),
        "prescribed_total": (sources["TRAITEMENT"], F.sum("QTE_MEDICAMENT")),
        "rooms_used": (views["vw_rooms_by_pathology"], F.count_distinct("room_number")),
        "night_most": (night, F.max("one_night_plus_pct")),
        "night_least": (night, F.min("one_night_plus_pct")),
        "night_total": (night, F.sum("total_hospitalisations")),
        "n_stays": (stays, F.count_distinct(F.when(valid, F.col("ID_HOSPI")))),
        "rooms_shown": (views["vw_empty_rooms"], F.count_distinct("room_num")),
        "n_rooms": (r_room, F.count("*")),
    }


def view_failures(
    views: dict[str, DataFrame], r_room: DataFrame, sources: dict[str, DataFrame]
) -> DataFrame:
    """Rules between views and their sources that do not hold: as the checks of a layer."""
    views, sources = summed_up(views, sources)
    parts = F.split("failed_rule", ": ")
    broken = checks.reconcile(figures(views, r_room, sources), RULES).select(
        parts[0].alias("src_table"), F.lit("reconcile").alias("check"), parts[1].alias("detail"),
        F.lit(1).cast("bigint").alias("n_failed"),
    )
    out = [broken]
    for view, column, table, source_column in KNOWN:
        source = r_room if table == "r_room" else sources[table]
        unknown = checks.unknown_ids(views[view], column, source, source_column)
        out.append(
            unknown.agg(F.count("*").alias("n_failed")).filter("n_failed > 0").select(
                F.lit(view).alias("src_table"), F.lit(f"source {table}").alias("check"),
                F.lit(column).alias("detail"), "n_failed",
            )
        )
    return reduce(DataFrame.unionByName, out)


def layer_failures(staged: dict[str, DataFrame], checked: dict[str, DataFrame]) -> DataFrame:
    """Tables whose staged rows and checked rows, of all fates, are not the same rows.

    Row count and order-free hash, one pass over each side.
    """
    out = []
    for name, rows in staged.items():
        columns = [c.staged for c in TABLES[name].columns]
        lost = differences(
            fingerprint(rows, rows=columns), fingerprint(checked[name].select(*columns), rows=columns)
        )
        out.append(
            lost.select(
                F.lit(name).alias("src_table"), F.lit("fingerprint").alias("check"),
                F.col("figure").alias("detail"), F.lit(1).cast("bigint").alias("n_failed"),
            )
        )
    return reduce(DataFrame.unionByName, out)
