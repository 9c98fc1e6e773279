"""Materialised indicator views of which only the days that changed are built again."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardhouse.plans.kpis import VIEWS
from wardhouse.session import work_path
from wardhouse.sources.files import child_folders, drop_folder, move_files

_MEDICATION = ("medicine_code", "medicine_category", "manufacturer_brand")


def changed_rows(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that only one of two versions of a table has, or has more often, on the given columns.

    A sum of +1 and -1 over equal rows, started before the shuffle.
    """
    both = old.select(*columns, F.lit(-1).alias("_n")).unionByName(new.select(*columns, F.lit(1).alias("_n")))
    return both.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0").drop("_n")


def _day(column: str = "started_at") -> Column:
    return F.to_date(column).alias("report_date")


def _naming(rows: DataFrame, changed: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """The rows whose columns name a changed row by the columns they are paired with."""
    keys = changed.select(*[F.col(theirs).alias(ours) for ours, theirs in pairs.items()]).distinct()
    return rows.join(keys, list(pairs), "left_semi")


def affected_days(view: str, old: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """(report_date): the days on which a view may differ between two versions of the marts.

    Days of changed facts, and days of facts that name a changed dimension row; for
    occupancy, days that are new or gone, days within a changed stay, and all days
    after a change of the rooms.
    """
    fact = new["fait_consult"]

    def changed(mart: str, *columns: str) -> DataFrame:
        return changed_rows(old[mart], new[mart], columns)

    if view == "vw_patients_one_night":
        return changed("r_hospi", "hospi_id", "started_at", "ended_at").select(_day()).distinct()
    if view == "vw_empty_rooms":
        before, now = (m["fait_consult"].select(_day()).distinct() for m in (old, new))
        days = before.exceptAll(now).union(now.exceptAll(before))
        stays = changed("r_hospi", "hospi_id", "room_number", "started_at", "ended_at")
        spans = stays.select(F.to_date("started_at").alias("_from"), F.to_date("ended_at").alias("_to")).distinct()
        last = now.agg(F.max("report_date")).scalar()
        covered = spans.withColumn("_end", F.coalesce("_to", last)).filter("_from <= _end").select(
            F.explode(F.sequence("_from", "_end")).alias("report_date")
        )
        rooms = changed("r_room", "room_num", "room_name", "room_typ", "buld_name")
        n_rooms = rooms.limit(1).agg(F.count("*")).scalar()
        touched = now.join(covered.distinct(), "report_date", "left_semi")
        return days.union(touched).union(now.filter(n_rooms > 0)).distinct()

    used = {
        "vw_avg_age_by_pathology": ("consultation_id", "pathology_description", "patient_id", "started_at"),
        "vw_top_medication_by_pathology": ("consultation_id", "pathology_description", "treatment_id", "started_at"),
        "vw_rooms_by_pathology": ("consultation_id", "pathology_description", "started_at"),
        "vw_doctor_speciality_by_pathology": ("consultation_id", "pathology_description", "staff_id", "started_at"),
    }[view]
    found = [changed("fait_consult", *used)]
    if view == "vw_avg_age_by_pathology":
        found.append(_naming(fact, changed("r_indiv", "indiv_id", "birth_date"), {"patient_id": "indiv_id"}))
    elif view == "vw_doctor_speciality_by_pathology":
        found.append(_naming(fact, changed("r_stf", "staff_id", "job_title"), {"staff_id": "staff_id"}))
    elif view == "vw_top_medication_by_pathology":
        treated = changed("r_trmt", "treatment_id", *_MEDICATION, "medicine_quantity").select("treatment_id")
        names = changed("r_medc", "medc_cd", "medc_catg", "manf_brnd", "medc_name")
        renamed = _naming(new["r_trmt"], names, dict(zip(_MEDICATION, ("medc_cd", "medc_catg", "manf_brnd"))))
        both = treated.union(renamed.select("treatment_id"))
        found.append(_naming(fact, both, {"treatment_id": "treatment_id"}))
    else:
        moved = changed("r_hospi", "hospi_id", "consultation_id", "room_number").select("consultation_id")
        known = changed("r_room", "room_num")
        housed = _naming(new["r_hospi"], known, {"room_number": "room_num"}).select("consultation_id")
        found.append(_naming(fact, moved.union(housed), {"consultation_id": "consultation_id"}))
    return reduce(DataFrame.union, [rows.select(_day()) for rows in found]).distinct()


def _on_days(rows: DataFrame, days: Sequence[date]) -> DataFrame:
    """Rows that start on one of the days; the span of the days is pushed to the scan."""
    first, after = F.lit(min(days)).cast("timestamp_ntz"), F.date_add(F.lit(max(days)), 1).cast("timestamp_ntz")
    start = F.col("started_at")
    return rows.filter((start >= first) & (start < after) & F.to_date(start).isin(*days))


def refresh(
    spark: SparkSession, path: str, view: str, old: dict[str, DataFrame], new: dict[str, DataFrame]
) -> list[date]:
    """Bring a view stored below ``path``, a folder for each day, from the old marts to the new.

    Returns the days built again, at most those of the calendar; folders of other
    days are not written, and facts of other days not read. For the first build the old
    marts are empty.
    """
    found = affected_days(view, old, new).filter("report_date IS NOT NULL").orderBy("report_date")
    days = [r["report_date"] for r in found.collect()]
    if not days:
        return []
    narrowed = "r_hospi" if view == "vw_patients_one_night" else "fait_consult"
    marts = new | {narrowed: _on_days(new[narrowed], days)}
    work = work_path(spark, "view-days")
    VIEWS[view](marts).hint("rebalance", F.col("report_date")).write.partitionBy("report_date").parquet(work)
    built = [f for f in child_folders(spark, work) if f.startswith("report_date=")]
    for folder in built:
        move_files(spark, f"{work}/{folder}", f"{path}/{folder}")
    # Days that have no row any more.
    for folder in set(child_folders(spark, path)).difference(built):
        if folder in {f"report_date={day}" for day in days}:
            drop_folder(spark, f"{path}/{folder}")
    return days
