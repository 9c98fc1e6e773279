"""The six indicator views and their roll-ups over a reporting period.

The marts are taken as written tables: a view looks once through the key column
it joins on for hot keys before it is planned. The views stay at detail grain.
A roll-up filters the period first and counts
distinct things afterwards: daily counts must never be summed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.functions.dates import age_in_years, hours_between, period_start
from wardhouse.operators.joins import join_dimension
from wardhouse.operators.occupancy import calendar, day_grid, taken_days

# Occupancy labels and the length of a night in hours.
OCCUPIED = "Occupée"
FREE = "Libre"
NIGHT_HOURS = 8


def _diagnosed(fait_consult: DataFrame) -> DataFrame:
    return fait_consult.filter(F.col("pathology_description").isNotNull())


def avg_age_by_pathology(fait_consult: DataFrame, r_indiv: DataFrame) -> DataFrame:
    """Per consultation: the patient's age on the day. Averaged in the roll-up."""
    born = r_indiv.filter(F.col("birth_date").isNotNull()).select(
        F.col("indiv_id").alias("patient_id"), "birth_date"
    )
    consults = _diagnosed(fait_consult).select(
        "consultation_id", "pathology_description", "patient_id", "started_at"
    )
    return join_dimension(consults, born, ["patient_id"], spread_by=["consultation_id"]).select(
        "pathology_description",
        "patient_id",
        F.to_date("started_at").alias("report_date"),
        age_in_years(F.col("birth_date"), F.col("started_at")).alias("age_at_consultation"),
    )


def top_medication_by_pathology(
    fait_consult: DataFrame, r_trmt: DataFrame, r_medc: DataFrame
) -> DataFrame:
    """Quantity prescribed per pathology, day and medication.

    Quantities are summed before the medication's name is looked up: the name
    depends on the medication alone, and the sum leaves one row per pathology
    and day of each medication, however often it was prescribed.
    """
    medication = ("medicine_code", "medicine_category", "manufacturer_brand")
    consults = _diagnosed(fait_consult).filter(F.col("treatment_id").isNotNull()).select(
        "consultation_id",
        "treatment_id",
        "pathology_description",
        F.to_date("started_at").alias("report_date"),
    )
    treatments = r_trmt.select("treatment_id", *medication, "medicine_quantity")
    prescribed = (
        join_dimension(consults, treatments, ["treatment_id"], spread_by=["consultation_id"])
        .groupBy("pathology_description", "report_date", *medication)
        .agg(F.sum(F.coalesce("medicine_quantity", F.lit(0))).alias("total_quantity"))
    )
    names = r_medc.select(
        F.col("medc_cd").alias("medicine_code"),
        F.col("medc_catg").alias("medicine_category"),
        F.col("manf_brnd").alias("manufacturer_brand"),
        "medc_name",
    )
    return prescribed.join(names, list(medication), "left").select(
        "pathology_description",
        "report_date",
        "medicine_code",
        F.coalesce("medc_name", "medicine_code").alias("medicine_name"),
        "medicine_category",
        "manufacturer_brand",
        "total_quantity",
    )


def rooms_by_pathology(
    fait_consult: DataFrame, r_hospi: DataFrame, r_room: DataFrame
) -> DataFrame:
    """Per stay in a known room: pathology of its consultation, room and day."""
    consults = _diagnosed(fait_consult).select(
        "consultation_id", "pathology_description", "started_at"
    )
    rooms = r_room.select(F.col("room_num").alias("room_number"))
    stays = r_hospi.select("hospi_id", "consultation_id", "room_number")
    known = join_dimension(stays, rooms, ["room_number"], "left_semi", ["hospi_id"])
    joined = join_dimension(
        known, consults, ["consultation_id"], spread_by=["hospi_id"], hot_in=r_hospi
    )
    return joined.select(
        "pathology_description", "room_number", F.to_date("started_at").alias("report_date")
    )


def doctor_speciality_by_pathology(fait_consult: DataFrame, r_stf: DataFrame) -> DataFrame:
    """Per consultation: the doctor and the doctor's specialty."""
    consults = _diagnosed(fait_consult).select(
        "consultation_id", "pathology_description", "staff_id", "started_at"
    )
    jobs = r_stf.select("staff_id", "job_title")
    return join_dimension(consults, jobs, ["staff_id"], spread_by=["consultation_id"]).select(
        "pathology_description",
        "staff_id",
        F.col("job_title").alias("specialty"),
        F.to_date("started_at").alias("report_date"),
    )


def patients_one_night(r_hospi: DataFrame) -> DataFrame:
    """Per start day: stays, and those that cross midnight and span a night's hours.

    Open stays count in the total only.
    """
    start, end = F.col("started_at"), F.col("ended_at")
    night = (F.to_date(end) > F.to_date(start)) & (hours_between(start, end) >= NIGHT_HOURS)
    return (
        r_hospi.groupBy(F.to_date(start).alias("report_date"))
        .agg(
            F.count("*").alias("total_hospitalisations"),
            F.sum(F.when(night, 1).otherwise(0)).alias("one_night_plus_count"),
        )
        .withColumn(
            "one_night_plus_pct",
            F.round(
                F.lit(100).cast("decimal(4,1)") * F.col("one_night_plus_count")
                / F.col("total_hospitalisations"),
                2,
            ),
        )
    )


def empty_rooms(fait_consult: DataFrame, r_hospi: DataFrame, r_room: DataFrame) -> DataFrame:
    """Every room on every day that saw a consultation, occupied or free.

    A stay occupies its room on each calendar day from its start to its end,
    both included.
    """
    days = calendar(fait_consult, "started_at")
    taken = taken_days(r_hospi, "room_number", "started_at", "ended_at", days)
    rooms = r_room.select("room_num", "room_name", "room_typ", "buld_name")
    return day_grid(rooms, "room_num", days, taken).select(
        "report_date",
        "room_num",
        "room_name",
        "room_typ",
        "buld_name",
        F.col("is_taken").alias("is_occupied"),
        F.when(F.col("is_taken") == 1, OCCUPIED).otherwise(FREE).alias("occupancy_status"),
    )


# Each view from the marts.
VIEWS = {
    "vw_avg_age_by_pathology": lambda m: avg_age_by_pathology(m["fait_consult"], m["r_indiv"]),
    "vw_top_medication_by_pathology": lambda m: top_medication_by_pathology(
        m["fait_consult"], m["r_trmt"], m["r_medc"]
    ),
    "vw_rooms_by_pathology": lambda m: rooms_by_pathology(
        m["fait_consult"], m["r_hospi"], m["r_room"]
    ),
    "vw_doctor_speciality_by_pathology": lambda m: doctor_speciality_by_pathology(
        m["fait_consult"], m["r_stf"]
    ),
    "vw_patients_one_night": lambda m: patients_one_night(m["r_hospi"]),
    "vw_empty_rooms": lambda m: empty_rooms(m["fait_consult"], m["r_hospi"], m["r_room"]),
}


def build_views(marts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All six views from the marts, keyed by view name."""
    return {name: build(marts) for name, build in VIEWS.items()}


def in_period(view: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """Rows of a view between two days, both included."""
    if since is not None:
        view = view.filter(F.col("report_date") >= F.lit(since))
    if until is not None:
        view = view.filter(F.col("report_date") <= F.lit(until))
    return view


def _by_period(view: DataFrame, period: str) -> DataFrame:
    return view.withColumn("period", period_start(F.col("report_date"), period))


def age_rollup(view: DataFrame, period: str) -> DataFrame:
    """Mean age and distinct patients per pathology and period."""
    return (
        _by_period(view, period)
        .groupBy("pathology_description", "period")
        .agg(
            F.avg("age_at_consultation").alias("avg_age"),
            F.count_distinct("patient_id").alias("n_patients"),
        )
    )


def top_medication_rollup(view: DataFrame, period: str, n: int = 1) -> DataFrame:
    """The n medications most prescribed per pathology and period."""
    medication = ("medicine_code", "medicine_name", "medicine_category", "manufacturer_brand")
    totals = (
        _by_period(view, period)
        .groupBy("pathology_description", "period", *medication)
        .agg(F.sum("total_quantity").alias("total_quantity"))
    )
    order = Window.partitionBy("pathology_description", "period").orderBy(
        F.col("total_quantity").desc(), *[F.col(c).asc_nulls_last() for c in medication]
    )
    return (
        totals.withColumn("_rank", F.row_number().over(order))
        # On the bare row number, so that each task keeps n rows before the shuffle.
        .filter(F.col("_rank") <= n)
        .withColumn("medication_rank", F.col("_rank").cast("bigint"))
        .drop("_rank")
    )


def rooms_rollup(view: DataFrame, period: str) -> DataFrame:
    """Distinct rooms per pathology and period."""
    return (
        _by_period(view, period)
        .groupBy("pathology_description", "period")
        .agg(F.count_distinct("room_number").alias("n_rooms"))
    )


def specialty_rollup(view: DataFrame, period: str) -> DataFrame:
    """Distinct doctors per pathology, specialty and period, and the specialty's share."""
    counted = (
        _by_period(view, period)
        .groupBy("pathology_description", "period", "specialty")
        .agg(F.count_distinct("staff_id").alias("n_doctors"))
    )
    # The window sees one row per specialty, not one per doctor.
    total = F.sum("n_doctors").over(Window.partitionBy("pathology_description", "period"))
    return counted.withColumn("share_pct", F.col("n_doctors") * F.lit(100.0) / total)


def occupancy_rollup(view: DataFrame, period: str) -> DataFrame:
    """Rooms occupied at least once in the period, all rooms, and rooms never occupied.

    Each room is reduced to one row per period first, so that no distinct count
    is needed afterwards.
    """
    per_room = (
        _by_period(view, period)
        .groupBy("period", "room_num")
        .agg(F.max("is_occupied").alias("_used"))
    )
    return (
        per_room.groupBy("period")
        .agg(
            F.sum("_used").cast("bigint").alias("occupied_rooms"),
            F.count("*").alias("total_rooms"),
        )
        .withColumn("free_rooms", F.col("total_rooms") - F.col("occupied_rooms"))
    )


def daily_state(
    view: DataFrame, by: Sequence[str], id_col: str, sums: Sequence[str] = ()
) -> DataFrame:
    """What a roll-up needs of each day: rows, sums, and which ids were there, as bitmaps.

    One row per group, day and range of 32,768 ids; dense ids, such as surrogate
    keys, fill few of them. States of a view can be kept and added to day by day.
    """
    return view.groupBy(
        *by, "report_date", F.bitmap_bucket_number(id_col).alias("id_range")
    ).agg(
        F.count("*").alias("n_rows"),
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("ids"),
        *[F.sum(c).alias(f"sum_{c}") for c in sums],
    )


def state_rollup(state: DataFrame, by: Sequence[str], period: str) -> DataFrame:
    """Rows, sums and distinct ids (``n_ids``) per group and period, from the states of its days.

    Days are united by OR and their bits counted: nothing is counted distinct and no
    detail is read again.
    """
    sums = [c for c in state.columns if c.startswith("sum_")]
    united = (
        _by_period(state, period)
        .groupBy(*by, "period", "id_range")
        .agg(
            F.bitmap_or_agg("ids").alias("ids"),
            F.sum("n_rows").alias("n_rows"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    return united.groupBy(*by, "period").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.bitmap_count("ids")).alias("n_ids"),
        *[F.sum(c).alias(c) for c in sums],
    )


AGE_STATE = {"by": ("pathology_description",), "id_col": "patient_id", "sums": ("age_at_consultation",)}
ROOM_STATE = {"by": ("pathology_description",), "id_col": "room_number"}
SPECIALTY_STATE = {"by": ("pathology_description", "specialty"), "id_col": "staff_id"}


def age_from_states(state: DataFrame, period: str) -> DataFrame:
    """:func:`age_rollup` from daily states."""
    rolled = state_rollup(state, AGE_STATE["by"], period)
    return rolled.select(
        *AGE_STATE["by"],
        "period",
        (F.col("sum_age_at_consultation") / F.col("n_rows")).alias("avg_age"),
        F.col("n_ids").alias("n_patients"),
    )


def rooms_from_states(state: DataFrame, period: str) -> DataFrame:
    """:func:`rooms_rollup` from daily states."""
    rolled = state_rollup(state, ROOM_STATE["by"], period)
    return rolled.select(*ROOM_STATE["by"], "period", F.col("n_ids").alias("n_rooms"))


def specialty_from_states(state: DataFrame, period: str) -> DataFrame:
    """:func:`specialty_rollup` from daily states."""
    rolled = state_rollup(state, SPECIALTY_STATE["by"], period)
    counted = rolled.select(*SPECIALTY_STATE["by"], "period", F.col("n_ids").alias("n_doctors"))
    total = F.sum("n_doctors").over(Window.partitionBy("pathology_description", "period"))
    return counted.withColumn("share_pct", F.col("n_doctors") * F.lit(100.0) / total)


def occupancy_periods(
    fait_consult: DataFrame, r_hospi: DataFrame, r_room: DataFrame, period: str,
    since: date | None = None, until: date | None = None,
) -> DataFrame:
    """:func:`occupancy_rollup` of :func:`empty_rooms` between two days, on month masks.

    The days of each period in each month are one mask; a room is occupied in the
    period if that meets the mask of its taken days. The grid of rooms and days is
    never unfolded: a room has a row for each period it was taken in.
    """
    days = calendar(fait_consult, "started_at")
    taken = taken_days(r_hospi, "room_number", "started_at", "ended_at", days)
    dates = fait_consult.select(F.to_date("started_at").alias("report_date")).filter("report_date IS NOT NULL")
    masks = (
        _by_period(in_period(dates, since, until), period)
        .groupBy("period", F.trunc("report_date", "MM").alias("month"))
        .agg(F.expr("bit_or(shiftleft(1L, dayofmonth(report_date) - 1))").alias("days"))
    )
    rooms = r_room.select(F.col("room_num").alias("place"))
    used = (
        taken.join(rooms, "place", "left_semi")
        .join(masks, "month")
        .filter(F.bit_count(F.col("taken").bitwiseAND(F.col("days"))) > 0)
        .groupBy("period", "place")
        .agg(F.lit(1).alias("_used"))
        .groupBy("period")
        .agg(F.count("*").alias("occupied_rooms"))
    )
    n_rooms = r_room.agg(F.count("*").alias("n")).scalar()
    return (
        masks.select("period").distinct().join(used, "period", "left")
        .select(
            "period",
            F.coalesce("occupied_rooms", F.lit(0).cast("long")).alias("occupied_rooms"),
            n_rooms.alias("total_rooms"),
        )
        .filter("total_rooms > 0")
        .withColumn("free_rooms", F.col("total_rooms") - F.col("occupied_rooms"))
    )
