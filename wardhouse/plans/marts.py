"""Dimensions and facts of the star schema, from the accepted work rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse.functions.dates import days_between, minutes_between
from wardhouse.operators.quality import accepted
from wardhouse.operators.surrogate import dense_key


def r_room(wrk_chambre: DataFrame) -> DataFrame:
    return accepted(wrk_chambre).select(
        F.col("room_number").alias("room_num"),
        "room_name",
        F.col("floor_number").alias("flor_num"),
        F.col("building_name").alias("buld_name"),
        F.col("room_type").alias("room_typ"),
        F.col("day_rate").alias("room_day_rate"),
        F.col("created_date").alias("crtn_dt"),
        "exec_id",
    )


def r_medc(wrk_medicament: DataFrame, partitions: int | None = None) -> DataFrame:
    rows = accepted(wrk_medicament).select(
        F.col("medicine_code").alias("medc_cd"),
        F.col("medicine_name").alias("medc_name"),
        F.col("medicine_packaging").alias("medc_cond"),
        F.col("medicine_category").alias("medc_catg"),
        F.col("manufacturer_brand").alias("manf_brnd"),
        "exec_id",
    )
    return dense_key(rows, ("medc_cd", "medc_catg", "manf_brnd"), "medc_id", partitions)


PATIENT_TYPE = "Patient"


def r_part(
    wrk_patient: DataFrame, wrk_personnel: DataFrame, partitions: int | None = None
) -> DataFrame:
    """Patients and staff as one population, numbered by type and source id."""
    patients = accepted(wrk_patient).select(
        F.col("patient_id").alias("src_id"), F.lit(PATIENT_TYPE).alias("src_typ"), "exec_id"
    )
    staff = accepted(wrk_personnel).select(
        F.col("staff_id").alias("src_id"), F.col("job_title").alias("src_typ"), "exec_id"
    )
    numbered = dense_key(patients.unionByName(staff), ("src_typ", "src_id"), "part_id", partitions)
    return numbered.select("part_id", "src_id", "src_typ", "exec_id")


def r_indiv(wrk_patient: DataFrame) -> DataFrame:
    return accepted(wrk_patient).select(
        F.col("patient_id").alias("indiv_id"),
        "last_name",
        "first_name",
        "social_security_number",
        "birth_date",
        "birth_city",
        "birth_country",
        "created_at",
        "updated_at",
        "exec_id",
    )


def r_stf(wrk_personnel: DataFrame) -> DataFrame:
    return accepted(wrk_personnel).select(
        "staff_id",
        "last_name",
        "first_name",
        "job_title",
        "work_start_at",
        "work_end_at",
        "work_end_reason",
        "status_code",
        "created_at",
        "updated_at",
        "exec_id",
    )


def r_addr(wrk_patient: DataFrame) -> DataFrame:
    """Patients of whom at least street, postal code or city is known."""
    known = (
        F.col("street_name").isNotNull()
        | F.col("postal_code").isNotNull()
        | F.col("city").isNotNull()
    )
    return accepted(wrk_patient).filter(known).select(
        F.col("patient_id").alias("indiv_id"),
        "street_number",
        "street_name",
        "address_complement",
        "postal_code",
        "city",
        "country",
        "exec_id",
    )


def r_tel(wrk_patient: DataFrame) -> DataFrame:
    return accepted(wrk_patient).filter(F.col("phone_number").isNotNull()).select(
        F.col("patient_id").alias("indiv_id"), "phone_country_code", "phone_number", "exec_id"
    )


def r_trmt(wrk_traitement: DataFrame) -> DataFrame:
    return accepted(wrk_traitement).select(
        "treatment_id",
        "consultation_id",
        "medicine_code",
        "medicine_category",
        "manufacturer_brand",
        "medicine_quantity",
        "dosage_description",
        "created_at",
        "exec_id",
    )


def fait_consult(wrk_consultation: DataFrame) -> DataFrame:
    """One row per consultation, with its length in minute boundaries."""
    return accepted(wrk_consultation).select(
        "consultation_id",
        "patient_id",
        "staff_id",
        "treatment_id",
        "started_at",
        "ended_at",
        "patient_weight_kg",
        "patient_temperature",
        "temperature_unit",
        "blood_pressure",
        "pathology_description",
        "diabetes_indicator",
        "hospitalisation_indicator",
        "exec_id",
        minutes_between(F.col("started_at"), F.col("ended_at")).alias("duration_minutes"),
    )


def r_hospi(wrk_hospitalisation: DataFrame) -> DataFrame:
    """One row per stay, with its length in calendar days; NULL while open."""
    return accepted(wrk_hospitalisation).select(
        "hospi_id",
        "consultation_id",
        "room_number",
        "responsible_staff_id",
        "started_at",
        "ended_at",
        "cost",
        "exec_id",
        days_between(F.col("started_at"), F.col("ended_at")).alias("duration_days"),
    )


# What each mart is mostly joined on.
MART_KEYS = {
    "r_room": ("room_num",),
    "r_medc": ("medc_cd", "medc_catg", "manf_brnd"),
    "r_part": ("src_id",),
    "r_indiv": ("indiv_id",),
    "r_stf": ("staff_id",),
    "r_addr": ("indiv_id",),
    "r_tel": ("indiv_id",),
    "r_trmt": ("treatment_id",),
    "fait_consult": ("consultation_id",),
    "r_hospi": ("consultation_id",),
}


# Each mart from the gated tables, in the order they are built.
MARTS = {
    "r_room": lambda work: r_room(work["CHAMBRE"]),
    "r_medc": lambda work: r_medc(work["MEDICAMENT"]),
    "r_part": lambda work: r_part(work["PATIENT"], work["PERSONNEL"]),
    "r_indiv": lambda work: r_indiv(work["PATIENT"]),
    "r_stf": lambda work: r_stf(work["PERSONNEL"]),
    "r_addr": lambda work: r_addr(work["PATIENT"]),
    "r_tel": lambda work: r_tel(work["PATIENT"]),
    "r_trmt": lambda work: r_trmt(work["TRAITEMENT"]),
    "fait_consult": lambda work: fait_consult(work["CONSULTATION"]),
    "r_hospi": lambda work: r_hospi(work["HOSPITALISATION"]),
}
