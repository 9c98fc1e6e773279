"""The party model: individuals, staff, phones, addresses and events on party keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse.operators.normalise import flag
from wardhouse.operators.quality import accepted
from wardhouse.operators.references import look_up
from wardhouse.plans.marts import PATIENT_TYPE

# Fixed value: status given to every patient.
ACTIVE = "Actif"


def patient_parties(r_part: DataFrame) -> DataFrame:
    return r_part.filter(F.col("src_typ") == PATIENT_TYPE)


def staff_parties(r_part: DataFrame) -> DataFrame:
    return r_part.filter(F.col("src_typ") != PATIENT_TYPE)


def _patients(wrk_patient: DataFrame, r_part: DataFrame) -> DataFrame:
    return look_up(
        accepted(wrk_patient), ["patient_id"], patient_parties(r_part), ["src_id"],
        "part_id", "part_id",
    )


def _staff(wrk_personnel: DataFrame, r_part: DataFrame) -> DataFrame:
    return look_up(
        accepted(wrk_personnel), ["staff_id", "job_title"], staff_parties(r_part),
        ["src_id", "src_typ"], "part_id", "part_id",
    )


def o_indv(wrk_patient: DataFrame, wrk_personnel: DataFrame, r_part: DataFrame) -> DataFrame:
    """Patients and staff as individuals."""
    patients = _patients(wrk_patient, r_part).select(
        "part_id",
        F.col("last_name").alias("indv_name"),
        F.col("first_name").alias("indv_firs_name"),
        F.lit(ACTIVE).alias("indv_stts_cd"),
        F.col("created_at").alias("crtn_dttm"),
        F.col("updated_at").alias("updt_dttm"),
        F.col("birth_date").alias("birt_dt"),
        F.col("birth_city").alias("birt_city"),
        F.col("birth_country").alias("birt_cntr"),
        F.col("social_security_number").alias("socl_num"),
        "exec_id",
    )
    staff = _staff(wrk_personnel, r_part).select(
        "part_id",
        F.col("last_name").alias("indv_name"),
        F.col("first_name").alias("indv_firs_name"),
        F.col("status_code").alias("indv_stts_cd"),
        F.col("created_at").alias("crtn_dttm"),
        F.col("updated_at").alias("updt_dttm"),
        F.lit(None).cast("date").alias("birt_dt"),
        *[F.lit(None).cast("string").alias(c) for c in ("birt_city", "birt_cntr", "socl_num")],
        "exec_id",
    )
    return patients.unionByName(staff)


def o_stff(wrk_personnel: DataFrame, r_part: DataFrame) -> DataFrame:
    return _staff(wrk_personnel, r_part).select(
        "part_id",
        F.col("work_start_at").alias("work_strt_dttm"),
        F.col("work_end_at").alias("work_end_dttm"),
        F.col("work_end_reason").alias("work_end_resn"),
        "exec_id",
    )


def o_telp(wrk_patient: DataFrame, r_part: DataFrame) -> DataFrame:
    """Phone numbers, valid from the patient's creation to the last update."""
    known = wrk_patient.filter(F.col("phone_number").isNotNull())
    return _patients(known, r_part).select(
        "part_id",
        F.col("created_at").alias("strt_vald_dttm"),
        F.col("phone_country_code").alias("cntr_ind"),
        F.col("phone_number").alias("telp_num"),
        F.col("updated_at").alias("end_vald_dttm"),
        "exec_id",
    )


def o_addr(wrk_patient: DataFrame, r_part: DataFrame) -> DataFrame:
    """Addresses, valid from the patient's creation to the last update."""
    known = wrk_patient.filter(
        "street_name IS NOT NULL OR postal_code IS NOT NULL OR city IS NOT NULL"
    )
    return _patients(known, r_part).select(
        "part_id",
        F.col("created_at").alias("strt_vald_dttm"),
        F.col("street_number").alias("strt_num"),
        F.col("street_name").alias("strt_dsc"),
        F.col("address_complement").alias("comp_strt"),
        F.col("postal_code").alias("post_cd"),
        F.col("city").alias("city_name"),
        F.col("country").alias("cntr_name"),
        F.col("updated_at").alias("end_vald_dttm"),
        "exec_id",
    )


def o_cons(wrk_consultation: DataFrame, r_part: DataFrame) -> DataFrame:
    """Consultations on the party keys of doctor and patient."""
    rows = look_up(
        accepted(wrk_consultation), ["staff_id"], staff_parties(r_part), ["src_id"],
        "part_id", "stff_id",
    )
    rows = look_up(
        rows, ["patient_id"], patient_parties(r_part), ["src_id"], "part_id", "patn_id",
        hot_in=accepted(wrk_consultation),
    )
    return rows.select(
        F.col("consultation_id").alias("cons_id"),
        "stff_id",
        "patn_id",
        F.col("started_at").alias("cons_strt_dttm"),
        F.col("ended_at").alias("cons_end_dttm"),
        F.col("patient_weight_kg").alias("patn_wegh"),
        F.col("patient_temperature").alias("patn_temp"),
        F.col("temperature_unit").alias("temp_unit"),
        F.col("blood_pressure").alias("bld_prss"),
        F.col("pathology_description").alias("path_dsc"),
        flag(F.col("diabetes_indicator")).alias("dibt_ind"),
        F.col("treatment_id").alias("tret_id"),
        flag(F.col("hospitalisation_indicator")).alias("hosp_ind"),
        "exec_id",
    )


def o_tret(wrk_traitement: DataFrame, r_medc: DataFrame) -> DataFrame:
    """Treatments on the medication key."""
    rows = look_up(
        accepted(wrk_traitement),
        ["medicine_code", "medicine_category", "manufacturer_brand"],
        r_medc,
        ["medc_cd", "medc_catg", "manf_brnd"],
        "medc_id",
        "medc_id",
    )
    return rows.select(
        F.col("treatment_id").alias("tret_id"),
        "medc_id",
        F.col("medicine_quantity").alias("medc_qty"),
        F.col("dosage_description").alias("dosg_dsc"),
        F.col("consultation_id").alias("cons_id"),
        F.col("created_at").alias("tret_crtn_dttm"),
        "exec_id",
    )


def o_hosp(wrk_hospitalisation: DataFrame, r_part: DataFrame) -> DataFrame:
    """Stays on the party key of the responsible doctor."""
    rows = look_up(
        accepted(wrk_hospitalisation), ["responsible_staff_id"], staff_parties(r_part),
        ["src_id"], "part_id", "stff_id",
    )
    return rows.select(
        F.col("hospi_id").alias("hosp_id"),
        F.col("consultation_id").alias("cons_id"),
        F.col("room_number").alias("room_num"),
        F.col("started_at").alias("hosp_strt_dttm"),
        F.col("ended_at").alias("hosp_end_dttm"),
        F.col("cost").alias("hosp_finl_rate"),
        "stff_id",
        "exec_id",
    )


def build_party(
    work: dict[str, DataFrame], r_part: DataFrame, r_medc: DataFrame
) -> dict[str, DataFrame]:
    """All party-model tables from the gated tables and the two surrogate tables."""
    return {
        "o_indv": o_indv(work["PATIENT"], work["PERSONNEL"], r_part),
        "o_stff": o_stff(work["PERSONNEL"], r_part),
        "o_telp": o_telp(work["PATIENT"], r_part),
        "o_addr": o_addr(work["PATIENT"], r_part),
        "o_cons": o_cons(work["CONSULTATION"], r_part),
        "o_tret": o_tret(work["TRAITEMENT"], r_medc),
        "o_hosp": o_hosp(work["HOSPITALISATION"], r_part),
    }
