"""Which checks each table of the warehouse must pass, and running them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.contracts import TABLES, Table
from wardhouse.operators import checks


@dataclass(frozen=True)
class Values:
    column: str
    accepted: tuple
    where: str | None = None


@dataclass(frozen=True)
class Parent:
    columns: tuple[str, ...]
    table: str
    parent_columns: tuple[str, ...]
    where: str | None = None


@dataclass(frozen=True)
class Expect:
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    unique_where: str | None = None
    accepted: tuple[Values, ...] = ()
    parents: tuple[Parent, ...] = ()
    never: tuple[str, ...] = ()
    present: tuple[tuple[str, str], ...] = field(default_factory=tuple)


# The checks declared on each layer.
LOADED = {
    "PATIENT": Expect(("ID_PATIENT", "NOM_PATIENT"), (("ID_PATIENT",),)),
    "PERSONNEL": Expect(("ID_PERSONNEL",), (("ID_PERSONNEL",),)),
    "CHAMBRE": Expect(("NO_CHAMBRE",), (("NO_CHAMBRE",),)),
    "MEDICAMENT": Expect(("CD_MEDICAMENT",)),
    "CONSULTATION": Expect(("ID_CONSULT", "ID_PATIENT", "ID_PERSONNEL"), (("ID_CONSULT",),)),
    "TRAITEMENT": Expect(("ID_TRAITEMENT", "ID_CONSULT"), (("ID_TRAITEMENT",),)),
    "HOSPITALISATION": Expect(("ID_HOSPI", "ID_CONSULT"), (("ID_HOSPI",),)),
}
STAGED = {
    "PATIENT": Expect(
        ("patient_id", "last_name", "first_name", "created_at", "updated_at"), (("patient_id",),)
    ),
    "CHAMBRE": Expect((
        "room_number", "room_name", "day_rate", "created_date",
    ), (("room_number",),)),
    "MEDICAMENT": Expect(
        ("medicine_code", "medicine_category", "manufacturer_brand"),
        (("medicine_code", "medicine_category", "manufacturer_brand"),),
    ),
    "CONSULTATION": Expect(
        ("consultation_id", "patient_id", "staff_id", "ended_at"), (("consultation_id",),)
    ),
    "TRAITEMENT": Expect(
        (
            "treatment_id", "consultation_id", "medicine_code", "medicine_category",
            "manufacturer_brand", "medicine_quantity",
        ),
        (("treatment_id",),),
    ),
    "HOSPITALISATION": Expect(
        ("hospi_id", "consultation_id", "room_number", "responsible_staff_id"), (("hospi_id",),)
    ),
    "PERSONNEL": Expect(
        (
            "staff_id", "last_name", "first_name", "job_title", "work_start_at", "created_at",
            "updated_at", "status_code",
        ),
        (("staff_id",),),
    ),
}
_REJECTED = "wrk_stts_cd = 'REJ'"


def _gated(table: Table) -> Expect:
    keys = table.staged_keys
    return Expect(
        (*keys, "wrk_stts_cd", "batch_dt", "exec_id"),
        (keys,),
        "wrk_stts_cd = 'OK'",
        (
            Values("wrk_stts_cd", ("OK", "REJ")),
            # The codes that the table's own rules can give.
            Values("rej_cod", tuple(dict.fromkeys(r.code for r in table.rules)), _REJECTED),
        ),
    )


WORK = {t.name: _gated(t) for t in TABLES.values()}
MARTS = {
    "r_room": Expect(
        ("room_num", "room_name", "room_day_rate", "crtn_dt", "exec_id"), (("room_num",),),
        never=("room_day_rate IS NULL OR room_day_rate <= 0",),
    ),
    "r_medc": Expect(
        ("medc_id", "medc_cd", "medc_catg", "manf_brnd", "exec_id"),
        (("medc_id",), ("medc_cd", "medc_catg", "manf_brnd")),
    ),
    "r_part": Expect(
        ("part_id", "src_id", "src_typ", "exec_id"), (("part_id",), ("src_id", "src_typ")),
        present=(
            ("src_typ = 'Patient'", "missing Patient population"),
            ("src_typ <> 'Patient'", "missing personnel population"),
        ),
    ),
    "r_indiv": Expect(
        (
            "indiv_id", "last_name", "first_name", "created_at", "updated_at", "exec_id",
        ), (("indiv_id",),)
    ),
    "r_stf": Expect(
        (
            "staff_id", "last_name", "first_name", "job_title", "work_start_at", "status_code",
            "exec_id",
        ),
        (("staff_id",),),
    ),
    "r_addr": Expect(
        ("indiv_id", "exec_id"), (("indiv_id",),),
        parents=(Parent(("indiv_id",), "r_indiv", ("indiv_id",)),),
    ),
    "r_tel": Expect(
        ("indiv_id", "phone_number", "exec_id"), (("indiv_id",),),
        parents=(Parent(("indiv_id",), "r_indiv", ("indiv_id",)),),
    ),
    "r_trmt": Expect(
        (
            "treatment_id", "consultation_id", "medicine_code", "medicine_category",
            "manufacturer_brand", "exec_id",
        ),
        (("treatment_id",),),
    ),
    "r_hospi": Expect(
        ("hospi_id", "consultation_id", "room_number", "started_at", "exec_id"),
        (("hospi_id",),),
        parents=(
            Parent(("room_number",), "r_room", ("room_num",)),
            Parent(("responsible_staff_id",), "r_stf", ("staff_id",)),
        ),
    ),
    "fait_consult": Expect(
        ("consultation_id", "patient_id", "staff_id", "started_at", "exec_id"),
        (("consultation_id",),),
        parents=(
            Parent(("patient_id",), "r_indiv", ("indiv_id",)),
            Parent(("staff_id",), "r_stf", ("staff_id",)),
            Parent(("treatment_id",), "r_trmt", ("treatment_id",), "treatment_id IS NOT NULL"),
        ),
    ),
}
VIEWS = {
    "vw_avg_age_by_pathology": Expect(
        ("pathology_description", "patient_id", "report_date", "age_at_consultation"),
        never=("age_at_consultation < 0",),
    ),
    "vw_top_medication_by_pathology": Expect(
        (
            "pathology_description", "report_date", "medicine_code", "medicine_name",
            "medicine_category", "manufacturer_brand", "total_quantity",
        ),
        never=("total_quantity < 0",),
    ),
    "vw_rooms_by_pathology": Expect(
        ("pathology_description", "room_number", "report_date"), never=("room_number = 0",)
    ),
    "vw_doctor_speciality_by_pathology": Expect(
        ("pathology_description", "staff_id", "specialty", "report_date")
    ),
    "vw_patients_one_night": Expect(
        ("report_date", "total_hospitalisations", "one_night_plus_count", "one_night_plus_pct"),
        never=("one_night_plus_count > total_hospitalisations", "one_night_plus_pct < 0"),
    ),
    "vw_empty_rooms": Expect(
        ("report_date", "room_num", "room_name", "is_occupied", "occupancy_status"),
        accepted=(
            Values("is_occupied", (0, 1)),
            Values("occupancy_status", ("Occupée", "Libre")),
        ),
    ),
}

# Constraints the loaded tables declare: required columns and primary keys.
DECLARED = {
    t.name: Expect(tuple(c.target for c in t.columns if c.required), (t.keys,))
    for t in TABLES.values()
}

LAYERS = {
    "loaded": LOADED, "declared": DECLARED, "staged": STAGED, "work": WORK, "marts": MARTS,
    "views": VIEWS,
}


def run_checks(
    tables: dict[str, DataFrame], expected: dict[str, Expect],
    parents: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Failing checks of a layer: table, check, detail, number of failures.

    Everything that one pass over a table can count shares that pass; all unique
    checks of a table share one shuffle, and so do all references to one parent.
    """
    parents = parents or tables
    parts, children = [], {}
    for name, expect in expected.items():
        parts += _failures(tables[name], name, expect)
        for p in expect.parents:
            children.setdefault((p.table, p.parent_columns), []).append((name, p))
    for (table, columns), named in children.items():
        lost = checks.lost_by_parent(
            parents[table], columns, [(tables[name], p.columns, p.where) for name, p in named]
        )
        parts.append(_labelled(lost, "child", [(n, f"parent {table}", p.columns) for n, p in named]))
    return reduce(DataFrame.unionByName, parts)


def _failures(df: DataFrame, name: str, expect: Expect):
    def row(check: str, detail: str, count: Column):
        return F.struct(
            F.lit(name).alias("src_table"), F.lit(check).alias("check"),
            F.lit(detail).alias("detail"), count.cast("bigint").alias("n_failed"),
        )

    counted = [row("not_null", c, F.count_if(F.col(c).isNull())) for c in expect.not_null]
    for v in expect.accepted:
        outside = F.col(v.column).isNotNull() & ~F.col(v.column).isin(*v.accepted)
        if v.where:
            outside = outside & F.expr(v.where)
        counted.append(row("accepted_values", v.column, F.count_if(outside)))
    counted += [row("never", p, F.count_if(F.expr(p))) for p in expect.never]
    for predicate, reason in expect.present:
        absent = F.when(F.count_if(F.expr(predicate)) == 0, 1).otherwise(0)
        counted.append(row("population", reason, absent))
    if counted:
        yield df.agg(F.array(*counted).alias("r")).select(F.inline("r")).filter("n_failed > 0")
    if expect.unique:
        repeated = checks.repeated_keys(df, expect.unique, expect.unique_where)
        yield _labelled(repeated, "key_set", [(name, "unique", keys) for keys in expect.unique])


def _labelled(failures: DataFrame, position: str, labels: list[tuple]) -> DataFrame:
    """Failures counted by position, under the table, check and columns at that position."""
    named = F.array(
        *[
            F.struct(
                F.lit(name).alias("src_table"), F.lit(check).alias("check"),
                F.lit(", ".join(columns)).alias("detail"),
            )
            for name, check, columns in labels
        ]
    )
    return failures.withColumn("_l", F.get(named, F.col(position))).select(
        "_l.src_table", "_l.check", "_l.detail", F.col("n_failed").cast("bigint").alias("n_failed")
    )
