"""What the hospital's daily extracts look like, as data.

One :class:`Table` per source extract: header names, loaded types, keys, load
mode, staging names, quality rules and the order that picks the latest version
of a key. Every operator takes such values as parameters, so the same code
serves any table described this way.
"""

from __future__ import annotations

from dataclasses import dataclass, field

NULL_MANDATORY = "NULL_MANDATORY"
WRONG_FORMAT = "WRONG_FORMAT"
WRONG_TYPE = "WRONG_TYPE"
DUPLICATE_PK = "DUPLICATE_PK"
FK_NOT_FOUND = "FK_NOT_FOUND"
NORM_FAILURE = "NORM_FAILURE"


@dataclass(frozen=True)
class Column:
    """One column on its way from the file header to the staging layer.

    ``kind`` is the logical type it is loaded as; ``staged_type`` is the type
    it is cast to in staging when that differs.
    """

    source: str
    kind: str
    staged: str
    required: bool = False
    loaded: str | None = None
    staged_type: str | None = None

    @property
    def target(self) -> str:
        return self.loaded or self.source


@dataclass(frozen=True)
class Rule:
    """A row that meets ``failing`` (a SQL predicate) is rejected with ``code``.

    A predicate that evaluates to NULL does not reject.
    """

    code: str
    failing: str
    note: str = ""


@dataclass(frozen=True)
class Reference:
    """Foreign key: ``columns`` of this table exist as ``parent_columns`` of ``parent``."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    parent_filter: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    load: str
    keys: tuple[str, ...]
    columns: tuple[Column, ...]
    rules: tuple[Rule, ...]
    latest_by: tuple[str, ...]
    guard: str | None = None
    retention_months: int = 13
    references: tuple[Reference, ...] = field(default_factory=tuple)

    @property
    def header(self) -> tuple[str, ...]:
        return tuple(c.source for c in self.columns)

    @property
    def staged_keys(self) -> tuple[str, ...]:
        names = {c.target: c.staged for c in self.columns}
        return tuple(names[k] for k in self.keys)


def required(*names: str) -> tuple[Rule, ...]:
    return tuple(Rule(NULL_MANDATORY, f"{n} IS NULL", f"{n} is missing") for n in names)


def positive(name: str) -> Rule:
    return Rule(WRONG_FORMAT, f"{name} <= 0", f"{name} is not above zero")


def not_before(end: str, start: str) -> Rule:
    return Rule(WRONG_FORMAT, f"{end} < {start}", f"{end} is before {start}")


def not_negative(name: str) -> Rule:
    return Rule(WRONG_FORMAT, f"{name} < 0", f"{name} is negative")


# File layout of a daily batch.
SEPARATOR = ";"
FOLDER_PREFIX = "BDD_HOSPITAL_"

# Header names, loaded types and staging names of the seven
# extracts, in file order. `required` marks the columns declared NOT NULL.
PATIENT = Table(
    name="PATIENT",
    load="delta",
    keys=("ID_PATIENT",),
    guard="TS_MAJ_PATIENT",
    columns=(
        Column("ID_PATIENT", "integer", "patient_id", required=True),
        Column("NOM_PATIENT", "varchar", "last_name", required=True),
        Column("PRENOM_PATIENT", "varchar", "first_name", required=True),
        Column("DT_NAISS", "date", "birth_date"),
        Column("VILLE_NAISS", "varchar", "birth_city"),
        Column("PAYS_NAISS", "varchar", "birth_country"),
        Column("NUM_SECU", "varchar", "social_security_number"),
        Column("IND_PAYS_NUM_TELP", "varchar", "phone_country_code"),
        Column("NUM_TELEPHONE", "varchar", "phone_number"),
        Column("NUM_VOIE", "varchar", "street_number"),
        Column("DSC_VOIE", "varchar", "street_name"),
        Column("CMPL_VOIE", "varchar", "address_complement"),
        Column("CD_POSTAL", "varchar", "postal_code"),
        Column("VILLE", "varchar", "city"),
        Column("PAYS", "varchar", "country"),
        Column("TS_CREATION_PATIENT", "timestamp", "created_at", required=True),
        Column("TS_MAJ_PATIENT", "timestamp", "updated_at", required=True),
    ),
    rules=(
        *required("patient_id"),
        positive("patient_id"),
        *required("last_name", "first_name", "created_at", "updated_at"),
    ),
    latest_by=("updated_at DESC NULLS LAST", "created_at DESC NULLS LAST"),
)

PERSONNEL = Table(
    name="PERSONNEL",
    load="full",
    keys=("ID_PERSONNEL",),
    columns=(
        Column("ID_PERSONNEL", "integer", "staff_id", required=True),
        Column("NOM_PERSONNEL", "varchar", "last_name", required=True),
        Column("PRENOM_PERSONNEL", "varchar", "first_name", required=True),
        Column("FONCTION_PERSONNEL", "varchar", "job_title", required=True),
        Column("TS_DEBUT_ACTIVITE", "timestamp", "work_start_at", required=True),
        Column("TS_FIN_ACTIVITE", "timestamp", "work_end_at"),
        Column("RAISON_FIN_ACTIVITE", "varchar", "work_end_reason"),
        Column("TS_CREATION_PERSONNEL", "timestamp", "created_at", required=True),
        Column("TS_MAJ_PERSONNEL", "timestamp", "updated_at", required=True),
        Column("CD_STATUT_PERSONNEL", "varchar", "status_code", required=True),
    ),
    rules=(
        *required("staff_id"),
        positive("staff_id"),
        *required(
            "last_name", "first_name", "job_title", "work_start_at",
            "created_at", "updated_at", "status_code",
        ),
    ),
    latest_by=("updated_at DESC NULLS LAST", "created_at DESC NULLS LAST"),
    retention_months=3,
)

CHAMBRE = Table(
    name="CHAMBRE",
    load="full",
    keys=("NO_CHAMBRE",),
    columns=(
        Column("NO_CHAMBRE", "integer", "room_number", required=True),
        Column("NOM_CHAMBRE", "varchar", "room_name", required=True),
        Column("NO_ETAGE", "smallint", "floor_number"),
        Column("NOM_BATIMENT", "varchar", "building_name"),
        Column("TYPE_CHAMBRE", "varchar", "room_type"),
        Column("PRIX_JOUR", "smallint", "day_rate", required=True),
        Column("DT_CREATION", "date", "created_date", required=True),
    ),
    rules=(
        *required("room_number"),
        positive("room_number"),
        *required("room_name", "day_rate"),
        positive("day_rate"),
        *required("created_date"),
    ),
    latest_by=("created_date DESC NULLS LAST",),
    retention_months=3,
)

MEDICAMENT = Table(
    name="MEDICAMENT",
    load="full",
    keys=("CD_MEDICAMENT", "CATG_MEDICAMENT", "MARQUE_FABRI"),
    columns=(
        Column("CD_MEDICAMENT", "varchar", "medicine_code", required=True),
        Column("NOM_MEDICAMENT", "varchar", "medicine_name"),
        Column("CONDIT_MEDICAMENT", "varchar", "medicine_packaging"),
        Column("CATG_MEDICAMENT", "varchar", "medicine_category", required=True),
        Column("MARQUE_FABRI", "varchar", "manufacturer_brand", required=True),
    ),
    rules=required("medicine_code", "medicine_category", "manufacturer_brand"),
    # Alphabetical, not by recency: the extract carries no timestamp.
    latest_by=("medicine_name ASC NULLS LAST",),
    retention_months=3,
)

CONSULTATION = Table(
    name="CONSULTATION",
    load="delta",
    keys=("ID_CONSULT",),
    columns=(
        Column("ID_CONSULT", "integer", "consultation_id", required=True),
        Column("ID_PERSONNEL", "integer", "staff_id", required=True),
        Column("ID_PATIENT", "integer", "patient_id", required=True),
        Column("TS_DEBUT_CONSULT", "timestamp", "started_at", required=True),
        Column("TS_FIN_CONSULT", "timestamp", "ended_at", required=True),
        Column("POIDS_PATIENT", "integer", "patient_weight_kg", required=True,
               staged_type="decimal(6,2)"),
        Column("TEMP_PATIENT", "decimal(38,0)", "patient_temperature",
               staged_type="decimal(5,2)"),
        Column("UNIT_TEMP", "varchar", "temperature_unit"),
        Column("TENSION_PATIENT", "integer", "blood_pressure"),
        Column("DSC_PATHO", "varchar", "pathology_description"),
        Column("INDIC_DIABETE", "boolean", "diabetes_indicator"),
        Column("ID_TRAITEMENT", "integer", "treatment_id"),
        Column("INDIC_HOSPI", "boolean", "hospitalisation_indicator"),
    ),
    rules=(
        *required("consultation_id"),
        positive("consultation_id"),
        *required("patient_id", "staff_id", "started_at", "ended_at"),
        not_before("ended_at", "started_at"),
    ),
    latest_by=("started_at DESC NULLS LAST",),
    references=(
        Reference(("staff_id",), "PERSONNEL", ("staff_id",)),
        Reference(("patient_id",), "PATIENT", ("patient_id",)),
    ),
)

TRAITEMENT = Table(
    name="TRAITEMENT",
    load="delta",
    keys=("ID_TRAITEMENT",),
    columns=(
        Column("ID_TRAITEMENT", "integer", "treatment_id", required=True),
        Column("CD_MEDICAMENT", "varchar", "medicine_code", required=True),
        Column("CATG_MEDICAMENT", "varchar", "medicine_category", required=True),
        Column("MARQUE_FABRI", "varchar", "manufacturer_brand", required=True),
        Column("QTE_MEDICAMENT", "integer", "medicine_quantity", staged_type="decimal(8,3)"),
        Column("DSC_POSOLOGIE", "varchar", "dosage_description", required=True),
        Column("ID_CONSULT", "integer", "consultation_id", required=True),
        Column("TS_CREATION_TRAITEMENT", "timestamp", "created_at", required=True),
    ),
    rules=(
        *required("treatment_id"),
        positive("treatment_id"),
        *required(
            "consultation_id", "medicine_code", "medicine_category",
            "manufacturer_brand", "dosage_description",
        ),
    ),
    latest_by=("created_at DESC NULLS LAST", "treatment_id ASC NULLS LAST"),
    references=(
        Reference(
            ("medicine_code", "medicine_category", "manufacturer_brand"),
            "MEDICAMENT",
            ("medicine_code", "medicine_category", "manufacturer_brand"),
        ),
        Reference(("consultation_id",), "CONSULTATION", ("consultation_id",)),
    ),
)

HOSPITALISATION = Table(
    name="HOSPITALISATION",
    load="delta",
    keys=("ID_HOSPI",),
    columns=(
        Column("ID_HOSPI", "integer", "hospi_id", required=True),
        Column("ID_CONSULT_hospi", "integer", "consultation_id", required=True,
               loaded="ID_CONSULT"),
        Column("NO_CHAMBRE_hospi", "integer", "room_number", required=True,
               loaded="NO_CHAMBRE"),
        Column("TS_DEBUT_HOSPI", "timestamp", "started_at", required=True),
        Column("TS_FIN_HOSPI", "timestamp", "ended_at"),
        Column("COUT_HOSPI", "decimal(10,2)", "cost"),
        Column("ID_PERSONNEL_RESP", "integer", "responsible_staff_id", required=True),
    ),
    rules=(
        *required("hospi_id"),
        positive("hospi_id"),
        *required("consultation_id", "room_number", "responsible_staff_id", "started_at"),
        not_before("ended_at", "started_at"),
        not_negative("cost"),
    ),
    latest_by=("started_at DESC NULLS LAST",),
    references=(
        Reference(
            ("consultation_id",), "CONSULTATION", ("consultation_id",),
            parent_filter="hospitalisation_indicator",
        ),
        Reference(("room_number",), "CHAMBRE", ("room_number",)),
        Reference(("responsible_staff_id",), "PERSONNEL", ("staff_id",)),
    ),
)

# Load order of a daily batch.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        PATIENT, PERSONNEL, CHAMBRE, MEDICAMENT, CONSULTATION, TRAITEMENT, HOSPITALISATION,
    )
}


def table(name: str) -> Table:
    try:
        return TABLES[name]
    except KeyError:
        raise ValueError(f"unknown table {name!r}; known tables: {list(TABLES)}") from None


def _not_a_number(name: str) -> Rule:
    return Rule(
        WRONG_FORMAT,
        f"try_cast({name} AS double) IS NULL OR try_cast({name} AS double) <= 0",
        f"{name} is not a number above zero",
    )


def _not_a_timestamp(name: str) -> Rule:
    return Rule(
        WRONG_FORMAT,
        f"{name} IS NOT NULL AND (try_cast({name} AS timestamp_ntz) IS NULL"
        f" OR NOT {name} RLIKE '^ *[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')",
        f"{name} is not a timestamp",
    )


def _ends_early(end: str, start: str) -> Rule:
    return Rule(
        WRONG_FORMAT,
        f"try_cast({end} AS timestamp_ntz) < try_cast({start} AS timestamp_ntz)",
        f"{end} is before {start}",
    )


# The same gates over text columns, before any cast. Only here is a malformed
# value (WRONG_FORMAT) told apart from a missing one (NULL_MANDATORY).
TEXT_RULES: dict[str, tuple[Rule, ...]] = {
    "CONSULTATION": (
        *required("consultation_id"),
        _not_a_number("consultation_id"),
        *required("patient_id", "staff_id", "started_at"),
        _not_a_timestamp("started_at"),
        *required("ended_at"),
        _not_a_timestamp("ended_at"),
        _ends_early("ended_at", "started_at"),
    ),
    "TRAITEMENT": (
        *required("treatment_id"),
        _not_a_number("treatment_id"),
        *required(
            "consultation_id", "medicine_code", "medicine_category",
            "manufacturer_brand", "dosage_description",
        ),
    ),
    "HOSPITALISATION": (
        *required("hospi_id"),
        _not_a_number("hospi_id"),
        *required("consultation_id", "room_number", "responsible_staff_id", "started_at"),
        _not_a_timestamp("started_at"),
        _not_a_timestamp("ended_at"),
        _ends_early("ended_at", "started_at"),
        Rule(WRONG_FORMAT, "try_cast(cost AS double) < 0", "cost is negative"),
    ),
}

# Stricter gates, as the documentation of the layers asks for. They replace the
# table's own rules where a caller passes them.
STRICT_RULES: dict[str, tuple[Rule, ...]] = {
    "CONSULTATION": (
        *CONSULTATION.rules, *required("patient_weight_kg"), positive("patient_weight_kg"),
    ),
    "TRAITEMENT": (*TRAITEMENT.rules, *required("created_at")),
}
