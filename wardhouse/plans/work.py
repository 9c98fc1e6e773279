"""The work layer: each staged table behind its quality gate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from wardhouse.contracts import (
    DUPLICATE_PK,
    FK_NOT_FOUND,
    NORM_FAILURE,
    STRICT_RULES,
    WRONG_TYPE,
    Rule,
    Table,
)
from wardhouse.operators.findings import HOLDING, check_all, wrong_type_findings
from wardhouse.operators.load import WRONG
from wardhouse.operators.normalise import unit_rule
from wardhouse.operators.quality import NO_BATCH, NO_EXEC, gate

# What is noted of a row beside its rules.
NOTES: dict[str, tuple[Rule, ...]] = {
    "CONSULTATION": (unit_rule("patient_temperature", "temperature_unit"),),
}
ALL_CODES = (*HOLDING, WRONG_TYPE, NORM_FAILURE, FK_NOT_FOUND, DUPLICATE_PK)


def work(
    staged: DataFrame, table: Table, batch_dt: date = NO_BATCH, exec_id: int = NO_EXEC
) -> DataFrame:
    return gate(staged, table.rules, table.staged_keys, table.latest_by, batch_dt, exec_id)


def checked(
    staged: DataFrame,
    table: Table,
    parents: dict[str, DataFrame],
    batch_dt: date = NO_BATCH,
    exec_id: int = NO_EXEC,
    strict: bool = False,
) -> DataFrame:
    """:func:`work`'s rows with all they break, and the versions it drops, from one read.

    ``staged`` may hold what did not fit its type; ``parents`` the accepted rows of
    the tables that it refers to. With ``strict`` the stricter rules hold, and every
    finding rejects its row.
    """
    return check_all(
        staged,
        STRICT_RULES.get(table.name, table.rules) if strict else table.rules,
        table.staged_keys,
        table.latest_by,
        table.references,
        parents,
        NOTES.get(table.name, ()),
        wrong_type_findings(table) if WRONG in staged.columns else None,
        ALL_CODES if strict else HOLDING,
        batch_dt,
        exec_id,
    )
