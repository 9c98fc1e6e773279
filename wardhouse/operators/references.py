"""Foreign keys: marking rows whose parent is unknown, and surrogate lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse.contracts import FK_NOT_FOUND, Reference
from wardhouse.operators.dedup import any_null
from wardhouse.operators.joins import hot_keys_of, join_dimension
from wardhouse.operators.quality import OK, REJ, accepted, rejected


def check_references(
    rows: DataFrame, references: Sequence[Reference], parents: dict[str, DataFrame]
) -> DataFrame:
    """Reject accepted rows that name a parent which is not there.

    ``parents`` holds the gated tables; only their accepted rows count, and only
    those meeting the reference's filter. The parent columns are the parent's
    key. A NULL foreign key names no parent.
    Rows rejected before keep their code and stay out of the joins, where the
    NULL keys among them would share one task.
    """
    columns = rows.columns
    checked = accepted(rows)
    lost = F.lit(None).cast("string")
    # One pass over the rows finds the hot keys of all references.
    hot = hot_keys_of(checked, [ref.columns for ref in references]) if references else []
    for n, ref in enumerate(references):
        parent = accepted(parents[ref.parent])
        if ref.parent_filter:
            parent = parent.filter(ref.parent_filter)
        held = (
            parent.select(*[F.col(p).alias(c) for c, p in zip(ref.columns, ref.parent_columns)])
            .withColumn(f"_held{n}", F.lit(True))
        )
        checked = join_dimension(checked, held, ref.columns, "left", hot=hot[n])
    for n, ref in reversed(list(enumerate(references))):
        missing = F.col(f"_held{n}").isNull() & ~any_null(ref.columns)
        lost = F.when(missing, F.lit(", ".join(ref.columns))).otherwise(lost)
    checked = checked.withColumn("_lost", lost)
    found = F.col("_lost").isNull()
    changed = {
        "wrk_stts_cd": F.when(found, OK).otherwise(REJ),
        "rej_cod": F.when(~found, FK_NOT_FOUND),
        "rej_dsc": F.concat(F.lit("no parent for "), F.col("_lost")),
    }
    checked = checked.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in columns]
    )
    return checked.unionByName(rejected(rows))


def look_up(
    rows: DataFrame,
    columns: Sequence[str],
    table: DataFrame,
    table_columns: Sequence[str],
    surrogate: str,
    name: str,
    hot_in: DataFrame | None = None,
) -> DataFrame:
    """Add the surrogate key a business key stands for; NULL where it is unknown.

    The business key is unique in the table.
    """
    keys = table.select(
        *[F.col(t).alias(c) for c, t in zip(columns, table_columns)],
        F.col(surrogate).alias(name),
    )
    return join_dimension(rows, keys, columns, "left", hot_in=hot_in)
