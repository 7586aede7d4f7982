"""The findings relation: one row per deviation, with its kind, severity and message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind -> (type, label). The first eight kinds and table_error are what a schema check reports.
KINDS: dict[str, tuple[str, str]] = {
    "missing_table": ("MISSING", "WARNING"),
    "missing_column": ("MISSING", "WARNING"),
    "type_mismatch": ("MISMATCH", "WARNING"),
    "nullability_mismatch": ("MISMATCH", "WARNING"),
    "unsynced_rows": ("MISMATCH", "WARNING"),
    "missing_dependency_schema": ("MISSING_DEPENDENCY", "DEPENDENCY"),
    "missing_dependency_table": ("MISSING_DEPENDENCY", "DEPENDENCY"),
    "missing_dependency_column": ("MISSING_DEPENDENCY", "DEPENDENCY"),
    "table_error": ("ERROR", "ERROR"),
    "load_error": ("ERROR", "ERROR"),
    "duplicate_key": ("MISMATCH", "WARNING"),
    "null_key": ("MISMATCH", "WARNING"),
    "orphan_rows": ("MISMATCH", "WARNING"),
    "changed_rows": ("MISMATCH", "WARNING"),
    "extra_rows": ("MISMATCH", "WARNING"),
    "name_collision": ("MISMATCH", "WARNING"),
    "cast_loss": ("MISMATCH", "WARNING"),
}

# The columns of one finding.
FINDING = "table string, column string, kind string, n bigint, message string"

# Message texts, filled in by position.
MESSAGES: dict[str, str] = {
    "missing_table": "MISSING TABLE: table %s is missing in %s schema",
    "missing_column": "MISSING COLUMN: table %s: missing column %s",
    "type_mismatch": "MISMATCH TABLE %s: column %s of type %s mismatches with column %s of type %s",
    "nullability_mismatch": "MISMATCH TABLE %s: column %s nullable mismatch",
    "unsynced_rows": "MISMATCH TABLE %s: %d unsynced rows",
    "missing_dependency_schema": "MISSING DEPENDENCY SCHEMA: table %s depends on schema %s which is missing",
    "missing_dependency_table": "MISSING DEPENDENCY TABLE: table %s depends on table %s in schema %s which is missing",
    "missing_dependency_column": (
        "MISSING DEPENDENCY COLUMN: table %s depends on column %s in table %s in schema %s which is missing"
    ),
    "table_error": "TABLE ERROR %s: error comparing rows: %s",
    "load_error": "Error loading table %s: %s",
    "duplicate_key": "MISMATCH TABLE %s: %d duplicated keys in %s",
    "null_key": "MISMATCH TABLE %s: %d rows with a NULL in the key in %s",
    "orphan_rows": "MISMATCH TABLE %s: %d rows whose reference %s has no parent",
    "changed_rows": "MISMATCH TABLE %s: %d changed rows",
    "extra_rows": "MISMATCH TABLE %s: %d rows only in the given table",
    "name_collision": "MISMATCH TABLE %s: names %s differ only in case",
    "cast_loss": "MISMATCH TABLE %s: column %s loses %d values when cast to %s",
}


def message(kind: str, *parts: Column) -> Column:
    return F.format_string(MESSAGES[kind], *parts)


def finding(kind: str, table: Column, column: Column | None, n: Column | None, *parts: Column) -> list[Column]:
    """Select list of one kind of finding. ``n`` counts the rows, keys or values concerned; NULL where not counted."""
    return [
        table.cast("string").alias("table"),
        (F.lit(None) if column is None else column).cast("string").alias("column"),
        F.lit(kind).alias("kind"),
        (F.lit(None) if n is None else n).cast("bigint").alias("n"),
        message(kind, *parts).alias("message"),
    ]


def labelled(findings: DataFrame, run_id: str) -> DataFrame:
    """Add the run and the type and label that belong to each kind."""

    def of(position: int) -> Column:
        cases = " ".join(f"WHEN '{kind}' THEN '{meaning[position]}'" for kind, meaning in KINDS.items())
        return F.expr(f"CASE kind {cases} END")

    return findings.select(
        F.lit(run_id).alias("run_id"),
        "table",
        "column",
        "kind",
        of(0).alias("type"),
        of(1).alias("label"),
        "n",
        "message",
    )
