"""Rejected rows, each with its reasons and itself as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import TabSpec

# Columns of the error table and the texts of its sentence.
ERROR_COLUMNS = ["process_id", "execution_id", "file_name", "table_name", "sheet_tab_name", "file_path", "error_category", "error_description", "pk_value", "pk_derived", "err_record", "comments", "az_insert_ts"]
ERRORS = ", ".join(f"{c} {'timestamp_ntz' if c == 'az_insert_ts' else 'string'}" for c in ERROR_COLUMNS)
BEFORE = "Record rejected during primary-key validation. Reason(s): "
KEY, DERIVED = ". Primary key -> ", ". Derived key = "
AFTER = ". This record was NOT ingested into the curated dataset."


def process_id(execution_id: Column, file_name: Column, tab: Column) -> Column:
    """One id for each run, file and tab."""
    return F.md5(F.concat_ws("|", execution_id, file_name, tab))


def error_rows(bad: DataFrame, spec: TabSpec, execution_id: Column, file_name: Column, tab: Column, path: Column, inserted: Column) -> DataFrame:
    """A row of the error table for each rejected row. The record is taken before any column is added; its nulls go."""
    own = [c for c in bad.columns if c not in ("_null", "_type", "_dup")]
    key = F.concat_ws(" | ", *[F.concat(F.lit(f"{k.name}="), F.col(f"`{k.name}`")) for k in spec.keys]) if spec.keys else F.lit("(no PK configured)")
    return described(bad, F.lit(spec.table), key, F.to_json(F.struct(*[F.col(f"`{c}`") for c in own])), execution_id, file_name, tab, path, inserted)


def described(bad: DataFrame, table: Column, key: Column, record: Column, execution_id: Column, file_name: Column, tab: Column, path: Column, inserted: Column) -> DataFrame:
    """Rows of the error table from rejected rows with COMMENTS and PK_DERIVED, the text of their key and their record."""
    category = F.regexp_replace("COMMENTS", r"\s*\|\|\s*$", "")
    made = {
        "process_id": process_id(execution_id, file_name, tab), "execution_id": execution_id, "file_name": file_name,
        "table_name": table, "sheet_tab_name": tab, "file_path": path, "error_category": category,
        "error_description": F.concat(F.lit(BEFORE), category, F.lit(KEY), key, F.lit(DERIVED), F.col("PK_DERIVED"), F.lit(AFTER)),
        "pk_value": key, "pk_derived": F.col("PK_DERIVED"), "err_record": record,
        "comments": F.col("COMMENTS"), "az_insert_ts": inserted,
    }
    return bad.select(*[made[c].alias(c) for c in ERROR_COLUMNS])


def errors_for_run(errors: DataFrame, execution_id: str) -> DataFrame:
    return errors.where(F.col("execution_id") == execution_id)
