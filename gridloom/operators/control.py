"""Control rows: what became of every tab of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# States and comments.
SUCCEEDED, FAILED = "Succeeded", "Failed"
NO_DATA = "No data received for this tab (report returned no results). Parquet generation skipped."
ALL_PASSED = "All primary-key checks passed."
FULL_LOAD = "PK validation skipped (load_type_delta=false) - full load ingested."
CONTROL = (
    "execution_id string, process_id string, batch_id string, file_name string, sheet_tab_name string, table_name string, "
    "source_file_path string, raw_parquet_path string, final_parquet_source_raw string, dq_check_validation array<string>, "
    "source_row_count bigint, valid_record_count bigint, error_record_count bigint, final_ingestion_status string, "
    "comments string, file_dttm timestamp_ntz, _az_insert_ts timestamp_ntz"
)
CHECKS = ["Duplicate PK Check", "Not Null PK Check", "Data Type Check"]


def not_run(reason: str = "") -> Column:
    return F.array(*[F.lit(f"{c} : NOT RUN{reason}") for c in CHECKS])


def outcome(counts: DataFrame, delta: Column, target: Column) -> DataFrame:
    """counts (of dq_counts) with final_ingestion_status and comments."""
    failed = F.concat(F.col("bad").cast("string"), F.lit(" record(s) failed PK validation. Good records ("), F.col("valid").cast("string"), F.lit(") written to "), target, F.lit("."))
    comments = F.when(F.col("bad") > 0, failed).when(delta, ALL_PASSED).otherwise(FULL_LOAD)
    return counts.withColumns({"final_ingestion_status": F.when(F.col("bad") > 0, FAILED).otherwise(SUCCEEDED), "comments": comments})


def latest(control: DataFrame) -> DataFrame:
    """The newest row of each table; of rows of the same time the one with the greatest process id.

    A grouped maximum: partial results are merged, so a table with most of the rows doesn't burden one task.
    """
    newest = control.groupBy(F.col("table_name").alias("_t")).agg(F.max_by(F.struct(*control.columns), F.struct("_az_insert_ts", "process_id")).alias("r"))
    return newest.select("r.*")


def reconciled(control: DataFrame, batches: DataFrame) -> DataFrame:
    """The newest control row of each table against the rows of its newest batch (table_name, actual)."""
    expected = F.coalesce("valid_record_count", "source_row_count", F.lit(0))
    joined = latest(control).select("table_name", expected.alias("expected")).join(batches, "table_name", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return joined.withColumn("matches", F.col("expected") == F.col("actual"))


def run_summary(control: DataFrame) -> DataFrame:
    ok = F.col("final_ingestion_status") == SUCCEEDED
    return control.groupBy("execution_id").agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"))


def short_reason(comments: Column) -> Column:
    """A comment up to its first ` -> ` or `. Sheet columns`."""
    return F.trim(F.substring_index(F.substring_index(comments, " -> ", 1), ". Sheet columns", 1))


def failure_summary(control: DataFrame, tables: int = 4, details: int = 15) -> DataFrame:
    """For each run its failed tables (the first few by name) and the first details; a report, so it is short."""
    failed = control.where(F.col("final_ingestion_status") != SUCCEEDED)
    of = F.coalesce("table_name", "sheet_tab_name", F.lit("-"))
    detail = F.concat(F.col("file_name"), F.lit(" -> "), of, F.lit(" : "), short_reason(F.coalesce("comments", F.lit(""))))
    place = F.row_number().over(Window.partitionBy("execution_id").orderBy("file_name", "sheet_tab_name"))
    top = failed.withColumns({"_d": detail, "_at": place}).where(F.col("_at") <= details)
    told = top.groupBy("execution_id").agg(F.concat_ws(" ;; ", F.transform(F.sort_array(F.collect_list(F.struct("_at", "_d"))), lambda r: r["_d"])).alias("details"))
    names = failed.groupBy("execution_id").agg(F.count("*").alias("n_failed"), F.sort_array(F.collect_set(F.coalesce("table_name", F.lit("-")))).alias("_t"))
    listed = F.concat(F.concat_ws(", ", F.slice("_t", 1, tables)), F.when(F.size("_t") > tables, " …").otherwise(""))
    return names.select("execution_id", "n_failed", listed.alias("tables")).join(told, "execution_id")
