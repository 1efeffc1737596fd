"""Ingesting tabs, regenerating sheets, loading in windows: lazy chains of the operators."""

from __future__ import annotations

import datetime as dt
import warnings
from concurrent.futures import ThreadPoolExecutor
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.files import file_meta
from ..functions.keys import derived_key_of, full_row_key_of
from ..operators import casts, checks, control, fold, quarantine, registry
from ..operators.registry import Key, TabSpec
from ..sources import grids, sinks
from .loads import more_pending, rejected_rows, windowed_load  # noqa: F401

SCOPE = ["file_name", "sheet_tab_name"]


def ingest_tab(rows: DataFrame, spec: TabSpec, inserted: Column, variant: bool = False) -> tuple[DataFrame, DataFrame]:
    """(checked, curated) of the wide rows of one tab's table, with the columns file_name and sheet_tab_name."""
    present = registry.TabSpec(spec.table, spec.keys if spec.delta else (), spec.delta, spec.data_column)
    missing = [k.sheet for k in present.keys if k.sheet not in rows.columns]
    if missing:
        raise ValueError(f"Configured PK column(s) {missing} not found. Sheet columns: {sorted(rows.columns)}")
    named = checks.renamed(rows, present)
    checked = checks.validated(named, present, SCOPE)
    data = checks.data_columns(named, present, SCOPE)
    time = file_meta(F.col("file_name"))["file_dttm"]
    return checked, fold.curated(checks.good(checked), present, data, time, F.col("file_name"), F.col("sheet_tab_name"), inserted, variant)


def tab_faults(columns: list[str], spec: TabSpec, spark: SparkSession) -> str | None:
    """Why a table's tabs can't be ingested as they are, or None: keys that are missing, reserved columns, types that are none."""
    keys = spec.keys if spec.delta else ()
    if missing := [k.sheet for k in keys if k.sheet not in columns]:
        return f"Configured PK column(s) {', '.join(missing)} not found. Sheet columns: {sorted(columns)}"
    taken = {r.lower() for r in checks.RESERVED}
    if clashing := [c for c in columns if c.lower() in taken]:
        return f"Sheet column(s) {', '.join(clashing)} have the names of added columns. Sheet columns: {sorted(columns)}"
    if unknown := sorted({k.type for k in keys if k.type.lower() not in checks.UNTYPED and not casts.readable(spark, k.type)}):
        return f"Key type(s) {', '.join(unknown)} are unknown. Sheet columns: {sorted(columns)}"
    return None


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def ingest_chain(rows: DataFrame, spec: TabSpec, base: str, execution_id: str, inserted: Column, path: Column, frequency: str = "daily") -> DataFrame:
    """Ingests one table's tabs as a whole; one control row for each tab, in the shape of control.CONTROL.

    The rows are landed as they came and read back, so nothing upstream runs twice; checked once, into a table; from that
    good rows go to <base>/curated/<table> by date and file, rejected ones to <base>/errors/<table>/<execution>. Control
    rows are the last thing that is written, to <base>/control/<table>/<execution>: an execution that has them is done and
    isn't run again, one that hasn't replaces what it had written.

    A fault is no exception but the outcome of the tabs: a missing or unknown key, a reserved column, or whatever fails
    while the tabs are worked on gives Failed rows with the reason, so other tables of a run go on.
    """
    spark = rows.sparkSession
    done = f"{base}/control/{spec.table}/{execution_id}"
    if not committed(spark, done):
        fault = tab_faults([c for c in rows.columns if c not in SCOPE], spec, spark)
        try:
            told = _failed_tabs(rows, spec, execution_id, inserted, path, fault) if fault else _ingested(rows, spec, base, execution_id, inserted, path, frequency)
            told.write.mode("overwrite").parquet(done)
        except (PySparkException, Py4JJavaError) as e:
            reason = str(e.java_exception if isinstance(e, Py4JJavaError) else e).split("\n")[0]
            _failed_tabs(rows, spec, execution_id, inserted, path, reason).write.mode("overwrite").parquet(done)
    return spark.read.schema(control.CONTROL).parquet(done)


def _control_rows(told: DataFrame, made: dict[str, Column]) -> DataFrame:
    fields = [c.strip().split(" ", 1) for c in control.CONTROL.split(", ")]
    return told.select(*[made.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields])


def _tab_columns(spec: TabSpec, execution_id: str, inserted: Column, path: Column) -> dict[str, Column]:
    meta = file_meta(F.col("file_name"))
    process = quarantine.process_id(F.lit(execution_id), F.col("file_name"), F.col("sheet_tab_name"))
    return {"execution_id": F.lit(execution_id), "process_id": process, "batch_id": meta["batch_id"], "file_name": F.col("file_name"), "sheet_tab_name": F.col("sheet_tab_name"), "table_name": F.lit(spec.table), "source_file_path": path, "file_dttm": meta["file_dttm"], "_az_insert_ts": inserted}


def _failed_tabs(rows: DataFrame, spec: TabSpec, execution_id: str, inserted: Column, path: Column, reason: str) -> DataFrame:
    """Control rows of tabs that failed as a whole: their rows are counted, none is loaded."""
    counts = rows.groupBy(*SCOPE).agg(F.count("*").alias("n"))
    made = {"dq_check_validation": control.not_run(), "source_row_count": F.col("n"), "valid_record_count": F.lit(0), "error_record_count": F.lit(0), "final_ingestion_status": F.lit(control.FAILED), "comments": F.lit(f"Tab processing failed - {reason}")}
    return _control_rows(counts, _tab_columns(spec, execution_id, inserted, path) | made)


def _ingested(rows: DataFrame, spec: TabSpec, base: str, execution_id: str, inserted: Column, path: Column, frequency: str) -> DataFrame:
    spark = rows.sparkSession
    raw, final, errors, checked_at = f"{base}/{spec.table}/_raw_asis/{execution_id}", f"{base}/curated/{spec.table}", f"{base}/errors/{spec.table}/{execution_id}", f"{base}/_checked/{spec.table}/{execution_id}"
    present = TabSpec(spec.table, spec.keys if spec.delta else (), spec.delta, spec.data_column)
    rows.write.mode("overwrite").partitionBy(*SCOPE).parquet(raw)
    landed = spark.read.schema(rows.schema).parquet(raw).select(*[F.col(f"`{c}`") for c in rows.columns])
    checks.validated(checks.renamed(landed, present), present, SCOPE).write.mode("overwrite").parquet(checked_at)
    checked = spark.read.parquet(checked_at)
    time = file_meta(F.col("file_name"))["file_dttm"]
    data = checks.data_columns(checks.renamed(landed, present), present, SCOPE)
    good = fold.curated(checks.good(checked), present, data, time, F.col("file_name"), F.col("sheet_tab_name"), inserted)
    bad = quarantine.error_rows(checks.bad(checked), present, F.lit(execution_id), F.col("file_name"), F.col("sheet_tab_name"), path, inserted)
    with ThreadPoolExecutor(2) as pool:  # two tables from one, side by side
        written = [pool.submit(sinks.write_curated, good, final, inserted, frequency, {"file": F.col(fold.FILE_NAME)}), pool.submit(bad.write.mode("overwrite").parquet, errors)]
    for w in written:
        w.result()
    told = control.outcome(checks.dq_counts(checked, SCOPE), F.lit(spec.delta), F.lit(spec.table))
    made = {
        "raw_parquet_path": F.lit(raw), "final_parquet_source_raw": F.lit(final),
        "dq_check_validation": checks.dq_report(F.lit(spec.delta), F.lit(any(k.check_not_null for k in present.keys))), "source_row_count": F.col("total"), "valid_record_count": F.col("valid"),
        "error_record_count": F.col("bad"), "final_ingestion_status": F.col("final_ingestion_status"), "comments": F.col("comments"),
    }
    return _control_rows(told, _tab_columns(spec, execution_id, inserted, path) | made)


def ingest_batch(promoted: DataFrame, known: DataFrame) -> DataFrame:
    """The checked rows of all configured tabs of all files, in one plan.

    promoted: file_name, sheet_tab_name, row_idx, header, values. Out: those, table_name, delta, data_column, missing
    (configured key columns that the tab lacks, sorted), reserved (its columns with the name of an added one), untyped
    (key types that aren't types), PK_DERIVED, keys, key_values (texts by name), DATA, DATA_KEYS and COMMENTS; a tab with
    one of these faults has neither checks nor data and fails as a whole, the others are not touched by that. Types are
    whatever the registry names: each different one is a cast of its own.
    """
    kinds, none = casts.named_types(known)
    prefixed = promoted.withColumn("file_name_prefix", file_meta(F.col("file_name"))["file_name_prefix"])
    rows = registry.with_specs(prefixed, known)
    record = F.map_from_arrays("header", "values")
    kind = lambda k: F.lower(F.trim(k["type"]))
    untyped = F.array_sort(F.array_distinct(F.filter(F.transform("keys", kind), lambda t: t.isin(none) if none else F.lit(False))))
    rows = rows.withColumns({"_record": record, "missing": F.array_sort(F.array_except(F.transform("keys", lambda k: k["sheet"]), "header")), "reserved": F.array_sort(F.filter("header", checks.is_reserved)), "untyped": untyped})
    value = lambda k: F.try_element_at(F.col("_record"), k["sheet"])
    key_values = F.transform("keys", value)
    derived = F.when(F.col("delta"), derived_key_of(key_values)).otherwise(full_row_key_of(F.col("values"), F.col("file_name"), F.col("sheet_tab_name")))
    names = F.filter("header", lambda h: ~F.exists("keys", lambda k: k["sheet"] == h))
    data = F.map_from_arrays(names, F.transform(names, lambda n: F.try_element_at(F.col("_record"), n)))
    rows = rows.withColumns(
        {
            "PK_DERIVED": derived,
            "_null": F.exists("keys", lambda k: k["check_not_null"] & checks.blank(value(k))),
            "_type": F.exists("keys", lambda k: casts.unreadable_as(value(k), kind(k), kinds)),
            "key_values": F.map_from_arrays(F.transform("keys", lambda k: k["name"]), key_values),
            "DATA": F.to_json(data, {"ignoreNullFields": "false"}),
            "DATA_KEYS": F.to_json(names),
        }
    )
    flagged = checks.with_duplicate_flag(rows, ["PK_DERIVED", *SCOPE])
    reasons = [F.when(F.col("delta") & F.col(f), F.lit(r)).otherwise("") for f, r in (("_null", checks.NULL_REASON), ("_type", checks.TYPE_REASON), ("_dup", checks.DUPLICATE_REASON))]
    return flagged.withColumn("COMMENTS", F.concat(*reasons)).drop("_record")


def lost() -> Column:
    """Whether a tab fails as a whole."""
    return (F.size("missing") > 0) | (F.size("reserved") > 0) | (F.size("untyped") > 0)


def batch_errors(checked: DataFrame, execution_id: str, path: Column, inserted: Column) -> DataFrame:
    """Rows of the error table for the rejected rows of all tables of a batch."""
    bad = checks.bad(checked).where(~lost())
    final = F.transform("header", lambda h: F.coalesce(F.get(F.filter("keys", lambda k: k["sheet"] == h), F.lit(0))["name"], h))
    added = F.create_map(F.lit("PK_DERIVED"), F.col("PK_DERIVED"), F.lit("COMMENTS"), F.col("COMMENTS"))
    scope = F.create_map(*[x for c in SCOPE for x in (F.lit(c), F.col(c))])
    record = F.map_filter(F.map_concat(scope, F.map_from_arrays(final, F.col("values")), added), lambda _, v: v.isNotNull())
    told = F.transform(F.map_entries(F.map_filter("key_values", lambda _, v: v.isNotNull())), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return quarantine.described(bad, F.col("table_name"), F.concat_ws(" | ", told), F.to_json(record), F.lit(execution_id), F.col("file_name"), F.col("sheet_tab_name"), path, inserted)


def curated_tables(checked: DataFrame, known: DataFrame, base: str, inserted: Column, frequency: str = "daily") -> list[str]:
    """Writes the good rows of all tables to <base>/curated/table_name=<table>/<date>/<file>/<tab>, keys by their types.

    Tables differ in their columns, so there is a write for each different list of names, types and data column, of all
    the tables that have it at once; the rows of each go to their partitions, of which only those are replaced. Returns
    the layouts.
    """
    good = checks.good(checked).where(~lost())
    layout = F.concat_ws(",", F.col("data_column"), F.transform("keys", lambda k: F.concat(k["name"], F.lit(":"), F.lower(F.trim(k["type"])))))
    kinds, none = casts.named_types(known)
    found = {}
    for row in registry.specs(known).select(layout.alias("layout"), "table_name", "data_column", "keys").collect():
        found.setdefault(row["layout"], (row, set()))[1].add(row["table_name"])
    time = file_meta(F.col("file_name"))["file_dttm"]
    for name, (row, tables) in sorted(found.items()):
        if any(k["type"].strip() in none for k in row["keys"]):
            continue
        key = lambda k: F.try_element_at(F.col("key_values"), F.lit(k["name"])).try_cast(k["type"]).alias(k["name"])
        lineage = [time.alias(fold.FILE_TIME), F.col("file_name").alias(fold.FILE_NAME), F.col("sheet_tab_name").alias(fold.TAB_NAME), inserted.alias(fold.INSERT_TIME)]
        own = good.where(F.col("table_name").isin(*tables) & (layout == name))
        rows = own.select("PK_DERIVED", *[key(k) for k in row["keys"]], F.col("DATA").alias(row["data_column"]), fold.KEYS_COLUMN, *lineage, "table_name")
        sinks.write_curated(rows.hint("rebalance", "table_name", fold.FILE_NAME, fold.TAB_NAME), f"{base}/curated", inserted, frequency, {"file": F.col(fold.FILE_NAME), "tab": F.col(fold.TAB_NAME)}, ["table_name"])
    return sorted(found)


def read_curated(spark: SparkSession, base: str, table: str, known: DataFrame | None = None) -> DataFrame:
    """A table that curated_tables wrote, its tabs' columns together, without the partition columns.

    known: the registry, whose columns of that table are there in any case: as nulls where no good row of a tab that has
    them was ever written, and without rows where none of the table was. Without it such a table can't be read.
    """
    own = {} if known is None else registry_columns(known, table)
    return read_written(spark, f"{base}/curated/table_name={table}", own).drop(*sinks.NAMES.values(), "file", "tab")


def curated_columns(keys: list[tuple[str, str]], data_columns: list[str]) -> dict[str, str]:
    """The columns of a curated table by name, with their types; keys are names and types."""
    lineage = {fold.FILE_TIME: "timestamp_ntz", fold.FILE_NAME: "string", fold.TAB_NAME: "string", fold.INSERT_TIME: "timestamp_ntz"}
    return {"PK_DERIVED": "string"} | dict(keys) | dict.fromkeys(data_columns, "string") | {fold.KEYS_COLUMN: "string"} | lineage


def registry_columns(known: DataFrame, table: str) -> dict[str, str]:
    """The columns of a curated table of a batch, of all tabs that feed it and whose key types are types."""
    tabs = registry.specs(known).where(F.col("table_name") == table.lower()).select("file_name_prefix", "sheet_tab_name", "data_column", "keys").collect()
    _, none = casts.named_types(known)
    fit = [t for t in sorted(tabs) if not any(k["type"].strip() in none for k in t["keys"])]
    return curated_columns([(k["name"], k["type"].strip()) for t in fit for k in t["keys"]], [t["data_column"] for t in fit]) if fit else {}


def read_written(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The table at a path, and of the given columns those that it lacks as nulls; no rows where nothing was written yet.

    A write by partitions of no rows leaves no partition, so neither files nor a schema.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [s for s in system.listStatus(at) if not s.getPath().getName().startswith(("_", "."))] if system.exists(at) else []
    typed = lambda c: F.lit(None).cast(columns[c]).alias(c)
    if columns and not parts:
        return spark.range(0).select(*map(typed, columns))
    rows = spark.read.option("mergeSchema", True).parquet(path)
    there = {c.lower() for c in rows.columns}
    return rows.select("*", *[typed(c) for c in columns if c.lower() not in there])


def ingest_tables(promoted: DataFrame, empty: DataFrame, broken: DataFrame, known: DataFrame, base: str, execution_id: str, inserted: Column, path: Column, frequency: str = "daily") -> DataFrame:
    """Ingests all tabs of all files into their tables; control rows in the shape of control.CONTROL.

    promoted as for ingest_batch, empty and broken as for batch_control. Rows are landed by table under <base>/raw, checked
    once, and parted into <base>/curated (see curated_tables) and <base>/errors. A tab that fails as a whole has its
    Failed row, whatever is the matter with it, and no data. Control rows come last, to <base>/control/<execution>: an
    execution that has them is done and isn't run again, one that hasn't replaces what it had written.
    """
    spark = promoted.sparkSession
    at = {n: f"{base}/{n}/{execution_id}" for n in ("raw", "_checked", "errors", "control")}
    if not committed(spark, at["control"]):
        prefixed = promoted.withColumn("file_name_prefix", file_meta(F.col("file_name"))["file_name_prefix"])
        named = registry.with_specs(prefixed, known).select(*promoted.columns, "table_name")
        named.write.mode("overwrite").partitionBy("table_name").parquet(at["raw"])
        landed = spark.read.schema(named.schema).parquet(at["raw"]).select(*promoted.columns)
        judged = ingest_batch(landed, known)
        judged.write.mode("overwrite").partitionBy("table_name").parquet(at["_checked"])
        checked = spark.read.schema(judged.schema).parquet(at["_checked"])
        batch_errors(checked, execution_id, path, inserted).write.mode("overwrite").partitionBy("table_name").parquet(at["errors"])
        curated_tables(checked, known, base, inserted, frequency)
        told = batch_control(checked, empty, broken, execution_id, inserted)
        made = {"source_file_path": path, "raw_parquet_path": F.when(F.col("source_row_count") > 0, F.concat(F.lit(at["raw"] + "/table_name="), F.col("table_name"))), "final_parquet_source_raw": F.when(F.col("valid_record_count") > 0, F.concat(F.lit(f"{base}/curated/table_name="), F.col("table_name")))}
        _control_rows(told, {c: F.col(c) for c in told.columns} | made).write.mode("overwrite").parquet(at["control"])
    return spark.read.schema(control.CONTROL).parquet(at["control"])


def batch_control(checked: DataFrame, empty: DataFrame, broken: DataFrame, execution_id: str, inserted: Column | None = None) -> DataFrame:
    """One control row for each tab: checked ones, empty configured ones (file_name, sheet_tab_name, table_name), and
    files that can't be read (file_name, error). inserted: the time of the run (now)."""
    flags = {f: F.col(f) & F.col("delta") for f in ("_dup", "_null", "_type")}
    whole = checked.withColumns(flags | {"checks_null": F.exists("keys", lambda k: k["check_not_null"])})
    counts = checks.dq_counts(whole, [*SCOPE, "table_name", "delta", "missing", "reserved", "untyped", "checks_null"])
    told = control.outcome(counts, F.col("delta"), F.col("table_name"))
    failed_as_whole = lost()
    unknown = F.concat(F.lit("Tab processing failed - Key type(s) "), F.concat_ws(", ", "untyped"), F.lit(" are unknown"))
    taken = F.concat(F.lit("Tab processing failed - Sheet column(s) "), F.concat_ws(", ", "reserved"), F.lit(" have the names of added columns"))
    reason = F.when((F.size("missing") == 0) & (F.size("reserved") == 0), unknown).when(F.size("missing") == 0, taken).otherwise(F.concat(F.lit("Tab processing failed - Configured PK column(s) "), F.concat_ws(", ", "missing"), F.lit(" not found")))
    report = F.when(failed_as_whole, control.not_run()).otherwise(checks.dq_report(F.col("delta"), F.col("checks_null")))
    common = lambda table, report, total, valid, bad, status, comments: [F.lit(execution_id).alias("execution_id"), *SCOPE, table.alias("table_name"), report.alias("dq_check_validation"), total.cast("long").alias("source_row_count"), valid.cast("long").alias("valid_record_count"), bad.cast("long").alias("error_record_count"), status.alias("final_ingestion_status"), comments.alias("comments")]
    none = F.lit(0)
    done = told.select(*common(F.col("table_name"), report, F.col("total"), F.when(failed_as_whole, 0).otherwise(F.col("valid")), F.when(failed_as_whole, 0).otherwise(F.col("bad")), F.when(failed_as_whole, control.FAILED).otherwise(F.col("final_ingestion_status")), F.when(failed_as_whole, reason).otherwise(F.col("comments"))))
    void = empty.select(*common(F.col("table_name"), control.not_run(" | no data"), none, none, none, F.lit(control.SUCCEEDED), F.lit(control.NO_DATA)))
    failed = broken.withColumn("sheet_tab_name", F.lit(None).cast("string")).select(*common(F.lit(None).cast("string"), control.not_run(), none, none, none, F.lit(control.FAILED), F.col("error")))
    rows = done.unionByName(void).unionByName(failed)
    meta = file_meta(F.col("file_name"))
    process = F.md5(F.concat_ws("|", "execution_id", "file_name", "sheet_tab_name"))
    return rows.select("execution_id", process.alias("process_id"), meta["batch_id"].alias("batch_id"), "*").withColumns({"file_dttm": file_meta(F.col("file_name"))["file_dttm"], "_az_insert_ts": F.localtimestamp() if inserted is None else inserted})


def regenerated(table: DataFrame, spec: TabSpec, expected: int | None = None) -> DataFrame:
    """The newest batch of a curated table as a flat sheet; just its columns if the run expected no rows."""
    whole = fold.checked_contract(table, spec)
    keys = fold.discovered_keys(whole)
    sheet = fold.unfolded(fold.latest_batch(whole), spec, keys)
    return sheet.limit(0) if expected == 0 else sheet


def regenerate_table(known: DataFrame, control_rows: DataFrame, curated: DataFrame, table: str, base: str, time: dt.datetime, most: int | None = 500_000) -> str:
    """Writes the sheet of a table's newest batch as CSV with a header; where it is.

    The registry tells the spec by the table's name, the newest control row how many rows are expected: none gives the
    header alone, another number than there are warns. More than `most` rows (None: no limit) are an error. The file's
    name has no dotted date, so on ingesting it again prefix and file time are given (see dated_name), not read from it.
    """
    found = registry.table_spec(known, table)
    if found is None:
        raise ValueError(f"no tab of the registry feeds {table}")
    spec, prefix, _ = found
    newest = control.latest(control_rows.where(F.lower("table_name") == spec.table)).select(F.coalesce("valid_record_count", "source_row_count", F.lit(0)).alias("n")).first()
    expected = None if newest is None else newest["n"]
    sheet = regenerated(curated, spec, expected)
    counted_batch(fold.latest_batch(curated), expected, most)
    path = sinks.export_path(base, spec.table, prefix, time)
    sinks.write_headered(sinks.sheet_texts(sheet), path)
    return path


def counted_batch(batch: DataFrame, expected: int | None, most: int | None = 500_000) -> int:
    """The rows of a batch; warns if its run expected another number, raises if they are more than a sheet may have."""
    n = batch.count()
    if expected is not None and n != expected:
        warnings.warn(f"the newest batch has {n} rows, its run expected {expected}", stacklevel=2)
    if most is not None and n > most:
        raise ValueError(f"more than {most} rows: {n} are too many for one sheet")
    return n


def regenerate_workbook(curated: DataFrame, spec: TabSpec, file_name: str, tab: str, banner: str | None = None, most: int = 500_000) -> DataFrame:
    """The sheet of a table's newest batch as workbooks (file_name, first_row, content), rows in the order of their keys."""
    sheet = regenerated(curated, spec)
    order = [k.name for k in spec.keys] if spec.delta and spec.keys else sheet.columns
    return grids.encode_grids(sinks.export_grid(sheet, file_name, tab, order, banner, most))


def ingest_workbook(files: DataFrame, spec: TabSpec, prefix: str, time: dt.datetime, inserted: Column, banner: bool = True) -> tuple[DataFrame, DataFrame]:
    """(checked, curated) of regenerated workbooks (as regenerate_workbook gives them) of one table.

    A regenerated sheet's name tells neither prefix nor time, so both are given; its key columns have their final names.
    """
    top = grids.HEADER_ROW if banner else 0
    grid = grids.text_grid(grids.decode_grids(files))
    promoted = grids.promoted(grid, top, top + 1)
    head = promoted.select("header").first()
    columns = head["header"] if head else [k.name for k in spec.keys]
    rows = grids.wide(promoted, columns).withColumn("file_name", F.lit(sinks.dated_name(prefix, time)))
    own = TabSpec(spec.table, tuple(Key(k.name, k.name, k.type, k.check_not_null) for k in spec.keys), spec.delta, spec.data_column)
    return ingest_tab(rows, own, inserted)
