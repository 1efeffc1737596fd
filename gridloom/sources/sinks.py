"""Writing tables and sheets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Partition columns by frequency, as date patterns.
LAYOUT = {"monthly": ["yyyy", "MM"], "daily": ["yyyy", "MM", "dd"], "hourly": ["yyyy", "MM", "dd", "HH"], "minutes": ["yyyy", "MM", "dd", "HH", "mm"]}
NAMES = {"yyyy": "year", "MM": "month", "dd": "day", "HH": "hour", "mm": "minute"}
ZONES = {"curated": "curated/{table}", "raw": "{table}/_raw_asis"}
BANNER_TIME = "%m/%d/%Y %I:%M %p"


def dated_columns(time: Column, frequency: str) -> dict[str, Column]:
    """The partition columns of a time; an unknown frequency is daily, `minutely` is `minutes`."""
    known = LAYOUT.get(frequency.lower().replace("minutely", "minutes"), LAYOUT["daily"])
    return {NAMES[p]: F.date_format(time, p) for p in known}


def dated_path(base: str, table: str, kind: str, time: Column, frequency: str) -> Column:
    """<base>/<zone and table>/<dated> as text."""
    zone = ZONES[kind].format(table=table)
    return F.concat_ws("/", F.lit(base.rstrip("/")), F.lit(zone), *dated_columns(time, frequency).values())


def land_raw(rows: DataFrame, path: str) -> None:
    """The rows as they came, by file and tab."""
    rows.write.mode("append").partitionBy("file_name", "sheet_tab_name").parquet(path)


def write_curated(rows: DataFrame, path: str, time: Column, frequency: str = "daily", within: dict[str, Column] | None = None, above: list[str] | None = None) -> None:
    """Curated rows by date, perhaps within other columns of theirs (above) and further parted (within, by name).

    Writing a partition again replaces it and no other.
    """
    dated = dated_columns(time, frequency) | (within or {})
    rows.withColumns(dated).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*(above or []), *dated).parquet(path)


def renamed_files(spark: SparkSession, folder: str, suffix: str, to: str) -> int:
    """Gives the files of one folder another suffix; how many there were."""
    jvm = spark._jvm
    system = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [s.getPath() for s in system.listStatus(jvm.org.apache.hadoop.fs.Path(folder)) if s.isFile() and s.getPath().getName().endswith(suffix)]
    return sum(system.rename(p, jvm.org.apache.hadoop.fs.Path(p.getParent(), p.getName()[: -len(suffix)] + to)) for p in paths)


def create_table(spark: SparkSession, table: str, schema: str) -> None:
    """An append table, if it isn't there yet."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet")


def append_aligned(rows: DataFrame, table: str) -> None:
    """Appends to a table by the names of its columns: in their order and types, those that the rows lack as null."""
    fields, names = rows.sparkSession.table(table).schema.fields, {c.lower() for c in rows.columns}
    column = lambda f: F.col(f"`{f.name}`") if f.name.lower() in names else F.lit(None)
    rows.select(*[column(f).cast(f.dataType).alias(f.name) for f in fields]).write.insertInto(table)


def create_run_table(spark: SparkSession, table: str, schema: str, by: str = "execution_id") -> None:
    """A table whose rows are replaced by run (see replace_run), if it isn't there yet."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet PARTITIONED BY ({by})")


def replace_run(rows: DataFrame, table: str, run: str, by: str = "execution_id") -> None:
    """Makes the rows those of a run in a table of create_run_table; appended twice, a run is there once.

    Rows are aligned by name as in append_aligned. The run's partition is overwritten as a whole, also by no rows; other
    runs aren't touched, and a reader sees the old partition or the new one.
    """
    spark = rows.sparkSession
    fields, names = spark.table(table).schema.fields, {c.lower() for c in rows.columns}
    column = lambda f: F.col(f"`{f.name}`") if f.name.lower() in names else F.lit(None)
    aligned = rows.select(*[column(f).cast(f.dataType).alias(f.name) for f in fields if f.name != by])
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({by} = {{run}}) SELECT * FROM {{rows}}", run=run, rows=aligned)


def capped(df: DataFrame, most: int = 500_000) -> DataFrame:
    """df itself, if it has no more rows than a sheet may have."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows: too many for one sheet")
    return df


def sheet_texts(df: DataFrame) -> DataFrame:
    """All columns as texts, times as `yyyy-MM-dd HH:mm:ss`."""
    text = lambda f: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.dataType.typeName().startswith("timestamp") else F.col(f"`{f.name}`").cast("string")
    return df.select(*[text(f).alias(f.name) for f in df.schema.fields])


def export_grid(df: DataFrame, file_name: str, tab: str, order: list[str], banner: str | None = None, most: int = 500_000) -> DataFrame:
    """A table as a grid: perhaps a banner, a header, and its rows in order; nulls are empty cells.

    Rows are numbered through one window, so more than fit a sheet are an error (see capped); larger tables are written
    as CSV with a header by write_headered.
    """
    df = capped(df, most)
    numbered = df.withColumn("_at", F.row_number().over(Window.orderBy(*[F.col(f"`{c}`") for c in order])))
    texts = sheet_texts(numbered)
    spark, first = df.sparkSession, 0
    top = []
    if banner is not None:
        top.append((0, [banner]))
        first = 1
    top.append((first, list(df.columns)))
    head = spark.createDataFrame(top, "row_idx bigint, cells array<string>")
    rows = texts.select((F.col("_at").cast("long") + first).alias("row_idx"), F.array(*[F.col(f"`{c}`") for c in df.columns]).alias("cells"))
    return head.union(rows).select(F.lit(file_name).alias("file_name"), F.lit(tab).alias("sheet_tab_name"), "row_idx", "cells")


def banner_text(title: str, time: dt.datetime) -> str:
    """The banner of a sheet: what it is, and when it was made."""
    return f"{title} {time.strftime(BANNER_TIME)}"


def export_path(base: str, table: str, prefix: str, time: dt.datetime) -> str:
    """<base>/<table>/<year>/<month>/<day>/<hour>/<prefix>_REGEN_<time>"""
    return f"{base.rstrip('/')}/{table}/{time:%Y/%m/%d/%H}/{prefix}_REGEN_{time:%Y%m%d_%H%M%S}"


def dated_name(prefix: str, time: dt.datetime) -> str:
    """The name of a feed's file of that time, which tells both again (see functions.files)."""
    return f"{prefix}.{time:%Y.%m.%d.%H.%M.%S}.xlsx"


def write_headered(df: DataFrame, path: str) -> None:
    """CSV with a header, written by all tasks; writing the same path again replaces it."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
