"""The registry: one row for each key column of each (file name prefix, tab)."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY = (
    "serial_number bigint, batch_id string, file_name_prefix string, sheet_tab_name string, table_name string, "
    "sheet_column_name string, original_column_name string, array_column_name string, data_type string, "
    "is_primary_key boolean, is_nullable boolean, load_type_delta boolean, _az_insert_ts timestamp, _az_update_ts timestamp"
)
#: Up to so many tabs the specs are broadcast to the records; more are joined by a shuffle.
BROADCAST_TABS = 100_000


@dataclass(frozen=True)
class Key:
    sheet: str
    name: str
    type: str = "string"
    check_not_null: bool = True


@dataclass(frozen=True)
class TabSpec:
    """How one tab is loaded."""

    table: str
    keys: tuple[Key, ...] = field(default_factory=tuple)
    delta: bool = True
    data_column: str = "DATA"


def seeded(spark: SparkSession, tabs: dict[tuple[str, str], TabSpec]) -> DataFrame:
    """Registry rows for the specs of tabs, by (file name prefix, tab): one for each key column, in order.

    A full load without keys gets a row that names no key, so that the tab is known.
    """
    rows = []
    for (prefix, tab), spec in tabs.items():
        for key in spec.keys or (None,):
            named = (key.sheet, key.name, spec.data_column, key.type, True, key.check_not_null) if key else (None, None, spec.data_column, None, False, False)
            rows.append((len(rows) + 1, None, prefix, tab, spec.table, *named, spec.delta, None, None))
    return spark.createDataFrame(rows, REGISTRY)


def flag(df: DataFrame, name: str) -> Column:
    """A boolean column that is true where it is null or missing."""
    return F.coalesce(F.col(name), F.lit(True)) if name in df.columns else F.lit(True)


def specs(registry: DataFrame) -> DataFrame:
    """One row for each tab: table_name, delta, data_column and keys, ordered by serial number.

    Table, load type and data column are those of the tab's first row.
    """
    row = F.struct(
        "serial_number",
        F.lower(F.coalesce("table_name", F.lit(""))).alias("table_name"),
        flag(registry, "load_type_delta").alias("delta"),
        F.coalesce(F.nullif(F.col("array_column_name"), F.lit("")), F.lit("DATA")).alias("data_column"),
        F.col("is_primary_key").alias("pk"),
        F.struct(
            F.col("sheet_column_name").alias("sheet"),
            F.coalesce(F.nullif(F.col("original_column_name"), F.lit("")), F.col("sheet_column_name")).alias("name"),
            F.lower("data_type").alias("type"),
            flag(registry, "is_nullable").alias("check_not_null"),
        ).alias("key"),
    )
    grouped = registry.groupBy("file_name_prefix", "sheet_tab_name").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    first = F.col("rows")[0]
    keys = F.transform(F.filter("rows", lambda r: r["pk"]), lambda r: r["key"])
    keys = F.when(first["delta"], keys).otherwise(F.slice(keys, 1, 0))
    return grouped.select("file_name_prefix", "sheet_tab_name", first["table_name"].alias("table_name"), first["delta"].alias("delta"), first["data_column"].alias("data_column"), keys.alias("keys"))


def tab_spec(registry: DataFrame, prefix: str, tab: str) -> TabSpec | None:
    """The spec of one tab, or None if it isn't configured."""
    row = specs(registry.where((F.col("file_name_prefix") == prefix) & (F.col("sheet_tab_name") == tab))).first()
    if row is None:
        return None
    return _spec(row)


def _spec(row) -> TabSpec:
    return TabSpec(row["table_name"], tuple(Key(k["sheet"], k["name"], k["type"], k["check_not_null"]) for k in row["keys"]), row["delta"], row["data_column"])


def by_table(registry: DataFrame) -> DataFrame:
    """One row for each table, whatever its case: the spec of its first tab by serial number, n_tabs and ambiguous (more than one)."""
    first = registry.groupBy("file_name_prefix", "sheet_tab_name").agg(F.min("serial_number").alias("_serial"))
    of = specs(registry).join(first, ["file_name_prefix", "sheet_tab_name"])
    row = F.struct("_serial", "file_name_prefix", "sheet_tab_name", "delta", "data_column", "keys")
    found = of.groupBy("table_name").agg(F.min_by(row, F.struct("_serial", "file_name_prefix", "sheet_tab_name")).alias("_r"), F.count("*").alias("n_tabs"))
    return found.select("table_name", "_r.file_name_prefix", "_r.sheet_tab_name", "_r.delta", "_r.data_column", "_r.keys", "n_tabs", (F.col("n_tabs") > 1).alias("ambiguous"))


def table_spec(registry: DataFrame, table: str) -> tuple[TabSpec, str, str] | None:
    """(spec, file name prefix, tab) of a table, or None; warns if more than one tab feeds it."""
    row = by_table(registry.where(F.lower("table_name") == table.lower())).first()
    if row is None:
        return None
    if row["ambiguous"]:
        warnings.warn(f"{row['n_tabs']} tabs feed {row['table_name']}; taken: {row['file_name_prefix']}, {row['sheet_tab_name']}", stacklevel=2)
    return _spec(row), row["file_name_prefix"], row["sheet_tab_name"]


def with_specs(tabs: DataFrame, registry: DataFrame) -> DataFrame:
    """tabs (file_name_prefix, sheet_tab_name, ...) with their specs; tabs that aren't configured go."""
    spec = specs(registry)
    small = spec.count() <= BROADCAST_TABS
    return tabs.join(F.broadcast(spec) if small else spec, ["file_name_prefix", "sheet_tab_name"])


def unconfigured(tabs: DataFrame, registry: DataFrame) -> DataFrame:
    """Tabs that the registry doesn't know; they are skipped and get no control row."""
    return tabs.join(registry.select("file_name_prefix", "sheet_tab_name").distinct(), ["file_name_prefix", "sheet_tab_name"], "left_anti")


def key_lists(registry: DataFrame) -> DataFrame:
    """For each tab and table its key names in order, joined by ` + `."""
    ordered = F.sort_array(F.collect_list(F.struct("serial_number", "sheet_column_name")))
    return registry.where("is_primary_key").groupBy("sheet_tab_name", "table_name").agg(F.concat_ws(" + ", F.transform(ordered, lambda r: r["sheet_column_name"])).alias("pk_columns"))


def ambiguous_tables(registry: DataFrame) -> DataFrame:
    """For each table, whatever its case, how many tabs feed it, and whether that is more than one."""
    n = F.count_distinct("file_name_prefix", "sheet_tab_name")
    return registry.groupBy(F.lower("table_name").alias("table_name")).agg(n.alias("n_tabs"), (n > 1).alias("ambiguous"))


def migrated(registry: DataFrame) -> DataFrame:
    """The registry in its present form: key rows only, flags filled, obsolete columns dropped."""
    filled = registry.where("is_primary_key").withColumns({c: flag(registry, c) for c in ("is_nullable", "load_type_delta")})
    wanted = [part.strip().split()[0] for part in REGISTRY.split(",")]
    return filled.select(*[c for c in wanted if c in filled.columns])
