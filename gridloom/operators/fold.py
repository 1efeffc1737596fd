"""Folding all columns that aren't keys into one semi-structured column, and unfolding it again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .registry import TabSpec

# The trailing columns of a curated table.
FILE_TIME, FILE_NAME, TAB_NAME, INSERT_TIME = "FILE_DTTM", "AZ_INPUT_XLS_FILE_NAME", "AZ_INPUT_XLS_TAB_NAME", "_AZ_INSERT_TS"
KEYS_COLUMN = "DATA_KEYS"


def folded(columns: list[str]) -> Column:
    """A JSON object of the columns in order, null ones included; `{}` for none."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}) if columns else F.lit("{}")


def keys_json(columns: list[str]) -> Column:
    """The JSON array of the folded columns' names, in order."""
    return F.to_json(F.array(*[F.lit(c) for c in columns])) if columns else F.lit("[]")


def curated(good: DataFrame, spec: TabSpec, data_columns: list[str], file_time: Column, file_name: Column, tab: Column, inserted: Column, variant: bool = False) -> DataFrame:
    """The curated rows: derived key, typed keys, folded data and its keys, lineage columns. variant: as VARIANT."""
    data, keys = folded(data_columns), keys_json(data_columns)
    if variant:
        data, keys = F.parse_json(data), F.parse_json(keys)
    typed = [F.col(f"`{k.name}`").try_cast(k.type).alias(k.name) for k in spec.keys]
    lineage = [file_time.alias(FILE_TIME), file_name.alias(FILE_NAME), tab.alias(TAB_NAME), inserted.alias(INSERT_TIME)]
    return good.select("PK_DERIVED", *typed, data.alias(spec.data_column), keys.alias(KEYS_COLUMN), *lineage)


def as_text(df: DataFrame, column: str) -> Column:
    """A JSON or VARIANT column as JSON text."""
    return F.col(f"`{column}`").cast("string") if isinstance(df.schema[column].dataType, T.VariantType) else F.col(f"`{column}`")


def checked_contract(df: DataFrame, spec: TabSpec) -> DataFrame:
    """df itself, if it has what a curated table must have."""
    missing = [c for c in (spec.data_column, KEYS_COLUMN, FILE_TIME) if c not in df.columns]
    if missing:
        raise ValueError(f"not a curated table: {missing} missing, there are {df.columns}")
    return df


def latest_batch(df: DataFrame) -> DataFrame:
    """The rows of the newest file time. One scalar, so that a partitioned table is pruned; none if there is no time."""
    newest = df.agg(F.max(FILE_TIME)).first()[0]
    return df.limit(0) if newest is None else df.where(F.col(FILE_TIME) == F.lit(newest).cast(df.schema[FILE_TIME].dataType))


def discovered_keys(df: DataFrame) -> list[str]:
    """The folded names of the newest row that has them, over the whole table."""
    row = df.where(F.col(KEYS_COLUMN).isNotNull()).agg(F.max_by(as_text(df, KEYS_COLUMN), F.struct(FILE_TIME, as_text(df, KEYS_COLUMN))).alias("k")).select(F.from_json("k", "array<string>").alias("k")).first()
    return list(row["k"]) if row and row["k"] else []


def unfolded(df: DataFrame, spec: TabSpec, keys: list[str]) -> DataFrame:
    """A flat sheet: typed keys first (none of a full load), then the folded columns, parsed once into a map."""
    names = [k.name for k in spec.keys] if spec.delta else []
    folded_names = [k for k in keys if k not in names]
    if not names and not folded_names:
        raise ValueError("nothing to unfold: no key columns and no folded ones")
    parsed = df.withColumn("_map", F.from_json(as_text(df, spec.data_column), "map<string,string>"))
    return parsed.select(*[F.col(f"`{n}`") for n in names], *[F.col("_map").getItem(k).alias(k) for k in folded_names])
