"""Casts that tell what they can't read, and types that are named by data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .checks import UNTYPED, blank

Cast = Callable[[Column], Column]
#: The column that split_cast adds: what couldn't be read, as (column, text).
FAILED = "_failed"


def split_cast(rows: DataFrame, casts: dict[str, Cast]) -> DataFrame:
    """rows with its columns cast in place, and _failed, the cells that have a text but no value: none of them is lost.

    casts: for each column a function of columns that gives null for what it can't read. Nulls and blank texts have no
    value and fail nothing.
    """
    old = {c: F.col(f"`{c}`") for c in casts}
    value = {c: cast(old[c]) for c, cast in casts.items()}
    cell = lambda c: F.struct(F.lit(c).alias("column"), old[c].cast("string").alias("text"))
    fails = [F.when(~blank(old[c].cast("string")) & value[c].isNull(), cell(c)) for c in casts]
    empty = F.array().cast("array<struct<column:string,text:string>>")
    return rows.withColumns(value | {FAILED: F.array_compact(F.array(*fails)) if fails else empty})


def told(failed: Column) -> Column:
    """What couldn't be read, as `column: text | ...`."""
    return F.concat_ws(" | ", F.transform(failed, lambda f: F.concat(f["column"], F.lit(": "), f["text"])))


def readable(spark: SparkSession, kind: str) -> bool:
    """Whether a text can be cast to a type of that name at all."""
    try:
        spark.range(1).select(F.lit("").try_cast(kind))
    except (PySparkException, ValueError):
        return False
    return True


def named_types(known: DataFrame) -> tuple[list[str], list[str]]:
    """The types that a registry names (lower case, without texts), and the names that aren't types of a text.

    Different names are as few as people write down; they come to the driver, since a cast needs its type as a literal.
    """
    rows = known.where("is_primary_key").select(F.lower(F.trim("data_type")).alias("t")).distinct().where("t is not null")
    kinds = sorted(r["t"] for r in rows.collect() if r["t"] not in UNTYPED)
    of = {k: readable(known.sparkSession, k) for k in kinds}
    return [k for k in kinds if of[k]], [k for k in kinds if not of[k]]


def unreadable_as(value: Column, kind: Column, kinds: list[str]) -> Column:
    """Whether a text that isn't blank can't be read as the type that its row names, of those that there are."""
    fails = F.lit(False)
    for name in kinds:
        fails = F.when(kind == name, value.try_cast(name).isNull()).otherwise(fails)
    return ~blank(value) & fails
