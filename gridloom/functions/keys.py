"""Derived keys: one md5 over a record's key columns, or over all of a full load's columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for null, and what follows every part.
NULL, AFTER = "~", "!@~"


def _parts(columns: list[Column]) -> list[Column]:
    return [F.concat(F.coalesce(c.cast("string"), F.lit(NULL)), F.lit(AFTER)) for c in columns]


def derived_key(columns: list[Column]) -> Column:
    """md5 of the key columns in registry order. A null and a literal `~` give the same key, as does no column and `~`."""
    return F.md5(F.concat(*_parts(columns), F.lit(NULL)))


def full_row_key(columns: list[Column], file_name: Column, tab: Column) -> Column:
    """md5 of all columns in sheet order, then the names of file and tab."""
    return F.md5(F.concat(*_parts(columns), file_name, F.lit(AFTER), tab))


def derived_key_of(values: Column) -> Column:
    """derived_key for an array of key texts, where each row may have keys of its own."""
    return F.md5(F.concat(F.array_join(F.transform(values, lambda v: F.concat(F.coalesce(v, F.lit(NULL)), F.lit(AFTER))), ""), F.lit(NULL)))


def full_row_key_of(values: Column, file_name: Column, tab: Column) -> Column:
    """full_row_key for an array of all texts of a row."""
    return F.md5(F.concat(F.array_join(F.transform(values, lambda v: F.concat(F.coalesce(v, F.lit(NULL)), F.lit(AFTER))), ""), file_name, F.lit(AFTER), tab))
