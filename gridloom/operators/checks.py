"""Validation of primary keys: duplicates, nulls, types. Nothing is dropped; every reason of a row is told."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import derived_key, full_row_key
from .registry import Key, TabSpec

# The reasons, in this order, and the report's texts.
NULL_REASON = "Mandatory PK field is NULL || "
TYPE_REASON = "PK datatype mismatch || "
DUPLICATE_REASON = "Duplicate Primary Key || "
UNTYPED = ("string", "varchar", "char")
#: Columns that checks add; a sheet that has one of these is rejected, or the column would be overwritten.
RESERVED = ("PK_DERIVED", "COMMENTS", "_null", "_type", "_dup")


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def null_flag(keys: tuple[Key, ...]) -> Column:
    """Whether a key that is to be checked is null or blank."""
    return _any([blank(F.col(f"`{k.name}`")) for k in keys if k.check_not_null])


def type_flag(keys: tuple[Key, ...]) -> Column:
    """Whether a key that isn't blank can't be read as its type."""
    return _any([~blank(F.col(f"`{k.name}`")) & F.col(f"`{k.name}`").try_cast(k.type).isNull() for k in keys if k.type.lower() not in UNTYPED])


def with_duplicate_flag(df: DataFrame, key: list[str], name: str = "_dup") -> DataFrame:
    """df with whether its key occurs more than once; every copy is flagged, and null keys are copies of each other.

    Keys are counted before the shuffle and only repeated ones are joined back, so a key with a third of all rows is one
    row in the count, and the join's large side can be split.
    """
    repeated = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n").withColumn(name, F.lit(True))
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)])
    return df.join(repeated, same, "left").drop(*[f"_k{i}" for i in range(len(key))]).withColumn(name, F.coalesce(name, F.lit(False)))


def is_reserved(name: Column) -> Column:
    """Whether a header is the name of an added column, whatever its case."""
    return F.lower(name).isin(*[r.lower() for r in RESERVED])


def unreserved(df: DataFrame) -> DataFrame:
    """df itself, if none of its columns has the name of one that the checks add."""
    taken = {r.lower() for r in RESERVED}
    clashing = [c for c in df.columns if c.lower() in taken]
    if clashing:
        raise ValueError(f"Sheet column(s) {clashing} have the names of added columns. Sheet columns: {sorted(df.columns)}")
    return df


def renamed(df: DataFrame, spec: TabSpec) -> DataFrame:
    """Key columns under their final names; all columns in the order of the sheet."""
    names = {k.sheet: k.name for k in spec.keys}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def data_columns(df: DataFrame, spec: TabSpec, scope: list[str]) -> list[str]:
    """Columns that are neither keys nor scope, in order."""
    out = {k.name for k in spec.keys} | set(scope)
    return [c for c in df.columns if c not in out]


def validated(df: DataFrame, spec: TabSpec, scope: list[str]) -> DataFrame:
    """A renamed tab with PK_DERIVED, the flags _null, _type, _dup, and COMMENTS ('' for good rows).

    scope: the columns that hold file and tab; keys are unique within them. A full load has no checks, and its key is
    over all columns and the scope. A sheet with a reserved column is rejected.
    """
    unreserved(df)
    if not spec.delta:
        columns = [F.col(f"`{c}`") for c in data_columns(df, spec, scope)]
        none = {f: F.lit(False) for f in ("_null", "_type", "_dup")}
        return df.withColumns({"PK_DERIVED": full_row_key(columns, F.col(scope[0]), F.col(scope[1]))} | none | {"COMMENTS": F.lit("")})
    keyed = df.withColumns({"PK_DERIVED": derived_key([F.col(f"`{k.name}`") for k in spec.keys]), "_null": null_flag(spec.keys), "_type": type_flag(spec.keys)})
    flagged = with_duplicate_flag(keyed, ["PK_DERIVED", *scope])  # the key first: sorts compare what differs
    reasons = [F.when(F.col(f), F.lit(r)).otherwise("") for f, r in (("_null", NULL_REASON), ("_type", TYPE_REASON), ("_dup", DUPLICATE_REASON))]
    return flagged.withColumn("COMMENTS", F.concat(*reasons))


def dq_counts(checked: DataFrame, scope: list[str]) -> DataFrame:
    """For each file and tab: total, dup, nul, dty, bad, valid, in one pass."""
    ones = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    counts = checked.groupBy(*scope).agg(F.count("*").alias("total"), ones(F.col("_dup")).alias("dup"), ones(F.col("_null")).alias("nul"), ones(F.col("_type")).alias("dty"), ones(F.col("COMMENTS") != "").alias("bad"))
    return counts.withColumn("valid", F.col("total") - F.col("bad"))


def dq_report(delta: Column, checks_null: Column) -> Column:
    """The three lines of a tab's report, from the columns dup, nul and dty of dq_counts."""
    line = lambda title, n, what: F.concat(F.lit(f"{title} : "), F.when(n == 0, "PASS").otherwise("FAIL"), F.lit(f" | {what}="), n.cast("string"))
    skipped = lambda title: F.lit(f"{title} : SKIPPED | load_type_delta=false")
    null_line = F.when(checks_null, line("Not Null PK Check", F.col("nul"), "null_records")).otherwise("Not Null PK Check : SKIPPED | is_nullable=false for all PK columns")
    run = F.array(line("Duplicate PK Check", F.col("dup"), "duplicate_records"), null_line, line("Data Type Check", F.col("dty"), "mismatch_records"))
    return F.when(delta, run).otherwise(F.array(skipped("Duplicate PK Check"), skipped("Not Null PK Check"), skipped("Data Type Check")))


def good(checked: DataFrame) -> DataFrame:
    return checked.where("COMMENTS = ''")


def bad(checked: DataFrame) -> DataFrame:
    return checked.where("COMMENTS <> ''")
