"""Bulk loads in key ranges: planned windows, resumed, reconciled and merged by key."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PENDING, DONE = "pending", "done"


def plan_windows(source: DataFrame, key: str, windows: int, cycle: str) -> DataFrame:
    """(cycle_id, window_id, lo, hi, status): ranges lo < key <= hi of equal width over all keys of the source."""
    low, high = source.agg(F.min(key), F.max(key)).first()
    spark = source.sparkSession
    if low is None:
        return spark.createDataFrame([], "cycle_id string, window_id int, lo long, hi long, status string")
    width = max(1, ceil((high - low + 1) / windows))
    plan = spark.range(ceil((high - low + 1) / width))
    lo = F.col("id") * width + (low - 1)
    return plan.select(F.lit(cycle).alias("cycle_id"), F.col("id").cast("int").alias("window_id"), lo.alias("lo"), F.least(lo + width, F.lit(high)).alias("hi"), F.lit(PENDING).alias("status"))


def plan_row_windows(source: DataFrame, key: str, rows: int, cycle: str, accuracy: int = 100) -> DataFrame:
    """Windows of about `rows` rows each, however keys are spread; in the shape of plan_windows.

    Their edges are quantiles of the keys from one mergeable sketch, a few numbers to the driver, exact to a
    1 / accuracy-th of a window. Rows of one key are never parted, so a key with more rows than that has its own window.
    """
    spark = source.sparkSession
    total, low, high = source.agg(F.count(key), F.min(key), F.max(key)).first()
    if not total:
        return spark.createDataFrame([], "cycle_id string, window_id int, lo long, hi long, status string")
    n = ceil(total / rows)
    shares = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(1.0))
    edges = sorted({x for x in source.agg(F.percentile_approx(key, shares, accuracy * n)).first()[0] if x < high} | {high})
    lows = [low - 1, *edges[:-1]]
    return spark.createDataFrame([(cycle, i, lo, hi, PENDING) for i, (lo, hi) in enumerate(zip(lows, edges, strict=True))], "cycle_id string, window_id int, lo long, hi long, status string")


def window_of(key: Column, low: int, width: int) -> Column:
    """The window of a key, by arithmetic: no join."""
    return F.floor((key - low) / width).cast("int")


def read_window(source: DataFrame, key: str, lo: int, hi: int) -> DataFrame:
    """The rows of one window; both bounds reach the scan."""
    return source.where((F.col(key) > lo) & (F.col(key) <= hi))


def window_predicates(key: str, lo: int, hi: int, partitions: int = 64) -> list[str]:
    """Conditions that part a window's keys (lo < key <= hi) into ranges, for one read task each."""
    parts = max(1, min(partitions, hi - lo))
    edges = [lo + (hi - lo) * i // parts for i in range(parts + 1)]
    return [f"{key} > {a} AND {key} <= {b}" for a, b in zip(edges, edges[1:], strict=False)]


def read_jdbc_window(spark: SparkSession, url: str, table: str, key: str, lo: int, hi: int, partitions: int = 64, **options: str) -> DataFrame:
    """The rows of one window of a database table, read by so many tasks side by side."""
    return spark.read.jdbc(url, table, predicates=window_predicates(key, lo, hi, partitions), properties=options)


def pending(windows: DataFrame, done: DataFrame) -> DataFrame:
    """Windows of a cycle that aren't done yet."""
    return windows.join(done.select("cycle_id", "window_id"), ["cycle_id", "window_id"], "left_anti")


def reconcile_windows(source: DataFrame, target: DataFrame, window: str = "window_id") -> DataFrame:
    """Rows on both sides of each window, and whether they agree."""
    count = lambda df, name: df.groupBy(window).agg(F.count("*").alias(name))
    both = count(source, "source_count").join(count(target, "target_count"), window, "full_outer")
    both = both.select(window, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("source_count", "target_count")])
    return both.withColumn("matches", F.col("source_count") == F.col("target_count"))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All of the source, and of the target what the source doesn't have."""
    return source.unionByName(target.join(source.select(*keys), keys, "left_anti"))


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All of the target, and of the source what the target doesn't have."""
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))
