"""Loading a large table in key windows: resumable, reconciled, inserting or updating, with rejected rows kept."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bulkload, casts, quarantine
from ..operators.checks import NULL_REASON

STATES = "cycle_id string, window_id int, lo long, hi long, status string, source_count long, target_count long, rejected_count long"
_STATES = [c.split()[0] for c in STATES.split(", ")]
#: What becomes of a row: loaded from the source, kept from the target (on updating), or rejected.
LOADED, KEPT, REJECTED = "loaded", "kept", "rejected"
#: The window of rows that have no key.
NO_KEY = -1
CAST_REASON = "Cast failed || "


def _saved(spark: SparkSession, folder: str, state: dict) -> None:
    """Writes a state as a file of its own: under another name first, so that it is there as a whole or not at all."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    name = f"{state['cycle_id']}-{state['window_id']}.json"
    made, final = path(f"{folder}/_{name}-{uuid.uuid4().hex}"), path(f"{folder}/{name}")
    system = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(made, True)
    out.write(bytearray(json.dumps({c: state.get(c) for c in _STATES}).encode()))
    out.close()
    system.delete(final, False)
    system.rename(made, final)


def _base(path: str) -> str:
    return f"{path}/rows"


def _part(path: str, state: dict) -> str:
    return f"{_base(path)}/_cycle={state['cycle_id']}/_window={state['window_id']}"


def _known(spark: SparkSession, folder: str) -> dict[tuple[str, int], dict]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return {(r["cycle_id"], r["window_id"]): r.asDict() for r in spark.read.schema(STATES).json(folder).collect()}


def windowed_load(
    source: DataFrame, target: DataFrame, windows: DataFrame, key: str, path: str, cast: dict[str, casts.Cast] | None = None, most: int | None = None, upsert: bool = False, at_once: int = 4
) -> tuple[DataFrame, DataFrame]:
    """Loads pending windows in order and stops at the first that doesn't reconcile; (target, window states).

    Every window is read by its range on both sides, cast and written by one job: rows of the source that are new to the
    target (upsert: all of them, and of the target the ones that the source doesn't have), and apart from them the rows
    with a cell that couldn't be cast, which are in rejected_rows. Then all sides are counted: a window is done if every
    row of the source is in the target or rejected. Its state is a file in <path>/states, its rows are in
    <path>/rows by cycle and window; a window without a row of the source changes nothing. Updating copies the ranges of done windows
    alone, the rest of the target stays as it is; a row that is rejected leaves the target's old row in place.

    A run that is started again on the same path, also by another driver, takes up the states that are there and writes
    a window anew that wasn't finished. Windows are disjoint, so none reads what another wrote, and `at_once` of them run
    side by side; what those after one that doesn't reconcile wrote doesn't count. Rows without a key belong to no window: they are rejected under the window NO_KEY, if there are any.
    Keys of the source are taken to be unique. cast: column functions by column. most: windows to load now; see
    more_pending. The driver loops over windows, of which there are few; the rows stay in Spark. path: a folder that all
    executors see.
    """
    spark, folder, columns = source.sparkSession, f"{path}/states", target.columns
    known = _known(spark, folder)
    states = [known.get((r["cycle_id"], r["window_id"])) or r.asDict() for r in windows.orderBy("window_id").collect()]
    part = lambda s: _part(path, s)
    written = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in target.schema.fields)}, _row string, _failed array<struct<column:string,text:string>>, _kind string"
    read = lambda *of: spark.read.schema(written).option("basePath", _base(path)).parquet(*[part(s) for s in of])

    def rejected(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields], "_row", casts.FAILED, F.lit(REJECTED).alias("_kind"))

    def load(state: dict) -> dict:
        rows, there = (bulkload.read_window(df, key, state["lo"], state["hi"]) for df in (source, target))
        told = casts.split_cast(rows.withColumn("_row", F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))), cast or {})
        new = told if upsert else told.join(there.select(key), key, "left_anti")
        good = F.size(casts.FAILED) == 0
        # one pass: what is rejected keeps its row as text in place of its cells
        cells = [F.when(good, F.col(f"`{c}`")).cast(target.schema[c].dataType).alias(c) for c in columns]
        out = new.select(*cells, F.when(~good, F.col("_row")).alias("_row"), casts.FAILED, F.when(good, LOADED).otherwise(REJECTED).alias("_kind"))
        if upsert:
            old = there.join(told.where(good).select(key), key, "left_anti").select(*columns)
            out = out.unionByName(old.select("*", F.lit(None).cast("string").alias("_row"), F.array().cast("array<struct<column:string,text:string>>").alias(casts.FAILED), F.lit(KEPT).alias("_kind")))
        out.write.mode("overwrite").partitionBy("_kind").parquet(part(state))
        sides = rows.select(F.lit("source").alias("of")).unionAll(there.select(F.lit("there"))).unionAll(read(state).select("_kind"))
        n = dict(sides.groupBy("of").count().collect())
        loaded, old, bad = n.get(LOADED, 0), n.get(KEPT, 0) if upsert else n.get("there", 0), n.get(REJECTED, 0)
        state = state | {"source_count": n.get("source", 0), "target_count": loaded + old, "rejected_count": bad}
        fine = state["source_count"] == (loaded if upsert else loaded + old) + bad
        return state | {"status": bulkload.DONE} if fine else state

    waiting = [i for i, s in enumerate(states) if s["status"] != bulkload.DONE][:most]
    for k in range(0, len(waiting), at_once):
        group = waiting[k : k + at_once]
        with ThreadPoolExecutor(len(group)) as pool:
            running = [pool.submit(load, states[i]) for i in group]
        for i, run in zip(group, running, strict=True):
            states[i] = run.result()
            if states[i]["status"] != bulkload.DONE:
                break
            _saved(spark, folder, states[i])
        if any(states[i]["status"] != bulkload.DONE for i in group):
            break

    cycle = states[0]["cycle_id"] if states else None
    keyless = known.get((cycle, NO_KEY))
    if keyless is None and states:
        none = source.where(F.col(key).isNull())
        if n := none.count():
            rows = none.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in source.columns])).alias("_row"), F.array(F.struct(F.lit(key).alias("column"), F.lit(None).cast("string").alias("text"))).alias(casts.FAILED))
            keyless = {"cycle_id": cycle, "window_id": NO_KEY, "lo": None, "hi": None, "status": bulkload.DONE, "source_count": n, "target_count": 0, "rejected_count": n}
            rejected(rows).write.mode("overwrite").partitionBy("_kind").parquet(part(keyless))
            _saved(spark, folder, keyless)
    told = ([keyless] if keyless else []) + states
    parts = [s for s in states if s["status"] == bulkload.DONE and s.get("source_count")]
    new = read(*parts).where(F.col("_kind") != REJECTED).select(*columns) if parts else target.limit(0)
    rest = target
    if upsert and parts:
        rest = target.where(~F.coalesce(_within(key, [(s["lo"], s["hi"]) for s in parts]), F.lit(False)))
    return rest.unionByName(new), spark.createDataFrame([tuple(s.get(c) for c in _STATES) for s in told], STATES)


def _within(key: str, ranges: list[tuple[int, int]]) -> Column:
    """Whether a key is in one of the ranges (lo < key <= hi); ranges that meet are one."""
    joined: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if joined and joined[-1][1] >= lo:
            joined[-1][1] = max(joined[-1][1], hi)
        else:
            joined.append([lo, hi])
    inside = F.lit(False)
    for lo, hi in joined:
        inside = inside | ((F.col(key) > lo) & (F.col(key) <= hi))
    return inside


def rejected_rows(spark: SparkSession, states: DataFrame, path: str, key: str, table: str, execution_id: str, inserted: Column) -> DataFrame:
    """The rows that done windows rejected, as rows of the error table: each with what couldn't be read, and itself as JSON."""
    found = [r.asDict() for r in states.where("rejected_count > 0").select("cycle_id", "window_id").collect()]
    if not found:
        return spark.createDataFrame([], quarantine.ERRORS)
    shape = "_row string, _failed array<struct<column:string,text:string>>, _kind string"
    rows = spark.read.schema(shape).option("basePath", _base(path)).parquet(*[f"{_part(path, r)}/_kind={REJECTED}" for r in found])
    keyless = F.exists(casts.FAILED, lambda f: f["text"].isNull())
    reason = F.when(keyless, F.lit(NULL_REASON)).otherwise(F.lit(CAST_REASON))
    category = F.regexp_replace(reason, r"\s*\|\|\s*$", "")
    value = F.concat(F.lit(f"{key}="), F.get_json_object("_row", f"$['{key}']"))
    made = {
        "process_id": quarantine.process_id(F.lit(execution_id), F.lit(table), F.lit(key)), "execution_id": F.lit(execution_id), "table_name": F.lit(table), "error_category": category,
        "error_description": F.concat(F.lit("Record rejected on loading. Reason(s): "), category, F.when(keyless, "").otherwise(F.concat(F.lit(" ("), casts.told(F.col(casts.FAILED)), F.lit(")"))), F.lit(". This record was NOT loaded.")),
        "pk_value": value, "err_record": F.col("_row"), "comments": reason, "az_insert_ts": inserted,
    }
    column = lambda c: made.get(c, F.lit(None).cast("string"))
    return rows.select(*[column(c).alias(c) for c in quarantine.ERROR_COLUMNS])


def more_pending(states: DataFrame) -> bool:
    """Whether a cycle has windows that aren't done."""
    return states.where(F.col("status") != bulkload.DONE).limit(1).count() > 0
