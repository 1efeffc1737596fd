"""Loads, batches and chains in the cases that are easy to get wrong."""

import datetime as dt
import warnings

import pytest
from pyspark.sql import functions as F

from gridloom.functions import tolerant_timestamp
from gridloom.operators import bulkload, casts, control, quarantine
from gridloom.operators.registry import Key, TabSpec, seeded
from gridloom.plans import flows
from gridloom.sources import sinks



def ntz():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


# ---- casts


def test_split_cast_tells_every_cell(spark):
    df = rows(spark, [(1, "7", "2024-01-01"), (2, "x", "never"), (3, None, " "), (4, "70000", None)], "k int, n string, at string")
    split = casts.split_cast(df, {"n": lambda c: c.try_cast("smallint"), "at": tolerant_timestamp}).orderBy("k").collect()
    assert [r["n"] for r in split] == [7, None, None, None]
    assert [[tuple(f) for f in r["_failed"]] for r in split] == [[], [("n", "x"), ("at", "never")], [], [("n", "70000")]]
    assert casts.split_cast(df, {}).where("size(_failed) > 0").count() == 0


def test_types_come_from_the_registry(spark):
    known = seeded(spark, {("P", t): TabSpec("t", (Key("K", "K", kind),)) for t, kind in (("a", "Decimal(5,2)"), ("b", "smallint"), ("c", "number(5)"), ("d", "STRING"), ("e", "array<int>"), ("f", " float "))})
    assert casts.named_types(known) == (["decimal(5,2)", "float", "smallint"], ["array<int>", "number(5)"])


# ---- windows


def test_windows_of_equal_rows_on_skewed_keys(spark):
    keys = [(i,) for i in range(900)] + [(10**12 + i * 10**9,) for i in range(100)]
    plan = bulkload.plan_row_windows(rows(spark, keys, "k bigint"), "k", 100, "c").collect()
    sizes = [sum(w["lo"] < k <= w["hi"] for (k,) in keys) for w in plan]
    assert sum(sizes) == 1000 and max(sizes) <= 150 and all(a["hi"] == b["lo"] for a, b in zip(plan, plan[1:], strict=False))
    wide = bulkload.plan_windows(rows(spark, keys, "k bigint"), "k", 10, "c").collect()
    assert max(sum(w["lo"] < k <= w["hi"] for (k,) in keys) for w in wide) >= 900


def test_one_key_with_most_rows_and_no_rows(spark):
    keys = [(5,)] * 500 + [(i,) for i in range(100)] + [(None,)] * 3
    plan = bulkload.plan_row_windows(rows(spark, keys, "k bigint"), "k", 50, "c").collect()
    assert all(sum(w["lo"] < k <= w["hi"] for w in plan) == 1 for (k,) in keys if k is not None)
    assert bulkload.plan_row_windows(rows(spark, [(None,)], "k bigint"), "k", 50, "c").count() == 0


def load(spark, tmp_path, source, target, upsert, **settings):
    source, target = rows(spark, source, "k bigint, at string, v string"), rows(spark, target, "k bigint, at timestamp_ntz, v string")
    plan = bulkload.plan_windows(source, "k", 4, "c")
    return flows.windowed_load(source, target, plan, "k", str(tmp_path), {"at": tolerant_timestamp}, upsert=upsert, **settings)


DAY = dt.datetime(2024, 1, 1)
SOURCE = [(k, "never" if k % 5 == 0 else "2024-01-01", "new") for k in range(1, 41)] + [(None, "2024-01-01", "lost")] * 2
OLD = [(k, None, "old") for k in (4, 5, 8, 39)]


@pytest.mark.parametrize("upsert", [False, True])
def test_loads_in_both_modes(spark, tmp_path, upsert):
    target, states = load(spark, tmp_path, SOURCE, OLD, upsert)
    got = {r["k"]: (r["at"], r["v"]) for r in target.collect()}
    assert got[5] == (None, "old") and 10 not in got and len(got) == 33
    assert {k: got[k] for k in (4, 8, 39)} == {k: (DAY, "new") if upsert else (None, "old") for k in (4, 8, 39)}
    told = {r["window_id"]: r for r in states.collect()}
    assert told[-1]["source_count"] == told[-1]["rejected_count"] == 2 and all(r["status"] == "done" for r in told.values())
    assert sum(r["source_count"] for r in told.values()) == 42
    bad = flows.rejected_rows(spark, states, str(tmp_path), "k", "t", "run", ntz())
    assert bad.columns == quarantine.ERROR_COLUMNS
    reasons = sorted((r["error_category"], r["pk_value"] or "") for r in bad.collect())
    # a row that is there already is not read when inserting, so it can't be rejected
    assert len(reasons) == (10 if upsert else 9) and reasons[-1][0] == "Mandatory PK field is NULL"
    assert any("at: never" in r["error_description"] for r in bad.collect())


def test_updating_leaves_other_ranges_alone(spark, tmp_path):
    target, states = load(spark, tmp_path, [(k, "2024-01-01", "new") for k in range(1, 21)], [(k, None, "old") for k in (3, 15, 99, -5)] + [(None, None, "old")], True, most=2)
    got = sorted((r["k"] is None, r["k"] or 0, r["v"]) for r in target.collect())
    assert [x for x in got if x[2] == "old"] == [(False, -5, "old"), (False, 15, "old"), (False, 99, "old"), (True, 0, "old")]
    assert flows.more_pending(states)
    again, states = load(spark, tmp_path, [(k, "2024-01-01", "new") for k in range(1, 21)], [(k, None, "old") for k in (3, 15, 99, -5)] + [(None, None, "old")], True)
    assert not flows.more_pending(states) and again.where("v = 'old'").count() == 3 and again.count() == 23


# ---- chains


def tab(spark, *keys, **more):
    df = rows(spark, [("f_2024.01.02.xlsx", "T", k, "v") for k in keys], "file_name string, sheet_tab_name string, K string, V string")
    return df.withColumns({n: F.lit(v) for n, v in more.items()})


SPEC = TabSpec("t", (Key("K", "ID", "bigint"),))


def chain(df, spec, base, run="r1"):
    return flows.ingest_chain(df, spec, str(base), run, ntz(), F.lit("/p")).collect()[0]


@pytest.mark.parametrize(("spec", "more", "reason"), [(TabSpec("t", (Key("X", "X"),)), {}, "Configured PK column(s) X not found"), (SPEC, {"Comments": "x"}, "Comments have the names"), (TabSpec("t", (Key("K", "K", "varchar2(5)"),)), {}, "varchar2(5) are unknown")])
def test_a_fault_is_a_failed_row(spark, tmp_path, spec, more, reason):
    told = chain(tab(spark, "1", "2", **more), spec, tmp_path)
    assert (told["final_ingestion_status"], told["source_row_count"], told["valid_record_count"]) == ("Failed", 2, 0)
    assert reason in told["comments"] and told["dq_check_validation"][0].endswith("NOT RUN") and not (tmp_path / "curated").exists()


def test_a_failure_on_the_way_is_a_failed_row(spark, tmp_path):
    (tmp_path / "curated").write_text("a file where a folder should be")
    told = chain(tab(spark, "1"), SPEC, tmp_path)
    assert told["final_ingestion_status"] == "Failed" and told["source_row_count"] == 1


def test_dotted_headers_and_configured_full_loads(spark, tmp_path):
    dotted = tab(spark, "1", "2").withColumnRenamed("V", "No. of items")
    assert chain(dotted, SPEC, tmp_path)["valid_record_count"] == 2
    assert chain(dotted, TabSpec("u", SPEC.keys, False), tmp_path)["valid_record_count"] == 2
    assert '"No. of items":"v"' in spark.read.parquet(f"{tmp_path}/curated/u").first()["DATA"]


def test_an_execution_is_run_once_and_files_stand_side_by_side(spark, tmp_path):
    first = chain(tab(spark, "1", "2"), SPEC, tmp_path)
    assert chain(tab(spark, "1", "2", "3"), SPEC, tmp_path) == first
    other = tab(spark, "7").withColumn("file_name", F.lit("g_2024.01.02.xlsx"))
    chain(other, SPEC, tmp_path, "r2")
    read = lambda: sorted(r["ID"] for r in spark.read.parquet(f"{tmp_path}/curated/t").select("ID").collect())
    assert read() == [1, 2, 7]
    chain(tab(spark, "5"), SPEC, tmp_path, "r3")
    assert read() == [5, 7]


def test_run_tables_replace_their_run(spark):
    sinks.create_run_table(spark, "gridloom_runs", "n int, execution_id string, comments string")
    df = rows(spark, [("b", 2), ("a", 1)], "COMMENTS string, n int")
    for run in ("x", "it's", "x"):
        sinks.replace_run(df, "gridloom_runs", run)
    sinks.replace_run(df.limit(0), "gridloom_runs", "it's")
    assert sorted(map(tuple, spark.table("gridloom_runs").select("execution_id", "n", "comments").collect())) == [("x", 1, "a"), ("x", 2, "b")]


def test_batch_rows_and_types(spark, tmp_path):
    known = seeded(spark, {("f", "A"): TabSpec("one", (Key("K", "ID", "decimal(5,2)"),)), ("f", "B"): TabSpec("two", (Key("K", "N", "smallint"), Key("L", "L")), data_column="REST"), ("f", "C"): TabSpec("three", (Key("K", "K", "nonsense"),)), ("f", "D"): TabSpec("four", (), False)})
    data = [("f.xlsx", t, i, ["K", "L", "v.w"], [k, "l", None]) for t in "ABCD" for i, k in enumerate(["1.5", "123456", "12", "12"])]
    promoted = rows(spark, data, "file_name string, sheet_tab_name string, row_idx bigint, header array<string>, values array<string>")
    none = lambda schema: spark.createDataFrame([], schema)
    told = flows.ingest_tables(promoted, none("file_name string, sheet_tab_name string, table_name string"), none("file_name string, error string"), known, str(tmp_path), "r", ntz(), F.lit("/p"))
    assert told.schema.simpleString() == spark.createDataFrame([], control.CONTROL).schema.simpleString()
    got = {r["sheet_tab_name"]: (r["final_ingestion_status"], r["valid_record_count"], r["error_record_count"]) for r in told.collect()}
    assert got == {"A": ("Failed", 1, 3), "B": ("Failed", 0, 4), "C": ("Failed", 0, 0), "D": ("Succeeded", 4, 0)}
    one = flows.read_curated(spark, str(tmp_path), "one")
    assert one.schema["ID"].dataType.simpleString() == "decimal(5,2)" and one.count() == 1 and one.first()["DATA"] == '{"L":"l","v.w":null}'
    assert flows.read_curated(spark, str(tmp_path), "four").count() == 4
    errors = spark.read.parquet(f"{tmp_path}/errors/r")
    bad = errors.where("table_name = 'one' and error_category like 'PK datatype%'").first()
    assert bad["pk_value"] == "ID=123456" and '"ID":"123456"' in bad["err_record"] and "v.w" not in bad["err_record"]


def test_tables_without_a_good_row_have_their_columns(spark, tmp_path):
    known = seeded(spark, {("f", "A"): TabSpec("one", (Key("K", "ID", "bigint"),)), ("f", "B"): TabSpec("one", (Key("K", "N", "int"),)), ("f", "C"): TabSpec("007", (Key("K", "C", "int"),))})
    none = lambda schema: spark.createDataFrame([], schema)
    void, broken = none("file_name string, sheet_tab_name string, table_name string"), rows(spark, [("b.xlsx", "broken")], "file_name string, error string")

    def run(name, data):
        promoted = rows(spark, data, "file_name string, sheet_tab_name string, row_idx bigint, header array<string>, values array<string>")
        told = flows.ingest_tables(promoted, void, broken, known, f"{tmp_path}/{name}", "r", ntz(), F.lit("/p"))
        return sorted((r["file_name"], r["sheet_tab_name"] or "", r["valid_record_count"], r["error_record_count"]) for r in told.collect())

    twice = [("f.xlsx", t, i, ["K", "V"], ["5", "v"]) for t in "AB" for i in range(2)]
    assert run("bad", twice) == [("b.xlsx", "", 0, 0), ("f.xlsx", "A", 0, 2), ("f.xlsx", "B", 0, 2)]
    one = flows.read_curated(spark, f"{tmp_path}/bad", "one", known)
    assert one.count() == 0 and dict(one.dtypes)["ID"] == "bigint" and dict(one.dtypes)["N"] == "int" and one.columns[0] == "PK_DERIVED" and "DATA" in one.columns
    assert run("half", [*twice[:2], ("f.xlsx", "B", 0, ["K", "V"], ["6", "v"]), ("f.xlsx", "C", 0, ["K", "V"], ["7", "v"])]) == [("b.xlsx", "", 0, 0), ("f.xlsx", "A", 0, 2), ("f.xlsx", "B", 1, 0), ("f.xlsx", "C", 1, 0)]
    assert [(r["ID"], r["N"]) for r in flows.read_curated(spark, f"{tmp_path}/half", "one", known).collect()] == [(None, 6)]
    assert [r["C"] for r in flows.read_curated(spark, f"{tmp_path}/half", "007", known).collect()] == [7]
    assert run("nothing", [("g.xlsx", "Z", 0, ["K"], ["1"])]) == [("b.xlsx", "", 0, 0)]
    assert flows.read_curated(spark, f"{tmp_path}/nothing", "one", known).count() == 0


# ---- regeneration


def test_counts_and_caps_of_a_batch(spark):
    df = spark.range(5)
    with pytest.warns(UserWarning, match="5 rows, its run expected 4"):
        assert flows.counted_batch(df, 4) == 5
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert flows.counted_batch(df, 5) == 5 and flows.counted_batch(df, None, None) == 5
    with pytest.raises(ValueError, match="too many"):
        flows.counted_batch(df, None, 4)


def test_dated_names_tell_prefix_and_time(spark):
    name = sinks.dated_name("A.b", dt.datetime(2024, 2, 1, 3, 4, 5))
    from gridloom.functions import file_meta

    assert tuple(spark.range(1).select(file_meta(F.lit(name)).alias("m")).first()["m"]) == ("A.b", "20240201030405", dt.datetime(2024, 2, 1, 3, 4, 5))
