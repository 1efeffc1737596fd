"""Single operators on small fixtures, and the cases that are easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.functions import cell_text, derived_key, file_meta, header_names, safe_tab_name, tolerant_timestamp
from gridloom.operators import bulkload, checks, control, fold, quarantine, registry
from gridloom.operators.registry import Key, TabSpec
from gridloom.plans import flows
from gridloom.sources import grids, sinks

SPEC = TabSpec("t", (Key("K", "ID", "bigint", True), Key("L", "PLACE", "string", False)))


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def tab(spark, *keys):
    return rows(spark, [("f.xlsx", "T", k, p, "v") for k, p in keys], "file_name string, sheet_tab_name string, K string, L string, V string")


def checked(spark, *keys):
    return checks.validated(checks.renamed(tab(spark, *keys), SPEC), SPEC, flows.SCOPE)


def comments(spark, *keys):
    return [r["COMMENTS"] for r in checked(spark, *keys).orderBy("ID", "PLACE").collect()]


def test_good_key_has_no_comment(spark):
    assert comments(spark, ("1", "a"), (" 12 ", "a")) == ["", ""]


def test_all_copies_are_rejected(spark):
    assert comments(spark, ("1", "a"), ("1", "a"), ("1", "b"), ("2", "a"), ("2", "a"), ("2", "a")).count(checks.DUPLICATE_REASON) == 5


def test_null_blank_and_mistyped(spark):
    assert comments(spark, (None, "a")) == [checks.NULL_REASON]
    assert comments(spark, ("  ", "a")) == [checks.NULL_REASON]
    assert comments(spark, ("12.0", "a")) == [checks.TYPE_REASON]
    assert comments(spark, ("x", "a")) == [checks.TYPE_REASON]


def test_reasons_add_up(spark):
    assert set(comments(spark, (None, "a"), (None, "a"))) == {checks.NULL_REASON + checks.DUPLICATE_REASON}


def test_null_equals_tilde_in_the_derived_key(spark):
    assert one(spark, derived_key([F.lit(None)])) == one(spark, derived_key([F.lit("~")]))
    assert one(spark, derived_key([])) == one(spark, F.md5(F.lit("~")))


def test_blank_unchecked_key_becomes_null(spark):
    spec = TabSpec("t", (Key("K", "ID", "bigint", False),))
    _, curated = flows.ingest_tab(tab(spark, ("  ", "a")), spec, F.lit("2024-01-01").cast("timestamp_ntz"))
    assert curated.first()["ID"] is None


def test_good_and_bad_part_the_rows(spark):
    df = checked(spark, ("1", "a"), ("x", "a"), (None, None), ("1", "b"), ("1", "b"))
    assert checks.good(df).count() + checks.bad(df).count() == 5
    counts = checks.dq_counts(df, flows.SCOPE).first()
    assert (counts["total"], counts["dup"], counts["nul"], counts["dty"], counts["bad"], counts["valid"]) == (5, 2, 1, 1, 4, 1)


def test_report_of_unchecked_and_full_loads(spark):
    counts = checks.dq_counts(checked(spark, ("1", "a")), flows.SCOPE)
    unchecked = counts.select(checks.dq_report(F.lit(True), F.lit(False)).alias("r")).first()["r"]
    assert unchecked[1] == "Not Null PK Check : SKIPPED | is_nullable=false for all PK columns"
    assert counts.select(checks.dq_report(F.lit(False), F.lit(True)).alias("r")).first()["r"][2] == "Data Type Check : SKIPPED | load_type_delta=false"


def test_full_load_folds_all_columns(spark):
    spec = TabSpec("t", (), False)
    _, curated = flows.ingest_tab(tab(spark, ("1", None)), spec, F.lit(None).cast("timestamp_ntz"))
    r = curated.first()
    assert (r["DATA"], r["DATA_KEYS"]) == ('{"K":"1","L":null,"V":"v"}', '["K","L","V"]')


def test_missing_key_column_is_told(spark):
    with pytest.raises(ValueError, match="ABSENT"):
        flows.ingest_tab(tab(spark, ("1", "a")), TabSpec("t", (Key("ABSENT", "A"),)), F.lit(None))


def test_error_record_drops_nulls_and_data_keeps_them(spark):
    bad = checks.bad(checked(spark, ("x", None)))
    r = quarantine.error_rows(bad, SPEC, F.lit("run"), F.col("file_name"), F.col("sheet_tab_name"), F.lit("/p"), F.lit(None).cast("timestamp")).first()
    assert "PLACE" not in r["err_record"] and '"ID":"x"' in r["err_record"]
    assert (r["pk_value"], r["error_category"]) == ("ID=x", "PK datatype mismatch")
    assert one(spark, F.to_json(F.struct(F.lit(None).cast("string").alias("a")), {"ignoreNullFields": "false"})) == '{"a":null}'


@pytest.mark.parametrize("given, told", [
    (["A", "B", "A", None, "", "A"], ["A", "B", "A_1", "col_3", "col_4", "A_2"]),
    (["A", "A", "A_1"], ["A", "A_1", "A_1_1"]),
    ([" x ", "X"], ["x", "X_1"]),
    ([], []),
])
def test_header_names(spark, given, told):
    df = rows(spark, [(given,)], "c array<string>")
    assert df.select(header_names(F.col("c")).alias("h")).first()["h"] == told


@pytest.mark.parametrize("kind, value, told", [
    ("s", None, None), ("b", "1", "true"), ("b", "0", "false"), ("n", "12345.0", "12345"), ("n", "1.5", "1.5"),
    ("n", "12345678.5", "12345678.5"), ("n", "0.0005", "0.0005"), ("s", "", None), ("s", " x ", " x "),
])
def test_cell_text(spark, kind, value, told):
    assert one(spark, cell_text(F.lit(value).cast("string"), F.lit(kind))) == told


@pytest.mark.parametrize("name, prefix, batch", [
    ("Feed_2026.06.10.xlsx", "Feed", "20260610000000"), ("Feed.2026.06.01.12.32.29.xlsx", "Feed", "20260601123229"),
    ("Feed.xlsx", "Feed", None), ("A_2024.01.02_2025.01.02.xlsx", "A", "20240102000000"), ("A_2024.13.41.xlsx", "A", "20241341000000"),
])
def test_file_meta(spark, name, prefix, batch):
    m = one(spark, file_meta(F.lit(name)))
    assert (m["file_name_prefix"], m["batch_id"]) == (prefix, batch)


def test_safe_tab_name(spark):
    assert one(spark, safe_tab_name(F.lit("a/b:c[1]" + "x" * 40), "f")) == ("a_b_c_1_" + "x" * 40)[:31]
    assert one(spark, safe_tab_name(F.lit(""), "f")) == "f" == one(spark, safe_tab_name(F.lit(None).cast("string"), "f"))


def test_tolerant_timestamp(spark):
    at = dt.datetime(2015, 3, 2)
    for text in ("2015-03-02 00:00:00.000000", "15-03-02 00:00:00.000000", "2015-03-02"):
        assert one(spark, tolerant_timestamp(F.lit(text))) == at
    assert one(spark, tolerant_timestamp(F.lit("soon"))) is None


def test_grids_survive_a_workbook(spark):
    data = [("a.xlsx", t, i, c) for t in ("T<1>", "U & co") for i, c in enumerate([["b"], ["K", None, "é"], [" 1 ", "", "x\ny"]])]
    grid = rows(spark, data, grids.GRID)
    raw = grids.decode_grids(grids.encode_grids(grid))
    got = sorted(tuple(r) for r in grids.text_grid(raw).collect())
    assert [(t, i, c) for _, t, i, c in got] == [("T<1>", 0, ["b"]), ("T<1>", 1, ["K", None, "é"]), ("T<1>", 2, [" 1 ", None, "x\ny"]), ("U & co", 0, ["b"]), ("U & co", 1, ["K", None, "é"]), ("U & co", 2, [" 1 ", None, "x\ny"])]


def test_unreadable_file_is_a_row(spark):
    files = rows(spark, [("bad.xlsx", bytearray(b"no zip"))], "file_name string, content binary")
    raw = grids.decode_grids(files)
    assert grids.unreadable(raw).first()["file_name"] == "bad.xlsx" and grids.text_grid(raw).count() == 0


@pytest.mark.parametrize("sheet, n, void", [
    ([["b"]], 0, True), ([["b"], ["report STATUS"], ["No Results"]], 0, True), ([["b"], ["K"]], 0, True), ([["b"], ["K"], ["1"]], 1, False),
])
def test_no_data(spark, sheet, n, void):
    grid = rows(spark, [("a", "T", i, c) for i, c in enumerate(sheet)], grids.GRID)
    r = grids.tab_counts(grid).first()
    assert (r["n_rows"], r["no_data"]) == (n, void)


def test_rows_are_padded_and_cut(spark):
    grid = rows(spark, [("a", "T", i, c) for i, c in enumerate([["b"], ["K", "L"], ["1"], ["1", "2", "3"]])], grids.GRID)
    assert [r["values"] for r in grids.promoted(grid).orderBy("row_idx").collect()] == [["1", None], ["1", "2"]]


def test_latest_batch_of_nothing(spark):
    df = rows(spark, [], "FILE_DTTM timestamp, x int")
    assert fold.latest_batch(df).count() == 0


def test_keys_come_from_the_newest_row_that_has_them(spark):
    df = rows(spark, [(dt.datetime(2024, 1, 1), '["a"]'), (dt.datetime(2024, 1, 2), '["b","c d"]'), (dt.datetime(2024, 1, 3), None)], "FILE_DTTM timestamp, DATA_KEYS string")
    assert fold.discovered_keys(df) == ["b", "c d"]
    assert fold.discovered_keys(df.limit(0)) == []


def test_unfold_odd_keys_and_values(spark):
    df = rows(spark, [(1, '{"a b":"x","c.d":null,"n":1.5,"o":{"p":1}}')], "ID bigint, DATA string")
    spec = TabSpec("t", (Key("ID", "ID", "bigint"),))
    assert tuple(fold.unfolded(df, spec, ["a b", "c.d", "n", "o", "gone"]).first()) == (1, "x", None, "1.5", '{"p":1}', None)
    with pytest.raises(ValueError):
        fold.unfolded(df, TabSpec("t", (), False), [])
    with pytest.raises(ValueError, match="DATA_KEYS"):
        fold.checked_contract(df, spec)


def test_latest_control_breaks_ties(spark):
    at = dt.datetime(2024, 1, 1)
    df = rows(spark, [("t", "a", at), ("t", "b", at), ("u", "a", at)], "table_name string, process_id string, _az_insert_ts timestamp")
    assert sorted((r["table_name"], r["process_id"]) for r in control.latest(df).collect()) == [("t", "b"), ("u", "a")]


def test_short_reason(spark):
    assert one(spark, control.short_reason(F.lit("Missing ['A']. Sheet columns: x -> y"))) == "Missing ['A']"


def test_windows_cover_each_key_once(spark):
    source = spark.range(7, 1007).withColumnRenamed("id", "k")
    plan = bulkload.plan_windows(source, "k", 13, "c").collect()
    assert len(plan) == 13 and sum(bulkload.read_window(source, "k", w["lo"], w["hi"]).count() for w in plan) == 1000
    assert bulkload.plan_windows(source.limit(0), "k", 13, "c").count() == 0


def test_window_bounds_reach_the_scan(spark, sf):
    plan = bulkload.read_window(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderkey", 10, 20)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10), LessThanOrEqual(o_orderkey,20)]" in plan


def test_load_resumes_and_stops(spark, tmp_path):
    source = rows(spark, [(i,) for i in range(1, 101)], "k bigint")
    plan = bulkload.plan_windows(source, "k", 4, "c")
    done = plan.withColumn("status", F.when(F.col("window_id") == 0, "done").otherwise("pending"))
    target, states = flows.windowed_load(source, source.where("k <= 25"), done, "k", str(tmp_path))
    assert target.count() == 100 and [r["status"] for r in states.orderBy("window_id").collect()] == ["done"] * 4
    twice, states = flows.windowed_load(source, source.where("k = 30").union(source.where("k = 30")), plan.where("window_id > 0"), "k", str(tmp_path / "twice"))
    assert [r["status"] for r in states.orderBy("window_id").collect()] == ["pending"] * 3


def test_load_survives_a_lost_driver(spark, tmp_path, monkeypatch):
    source = rows(spark, [(i,) for i in range(1, 101)], "k bigint")
    plan, read = bulkload.plan_windows(source, "k", 4, "c"), bulkload.read_window

    def failing(df, key, lo, hi):
        if lo >= 50:
            raise RuntimeError("lost")
        return read(df, key, lo, hi)

    monkeypatch.setattr(bulkload, "read_window", failing)
    with pytest.raises(RuntimeError):
        flows.windowed_load(source, source.limit(0), plan, "k", str(tmp_path))
    seen = []
    monkeypatch.setattr(bulkload, "read_window", lambda df, key, lo, hi: seen.append(lo) or read(df, key, lo, hi))
    target, states = flows.windowed_load(source, source.limit(0), plan, "k", str(tmp_path))
    assert set(seen) == {50, 75} and sorted(r["k"] for r in target.collect()) == list(range(1, 101)) and not flows.more_pending(states)


@pytest.mark.parametrize("name", ["COMMENTS", "pk_derived", "_null", "_Dup", "_type"])
def test_reserved_columns_are_rejected(spark, name):
    with pytest.raises(ValueError, match=name):
        flows.ingest_tab(tab(spark, ("1", "a")).withColumn(name, F.lit("own")), SPEC, F.lit(None).cast("timestamp_ntz"))


def test_table_lookup(spark):
    schema = "serial_number bigint, file_name_prefix string, sheet_tab_name string, table_name string, sheet_column_name string, original_column_name string, array_column_name string, data_type string, is_primary_key boolean"
    df = rows(spark, [(2, "P", "T", "Tab", "K", None, None, "BIGINT", True), (1, "P", "U", "tab", "L", "M", "", "int", True), (3, "P", "V", "other", "K", None, None, "int", True)], schema)
    with pytest.warns(UserWarning, match="2 tabs"):
        assert registry.table_spec(df, "TAB") == (TabSpec("tab", (Key("L", "M", "int", True),)), "P", "U")
    assert registry.table_spec(df, "other")[0].keys[0].name == "K" and registry.table_spec(df, "none") is None


def test_export_path_and_banner():
    at = dt.datetime(2024, 2, 1, 14, 5, 9)
    assert sinks.export_path("/b/", "t", "Feed", at) == "/b/t/2024/02/01/14/Feed_REGEN_20240201_140509"
    assert sinks.banner_text("Feed", at) == "Feed 02/01/2024 02:05 PM"


def test_long_sheets_go_into_more_workbooks(spark):
    data = [("a.xlsx", t, i, [str(i)]) for t in ("T", "U") for i in range(25)]
    books = grids.encode_grids(rows(spark, data, grids.GRID), 10)
    assert books.count() == 6
    assert sorted(tuple(r) for r in grids.text_grid(grids.decode_grids(books)).collect()) == data


def test_seeded_registry_gives_its_specs(spark):
    tabs = {("P", "T"): SPEC, ("P", "Full"): TabSpec("full", (), False)}
    known = registry.seeded(spark, tabs)
    assert all(registry.tab_spec(known, *at) == spec for at, spec in tabs.items())


def test_window_predicates_part_the_keys(spark):
    source = spark.range(0, 500).withColumnRenamed("id", "k")
    for lo, hi, parts in ((10, 300, 64), (5, 8, 64), (0, 100, 1)):
        wheres = bulkload.window_predicates("k", lo, hi, parts)
        assert len(wheres) == min(parts, hi - lo) and sorted(r["k"] for w in wheres for r in source.where(w).collect()) == list(range(lo + 1, hi + 1))


def test_latest_partition_by_frequency(spark):
    df = rows(spark, [("2024", "02", "01"), ("2024", "02", "03"), ("2024", "01", "09"), ("2023", "12", "31")], "y string, m string, d string")
    count = lambda *f: grids.latest_partition(df, ["y", "m", "d"], *f).count()
    assert (count("monthly"), count("daily"), count("hourly"), count("other"), count()) == (3, 2, 1, 2, 1)


def test_merge_modes(spark):
    old, new = rows(spark, [(1, "o"), (2, "o")], "k int, v string"), rows(spark, [(2, "n"), (3, "n")], "k int, v string")
    assert sorted(map(tuple, bulkload.merge_upsert(old, new, ["k"]).collect())) == [(1, "o"), (2, "n"), (3, "n")]
    assert sorted(map(tuple, bulkload.merge_insert_only(old, new, ["k"]).collect())) == [(1, "o"), (2, "o"), (3, "n")]
    assert bulkload.merge_upsert(old, new.limit(0), ["k"]).count() == 2


def test_sheet_limit(spark):
    with pytest.raises(ValueError):
        sinks.capped(spark.range(11), 10)
    assert sinks.capped(spark.range(10), 10).count() == 10


def test_registry_flags_default_to_true(spark):
    df = rows(spark, [(1, "P", "T", "Tab", "K", None, None, "BIGINT", True)], "serial_number bigint, file_name_prefix string, sheet_tab_name string, table_name string, sheet_column_name string, original_column_name string, array_column_name string, data_type string, is_primary_key boolean")
    assert registry.tab_spec(df, "P", "T") == TabSpec("tab", (Key("K", "K", "bigint", True),), True, "DATA")
    assert registry.tab_spec(df, "P", "other") is None


def test_streamed_landing(spark, tmp_path):
    from gridloom.streaming import landing

    grid = rows(spark, [("a.xlsx", "T", i, ["1"]) for i in range(3)], grids.GRID)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xlsx").write_bytes(bytes(grids.encode_grids(grid).first()["content"]))
    seen = []
    for _ in range(2):
        landing.start(landing.stream_files(spark, str(tmp_path / "in")), lambda df, n: seen.append(df.count()), str(tmp_path / "ck"), once=True).awaitTermination(60)
    assert sum(seen) == 3
