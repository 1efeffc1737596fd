"""The registered queries of the ingestion library, over whole tables, and their SQL.

The given tables play the feeds: `orders` one table's tabs by year and priority, with faults put in by expression;
`events` a batch of many tabs by day and type; `lineitem` a key with natural duplicates. What stands for them is SQL text
that both engines read.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cell_text, derived_key, file_meta, full_row_key, safe_tab_name, tolerant_timestamp
from ..operators import bulkload, checks, control, fold, quarantine, registry
from ..operators.registry import Key, TabSpec
from ..sources import grids, sinks
from . import flows

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations")
RUN = "run-1"
INSERTED = "2024-02-01 00:00:00"

# Keys missing, blank, mistyped or repeated, by expression.
ORDERS = """
SELECT 'Orders_' || substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4) || '.01.01.xlsx' AS file_name, o_orderpriority AS sheet_tab_name,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN '  ' WHEN o_orderkey % 89 = 0 THEN 'x' || CAST(o_orderkey AS STRING)
       WHEN o_orderkey % 53 = 0 THEN CAST(o_orderkey % 7 AS STRING) WHEN o_orderkey % 59 = 0 THEN ' ' || CAST(o_orderkey AS STRING) || ' ' ELSE CAST(o_orderkey AS STRING) END AS ORDER_KEY,
  CASE WHEN o_custkey % 211 = 0 THEN NULL ELSE CAST(o_custkey % 5 AS STRING) END AS REGION,
  o_orderstatus AS STATUS, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING) AS TOTAL, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ODATE,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS PRIORITY
FROM {orders}"""
SPEC = TabSpec("orders_feed", (Key("ORDER_KEY", "ORDER_ID", "bigint", True), Key("REGION", "REGION_ID", "int", False)))
FULL = TabSpec("orders_full", (), False)

FEED = """
SELECT 'Feed_' || replace(CAST(CAST(ts AS DATE) AS STRING), '-', '.') || '.xlsx' AS file_name, event_type AS sheet_tab_name, event_id,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'x' ELSE CAST(event_id % 997 AS STRING) END AS USER_KEY,
  CAST(CAST(value AS DECIMAL(18, 2)) AS STRING) AS AMOUNT, props AS PROPS, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS NOTE
FROM {events}"""

# A tab `error` that isn't configured, one (`click`) that is a full load, one (`signup`) whose key column is missing.
REGISTRY = """
SELECT CAST(10 * row_number() OVER (ORDER BY event_type) AS BIGINT) AS serial_number, 'batch-1' AS batch_id, 'Feed' AS file_name_prefix, event_type AS sheet_tab_name,
  CASE WHEN event_type IN ('view', 'purchase') THEN 'Feed_Shared' ELSE 'feed_' || event_type END AS table_name,
  CASE WHEN event_type = 'signup' THEN 'ABSENT' ELSE 'USER_KEY' END AS sheet_column_name, CASE WHEN event_type = 'view' THEN 'USER_ID' END AS original_column_name, 'DATA' AS array_column_name,
  'BIGINT' AS data_type, TRUE AS is_primary_key, CASE WHEN event_type = 'purchase' THEN FALSE END AS is_nullable, CASE WHEN event_type = 'click' THEN FALSE END AS load_type_delta
FROM (SELECT DISTINCT event_type FROM {events}) t WHERE event_type <> 'error'"""
REGISTRY_WIDE = f"""
SELECT * FROM ({REGISTRY}) a
UNION ALL SELECT serial_number - 1, batch_id, file_name_prefix, sheet_tab_name, table_name, 'AMOUNT', NULL, array_column_name, 'string', TRUE, is_nullable, load_type_delta FROM ({REGISTRY}) b WHERE sheet_tab_name <> 'view'
UNION ALL SELECT serial_number + 1, batch_id, file_name_prefix, sheet_tab_name, table_name, 'NOTE', NULL, array_column_name, 'string', FALSE, is_nullable, load_type_delta FROM ({REGISTRY}) c"""

CURATED = """
SELECT md5(CAST(event_id AS STRING)) AS PK_DERIVED, event_id AS EVENT_ID, props AS DATA, CASE WHEN event_id % 3 = 0 THEN NULL ELSE '["k","EVENT_ID","absent"]' END AS DATA_KEYS,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS FILE_DTTM, event_type AS table_name
FROM {events}"""
EVENT_SPEC = TabSpec("events_feed", (Key("EVENT_ID", "EVENT_ID", "bigint"),))

CONTROL = f"""
SELECT CASE WHEN file_name < 'Feed_2024.01.16.xlsx' THEN 'run-1' ELSE 'run-2' END AS execution_id, md5(file_name || sheet_tab_name) AS process_id, file_name, sheet_tab_name, 'feed_' || sheet_tab_name AS table_name,
  count(*) AS source_row_count, CASE WHEN sheet_tab_name = 'view' THEN NULL ELSE count(*) - count(CASE WHEN USER_KEY = 'x' THEN 1 END) END AS valid_record_count, count(CASE WHEN USER_KEY = 'x' THEN 1 END) AS error_record_count,
  CASE WHEN count(CASE WHEN USER_KEY = 'x' THEN 1 END) > 0 THEN 'Failed' ELSE 'Succeeded' END AS final_ingestion_status,
  CASE WHEN count(CASE WHEN USER_KEY = 'x' THEN 1 END) > 0 THEN 'bad keys: ' || CAST(count(CASE WHEN USER_KEY = 'x' THEN 1 END) AS STRING) || '. Sheet columns: many -> err_table' ELSE 'ok' END AS comments,
  CAST(max(d) AS TIMESTAMP) AS _az_insert_ts
FROM (SELECT f.*, substr(file_name, 6, 4) || '-' || substr(file_name, 11, 2) || '-' || CASE WHEN substr(file_name, 14, 2) > '20' THEN '20' ELSE substr(file_name, 14, 2) END AS d FROM ({FEED}) f) g
GROUP BY file_name, sheet_tab_name"""

QUERIES: dict = {}
SQL: dict[str, str] = {}


def sql_text(text: str) -> str:
    return text.format(**{t: t for t in TABLES})


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql_text(sql)
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def made(spark: SparkSession, sf: str, text: str) -> DataFrame:
    """A DataFrame of SQL text over the given tables."""
    return spark.sql(text, **{t: table(spark, sf, t) for t in TABLES if "{" + t + "}" in text})


def ntz(text: str = INSERTED):
    return F.lit(text).cast("timestamp_ntz")


def shared(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/gridloom-{uuid.uuid4().hex}"


# ---- keys, checks, folding, over one table's tabs -------------------------------------------------------------------

KEYED = f"""SELECT *, md5(coalesce(ORDER_KEY, '~') || '!@~' || coalesce(REGION, '~') || '!@~' || '~') AS PK_DERIVED,
  (ORDER_KEY IS NULL OR trim(ORDER_KEY) = '') AS f_null,
  coalesce(trim(ORDER_KEY) <> '' AND NOT regexp_full_match(trim(ORDER_KEY), '[+-]?[0-9]+'), false) OR coalesce(trim(REGION) <> '' AND NOT regexp_full_match(trim(REGION), '[+-]?[0-9]+'), false) AS f_type
FROM ({ORDERS}) o"""
CHECKED = f"""SELECT *, (CASE WHEN f_null THEN 'Mandatory PK field is NULL || ' ELSE '' END) || (CASE WHEN f_type THEN 'PK datatype mismatch || ' ELSE '' END) || (CASE WHEN f_dup THEN 'Duplicate Primary Key || ' ELSE '' END) AS COMMENTS
FROM (SELECT *, count(*) OVER (PARTITION BY file_name, sheet_tab_name, PK_DERIVED) > 1 AS f_dup FROM ({KEYED}) k) c"""
FOLDED = "to_json({{'STATUS': STATUS, 'TOTAL': TOTAL, 'ODATE': ODATE, 'PRIORITY': PRIORITY}})::VARCHAR"
DATA_KEYS = '["STATUS","TOTAL","ODATE","PRIORITY"]'
FILE_TIME = "CAST(substr(file_name, 8, 4) || '-01-01' AS TIMESTAMP)"
CURATED_ORDERS = f"""SELECT PK_DERIVED, CAST(trim(ORDER_KEY) AS BIGINT) AS ORDER_ID, CAST(REGION AS INT) AS REGION_ID, {FOLDED} AS DATA, '{DATA_KEYS}' AS DATA_KEYS,
  {FILE_TIME} AS FILE_DTTM, file_name AS AZ_INPUT_XLS_FILE_NAME, sheet_tab_name AS AZ_INPUT_XLS_TAB_NAME, TIMESTAMP '{INSERTED}' AS _AZ_INSERT_TS
FROM ({CHECKED}) v WHERE COMMENTS = ''"""


def orders_tab(spark: SparkSession, sf: str) -> DataFrame:
    return made(spark, sf, ORDERS)


def orders_checked(spark: SparkSession, sf: str) -> DataFrame:
    return checks.validated(checks.renamed(orders_tab(spark, sf), SPEC), SPEC, flows.SCOPE)


KEYS = ["file_name", "sheet_tab_name", "ORDER_ID", "REGION_ID", "PK_DERIVED"]
SQL_KEYS = "file_name, sheet_tab_name, ORDER_KEY AS ORDER_ID, REGION AS REGION_ID, PK_DERIVED"


@query(f"SELECT ORDER_KEY AS ORDER_ID, REGION AS REGION_ID, STATUS, TOTAL, ODATE, PRIORITY, file_name, sheet_tab_name FROM ({ORDERS}) o")
def registry_rename(spark, sf):
    return checks.renamed(orders_tab(spark, sf), SPEC)


@query("SELECT l_orderkey, l_linenumber, md5(CAST(l_orderkey AS STRING) || '!@~' || CAST(l_linenumber AS STRING) || '!@~' || '~') AS PK_DERIVED FROM {lineitem}")
def derived_key_(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", derived_key([F.col("l_orderkey"), F.col("l_linenumber")]).alias("PK_DERIVED"))


@query("SELECT c_custkey, md5(CAST(c_custkey AS STRING) || '!@~' || coalesce(c_name, '~') || '!@~' || CAST(c_nationkey AS STRING) || '!@~' || coalesce(c_mktsegment, '~') || '!@~' || 'Customers.xlsx' || '!@~' || 'All') AS PK_DERIVED FROM {customer}")
def full_row_key_(spark, sf):
    columns = [F.col(c) for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")]
    return table(spark, sf, "customer").select("c_custkey", full_row_key(columns, F.lit("Customers.xlsx"), F.lit("All")).alias("PK_DERIVED"))


@query(f"SELECT {SQL_KEYS}, f_null AS is_null FROM ({KEYED}) k")
def pk_null_check(spark, sf):
    return orders_checked(spark, sf).select(*KEYS, F.col("_null").alias("is_null"))


@query(f"SELECT {SQL_KEYS}, f_type AS mismatch FROM ({KEYED}) k")
def pk_type_check(spark, sf):
    return orders_checked(spark, sf).select(*KEYS, F.col("_type").alias("mismatch"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicate FROM {lineitem}")
def pk_duplicate_check(spark, sf):
    return checks.with_duplicate_flag(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], "duplicate")


@query(f"SELECT {SQL_KEYS}, COMMENTS FROM ({CHECKED}) c")
def pk_comments(spark, sf):
    return orders_checked(spark, sf).select(*KEYS, "COMMENTS")


@query(f"SELECT {SQL_KEYS}, STATUS, TOTAL FROM ({CHECKED}) c WHERE COMMENTS = ''")
def good_rows(spark, sf):
    return checks.good(orders_checked(spark, sf)).select(*KEYS, "STATUS", "TOTAL")


@query(f"SELECT {SQL_KEYS}, STATUS, TOTAL, COMMENTS FROM ({CHECKED}) c WHERE COMMENTS <> ''")
def bad_rows(spark, sf):
    return checks.bad(orders_checked(spark, sf)).select(*KEYS, "STATUS", "TOTAL", "COMMENTS")


COUNTS = f"""SELECT file_name, sheet_tab_name, count(*) AS total, count(*) FILTER (f_dup) AS dup, count(*) FILTER (f_null) AS nul, count(*) FILTER (f_type) AS dty,
  count(*) FILTER (COMMENTS <> '') AS bad, count(*) FILTER (COMMENTS = '') AS valid FROM ({CHECKED}) c GROUP BY file_name, sheet_tab_name"""


@query(COUNTS)
def dq_counts(spark, sf):
    return checks.dq_counts(orders_checked(spark, sf), flows.SCOPE)


def _line(title, column, what):
    return f"'{title} : ' || (CASE WHEN {column} = 0 THEN 'PASS' ELSE 'FAIL' END) || ' | {what}=' || {column}::VARCHAR"


@query(f"""SELECT file_name, sheet_tab_name, {_line('Duplicate PK Check', 'dup', 'duplicate_records')} AS duplicates, {_line('Not Null PK Check', 'nul', 'null_records')} AS nulls,
  {_line('Data Type Check', 'dty', 'mismatch_records')} AS types FROM ({COUNTS}) c""")
def dq_report(spark, sf):
    lines = checks.dq_counts(orders_checked(spark, sf), flows.SCOPE).withColumn("r", checks.dq_report(F.lit(True), F.lit(True)))
    return lines.select(*flows.SCOPE, F.col("r")[0].alias("duplicates"), F.col("r")[1].alias("nulls"), F.col("r")[2].alias("types"))


@query(f"""SELECT file_name, sheet_tab_name, count(*) AS total, 'Duplicate PK Check : SKIPPED | load_type_delta=false' AS duplicates, 'Not Null PK Check : SKIPPED | load_type_delta=false' AS nulls,
  'Data Type Check : SKIPPED | load_type_delta=false' AS types, 'PK validation skipped (load_type_delta=false) - full load ingested.' AS comments FROM ({ORDERS}) o GROUP BY file_name, sheet_tab_name""")
def dq_full_load(spark, sf):
    """Count and report of tabs that are loaded as a whole, without checks."""
    counts = checks.dq_counts(checks.validated(orders_tab(spark, sf), FULL, flows.SCOPE), flows.SCOPE)
    told = control.outcome(counts, F.lit(FULL.delta), F.lit(FULL.table)).withColumn("r", checks.dq_report(F.lit(FULL.delta), F.lit(False)))
    return told.select(*flows.SCOPE, "total", F.col("r")[0].alias("duplicates"), F.col("r")[1].alias("nulls"), F.col("r")[2].alias("types"), "comments")


@query(f"""SELECT file_name, sheet_tab_name, total, bad, CASE WHEN bad > 0 THEN 'Failed' ELSE 'Succeeded' END AS final_ingestion_status,
  CASE WHEN bad > 0 THEN bad::VARCHAR || ' record(s) failed PK validation. Good records (' || valid::VARCHAR || ') written to orders_feed.' ELSE 'All primary-key checks passed.' END AS comments FROM ({COUNTS}) c""")
def tab_outcome(spark, sf):
    counts = checks.dq_counts(orders_checked(spark, sf), flows.SCOPE)
    return control.outcome(counts, F.lit(True), F.lit(SPEC.table)).select(*flows.SCOPE, "total", "bad", "final_ingestion_status", "comments")


@query(f"SELECT file_name, sheet_tab_name, ORDER_KEY, {FOLDED} AS DATA FROM ({ORDERS}) o")
def fold_json(spark, sf):
    return orders_tab(spark, sf).select(*flows.SCOPE, "ORDER_KEY", fold.folded(["STATUS", "TOTAL", "ODATE", "PRIORITY"]).alias("DATA"))


@query("SELECT doc_id, to_json({{'text': text, 'lang': lang}})::VARCHAR AS DATA FROM {documents}")
def fold_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fold.folded(["text", "lang"]).alias("DATA"))


@query(f"SELECT file_name, sheet_tab_name, ORDER_KEY, to_json({{{{'ODATE': ODATE, 'PRIORITY': PRIORITY, 'STATUS': STATUS, 'TOTAL': TOTAL}}}})::VARCHAR AS DATA FROM ({ORDERS}) o")
def fold_variant(spark, sf):
    data = F.parse_json(fold.folded(["STATUS", "TOTAL", "ODATE", "PRIORITY"]))
    return orders_tab(spark, sf).select(*flows.SCOPE, "ORDER_KEY", data.cast("string").alias("DATA"))


@query(f"SELECT file_name, sheet_tab_name, '{DATA_KEYS}' AS DATA_KEYS, count(*) AS n FROM ({ORDERS}) o GROUP BY file_name, sheet_tab_name")
def data_keys(spark, sf):
    keyed = orders_tab(spark, sf).withColumn("DATA_KEYS", fold.keys_json(["STATUS", "TOTAL", "ODATE", "PRIORITY"]))
    return keyed.groupBy(*flows.SCOPE, "DATA_KEYS").agg(F.count("*").alias("n"))


@query(CURATED_ORDERS)
def curated_rows(spark, sf):
    return flows.ingest_tab(orders_tab(spark, sf), SPEC, ntz())[1]


@query("""SELECT total, dup, dup_keys, valid FROM (
  SELECT count(*) AS total, count(*) FILTER (n > 1) AS dup, count(DISTINCT CASE WHEN n > 1 THEN k END) AS dup_keys, count(*) FILTER (n = 1) AS valid
  FROM (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM (SELECT l_orderkey::VARCHAR || '/' || l_linenumber::VARCHAR AS k FROM {lineitem}) a) b) c""")
def ingest_tab(spark, sf):
    """The whole chain, counted from the tables that it wrote."""
    base, _ = lines_ingested(spark, sf)
    good = lines_curated(spark, base).select(F.col("PK_DERIVED").alias("k"), F.lit(True).alias("good"))
    every = good.unionAll(spark.read.parquet(f"{base}/errors/lines/{RUN}").select("pk_derived", F.lit(False)))
    bad = ~F.col("good")
    return every.agg(F.count("*").alias("total"), F.count_if(bad).alias("dup"), F.count_distinct(F.when(bad, F.col("k"))).alias("dup_keys"), F.count_if("good").alias("valid"))


LINES_SPEC = TabSpec("lines", (Key("l_orderkey", "l_orderkey", "bigint"), Key("l_linenumber", "l_linenumber", "int")))


def lines_ingested(spark, sf) -> tuple[str, DataFrame]:
    """lineitem through the whole chain: where its tables are, and the control row."""
    rows = table(spark, sf, "lineitem").select(F.lit("Lines.xlsx").alias("file_name"), F.lit("All").alias("sheet_tab_name"), *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")])
    base = shared(spark)
    return base, flows.ingest_chain(rows, LINES_SPEC, base, RUN, ntz(), F.lit("/landing"))


def lines_curated(spark, base) -> DataFrame:
    return flows.read_written(spark, f"{base}/curated/lines", flows.curated_columns([(k.name, k.type) for k in LINES_SPEC.keys], [LINES_SPEC.data_column]))


LINES = """SELECT md5(CAST(l_orderkey AS STRING) || '!@~' || CAST(l_linenumber AS STRING) || '!@~' || '~') AS PK_DERIVED, l_orderkey, CAST(l_linenumber AS INT) AS l_linenumber,
  to_json({{{{'l_partkey': CAST(l_partkey AS STRING), 'l_returnflag': l_returnflag}}}})::VARCHAR AS DATA, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM {{lineitem}}""".replace("{{", "{").replace("}}", "}")


@query(f"SELECT PK_DERIVED, l_orderkey, l_linenumber, DATA FROM ({LINES}) a WHERE n = 1")
def ingest_tab_curated(spark, sf):
    base, _ = lines_ingested(spark, sf)
    return lines_curated(spark, base).select("PK_DERIVED", "l_orderkey", "l_linenumber", "DATA")


@query(f"""SELECT 'run-1' AS execution_id, md5('run-1|Lines.xlsx|All') AS process_id, 'lines' AS table_name, count(*) AS source_row_count, count(*) FILTER (n = 1) AS valid_record_count, count(*) FILTER (n > 1) AS error_record_count,
  CASE WHEN count(*) FILTER (n > 1) > 0 THEN 'Failed' ELSE 'Succeeded' END AS final_ingestion_status, TIMESTAMP '{INSERTED}' AS _az_insert_ts FROM ({LINES}) a""")
def ingest_tab_control(spark, sf):
    rows = lines_ingested(spark, sf)[1]
    return rows.select("execution_id", "process_id", "table_name", "source_row_count", "valid_record_count", "error_record_count", "final_ingestion_status", "_az_insert_ts")


@query(f"""SELECT md5(coalesce(ORDER_KEY, '~') || '!@~' || coalesce(REGION, '~') || '!@~' || coalesce(STATUS, '~') || '!@~' || TOTAL || '!@~' || ODATE || '!@~' || coalesce(PRIORITY, '~') || '!@~' || file_name || '!@~' || sheet_tab_name) AS PK_DERIVED,
  to_json({{{{'ORDER_KEY': ORDER_KEY, 'REGION': REGION, 'STATUS': STATUS, 'TOTAL': TOTAL, 'ODATE': ODATE, 'PRIORITY': PRIORITY}}}})::VARCHAR AS DATA, '["ORDER_KEY","REGION","STATUS","TOTAL","ODATE","PRIORITY"]' AS DATA_KEYS, file_name AS AZ_INPUT_XLS_FILE_NAME FROM ({ORDERS}) o""")
def ingest_full_load(spark, sf):
    return flows.ingest_tab(orders_tab(spark, sf), FULL, ntz())[1].select("PK_DERIVED", "DATA", "DATA_KEYS", "AZ_INPUT_XLS_FILE_NAME")


ERROR_JSON = "'{{' || concat_ws(',', '\"file_name\":\"' || file_name || '\"', '\"sheet_tab_name\":\"' || sheet_tab_name || '\"', '\"ORDER_ID\":\"' || ORDER_KEY || '\"', '\"REGION_ID\":\"' || REGION || '\"', '\"STATUS\":\"' || STATUS || '\"', '\"TOTAL\":\"' || TOTAL || '\"', '\"ODATE\":\"' || ODATE || '\"', '\"PRIORITY\":\"' || PRIORITY || '\"', '\"PK_DERIVED\":\"' || PK_DERIVED || '\"', '\"COMMENTS\":\"' || COMMENTS || '\"') || '}}'"
QUARANTINE = f"""SELECT md5('{RUN}' || '|' || file_name || '|' || sheet_tab_name) AS process_id, '{RUN}' AS execution_id, file_name, 'orders_feed' AS table_name, sheet_tab_name, '/landing' AS file_path,
  regexp_replace(COMMENTS, '\\s*\\|\\|\\s*$', '') AS error_category,
  'Record rejected during primary-key validation. Reason(s): ' || regexp_replace(COMMENTS, '\\s*\\|\\|\\s*$', '') || '. Primary key -> ' || concat_ws(' | ', 'ORDER_ID=' || ORDER_KEY, 'REGION_ID=' || REGION) || '. Derived key = ' || PK_DERIVED || '. This record was NOT ingested into the curated dataset.' AS error_description,
  concat_ws(' | ', 'ORDER_ID=' || ORDER_KEY, 'REGION_ID=' || REGION) AS pk_value, PK_DERIVED AS pk_derived, {ERROR_JSON} AS err_record, COMMENTS AS comments, TIMESTAMP '{INSERTED}' AS az_insert_ts
FROM ({CHECKED}) c WHERE COMMENTS <> ''"""


def quarantined(spark, sf):
    bad = checks.bad(orders_checked(spark, sf))
    return quarantine.error_rows(bad, SPEC, F.lit(RUN), F.col("file_name"), F.col("sheet_tab_name"), F.lit("/landing"), ntz())


@query(QUARANTINE)
def quarantine_rows(spark, sf):
    return quarantined(spark, sf)


@query(f"SELECT file_name, pk_derived, error_category FROM ({QUARANTINE}) q WHERE execution_id = '{RUN}'")
def errors_for_run(spark, sf):
    return quarantine.errors_for_run(quarantined(spark, sf), RUN).select("file_name", "pk_derived", "error_category")


# ---- unfolding, batches, regeneration -------------------------------------------------------------------------------

@query("SELECT event_id AS EVENT_ID, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS absent FROM {events}")
def unfold_data(spark, sf):
    df = made(spark, sf, CURATED)
    return fold.unfolded(df, EVENT_SPEC, fold.discovered_keys(df))


@query("SELECT event_id AS EVENT_ID, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS absent FROM {events}")
def unfold_variant(spark, sf):
    df = made(spark, sf, CURATED).withColumns({"DATA": F.parse_json("DATA"), "DATA_KEYS": F.parse_json("DATA_KEYS")})
    return fold.unfolded(df, EVENT_SPEC, fold.discovered_keys(df))


@query("SELECT event_type AS table_name, '[\"k\",\"EVENT_ID\",\"absent\"]' AS DATA_KEYS FROM {events} WHERE event_id % 3 <> 0 GROUP BY event_type")
def discover_keys(spark, sf):
    df = made(spark, sf, CURATED)
    return df.where("DATA_KEYS is not null").groupBy("table_name").agg(F.max_by("DATA_KEYS", "FILE_DTTM").alias("DATA_KEYS"))


@query(f"SELECT EVENT_ID, PK_DERIVED, CAST(FILE_DTTM AS STRING) AS at FROM ({CURATED}) c WHERE FILE_DTTM = (SELECT max(FILE_DTTM) FROM ({CURATED}) d)")
def latest_batch(spark, sf):
    return fold.latest_batch(made(spark, sf, CURATED)).select("EVENT_ID", "PK_DERIVED", F.date_format("FILE_DTTM", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(f"SELECT table_name, count(*) AS n_rows, count(*) FILTER (FILE_DTTM = newest) AS n_batch FROM (SELECT *, max(FILE_DTTM) OVER (PARTITION BY table_name) AS newest FROM ({CURATED}) c) d GROUP BY table_name")
def batch_counts(spark, sf):
    return counts_by_table(made(spark, sf, CURATED)).select("table_name", "n_rows", "n_batch")


def counts_by_table(df: DataFrame) -> DataFrame:
    """n_rows and n_batch (rows of the newest file time) of each table: counts by time first, so that nothing is sorted."""
    by_time = df.groupBy("table_name", "FILE_DTTM").agg(F.count("*").alias("n"))
    return by_time.groupBy("table_name").agg(F.sum("n").alias("n_rows"), F.max_by("n", "FILE_DTTM").alias("n_batch"))


@query(f"SELECT EVENT_ID, json_extract_string(DATA, '$.k') AS k, NULL::VARCHAR AS absent FROM ({CURATED}) c WHERE FILE_DTTM = (SELECT max(FILE_DTTM) FROM ({CURATED}) d)")
def regenerate(spark, sf):
    return flows.regenerated(made(spark, sf, CURATED), EVENT_SPEC)


@query("SELECT event_id AS EVENT_ID, '' AS k, '' AS absent FROM {events} WHERE false")
def headers_only(spark, sf):
    return flows.regenerated(made(spark, sf, CURATED), EVENT_SPEC, expected=0)


@query("SELECT CAST(0 AS BIGINT) AS row_idx, 'EVENT_ID/k/absent' AS cells, count(*) > 0 AS has_rows FROM {events}")
def headers_only_sheet(spark, sf):
    """The sheet of a run that expected no rows: its header alone, though the table has rows."""
    df = made(spark, sf, CURATED)
    grid = sinks.export_grid(flows.regenerated(df, EVENT_SPEC, expected=0), "Events_REGEN.xlsx", "All", ["EVENT_ID"])
    n = df.agg((F.count("*") > 0).alias("has_rows"))
    return grid.select("row_idx", F.concat_ws("/", "cells").alias("cells")).withColumn("has_rows", n.scalar())


@query(f"SELECT PK_DERIVED, ORDER_ID, REGION_ID, json_extract_string(DATA, '$.STATUS') AS STATUS, json_extract_string(DATA, '$.TOTAL') AS TOTAL, json_extract_string(DATA, '$.ODATE') AS ODATE, json_extract_string(DATA, '$.PRIORITY') AS PRIORITY FROM ({CURATED_ORDERS}) c")
def round_trip(spark, sf):
    """Folds, unfolds, folds again: the second fold's key with the sheet of the first."""
    _, first = flows.ingest_tab(orders_tab(spark, sf), SPEC, ntz())
    keys = fold.discovered_keys(first)
    lineage = {"file_name": F.col(fold.FILE_NAME), "sheet_tab_name": F.col(fold.TAB_NAME)}
    parsed = first.withColumns(lineage | {"_m": F.from_json("DATA", "map<string,string>")})
    sheet = parsed.select("file_name", "sheet_tab_name", F.col("ORDER_ID").cast("string").alias("ORDER_KEY"), F.col("REGION_ID").cast("string").alias("REGION"), "PK_DERIVED", *[F.col("_m")[k].alias(k) for k in keys])
    again = checks.renamed(sheet.drop("PK_DERIVED"), SPEC)
    second = checks.good(checks.validated(again, SPEC, flows.SCOPE)).select("file_name", "sheet_tab_name", F.col("ORDER_ID").try_cast("bigint").alias("ORDER_ID"), F.col("REGION_ID").try_cast("int").alias("REGION_ID"), *keys)
    back = parsed.select("file_name", "sheet_tab_name", F.col("ORDER_ID").alias("_o"), F.col("REGION_ID").alias("_r"), "PK_DERIVED")
    same = (second["file_name"] == back["file_name"]) & (second["sheet_tab_name"] == back["sheet_tab_name"]) & (second["ORDER_ID"] == back["_o"]) & second["REGION_ID"].eqNullSafe(back["_r"])
    return second.join(back, same).select("PK_DERIVED", "ORDER_ID", "REGION_ID", *keys)


URGENT = f"SELECT * FROM ({CURATED_ORDERS}) c WHERE AZ_INPUT_XLS_TAB_NAME = '1-URGENT' AND FILE_DTTM = (SELECT max(FILE_DTTM) FROM ({CURATED_ORDERS}) d WHERE AZ_INPUT_XLS_TAB_NAME = '1-URGENT')"


@query(f"""SELECT md5(CAST(ORDER_ID AS STRING) || '!@~' || coalesce(CAST(REGION_ID AS STRING), '~') || '!@~' || '~') AS PK_DERIVED, ORDER_ID, REGION_ID, DATA, DATA_KEYS, FILE_DTTM FROM (
  SELECT *, count(*) OVER (PARTITION BY ORDER_ID, REGION_ID) AS n FROM ({URGENT}) u) v WHERE n = 1""")
def round_trip_file(spark, sf):
    """The newest batch of a table as a workbook, decoded and ingested again with the prefix and time that it had."""
    _, curated = flows.ingest_tab(orders_tab(spark, sf), SPEC, ntz())
    one = curated.where(F.col(fold.TAB_NAME) == "1-URGENT")
    time = one.agg(F.max(fold.FILE_TIME)).first()[0]
    books = flows.regenerate_workbook(one, SPEC, "Orders_REGEN_20240201_123000.xlsx", "1-URGENT", "Orders")
    again = flows.ingest_workbook(books, SPEC, "Orders", time, ntz())[1]
    return again.select("PK_DERIVED", "ORDER_ID", "REGION_ID", "DATA", "DATA_KEYS", "FILE_DTTM")


# ---- grids and batches of tabs --------------------------------------------------------------------------------------

HEADER = ["USER_KEY", " AMOUNT ", "PROPS", "NOTE", "NOTE", ""]


def feed_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The events as sheets: a banner, a header with repeats and an empty name, ragged rows; `view` of the first day empty."""
    feed = made(spark, sf, FEED)
    at = F.row_number().over(Window.partitionBy("file_name", "sheet_tab_name").orderBy("event_id")).cast("long") + 1
    cells = F.array("USER_KEY", "AMOUNT", "PROPS", "NOTE")
    wide = F.when(F.col("event_id") % 4 == 0, F.concat(cells, F.array(F.lit("extra"), F.lit("more"), F.lit("cut")))).when(F.col("event_id") % 4 == 1, F.slice(cells, 1, 3)).otherwise(cells)
    rows = feed.select("file_name", "sheet_tab_name", at.alias("row_idx"), wide.alias("cells"))
    tabs = feed.select("file_name", "sheet_tab_name").distinct()
    empty = (F.col("sheet_tab_name") == "view") & (F.col("file_name") == "Feed_2024.01.01.xlsx")
    head = F.when(empty, F.array(F.lit("Report Status"))).otherwise(F.array(*[F.lit(h) for h in HEADER]))
    tops = tabs.select("file_name", "sheet_tab_name", F.explode(F.array(F.struct(F.lit(0).cast("long").alias("i"), F.array(F.lit("Banner")).alias("c")), F.struct(F.lit(1).cast("long").alias("i"), head.alias("c")))).alias("t"))
    return rows.unionByName(tops.select("file_name", "sheet_tab_name", F.col("t.i").alias("row_idx"), F.col("t.c").alias("cells")))


EMPTY_TAB = "(sheet_tab_name = 'view' AND file_name = 'Feed_2024.01.01.xlsx')"
RAGGED = f"""SELECT file_name, sheet_tab_name, event_id, USER_KEY, AMOUNT, PROPS, CASE WHEN event_id % 4 = 1 THEN NULL ELSE NOTE END AS NOTE,
  CASE WHEN event_id % 4 = 0 THEN 'extra' END AS NOTE_1, CASE WHEN event_id % 4 = 0 THEN 'more' END AS col_5 FROM ({FEED}) f WHERE NOT {EMPTY_TAB}"""


@query(f"SELECT file_name, sheet_tab_name, USER_KEY, AMOUNT, PROPS, NOTE, NOTE_1, col_5 FROM ({RAGGED}) r")
def header_promotion(spark, sf):
    return grids.wide(grids.promoted(feed_grid(spark, sf)), ["USER_KEY", "AMOUNT", "PROPS", "NOTE", "NOTE_1", "col_5"])


@query(f"SELECT file_name, sheet_tab_name, CASE WHEN {EMPTY_TAB} THEN 0 ELSE count(*) END AS n_rows, {EMPTY_TAB} AS no_data FROM ({FEED}) f GROUP BY file_name, sheet_tab_name")
def no_data_tabs(spark, sf):
    return grids.tab_counts(feed_grid(spark, sf))


@query(f"""SELECT file_name, sheet_tab_name, row_number() OVER (PARTITION BY file_name, sheet_tab_name ORDER BY event_id) + 1 AS row_idx, USER_KEY AS first_cell FROM ({FEED}) f
UNION ALL SELECT DISTINCT file_name, sheet_tab_name, 0, 'Banner' FROM ({FEED}) g
UNION ALL SELECT DISTINCT file_name, sheet_tab_name, 1, CASE WHEN {EMPTY_TAB} THEN 'Report Status' ELSE 'USER_KEY' END FROM ({FEED}) h""")
def grid_scan(spark, sf):
    """The sheets as workbook files, decoded again."""
    files = grids.encode_grids(feed_grid(spark, sf))
    return grids.text_grid(grids.decode_grids(files)).select("file_name", "sheet_tab_name", "row_idx", F.col("cells")[0].alias("first_cell"))


@query("SELECT o_orderstatus, count(*) AS n_lines, true AS only_wanted FROM {orders} GROUP BY o_orderstatus")
def file_landing(spark, sf):
    """The orders landed as files, by status, between others; the lines in what is found."""
    folder = shared(spark)
    orders = table(spark, sf, "orders")
    orders.select("o_orderstatus", "o_orderkey").write.option("maxRecordsPerFile", 1_000_000).partitionBy("o_orderstatus").csv(folder)
    orders.select(F.col("o_orderkey").cast("string")).write.mode("append").text(folder)
    lines = F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1
    found = grids.landing(spark, folder, ".csv", recursive=True).select(F.regexp_extract("path", "o_orderstatus=([^/]*)", 1).alias("o_orderstatus"), "file_name", lines.alias("n"))
    return found.groupBy("o_orderstatus").agg(F.sum("n").alias("n_lines"), F.bool_and(F.endswith("file_name", F.lit(".csv"))).alias("only_wanted"))


@query("SELECT 'LINES.CSV' AS file_name, count(*) AS n_lines FROM {orders} WHERE o_orderstatus = 'F'")
def folder_landing(spark, sf):
    """One status of the orders landed in a folder, another in a folder below; the lines in what the one folder has."""
    folder = shared(spark)
    orders = table(spark, sf, "orders").select("o_orderstatus", F.col("o_orderkey").cast("string").alias("value"))
    for status, below in (("F", ""), ("O", "/below")):
        orders.where(F.col("o_orderstatus") == status).select("value").write.mode("append").option("lineSep", "\n").text(folder + below)
    sinks.renamed_files(spark, folder, ".txt", ".CSV")
    lines = F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1
    return grids.landing(spark, folder, ".csv").agg(F.lit("LINES.CSV").alias("file_name"), F.sum(lines).alias("n_lines"))


EPOCH = "CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS STRING)"


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 06:00:00' WHEN 2 THEN '12:00:00' WHEN 3 THEN CAST(o_orderkey % 300 AS STRING) || ' days, 18:00:00'
  ELSE CAST(o_orderkey AS STRING) || '.1' END AS cell FROM {orders} WHERE o_orderkey % 5 <> 3 OR o_orderkey % 300 > 1""")
def cell_dates(spark, sf):
    """The orders' dates as cells of a workbook with number formats, in both epochs, decoded to their texts."""
    k = F.col("o_orderkey")
    days = F.datediff("o_orderdate", F.lit("1899-12-30"))
    kind = F.when(k % 5 == 3, "e").when(k % 5 == 4, "n").otherwise(F.when(k % 2 == 0, "d").otherwise("d4"))
    own = days - F.when(kind == "d4", 1462).otherwise(0)
    raw = F.when(k % 5 == 0, own.cast("string")).when(k % 5 == 1, F.concat(own.cast("string"), F.lit(".25"))).when(k % 5 == 2, "0.5").when(k % 5 == 3, F.concat((k % 300).cast("string"), F.lit(".75"))).otherwise(F.concat(k.cast("string"), F.lit(".1")))
    rows = table(spark, sf, "orders").where((k % 5 != 3) | (k % 300 > 1))
    cells = F.array(F.struct(F.lit("s").alias("kind"), k.cast("string").alias("value")), F.struct(kind.alias("kind"), raw.alias("value")))
    at = F.floor(k / 4_000_000).cast("string")
    books = rows.select(F.concat_ws("-", F.lit("Book"), kind, at).alias("file_name"), F.lit("All").alias("sheet_tab_name"), F.row_number().over(Window.partitionBy(kind, at).orderBy(k)).cast("long").alias("row_idx"), cells.alias("cells"))
    found = grids.text_grid(grids.decode_grids(grids.encode_grids(books)))
    return found.select(F.col("cells")[0].cast("long").alias("o_orderkey"), F.col("cells")[1].alias("cell"))


@query("""SELECT o_orderkey, v AS raw, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END) WHEN 2 THEN CAST(o_orderkey AS STRING) WHEN 3 THEN CAST(o_orderkey AS STRING) || '.5' ELSE ' x ' END AS cell
FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN CAST(o_orderkey % 2 AS STRING) WHEN 2 THEN CAST(o_orderkey AS STRING) || '.0' WHEN 3 THEN CAST(o_orderkey AS STRING) || '.50' ELSE ' x ' END AS v FROM {orders}) a""".replace("o_orderkey % 2 = 0 THEN 'true' ELSE 'false'", "o_orderkey % 2 = 1 THEN 'true' ELSE 'false'"))
def cell_canonical(spark, sf):
    k = F.col("o_orderkey")
    text = k.cast("string")
    raw = F.when(k % 5 == 0, "").when(k % 5 == 1, (k % 2).cast("string")).when(k % 5 == 2, F.concat(text, F.lit(".0"))).when(k % 5 == 3, F.concat(text, F.lit(".50"))).otherwise(" x ")
    kind = F.when(k % 5 == 1, "b").when(k % 5 < 4, "n").otherwise("s")
    return table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"), cell_text(raw, kind).alias("cell"))


@query("""SELECT o_orderkey, 'A.b_' || o_orderstatus AS file_name_prefix, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE replace(d, '-', '') || (CASE WHEN o_orderkey % 3 = 1 THEN '000000' ELSE '123229' END) END AS batch_id,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(d || (CASE WHEN o_orderkey % 3 = 1 THEN ' 00:00:00' ELSE ' 12:32:29' END) AS TIMESTAMP) END AS file_dttm
FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders}) o""")
def file_name_meta(spark, sf):
    dotted = F.date_format("o_orderdate", "yyyy.MM.dd")
    k, base = F.col("o_orderkey") % 3, F.concat(F.lit("A.b_"), F.col("o_orderstatus"))
    name = F.when(k == 0, F.concat(base, F.lit(".xlsx"))).when(k == 1, F.concat(base, F.lit("_"), dotted, F.lit(".xlsx"))).otherwise(F.concat(base, F.lit("."), dotted, F.lit(".12.32.29.xlsx")))
    return table(spark, sf, "orders").select("o_orderkey", file_meta(name).alias("m")).select("o_orderkey", "m.*")


BATCH = f"""SELECT file_name, sheet_tab_name, USER_KEY,
  CASE WHEN sheet_tab_name = 'click' THEN md5(coalesce(USER_KEY, '~') || '!@~' || AMOUNT || '!@~' || PROPS || '!@~' || coalesce(NOTE, '~') || '!@~' || coalesce(NOTE_1, '~') || '!@~' || coalesce(col_5, '~') || '!@~' || file_name || '!@~' || sheet_tab_name) ELSE md5(coalesce(USER_KEY, '~') || '!@~' || '~') END AS PK_DERIVED,
  sheet_tab_name = 'view' AND coalesce(trim(USER_KEY), '') = '' AS f_null, sheet_tab_name <> 'click' AND coalesce(USER_KEY = 'x', false) AS f_type, sheet_tab_name = 'click' AS full_load,
  CASE WHEN sheet_tab_name = 'click' THEN to_json({{{{'USER_KEY': USER_KEY, 'AMOUNT': AMOUNT, 'PROPS': PROPS, 'NOTE': NOTE, 'NOTE_1': NOTE_1, 'col_5': col_5}}}})::VARCHAR ELSE to_json({{{{'AMOUNT': AMOUNT, 'PROPS': PROPS, 'NOTE': NOTE, 'NOTE_1': NOTE_1, 'col_5': col_5}}}})::VARCHAR END AS DATA
FROM ({RAGGED}) r WHERE sheet_tab_name NOT IN ('error', 'signup')"""
BATCH_CHECKED = f"""SELECT *, (CASE WHEN f_null THEN 'Mandatory PK field is NULL || ' ELSE '' END) || (CASE WHEN f_type THEN 'PK datatype mismatch || ' ELSE '' END) || (CASE WHEN f_dup AND NOT full_load THEN 'Duplicate Primary Key || ' ELSE '' END) AS COMMENTS
FROM (SELECT *, count(*) OVER (PARTITION BY file_name, sheet_tab_name, PK_DERIVED) > 1 AS f_dup FROM ({BATCH}) b) c"""


def batch(spark, sf):
    return flows.ingest_batch(grids.promoted(feed_grid(spark, sf)), made(spark, sf, REGISTRY))


@query(f"SELECT file_name, sheet_tab_name, PK_DERIVED, DATA, COMMENTS FROM ({BATCH_CHECKED}) c")
def ingest_batch(spark, sf):
    return batch(spark, sf).where(F.size("missing") == 0).select("file_name", "sheet_tab_name", "PK_DERIVED", "DATA", "COMMENTS")


@query("SELECT DISTINCT 'Feed_' || replace(CAST(CAST(ts AS DATE) AS STRING), '-', '.') || '.xlsx' AS file_name, event_type AS sheet_tab_name, 'ABSENT' AS missing FROM {events} WHERE event_type = 'signup'")
def missing_keys(spark, sf):
    lost = batch(spark, sf).where(F.size("missing") > 0)
    return lost.select("file_name", "sheet_tab_name", F.concat_ws(",", "missing").alias("missing")).distinct()


@query(f"""SELECT file_name, sheet_tab_name, count(*) AS source_row_count, count(*) FILTER (COMMENTS = '') AS valid_record_count, count(*) FILTER (COMMENTS <> '') AS error_record_count, CASE WHEN count(*) FILTER (COMMENTS <> '') > 0 THEN 'Failed' ELSE 'Succeeded' END AS final_ingestion_status FROM ({BATCH_CHECKED}) c GROUP BY file_name, sheet_tab_name
UNION ALL SELECT file_name, sheet_tab_name, count(*), 0, 0, 'Failed' FROM ({RAGGED}) r WHERE sheet_tab_name = 'signup' GROUP BY file_name, sheet_tab_name
UNION ALL SELECT DISTINCT file_name, sheet_tab_name, 0, 0, 0, 'Succeeded' FROM ({FEED}) f WHERE {EMPTY_TAB}
UNION ALL SELECT 'Broken.xlsx', NULL, 0, 0, 0, 'Failed' FROM (SELECT count(*) FROM {{events}}) e""")
def control_rows(spark, sf):
    grid = feed_grid(spark, sf)
    known = made(spark, sf, REGISTRY)
    empty = grids.tab_counts(grid).where("no_data").withColumn("file_name_prefix", file_meta(F.col("file_name"))["file_name_prefix"])
    broken = table(spark, sf, "events").agg(F.lit("Broken.xlsx").alias("file_name"), F.lit("Workbook could not be read").alias("error"))
    rows = flows.batch_control(batch(spark, sf), registry.with_specs(empty, known), broken, RUN)
    return rows.select("file_name", "sheet_tab_name", "source_row_count", "valid_record_count", "error_record_count", "final_ingestion_status")


@query("SELECT DISTINCT 'Feed_' || replace(CAST(CAST(ts AS DATE) AS STRING), '-', '.') || '.xlsx' AS file_name, event_type AS sheet_tab_name, 'COMMENTS' AS reserved FROM {events} WHERE event_type = 'purchase'")
def reserved_headers(spark, sf):
    """Tabs with a column that checks would overwrite."""
    header = (F.col("sheet_tab_name") == "purchase") & (F.col("row_idx") == 1)
    grid = feed_grid(spark, sf).withColumn("cells", F.when(header, F.transform("cells", lambda c: F.when(c == "NOTE", "COMMENTS").otherwise(c))).otherwise(F.col("cells")))
    checked = flows.ingest_batch(grids.promoted(grid), made(spark, sf, REGISTRY))
    return checked.where(F.size("reserved") > 0).select("file_name", "sheet_tab_name", F.concat_ws(",", "reserved").alias("reserved")).distinct()


def batch_written(spark, sf, run: str = RUN) -> tuple[str, DataFrame]:
    """The feed through its tables: where they are, and the control rows."""
    grid, known = feed_grid(spark, sf), made(spark, sf, REGISTRY)
    empty = registry.with_specs(grids.tab_counts(grid).where("no_data").withColumn("file_name_prefix", file_meta(F.col("file_name"))["file_name_prefix"]), known)
    broken = table(spark, sf, "events").agg(F.lit("Broken.xlsx").alias("file_name"), F.lit("Workbook could not be read").alias("error"))
    base = shared(spark)
    return base, flows.ingest_tables(grids.promoted(grid), empty, broken, known, base, run, ntz(), F.lit("/landing"))


@query(f"""SELECT CASE WHEN sheet_tab_name = 'click' THEN 'feed_click' ELSE 'feed_shared' END AS table_name, file_name, sheet_tab_name, PK_DERIVED, CASE WHEN sheet_tab_name = 'view' THEN CAST(USER_KEY AS BIGINT) END AS USER_ID,
  CASE WHEN sheet_tab_name = 'purchase' THEN CAST(nullif(trim(USER_KEY), '') AS BIGINT) END AS USER_KEY, DATA FROM ({BATCH_CHECKED}) c WHERE COMMENTS = ''""")
def batch_tables(spark, sf):
    """The curated tables of a batch, read back: keys have their types, columns of a table's tabs stand side by side."""
    base, _ = batch_written(spark, sf)
    known = made(spark, sf, REGISTRY)
    read = lambda t: flows.read_curated(spark, base, t, known).withColumn("table_name", F.lit(t))
    rows = read("feed_shared").unionByName(read("feed_click"), allowMissingColumns=True)
    return rows.select("table_name", F.col(fold.FILE_NAME).alias("file_name"), F.col(fold.TAB_NAME).alias("sheet_tab_name"), "PK_DERIVED", "USER_ID", "USER_KEY", "DATA")


@query(f"""SELECT 'feed_shared' AS table_name, file_name, sheet_tab_name, PK_DERIVED AS pk_derived, regexp_replace(COMMENTS, '\\s*\\|\\|\\s*$', '') AS error_category, coalesce((CASE WHEN sheet_tab_name = 'view' THEN 'USER_ID=' ELSE 'USER_KEY=' END) || USER_KEY, '') AS pk_value
FROM ({BATCH_CHECKED}) c WHERE COMMENTS <> ''""")
def batch_error_rows(spark, sf):
    """The rejected rows of a batch, read back."""
    base, _ = batch_written(spark, sf)
    return spark.read.schema(quarantine.ERRORS).parquet(f"{base}/errors/{RUN}").select("table_name", "file_name", "sheet_tab_name", "pk_derived", "error_category", "pk_value")


@query()
def batch_outcomes(spark, sf):
    """The control rows of a batch that writes its tables, of which some tabs fail as a whole; a second run of the same
    execution finds them there."""
    base, rows = batch_written(spark, sf)
    return spark.read.parquet(f"{base}/control/{RUN}").select("file_name", "sheet_tab_name", "source_row_count", "valid_record_count", "error_record_count", "final_ingestion_status")


SQL["batch_outcomes"] = SQL["control_rows"]
KINDS = "CASE sheet_tab_name WHEN 'view' THEN 'decimal(5,2)' WHEN 'purchase' THEN 'SmallInt' WHEN 'click' THEN 'tinyint' WHEN 'signup' THEN 'float' ELSE 'no such type' END"


@query(f"""SELECT file_name, sheet_tab_name, {KINDS} AS kind, count(*) AS source_row_count,
  count(*) FILTER (sheet_tab_name <> 'error' AND NOT bad) AS valid_record_count, count(*) FILTER (sheet_tab_name <> 'error' AND bad) AS error_record_count,
  CASE WHEN sheet_tab_name = 'error' OR count(*) FILTER (bad) > 0 THEN 'Failed' ELSE 'Succeeded' END AS final_ingestion_status
FROM (SELECT *, CASE sheet_tab_name WHEN 'view' THEN abs(CAST(k AS DECIMAL(18, 2))) > 999.99 WHEN 'purchase' THEN CAST(k AS BIGINT) > 32767 WHEN 'click' THEN CAST(k AS BIGINT) > 127 WHEN 'signup' THEN k = 'x' ELSE false END AS bad
  FROM (SELECT file_name, sheet_tab_name, CASE sheet_tab_name WHEN 'view' THEN CAST(event_id AS STRING) || '.25' WHEN 'signup' THEN (CASE WHEN event_id % 11 = 0 THEN 'x' ELSE CAST(event_id AS STRING) || '.5' END) ELSE CAST(event_id AS STRING) END AS k FROM ({FEED}) f) g) h GROUP BY file_name, sheet_tab_name""".replace("WHEN event_id % 11 = 0 THEN 'x'", "WHEN event_id % 11 = 0 THEN 'x' || CAST(event_id AS STRING)").replace("WHEN 'signup' THEN k = 'x'", "WHEN 'signup' THEN k LIKE 'x%'"))
def batch_key_types(spark, sf):
    """Keys of types that nobody listed, and one of a type that there isn't: its tab fails, the others go on."""
    feed, tab = made(spark, sf, FEED), F.col("sheet_tab_name")
    text = F.col("event_id").cast("string")
    k = F.when(tab == "view", F.concat(text, F.lit(".25"))).when(tab == "signup", F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("x"), text)).otherwise(F.concat(text, F.lit(".5")))).otherwise(text)
    promoted = feed.select("file_name", "sheet_tab_name", F.col("event_id").alias("row_idx"), F.array(F.lit("K"), F.lit("NOTE")).alias("header"), F.array(k, F.col("NOTE")).alias("values"))
    known = spark.sql(
        f"SELECT CAST(row_number() OVER (ORDER BY sheet_tab_name) AS BIGINT) AS serial_number, 'Feed' AS file_name_prefix, sheet_tab_name, 'typed_' || sheet_tab_name AS table_name, 'K' AS sheet_column_name, CAST(NULL AS STRING) AS original_column_name, 'DATA' AS array_column_name, {KINDS} AS data_type, TRUE AS is_primary_key, TRUE AS is_nullable, TRUE AS load_type_delta FROM {{feed}} GROUP BY sheet_tab_name",
        feed=feed,
    )
    none = lambda schema: spark.createDataFrame([], schema)
    rows = flows.ingest_tables(promoted, none("file_name string, sheet_tab_name string, table_name string"), none("file_name string, error string"), known, shared(spark), RUN, ntz(), F.lit("/landing"))
    kinds = known.select("sheet_tab_name", F.col("data_type").alias("kind"))
    return rows.join(kinds, "sheet_tab_name").select("file_name", "sheet_tab_name", "kind", "source_row_count", "valid_record_count", "error_record_count", "final_ingestion_status")


@query(f"""SELECT 'orders_feed' AS table_name, file_name, sheet_tab_name, total AS source_row_count, valid AS valid_record_count, bad AS error_record_count, CASE WHEN bad > 0 THEN 'Failed' ELSE 'Succeeded' END AS final_ingestion_status, true AS has_data FROM ({COUNTS}) c
UNION ALL SELECT t, file_name, sheet_tab_name, count(*), 0, 0, 'Failed', false FROM ({ORDERS}) o, (VALUES ('no_key'), ('reserved_header'), ('no_type')) v(t) GROUP BY t, file_name, sheet_tab_name
UNION ALL SELECT 'all_columns', file_name, sheet_tab_name, count(*), count(*), 0, 'Succeeded', true FROM ({ORDERS}) o GROUP BY file_name, sheet_tab_name""")
def isolated_tabs(spark, sf):
    """Tables one after the other: a good one, one whose key is missing, one with a reserved column, one of an unknown key
    type, and a full load whose keys are configured all the same, with a dotted header."""
    rows, base = orders_tab(spark, sf), shared(spark)
    named = lambda name, spec: TabSpec(name, spec.keys, spec.delta)
    runs = [
        (rows, SPEC), (rows, TabSpec("no_key", (Key("ABSENT", "A"),))), (rows.withColumn("COMMENTS", F.lit("own")), named("reserved_header", SPEC)),
        (rows, TabSpec("no_type", (Key("ORDER_KEY", "K", "number(5)"),))), (rows.withColumnRenamed("TOTAL", "No. of items"), TabSpec("all_columns", SPEC.keys, False)),
    ]
    told = [flows.ingest_chain(df, spec, base, RUN, ntz(), F.lit("/landing")) for df, spec in runs]
    rows = told[0]
    for t in told[1:]:
        rows = rows.unionByName(t)
    return rows.select("table_name", "file_name", "sheet_tab_name", "source_row_count", "valid_record_count", "error_record_count", "final_ingestion_status", F.col("final_parquet_source_raw").isNotNull().alias("has_data"))


@query(f"SELECT execution_id, count(*) AS n, count(DISTINCT pk_derived) AS n_keys FROM (SELECT pk_derived, unnest(['run-1', 'run-2']) AS execution_id FROM ({QUARANTINE}) q) r GROUP BY execution_id")
def idempotent_append(spark, sf):
    """The rejected rows of two runs, the first of which is appended three times: each run is there once."""
    name = f"gridloom_{uuid.uuid4().hex}"
    sinks.create_run_table(spark, name, quarantine.ERRORS)
    for run in (RUN, "run-2", RUN, RUN):
        sinks.replace_run(quarantined(spark, sf), name, run)
    return spark.table(name).groupBy("execution_id").agg(F.count("*").alias("n"), F.count_distinct("pk_derived").alias("n_keys"))


def appended(spark, schema: str) -> str:
    """The name of a new append table."""
    name = f"gridloom_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, schema)
    return name


@query()
def control_append(spark, sf):
    """The control rows of two runs appended to one table, and the newest of each table read from it."""
    grid, name = feed_grid(spark, sf), appended(spark, control.CONTROL)
    known = made(spark, sf, REGISTRY)
    empty = registry.with_specs(grids.tab_counts(grid).where("no_data").withColumn("file_name_prefix", file_meta(F.col("file_name"))["file_name_prefix"]), known)
    broken = table(spark, sf, "events").agg(F.lit("Broken.xlsx").alias("file_name"), F.lit("Workbook could not be read").alias("error"))
    for run, at in ((RUN, INSERTED), ("run-2", "2024-02-02 00:00:00")):
        sinks.append_aligned(flows.batch_control(batch(spark, sf), empty, broken, run, ntz(at)), name)
    newest = control.latest(spark.table(name))
    return newest.select("execution_id", "process_id", "table_name", "file_name", "source_row_count", "valid_record_count", "error_record_count", F.col("source_file_path").isNull().alias("without_path"))


SQL["control_append"] = f"""
SELECT 'run-2' AS execution_id, process_id, table_name, file_name, source_row_count, valid_record_count, error_record_count, true AS without_path FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY process_id DESC) AS place FROM (
    SELECT *, CASE WHEN sheet_tab_name IN ('view', 'purchase') THEN 'feed_shared' ELSE 'feed_' || sheet_tab_name END AS table_name, md5('run-2|' || file_name || coalesce('|' || sheet_tab_name, '')) AS process_id FROM ({SQL['control_rows']}) c) d) e WHERE place = 1"""


@query(QUARANTINE)
def error_append(spark, sf):
    """Rejected rows appended to an error table in its own column order, and those of the run read from it."""
    name = appended(spark, quarantine.ERRORS)
    rows = quarantined(spark, sf)
    sinks.append_aligned(rows.select(*reversed(rows.columns)), name)
    return quarantine.errors_for_run(spark.table(name), RUN)


EVENTS_KNOWN = """SELECT CAST(1 AS BIGINT) AS serial_number, 'Events' AS file_name_prefix, 'All' AS sheet_tab_name, 'Events_Feed' AS table_name, 'EVENT_ID' AS sheet_column_name, CAST(NULL AS STRING) AS original_column_name,
  'DATA' AS array_column_name, 'bigint' AS data_type, TRUE AS is_primary_key, TRUE AS is_nullable, TRUE AS load_type_delta FROM (SELECT count(*) AS n FROM {events}) e"""
EVENTS_CONTROL = "SELECT 'run-1' AS execution_id, 'p' AS process_id, 'events_feed' AS table_name, count(*) AS source_row_count, count(*) AS valid_record_count, CAST('2024-02-01' AS TIMESTAMP) AS _az_insert_ts FROM {events}"


@query(f"SELECT CAST(EVENT_ID AS STRING) AS EVENT_ID, json_extract_string(DATA, '$.k') AS k, NULL::VARCHAR AS absent FROM ({CURATED}) c WHERE FILE_DTTM = (SELECT max(FILE_DTTM) FROM ({CURATED}) d)")
def regenerate_chain(spark, sf):
    """From the table's name to a written sheet, read back."""
    path = flows.regenerate_table(made(spark, sf, EVENTS_KNOWN), made(spark, sf, EVENTS_CONTROL), made(spark, sf, CURATED), "EVENTS_FEED", shared(spark), dt.datetime(2024, 2, 1, 12, 30))
    return spark.read.option("header", True).csv(path)


@query(f"SELECT lower(table_name) AS table_name, arg_min(file_name_prefix, serial_number) AS file_name_prefix, arg_min(sheet_tab_name, serial_number) AS sheet_tab_name, count(DISTINCT sheet_tab_name) AS n_tabs, count(DISTINCT sheet_tab_name) > 1 AS ambiguous FROM ({REGISTRY_WIDE}) r GROUP BY 1")
def registry_by_table(spark, sf):
    return registry.by_table(made(spark, sf, REGISTRY_WIDE)).select("table_name", "file_name_prefix", "sheet_tab_name", "n_tabs", "ambiguous")


# ---- registry -------------------------------------------------------------------------------------------------------

@query(f"""SELECT file_name_prefix, sheet_tab_name, lower(table_name) AS table_name, coalesce(load_type_delta, true) AS delta, CASE WHEN sheet_tab_name = 'click' THEN '' WHEN sheet_tab_name = 'view' THEN 'USER_ID:bigint:true' WHEN sheet_tab_name = 'signup' THEN 'AMOUNT:string:true,ABSENT:bigint:true' WHEN sheet_tab_name = 'purchase' THEN 'AMOUNT:string:false,USER_KEY:bigint:false' ELSE '?' END AS keys FROM ({REGISTRY}) r""")
def registry_spec(spark, sf):
    spec = registry.specs(made(spark, sf, REGISTRY_WIDE))
    told = F.transform("keys", lambda k: F.concat_ws(":", k["name"], k["type"], k["check_not_null"].cast("string")))
    return spec.select("file_name_prefix", "sheet_tab_name", "table_name", "delta", F.concat_ws(",", told).alias("keys"))


@query(f"SELECT serial_number, sheet_column_name, coalesce(is_nullable, true) AS is_nullable, coalesce(load_type_delta, true) AS load_type_delta, true AS unknown FROM ({REGISTRY_WIDE}) r")
def flag_defaults(spark, sf):
    df = made(spark, sf, REGISTRY_WIDE)
    return df.select("serial_number", "sheet_column_name", *[registry.flag(df, c).alias(c) for c in ("is_nullable", "load_type_delta", "unknown")])


@query(f"SELECT sheet_tab_name, table_name, string_agg(sheet_column_name, ' + ' ORDER BY serial_number) AS pk_columns FROM ({REGISTRY_WIDE}) r WHERE is_primary_key GROUP BY sheet_tab_name, table_name")
def registry_pk_list(spark, sf):
    return registry.key_lists(made(spark, sf, REGISTRY_WIDE))


@query(f"SELECT lower(table_name) AS table_name, count(DISTINCT file_name_prefix || '/' || sheet_tab_name) AS n_tabs, count(DISTINCT file_name_prefix || '/' || sheet_tab_name) > 1 AS ambiguous FROM ({REGISTRY_WIDE}) r GROUP BY 1")
def registry_ambiguity(spark, sf):
    return registry.ambiguous_tables(made(spark, sf, REGISTRY_WIDE))


@query(f"SELECT serial_number, batch_id, file_name_prefix, sheet_tab_name, table_name, sheet_column_name, original_column_name, array_column_name, data_type, is_primary_key, coalesce(is_nullable, true) AS is_nullable, coalesce(load_type_delta, true) AS load_type_delta FROM ({REGISTRY_WIDE}) r WHERE is_primary_key")
def registry_migration(spark, sf):
    return registry.migrated(made(spark, sf, REGISTRY_WIDE).withColumn("column_order", F.lit(1)))


TABS = "SELECT DISTINCT 'Feed' AS file_name_prefix, 'Feed_' || replace(CAST(CAST(ts AS DATE) AS STRING), '-', '.') || '.xlsx' AS file_name, event_type AS sheet_tab_name FROM {events}"


@query(f"SELECT t.file_name, t.sheet_tab_name, lower(r.table_name) AS table_name FROM ({TABS}) t JOIN ({REGISTRY}) r ON t.sheet_tab_name = r.sheet_tab_name AND t.file_name_prefix = r.file_name_prefix")
def tab_registry_join(spark, sf):
    return registry.with_specs(made(spark, sf, TABS), made(spark, sf, REGISTRY)).select("file_name", "sheet_tab_name", "table_name")


@query(f"SELECT file_name_prefix, file_name, sheet_tab_name FROM ({TABS}) t WHERE sheet_tab_name = 'error'")
def unconfigured_tabs(spark, sf):
    return registry.unconfigured(made(spark, sf, TABS), made(spark, sf, REGISTRY))


# ---- control tables -------------------------------------------------------------------------------------------------

@query(f"SELECT table_name, file_name, process_id, source_row_count FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY _az_insert_ts DESC, process_id DESC) AS place FROM ({CONTROL}) c) d WHERE place = 1")
def latest_control(spark, sf):
    return control.latest(made(spark, sf, CONTROL)).select("table_name", "file_name", "process_id", "source_row_count")


@query(f"SELECT execution_id, count(*) FILTER (final_ingestion_status = 'Succeeded') AS n_ok, count(*) FILTER (final_ingestion_status <> 'Succeeded') AS n_failed FROM ({CONTROL}) c GROUP BY execution_id")
def run_summary(spark, sf):
    return control.run_summary(made(spark, sf, CONTROL))


@query(f"""SELECT n.execution_id, n_failed, array_to_string(names[1:4], ', ') || (CASE WHEN len(names) > 4 THEN ' …' ELSE '' END) AS tables, details FROM (
  SELECT execution_id, count(*) AS n_failed, list_sort(list(DISTINCT table_name)) AS names FROM ({CONTROL}) c WHERE final_ingestion_status = 'Failed' GROUP BY execution_id) n JOIN (
  SELECT execution_id, string_agg(d, ' ;; ' ORDER BY place) AS details FROM (SELECT execution_id, file_name || ' -> ' || table_name || ' : bad keys: ' || error_record_count::VARCHAR AS d, row_number() OVER (PARTITION BY execution_id ORDER BY file_name, sheet_tab_name) AS place FROM ({CONTROL}) c WHERE final_ingestion_status = 'Failed') e WHERE place <= 15 GROUP BY execution_id) m ON n.execution_id = m.execution_id""")
def failure_summary(spark, sf):
    return control.failure_summary(made(spark, sf, CONTROL))


@query(f"""SELECT c.table_name, coalesce(c.valid_record_count, c.source_row_count, 0) AS expected, coalesce(b.actual, 0) AS actual, coalesce(c.valid_record_count, c.source_row_count, 0) = coalesce(b.actual, 0) AS matches
FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY _az_insert_ts DESC, process_id DESC) AS place FROM ({CONTROL}) c) c
LEFT JOIN (SELECT 'feed_' || event_type AS table_name, count(*) AS actual FROM {{events}} e WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM {{events}} x WHERE x.event_type = e.event_type) GROUP BY event_type) b ON b.table_name = c.table_name WHERE place = 1""")
def count_reconcile(spark, sf):
    batches = counts_by_table(made(spark, sf, CURATED)).select(F.concat(F.lit("feed_"), F.col("table_name")).alias("table_name"), F.col("n_batch").alias("actual"))
    return control.reconciled(made(spark, sf, CONTROL), batches)


# ---- writing and reading back ---------------------------------------------------------------------------------------

@query(f"SELECT file_name, sheet_tab_name, count(*) AS n, count(ORDER_KEY) AS n_keys FROM ({ORDERS}) o GROUP BY file_name, sheet_tab_name")
def raw_landing(spark, sf):
    path = shared(spark)
    sinks.land_raw(orders_tab(spark, sf), path)
    return spark.read.parquet(path).groupBy("file_name", "sheet_tab_name").agg(F.count("*").alias("n"), F.count("ORDER_KEY").alias("n_keys"))


@query(f"SELECT ORDER_ID, DATA, AZ_INPUT_XLS_FILE_NAME FROM ({CURATED_ORDERS}) c")
def curated_write(spark, sf):
    """Written twice to the same date: the second replaces the first."""
    path = shared(spark)
    rows = flows.ingest_tab(orders_tab(spark, sf), SPEC, ntz())[1]
    for _ in range(2):
        sinks.write_curated(rows, path, ntz(), "daily")
    return spark.read.parquet(path).where("year = '2024' and month = '02'").select("ORDER_ID", "DATA", "AZ_INPUT_XLS_FILE_NAME")


@query("""SELECT o_orderkey, '/base/curated/orders/' || strftime(o_orderdate, '%Y/%m/%d') AS daily, '/base/orders/_raw_asis/' || strftime(o_orderdate, '%Y/%m') AS monthly,
  '/base/curated/orders/' || strftime(o_orderdate, '%Y/%m/%d/%H/%M') AS minutes FROM {orders}""")
def dated_layout(spark, sf):
    at = F.col("o_orderdate")
    path = lambda kind, frequency: sinks.dated_path("/base/", "orders", kind, at, frequency)
    return table(spark, sf, "orders").select("o_orderkey", path("curated", "other").alias("daily"), path("raw", "monthly").alias("monthly"), path("curated", "minutely").alias("minutes"))


@query("SELECT o_orderkey, o_orderpriority FROM {orders} WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM {orders})")
def latest_partition(spark, sf):
    path = shared(spark)
    dated = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy").alias("y"), F.date_format("o_orderdate", "MM").alias("m"))
    dated.write.partitionBy("y", "m").parquet(path)
    read = spark.read.schema(dated.schema).parquet(path)
    return grids.latest_partition(read, ["y", "m"]).select("o_orderkey", "o_orderpriority")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS folder FROM {orders} WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM {orders})")
def newest_folder(spark, sf):
    """The orders in folders by year, month and day; those of the newest folder, found without scanning any other."""
    base, at = shared(spark), F.col("o_orderdate")
    orders = table(spark, sf, "orders").select("o_orderkey", *[F.date_format(at, p).alias(n) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))])
    orders.repartition("year", "month").write.partitionBy("year", "month", "day").parquet(base)
    newest = grids.newest_folder(spark, base, "hourly")
    folder = "/".join(part.split("=")[1] for part in newest.split("/")[-3:])
    return spark.read.parquet(newest).select("o_orderkey", F.lit(folder).alias("folder"))


@query("""SELECT row_number() OVER (ORDER BY s_suppkey) + 1 AS row_idx, CAST(s_suppkey AS STRING) || '/' || s_name AS cells FROM {supplier}
UNION ALL SELECT 0, 'Suppliers' FROM (SELECT count(*) FROM {supplier}) a UNION ALL SELECT 1, 's_suppkey/s_name' FROM (SELECT count(*) FROM {supplier}) b""")
def export_grid(spark, sf):
    grid = sinks.export_grid(sinks.capped(table(spark, sf, "supplier").select("s_suppkey", "s_name")), "Suppliers_REGEN.xlsx", "Suppliers", ["s_suppkey"], "Suppliers")
    return grid.select("row_idx", F.concat_ws("/", "cells").alias("cells"))


@query("SELECT p_partkey, substr(trim(regexp_replace(p_name || '/[' || p_type || ']:' || p_brand, '[\\\\/*?:\\[\\]]', '_', 'g')), 1, 31) AS tab FROM {part}")
def safe_tab_names(spark, sf):
    name = F.concat("p_name", F.lit("/["), "p_type", F.lit("]:"), "p_brand")
    return table(spark, sf, "part").select("p_partkey", safe_tab_name(name, "part").alias("tab"))


# ---- bulk loads -----------------------------------------------------------------------------------------------------

N_WINDOWS = 13
WIDTH = "(SELECT CAST(ceil((max(o_orderkey) - min(o_orderkey) + 1) / 13.0) AS BIGINT) FROM {orders})"
LOW = "(SELECT min(o_orderkey) FROM {orders})"


@query(f"SELECT o_orderkey, CAST((o_orderkey - {LOW}) // {WIDTH} AS INT) AS window_id FROM {{orders}}")
def range_windows(spark, sf):
    orders = table(spark, sf, "orders")
    first = bulkload.plan_windows(orders, "o_orderkey", N_WINDOWS, "c1").orderBy("window_id").first()
    low = first["lo"] + 1
    return orders.select("o_orderkey", bulkload.window_of(F.col("o_orderkey"), low, first["hi"] - first["lo"]).alias("window_id"))


@query(f"SELECT 'c1' AS cycle_id, w AS window_id, {LOW} - 1 + w * {WIDTH} AS lo, 'pending' AS status FROM (SELECT DISTINCT CAST((o_orderkey - {LOW}) // {WIDTH} AS INT) AS w FROM {{orders}}) a WHERE w > 0")
def pending_windows(spark, sf):
    plan = bulkload.plan_windows(table(spark, sf, "orders"), "o_orderkey", N_WINDOWS, "c1")
    return bulkload.pending(plan, plan.where("window_id = 0")).select("cycle_id", "window_id", "lo", "status")


OLD = "SELECT o_orderkey, 'old' AS state, o_totalprice FROM {orders} WHERE o_orderkey % 3 <> 0"
NEW = "SELECT o_orderkey, 'new' AS state, o_totalprice FROM {orders} WHERE o_orderkey % 2 = 0"


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS state, o_totalprice FROM {orders} WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0")
def merge_upsert(spark, sf):
    return bulkload.merge_upsert(made(spark, sf, OLD), made(spark, sf, NEW), ["o_orderkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 'old' ELSE 'new' END AS state, o_totalprice FROM {orders} WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0")
def merge_insert_only(spark, sf):
    return bulkload.merge_insert_only(made(spark, sf, OLD), made(spark, sf, NEW), ["o_orderkey"])


@query("""SELECT CAST(o_orderkey % 13 AS INT) AS window_id, count(*) AS source_count, count(*) FILTER (o_orderkey % 7 <> 0 OR o_orderkey % 13 <> 5) AS target_count,
  count(*) = count(*) FILTER (o_orderkey % 7 <> 0 OR o_orderkey % 13 <> 5) AS matches FROM {orders} GROUP BY 1""")
def window_reconcile(spark, sf):
    source = table(spark, sf, "orders").select((F.col("o_orderkey") % 13).cast("int").alias("window_id"), "o_orderkey")
    return bulkload.reconcile_windows(source, source.where("o_orderkey % 7 <> 0 or window_id <> 5"))


@query(f"SELECT CAST((o_orderkey - {LOW}) // {WIDTH} AS INT) AS window_id, 'done' AS status, count(*) AS source_count, count(*) AS target_count FROM {{orders}} GROUP BY 1")
def windowed_load(spark, sf):
    """A third of the rows is there already; every window is read, merged and counted."""
    source = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    plan = bulkload.plan_windows(source, "o_orderkey", N_WINDOWS, "c1")
    _, states = flows.windowed_load(source, source.where("o_orderkey % 3 = 0"), plan, "o_orderkey", shared(spark))
    return states.select("window_id", "status", "source_count", "target_count")


@query("SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys, 8 AS n_windows, true AS even FROM {orders}")
def equal_row_windows(spark, sf):
    """Windows of an eighth of the rows over keys that crowd at the low end; each row in one window, none over 1.5 times the mean."""
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(key % 10 == 0, key * 1000).otherwise(key).alias("k"))
    n = orders.count()
    plan = bulkload.plan_row_windows(orders, "k", -(-n // 8), "c1")
    windows = plan.collect()
    edge = F.array(*[F.lit(w["hi"]) for w in windows])
    of = orders.withColumn("w", F.size(F.filter(edge, lambda e: e < F.col("k"))))
    sizes = of.groupBy("w").agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("k"))
    return sizes.agg(F.sum("n").alias("n_rows"), F.sum("k").alias("n_keys"), F.count("*").cast("int").alias("n_windows"), (F.max("n") <= 1.5 * F.avg("n")).alias("even"))


DATED = "CASE WHEN o_orderkey % 4 = 3 THEN 'no time ' || CAST(o_orderkey AS STRING) ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 00:00:00' END"


def loaded_in_windows(spark, sf, upsert: bool):
    """The orders with times as texts, some unreadable, some without a key, onto a table that has a third of them."""
    k = F.col("o_orderkey")
    source = made(spark, sf, f"SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, {DATED} AS at, 'new' AS state FROM {{orders}}")
    target = table(spark, sf, "orders").where(k % 3 == 0).select("o_orderkey", F.lit(None).cast("timestamp_ntz").alias("at"), F.lit("old").alias("state"))
    target = target.where(k % 101 != 0)
    plan, path = bulkload.plan_row_windows(source, "o_orderkey", -(-table(spark, sf, "orders").count() // 6), "c1"), shared(spark)
    whole, states = flows.windowed_load(source, target, plan, "o_orderkey", path, {"at": tolerant_timestamp}, upsert=upsert)
    return whole, states, path


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 4 = 3 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS at, CASE WHEN o_orderkey % 4 = 3 THEN 'old' ELSE 'new' END AS state
FROM {orders} WHERE o_orderkey % 101 <> 0 AND (o_orderkey % 4 <> 3 OR o_orderkey % 3 = 0)""")
def windowed_upsert(spark, sf):
    """Rows that are there are updated, new ones added; what can't be cast leaves the old row."""
    return loaded_in_windows(spark, sf, True)[0]


@query("""SELECT CAST(NULL AS BIGINT) AS o_orderkey, 'Mandatory PK field is NULL' AS error_category, count(*) AS n FROM {orders} WHERE o_orderkey % 101 = 0
UNION ALL SELECT o_orderkey, 'Cast failed', 1 FROM {orders} WHERE o_orderkey % 101 <> 0 AND o_orderkey % 4 = 3 AND o_orderkey % 3 <> 0""")
def rejected_casts(spark, sf):
    """What a load that inserts couldn't read, and rows without a key; with what is loaded they are all of the source."""
    _, states, path = loaded_in_windows(spark, sf, False)
    rows = flows.rejected_rows(spark, states, path, "o_orderkey", "orders", RUN, ntz())
    key = F.get_json_object("err_record", "$.o_orderkey").cast("bigint")
    return rows.groupBy(key.alias("o_orderkey"), "error_category").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS at FROM {orders}")
def windowed_resume(spark, sf):
    """Five windows, then the rest by another run from the stored states; times come as texts and are cast."""
    orders, path = table(spark, sf, "orders"), shared(spark)
    source = orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00.000000").alias("at"))
    target = source.where("o_orderkey % 3 = 0").withColumn("at", tolerant_timestamp(F.col("at")))
    plan = bulkload.plan_windows(orders, "o_orderkey", N_WINDOWS, "c1")
    load = lambda most: flows.windowed_load(source, target, plan, "o_orderkey", path, {"at": tolerant_timestamp}, most)
    first = load(5)[1]
    return load(None)[0] if flows.more_pending(first) else target.limit(0)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS at FROM {orders}""")
def tolerant_cast(spark, sf):
    k = F.col("o_orderkey") % 4
    at = F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(at, "yyyy-MM-dd 00:00:00.000000")).when(k == 1, F.date_format(at, "yyyy-MM-dd")).when(k == 2, F.date_format(at, "yyyy-MM-dd 00:00:00")).otherwise("not a time")
    return table(spark, sf, "orders").select("o_orderkey", tolerant_timestamp(text).alias("at"))


for old, new in (("derived_key_", "derived_key"), ("full_row_key_", "full_row_key"), ("safe_tab_names", "safe_tab_name")):
    QUERIES[new] = QUERIES.pop(old)
    SQL[new] = SQL.pop(old)
