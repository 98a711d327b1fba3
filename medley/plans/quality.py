"""The quality gate over orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.operators.load import read_files
from medley.operators.quality import GateResult, Rule, gate, report, select_rules, to_rules
from medley.operators.quality.dates import LocalFormat, normalise_dates
from medley.operators.quality.gate import post_load, previous_snapshot
from medley.operators.quality.run import Delivery, check_file
from medley.operators.reshape import stack_tagged
from medley.plans.base import Tables, query
from medley.session import work_path

RUN_TIME = dt.datetime(2024, 3, 1, 6, 30)

RULES = [
    Rule("null_check", "mandatory", ("status", "segment"), "Null Check#Mandatory value is missing", "high", "core"),
    Rule("numeric_check", "numeric", ("price",), "Numeric Check#Value is not numeric", "medium", "core"),
    Rule("date_check", "date", ("day",), "Date Check#Out of range", "medium", "core", "yyyy-MM-dd"),
    Rule("valid_value_check", "valid_value", ("status",), "Value Check#Invalid value", "low", "sales", "O,F"),
    Rule("duplicate_check", "duplicate", ("custkey",), "Duplicate Check#Duplicate record", "low", "sales", "custkey,day"),
    Rule("df_custom_check", "expr", ("price",), "Custom Check#Price above limit", "low", "sales",
         "try_cast({col} as double) <= 450000 or try_cast({col} as double) is null"),
]

FORMATS = [LocalFormat("dd/MM/yyyy"), LocalFormat("yyyyMMdd HH:mm", with_time=True, active="I")]

# The same input, errors and grades in SQL. Message order follows the rules.
BASE = """
WITH src AS (
 SELECT o_orderkey AS orderkey, o_custkey AS custkey,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE o_orderpriority END AS segment,
  CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
  CASE WHEN o_orderkey % 19 = 0 THEN '2020-13-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders),
dup AS (SELECT *, count(*) OVER (PARTITION BY custkey, day) AS n FROM src),
err AS (SELECT *,
  status IS NULL AS e1, trim(segment) = '' AS e2, price = 'n/a' AS e3, day = '2020-13-01' AS e4,
  status IS NOT NULL AND status NOT IN ('O', 'F') AS e5, n > 1 AS e6, coalesce(TRY_CAST(price AS DOUBLE) > 450000, false) AS e7 FROM dup),
graded AS (SELECT *, CASE WHEN e1 OR e2 THEN 'high' WHEN e3 OR e4 THEN 'medium' WHEN e5 OR e6 OR e7 THEN 'low' ELSE 'ok' END AS grade,
  concat_ws(';', CASE WHEN e1 THEN 'core-Null Check#Mandatory value is missing: status' END,
   CASE WHEN e2 THEN 'core-Null Check#Mandatory value is missing: segment' END,
   CASE WHEN e3 THEN 'core-Numeric Check#Value is not numeric: price' END,
   CASE WHEN e4 THEN 'core-Date Check#Out of range: day' END,
   CASE WHEN e5 THEN 'sales-Value Check#Invalid value: status' END,
   CASE WHEN e6 THEN 'sales-Duplicate Check#Duplicate record: custkey' END,
   CASE WHEN e7 THEN 'sales-Custom Check#Price above limit: price' END) AS description FROM err)
"""


def source(t: Tables) -> DataFrame:
    """Orders as delivered: missing values, blanks, text in numbers, local and impossible dates."""
    k = F.col("o_orderkey")
    shown = F.when(k % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return t.orders.select(
        k.alias("orderkey"),
        F.col("o_custkey").alias("custkey"),
        F.when(k % 11 == 0, "nan").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 13 == 0, " ").otherwise(F.col("o_orderpriority")).alias("segment"),
        F.when(k % 17 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(k % 19 == 0, "2020-13-01").otherwise(shown).alias("day"),
    )


def checked(t: Tables) -> GateResult:
    """The gate over the whole table."""
    return gate(source(t), RULES, ["orderkey"], "orders_2024.csv", FORMATS)


@query(BASE + "SELECT orderkey, grade, nullif(description, '') AS description FROM graded")
def dq_tag(t: Tables) -> DataFrame:
    """[Q04 to Q09, Q12, Q17, Q21] Every row with its error text and grade."""
    return checked(t).tagged.select("orderkey", "grade", report.render(F.col("errors")).alias("description"))


@query(BASE + """
SELECT 'valid' AS side, count(*) AS n FROM graded WHERE grade IN ('ok', 'low') UNION ALL
SELECT 'held', count(*) FROM graded WHERE grade IN ('medium', 'high')
""")
def dq_split_counts(t: Tables) -> DataFrame:
    """[Q17, Q22] Valid and held rows."""
    side = F.when(F.col("grade").isin("ok", "low"), "valid").otherwise("held")
    return checked(t).tagged.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


@query(BASE + "SELECT orderkey, custkey, status, CASE WHEN TRIM(segment) = '' THEN ' ' ELSE segment END AS segment, price, day FROM graded WHERE grade IN ('ok', 'low')")
def dq_valid(t: Tables) -> DataFrame:
    """[Q22] The rows that go on, input columns only."""
    return checked(t).valid


@query(BASE + "SELECT bool_or(grade = 'high') AS high, bool_or(e3 OR e4) AS medium, bool_or(e5 OR e6 OR e7) AS low FROM graded")
def dq_priority(t: Tables) -> DataFrame:
    """[Q20, Q23] Flags by priority."""
    return checked(t).flags()


@query(BASE + """
SELECT 'XX' AS country_code, 'orders_2024.csv' AS filename, description AS error_description, count(*) AS "count",
 (SELECT count(*) FROM orders) AS total_record FROM graded WHERE grade <> 'ok' GROUP BY description
""")
def dq_summary(t: Tables) -> DataFrame:
    """[Q18, Q24] Error rows by description with the file's total."""
    rows = checked(t).error_rows("orders_2024.csv", "gate", RUN_TIME)
    total = t.orders.count()
    out = report.summary(rows, total, "XX", "ORDERS", "err_orders", "err_orders.csv", "/landing")
    return out.select("country_code", "filename", "error_description", "count", "total_record")


@query(BASE + """
SELECT 'numeric' AS "check", count(*) FILTER (WHERE e3) AS error_records FROM graded UNION ALL
SELECT 'date', count(*) FILTER (WHERE e4) FROM graded UNION ALL SELECT 'duplicate', count(*) FILTER (WHERE e6) FROM graded UNION ALL
SELECT 'valid_value', count(*) FILTER (WHERE e5) FROM graded UNION ALL
SELECT 'mandatory', count(*) FILTER (WHERE e1) + count(*) FILTER (WHERE e2) FROM graded
""")
def dq_by_check(t: Tables) -> DataFrame:
    """[Q25] Errors by type of check."""
    return checked(t).by_check().select("check", "error_records")


@query(BASE + "SELECT 'Price above limit: price' AS message, 'sales' AS mail_group, count(*) AS error_records FROM graded WHERE e7")
def dq_custom_summary(t: Tables) -> DataFrame:
    """[Q26] Errors of custom checks."""
    return checked(t).custom()


@query(BASE + """
, n AS (SELECT count(*) FILTER (WHERE e1) AS n1, count(*) FILTER (WHERE e2) AS n2, count(*) FILTER (WHERE e3) AS n3, count(*) FILTER (WHERE e4) AS n4,
 count(*) FILTER (WHERE e5) AS n5, count(*) FILTER (WHERE e6) AS n6, count(*) FILTER (WHERE e7) AS n7 FROM graded)
SELECT * FROM (SELECT 'null_check' AS rule, n1 + n2 AS errors, CASE WHEN n1 + n2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS status,
  CASE WHEN n1 + n2 = 0 THEN '' ELSE 'Null Check#Mandatory value is missing: ' || concat_ws(',', CASE WHEN n1 > 0 THEN 'status' END, CASE WHEN n2 > 0 THEN 'segment' END) END AS error_text FROM n
 UNION ALL SELECT 'numeric_check', n3, CASE WHEN n3 = 0 THEN 'TRUE' ELSE 'FALSE' END, CASE WHEN n3 = 0 THEN '' ELSE 'Numeric Check#Value is not numeric: price' END FROM n
 UNION ALL SELECT 'date_check', n4, CASE WHEN n4 = 0 THEN 'TRUE' ELSE 'FALSE' END, CASE WHEN n4 = 0 THEN '' ELSE 'Date Check#Out of range: day' END FROM n
 UNION ALL SELECT 'valid_value_check', n5, CASE WHEN n5 = 0 THEN 'TRUE' ELSE 'FALSE' END, CASE WHEN n5 = 0 THEN '' ELSE 'Value Check#Invalid value: status' END FROM n
 UNION ALL SELECT 'duplicate_check', n6, CASE WHEN n6 = 0 THEN 'TRUE' ELSE 'FALSE' END, CASE WHEN n6 = 0 THEN '' ELSE 'Duplicate Check#Duplicate record: custkey' END FROM n
 UNION ALL SELECT 'df_custom_check', n7, CASE WHEN n7 = 0 THEN 'TRUE' ELSE 'FALSE' END, CASE WHEN n7 = 0 THEN '' ELSE 'Custom Check#Price above limit: price' END FROM n)
""")
def dq_log(t: Tables) -> DataFrame:
    """[Q27] One row per rule."""
    return checked(t).log().select("rule", "errors", "status", "error_text")


@query(BASE + """
SELECT orderkey, concat_ws(',', CASE WHEN e1 OR e5 THEN 'status' END, CASE WHEN e2 THEN 'segment' END, CASE WHEN e3 OR e7 THEN 'price' END,
 CASE WHEN e4 THEN 'day' END, CASE WHEN e6 THEN 'custkey' END) AS marked FROM graded WHERE grade <> 'ok'
""")
def dq_error_columns(t: Tables) -> DataFrame:
    """[Q28] Columns named by a row's errors, in a fixed order."""
    named = report.error_columns(F.col("errors"))
    ordered = F.filter(F.array(*map(F.lit, ("status", "segment", "price", "day", "custkey"))), lambda c: F.array_contains(named, c))
    return checked(t).invalid.select("orderkey", F.array_join(ordered, ",").alias("marked"))


@query(BASE + """
SELECT orderkey, string_split(m, '-')[1] AS mail_group, substring(m, strpos(m, '-') + 1) AS description,
 CASE WHEN m LIKE 'core-Null%' THEN 'high' WHEN m LIKE 'core-%' THEN 'medium' ELSE 'low' END AS priority
FROM (SELECT *, unnest(string_split(description, ';')) AS m FROM graded WHERE grade = 'medium')
""")
def dq_export_medium(t: Tables) -> DataFrame:
    """[Q21, Q30] Export lines of one grade, each error with its own priority."""
    done = checked(t)
    rows = report.export_frame(done.invalid, done.columns, done.key, "medium", "orders_2024.csv", "gate", RUN_TIME)
    return rows.select("orderkey", "mail_group", F.col("ERROR_DESCRIPTION").alias("description"), F.col("priority_level").alias("priority"))


@query(BASE + """
SELECT grade, CASE WHEN grade = 'low' THEN 'processed' END AS status, count(*) AS n FROM graded WHERE grade <> 'ok' GROUP BY ALL
""")
def dq_mark_processed(t: Tables) -> DataFrame:
    """[Q29] Low rows marked as processed."""
    rows = report.mark_processed(checked(t).error_rows("orders_2024.csv", "gate", RUN_TIME), "low")
    return report.by_grade(rows).groupBy("grade", "status").agg(F.count(F.lit(1)).alias("n"))


@query(BASE + "SELECT CAST(count(*) AS BIGINT) AS errors, 1 AS files, (SELECT count(*) FROM orders) AS records FROM graded WHERE grade <> 'ok'")
def dq_totals(t: Tables) -> DataFrame:
    """[Q32] Errors, files and records over the summary."""
    rows = checked(t).error_rows("orders_2024.csv", "gate", RUN_TIME)
    return report.totals_by_file(report.summary(rows, t.orders.count(), "XX", "ORDERS", "err", "err.csv", "/landing"))


@query("""
WITH errs AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'a.csv' WHEN o_orderkey % 3 = 1 THEN 'b.csv' ELSE 'c.csv' END AS f,
 DATE '2024-03-01' - CAST(o_orderkey % 6 AS INTEGER) AS d FROM orders)
SELECT f AS filename, count(*) AS n FROM errs WHERE f <> 'a.csv' AND d >= DATE '2024-02-27' GROUP BY 1
UNION ALL SELECT 'a.csv', count(*) FROM orders WHERE o_orderstatus = 'P'
""")
def dq_error_table(t: Tables) -> DataFrame:
    """[Q19] Upkeep of the error table: the file's earlier rows and old rows go, new ones come."""
    k = F.col("o_orderkey")
    file = F.get(F.array(F.lit("a.csv"), F.lit("b.csv"), F.lit("c.csv")), (k % 3).cast("int"))
    day = F.date_sub(F.lit(dt.date(2024, 3, 1)), (k % 6).cast("int")).cast("timestamp")
    old = t.orders.select(k, file.alias("FILENAME"), day.alias("PROCESSED_DATE"))
    new = t.orders.filter("o_orderstatus = 'P'").select(k, F.lit("a.csv").alias("FILENAME"), F.lit(RUN_TIME).alias("PROCESSED_DATE"))
    rows = report.refresh_error_table(old, new, "A.csv", dt.date(2024, 3, 1))
    return rows.groupBy(F.col("FILENAME").alias("filename")).agg(F.count(F.lit(1)).alias("n"))


CUSTOM_SQL = """
SELECT d.*, CASE WHEN c.c_acctbal < 0 AND d.o_totalprice > 200000 THEN 'Custom Check#Large order on negative balance' END AS processing_status_2,
 CASE WHEN c.c_acctbal < 0 AND d.o_totalprice > 200000 THEN 'medium' END AS priority_status_2
FROM {data} d LEFT JOIN {customer} c ON d.o_custkey = c.c_custkey
"""


@query("""
SELECT o_orderkey, CASE WHEN c_acctbal < 0 AND o_totalprice > 200000 THEN 'medium' ELSE 'ok' END AS grade,
 CASE WHEN c_acctbal < 0 AND o_totalprice > 200000 THEN 'fin-Custom Check#Large order on negative balance' END AS description
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def dq_custom_sql(t: Tables) -> DataFrame:
    """[Q10] A query rule that reads another table."""
    rule = Rule("custom_check", "custom", (), "", "low", "fin", CUSTOM_SQL)
    done = gate(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), [rule], ["o_orderkey"], views={"customer": t.customer})
    return done.tagged.select("o_orderkey", "grade", report.render(F.col("errors")).alias("description"))


HISTORY_SQL = """
SELECT d.*, CASE WHEN p.n IS NULL THEN 'Custom Check#Customer not in last delivery' END AS processing_status_2,
 CASE WHEN p.n IS NULL THEN 'low' END AS priority_status_2
FROM {data} d LEFT JOIN (SELECT o_custkey AS pk, count(*) AS n FROM {previous} GROUP BY o_custkey) p ON d.o_custkey = p.pk
"""


@query("""
WITH d AS (SELECT *, CAST(o_orderdate AS DATE) AS run FROM orders),
prev AS (SELECT DISTINCT o_custkey FROM d WHERE run = (SELECT max(run) FROM d WHERE run < DATE '2000-01-01'))
SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM prev) THEN 'ok' ELSE 'low' END AS grade FROM orders
""")
def dq_history(t: Tables) -> DataFrame:
    """[Q11] A query rule that reads the last delivery before a day."""
    runs = t.orders.withColumn("run", F.to_date("o_orderdate"))
    last = previous_snapshot(runs, "run", dt.date(2000, 1, 1))
    rule = Rule("history_check", "history", (), "", "low", "fin", HISTORY_SQL)
    done = gate(t.orders.select("o_orderkey", "o_custkey"), [rule], ["o_orderkey"], previous=last)
    return done.tagged.select("o_orderkey", "grade")


@query("""
SELECT doc_id, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) > 1 AS is_copy
FROM (SELECT doc_id, text, lang FROM documents UNION ALL SELECT doc_id, text, lang FROM documents WHERE lang = 'fr')
""")
def dq_whole_row(t: Tables) -> DataFrame:
    """[Q09] Whole-row duplicates: all but the first copy fail; some rows are delivered twice, key and all."""
    rule = Rule("duplicate_check", "duplicate", ("text",), "Duplicate Check#Copy", "medium", "docs")
    rows = t.documents.select("doc_id", "text", "lang")
    done = gate(rows.unionByName(rows.filter("lang = 'fr'")), [rule], ["doc_id"])
    return done.tagged.select("doc_id", (F.col("grade") == "medium").alias("is_copy"))


FILTER_SQL = """
SELECT d.*, 'Custom Check#Large order' AS processing_status_2, 'medium' AS priority_status_2
FROM {data} d JOIN {lineitem} l ON d.o_orderkey = l.l_orderkey WHERE d.o_totalprice > 300000
"""


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 AND o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'medium' ELSE 'ok' END AS grade FROM orders
""")
def dq_custom_filter(t: Tables) -> DataFrame:
    """[Q10, Q17] A query rule that filters and joins to many rows: every order comes out once all the same."""
    rule = Rule("custom_check", "custom", (), "", "low", "fin", FILTER_SQL)
    done = gate(t.orders.select("o_orderkey", "o_totalprice"), [rule], ["o_orderkey"], views={"lineitem": t.lineitem})
    return done.valid.select("o_orderkey", F.lit("ok").alias("grade")).unionByName(done.held.select("o_orderkey", "grade"))


@query("SELECT o_orderkey, 'ok' AS grade FROM orders")
def dq_no_rules(t: Tables) -> DataFrame:
    """[Q02] Without rules everything passes."""
    return gate(t.orders, [], ["o_orderkey"]).tagged.select("o_orderkey", "grade")


RULE_ROWS = [
    ("null_check", "US,XX", "ORDERS", "ORDERS%", "orders_*.csv", "A", "status,segment", "Null Check#Missing", "high", "core", None),
    ("numeric_check", "US", "ORDERS", "ORDERS%", "orders_*.csv", "A", "price", "Numeric Check#Bad", "medium", "core", None),
    ("valid_value_check", "XX", "orders", "%2024%", "orders_*.csv", "a", "status", "Value Check#Bad", "low", "sales", "O,F"),
    ("date_check", "XX", "ORDERS", "ORDERS%", "orders_*.csv", "I", "day", "Date Check#Bad", "low", "core", "yyyy-MM-dd"),
]

STRUCTURE_ROW = ("structure_check", "XX", "ORDERS", "ORDERS%", "orders_*.csv", "A", None, "Structure#Columns differ", "high", "core", None)

RULE_SCHEMA = (
    "rule_name string, country_code string, source_system string, file_name string, config_filename_format string, "
    "active_flag string, column_name string, subject_line string, priority_level string, mail_group string, sql_query string"
)


@query(BASE + "SELECT orderkey, CASE WHEN e1 OR e2 THEN 'high' WHEN e5 THEN 'low' ELSE 'ok' END AS grade FROM graded")
def dq_selected_rules(t: Tables) -> DataFrame:
    """[Q01] Rules picked from the rule table for one file, then applied."""
    table = t.spark.createDataFrame(RULE_ROWS, RULE_SCHEMA)
    picked = to_rules(select_rules(table, "xx", "Orders", "orders_2024.csv", "orders_*.csv"))
    return gate(source(t), picked, ["orderkey"]).tagged.select("orderkey", "grade")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def date_normalise(t: Tables) -> DataFrame:
    """[Q13, Q15, Q16] Four local date patterns to one."""
    k = F.col("o_orderkey") % 4
    shown = (
        F.when(k == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .when(k == 1, F.date_format("o_orderdate", "dd.MM.yyyy"))
        .when(k == 2, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    formats = [
        LocalFormat("dd/MM/yyyy"),
        LocalFormat("dd.MM.yyyy", file_pattern="orders"),
        LocalFormat("MM.dd.yyyy", active="I"),
        LocalFormat("MM/dd/yyyy", file_pattern="returns"),
    ]
    rows = t.orders.select("o_orderkey", shown.alias("day"))
    return normalise_dates(rows, ["day"], "yyyy-MM-dd", formats, "ORDERS_2024.csv")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS at FROM events")
def timestamp_normalise(t: Tables) -> DataFrame:
    """[Q14] Local timestamps, the local time part kept."""
    rows = t.events.select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm").alias("at"))
    return normalise_dates(rows, ["at"], "yyyy-MM-dd", [LocalFormat("dd/MM/yyyy HH:mm", with_time=True)])


@query("SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS day FROM orders")
def separator_unify(t: Tables) -> DataFrame:
    """[Q16] Separators brought to the expected one."""
    sep = F.get(F.array(*map(F.lit, "./-,")), (F.col("o_orderkey") % 4).cast("int"))
    parts = [F.date_format("o_orderdate", p) for p in ("dd", "MM", "yyyy")]
    rows = t.orders.select("o_orderkey", F.concat(parts[0], sep, parts[1], sep, parts[2]).alias("day"))
    return normalise_dates(rows, ["day"], "dd.MM.yyyy")


@query("""
SELECT 'orders' AS "table", count(*) AS n FROM orders WHERE o_totalprice > 400000 UNION ALL
SELECT 'customer', count(*) FROM customer WHERE c_acctbal < 0
""")
def post_load_rules(t: Tables) -> DataFrame:
    """[Q31] Active post-load rules of a region run against the loaded tables."""
    entry = lambda name, sql, target, active="A", region="EU": {
        "name": name, "query": sql, "target": target, "active": active, "region": region
    }
    found = post_load(
        t.spark,
        [
            entry("large", "SELECT count(*) AS n FROM {orders} WHERE o_totalprice > 400000", "orders"),
            entry("owing", "SELECT count(*) AS n FROM {customer} WHERE c_acctbal < 0", "customer"),
            entry("idle", "SELECT count(*) AS n FROM {orders}", "orders", "I"),
            entry("skip", "SELECT count(*) AS n FROM {orders}", "orders"),
        ],
        "EU",
        excluded=["skip"],
        views={"orders": t.orders, "customer": t.customer},
    )
    return stack_tagged({name.split(".")[0]: df for name, df in found.items()}, "table")


@query(BASE + """
SELECT CASE WHEN e1 OR e2 THEN 'high' ELSE 'low' END AS grade, count(*) AS n, f AS filename
FROM graded, (VALUES ('orders_2024.csv'), ('Orders_2024b.csv')) AS files(f) WHERE e1 OR e2 OR e5 GROUP BY 1, 3
""")
def dq_file_run(t: Tables) -> DataFrame:
    """[Q01, Q03, Q17 to Q24] Runs of two files at one time, twice: a second delivery replaces its own file's rows only."""
    table = t.spark.createDataFrame([*RULE_ROWS, STRUCTURE_ROW], RULE_SCHEMA)
    errors, summary = work_path(t.spark, "error_table"), work_path(t.spark, "summary")
    rows = source(t)
    for hour in (6, 7):
        at = dt.datetime(2024, 3, 1, hour)
        for file in ("orders_2024.csv", "Orders_2024b.csv"):
            delivery = Delivery(file, "orders_*.csv", "xx", "Orders", "gate", at)
            check_file(rows, table, ["orderkey"], delivery, errors, summary, expected=rows.columns)
    rows = report.by_grade(read_files(t.spark, errors))
    return rows.groupBy("grade", F.col("FILENAME").alias("filename")).agg(F.count(F.lit(1)).alias("n"))
