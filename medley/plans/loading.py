"""Incremental loads, reconciliation and streaming over the order and event tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.operators import aggregates, joins, load, reconcile
from medley.operators.reshape import stack_tagged
from medley.plans.base import Tables, money, number, query
from medley.session import work_path
from medley.sources import files, landing, snapshots, typed
from medley.streaming import entities, hourly


@query("""
SELECT 'day' AS mode, o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) - DATE '2000-06-30' > 0
UNION ALL SELECT 'timestamp', o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-30 00:00:00'
""")
def incremental_slice(t: Tables) -> DataFrame:
    """[L01, L02] Rows after a watermark, by day and by timestamp."""
    at = dt.datetime(2000, 6, 30)
    rows = t.orders.select("o_orderkey", "o_orderdate")
    assert load.mode("I", at) == "incremental"
    parts = {m: load.incremental(rows, "o_orderdate", at, m).select("o_orderkey") for m in ("day", "timestamp")}
    return stack_tagged(parts, "mode")


@query("""
SELECT c_custkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'EUROPE' AND n_name NOT IN ('NATION_3') AND (c_mktsegment = 'BUILDING' OR c_mktsegment NOT IN ('MACHINERY'))
""")
def full_slice(t: Tables) -> DataFrame:
    """[L03] Full read by region, excluded country and record type."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    cut = load.full_slice(rows, ("r_name", "EUROPE"), ("n_name", ["NATION_3"]), ("c_mktsegment", "BUILDING", ["MACHINERY"]))
    return cut.select("c_custkey", "c_mktsegment")


def _target(t: Tables) -> DataFrame:
    """Orders loaded so far: all but the youngest, with an older status."""
    return t.orders.filter("o_orderkey % 5 <> 0").select("o_orderkey", F.lit("old").alias("state"), "o_orderdate")


def _source(t: Tables) -> DataFrame:
    """New delivery: changed and added orders, every key twice with an older and a newer copy."""
    rows = t.orders.filter("o_orderkey % 5 = 0 or o_orderkey % 3 = 0")
    copies = rows.withColumn("state", F.explode(F.array(F.lit("n1"), F.lit("n2"))))
    return copies.select("o_orderkey", "state", "o_orderdate")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN 'n2' ELSE 'old' END AS state FROM orders
""")
def merge_upsert(t: Tables) -> DataFrame:
    """[L05, L12] Merge by key, the newest of several source rows wins."""
    return load.merge(_target(t), _source(t), ["o_orderkey"], ["state"]).select("o_orderkey", "state")


@query("""
SELECT o_orderkey, 'new' AS state FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'
UNION ALL SELECT o_orderkey, 'old' FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
""")
def replace_slice(t: Tables) -> DataFrame:
    """[L04] A slice deleted by predicate and inserted anew."""
    inside = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    new = t.orders.filter(inside).select("o_orderkey", F.lit("new").alias("state"), "o_orderdate")
    return load.replace_slice(_target(t), new, inside).select("o_orderkey", "state")


@query("""
SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0 AND NOT (o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' AND o_orderkey % 3 <> 0)
""")
def delete_vanished(t: Tables) -> DataFrame:
    """[L06, J06] Keys of a slice that left the source are deleted."""
    inside = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    return load.delete_vanished(_target(t), _source(t), ["o_orderkey"], inside).select("o_orderkey")


@query("""
SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders
WHERE o_orderkey % 5 <> 0 AND o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' AND o_orderkey % 3 <> 0
""")
def vanished_keys(t: Tables) -> DataFrame:
    """[L06] The vanished rows themselves, counted."""
    inside = F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    gone = load.vanished(_target(t), _source(t), ["o_orderkey"], inside)
    return gone.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' THEN 'new' ELSE 'old' END AS state
FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'
""")
def replace_period(t: Tables) -> DataFrame:
    """[L09] Periods of the new data replaced, the rest kept."""
    period = F.year("o_orderdate").alias("period")
    old = _target(t).select("o_orderkey", "state", period)
    new = t.orders.select("o_orderkey", F.lit("new").alias("state"), period).filter("period >= 2001")
    return load.replace_period(old, new, ["period"]).select("o_orderkey", "state")


@query("""
SELECT CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 7 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) + 1 END
  WHEN o_orderkey % 4 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS period,
 CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN 'n2' ELSE 'old' END AS state, count(*) AS n
FROM orders GROUP BY ALL
""")
def merge_partitions(t: Tables) -> DataFrame:
    """[L05, S09] Merge into a partitioned table on disk: rows move to other partitions and into and out of the null one."""
    path = work_path(t.spark, "orders_by_year")
    year, k = F.year("o_orderdate"), F.col("o_orderkey")
    files.write_partitioned(_target(t).select("o_orderkey", "state", F.when(k % 4 != 0, year).alias("period")), path, ["period"])
    source = _source(t).select("o_orderkey", "state", F.when(k % 7 != 0, year + 1).alias("period"))
    load.merge_partitions(t.spark, path, source, ["o_orderkey"], "period", ["state"])
    return t.spark.read.parquet(path).groupBy("period", "state").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 7 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) + 1 END
  WHEN o_orderkey % 4 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS period,
 CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN 'n2' ELSE 'old' END AS state, count(*) AS n
FROM orders GROUP BY ALL
""")
def merge_snapshot(t: Tables) -> DataFrame:
    """[L05, L12] The same merge into a table kept by a manifest: the whole change or none of it."""
    path = work_path(t.spark, "orders_snapshot")
    year, k = F.year("o_orderdate"), F.col("o_orderkey")
    load.replace_periods(_target(t).select("o_orderkey", "state", F.when(k % 4 != 0, year).alias("period")), path, "period")
    source = _source(t).select("o_orderkey", "state", F.when(k % 7 != 0, year + 1).alias("period"))
    load.merge_snapshot(t.spark, path, source, ["o_orderkey"], "period", ["state"])
    return snapshots.read(t.spark, path).groupBy("period", "state").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS n, CAST(sum(CASE WHEN year(o_orderdate) IN (1994, 1995) THEN 1 ELSE 0 END) AS BIGINT) AS again
FROM orders WHERE year(o_orderdate) NOT IN (1994, 1995) OR o_orderkey % 2 = 0 GROUP BY 1
""")
def replace_periods(t: Tables) -> DataFrame:
    """[L09] Two years delivered again with fewer rows take the place of the old ones, at once."""
    path = work_path(t.spark, "orders_periods")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("period"))
    load.replace_periods(rows.withColumn("again", F.lit(0)), path, "period")
    load.replace_periods(rows.filter("period IN (1994, 1995) AND o_orderkey % 2 = 0").withColumn("again", F.lit(1)), path, "period")
    return snapshots.read(t.spark, path).groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum("again").alias("again"))


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000)
""")
def in_table_values(t: Tables) -> DataFrame:
    """[L07] A filter by values held in a table."""
    listed = t.supplier.filter("s_acctbal < 1000").select("s_suppkey")
    return load.in_values(t.lineitem, "l_suppkey", listed).select("l_orderkey", "l_linenumber")


@query("""
SELECT 'events' AS "table", 'event_type' AS "column", 'Missing Values' AS kind, unnest(['refund', 'search']) AS value
UNION ALL SELECT DISTINCT 'events', 'event_type', 'New Values', event_type FROM events WHERE event_type NOT IN ('click', 'view', 'refund', 'search')
UNION ALL SELECT DISTINCT 'part', 'p_size', 'New Values', CAST(p_size AS VARCHAR) FROM part WHERE p_size > 40
""")
def value_drift(t: Tables) -> DataFrame:
    """[C04] New and missing values against allowed lists as rows, a text and a number column."""
    config = [
        ("events", "event_type", ["click", "view", "search", "refund"]),
        ("part", "p_size", [str(i) for i in range(1, 41)]),
    ]
    return reconcile.drift_rows({"events": t.events, "part": t.part}, config)


@query("""
SELECT coalesce(o_orderkey, l_orderkey) AS orderkey, coalesce(a, 0) AS n_a, coalesce(b, 0) AS n_b, coalesce(a, 0) - coalesce(b, 0) AS diff,
 CASE WHEN b IS NULL THEN 'only_a' WHEN a IS NULL THEN 'only_b' WHEN a = b THEN 'match' ELSE 'differ' END AS status
FROM (SELECT o_orderkey, count(*) AS a FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) FULL JOIN
 (SELECT l_orderkey, count(*) AS b FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
""")
def count_reconcile(t: Tables) -> DataFrame:
    """[C02, A21] Counts by key on both sides."""
    a = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("orderkey"))
    b = t.lineitem.select(F.col("l_orderkey").alias("orderkey"))
    return reconcile.counts_by_key(a, b, ["orderkey"])


@query("SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1")
def orders_per_shop(t: Tables) -> DataFrame:
    """[A21] Orders per customer, as the count report lists them per shop."""
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS report_date, count(*) AS n_a, count(*) FILTER (WHERE event_type <> 'error') AS n_b,
 CASE WHEN count(*) = count(*) FILTER (WHERE event_type <> 'error') THEN 'match' ELSE 'differ' END AS status FROM events GROUP BY 1
""")
def loaded_vs_raw(t: Tables) -> DataFrame:
    """[C01, A20, S09, X06] Raw text lines of each day's files against loaded rows."""
    path = work_path(t.spark, "raw_lines")
    day = F.to_date("ts")
    raw = t.events.select(F.to_json(F.struct("event_id", "event_type")).alias("value"), day.alias("report_date"))
    raw.write.partitionBy("report_date").text(path)
    loaded = t.events.filter("event_type <> 'error'").select(day.alias("day"))
    rows = reconcile.loaded_vs_raw(landing.read_lines(t.spark, path), "path", loaded, "day")
    return rows.select(F.col("report_date").cast("string").alias("report_date"), "n_a", "n_b", "status")


@query("""
SELECT 'events' AS "table", 'value' AS "column", CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS key, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS metric
 FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-10' GROUP BY ALL
UNION ALL SELECT 'orders', 'price', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), NULL, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders GROUP BY ALL
""")
def volume_metrics(t: Tables) -> DataFrame:
    """[C05] Daily volumes of two tables, one with a further key and a watermark."""
    tables = {
        "events": t.events.withColumn("value", money("value")),
        "orders": t.orders.withColumn("price", money("o_totalprice")),
    }
    config = [("events", "ts", "value", "event_type"), ("orders", "o_orderdate", "price", None)]
    rows = reconcile.volume_metrics(tables, config, dt.date(2024, 3, 1), {"events": dt.date(2024, 1, 10)})
    return rows.withColumns({"day": F.col("day").cast("string"), "metric": number(F.col("metric"))})


@query("""
SELECT 'daily' AS source, 'https://s' || CAST(c_custkey AS VARCHAR) || '/graphql.json' AS url, 'timeout' AS error_message FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'hourly', 'https://s' || CAST(s_suppkey AS VARCHAR) || '/graphql.json', 'denied' FROM supplier WHERE s_acctbal < 0
""")
def error_report_union(t: Tables) -> DataFrame:
    """[C06, C07, T02] Error reports of two batches, tagged and stacked."""
    line = lambda key, text: F.concat(F.lit("https://s"), F.col(key).cast("string"), F.lit(f"/graphql.json {text}")).alias("line")
    day = dt.date(2024, 3, 1)
    daily = reconcile.error_reports(t.customer.filter("c_acctbal < 0").select(line("c_custkey", "timeout")), "line", "/graphql.json", day)
    hour = reconcile.error_reports(t.supplier.filter("s_acctbal < 0").select(line("s_suppkey", "denied")), "line", "/graphql.json", day)
    rows = reconcile.all_error_reports({"daily": daily, "hourly": hour}, dt.datetime(2024, 3, 1, 6))
    return rows.select("source", "url", "error_message")


@query("""
SELECT DISTINCT 'https://api/' || CAST(user_id AS VARCHAR) AS url, user_id AS shop FROM events WHERE event_type = 'error'
""")
def retry_requests(t: Tables) -> DataFrame:
    """[C08, T06] Failed requests kept with their context and read again."""
    request = F.struct(F.concat(F.lit("https://api/"), F.col("user_id").cast("string")).alias("url"), F.col("user_id").alias("shop"))
    status = F.when(F.col("event_type") == "error", 500).otherwise(200)
    failed = reconcile.failed_requests(t.events.select(request.alias("request"), status.alias("status")), "request", "status")
    return reconcile.retry_requests(failed, "url string, shop long")


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_partition_counts(t: Tables) -> DataFrame:
    """[R01, S09] Date partitions rewritten in batch, twice, which changes nothing."""
    path = work_path(t.spark, "event_partitions")
    hourly.rewrite_partition(t.events, path, "ts")
    hourly.rewrite_partition(t.events.filter("ts < '2024-01-03'"), path, "ts")
    rows = t.spark.read.parquet(path).groupBy("event_date", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("event_date", F.col("event_date").cast("string"))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM events GROUP BY 1")
def stream_partition_counts(t: Tables) -> DataFrame:
    """[R01, R02] The same as a stream, in micro-batches, delivered twice by two queries: each event lands once."""
    path = work_path(t.spark, "event_stream")
    for _ in range(2):
        stream = hourly.read_events(t.spark, t.path, t.events.schema, "events.parquet")
        hourly.stream_to_partitions(stream, path, work_path(t.spark, "stream_state"), "ts", ["event_id"]).awaitTermination()
    rows = t.spark.read.parquet(path).groupBy("event_date")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_ids")).withColumn(
        "event_date", F.col("event_date").cast("string")
    )


@query("""
SELECT entity, CAST(CAST(date_trunc('year', day) AS DATE) AS VARCHAR) AS event_date, count(*) AS n FROM (
 SELECT event_type AS entity, ts AS day FROM events UNION ALL SELECT 'orders', o_orderdate FROM orders
 UNION ALL (SELECT 'order_lines', min(l_shipdate) FROM lineitem GROUP BY l_orderkey, l_linenumber, year(l_shipdate))) GROUP BY ALL
""")
def entity_stream_counts(t: Tables) -> DataFrame:
    """[R01, R02] Seven entities from their landing folders as one stream, delivered twice: each key of a year once, late rows included."""
    landing, path, state = (work_path(t.spark, n) for n in ("landing", "entities", "entity_state"))
    kinds = [entities.Entity(n, ["event_id"], "ts") for n in ("view", "signup", "click", "error", "purchase")]
    kinds += [entities.Entity("orders", ["o_orderkey"], "o_orderdate"), entities.Entity("order_lines", ["l_orderkey", "l_linenumber"], "l_shipdate")]
    line = lambda *columns: F.to_json(F.struct(*columns)).alias("value")
    raw = t.events.select(F.col("event_type").alias("entity"), line("event_id", "ts", "user_id", "props"))
    raw = raw.unionByName(t.orders.select(F.lit("orders").alias("entity"), line("o_orderkey", "o_orderdate", "o_orderstatus")))
    raw = raw.unionByName(t.lineitem.select(F.lit("order_lines").alias("entity"), line("l_orderkey", "l_linenumber", "l_shipdate")))
    for _ in range(2):
        raw.write.partitionBy("entity").mode("append").text(landing)
        entities.load_entities(entities.read_landing(t.spark, landing, kinds), path, state, period="year").awaitTermination()
    rows = entities.with_late(t.spark, path).groupBy("entity", F.col("event_date").cast("string").alias("event_date"))
    return rows.agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL
""")
def window_counts(t: Tables) -> DataFrame:
    """[R01] Tumbling windows."""
    rows = hourly.window_counts(t.events, "ts", ["event_type"], "6 hours")
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n")


@query("""
SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start, count(*) AS n FROM
 (SELECT unnest([time_bucket(INTERVAL 2 HOUR, ts), time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 2 HOUR, time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 4 HOUR]) AS w FROM events) GROUP BY 1
""")
def sliding_counts(t: Tables) -> DataFrame:
    """[R01] Sliding windows of six hours every two."""
    rows = hourly.window_counts(t.events, "ts", [], "6 hours", "2 hours")
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "n")


@query("""
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS s FROM events),
g AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n FROM g GROUP BY user_id, g
""")
def session_counts(t: Tables) -> DataFrame:
    """[R01] Sessions by user with a gap of half a day."""
    rows = hourly.session_counts(t.events, "ts", ["user_id"], "12 hours")
    return rows.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


@query("SELECT event_id, event_type, value, '2024-03-01' AS report_date FROM events")
def ndjson_round_trip(t: Tables) -> DataFrame:
    """[S07, S11, S17] JSON lines into a day's partition, replaced on a second load, unknown fields dropped."""
    raw, table = work_path(t.spark, "ndjson"), work_path(t.spark, "events_table")
    files.export_ndjson(t.events.select("event_id", "event_type", "value", "props"), raw)
    for _ in range(2):
        landing.load_ndjson(t.spark, raw, "event_id long, event_type string, value double", dt.date(2024, 3, 1), table)
    rows = t.spark.read.parquet(table)
    return rows.select("event_id", "event_type", "value", F.col("report_date").cast("string").alias("report_date"))


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def typed_round_trip(t: Tables) -> DataFrame:
    """[S15, S16, S02] Delimited text to typed binary records and back."""
    raw, out = work_path(t.spark, "text"), work_path(t.spark, "typed")
    fields = [("p_partkey", "long"), ("p_name", "string"), ("p_size", "int"), ("p_retailprice", "double")]
    line = F.concat_ws(";", *[F.col(n).cast("string") for n, _ in fields])
    t.part.select(line.alias("value")).write.text(raw)
    used = typed.csv_to_typed(t.spark, raw, out, fields, ";")
    return typed.read_typed(t.spark, out, used)


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(t: Tables) -> DataFrame:
    """[S01, S04, S14] Quoted CSV with a header, read by schema."""
    path = work_path(t.spark, "csv")
    files.write_quoted(t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path, "|")
    return files.read_csv(t.spark, path, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string", sep="|")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def orc_round_trip(t: Tables) -> DataFrame:
    """[S06] ORC written and read by format name."""
    path = work_path(t.spark, "orc")
    files.write_table(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), path, "orc")
    return files.read_table(t.spark, path, "orc")


@query("SELECT event_type AS kind, count(*) AS n FROM events GROUP BY 1")
def route_by_key(t: Tables) -> DataFrame:
    """[S22] Rows routed to special outputs and to a directory per key."""
    path = work_path(t.spark, "routed")
    landing.route_by_key(t.events.select("event_id", F.col("event_type").alias("kind")), "kind", path, ("error", "signup"))
    special = [t.spark.read.schema("event_id long, kind string").json(f"{path}/{k}") for k in ("error", "signup")]
    data = t.spark.read.schema("event_id long").json(f"{path}/data")
    every = special[0].unionByName(special[1]).unionByName(data.select("event_id", "kind"))
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT n_name AS country, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def split_to_tables(t: Tables) -> DataFrame:
    """[S24] One directory per country in one job."""
    path = work_path(t.spark, "countries")
    places = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    landing.split_to_tables(t.customer.join(places, "c_nationkey"), "country", path)
    return t.spark.read.parquet(path).groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type FROM events")
def tolerant_load(t: Tables) -> DataFrame:
    """[S13] JSON lines with a malformed line are accepted up to a limit."""
    path = work_path(t.spark, "bad_lines")
    good = t.events.select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    broken = t.region.select(F.concat(F.lit('{"event_id": '), F.col("r_name")).alias("value"))
    good.unionByName(broken).write.text(path)
    return landing.load_tolerant(t.spark, path, "event_id long, event_type string", max_bad=25)


@query("SELECT o_orderkey, api FROM orders, (VALUES ('orders'), ('refunds')) a(api)")
def request_batches(t: Tables) -> DataFrame:
    """[A17] Requests of each shop side by side."""
    shops = t.orders.select(F.col("o_orderkey").cast("string").alias("shop"))
    asked = joins.requests(shops, "shop", [("orders", "/{shop_domain}/o"), ("refunds", "/{shop_domain}/r")], {})
    rows = aggregates.shop_batches(asked, "shop_domain")
    return rows.select(F.col("shop_domain").cast("long").alias("o_orderkey"), "api")
