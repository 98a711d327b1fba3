"""Files, landing areas and loads written to the shared folder and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.operators import commerce, joins, load
from medley.plans.base import Tables, query
from medley.session import work_path
from medley.sources import files, landing

DAY = dt.date(2024, 3, 1)
FILE_ROWS = 10_000


def _count_files(t: Tables, path: str) -> int:
    return t.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").count()


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS priority, count(*) AS n, 1 AS files FROM orders GROUP BY ALL")
def single_file(t: Tables) -> DataFrame:
    """[S03] A report over all orders in one file."""
    path = work_path(t.spark, "single")
    report = t.orders.groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    files.write_single_file(report, path)
    return files.read_csv(t.spark, path, "year int, priority string, n long").withColumn("files", F.lit(_count_files(t, path)))


@query("SELECT o_orderpriority AS priority, count(*) AS n, 7 AS files FROM orders GROUP BY 1")
def n_files(t: Tables) -> DataFrame:
    """[S10] A stated number of files."""
    path = work_path(t.spark, "seven")
    files.write_n_files(t.orders.select("o_orderkey", "o_orderpriority"), path, 7)
    rows = files.read_table(t.spark, path).groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("files", F.lit(_count_files(t, path)))


@query("SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part")
def multiline_json(t: Tables) -> DataFrame:
    """[S08] JSON objects that span lines, one array of about FILE_ROWS objects a file."""
    path = work_path(t.spark, "multiline")
    pieces_asked = max(1, -(-t.part.count() // FILE_ROWS))
    fields = [F.concat(F.lit(f'  "{c}": '), F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)) for c in ("p_partkey", "p_name", "p_size")]
    item = F.concat(F.lit("{\n"), F.concat_ws(",\n", *fields), F.lit("\n}"))
    pieces = t.part.select(F.pmod(F.xxhash64("p_partkey"), F.lit(pieces_asked)).alias("k"), item.alias("item"))
    texts = pieces.groupBy("k").agg(F.concat(F.lit("["), F.array_join(F.collect_list("item"), ",\n"), F.lit("]")).alias("value"))
    texts.write.partitionBy("k").text(path)
    return files.read_json_multiline(t.spark, path, "p_partkey long, p_name string, p_size long").drop("k")


@query("SELECT event_type, CAST(2 * count(*) AS BIGINT) AS n, '2024-03-01' AS day FROM events GROUP BY 1")
def ndjson_append(t: Tables) -> DataFrame:
    """[S12] A day's lines loaded twice: appended, not replaced."""
    raw, table = work_path(t.spark, "lines"), work_path(t.spark, "appended")
    files.export_ndjson(t.events.select("event_id", "event_type"), raw)
    for _ in range(2):
        landing.load_ndjson_append(t.spark, raw, "event_id long, event_type string", DAY, table)
    rows = t.spark.read.parquet(table).groupBy("event_type", F.col("report_date").cast("string").alias("day"))
    return rows.agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_orderstatus, '20240301' AS suffix FROM orders WHERE o_orderstatus IN ('O', 'P')")
def open_orders_csv(t: Tables) -> DataFrame:
    """[K14, S18] Open orders as CSV under the run date."""
    rows = commerce.open_orders(t.orders, "o_orderstatus", ["O", "P"]).select("o_orderkey", "o_orderstatus")
    path = files.export_csv_dated(rows, work_path(t.spark, "open") + "/orders_", DAY)
    return files.read_csv(t.spark, path, "o_orderkey long, o_orderstatus string").withColumn("suffix", F.lit(path[-8:]))


@query("SELECT s_suppkey, s_name FROM supplier")
def store_metadata_csv(t: Tables) -> DataFrame:
    """[K16, S18] Newest metadata of every store as CSV under the run date."""
    rows = t.supplier.withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
    shops = rows.withColumn("s_name", F.when(F.col("v") == 2, F.col("s_name")).otherwise("old"))
    found = commerce.store_metadata(shops, "s_suppkey", "v", ["s_name"])
    path = files.export_csv_dated(found, work_path(t.spark, "stores") + "/stores_", DAY)
    return files.read_csv(t.spark, path, "s_suppkey long, s_name string")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def literal_frame(t: Tables) -> DataFrame:
    """[S21] Literal rows as a frame that orders are looked up in."""
    wanted = files.frame_from(t.spark, [("1-URGENT",), ("5-LOW",), (None,)], "o_orderpriority string")
    return joins.semi(t.orders.select("o_orderkey", "o_orderpriority"), wanted, ["o_orderpriority"])


@query("SELECT 2024 AS year, 3 AS month, 1 AS day, count(*) AS n FROM customer UNION ALL SELECT 2024, 3, 2, count(*) FROM customer WHERE c_acctbal < 0")
def archive_days(t: Tables) -> DataFrame:
    """[S23] Copies under year, month and day; a second copy replaces its own day only."""
    path = work_path(t.spark, "archive")
    rows = t.customer.select("c_custkey", "c_acctbal")
    files.archive_by_date(rows.filter("c_acctbal > 0"), path, DAY)
    files.archive_by_date(rows.filter("c_acctbal < 0"), path, dt.date(2024, 3, 2))
    files.archive_by_date(rows, path, DAY)
    names = [F.col(a).cast("int").alias(b) for a, b in (("Year", "year"), ("Month", "month"), ("Day", "day"))]
    return t.spark.read.parquet(path).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def view_counts(t: Tables) -> DataFrame:
    """[S25] A registered view, counted by SQL and dropped again."""
    name = work_path(t.spark, "view").rsplit("/", 1)[1].replace("-", "_")
    files.register_view(t.customer, name)
    try:
        return t.spark.sql(f"SELECT c_mktsegment, count(*) AS n FROM {name} GROUP BY c_mktsegment")
    finally:
        t.spark.catalog.dropTempView(name)


@query("SELECT c_mktsegment AS segment, count(*) AS n FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1")
def unprocessed_files(t: Tables) -> DataFrame:
    """[S26] Files of a directory that the log does not name yet."""
    path = work_path(t.spark, "delivered")
    files.write_partitioned(t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment")), path, ["segment"])
    listed = landing.list_files(t.spark, path).filter(F.contains("file_name", F.lit("/part-")))
    log = listed.filter(F.contains("file_name", F.lit("segment=FURNITURE"))).select("file_name")
    fresh = landing.unprocessed(listed, log).select(F.regexp_extract("file_name", "segment=.*", 0).alias("name"))
    rows = t.spark.read.parquet(path).withColumn("name", F.regexp_extract(F.col("_metadata.file_path"), "segment=.*", 0))
    return joins.semi(rows, fresh, ["name"]).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name FROM customer")
def staging_table(t: Tables) -> DataFrame:
    """[S27] A table made if it is missing, filled through a staging view, and both dropped."""
    name = work_path(t.spark, "stage").rsplit("/", 1)[1].replace("-", "_")
    for _ in range(2):
        landing.create_table_if_missing(t.spark, name, "c_custkey long, c_name string")
    t.customer.select(F.col("c_custkey").cast("long"), "c_name").write.mode("append").saveAsTable(name)
    path = work_path(t.spark, "staged")
    t.spark.table(name).write.parquet(path)
    landing.drop_staging(t.spark, name)
    return t.spark.read.parquet(path)


@query("SELECT event_id, 'lines' AS place FROM events WHERE event_type = 'error'")
def empty_landing(t: Tables) -> DataFrame:
    """[S28] A directory with files, and one without, which gives an empty frame of the schema."""
    path = work_path(t.spark, "landing")
    files.export_ndjson(t.events.filter("event_type = 'error'").select("event_id"), path)
    found = landing.read_if_any(t.spark, path, "event_id long").withColumn("place", F.lit("lines"))
    none = landing.read_if_any(t.spark, work_path(t.spark, "nothing"), "event_id long").withColumn("place", F.lit("none"))
    return found.unionByName(none)


@query("SELECT 'orders' AS name, count(*) AS count, 'OK' AS status FROM orders UNION ALL SELECT 'customer', count(*), 'OK' FROM customer")
def process_log(t: Tables) -> DataFrame:
    """[L08] One log row per load, appended."""
    path, at = work_path(t.spark, "log"), dt.datetime(2024, 3, 1, 6)
    for name in ("orders", "customer"):
        count = getattr(t, name).count()
        load.process_log(t.spark, name, count, "daily", "shop", at, at, "OK").write.mode("append").parquet(path)
    return t.spark.read.parquet(path).select("name", "count", "status")


@query("SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, true AS refused FROM events")
def checked_overwrite(t: Tables) -> DataFrame:
    """[L10] A table replaced only if as many rows were loaded as there are lines; a short load is refused."""
    raw, path = work_path(t.spark, "raw"), work_path(t.spark, "checked")
    files.export_ndjson(t.events.select("event_id"), raw)
    lines, loaded = t.spark.read.text(raw), files.read_json_lines(t.spark, raw, "event_id long")
    load.checked_overwrite(lines, loaded, path)
    try:
        load.checked_overwrite(lines, loaded.filter("event_id % 2 = 0"), path)
        refused = False
    except ValueError:
        refused = True
    rows = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    return rows.withColumn("refused", F.lit(refused))


@query("SELECT c_custkey, 'a' AS batch FROM customer UNION ALL SELECT c_custkey, 'b' FROM customer WHERE c_acctbal < 0")
def stage_append(t: Tables) -> DataFrame:
    """[L11] Prepared staging rows appended to the main table."""
    path = work_path(t.spark, "main")
    rows = t.customer.select("c_custkey", "c_acctbal")
    load.stage_append(rows, path, lambda d: d.select("c_custkey", F.lit("a").alias("batch")))
    load.stage_append(rows, path, lambda d: d.filter("c_acctbal < 0").select("c_custkey", F.lit("b").alias("batch")))
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, lower(trim(t)) AS campaign FROM (SELECT o_orderkey, unnest([o_orderstatus, substring(o_orderpriority, 3)]) AS t FROM orders) GROUP BY ALL")
def campaign_tags(t: Tables) -> DataFrame:
    """[K12] Campaigns out of order tags."""
    tags = F.concat(F.lit("New, camp:"), F.col("o_orderstatus"), F.lit(" ,Camp:"), F.substring(F.col("o_orderpriority"), F.lit(3), F.lit(99)))
    return commerce.campaign_tags(t.orders.withColumn("tags", tags), "o_orderkey", "tags", "camp:")


@query("""
WITH p AS (SELECT l_orderkey, l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS a FROM lineitem GROUP BY ALL),
u AS (SELECT l_orderkey, count(*) AS n_products, sum(a) - max(a) AS upsell FROM p GROUP BY 1 HAVING count(*) >= 2),
s AS (SELECT l_orderkey, min(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS f, max(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS l
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT l_orderkey, n_products AS upsell_n_products, CAST(upsell AS DOUBLE) AS upsell_upsell, f AS shipping_first_days, l AS shipping_last_days FROM u FULL JOIN s USING (l_orderkey)
""")
def order_extracts(t: Tables) -> DataFrame:
    """[K12] Upsells and shipping of every order side by side."""
    lines = t.lineitem.withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))
    ups = commerce.upsells(lines, "l_orderkey", "l_partkey", "price").withColumn("upsell", F.col("upsell").cast("double"))
    placed = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ships = commerce.shipping(placed, "l_orderkey", "l_shipdate", "o_orderdate")
    ships = ships.select("l_orderkey", *[F.col(c).cast("long").alias(c) for c in ("first_days", "last_days")])
    return commerce.combined({"upsell": ups, "shipping": ships}, "l_orderkey")


@query("SELECT o_orderkey, o_orderstatus, l_linenumber FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def order_detail(t: Tables) -> DataFrame:
    """[K12] Every line with its order's columns."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return commerce.order_detail(t.orders, lines, "o_orderkey", ["o_orderstatus"], ["l_linenumber"])
