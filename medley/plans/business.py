"""Commerce tables, reports and layered sales rules."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.operators import allocation, commerce
from medley.operators.reshape import stack_tagged
from medley.plans.base import Tables, money, number, query
from medley.session import materialise

ORDER_SCHEMA = (
    "id bigint, customer bigint, line_items array<struct<sku: bigint, quantity: int, "
    "tax_lines: array<struct<title: string, cents: bigint>>>>, note_attributes array<struct<name: string, value: string>>, "
    "client_details struct<browser: string, size: struct<w: int, h: int>>"
)


def raw_orders(t: Tables) -> DataFrame:
    """Order documents as JSON text, derived row by row: 0 to 3 lines, 1 or 2 taxes on each."""
    key = F.col("o_orderkey")
    count = (key % 4).cast("int")
    tax = lambda title, i: F.struct(F.lit(title).alias("title"), (key + i).alias("cents"))
    line = lambda i: F.struct(
        (key * 10 + i).alias("sku"),
        (i + 1).alias("quantity"),
        F.when(i == 0, F.array(tax("state", i), tax("city", i))).otherwise(F.array(tax("state", i))).alias("tax_lines"),
    )
    lines = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), line))
    notes = F.array(F.struct(F.lit("status").alias("name"), F.col("o_orderstatus").alias("value")))
    client = F.struct(F.col("o_orderpriority").alias("browser"), F.struct(F.lit(3).alias("w"), F.lit(4).alias("h")).alias("size"))
    doc = F.struct(key.alias("id"), F.col("o_custkey").alias("customer"), lines.alias("line_items"),
                   notes.alias("note_attributes"), client.alias("client_details"), F.lit("x").alias("unknown"))
    return t.orders.select(F.to_json(doc).alias("value"))


def nested_orders(t: Tables) -> DataFrame:
    """The documents parsed once into a table that all child tables read."""
    return materialise(commerce.parse_orders(raw_orders(t), "value", ORDER_SCHEMA), "orders")


@query("""
SELECT o_orderkey AS id, i AS position, o_orderkey * 10 + i AS sku, i + 1 AS quantity
FROM orders, range(3) r(i) WHERE i < o_orderkey % 4
""")
def flatten_order_lines(t: Tables) -> DataFrame:
    """[K01, K06] Order lines out of nested orders."""
    rows = commerce.child_tables(nested_orders(t), ["id"], commerce.ORDER_TABLES)["orders_line_items"]
    return rows.select("id", "position", "sku", "quantity")


@query("""
SELECT o_orderkey AS id, i AS line, 0 AS position, 'state' AS title, o_orderkey + i AS cents FROM orders, range(3) r(i) WHERE i < o_orderkey % 4
UNION ALL SELECT o_orderkey, 0, 1, 'city', o_orderkey FROM orders WHERE o_orderkey % 4 > 0
""")
def flatten_tax_lines(t: Tables) -> DataFrame:
    """[K01] A child of a child, with both positions."""
    rows = commerce.child_tables(nested_orders(t), ["id"], commerce.ORDER_TABLES)["orders_line_items_tax_lines"]
    return rows.select("id", F.col("line_items_position").alias("line"), "position", "title", "cents")


@query("SELECT o_orderkey AS id, o_orderpriority AS browser, 3 AS size_w, 4 AS size_h, 'status' AS name, o_orderstatus AS value FROM orders")
def flatten_details(t: Tables) -> DataFrame:
    """[K01, X22] Client details and note attributes, side by side."""
    tables = commerce.child_tables(nested_orders(t), ["id"], commerce.ORDER_TABLES)
    notes = tables["orders_note_attributes"].select("id", "name", "value")
    return tables["orders_client_details"].join(notes, "id")


@query("""
SELECT p_partkey AS id, 'products_variants' AS child, p_size AS n FROM part UNION ALL SELECT p_partkey, 'products_options', 1 FROM part
""")
def flatten_products(t: Tables) -> DataFrame:
    """[K02] Daily entities: variants and options of products, counted per product."""
    variants = F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: F.struct(i.alias("size")))
    options = F.array(F.struct(F.col("p_brand").alias("brand")))
    nested = t.part.select(F.col("p_partkey").alias("id"), variants.alias("variants"), options.alias("options"))
    tables = commerce.child_tables(nested, ["id"], commerce.DAILY_TABLES["products"])
    return stack_tagged({n: d.groupBy("id").agg(F.count(F.lit(1)).alias("n")) for n, d in tables.items()}, "child")


@query("""
SELECT 'full' AS run, count(*) AS n FROM orders UNION ALL SELECT 'changed', count(*) FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2000-01-01'
""")
def entity_rows(t: Tables) -> DataFrame:
    """[K03] Full or incremental run by flag."""
    runs = {"full": True, "changed": False}
    rows = {n: commerce.entity_rows(t.orders, "o_orderdate", dt.date(2000, 1, 1), f).select("o_orderkey") for n, f in runs.items()}
    return stack_tagged(rows, "run").groupBy("run").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') AS is_digital,
 round(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * l_extendedprice / 2, 4) AS amount_usd FROM lineitem
""")
def sales_rows(t: Tables) -> DataFrame:
    """[K05, J08] Sales rows in USD, refunds negative, digital flag."""
    digital = t.part.filter("p_type = 'PROMO'").select("p_partkey")
    lines = t.lineitem.withColumns({"rate": F.lit(2.0), "is_refund": F.col("l_returnflag") == "R"})
    rows = commerce.sales_rows(lines, digital, "l_partkey", "l_extendedprice", "rate", "is_refund")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "is_digital", F.round("amount_usd", 4).alias("amount_usd"))


@query("SELECT DISTINCT sha256('s1' || lower(trim(c_name))) AS hash, lower(trim(c_name)) AS value FROM customer")
def reidentification(t: Tables) -> DataFrame:
    """[K07] Hash and value, kept apart."""
    return commerce.reidentification(t.customer, "c_name", "s1")


@query("""
SELECT user_id, event_type AS name, max(CAST(json_extract(props, '$.k') AS INTEGER)) FILTER (WHERE rn = 1) AS value FROM
 (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rn FROM events) GROUP BY ALL
""")
def metafields(t: Tables) -> DataFrame:
    """[K08] Newest value of every metafield of a product."""
    field = F.struct(F.col("event_type").alias("name"), F.get_json_object("props", "$.k").cast("int").alias("value"))
    rows = t.events.select("user_id", "ts", F.array(field).alias("fields"))
    return commerce.metafields(rows, "user_id", "fields", "ts").select("user_id", "name", "value")


@query("""
SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1999-05-05' AND o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'
""")
def bulk_operations(t: Tables) -> DataFrame:
    """[K09] Operations of a day by status, some shops left out."""
    rows = t.orders.select(
        "o_orderkey", F.to_date("o_orderdate").alias("report_date"), F.col("o_orderstatus").alias("bulk_operation_status"),
        F.col("o_orderpriority").alias("shop_domain"),
    )
    return commerce.bulk_operations(rows, dt.date(1999, 5, 5), exclude=["5-LOW"], status="O").select("o_orderkey")


@query("""
SELECT o_custkey AS shop, o_orderkey, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def store_metadata(t: Tables) -> DataFrame:
    """[K10, K16] Newest row of every shop."""
    rows = t.orders.withColumnRenamed("o_custkey", "shop").withColumn("updated", F.struct("o_orderdate", "o_orderkey"))
    return commerce.store_metadata(rows, "shop", "updated", ["o_orderkey", "o_orderstatus"])


@query("""
SELECT market, p_type, sum(units) AS units, '2024-03-01' AS process_date FROM (
 SELECT 'US' AS market, p_type, l_quantity AS units FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'A'
 UNION ALL SELECT 'AU', p_type, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N') GROUP BY ALL
""")
def chart_report(t: Tables) -> DataFrame:
    """[K11] Chart reports of two markets stacked under a process date."""
    units = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").alias("units"))
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    rows = units.join(kinds, "l_partkey").groupBy("l_returnflag", "p_type").agg(F.sum("units").alias("units"))
    market = lambda flag, name: rows.filter(F.col("l_returnflag") == flag).select(F.lit(name).alias("market"), "p_type", "units")
    report = commerce.chart_report([market("A", "US"), market("N", "AU")], dt.date(2024, 3, 1))
    return report.withColumn("process_date", F.col("process_date").cast("string"))


@query("SELECT o_custkey, count(DISTINCT o_orderkey) AS n_orders FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderkey) >= 2")
def repeat_customers(t: Tables) -> DataFrame:
    """[K12] Customers with two or more orders."""
    return commerce.repeat_customers(t.orders, "o_custkey", "o_orderkey")


@query("""
SELECT l_partkey, l_returnflag, count(*) AS n_lines, sum(l_quantity) AS units, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem GROUP BY ALL
""")
def product_extract(t: Tables) -> DataFrame:
    """[K12] Lines, units and amount by product and kind."""
    lines = t.lineitem.withColumn("amount", money("l_extendedprice"))
    rows = commerce.sales_by(lines, ["l_partkey", "l_returnflag"], "amount", "l_quantity")
    return rows.withColumn("amount", number(F.col("amount")))


@query("""
SELECT l_orderkey, count(*) AS n_lines, count(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS n_shipped,
 CAST(CAST(max(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS DATE) AS VARCHAR) AS last_shipped FROM lineitem GROUP BY 1
""")
def order_fulfilment(t: Tables) -> DataFrame:
    """[K12] Shipped lines per order."""
    shipped = F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("shipped")
    rows = commerce.fulfilment(t.lineitem.select("l_orderkey", shipped), "l_orderkey", "shipped")
    return rows.withColumn("last_shipped", F.col("last_shipped").cast("string"))


@query("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 3 AS VARCHAR) AS promised FROM orders WHERE o_orderstatus IN ('O', 'P')
""")
def open_orders(t: Tables) -> DataFrame:
    """[K13, K14] Open orders with the day they are promised for."""
    rows = commerce.promised_dates(commerce.open_orders(t.orders, "o_orderstatus", ["O", "P"]), "o_orderdate", 3)
    return rows.select("o_orderkey", F.col("promised").cast("string").alias("promised"))


@query("""
SELECT 'gift_cards' AS entity, o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS state FROM orders
UNION ALL SELECT 'pages', page_id, 'old' FROM pages
""")
def merge_reporting(t: Tables) -> DataFrame:
    """[K15, L12] Reporting entities merged; one of them without a load."""
    old = lambda df, key: df.select(F.col(key).alias("id"), F.lit("old").alias("state"))
    targets = {"gift_cards": old(t.orders, "o_orderkey"), "pages": old(t.pages, "page_id")}
    new = t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), F.lit("new").alias("state"))
    merged = commerce.merge_reporting(targets, {"gift_cards": new}, {"gift_cards": ["id"], "pages": ["id"]}, "state")
    return stack_tagged(merged, "entity")


WEIGHT_SCHEMA = "p_type string, area string, weight decimal(4,2)"

WEIGHTS = [
    ("PROMO", "cardio", Decimal("0.75")),
    ("PROMO", "neuro", Decimal("0.25")),
    ("ECONOMY", "onco", Decimal("1.00")),
    ("SMALL", "cardio", Decimal("0.50")),
    ("SMALL", "onco", Decimal("0.50")),
]

SALES = """
WITH sales AS (SELECT p_type, l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
w(p, area, weight) AS (VALUES ('PROMO', 'cardio', 0.75), ('PROMO', 'neuro', 0.25), ('ECONOMY', 'onco', 1.0), ('SMALL', 'cardio', 0.5), ('SMALL', 'onco', 0.5))
"""


def product_sales(t: Tables) -> DataFrame:
    """Sales by product type and flag, summed per part before the join."""
    per_part = t.lineitem.groupBy("l_partkey", "l_returnflag").agg(F.sum(money("l_extendedprice")).alias("amount"))
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    rows = per_part.join(kinds, "l_partkey").groupBy("p_type", "l_returnflag")
    return rows.agg(F.sum("amount").alias("amount"))


@query(SALES + """
SELECT p_type, l_returnflag, area, CAST(amount * coalesce(weight, 1.0) AS DOUBLE) AS amount FROM sales LEFT JOIN w ON p_type = p
""")
def allocation_areas(t: Tables) -> DataFrame:
    """[G01] Sales split over areas by weight."""
    weights = t.spark.createDataFrame(WEIGHTS, WEIGHT_SCHEMA)
    rows = allocation.allocate(product_sales(t), weights, ["p_type"], "area", "weight", "amount")
    return rows.select("p_type", "l_returnflag", "area", number(F.col("amount")).alias("amount"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN s_nationkey < 10 THEN 'R' || CAST(s_nationkey AS VARCHAR) ELSE l_returnflag END AS area
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
""")
def reallocation(t: Tables) -> DataFrame:
    """[G02] Distributor sales moved to real regions; others keep theirs."""
    real = F.concat(F.lit("R"), F.col("s_nationkey").cast("string")).alias("real")
    regions = t.supplier.filter("s_nationkey < 10").select(F.col("s_suppkey").alias("l_suppkey"), real)
    lines = t.lineitem.withColumnRenamed("l_returnflag", "area")
    rows = allocation.reallocate(lines, regions, ["l_suppkey"], "area", "real")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "area")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * CASE WHEN p_size > 25 THEN 2.0 ELSE 1.0 END AS units
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
""")
def conversion(t: Tables) -> DataFrame:
    """[G04] Units times the product's factor, 1 where none is listed."""
    factors = t.part.filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), F.lit(2.0).alias("factor"))
    lines = t.lineitem.withColumnRenamed("l_quantity", "units")
    rows = allocation.convert(lines, factors, ["l_partkey"], "factor", ["units"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "units")


@query(SALES + """
SELECT coalesce(area, 'none') AS area, CAST(sum(amount * coalesce(weight, 1.0) * CASE WHEN l_returnflag = 'R' THEN 0.5 ELSE 1.0 END) AS DOUBLE) AS amount
FROM sales LEFT JOIN w ON p_type = p GROUP BY 1
""")
def rule_sequence(t: Tables) -> DataFrame:
    """[G03, G05] Conversion, then allocation, then totals; each step on the result of the one before."""
    weights = t.spark.createDataFrame(WEIGHTS, WEIGHT_SCHEMA)
    factors = t.spark.createDataFrame([("R", Decimal("0.50"))], "l_returnflag string, factor decimal(4,2)")
    steps = [
        lambda d: allocation.convert(d, factors, ["l_returnflag"], "factor", ["amount"]),
        lambda d: allocation.allocate(d, weights, ["p_type"], "area", "weight", "amount"),
        lambda d: d.fillna({"area": "none"}).groupBy("area").agg(number(F.sum("amount")).alias("amount")),
    ]
    return allocation.run_rules(allocation.run_rules(product_sales(t), []), steps)


@query("""
SELECT c_custkey, n_name, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('EUROPE', 'ASIA')
""")
def region_subset(t: Tables) -> DataFrame:
    """[G06] Countries configured for a table, with their region."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    config = places.filter(F.col("r_name").isin("EUROPE", "ASIA")).select(
        F.lit("customer").alias("table_name"), F.col("n_name").alias("country"), F.col("r_name").alias("region")
    )
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return allocation.region_subset(rows, config, "customer", "n_name")


@query("""
WITH b AS (SELECT r_name, n_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS a FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 'r_name' AS level, r_name, NULL AS n_name, NULL AS c_mktsegment, CAST(sum(a) AS DOUBLE) AS amount FROM b GROUP BY r_name
UNION ALL SELECT 'n_name', r_name, n_name, NULL, CAST(sum(a) AS DOUBLE) FROM b GROUP BY r_name, n_name
UNION ALL SELECT 'c_mktsegment', r_name, n_name, c_mktsegment, CAST(sum(a) AS DOUBLE) FROM b GROUP BY ALL
""")
def geography_rollup(t: Tables) -> DataFrame:
    """[G07] Totals at every level of a hierarchy."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("amount", money("c_acctbal"))
    levels = allocation.roll_up(rows, ["r_name", "n_name", "c_mktsegment"], "amount")
    parts = [d.withColumn("level", F.lit(n)) for n, d in levels.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.select("level", "r_name", "n_name", "c_mktsegment", number(F.col("amount")).alias("amount"))
