"""Filters, joins, aggregations, windows, sorts and reshaping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.functions import numbers
from medley.operators import aggregates, joins, project, reshape, skew, windows
from medley.operators.commerce import sales_input
from medley.plans.base import Tables, money, number, query
from medley.streaming.hourly import merge_copies


@query("""
SELECT n_name AS nation, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
""")
def nation_revenue(t: Tables) -> DataFrame:
    """[S05, A05, J02] Revenue by nation and year. Lines are summed per order before any join."""
    net = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(net).alias("net"))
    nations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    orders = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    rows = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    by_customer = rows.groupBy("o_custkey", "order_year").agg(F.sum("net").alias("net"))
    named = by_customer.join(nations, F.col("o_custkey") == F.col("c_custkey"))
    return named.groupBy(F.col("n_name").alias("nation"), "order_year").agg(number(F.sum("net")).alias("revenue"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net
FROM lineitem WHERE l_quantity < 24 AND l_discount BETWEEN 0.02 AND 0.07 AND l_returnflag IN ('A', 'R')
""")
def filter_project(t: Tables) -> DataFrame:
    """[P01, P02, P07, P10, P14] Filter and computed column."""
    rows = t.lineitem.filter("l_quantity < 24 and l_discount between 0.02 and 0.07")
    rows = rows.filter(F.col("l_returnflag").isin("A", "R"))
    net = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", number(net).alias("net"))


RULE_PATTERNS = [("promo", "promo*"), ("standard", "*ard"), ("any_m", "*m*")]


@query("""
SELECT p_partkey, rule FROM part, (VALUES ('promo', 'PROMO%'), ('standard', '%ARD'), ('any_m', '%M%')) r(rule, pat)
WHERE upper(p_type) LIKE pat
""")
def like_patterns(t: Tables) -> DataFrame:
    """[P08, P17, Q01] Patterns held in a rule list."""
    return project.match_patterns(t.part, "p_type", RULE_PATTERNS).select("p_partkey", "rule")


@query("""
SELECT count(*) FILTER (WHERE p_name LIKE 'red %') AS n_like, count(*) FILTER (WHERE p_name NOT LIKE '%bolt') AS n_not,
       count(*) FILTER (WHERE p_type ILIKE 'pro%') AS n_fold FROM part
""")
def like_counts(t: Tables) -> DataFrame:
    """[P08] like, not like and without regard to case."""
    return t.part.agg(
        F.count_if(F.col("p_name").like("red %")).alias("n_like"),
        F.count_if(~F.col("p_name").like("%bolt")).alias("n_not"),
        F.count_if(F.col("p_type").ilike("pro%")).alias("n_fold"),
    )


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderdate BETWEEN least(DATE '1998-06-30', DATE '1997-07-01') AND greatest(DATE '1998-06-30', DATE '1997-07-01')
""")
def between_symmetric(t: Tables) -> DataFrame:
    """[P09] Bounds in either order."""
    a, b = F.lit(dt.date(1998, 6, 30)), F.lit(dt.date(1997, 7, 1))
    return t.orders.filter(numbers.between_either(F.col("o_orderdate"), a, b)).select("o_orderkey", "o_custkey")


@query("""
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush' WHEN o_orderpriority = '3-MEDIUM' THEN 'normal'
       ELSE 'slow' END AS label, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10
""")
def case_label(t: Tables) -> DataFrame:
    """[P12, A04] Label by condition, then a condition on the groups."""
    p = F.col("o_orderpriority")
    label = F.when(p.isin("1-URGENT", "2-HIGH"), "rush").when(p == "3-MEDIUM", "normal").otherwise("slow")
    return t.orders.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n")).filter("n > 10")


@query("""
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE source END AS source, source IS NOT NULL AND doc_id % 7 <> 0 AS has_source
FROM documents
""")
def null_tokens(t: Tables) -> DataFrame:
    """[P13, P11] Tokens for missing values, planted by expression."""
    planted = F.when(F.col("doc_id") % 7 == 0, F.get(F.array(*map(F.lit, ("nan", "None", "NaN", "none"))), (F.col("doc_id") % 4).cast("int")))
    rows = t.documents.select("doc_id", F.coalesce(planted, "source").alias("source"))
    return project.null_tokens(rows).withColumn("has_source", F.col("source").isNotNull())


@query("""
SELECT event_id, CASE WHEN value > 100 THEN 100 ELSE value END AS value FROM events WHERE value <= 300
""")
def cap_outliers(t: Tables) -> DataFrame:
    """[P19] Values above a limit dropped, then capped at a lower one."""
    kept = project.drop_above(t.events, "value", 300.0)
    return kept.select("event_id", numbers.cap(F.col("value"), 100.0).alias("value"))


@query("""
WITH e AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS v FROM events)
SELECT event_id, coalesce(v, (SELECT median(v) FROM e)) AS v FROM e
""")
def fill_median(t: Tables) -> DataFrame:
    """[P22] Gaps filled with the exact median."""
    gaps = t.events.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("v"))
    return project.fill_stat(gaps, "v", "median")


@query("""
WITH e AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS kind FROM events),
m AS (SELECT kind FROM e WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1)
SELECT coalesce(kind, (SELECT kind FROM m)) AS kind, count(*) AS n FROM e GROUP BY 1
""")
def fill_mode(t: Tables) -> DataFrame:
    """[P22] Gaps filled with the most frequent value."""
    gaps = t.events.select(F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("kind"))
    return project.fill_stat(gaps, "kind", "mode").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END, -1) AS user_id,
       coalesce(CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_type END, '') AS event_type
FROM events WHERE NOT (event_id % 3 = 0 AND event_id % 2 = 0)
""")
def drop_fill_na(t: Tables) -> DataFrame:
    """[P20, P21] Rows with nothing left are dropped, other gaps get a constant."""
    gaps = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 2 != 0, F.col("event_type")).alias("event_type"),
    )
    return gaps.dropna("all", subset=["user_id", "event_type"]).fillna({"user_id": -1, "event_type": ""})


@query("""
SELECT c_custkey AS "key", CASE WHEN c_custkey = 7 THEN 0.0 ELSE c_acctbal END AS balance, c_mktsegment AS market_segment
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def rename_update(t: Tables) -> DataFrame:
    """[P03, P05, P23, P24, O05] Rename, drop, update one cell, look up by label list, order columns."""
    rows = project.lookup_labels(t.customer, "c_mktsegment", ["BUILDING", "MACHINERY"]).drop("c_name", "c_nationkey")
    named = project.rename(rows, {"c_custkey": "key", "c_acctbal": "balance", "c_mktsegment": "market_segment"})
    return project.by_name(project.set_cell(named, "key", 7, "balance", 0.0))


@query("""
SELECT c_custkey AS cust_id, CAST(c_acctbal AS DOUBLE) AS net_value_, c_mktsegment, CAST(NULL AS VARCHAR) AS loyalty FROM customer
""")
def map_columns(t: Tables) -> DataFrame:
    """[J14, P04] A mapping document applied; names made safe."""
    mapping = [("c_custkey", "cust id", "long"), ("c_acctbal", "net value%", "double"),
               ("c_mktsegment", "c_mktsegment", "string"), ("c_loyalty", "loyalty", "string")]
    return project.sanitise_names(project.map_columns(t.customer, mapping))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderstatus = 'F' OR o_orderstatus IS NULL OR o_orderstatus NOT IN ('O', 'X')
""")
def in_or_missing(t: Tables) -> DataFrame:
    """[P10, L03] Equal, or missing, or not listed."""
    rows = project.in_or_missing(t.orders, "o_orderstatus", "F", ["O", "X"])
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("""
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer
""")
def distinct_pairs(t: Tables) -> DataFrame:
    """[P16] Distinct values."""
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rownumber FROM orders
""")
def row_numbers(t: Tables) -> DataFrame:
    """[P18] Dense positions along date and key."""
    return project.row_numbers(t.orders, ["o_orderdate", "o_orderkey"], "rownumber").select("o_orderkey", "rownumber")


@query("""
SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
""")
def join_two(t: Tables) -> DataFrame:
    """[J01] Inner join with a master table, unique on its key."""
    people = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t.orders.join(people, "o_custkey").select("o_orderkey", "c_name", "c_mktsegment")


@query("""
SELECT n_name, c_mktsegment, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
""")
def join_three(t: Tables) -> DataFrame:
    """[J02] Three tables; orders are counted per customer before they meet the others."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = per_customer.join(t.customer, "c_custkey").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name", "c_mktsegment").agg(F.sum("n").alias("n_orders"))


@query("""
SELECT CAST(a.d AS VARCHAR) AS ds, n_orders, n_lines FROM
(SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders FROM orders GROUP BY 1) a JOIN
(SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n_lines FROM lineitem GROUP BY 1) b ON a.d = b.d
""")
def join_on_date(t: Tables) -> DataFrame:
    """[J03] Two computed frames merged on a date."""
    a = t.orders.groupBy(F.to_date("o_orderdate").alias("ds")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.lineitem.groupBy(F.to_date("l_shipdate").alias("ds")).agg(F.count(F.lit(1)).alias("n_lines"))
    return a.join(b, "ds").select(F.col("ds").cast("string").alias("ds"), "n_orders", "n_lines")


RATES = """
WITH rates(cur, rate, s, e) AS (VALUES
 ('BUILDING', 0.5, DATE '1995-01-01', DATE '1997-12-31'), ('BUILDING', 0.8, DATE '1998-01-01', DATE '2001-12-31'),
 ('MACHINERY', 4.0, DATE '1996-03-01', DATE '1999-06-30'), ('MACHINERY', 2.0, DATE '1999-06-30', DATE '2000-12-31'),
 ('FURNITURE', 1.25, DATE '1995-01-01', DATE '2001-12-31'))
"""


def rate_table(t: Tables) -> DataFrame:
    """Exchange rates by currency and period, a small table with one shared border day."""
    d = dt.date
    return t.spark.createDataFrame(
        [
            ("BUILDING", 0.5, d(1995, 1, 1), d(1997, 12, 31)),
            ("BUILDING", 0.8, d(1998, 1, 1), d(2001, 12, 31)),
            ("MACHINERY", 4.0, d(1996, 3, 1), d(1999, 6, 30)),
            ("MACHINERY", 2.0, d(1999, 6, 30), d(2000, 12, 31)),
            ("FURNITURE", 1.25, d(1995, 1, 1), d(2001, 12, 31)),
        ],
        "cur string, rate_to_usd double, conversion_start_date date, conversion_end_date date",
    )


@query(RATES + """
SELECT o_orderkey, 1 / rate AS exchange_rate FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN rates ON cur = c_mktsegment AND CAST(o_orderdate AS DATE) BETWEEN s AND e
""")
def rate_interval_join(t: Tables) -> DataFrame:
    """[J04, K04] Orders with the rate of their segment on their day."""
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    sales = orders.select("o_orderkey", "c_mktsegment", "o_orderdate")
    rows = sales_input(sales, rate_table(t), ("c_mktsegment", "cur"), "o_orderdate")
    return rows.select("o_orderkey", "exchange_rate")


@query("""
WITH r AS (SELECT min(s_suppkey) AS s_suppkey, s_nationkey, DATE '1995-01-01' + CAST(s_suppkey % 20 AS INTEGER) * 100 AS s,
           DATE '1995-01-01' + CAST(s_suppkey % 20 AS INTEGER) * 100 + 150 AS e FROM supplier GROUP BY ALL)
SELECT o_orderkey, s_suppkey FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN r ON s_nationkey = c_nationkey AND CAST(o_orderdate AS DATE) BETWEEN s AND e
""")
def period_interval_join(t: Tables) -> DataFrame:
    """[J04] One range per nation and period, of which two overlap at most: distinct key and day pairs find theirs."""
    start = F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("s_suppkey") % 20 * 100).cast("int"))
    ranges = t.supplier.groupBy("s_nationkey", start.alias("s")).agg(F.min("s_suppkey").alias("s_suppkey"))
    ranges = ranges.withColumn("e", F.date_add("s", 150))
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    orders = orders.select("o_orderkey", "c_nationkey", "o_orderdate")
    rows = joins.interval_join(orders, ranges, ("c_nationkey", "s_nationkey"), "o_orderdate", "s", "e")
    return rows.select("o_orderkey", "s_suppkey")


@query("""
SELECT p.event_id, c.event_id AS click_id, c.value AS click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts
""")
def asof_last_event(t: Tables) -> DataFrame:
    """[J05] Each purchase with the user's last click."""
    left = t.events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    right = t.events.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click"), "value")
    rows = joins.asof(left, right, ["user_id"], "ts", {"click": "click_id", "value": "click_value"}, "click")
    return rows.select("event_id", "click_id", "click_value")


@query("""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000 AND o_custkey IS NOT NULL)
""")
def anti_keys(t: Tables) -> DataFrame:
    """[J06] Customers without a large order."""
    large = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(t.customer, large, ["c_custkey"]).select("c_custkey")


@query("""
SELECT 'only_orders' AS side, k FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 250000
 EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'only_customers', k FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0
 EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000)
""")
def both_differences(t: Tables) -> DataFrame:
    """[J07] Values on one side only, both ways."""
    a = t.orders.filter("o_totalprice > 250000").select(F.col("o_custkey").alias("k"))
    b = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    only_a, only_b = joins.differences(a, b, "k")
    return reshape.stack_tagged({"only_orders": only_a, "only_customers": only_b}, "side")


@query("""
SELECT o_custkey FROM orders WHERE o_totalprice < 100000
EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def set_minus(t: Tables) -> DataFrame:
    """[T04] Distinct difference."""
    a = t.orders.filter("o_totalprice < 100000").select("o_custkey")
    return reshape.minus(a, t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')
""")
def semi_keys(t: Tables) -> DataFrame:
    """[J08, L07] Lines of listed parts."""
    listed = t.part.filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    return joins.semi(t.lineitem, listed, ["l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
SELECT c_name AS shop_domain, api, replace(replace(u, '{shop_domain}', c_name), '{start_date}', '2024-01-01') AS url
FROM customer, (VALUES ('orders', 'https://{shop_domain}/orders?from={start_date}'), ('pages', 'https://{shop_domain}/pages')) a(api, u)
WHERE c_acctbal >= 0
""")
def shop_requests(t: Tables) -> DataFrame:
    """[J09, J10, T06] Request rows per shop and API, without inactive shops."""
    apis = [("orders", "https://{shop_domain}/orders?from={start_date}"), ("pages", "https://{shop_domain}/pages")]
    idle = t.customer.filter("c_acctbal < 0").select("c_name")
    return joins.requests(t.customer.select("c_name"), "c_name", apis, {"start_date": "2024-01-01"}, idle)


@query("""
SELECT (SELECT count(*) FROM orders) AS rows_a, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS rows_b,
       (SELECT count(*) FROM orders) = (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS equal
""")
def compare_totals(t: Tables) -> DataFrame:
    """[J11, C03] Two counts side by side."""
    return joins.compare_totals(t.orders, t.lineitem.select("l_orderkey").distinct())


@query("""
SELECT l_orderkey, l_linenumber, p_name, p_partkey IS NULL AS unmatched
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey
""")
def mdm_enrich_unmatched(t: Tables) -> DataFrame:
    """[J13] Lines with master data, misses flagged."""
    master = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return joins.enrich(lines, master, ["l_partkey"]).drop("l_partkey")


@query("""
WITH config(segment, tier) AS (VALUES ('BUILDING', 'a'), ('MACHINERY', 'b'))
SELECT n.segment, n.n_customers, tier FROM (SELECT c_mktsegment AS segment, count(*) AS n_customers FROM customer GROUP BY 1) n
LEFT JOIN config ON n.segment = config.segment
""")
def config_lookup(t: Tables) -> DataFrame:
    """[J12] Configured values next to the groups they apply to."""
    counts = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n_customers"))
    config = t.spark.createDataFrame([("BUILDING", "a"), ("MACHINERY", "b")], "segment string, tier string")
    return joins.config_lookup(counts, config, ["segment"])


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def group_count(t: Tables) -> DataFrame:
    """[A01, A02] Count by one key."""
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def group_multi(t: Tables) -> DataFrame:
    """[A03] Count by several keys."""
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT l_returnflag, round(sum(l_quantity), 2) AS total, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std
FROM lineitem GROUP BY 1
""")
def group_agg_set(t: Tables) -> DataFrame:
    """[A05, A08] Sum, mean and deviation at once."""
    rows = aggregates.agg_set(t.lineitem, ["l_returnflag"], "l_quantity")
    return rows.select(
        "l_returnflag", F.round("total", 2).alias("total"), F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")
    )


@query("""
SELECT p_brand, round(avg(p_partkey), 6) AS avg_p_partkey, round(avg(p_size), 6) AS avg_p_size FROM part GROUP BY 1
""")
def group_averages(t: Tables) -> DataFrame:
    """[A06] Averages of all numeric columns."""
    rows = aggregates.averages(t.part.drop("p_retailprice"), ["p_brand"])
    return rows.select("p_brand", *[F.round(c, 6).alias(c) for c in rows.columns if c != "p_brand"])


@query("""
SELECT CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1
""")
def quarter_sales(t: Tables) -> DataFrame:
    """[A11, X09] Sum by quarter."""
    rows = aggregates.by_quarter(t.orders.withColumn("amount", money("o_totalprice")), "o_orderdate", "amount")
    return rows.withColumn("total", number(F.col("total")))


@query("SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS high, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS low FROM orders")
def watermark_bounds(t: Tables) -> DataFrame:
    """[A12] Newest and oldest day."""
    day = F.to_date("o_orderdate")
    return t.orders.agg(F.max(day).cast("string").alias("high"), F.min(day).cast("string").alias("low"))


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS metric
FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-05' AND CAST(ts AS DATE) <= DATE '2024-01-25' GROUP BY 1
""")
def daily_metric(t: Tables) -> DataFrame:
    """[A13, C05] Daily sum above a watermark."""
    rows = aggregates.daily_metric(
        t.events.withColumn("value", money("value")), "ts", "value", dt.date(2024, 1, 25), dt.date(2024, 1, 5)
    )
    return rows.select(F.col("day").cast("string").alias("day"), number(F.col("metric")).alias("metric"))


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS metric
FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-25' GROUP BY ALL
""")
def daily_metric_by_key(t: Tables) -> DataFrame:
    """[A14, C05] Daily sum by one more key."""
    rows = aggregates.daily_metric(
        t.events.withColumn("value", money("value")), "ts", "value", dt.date(2024, 1, 25), key="event_type"
    )
    return rows.select(F.col("day").cast("string").alias("day"), "event_type", number(F.col("metric")).alias("metric"))


@query("""
SELECT round(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) * 100.0 / sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END), 6) AS percent
FROM events
""")
def ratio_percent(t: Tables) -> DataFrame:
    """[A15] Purchases as percent of views."""
    marked = t.events.select(
        (F.col("event_type") == "purchase").cast("int").alias("p"), (F.col("event_type") == "view").cast("int").alias("v")
    )
    return aggregates.ratio(marked, "p", "v").select(F.round("percent", 6).alias("percent"))


@query("""
SELECT 'doc_id' AS "column", 'bigint' AS kind, count(doc_id) AS n FROM documents
UNION ALL SELECT 'lang', 'string', count(lang) FROM documents
UNION ALL SELECT 'source', 'string', count(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END) FROM documents
""")
def profile_columns(t: Tables) -> DataFrame:
    """[A10] Type and non-null count per column."""
    source = F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source")
    return aggregates.profile(t.documents.select("doc_id", "lang", source))


@query("""
SELECT count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS low,
       round(quantile_cont(value, 0.25), 6) AS q1, round(median(value), 6) AS q2, round(quantile_cont(value, 0.75), 6) AS q3,
       max(value) AS high FROM events
""")
def describe_values(t: Tables) -> DataFrame:
    """[A09] Summary with exact quartiles."""
    rows = aggregates.describe(t.events, "value")
    return rows.select(*[F.round(c, 6).alias(c) if c in ("mean", "std", "q1", "q2", "q3") else c for c in rows.columns])


@query("""
SELECT 'c_name' AS "column", count(c_name) AS n, min(c_name) AS low, max(c_name) AS high FROM customer
UNION ALL SELECT 'c_mktsegment', count(c_mktsegment), min(c_mktsegment), max(c_mktsegment) FROM customer
""")
def describe_text(t: Tables) -> DataFrame:
    """[A09] Summary of text columns."""
    return aggregates.describe_text(t.customer)


@query("""
SELECT user_id, event_type, count(*) OVER (PARTITION BY user_id) AS n_kinds FROM (SELECT DISTINCT user_id, event_type FROM events WHERE event_type IS NOT NULL)
""")
def distinct_sets(t: Tables) -> DataFrame:
    """[A16, A18] Distinct event types by user as rows, and how many."""
    kinds = t.events.select("user_id", "event_type").dropna(subset=["event_type"]).distinct()
    counts = kinds.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_kinds"))
    return skew.lookup(kinds, counts, ["user_id"])


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def group_members(t: Tables) -> DataFrame:
    """[A22] Group listing as rows."""
    return aggregates.group_members(t.customer, ["c_mktsegment"], "c_nationkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'FURNITURE'")
def chosen_group(t: Tables) -> DataFrame:
    """[A22] One chosen group."""
    return aggregates.get_group(t.customer, "c_mktsegment", "FURNITURE").select("c_custkey", "c_name")


@query("""
SELECT n_regionkey, max(c_acctbal) AS best FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY best DESC, 1 LIMIT 1
""")
def topk_group(t: Tables) -> DataFrame:
    """[A07] Largest group maximum."""
    best = t.customer.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("best"))
    rows = best.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_regionkey").agg(F.max("best").alias("best")).orderBy(F.desc("best"), "n_regionkey").limit(1)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def topk_orders(t: Tables) -> DataFrame:
    """[O01] Three largest orders."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(3)


@query("""
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_name, c_custkey LIMIT 5
""")
def topk_filtered(t: Tables) -> DataFrame:
    """[O02] Filter, several sort keys, five rows."""
    rows = t.customer.filter("c_mktsegment = 'BUILDING'").orderBy(F.desc("c_acctbal"), "c_name", "c_custkey").limit(5)
    return rows.select("c_custkey", "c_name", "c_acctbal")


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey DESC")
def full_sort(t: Tables) -> DataFrame:
    """[O03] Full sort."""
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy("s_acctbal", F.desc("s_suppkey"))


@query("""
SELECT 'head' AS part, o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 4)
UNION ALL SELECT 'tail', o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 4)
""")
def head_tail(t: Tables) -> DataFrame:
    """[O04] First and last rows by key."""
    keys = t.orders.select("o_orderkey")
    ends = {"head": keys.orderBy("o_orderkey").limit(4), "tail": keys.orderBy(F.desc("o_orderkey")).limit(4)}
    return reshape.stack_tagged(ends, "part")


@query("""
SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS key_n FROM orders
""")
def dup_keys(t: Tables) -> DataFrame:
    """[W02, Q09] How often each order's customer and day occur."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.count_keys(rows, ["o_custkey", "o_orderdate"], "key_n").select("o_orderkey", "key_n")


@query("SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS dup_n FROM documents")
def dup_rows(t: Tables) -> DataFrame:
    """[W01, T05] Number of each document among those with equal text."""
    rows = windows.mark_duplicate_rows(t.documents, ["doc_id"], ["text"], keep=["doc_id"])
    return rows.select("doc_id", F.col("_dup_n").alias("dup_n"))


@query("""
SELECT day, user_id, event_type FROM (SELECT CAST(ts AS DATE) AS day, user_id, event_type,
 row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE)) AS rn FROM events) WHERE rn = 1
""")
def drop_duplicates(t: Tables) -> DataFrame:
    """[T05] First day of each user and type; many rows tie on it."""
    rows = t.events.select(F.to_date("ts").alias("day"), "user_id", "event_type")
    return reshape.drop_duplicate_rows(rows, ["user_id", "event_type"], "day")


@query("""
SELECT o_orderkey, rnk AS date_rank FROM (SELECT o_orderkey, dense_rank() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderdate) AS rnk FROM orders)
WHERE rnk <= 3
""")
def dense_rank_month(t: Tables) -> DataFrame:
    """[W03] Orders on the first three order days of their month."""
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day")).withColumn("month", F.trunc("day", "month"))
    return windows.first_ranks(rows, ["month"], "day", 3, "date_rank").select("o_orderkey", "date_rank")


@query("SELECT o_orderkey, dense_rank() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderdate) AS date_rank FROM orders")
def dense_rank_split(t: Tables) -> DataFrame:
    """[W03] The rank of every order's day in its month, by a scan in parts, so that a hot month or day is spread over tasks."""
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day")).withColumn("month", F.trunc("day", "month"))
    return windows.rank_in(rows, ["month"], "day", "date_rank").select("o_orderkey", "date_rank")


@query("""
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key(t: Tables) -> DataFrame:
    """[W04, R02] Newest row per key over batch and stream copies; some rows exist in both."""
    batch, stream = t.events.filter("event_id % 3 <> 0"), t.events.filter("event_id % 3 <> 1")
    rows = merge_copies(batch, stream, ["user_id", "event_type"], ["ts", "event_id"])
    return rows.select("user_id", "event_type", "event_id", "value")


@query("""
SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS high FROM events
""")
def running_max(t: Tables) -> DataFrame:
    """[W05] Highest value so far by user."""
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return windows.running_max(rows, ["user_id"], ["ts", "event_id"], "value", "high").select("event_id", "high")


@query("""
SELECT l_partkey, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_ordered FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
""")
def first_order_date(t: Tables) -> DataFrame:
    """[W06] First order date by part."""
    lines = t.lineitem.select("l_partkey", "l_orderkey").distinct()
    rows = lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    first = windows.first_date(rows, "l_partkey", "o_orderdate", "first_ordered")
    return first.select("l_partkey", F.to_date("first_ordered").cast("string").alias("first_ordered"))


def report_lines(t: Tables) -> DataFrame:
    """Report text as delivered: per year a category line, per order a header line and three detail lines."""
    day = F.to_date("o_orderdate")
    base = t.orders.select(F.year(day).alias("file"), "o_orderkey", "o_totalprice")
    entry = lambda at, label, amount: F.struct(
        F.lit(at).alias("at"), label.alias("label"), amount.cast("decimal(18,2)").alias("amount")
    )
    none = F.lit(None)
    lines = F.array(
        entry(0, F.concat(F.lit("Account "), (F.col("o_orderkey") / 1000).cast("long").cast("string")), none),
        entry(1, F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")), none),
        entry(2, F.lit("Goods "), F.col("o_totalprice")),
        entry(3, F.lit(" "), none),
        entry(4, F.lit("Freight"), money("o_totalprice") * 2),
        entry(5, F.lit("Total order"), F.col("o_totalprice")),
    )
    rows = base.select("file", "o_orderkey", F.explode(lines).alias("e"))
    return rows.select("file", (F.col("o_orderkey") * 10 + F.col("e.at")).alias("line"), "e.label", "e.amount")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS file, o_orderkey * 10 + pos AS "line", 'Account ' || CAST(o_orderkey // 1000 AS VARCHAR) AS category,
 'Order ' || CAST(o_orderkey AS VARCHAR) AS sub_category, details,
 CAST(CASE WHEN pos = 2 THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) * 2 END AS DOUBLE) AS amount
FROM orders, (VALUES (2, 'Goods'), (4, 'Freight')) v(pos, details)
""")
def section_rows(t: Tables) -> DataFrame:
    """[W07, T10] Report sections as rows."""
    rows = reshape.report_rows(report_lines(t), "file", "line", "label", "amount")
    return rows.withColumn("amount", number(F.col("amount")))


@query("""
SELECT 'customer' AS source, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier
""")
def union_tagged(t: Tables) -> DataFrame:
    """[T01, T02] Union with the source's name."""
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return reshape.stack_tagged({"customer": a, "supplier": b})


@query("""
SELECT c_custkey AS id, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier
""")
def append_missing_cols(t: Tables) -> DataFrame:
    """[T03] Frames with different columns."""
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return reshape.stack_loose([a, b])


# Every event type of the table.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
COUNTED = ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS \"{k}\"" for k in EVENT_TYPES)
USERS = ", ".join(f"count(DISTINCT user_id) FILTER (WHERE event_type = '{k}')" for k in EVENT_TYPES)


@query(f"WITH w AS (SELECT user_id, {COUNTED} FROM events GROUP BY 1) UNPIVOT w ON {', '.join(EVENT_TYPES)} INTO NAME event_type VALUE n")
def melt_counts(t: Tables) -> DataFrame:
    """[T07] Wide counts to long."""
    wide = t.events.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == k).alias(k) for k in EVENT_TYPES])
    return reshape.melt(wide, ["user_id"], EVENT_TYPES, "event_type", "n")


@query(f"SELECT 'n' AS measure, {COUNTED} FROM events UNION ALL SELECT 'users', {USERS} FROM events")
def pivot_types(t: Tables) -> DataFrame:
    """[T08] A small summary on its side."""
    pairs = t.events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    small = pairs.groupBy("event_type").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("users"))
    return reshape.transpose(small, "event_type", ["n", "users"], EVENT_TYPES, "measure")


@query("""
WITH k(c_custkey) AS (VALUES (1), (5), (9), (100000000))
SELECT CAST(k.c_custkey AS BIGINT) AS c_custkey, c_name, CASE WHEN k.c_custkey IN (1, 5) THEN 1 END AS flag FROM k LEFT JOIN customer c ON k.c_custkey = c.c_custkey
""")
def reindex(t: Tables) -> DataFrame:
    """[T09] Exactly the given keys, one column set on some."""
    rows = reshape.reindex(t.customer, "c_custkey", [1, 5, 9, 100000000], "flag", 1, [1, 5])
    return rows.select("c_custkey", "c_name", "flag")
