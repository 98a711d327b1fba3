"""Scalar and array expressions, and vectorised functions, over whole tables."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.functions import dates, fingerprint, nested, numbers, text, udfs
from medley.operators import batches, project
from medley.operators.commerce import hash_emails
from medley.operators.reconcile import error_reports
from medley.plans.base import Tables, query

RUN_DATE = dt.date(2024, 3, 1)


@query("""
SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, translate(p_brand, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz') AS swapped,
 p_brand || '/' || p_type AS joined, substring(p_brand, 7) AS brand_no, regexp_replace(p_name, '[aeiou]', '_', 'g') AS masked,
 contains(p_name, 'bolt') AS is_bolt, trim('  ' || p_type || ' ') AS trimmed, replace(p_name, ' ', '-') AS dashed FROM part
""")
def text_functions(t: Tables) -> DataFrame:
    """[X01, X02, X04, X05, X27] Case, concat, trim, replace, substring, contained text."""
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return t.part.select(
        "p_partkey",
        F.upper(name).alias("up"),
        F.lower(brand).alias("low"),
        text.swap_case(brand).alias("swapped"),
        F.concat(brand, F.lit("/"), kind).alias("joined"),
        text.drop_lead(brand, 6).alias("brand_no"),
        F.regexp_replace(name, "[aeiou]", "_").alias("masked"),
        text.contains(name, "bolt").alias("is_bolt"),
        F.trim(F.concat(F.lit("  "), kind, F.lit(" "))).alias("trimmed"),
        F.replace(name, F.lit(" "), F.lit("-")).alias("dashed"),
    )


@query("SELECT p_partkey, trim(w) AS word FROM (SELECT p_partkey, unnest(string_split(replace(p_name, ' ', ', '), ',')) AS w FROM part)")
def split_explode(t: Tables) -> DataFrame:
    """[X03, X20] A delimited text exploded, blanks trimmed."""
    listed = F.replace(F.col("p_name"), F.lit(" "), F.lit(", "))
    return t.part.select("p_partkey", F.explode(text.pieces(listed, ",")).alias("word"))


@query("""
SELECT p_partkey, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second, string_split(p_name, ' ')[3] AS third FROM part
""")
def split_pick(t: Tables) -> DataFrame:
    """[X03] Pieces by position; null past the end."""
    pick = lambda i: text.part(F.col("p_name"), " ", i)
    return t.part.select("p_partkey", pick(0).alias("first"), pick(1).alias("second"), pick(2).alias("third"))


@query("""
SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '://([^/?#]+)', 1) AS host FROM pages
""")
def url_parts(t: Tables) -> DataFrame:
    """[X06] Pattern extraction from paths."""
    return t.pages.select(
        "page_id",
        F.regexp_extract("url", "^(https?)://", 1).alias("scheme"),
        F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"),
    )


@query("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed,
 strftime(o_orderdate, '%d.%m.%Y') AS shown, CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month",
 CAST(day(o_orderdate) AS INTEGER) AS "day", CAST(quarter(o_orderdate) AS INTEGER) AS quarter, dayname(o_orderdate) AS weekday,
 dayofweek(o_orderdate) IN (0, 6) AS weekend,
 CAST(CAST(o_orderdate AS DATE) - 7 AS VARCHAR) AS before, CAST(CAST(o_orderdate AS DATE) + 5 AS VARCHAR) AS after FROM orders
""")
def date_functions(t: Tables) -> DataFrame:
    """[X07, X08, X09, X10, X15, X16] Parse, format, parts, weekday, shifted days."""
    at = F.col("o_orderdate")
    day = F.to_date(at)
    mixed = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(at, "dd/MM/yyyy")).otherwise(F.date_format(at, "yyyyMMdd"))
    return t.orders.select(
        "o_orderkey",
        dates.parse_date(mixed, "dd/MM/yyyy").cast("string").alias("parsed"),
        F.date_format(at, "dd.MM.yyyy").alias("shown"),
        *[c.alias(n) for n, c in dates.parts(at).items()],
        dates.weekday(at).alias("weekday"),
        dates.is_weekend(at).alias("weekend"),
        F.date_sub(day, 7).cast("string").alias("before"),
        F.date_add(day, 5).cast("string").alias("after"),
    )


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS rebuilt FROM orders")
def date_from_parts(t: Tables) -> DataFrame:
    """[X16] A date rebuilt from the parts of a text."""
    shown = F.date_format("o_orderdate", "dd-MM-yyyy")
    rebuilt = dates.from_parts(shown, (7, 4), (4, 2), (1, 2))
    return t.orders.select("o_orderkey", rebuilt.cast("string").alias("rebuilt"))


@query("""
SELECT o_orderkey, CAST(DATE '2024-03-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS days,
 CAST((DATE '2024-03-01' - CAST(o_orderdate AS DATE)) // 365 AS BIGINT) AS years, CAST(o_orderdate AS DATE) < DATE '2024-02-29' AS later FROM orders
""")
def age_years(t: Tables) -> DataFrame:
    """[X11, X12] Days between, whole years, later by a day."""
    day, run = F.to_date("o_orderdate"), F.lit(RUN_DATE)
    return t.orders.select(
        "o_orderkey",
        F.datediff(run, day).alias("days"),
        dates.age_years(day, RUN_DATE).alias("years"),
        dates.days_later(F.lit(dt.date(2024, 2, 29)), day).alias("later"),
    )


@query("""
SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS utc, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS ist,
 strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS eu FROM events
""")
def tz_shift(t: Tables) -> DataFrame:
    """[X13] To UTC from a zone, from UTC to a zone."""
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    at = F.col("ts")
    return t.events.select(
        "event_id",
        show(dates.to_utc(at, "PST")).alias("utc"),
        show(dates.from_utc(at, "IST")).alias("ist"),
        show(dates.from_utc(at, dates.region_zone("EU", {"EU": "Europe/Amsterdam"}))).alias("eu"),
    )


@query("""
SELECT event_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS micros, hour(ts) % 4 = 0 AS on_hour FROM events
""")
def elapsed_micros(t: Tables) -> DataFrame:
    """[X14, X15] Elapsed time and hours divisible by four."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    _, micros = dates.elapsed(F.col("ts"), start)
    return t.events.select("event_id", micros.alias("micros"), dates.on_hour(F.col("ts"), 4).alias("on_hour"))


@query("""
SELECT event_id, round((value - 273.15), 6) AS celsius, round((value - 273.15) * 9 / 5 + 32, 6) AS fahrenheit, round(1 / nullif(value, 0), 6) AS reciprocal,
 round(value / nullif(event_id % 4, 0), 6) AS quotient FROM events
""")
def unit_change(t: Tables) -> DataFrame:
    """[X17] Linear change, reciprocal, division by zero as null."""
    celsius, fahrenheit = numbers.kelvin(F.col("value"))
    return t.events.select(
        "event_id",
        F.round(celsius, 6).alias("celsius"),
        F.round(fahrenheit, 6).alias("fahrenheit"),
        F.round(numbers.reciprocal(F.col("value")), 6).alias("reciprocal"),
        F.round(F.try_divide(F.col("value"), F.col("event_id") % 4), 6).alias("quotient"),
    )


@query()
def farm_fingerprints(t: Tables) -> DataFrame:
    """[X18, K07] Customers' names and whole documents as the warehouse's fingerprint in text form. Compared with published values in the tests."""
    names = t.customer.select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), fingerprint.farm(F.lower(F.trim("c_name"))).cast("string").alias("hash"))
    texts = t.documents.select(F.lit("document").alias("source"), F.col("doc_id").alias("id"), fingerprint.farm(F.col("text")).cast("string").alias("hash"))
    return names.unionByName(texts)


@query("SELECT c_custkey, sha256('pepper' || lower(trim(c_name))) AS name_hash FROM customer")
def pii_hash(t: Tables) -> DataFrame:
    """[X18, K07, P06] Names replaced by a salted hash."""
    return hash_emails(t.customer, "c_name", "pepper", "name_hash").select("c_custkey", "name_hash")


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(json_extract(props, '$.k') AS VARCHAR) AS k_text,
 '{"event_type":"' || event_type || '","k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS packed FROM events
""")
def json_props(t: Tables) -> DataFrame:
    """[X19, X21] JSON text parsed, one field by path, a struct back to text."""
    parsed = t.events.withColumn("p", nested.parse_json(F.col("props"), "k int"))
    return parsed.select(
        "event_id",
        "p.k",
        nested.json_field(F.col("props"), "$.k").alias("k_text"),
        nested.struct_text(F.struct("event_type", F.col("p.k"))).alias("packed"),
    )


@query("""
SELECT event_id AS id, event_type AS body_kind, value AS body_amount, CAST(json_extract(props, '$.k') AS INTEGER) AS body_props_k FROM events
""")
def flatten_structs(t: Tables) -> DataFrame:
    """[X22, H07] Nested columns flattened by schema."""
    body = F.struct(
        F.col("event_type").alias("kind"), F.col("value").alias("amount"), F.from_json("props", "k int").alias("props")
    )
    return nested.flatten_structs(t.events.select(F.col("event_id").alias("id"), body.alias("body")))


@query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '1-URGENT' THEN 3 END AS level,
 CASE WHEN o_orderpriority LIKE '%HIGH%' THEN 'high' WHEN o_orderpriority LIKE '%MEDIUM%' THEN 'medium' ELSE 'low' END AS grade FROM orders
""")
def ordered_category(t: Tables) -> DataFrame:
    """[X24, X28] Category to position, unknown to null; priority text to grade."""
    p = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        text.ordinal(p, ["5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT"]).alias("level"),
        text.priority_level(p).alias("grade"),
    )


@query("""
SELECT vec_id, round(list_sum(list_transform(embedding[1:4], lambda x: CAST(x AS DOUBLE) * 2)), 5) AS added,
 len(list_filter(embedding, lambda x: x > 0)) AS n_positive, round(CAST(list_min(embedding) AS DOUBLE), 5) AS smallest,
 CAST(floor(embedding[1] * 10) AS BIGINT) AS floored, len(embedding) * 2 AS n_joined FROM embeddings
""")
def array_functions(t: Tables) -> DataFrame:
    """[X23, X26, U07] Elementwise arithmetic, sort, concatenation, slices and items."""
    full = F.transform("embedding", lambda x: x.cast("double"))
    rows = t.embeddings.select("vec_id", full.alias("v"))
    ops = numbers.array_ops(F.col("v"), F.col("v"))
    head = F.slice(ops["added"], 1, 4)
    return rows.select(
        "vec_id",
        F.round(F.aggregate(head, F.lit(0.0), lambda a, x: a + x), 5).alias("added"),
        F.size(F.filter("v", lambda x: x > 0)).cast("long").alias("n_positive"),
        F.round(nested.item(ops["ordered"], 0), 5).alias("smallest"),
        F.floor(nested.item(F.col("v"), 0) * 10).alias("floored"),
        F.size(ops["joined"]).cast("long").alias("n_joined"),
    )


@query("""
SELECT vec_id, array_to_string(list_filter(range(len(embedding)), lambda i: CAST(floor(embedding[i + 1] * 100) AS BIGINT) % 2 = 0), ',') AS even_at FROM embeddings
""")
def even_positions(t: Tables) -> DataFrame:
    """[P25] Positions of even values."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("float") * F.lit(100).cast("float")))
    at = numbers.even_positions(whole)
    return t.embeddings.select("vec_id", F.array_join(at.cast("array<string>"), ",").alias("even_at"))


@query("""
SELECT c_custkey, c_mktsegment AS segment, 'B' || CAST(c_nationkey AS VARCHAR) AS nation,
 array_to_string(list_sort([c_mktsegment, 'alpha', 'zeta', c_name]), ',') AS flat, 2 AS n_pairs FROM customer
""")
def map_functions(t: Tables) -> DataFrame:
    """[X25] Lists to pairs and maps, maps merged with the right winning, arrays flattened and sorted."""
    names = F.array(F.lit("segment"), F.lit("nation"))
    left = numbers.pair_map(names, F.array(F.col("c_mktsegment"), F.lit("A")))
    right = numbers.pair_map(F.array(F.lit("nation")), F.array(F.concat(F.lit("B"), F.col("c_nationkey").cast("string"))))
    both = numbers.merge_maps(left, right)
    lists = F.array(F.array(F.col("c_mktsegment"), F.lit("alpha")), F.array(F.lit("zeta"), F.col("c_name")))
    return t.customer.select(
        "c_custkey",
        both["segment"].alias("segment"),
        both["nation"].alias("nation"),
        F.array_join(numbers.flat_sorted(lists), ",").alias("flat"),
        F.size(numbers.pairs(names, names)).alias("n_pairs"),
    )


@query("""
SELECT 'https://shop' || CAST(o_custkey AS VARCHAR) || '/api/graphql.json' AS url, 'error ' || CAST(o_orderkey AS VARCHAR) AS error_message, '2024-03-01' AS report_date
FROM orders WHERE o_orderstatus = 'F'
""")
def error_text_parse(t: Tables) -> DataFrame:
    """[C06, X03, X04] Error lines to URL and message; lines without the marker are left out."""
    url = F.concat(F.lit(" https://shop"), F.col("o_custkey").cast("string"), F.lit("/api/graphql.json"))
    line = F.when(F.col("o_orderstatus") == "F", F.concat(url, F.lit("  error "), F.col("o_orderkey").cast("string")))
    lines = t.orders.select(F.coalesce(line, F.lit("https://shop/ok")).alias("line"))
    rows = error_reports(lines, "line", "/graphql.json", RUN_DATE)
    return rows.withColumn("report_date", F.col("report_date").cast("string"))


@query("SELECT event_id, user_id + 1 AS next_user, event_id + 1 AS next_event FROM events")
def udf_plus_one(t: Tables) -> DataFrame:
    """[U01, U02] A vectorised function as a column and in SQL text."""
    name = udfs.register(t.spark)
    return t.events.select("event_id", udfs.plus_one("user_id").alias("next_user"), F.expr(f"{name}(event_id)").alias("next_event"))


@query("SELECT event_id, value FROM events WHERE event_type = 'click'")
def map_filter(t: Tables) -> DataFrame:
    """[U03] A filter over batches of rows."""

    def clicks(batch: pd.DataFrame) -> pd.DataFrame:
        return batch[batch.event_type == "click"][["event_id", "value"]]

    return batches.map_batches(t.events.select("event_id", "event_type", "value"), clicks, "event_id long, value double")


@query("SELECT event_id, round(value - avg(value) OVER (PARTITION BY event_type), 6) AS off FROM events")
def group_demean(t: Tables) -> DataFrame:
    """[U04] Value minus its group's mean by a function over grouped rows; hot groups are never gathered."""

    def count_and_sum(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [rows.value.count()], "total": [rows.value.sum()]})

    def off(rows: pd.DataFrame, whole: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(off=rows.value - whole.total.iloc[0] / whole.n.iloc[0])

    summary = batches.Summary("n long, total double", count_and_sum, lambda a, b: pd.DataFrame({c: [a[c].iloc[0] + b[c].iloc[0]] for c in a.columns}))
    rows = batches.grouped_map(t.events.select("event_id", "event_type", "value"), ["event_type"], summary, off, "event_id long, off double")
    return rows.select("event_id", F.round("off", 6).alias("off"))


@query("""
SELECT p.event_id, c.event_id AS click_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts
""")
def cogroup_asof(t: Tables) -> DataFrame:
    """[U05] Each purchase with the user's last click, by a function over both sides of a user."""

    def last_click(left: pd.DataFrame, right: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        clicks = pd.concat([before, right[["at", "click_id"]]]).astype({"at": "int64", "click_id": "Int64"})
        return pd.merge_asof(left, clicks, on="at")

    at = F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    left = t.events.filter("event_type = 'purchase'").select("user_id", at, "event_id")
    right = t.events.filter("event_type = 'click'").select("user_id", at, F.col("event_id").alias("click_id"))
    last = batches.Carry("at long, click_id long", lambda left, right: right[["at", "click_id"]].tail(1), lambda before, own: own if len(own) else before)
    return batches.cogrouped_map(left, right, ["user_id"], ["at"], last_click, "event_id long, click_id long", last, tie=["click_id"])


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%:%' THEN o_orderpriority ELSE 'check#' || o_orderstatus || ': ' || o_orderpriority END AS message FROM orders
""")
def error_text(t: Tables) -> DataFrame:
    """[U06] Error text from subject and column."""
    subject = F.concat(F.lit("check#"), F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", udfs.error_text(subject, F.col("o_orderpriority")).alias("message"))


@query("""
SELECT 'file:' AS scheme, '2024-03-01' AS report_date, '2024-03-01 06:30:00' AS load_time, count(*) AS n FROM customer
""")
def stamp_lineage(t: Tables) -> DataFrame:
    """[P15] Lineage columns from the scan."""
    rows = project.stamp(t.customer, RUN_DATE, dt.datetime(2024, 3, 1, 6, 30))
    return rows.groupBy(
        F.regexp_extract("source_uri", "^(file:)", 1).alias("scheme"),
        F.col("report_date").cast("string").alias("report_date"),
        F.date_format("load_time", "yyyy-MM-dd HH:mm:ss").alias("load_time"),
    ).agg(F.count(F.lit(1)).alias("n"))
