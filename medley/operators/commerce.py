"""Commerce tables and reports. Definitions marked `ours` are stated here, not taken over."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medley.functions.nested import flatten
from medley.functions.numbers import reciprocal
from medley.functions.text import stable_hash
from medley.operators.joins import enrich, interval_join
from medley.operators.load import merge
from medley.operators.reshape import stack
from medley.operators.windows import latest

# Child tables of an order and the path of each inside the nested order.
ORDER_TABLES = {
    "orders_billing_address": "billing_address",
    "orders_client_details": "client_details",
    "orders_discount_applications": "discount_applications",
    "orders_discount_codes": "discount_codes",
    "orders_fulfillments": "fulfillments",
    "orders_fulfillments_line_items": "fulfillments.line_items",
    "orders_fulfillments_line_items_discount_allocations": "fulfillments.line_items.discount_allocations",
    "orders_fulfillments_line_items_properties": "fulfillments.line_items.properties",
    "orders_fulfillments_line_items_tax_lines": "fulfillments.line_items.tax_lines",
    "orders_fulfillments_receipts": "fulfillments.receipt",
    "orders_line_items": "line_items",
    "orders_line_items_discount_allocations": "line_items.discount_allocations",
    "orders_line_items_properties": "line_items.properties",
    "orders_line_items_tax_lines": "line_items.tax_lines",
    "orders_note_attributes": "note_attributes",
    "orders_payment_details": "payment_details",
    "orders_refunds": "refunds",
    "orders_refunds_order_adjustments": "refunds.order_adjustments",
    "orders_refunds_refund_line_items": "refunds.refund_line_items",
    "orders_refunds_transactions": "refunds.transactions",
    "orders_refunds_transactions_payment_details": "refunds.transactions.payment_details",
    "orders_refunds_transactions_receipts": "refunds.transactions.receipt",
    "orders_shipping_address": "shipping_address",
    "orders_shipping_lines": "shipping_lines",
    "orders_shipping_lines_taxline": "shipping_lines.tax_lines",
    "orders_tax_lines": "tax_lines",
    "orders_transactions": "transactions",
    "orders_transactions_payment_details": "transactions.payment_details",
    "orders_transactions_receipts": "transactions.receipt",
}

# Child tables of the daily entities.
DAILY_TABLES = {
    "customers": {"customers_addresses": "addresses"},
    "payouts": {"payouts_summaries": "summary"},
    "products": {
        "products_images": "images",
        "products_options": "options",
        "products_variants": "variants",
    },
    "smart_collections": {"smart_collections_images": "image", "smart_collections_rules": "rules"},
}


def _has(df: DataFrame, path: str) -> bool:
    kind = df.schema
    for step in path.split("."):
        kind = getattr(kind, "elementType", kind)
        if step not in getattr(kind, "names", []):
            return False
        kind = kind[step].dataType
    return True


def child_tables(df: DataFrame, key: Sequence[str], paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """[K01, K02] Child tables of a nested entity, by name; paths the schema lacks are left out.

    Ours: one row per element with the parent's key and positions; parents without elements give no row.
    Give it a table, not raw JSON text: every child then reads only its own nested columns, and nothing
    is parsed again.
    """
    return {name: flatten(df, key, path, outer=False) for name, path in paths.items() if _has(df, path)}


def entity_rows(df: DataFrame, changed: str, since: dt.date | None, full: bool) -> DataFrame:
    """[K03] The rows a run covers: all, or those changed on or after a day."""
    return df if full or since is None else df.filter(F.col(changed) >= F.lit(since).cast(df.schema[changed].dataType))


def sales_input(sales: DataFrame, rates: DataFrame, currency: tuple[str, str], at: str) -> DataFrame:
    """[K04, J04] Sales with the exchange rate to the local currency: 1 / rate of the day, null if unknown.

    `rates` has the currency, `rate_to_usd`, `conversion_start_date` and `conversion_end_date`.
    """
    joined = interval_join(sales, rates, currency, at, "conversion_start_date", "conversion_end_date")
    return joined.withColumn("exchange_rate", reciprocal(F.col("rate_to_usd"))).select(*sales.columns, "exchange_rate")


def sales_rows(
    lines: DataFrame, digital: DataFrame, product: str, amount: str, rate: str, refund: str
) -> DataFrame:
    """[K05, J08] Ours: one row per line, amount in USD, negative for refunds, digital flag.

    `digital` holds product ids; `rate` is local currency per USD as `sales_input` gives it.
    """
    ids = digital.select(F.col(digital.columns[0]).alias(product)).dropna().distinct()
    flagged = enrich(lines, ids, [product], "_physical")
    usd = F.try_divide(F.col(amount), F.col(rate))
    return flagged.withColumns(
        {"amount_usd": F.when(F.col(refund), -usd).otherwise(usd), "is_digital": ~F.col("_physical")}
    ).drop("_physical")


def parse_orders(raw: DataFrame, column: str, schema: str) -> DataFrame:
    """[K06] Ours: raw order JSON by schema; a line that is no JSON object gives nulls."""
    return raw.select(F.from_json(column, schema).alias("o")).select("o.*")


def hash_emails(df: DataFrame, column: str, salt: str = "", out: str | None = None) -> DataFrame:
    """[K07, P06, X18] The column replaced by its salted hash."""
    return df.withColumn(out or f"{column}_hash", stable_hash(F.col(column), salt)).drop(column)


def reidentification(df: DataFrame, column: str, salt: str = "") -> DataFrame:
    """[K07] Ours: distinct (hash, value) pairs, to be kept in a path of their own."""
    return df.filter(F.col(column).isNotNull()).select(
        stable_hash(F.col(column), salt).alias("hash"), F.lower(F.trim(F.col(column))).alias("value")
    ).distinct()


def metafields(products: DataFrame, key: str, fields: str, updated: str, shop: tuple[str, str] | None = None) -> DataFrame:
    """[K08] Ours: newest value of every metafield of a product, optionally of one shop."""
    rows = products if shop is None else products.filter(F.col(shop[0]) == shop[1])
    exploded = rows.select(key, updated, F.explode(fields).alias("m")).select(key, updated, "m.*")
    return latest(exploded, [key, "name"], [updated])


def bulk_operations(
    df: DataFrame, day: dt.date, shops: Sequence[str] = (), exclude: Sequence[str] = (), status: str = "CREATED"
) -> DataFrame:
    """[K09] Operations of a day with a status, of listed shops or of all but listed ones."""
    rows = df.filter((F.col("report_date") == F.lit(day)) & (F.col("bulk_operation_status") == status))
    if shops:
        rows = rows.filter(F.col("shop_domain").isin(*shops))
    return rows.filter(~F.col("shop_domain").isin(*exclude)) if exclude else rows


def chart_report(reports: Sequence[DataFrame], process_date: dt.date) -> DataFrame:
    """[K11, T01] Chart reports stacked, with the process date they are appended under."""
    return stack(reports).withColumn("process_date", F.lit(process_date))


def repeat_customers(orders: DataFrame, customer: str, order: str) -> DataFrame:
    """[K12] Ours: customers with two or more orders."""
    counts = orders.select(customer, order).distinct().groupBy(customer).agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.filter("n_orders >= 2")


def sales_by(lines: DataFrame, keys: Sequence[str], amount: str, quantity: str) -> DataFrame:
    """[K12] Ours: lines, units and amount by key, for the sales, product, line-item and refund extracts."""
    return lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(quantity).alias("units"), F.sum(amount).alias("amount")
    )


def promised_dates(orders: DataFrame, at: str, days: int, out: str = "promised") -> DataFrame:
    """[K12, K13] Ours: the day an order is promised for, a fixed number of days after it was placed."""
    return orders.withColumn(out, F.date_add(F.to_date(F.col(at)), days))


def fulfilment(lines: DataFrame, order: str, shipped: str) -> DataFrame:
    """[K12] Ours: per order the number of lines, shipped lines and the last ship date."""
    return lines.groupBy(order).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(shipped).alias("n_shipped"), F.max(shipped).alias("last_shipped")
    )


def campaign_tags(orders: DataFrame, order: str, tags: str, prefix: str) -> DataFrame:
    """[K12] Ours: one row per order and campaign, a campaign being a comma-separated tag with a prefix, without it."""
    tag = F.explode(F.array_distinct(F.transform(F.split(tags, ","), lambda t: F.lower(F.trim(t)))))
    rows = orders.select(order, tag.alias("tag")).filter(F.startswith("tag", F.lit(prefix)))
    return rows.select(order, F.substring("tag", F.lit(len(prefix) + 1), F.length("tag")).alias("campaign"))


def upsells(lines: DataFrame, order: str, product: str, amount: str) -> DataFrame:
    """[K12] Ours: per order of several products the amount beyond the dearest one."""
    products = lines.groupBy(order, product).agg(F.sum(amount).alias("_a"))
    totals = products.groupBy(order).agg(F.count(F.lit(1)).alias("n_products"), (F.sum("_a") - F.max("_a")).alias("upsell"))
    return totals.filter("n_products >= 2")


def shipping(lines: DataFrame, order: str, shipped: str, placed: str) -> DataFrame:
    """[K12] Ours: per order the days from placing to the first and to the last shipped line, null while none is."""
    days = F.datediff(F.to_date(shipped), F.to_date(placed))
    return lines.groupBy(order).agg(F.min(days).alias("first_days"), F.max(days).alias("last_days"))


def order_detail(orders: DataFrame, lines: DataFrame, order: str, columns: Sequence[str], line_columns: Sequence[str]) -> DataFrame:
    """[K12] Ours: every line with its order's columns; an order without lines keeps one row."""
    return orders.select(order, *columns).join(lines.select(order, *line_columns), order, "left")


def combined(extracts: Mapping[str, DataFrame], order: str) -> DataFrame:
    """[K12] Ours: extracts of one row per order side by side, columns named after their extract."""
    named = [df.select(order, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c != order]) for name, df in extracts.items()]
    return reduce(lambda a, b: a.join(b, order, "full"), named)


def rewrite_table(df: DataFrame, path: str) -> None:
    """[K13] A finance table rewritten in full from its query."""
    df.write.mode("overwrite").parquet(path)


def open_orders(orders: DataFrame, status: str, open_values: Sequence[str]) -> DataFrame:
    """[K14] Ours: orders whose status is among the open ones."""
    return orders.filter(F.col(status).isin(*open_values))


def merge_reporting(
    targets: Mapping[str, DataFrame], loads: Mapping[str, DataFrame], key: Mapping[str, Sequence[str]], newest: str
) -> dict[str, DataFrame]:
    """[K15, L12] Ours: disputes, gift cards, inventory and other entities merged, newest row per key."""
    return {n: merge(t, loads[n], key[n], [newest]) if n in loads else t for n, t in targets.items()}


def store_metadata(shops: DataFrame, key: str, updated: str, columns: Sequence[str]) -> DataFrame:
    """[K10, K16] Ours: the newest metadata row of every shop, chosen columns."""
    return latest(shops, [key], [updated]).select(key, *columns)
