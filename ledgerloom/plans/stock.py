"""Stock ageing and the stock balance reports with reservations and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import doubles, or_zero, ratio, rounded
from ledgerloom.functions.predicates import RECEIPT_VOUCHERS, live, submitted, up_to
from ledgerloom.operators import stock as S
from ledgerloom.sources.tables import Tables

# The choices of the balance reports.
ACTUAL, AVAILABLE, FUTURE = "Actual Balances", "Available Balances", "Available and Future Balances"


def _sized(t: Tables, df: DataFrame) -> DataFrame:
    """With the sort code of the item's size."""
    return df.join(t.tire_size.select(F.col("name").alias("tire_size"), "sorting_code"), "tire_size", "left")


def receipts_by_day(t: Tables, as_of: str) -> DataFrame:
    """Received quantity per item and day, legacy purchases included."""
    real = (
        up_to(submitted(t.purchase_receipt).filter("is_return = 0"), as_of).select("name")
        .union(up_to(submitted(t.purchase_invoice).filter("is_return = 0 AND update_stock = 1"), as_of).select("name"))
        .union(up_to(submitted(t.stock_entry).filter("stock_entry_type = 'Material Receipt'"), as_of).select("name"))
        .withColumnRenamed("name", "voucher_no")
    )
    received = (
        up_to(live(t.stock_ledger_entry), as_of)
        .filter((F.col("actual_qty") > 0) & F.col("voucher_type").isin(*RECEIPT_VOUCHERS))
        .join(real, "voucher_no", "left_semi")
        .select("item_code", "posting_date", "actual_qty")
    )
    legacy = t.legacy_purchase_ledger.select("item_code", "posting_date", "actual_qty")
    return received.unionByName(legacy).groupBy("item_code", "posting_date").agg(F.sum("actual_qty").alias("receipt_qty"))


def fifo_remainder(t: Tables, as_of: str) -> DataFrame:
    """The part of each day's receipts that is still in stock if the oldest goods leave first.

    A window holds one row per day of an item, however many ledger rows a day had.
    """
    newest_first = Window.partitionBy("item_code").orderBy(F.desc("posting_date"))
    later = F.sum("receipt_qty").over(newest_first.rowsBetween(Window.unboundedPreceding, -1))
    balance = S.item_balance(t, as_of)
    rows = receipts_by_day(t, as_of).join(balance, "item_code").withColumn("_later", or_zero(later))
    # What is left of the balance after the later receipts, at most the receipt itself.
    left = F.least(F.col("receipt_qty"), F.col("actual_qty") - F.col("_later"))
    age = F.datediff(F.lit(as_of).cast("date"), "posting_date") + 1
    return rows.withColumns({"os_qty": left, "age": age}).filter("os_qty > 0").select(
        "item_code", "posting_date", "receipt_qty", "os_qty", "age", "actual_qty", "valuation_rate"
    )


def stock_ageing(t: Tables, as_of: str, min_age: float = 0) -> DataFrame:
    """Average age in days of what is in stock, first in first out."""
    aged = (
        fifo_remainder(t, as_of)
        .groupBy("item_code", "actual_qty", "valuation_rate")
        .agg(ratio(F.sum(F.col("os_qty") * F.col("age")), F.sum("os_qty")).alias("avg_age"))
        .filter(F.col("avg_age") >= min_age)
    )
    items = t.item.select(
        F.col("name").alias("item_code"), "item_name", "item_group", F.col("country_of_origin").alias("origin"), "brand", "tire_size"
    )
    report = _sized(t, aged.join(items, "item_code")).orderBy("brand", F.coalesce("sorting_code", F.lit("Z")))
    return report.select(
        "item_code", "item_name", "item_group", "origin", "brand", F.col("actual_qty").cast("double").alias("actual_qty"),
        rounded(F.col("valuation_rate"), 6).alias("valuation_rate"), rounded(F.col("avg_age"), 6).alias("avg_age"),
    )


def _balances(t: Tables, as_of: str) -> DataFrame:
    """Positive stock with what open orders wait for."""
    return S.stock_qty(t, as_of, positive=True).join(S.reserved_qty(t, as_of), S.ITEM_YEAR, "left")


_ITEM = ("item_name", "brand", "tire_size", "ply_rating", "is_stock_item")


def _items(t: Tables) -> DataFrame:
    return t.item.select(F.col("name").alias("item_code"), *_ITEM)


def _by_mode(mode: str, actual: Column, available: Column) -> Column:
    return {ACTUAL: actual, AVAILABLE: available}.get(mode, F.lit(False))


def stock_balance(t: Tables, as_of: str, filter_based_on: str = ACTUAL, strict: bool = False) -> DataFrame:
    """Stock, reservations and what is left, by item and year.

    Without ``strict`` no row is dropped: a row that fails the choice shows no reservation, as users of the
    report know it.  With ``strict`` such rows are left out.
    """
    rows = _balances(t, as_of).join(_items(t), "item_code")
    left = F.col("actual_qty") - or_zero("qty_to_deliver")
    kept = (F.col("is_stock_item") == 1) & _by_mode(filter_based_on, F.lit(True), left > 0)
    rows = rows.filter(kept) if strict else rows.withColumn("qty_to_deliver", F.when(kept, F.col("qty_to_deliver")))
    rows = rows.withColumn("qty_to_deliver", or_zero("qty_to_deliver")).withColumn(
        "available_qty", F.col("actual_qty") - F.col("qty_to_deliver")
    )
    report = _sized(t, rows).orderBy("brand", "sorting_code", "ply_rating")
    return doubles(report, "actual_qty", "qty_to_deliver", "available_qty").select(
        "item_code", "item_name", "production_year", "brand", "actual_qty", "qty_to_deliver", "available_qty"
    )


def available_items(t: Tables, as_of: str, filter_based_on: str = ACTUAL, min_bal: float = 1) -> DataFrame:
    """Priced stock items with at least ``min_bal`` on hand, or left after reservations."""
    left = F.col("actual_qty") - or_zero("qty_to_deliver")
    rows = (
        _balances(t, as_of)
        .filter(_by_mode(filter_based_on, F.col("actual_qty") >= min_bal, left >= min_bal))
        .join(_items(t).filter("is_stock_item = 1"), "item_code")
        .join(S.selling_price(t), S.ITEM_YEAR, "left")
    )
    report = _sized(t, rows).orderBy("brand", "sorting_code", "ply_rating")
    return doubles(report, "price_list_rate").select("item_code", "item_name", "production_year", "brand", "price_list_rate")


def stock_balance_prices(
    t: Tables, as_of: str, filter_based_on: str = ACTUAL, minimum_qty: int = 1, brands: list[str] | None = None
) -> DataFrame:
    """Stock, reservations, expected goods and price; with ``minimum_qty`` at most 0 also items without stock."""
    wanted = [b.strip() for b in brands or [] if b.strip()]
    items = S.item_years(t, as_of).filter("is_stock_item = 1")
    if wanted:
        items = items.filter(F.col("brand").isin(wanted))
    rows = (
        items.join(S.reserved_qty(t, as_of), S.ITEM_YEAR, "left")
        .join(S.virtual_receipt_qty(t), S.ITEM_YEAR, "left")
        .withColumns({c: or_zero(c) for c in ("actual_qty", "qty_to_deliver", "qty_to_receive")})
        .withColumn("available_qty", F.col("actual_qty") - F.col("qty_to_deliver"))
    )
    measure = {
        ACTUAL: F.col("actual_qty"), AVAILABLE: F.col("available_qty"), FUTURE: F.col("available_qty") + F.col("qty_to_receive")
    }.get(filter_based_on)
    rows = rows.filter(F.lit(False) if measure is None else measure >= minimum_qty)
    report = _sized(t, rows.join(S.selling_price(t), S.ITEM_YEAR, "left")).orderBy("brand", "sorting_code")
    numbers = ("actual_qty", "qty_to_deliver", "available_qty", "qty_to_receive", "price_list_rate")
    return doubles(report, *numbers).select("item_code", "item_name", "production_year", "brand", *numbers)


def stock_balance_cost_prices(t: Tables, as_of: str, filter_based_on: str = ACTUAL) -> DataFrame:
    """Stock in hand with price (by year) and value per unit (by item)."""
    left = F.col("actual_qty") - or_zero("qty_to_deliver")
    value = F.when(F.col("item_qty") > 0, ratio(F.col("item_value"), F.col("item_qty")))
    stock = S.valued_stock(t, as_of).filter("actual_qty > 0").withColumn("valuation_rate", value)
    rows = (
        stock.join(S.reserved_qty(t, as_of), S.ITEM_YEAR, "left")
        .filter(_by_mode(filter_based_on, F.lit(True), left > 0))
        .join(_items(t).filter("is_stock_item = 1"), "item_code")
        .join(S.selling_price(t), S.ITEM_YEAR, "left")
        .withColumn("qty_to_deliver", or_zero("qty_to_deliver"))
        .withColumn("available_qty", F.col("actual_qty") - F.col("qty_to_deliver"))
    )
    report = _sized(t, rows).orderBy("brand", "sorting_code")
    numbers = ("actual_qty", "qty_to_deliver", "available_qty", "price_list_rate")
    return doubles(report, *numbers).select(
        "item_code", "item_name", "production_year", "brand", *numbers, rounded(F.col("valuation_rate"), 6).alias("valuation_rate")
    )
