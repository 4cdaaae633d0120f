"""Availability to promise, and the order and receipt lines it does not cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import normalize_dim, or_zero
from ledgerloom.functions.predicates import FUTURE_RESERVATION, live, open_orders, submitted
from ledgerloom.operators.stock import open_order_lines, virtual_receipt_lines
from ledgerloom.sources.tables import Tables

_PARTS = ("stock", "expected", "reserved_now", "reserved_future")
# Stands for all years of an item.
_ANY = "any year"


def available_to_promise(t: Tables, any_year: bool = False) -> DataFrame:
    """Stock, expected goods and reservations per item, year and warehouse, and what may still be sold.

    Reservations against future receipts use up the expected goods first; what exceeds these takes from stock.
    An order without a reservation status counts in neither group.  The four sums are gathered by one
    grouping over their union, so keys known to only one of them are kept without outer joins.
    ``any_year`` sums the years of an item.
    """
    keys = ["item_code", "warehouse"] if any_year else ["item_code", "production_year", "warehouse"]
    zero = F.lit(0).cast("decimal(28,3)")

    def part(df: DataFrame, name: Column | str, qty: str) -> DataFrame:
        return df.select(*keys, *((F.col(qty).cast("decimal(28,3)") if p == name else zero).alias(p) for p in _PARTS))

    stock_items = t.item.filter("is_stock_item = 1").select(F.col("name").alias("item_code"))
    orders = open_order_lines(t).join(stock_items, "item_code", "left_semi").withColumnRenamed("set_warehouse", "warehouse")
    future = F.col("reservation_status") == FUTURE_RESERVATION
    # The ledger is summed by itself first, so its many keys carry one sum and not four.
    stock = normalize_dim(live(t.stock_ledger_entry)).groupBy(*keys).agg(F.sum("actual_qty").alias("_qty"))
    parts = (
        part(stock, "stock", "_qty")
        .unionByName(part(virtual_receipt_lines(t), "expected", "qty"))
        .unionByName(
            orders.filter(future.isNotNull()).select(
                *keys, zero.alias("stock"), zero.alias("expected"),
                F.when(~future, F.col("pending").cast("decimal(28,3)")).otherwise(zero).alias("reserved_now"),
                F.when(future, F.col("pending").cast("decimal(28,3)")).otherwise(zero).alias("reserved_future"),
            )
        )
    )
    return _promised(parts.groupBy(*keys).agg(*(F.sum(p).alias(p) for p in _PARTS)))


def _promised(sums: DataFrame) -> DataFrame:
    excess = F.greatest(F.col("reserved_future") - F.col("expected"), F.lit(0))
    return sums.withColumns(
        {
            "actual_available": F.col("stock") - F.col("reserved_now") - excess,
            "future_available": F.col("stock") + F.col("expected") - F.col("reserved_now") - F.col("reserved_future"),
        }
    )


def order_shortages(t: Tables, any_year: bool = False, reserves_future: bool = True) -> DataFrame:
    """Lines of open orders whose item cannot be promised, with the missing quantity.

    A line with a production year needs goods of that year, a line without one (with ``any_year``, every line) goods of any.
    Orders against future receipts count expected goods too, if the user has the role for it (``reserves_future``).
    """
    keys = ["item_code", "production_year", "warehouse"]
    orders = open_orders(t.sales_order).select(
        F.col("name").alias("parent"), "customer", "reservation_status", F.col("set_warehouse").alias("warehouse")
    )
    lines = normalize_dim(submitted(t.sales_order_item)).select("parent", "name", "item_code", "production_year", "qty")
    # The figures of each year of an item and warehouse, and their sums over all years.
    by_year = available_to_promise(t).select(*keys, *_PARTS)
    both = by_year.withColumn("_year", F.explode(F.array("production_year", F.lit(_ANY))))
    promise = _promised(both.groupBy("item_code", "warehouse", "_year").agg(*(F.sum(p).alias(p) for p in _PARTS)))
    promise = promise.select("item_code", "warehouse", "_year", "actual_available", "future_available")
    year = F.when(F.lit(any_year) | (F.col("production_year") == ""), F.lit(_ANY)).otherwise(F.col("production_year"))
    checked = lines.withColumn("_year", year).join(orders, "parent").join(promise, ["item_code", "warehouse", "_year"], "left")
    is_future = F.lit(reserves_future) & F.coalesce(F.col("reservation_status") == FUTURE_RESERVATION, F.lit(False))
    available = or_zero(F.when(is_future, F.col("future_available")).otherwise(F.col("actual_available")))
    return (
        checked.withColumn("shortage", -available)
        .filter("shortage > 0")
        .select("parent", "name", "customer", "item_code", "production_year", "warehouse", "qty", "shortage")
    )


def unvirtualize_check(t: Tables) -> DataFrame:
    """Lines of expected receipts that orders already rely on: dropping them would leave units missing."""
    keys = ["item_code", "production_year", "warehouse"]
    promise = available_to_promise(t).select(*keys, "future_available")
    lines = virtual_receipt_lines(t).select("parent", "name", *keys, "qty")
    return (
        lines.join(promise, keys)
        .withColumn("missing", F.col("qty") - F.col("future_available"))
        .filter("missing > 0")
        .select("parent", "name", *keys, "qty", "future_available", "missing")
    )
