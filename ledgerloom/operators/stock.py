"""Stock quantities, values, reservations and prices by item and production year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import normalize_dim, ratio
from ledgerloom.functions.predicates import (
    PURCHASE_VOUCHERS, SALES_VOUCHERS, draft, live, open_orders, submitted, up_to, within,
)
from ledgerloom.sources.tables import Tables

ITEM_YEAR = ["item_code", "production_year"]


def stock_qty(
    t: Tables, as_of: str | None = None, by: list[str] | None = None, positive: bool = False, warehouse: str | None = None
) -> DataFrame:
    """Quantity on hand at ``as_of`` (all dates if None), by item and year unless ``by`` says otherwise."""
    rows = up_to(live(t.stock_ledger_entry), as_of)
    if warehouse is not None:
        rows = rows.filter(F.col("warehouse") == warehouse)
    qty = normalize_dim(rows).groupBy(*(by or ITEM_YEAR)).agg(F.sum("actual_qty").alias("actual_qty"))
    return qty.filter("actual_qty > 0") if positive else qty


def valuation_rate_ledger(t: Tables, as_of: str | None = None) -> DataFrame:
    """Value per unit of the items in stock, from the ledger."""
    return item_balance(t, as_of).select("item_code", "valuation_rate")


def item_balance(t: Tables, as_of: str | None = None) -> DataFrame:
    """Quantity and value per unit of the items in stock."""
    return (
        up_to(live(t.stock_ledger_entry), as_of)
        .groupBy("item_code")
        .agg(F.sum("actual_qty").alias("actual_qty"), F.sum("stock_value_difference").alias("_value"))
        .filter("actual_qty > 0")
        .select("item_code", "actual_qty", ratio(F.col("_value"), F.col("actual_qty")).alias("valuation_rate"))
    )


def valuation_rate_bin(t: Tables) -> DataFrame:
    """Value per unit over the warehouse bins that hold stock."""
    return (
        t.bin.filter("actual_qty > 0")
        .groupBy("item_code")
        .agg(ratio(F.sum("stock_value"), F.sum("actual_qty")).alias("valuation_rate"))
    )


def open_order_lines(t: Tables, as_of: str | None = None) -> DataFrame:
    """Lines of open orders with something left to deliver, order columns under ``order_*``."""
    lines = normalize_dim(submitted(t.sales_order_item)).withColumn("pending", F.col("qty") - F.col("delivered_qty"))
    orders = open_orders(t.sales_order, as_of).select(
        F.col("name").alias("parent"), "customer", "transaction_date", "reservation_status", "set_warehouse"
    )
    return lines.filter("pending > 0").join(orders, "parent")


def reserved_qty(t: Tables, as_of: str | None = None) -> DataFrame:
    """Quantity that open orders still wait for.  Every line counted is positive, so one sum is enough."""
    return open_order_lines(t, as_of).groupBy(*ITEM_YEAR).agg(F.sum("pending").alias("qty_to_deliver"))


def reserved_qty_having(t: Tables) -> DataFrame:
    """The variant in which over-delivered lines offset others of the same item and year."""
    orders = open_orders(t.sales_order).select(F.col("name").alias("parent"))
    return (
        normalize_dim(submitted(t.sales_order_item))
        .join(orders, "parent", "left_semi")
        .groupBy(*ITEM_YEAR)
        .agg(F.sum(F.col("qty") - F.col("delivered_qty")).alias("qty_to_deliver"))
        .filter("qty_to_deliver > 0")
    )


def virtual_receipt_lines(t: Tables) -> DataFrame:
    """Lines of draft receipts that are flagged as expected goods."""
    receipts = draft(t.purchase_receipt).filter("virtual_receipt = 1").select(F.col("name").alias("parent"), "is_return")
    return normalize_dim(draft(t.purchase_receipt_item)).join(receipts, "parent")


def virtual_receipt_qty(t: Tables) -> DataFrame:
    return (
        virtual_receipt_lines(t)
        .filter("qty > 0 AND is_return = 0")
        .groupBy(*ITEM_YEAR)
        .agg(F.sum("qty").alias("qty_to_receive"))
    )


def selling_price(t: Tables) -> DataFrame:
    """Price rows of the default selling list."""
    default_list = t.singles.filter("doctype = 'Selling Settings' AND field = 'selling_price_list'").select(
        F.col("value").alias("price_list")
    )
    return (
        normalize_dim(t.item_price.filter("selling = 1"))
        .join(default_list, "price_list", "left_semi")
        .select(*ITEM_YEAR, "price_list_rate", F.col("name").alias("price_name"))
    )


def item_years(t: Tables, as_of: str | None = None) -> DataFrame:
    """Items with the production years seen in live ledger rows; an item without any gets the blank year.

    ``actual_qty`` is the quantity on hand at ``as_of`` where that is positive, found in the same pass.
    """
    in_time = F.lit(True) if as_of is None else F.col("posting_date") <= F.lit(as_of).cast("date")
    seen = (
        normalize_dim(live(t.stock_ledger_entry)).groupBy(*ITEM_YEAR)
        .agg(F.sum(F.when(in_time, F.col("actual_qty"))).alias("_qty"))
        .select(F.col("item_code").alias("name"), "production_year", F.when(F.col("_qty") > 0, F.col("_qty")).alias("actual_qty"))
    )
    return normalize_dim(t.item.join(seen, "name", "left").withColumn("item_code", F.col("name")))


def cogs_by_item(t: Tables, from_date: str, to_date: str) -> DataFrame:
    sold = live(t.stock_ledger_entry).filter(F.col("voucher_type").isin(*SALES_VOUCHERS))
    return within(sold, from_date, to_date).groupBy("item_code").agg((-F.sum("stock_value_difference")).alias("cost"))


def held_and_sold(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """Quantity on hand at ``to_date`` and cost of what was sold in the period, per item, in one pass over the ledger."""
    sold = F.col("posting_date").between(F.lit(from_date).cast("date"), F.lit(to_date).cast("date")) & F.col("voucher_type").isin(*SALES_VOUCHERS)
    return up_to(live(t.stock_ledger_entry), to_date).groupBy("item_code").agg(
        F.sum("actual_qty").alias("stock_qty"), F.sum(F.when(sold, -F.col("stock_value_difference"))).alias("sales_cost")
    )


def valued_stock(t: Tables, as_of: str | None = None) -> DataFrame:
    """All items and years of the ledger with their quantity and the item's quantity and value over all years, in one pass.

    The window is over sums: it holds one row per year of an item.
    """
    sums = normalize_dim(up_to(live(t.stock_ledger_entry), as_of)).groupBy(*ITEM_YEAR).agg(
        F.sum("actual_qty").alias("actual_qty"), F.sum("stock_value_difference").alias("_value")
    )
    item = Window.partitionBy("item_code")
    return sums.select(
        *ITEM_YEAR, "actual_qty", F.sum("actual_qty").over(item).alias("item_qty"), F.sum("_value").over(item).alias("item_value")
    )


def cogs_by_customer(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """Cost of what left stock, by the customer of the stock-updating invoice or delivery note."""
    invoices = submitted(t.sales_invoice).filter("update_stock = 1")
    vouchers = (
        within(invoices, from_date, to_date).select("name", "customer")
        .union(within(submitted(t.delivery_note), from_date, to_date).select("name", "customer"))
        .distinct()
    )
    sold = within(live(t.stock_ledger_entry).filter(F.col("voucher_type").isin(*SALES_VOUCHERS)), from_date, to_date)
    # Costs are summed per voucher before the join, so a voucher with many lines travels as one row.
    per_voucher = sold.groupBy(F.col("voucher_no").alias("name")).agg(F.sum("stock_value_difference").alias("_value"))
    return per_voucher.join(vouchers, "name").groupBy("customer").agg((-F.sum("_value")).alias("cost"))


def stock_movements(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """Opening, purchased, sold and ending quantity per item in one pass over the ledger.

    Opening-stock reconciliations count one day earlier, so one dated ``from_date`` belongs to the opening.
    """
    first, last = F.lit(from_date).cast("date"), F.lit(to_date).cast("date")
    opening_docs = submitted(t.stock_reconciliation).filter("purpose = 'Opening Stock'").select(
        F.col("name").alias("voucher_no"), F.date_sub("posting_date", 1).alias("_opening_date")
    )
    # Whatever counts was posted by the end of the period, openings included.
    rows = up_to(live(t.stock_ledger_entry), to_date).join(opening_docs, "voucher_no", "left")
    date, kind, qty = F.col("posting_date"), F.col("voucher_type"), F.col("actual_qty")
    in_period = date.between(first, last)
    return rows.groupBy("item_code").agg(
        F.sum(F.when(F.coalesce("_opening_date", date) < first, qty)).alias("opening_stock"),
        F.sum(F.when(in_period & kind.isin(*PURCHASE_VOUCHERS), qty)).alias("purchases"),
        F.sum(F.when(in_period & kind.isin(*SALES_VOUCHERS), -qty)).alias("sales"),
        F.sum(qty).alias("ending_stock"),
    )
