"""Item and brand performance, movements, ledgers, reservations and receipt details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import doubles, normalize_dim, or_zero, percent, percent_text, year_or_blank
from ledgerloom.functions.predicates import live, not_cancelled, only, submitted, within
from ledgerloom.operators import gl as G
from ledgerloom.operators.running import running_total
from ledgerloom.operators.sales import sales_by
from ledgerloom.operators.stock import held_and_sold, open_order_lines, stock_movements
from ledgerloom.sources.tables import Tables


def _item_results(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """Items with sales or stock: exact sums, shared by the item and the brand report."""
    sales = sales_by(t, "item_code", from_date, to_date).select(
        "item_code", F.col("qty").alias("sales_qty"), F.col("net_amount").alias("sales_amount")
    )
    joined = (
        t.item.select(F.col("name").alias("item_code"), "item_name", "brand")
        .join(sales, "item_code", "left")
        .join(held_and_sold(t, from_date, to_date), "item_code", "left")
    )
    measures = ("sales_qty", "sales_amount", "sales_cost", "stock_qty")
    joined = joined.withColumns({c: or_zero(c) for c in measures})
    return joined.filter(F.abs("sales_qty") + F.col("stock_qty") > 0)


def _with_markup(df: DataFrame) -> DataFrame:
    profit = F.col("sales_amount") - F.col("sales_cost")
    return df.withColumn("gross_profit", profit).withColumn("markup", percent_text(percent(profit, F.col("sales_cost"))))


_RESULT = ("sales_qty", "sales_amount", "sales_cost", "gross_profit")


def item_performance(t: Tables, from_date: str, to_date: str) -> DataFrame:
    report = _with_markup(_item_results(t, from_date, to_date)).orderBy("brand", F.desc("sales_qty"))
    return doubles(report, *_RESULT, "stock_qty").select("item_code", "item_name", "brand", *_RESULT, "markup", "stock_qty")


def brand_performance(t: Tables, from_date: str, to_date: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("sales_qty", "sales_amount", "sales_cost", "stock_qty")]
    report = _with_markup(_item_results(t, from_date, to_date).groupBy("brand").agg(*sums)).orderBy("brand")
    return doubles(report, *_RESULT, "stock_qty").select("brand", *_RESULT, "markup", "stock_qty")


_MOVES = ("opening_stock", "purchases", "sales", "ending_stock")


def _item_moves(t: Tables, from_date: str, to_date: str) -> DataFrame:
    items = t.item.select(F.col("name").alias("item_code"), "item_name", "item_group", "brand", "country_of_origin")
    moves = items.join(stock_movements(t, from_date, to_date), "item_code").withColumns({c: or_zero(c) for c in _MOVES})
    return moves.filter(F.col("opening_stock") + F.abs("purchases") + F.abs("sales") + F.col("ending_stock") > 0)


def item_transactions(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """Opening, purchased, sold and ending quantity of items that have any (other movements are not shown)."""
    report = _item_moves(t, from_date, to_date).orderBy("brand", F.desc("ending_stock"))
    return doubles(report, *_MOVES).select("item_code", "item_name", "item_group", "brand", "country_of_origin", *_MOVES)


def brand_transactions(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """The item report filtered per item first, then summed by brand, group and origin."""
    group = ["brand", "item_group", "country_of_origin"]
    sums = _item_moves(t, from_date, to_date).groupBy(*group).agg(*(F.sum(c).alias(c) for c in _MOVES))
    return doubles(sums.orderBy("brand", F.desc("ending_stock")), *_MOVES).select(*group, *_MOVES)


def item_ledger(t: Tables, from_date: str, to_date: str, items: list[str] | None = None) -> DataFrame:
    """Stock movements per voucher with the quantity on hand after each voucher, for all items or the given ones."""
    ledger = only(live(t.stock_ledger_entry), "item_code", items)
    came = F.when(F.col("actual_qty") > 0, F.col("actual_qty")).otherwise(0)
    went = F.when(F.col("actual_qty") < 0, -F.col("actual_qty")).otherwise(0)
    in_out = [F.sum(came).alias("qty_in"), F.sum(went).alias("qty_out")]

    customers = t.customer_master.select(F.col("name").alias("customer"), "customer_name")
    invoices = within(submitted(t.sales_invoice).filter("update_stock = 1"), from_date, to_date)
    notes = within(submitted(t.delivery_note), from_date, to_date)
    vouchers = (
        invoices.select(F.lit("Sales Invoice").alias("voucher_type"), F.col("name").alias("voucher_no"), "customer")
        .unionByName(notes.select(F.lit("Delivery Note").alias("voucher_type"), F.col("name").alias("voucher_no"), "customer"))
        .join(customers, "customer")
        .drop("customer")
    )
    moves = (
        normalize_dim(within(ledger, from_date, to_date))
        .groupBy("item_code", "posting_date", "voucher_type", "voucher_no", "production_year")
        .agg(*in_out)
        .join(vouchers, ["voucher_type", "voucher_no"], "left")
        .withColumn("row_kind", F.lit(G.PERIOD_ROW))
    )
    nothing = only(t.item, "name", items).select(F.col("name").alias("item_code"), F.lit(0).cast("decimal(18,3)").alias("actual_qty"))
    before = ledger.filter(F.col("posting_date") < F.lit(from_date).cast("date")).select("item_code", "actual_qty")
    opening = (
        before.unionByName(nothing).groupBy("item_code").agg(*in_out)
        .withColumns(
            {
                "posting_date": F.lit(None).cast("date"), "voucher_type": F.lit(G.OPENING),
                "voucher_no": F.lit(None).cast("string"), "production_year": F.lit(None).cast("string"),
                "customer_name": F.lit(None).cast("string"), "row_kind": F.lit(G.OPENING_ROW),
            }
        )
    )
    rows = opening.unionByName(moves).withColumns(
        {"_day": F.coalesce("posting_date", F.lit("0001-01-01").cast("date")), "_move": F.col("qty_in") - F.col("qty_out")}
    )
    # Ordered by date and number only: the rows of one voucher share the balance after it.
    lines = running_total(rows, ["item_code"], "_day", ["voucher_no"], {"_move": "balance"})
    names = t.item.select(F.col("name").alias("item_code"), "item_name")
    lines = G.translate_voucher_type(lines, t).join(names, "item_code", "left")
    return doubles(lines, "qty_in", "qty_out", "balance").select(
        "item_code", "row_kind", "posting_date", "translated_voucher_type", "voucher_no", "customer_name", "production_year",
        "qty_in", "qty_out", "balance", "item_name", "voucher_type",
    ).orderBy("item_code", "posting_date", "voucher_no")


def item_reservations(t: Tables, items: list[str] | None = None) -> DataFrame:
    """What each open order still waits for, by item and year."""
    lines = (
        only(open_order_lines(t), "item_code", items)
        .groupBy("item_code", F.col("parent").alias("sales_order"), "transaction_date", "customer", "production_year")
        .agg(F.sum("pending").alias("qty_to_deliver"), F.max("rate").alias("rate"))
    )
    named = lines.join(t.item.select(F.col("name").alias("item_code"), "item_name", "brand"), "item_code").join(
        t.customer_master.select(F.col("name").alias("customer"), "customer_name"), "customer"
    )
    return doubles(named, "qty_to_deliver", "rate").select(
        "item_code", "item_name", "brand", "sales_order", "transaction_date", "customer_name", "production_year",
        "qty_to_deliver", "rate",
    )


def item_sales_ledger(t: Tables, from_date: str, to_date: str, items: list[str] | None = None) -> DataFrame:
    """Invoice lines with returned and sold quantity."""
    invoices = within(submitted(t.sales_invoice).filter("is_opening = 'No'"), from_date, to_date).select(
        F.col("name").alias("sales_invoice"), "posting_date", "customer"
    )
    qty = F.col("qty")
    lines = (
        only(submitted(t.sales_invoice_item), "item_code", items)
        .withColumnRenamed("parent", "sales_invoice")
        .join(invoices, "sales_invoice")
        .join(t.item.select(F.col("name").alias("item_code"), "item_name"), "item_code")
        .join(t.customer_master.select(F.col("name").alias("customer"), "customer_name"), "customer")
    )
    return lines.select(
        "item_code", "item_name", "sales_invoice", "posting_date", "customer", "customer_name",
        year_or_blank().alias("production_year"),
        F.greatest(-qty, F.lit(0)).cast("double").alias("in_qty"), F.greatest(qty, F.lit(0)).cast("double").alias("out_qty"),
        F.col("rate").cast("double").alias("rate"),
    ).orderBy(F.desc("posting_date"), F.desc("sales_invoice"))


def receipt_details(t: Tables, receipts: list[str] | None = None) -> DataFrame:
    """Quantities of each receipt by item and year."""
    headers = not_cancelled(only(t.purchase_receipt, "name", receipts)).filter("is_return = 0").select(
        F.col("name").alias("purchase_receipt"), F.col("title").alias("shipment_name")
    )
    # Summed per receipt line key before any join.
    sums = (
        not_cancelled(only(t.purchase_receipt_item, "parent", receipts)).filter("qty > 0")
        .groupBy(F.col("parent").alias("purchase_receipt"), "item_code", "item_name", "production_year", "brand")
        .agg(F.sum("qty").cast("double").alias("qty"))
    )
    sizes = t.tire_size.select(F.col("name").alias("tire_size"), "sorting_code")
    items = t.item.select(F.col("name").alias("item_code"), "tire_size")
    report = sums.join(headers, "purchase_receipt").join(items, "item_code").join(sizes, "tire_size", "left")
    return report.orderBy("purchase_receipt", "brand", "sorting_code", "item_code").select(
        "purchase_receipt", "shipment_name", "item_code", "item_name", "production_year", "brand", "qty"
    )
