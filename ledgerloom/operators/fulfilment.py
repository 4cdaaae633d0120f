"""From orders to deliveries to invoices: what is pending, billed, delivered, closable or to be changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import or_zero, ratio, rounded
from ledgerloom.functions.predicates import draft, not_cancelled, submitted
from ledgerloom.sources.tables import Tables


def pending_delivery_lines(t: Tables) -> DataFrame:
    """Undelivered rest of submitted orders as delivery lines; orders with a draft delivery wait."""
    drafts = draft(t.delivery_note_item).select(F.col("against_sales_order").alias("parent"))
    orders = submitted(t.sales_order).select(F.col("name").alias("parent"), F.col("set_warehouse").alias("warehouse"), "customer")
    lines = submitted(t.sales_order_item).withColumn("_rest", F.col("qty") - F.col("delivered_qty")).filter("_rest > 0")
    items = t.item.select(F.col("name").alias("item_code"), F.col("brand").alias("_brand"))
    rows = lines.join(orders, "parent").join(drafts, "parent", "left_anti").join(items, "item_code", "left")
    brand = F.when(F.coalesce("brand", F.lit("")) != "", F.col("brand")).otherwise(F.coalesce("_brand", F.lit("")))
    return rows.select(
        F.col("parent").alias("against_sales_order"), "customer", F.col("name").alias("so_detail"), "item_code", "production_year",
        F.col("_rest").cast("double").alias("qty"), "warehouse", "rate", "price_list_rate", brand.alias("brand"),
    ).orderBy("against_sales_order", "brand")


def pending_billing_lines(t: Tables) -> DataFrame:
    """Unbilled rest of submitted delivery notes as invoice lines; notes with a draft invoice wait."""
    drafts = draft(t.sales_invoice_item).select(F.col("delivery_note").alias("parent"))
    notes = submitted(t.delivery_note).select(F.col("name").alias("parent"), F.col("set_warehouse").alias("warehouse"), "customer")
    lines = submitted(t.delivery_note_item).withColumn("_rest", F.col("qty") - F.col("billed_qty")).filter("_rest > 0")
    return lines.join(notes, "parent").join(drafts, "parent", "left_anti").select(
        F.col("parent").alias("delivery_note"), "customer", F.col("name").alias("dn_detail"), "so_detail",
        F.col("against_sales_order").alias("sales_order"), "item_code", "production_year",
        F.col("_rest").cast("double").alias("qty"), "warehouse", "rate", "price_list_rate",
    )


def billed_qty_rollup(t: Tables) -> DataFrame:
    """Billed quantity per order line and delivery line, summed over live invoices instead of kept by increments."""
    invoices = submitted(t.sales_invoice).filter("is_return = 0 AND update_stock = 0 AND is_opening <> 'Yes'").select(
        F.col("name").alias("parent")
    )
    lines = submitted(t.sales_invoice_item).join(invoices, "parent", "left_semi")
    sides = F.array(
        F.struct(F.lit("Sales Order Item").alias("line_type"), F.col("so_detail").alias("line")),
        F.struct(F.lit("Delivery Note Item").alias("line_type"), F.col("dn_detail").alias("line")),
    )
    return (
        lines.select("qty", F.explode(sides).alias("_s"))
        .select("qty", "_s.line_type", "_s.line")
        .filter("line IS NOT NULL")
        .groupBy("line_type", "line")
        .agg(F.sum("qty").alias("billed_qty"))
    )


def delivery_billing_status(t: Tables) -> DataFrame:
    """How far each delivery note is billed, in percent."""
    sums = t.delivery_note_item.groupBy(F.col("parent").alias("delivery_note")).agg(
        F.sum(or_zero("billed_qty")).alias("_billed"), F.sum("qty").alias("_qty")
    )
    billed, qty = F.col("_billed"), F.col("_qty")
    partly = (billed > 0) & (billed < qty)
    return sums.select(
        "delivery_note",
        F.when(billed == 0, 0.0).when(partly, rounded(ratio(billed, qty) * 100, 6)).otherwise(100.0).alias("per_billed"),
        F.when(billed == 0, "Not Billed").when(partly, "Partly Billed").otherwise("Fully Billed").alias("billing_status"),
    )


def orders_to_close(t: Tables) -> DataFrame:
    """Orders, not closed yet, with nothing left to do: all lines billed by quantity, or fully delivered and partly billed."""
    lines = t.sales_order_item.groupBy(F.col("parent").alias("name")).agg(
        F.bool_and(F.col("qty").eqNullSafe(F.col("billed_qty"))).alias("_all_billed")
    )
    still_open = submitted(t.sales_order).filter("status IS NULL OR status <> 'Closed'")
    orders = still_open.select("name", "per_billed", "billing_status", "delivery_status")
    by_lines = F.coalesce(F.col("_all_billed") & (F.col("per_billed") < 100), F.lit(False))
    by_status = (F.col("billing_status") == "Partly Billed") & (F.col("delivery_status") == "Fully Delivered")
    reason = F.when(by_lines, "all lines billed").when(by_status, "delivered, partly billed")
    return orders.join(lines, "name", "left").withColumn("reason", reason).filter("reason IS NOT NULL").select("name", "reason")


def delivery_status(orders: DataFrame) -> DataFrame:
    """The delivery indicator of orders: closed and held orders keep their status, drafts have none."""
    done = F.col("per_delivered")
    live_order = F.col("docstatus") == 1
    status = (
        F.when(F.col("status").isin("On Hold", "Closed"), F.col("status"))
        .when(live_order & (done == 0), "Not Delivered")
        .when(live_order & (done < 100), "Partly Delivered")
        .when(live_order & (done == 100), "Fully Delivered")
    )
    return orders.withColumn("indicator", status)


def reconciliation_candidates(t: Tables) -> DataFrame:
    """Customers with unpaid invoices and, at the same time, payments, credits or returns not yet set against them."""
    invoices = submitted(t.sales_invoice).groupBy("customer").agg(
        F.max("outstanding_amount").alias("_largest"),
        F.sum(F.when(F.expr("outstanding_amount < 0 AND is_return = 1"), F.col("outstanding_amount"))).alias("return_amount"),
    )
    payments = (
        submitted(t.payment_entry).filter("unallocated_amount > 0").groupBy(F.col("party").alias("customer"))
        .agg(F.sum("unallocated_amount").alias("unallocated_amount"))
    )
    credits = (
        submitted(t.journal_entry_account).filter("credit > 0 AND reference_name IS NULL").groupBy(F.col("party").alias("customer"))
        .agg(F.sum("credit").alias("credit_amount"))
    )
    sums = ("unallocated_amount", "credit_amount", "return_amount")
    return (
        invoices.filter("_largest > 0")
        .join(payments, "customer", "left").join(credits, "customer", "left")
        .withColumns({c: or_zero(c) for c in sums})
        .filter("unallocated_amount <> 0 OR credit_amount <> 0 OR return_amount <> 0")
        .select("customer", *(F.col(c).cast("double").alias(c) for c in sums))
    )


def line_margin_discount(lines: DataFrame) -> DataFrame:
    """Margin or discount of a line's rate against its list price; lines without a list price keep NULLs."""
    rate, listed = F.col("rate").cast("double"), F.col("price_list_rate").cast("double")
    priced = F.coalesce(listed, F.lit(0.0)) != 0
    above = rate > listed
    return lines.withColumns(
        {
            "margin_type": F.when(priced, F.when(above, "Amount").otherwise("")),
            "margin_rate_or_amount": F.when(priced, F.when(above, rounded(rate - listed, 6)).otherwise(0.0)),
            "rate_with_margin": F.when(priced, F.when(above, rate).otherwise(0.0)),
            "discount_percentage": F.when(priced, F.when(above, 0.0).otherwise(rounded((1 - F.try_divide(rate, listed)) * 100, 6))),
            "discount_amount": F.when(priced & ~above, rounded(listed - rate, 6)),
        }
    )


def order_line_changes(t: Tables, changes: DataFrame) -> DataFrame:
    """A change list (docname, parent, item_code, production_year, qty, rate) applied to the order lines.

    ``outcome`` is kept, unchanged, changed, added or rejected (with the reason).  Rejected lines stay as they were.
    """
    given = changes.select(
        F.col("docname").alias("name"), F.col("qty").alias("_qty"), F.col("rate").alias("_rate"), F.col("production_year").alias("_year")
    ).filter("name IS NOT NULL")
    lines = t.sales_order_item.join(given, "name", "left")
    qty, rate = F.col("_qty"), rounded(F.col("_rate"), 2)
    given_row = qty.isNotNull()
    same = (qty == F.col("qty")) & (F.col("_rate") == F.col("rate"))
    amount = rounded(rate * qty.cast("double"), 2)
    reject = F.when(given_row & ~same, _reject_reason(qty, F.col("delivered_qty"), F.col("billed_amt").cast("double"), rate, amount))
    changed = given_row & ~same & reject.isNull()
    outcome = F.when(~given_row, "kept").when(same, "unchanged").when(reject.isNotNull(), "rejected").otherwise("changed")
    columns = ("parent", "name", "item_code", "production_year", "qty", "rate", "price_list_rate", "outcome", "reason")
    existing = lines.withColumns({"outcome": outcome, "reason": reject, "_changed": changed}).withColumns(
        {
            "qty": F.when(F.col("_changed"), qty).otherwise(F.col("qty")),
            "rate": F.when(F.col("_changed"), rate).otherwise(F.col("rate")),
            "production_year": F.when(F.col("_changed") & (F.coalesce("_year", F.lit("")) != ""), F.col("_year")).otherwise(
                F.col("production_year")
            ),
        }
    )
    new = changes.filter("docname IS NULL")
    reason = F.when(F.coalesce("qty", F.lit(0)) == 0, "quantity is zero")
    added = new.select(
        "parent", F.lit(None).cast("string").alias("name"), "item_code", "production_year", "qty", rounded(F.col("rate"), 2).alias("rate"),
        F.lit(None).cast("double").alias("price_list_rate"), F.when(reason.isNull(), "added").otherwise("rejected").alias("outcome"),
        reason.alias("reason"),
    )
    return line_margin_discount(existing.select(*columns).unionByName(added))


_LINE_VALUES = ("item_code", "production_year", "brand", "qty", "rate", "uom", "conversion_factor", "due_date")
# Kinds of rows, in the order in which they come for one line: of the order, of its list for a line by name, of its list without a line.
_OLD, _NAMED, _UNNAMED = 0, 1, 2


def order_line_difference(lines: DataFrame, listed: DataFrame, conversions: DataFrame, done: str, due: str, places: int = 2) -> DataFrame:
    """The full difference between order lines and the lists that shall replace them.

    A list names all lines an order shall have; orders without a list do not occur. ``outcome`` is same, changed, new, removed or
    rejected (with the reason), and ``applied`` is 0 for all rows of an order with a rejected line, as it stays as it was. ``done``
    is the column of the quantity already delivered or received, ``due`` that of the date, in ``lines`` and in ``listed``.

    A listed line is the same if quantity, rate, unit and factor are, and if both dates are there and equal. Rates and factors are
    rounded to ``places``. A changed unit takes its factor from the list, else from ``conversions`` (parent: the item), else 1; a
    factor of the stock unit is 1 unless the list names a unit. Blank brands and years change nothing. Listed rows without an item
    change nothing and keep their line; of several rows for one line the last by ``idx`` counts, then the greatest. Rows of a line
    the order does not have are rejected, and so are new rows without an order.
    """
    def blank(column: Column) -> Column:
        return F.coalesce(column, F.lit("")) == ""

    listed = listed.withColumnRenamed(due, "due_date").withColumn("docname", F.nullif(F.col("docname"), F.lit("")))
    old_columns = [F.col(due if c == "due_date" else c).alias(c) for c in ("parent", "name", *_LINE_VALUES, "price_list_rate", "stock_uom")]
    old = lines.filter("parent IS NOT NULL AND name IS NOT NULL").select(
        *old_columns, or_zero(done).alias("_done"), or_zero("billed_amt").cast("double").alias("_billed"), F.lit(_OLD).alias("_kind")
    )
    values = F.struct(F.coalesce("idx", F.lit(0)).alias("_at"), *_LINE_VALUES).alias("_g")
    named = F.col("docname").isNotNull()
    given = listed.filter(~named | F.col("parent").isNotNull()).select(
        "parent", F.col("docname").alias("name"), values, F.when(named, _NAMED).otherwise(_UNNAMED).alias("_kind")
    )
    # Old and listed lines travel once, by order; all that follows looks at one order or one line of it.
    by_line = Window.partitionBy("parent", "name")
    kind = F.col("_kind")
    rows = old.unionByName(given, allowMissingColumns=True).repartition("parent")
    rows = rows.withColumn("_at", F.row_number().over(by_line.orderBy("_kind"))).withColumn("_last", F.max(F.when(kind == _NAMED, F.col("_g"))).over(by_line))
    rows = rows.withColumn("_in_list", F.max(kind != _OLD).over(Window.partitionBy("parent")))
    rows = rows.withColumns({"_new": kind == _UNNAMED, "g": F.when(kind == _UNNAMED, F.col("_g")).otherwise(F.col("_last"))})
    # Rows of one line the order does not have are one; of rows without a line those with an item are new lines.
    rows = rows.filter(
        (F.col("_in_list") & (kind == _OLD)) | (~blank(F.col("g.item_code")) & (F.col("_new") | ((kind == _NAMED) & (F.col("_at") == 1))))
    ).withColumns({
        "_found": kind != _NAMED, "_listed": F.col("g").isNotNull(), "_kept": (kind == _OLD) & F.col("g").isNotNull() & blank(F.col("g.item_code")),
        "_done": or_zero("_done"), "_billed": or_zero("_billed"), "item_code": F.when(F.col("_new"), F.col("g.item_code")).otherwise(F.col("item_code")),
    }).drop("_kind", "_g", "_last", "_at", "_in_list")

    qty, rate = or_zero("g.qty"), rounded(or_zero("g.rate"), places)
    own = F.nullif(rounded(F.col("g.conversion_factor"), places), F.lit(0.0))
    factor = (
        F.when(~blank(F.col("g.uom")), own)
        .when(or_zero("g.conversion_factor") == 0, F.when(F.col("_new"), F.lit(1.0)).otherwise(F.col("conversion_factor")))
        .otherwise(F.when(F.col("_found") & ~F.col("_new") & F.col("stock_uom").eqNullSafe(F.col("uom")), F.lit(1.0)).otherwise(F.coalesce(own, F.lit(0.0))))
    )
    same = (
        (qty == or_zero("qty")) & (or_zero("g.rate") == or_zero("rate")) & (or_zero("g.conversion_factor") == or_zero("conversion_factor"))
        & F.col("g.uom").eqNullSafe(F.col("uom")) & F.coalesce(F.col("g.due_date") == F.col("due_date"), F.lit(False))
    )
    removed = ~F.col("_listed")
    same = F.col("_found") & F.col("_listed") & (F.col("_kept") | (~F.col("_new") & same))
    word = done.removesuffix("_qty")
    reason = (
        F.when(F.col("parent").isNull(), "no order")
        .when(~F.col("_found"), "no such line")
        .when(removed, F.when(F.col("_done") > 0, f"already {word}").when(F.col("_billed") != 0, "already billed"))
        .when(~same, F.coalesce(
            F.when(qty == 0, "quantity is zero"), F.when(qty < F.col("_done"), f"below {word} quantity"),
            F.when((rounded(F.col("_billed"), places) > rounded(rate * qty.cast("double"), places)) & (rate > 0), "below billed amount"),
        ))
    )
    rows = rows.withColumns({"reason": reason, "_same": same, "_qty": qty, "_rate": rate, "_cf": factor})
    outcome = (
        F.when(F.col("reason").isNotNull(), "rejected").when(~F.col("_listed"), "removed").when(F.col("_same"), "same")
        .when(F.col("_new"), "new").otherwise("changed")
    )
    rows = rows.withColumn("outcome", outcome)
    # An order is a document: its lines fit a task.
    refused = F.max((F.col("outcome") == "rejected").cast("int")).over(Window.partitionBy("parent"))
    takes = F.col("_new") | ~F.col("_found") | (F.col("outcome") == "changed")

    def after(c: str, value: Column) -> Column:
        return F.when(takes, value).otherwise(F.col(c)).alias(c)

    def filled(c: str) -> Column:
        return F.when(blank(F.col(f"g.{c}")), F.col(c)).otherwise(F.col(f"g.{c}"))

    # Known only now which rows need a factor of their item: a changed unit without one in the list.
    needs = takes & ~blank(F.col("g.uom")) & own.isNull()
    rows = rows.withColumns({"applied": 1 - refused, "_needs": F.coalesce(needs, F.lit(False))})
    factors = conversions.groupBy(F.col("parent").alias("_item"), F.col("uom").alias("_uom")).agg(F.max("conversion_factor").alias("_factor"))
    converted = rows.filter("_needs").join(factors, (F.col("item_code") == F.col("_item")) & (F.col("g.uom") == F.col("_uom")), "left")

    def differences(of: DataFrame, cf: Column) -> DataFrame:
        return of.select(
            "parent", "name", after("item_code", F.coalesce("item_code", "g.item_code")), after("production_year", filled("production_year")),
            after("brand", filled("brand")), after("qty", F.col("_qty")), after("rate", F.col("_rate")), "price_list_rate",
            after("uom", filled("uom")), after("conversion_factor", cf), after("due_date", F.coalesce("g.due_date", "due_date")),
            "outcome", "reason", "applied",
        )

    rows = differences(rows.filter("NOT _needs"), F.col("_cf")).unionByName(differences(converted, F.coalesce("_cf", "_factor", F.lit(1.0))))
    return line_margin_discount(rows.withColumn("stock_qty", rounded(F.col("qty").cast("double") * F.col("conversion_factor"), 6)))


def sales_line_difference(t: Tables, listed: DataFrame) -> DataFrame:
    """Sales order lines against the lists that shall replace them."""
    return order_line_difference(t.sales_order_item, listed, t.uom_conversion_detail, "delivered_qty", "delivery_date")


def purchase_line_difference(t: Tables, listed: DataFrame) -> DataFrame:
    """Purchase order lines against the lists that shall replace them."""
    return order_line_difference(t.purchase_order_item, listed, t.uom_conversion_detail, "received_qty", "schedule_date")


def _reject_reason(qty: Column, delivered: Column, billed: Column, rate: Column, amount: Column) -> Column:
    return (
        F.when(qty == 0, "quantity is zero")
        .when(qty < delivered, "below delivered quantity")
        .when((rounded(billed, 2) > amount) & (rate > 0), "below billed amount")
    )


def adjustment_lines(t: Tables) -> DataFrame:
    """Submitted adjustment requests as order and delivery lines (increases) and return lines (decreases)."""
    requests = submitted(t.sales_adjustment_request).select(F.col("name").alias("request"), F.col("sales_invoice").alias("_invoice"))
    headers = requests.join(
        t.sales_invoice.select(
            F.col("name").alias("_invoice"), "customer", "company", "currency", "set_warehouse", "selling_price_list"
        ),
        "_invoice",
    ).withColumnRenamed("_invoice", "sales_invoice")

    def lines(details: DataFrame, kinds: list[str], sign: int) -> DataFrame:
        rows = details.withColumnRenamed("parent", "request").join(headers, "request")
        return rows.withColumn("qty", (F.col("qty") * sign).cast("double")).withColumn(
            "document", F.explode(F.array(*(F.lit(k) for k in kinds)))
        )

    columns = ("request", "document", "sales_invoice", "customer", "company", "currency", "set_warehouse", "selling_price_list",
               "idx", "item_code", "production_year", "qty", "rate")
    return (
        lines(t.sales_adjustment_increase, ["Sales Order", "Delivery Note"], 1)
        .unionByName(lines(t.sales_adjustment_decrease, ["Sales Invoice"], -1))
        .select(*columns)
    )


def empty_adjustments(t: Tables) -> DataFrame:
    """Adjustment requests without any line, which may not be submitted."""
    requests = t.sales_adjustment_request.withColumnRenamed("name", "parent")
    for details in (t.sales_adjustment_increase, t.sales_adjustment_decrease):
        requests = requests.join(details.select("parent"), "parent", "left_anti")
    return requests.select(F.col("parent").alias("request"), "sales_invoice", "docstatus")


def receipt_list(t: Tables) -> DataFrame:
    """Receipts that are not cancelled: drafts first, then the latest; only submitted ones show a date."""
    rows = not_cancelled(t.purchase_receipt).orderBy("docstatus", F.desc("posting_date"))
    done = F.col("docstatus") == 1
    return rows.select(
        F.col("name").alias("purchase_receipt"), F.col("title").alias("shipment_name"), "virtual_receipt",
        F.col("total_qty").cast("double").alias("total_qty"), "currency", F.col("grand_total").cast("double").alias("grand_total"),
        F.col("base_grand_total").cast("double").alias("base_grand_total"), F.when(done, F.col("posting_date")).alias("posting_date"),
        F.when(done, 1).otherwise(0).alias("actual_receipt"),
    )


def stock_entry_totals(t: Tables) -> DataFrame:
    """Total quantity of each stock entry."""
    sums = t.stock_entry_detail.groupBy(F.col("parent").alias("name")).agg(F.sum("qty").alias("_qty"))
    return t.stock_entry.join(sums, "name", "left").withColumn("total_qty", or_zero("_qty").cast("double")).drop("_qty")


def stock_entry_lines(t: Tables) -> DataFrame:
    """Stock entry lines with the expense account of the header where it has one."""
    headers = t.stock_entry.select(F.col("name").alias("parent"), F.col("expense_account").alias("_account"))
    account = F.when(F.coalesce("_account", F.lit("")) != "", F.col("_account")).otherwise(F.col("expense_account"))
    return t.stock_entry_detail.join(headers, "parent", "left").withColumn("expense_account", account).drop("_account")
