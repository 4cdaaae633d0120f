"""Customer balances, unbilled orders, limits and overdue amounts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import or_zero
from ledgerloom.functions.predicates import live, open_orders, submitted, up_to
from ledgerloom.sources.tables import Tables

# Warning thresholds and the colours of the customer indicator.
EARLY_WARNING = Decimal("0.85")
RED, ORANGE, GREEN = "#FF0000", "#FFA500", "#008000"


def party_balance(t: Tables, as_of: str | None = None) -> DataFrame:
    rows = up_to(live(t.gl_entry).filter("party_type = 'Customer'"), as_of)
    return rows.groupBy(F.col("party").alias("customer")).agg((F.sum("debit") - F.sum("credit")).alias("balance"))


def unbilled_orders(t: Tables, as_of: str | None = None) -> DataFrame:
    """What open orders will still be billed for, scaled by the order's discount and taxes.

    Lines are summed per order before the join, so the join moves one row per order.
    """
    pending = F.col("amount") - F.col("billed_amt")
    lines = (
        submitted(t.sales_order_item).filter(pending > 0)
        .groupBy(F.col("parent").alias("name"))
        .agg(F.sum(pending).alias("_pending"))
    )
    orders = open_orders(t.sales_order, as_of).select("name", "customer", "grand_total", "total")
    share = F.try_divide(F.col("_pending").cast("decimal(24,4)") * F.col("grand_total"), F.col("total"))
    return lines.join(orders, "name").groupBy("customer").agg(F.sum(share).alias("unbilled"))


def credit_limit(t: Tables) -> DataFrame:
    return (
        t.customer_credit_limit.filter("parenttype = 'Customer'")
        .groupBy(F.col("parent").alias("customer"))
        .agg(F.sum("credit_limit").alias("credit_limit"))
    )


def customer_terms(t: Tables) -> DataFrame:
    """Customers with the longest credit period of their payment terms (0 without terms)."""
    days = t.payment_terms_detail.groupBy(F.col("parent").alias("payment_terms")).agg(F.max("credit_days").alias("_days"))
    return t.customer_master.join(days, "payment_terms", "left").withColumn("credit_days", or_zero("_days")).drop("_days")


def _open_invoices(t: Tables) -> DataFrame:
    """Unpaid amounts by customer, due-relevant date and credit period, summed before the join."""
    by_day = (
        submitted(t.sales_invoice).filter("is_return = 0 AND outstanding_amount > 0")
        .groupBy("customer", "posting_date")
        .agg(F.sum("outstanding_amount").alias("outstanding"))
    )
    terms = customer_terms(t).select(F.col("name").alias("customer"), "credit_days")
    # An invoice of an unknown customer has no credit period and, as a NULL comparison, is never due.
    return by_day.join(terms, "customer")


def _due(days: Column) -> Column:
    return F.date_add("posting_date", days.cast("int"))


def receivable_ageing(t: Tables, as_of: str) -> DataFrame:
    """Overdue and soon overdue amounts per customer in one pass over the invoices."""
    today = F.lit(as_of).cast("date")
    days = F.col("credit_days")
    late = today >= _due(days)
    soon = ~late & (today >= _due(F.floor(days * F.lit(EARLY_WARNING))))
    amount = F.col("outstanding")
    return _open_invoices(t).groupBy("customer").agg(
        F.sum(F.when(late, amount)).alias("overdue"), F.sum(F.when(soon, amount)).alias("potential_overdue")
    )


def overdue(t: Tables, as_of: str) -> DataFrame:
    return receivable_ageing(t, as_of).select("customer", "overdue").filter("overdue IS NOT NULL")


def potential_overdue(t: Tables, as_of: str) -> DataFrame:
    return receivable_ageing(t, as_of).select("customer", "potential_overdue").filter("potential_overdue IS NOT NULL")


def customer_credit_status(t: Tables, as_of: str) -> DataFrame:
    """Balance, limit, unbilled and overdue amounts and the indicator colour of every customer."""
    customers = t.customer_master.select(F.col("name").alias("customer"))
    parts = (
        customers.join(party_balance(t), "customer", "left")
        .join(receivable_ageing(t, as_of), "customer", "left")
        .join(credit_limit(t), "customer", "left")
        .join(unbilled_orders(t), "customer", "left")
    )
    parts = parts.withColumns({c: or_zero(c) for c in ("balance", "overdue", "potential_overdue", "credit_limit", "unbilled")})
    exposure, limit = F.col("balance") + F.col("unbilled"), F.col("credit_limit")
    limited = limit > 0
    colour = (
        F.when((limited & (exposure > limit)) | (F.col("overdue") > 0), RED)
        .when((limited & (exposure > limit * F.lit(EARLY_WARNING))) | (F.col("potential_overdue") > 0), ORANGE)
        .otherwise(GREEN)
    )
    return parts.withColumn("indicator", colour)


def overdue_blocks(t: Tables, as_of: str) -> DataFrame:
    """Customers who may not order: no payment terms, or unpaid invoices older than the terms without a bypass.

    Unlike ``overdue`` the age is strict and returns count against the debt.
    """
    terms = customer_terms(t).select(
        F.col("name").alias("customer"), "payment_terms", "credit_days", "bypass_overdue_check"
    )
    has_terms = F.col("payment_terms").isNotNull() & (F.col("payment_terms") != "")
    by_day = (
        submitted(t.sales_invoice).groupBy("customer", "posting_date").agg(F.sum("outstanding_amount").alias("_amount"))
    )
    owed = (
        by_day.join(terms.filter(has_terms).select("customer", "credit_days"), "customer")
        .filter(F.col("posting_date") < F.date_sub(F.lit(as_of).cast("date"), F.col("credit_days").cast("int")))
        .groupBy("customer")
        .agg(F.sum("_amount").alias("outstanding"))
    )
    checked = terms.join(owed, "customer", "left")
    reason = F.when(~has_terms | F.col("payment_terms").isNull(), "no terms").when(
        (F.col("outstanding") > 0) & (F.coalesce("bypass_overdue_check", F.lit(0)) != 1), "overdue"
    )
    return checked.withColumn("reason", reason).filter("reason IS NOT NULL").select("customer", "reason", "outstanding")
