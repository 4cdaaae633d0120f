"""Customer balances and customer performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import doubles, or_zero, percent, percent_text
from ledgerloom.operators import parties as P
from ledgerloom.operators.sales import sales_by
from ledgerloom.operators.stock import cogs_by_customer
from ledgerloom.sources.tables import Tables

# The choices of the balances report.
ALL = "All Balances"
DEBIT_WITHOUT = "Debit Balances (w/o Orders)"
CREDIT_WITHOUT = "Credit Balances (w/o Orders)"
ZERO_WITHOUT = "Zero Balances (w/o Orders)"
DEBIT_WITH = "Debit Balances (w Orders)"
CREDIT_WITH = "Credit Balances (w Orders)"
ZERO_WITH = "Zero Balances (w Orders)"
OVERDUE = "Overdue Balances"
OVER_CREDIT = "Over-credit Balances"


def _cents(column: str) -> Column:
    return F.round(column, 2)


def _choice(show: str) -> Column:
    without, with_orders, limit = _cents("balance_wo_so"), _cents("balance_w_so"), F.col("credit_limit")
    choices = {
        ALL: F.lit(True),
        DEBIT_WITHOUT: without > 0,
        CREDIT_WITHOUT: without < 0,
        ZERO_WITHOUT: without == 0,
        DEBIT_WITH: with_orders > 0,
        CREDIT_WITH: with_orders < 0,
        ZERO_WITH: with_orders == 0,
        OVERDUE: _cents("overdues") > 0,
        OVER_CREDIT: (limit > 0) & (_cents("credit_limit") < with_orders),
    }
    return choices.get(show, F.lit(False))


def customer_balances(t: Tables, as_of: str, show_balances: str = ALL, today: str | None = None) -> DataFrame:
    """Balance, unbilled orders, limit and overdue amount of each customer.

    Balances are as of ``as_of``; amounts are overdue as of ``today`` (the same date unless given).
    """
    amounts = ("credit_limit", "balance_wo_so", "unbilled_sales_orders", "overdues")
    customers = t.customer_master.select(F.col("name").alias("customer"), "customer_name", "customer_group", "payment_terms")
    report = (
        customers.join(P.party_balance(t, as_of).withColumnRenamed("balance", "balance_wo_so"), "customer", "left")
        .join(P.unbilled_orders(t, as_of).withColumnRenamed("unbilled", "unbilled_sales_orders"), "customer", "left")
        .join(P.credit_limit(t), "customer", "left")
        .join(P.overdue(t, today or as_of).withColumnRenamed("overdue", "overdues"), "customer", "left")
        .withColumns({c: or_zero(c) for c in amounts})
        .withColumn("balance_w_so", F.col("balance_wo_so") + F.col("unbilled_sales_orders"))
        .filter(_choice(show_balances))
        .orderBy(F.desc("balance_w_so"), "customer")
    )
    rounded = {c: F.round(c, 4).cast("double") for c in ("unbilled_sales_orders", "balance_w_so")}
    return doubles(report.withColumns(rounded), "credit_limit", "balance_wo_so", "overdues").select(
        "customer", "customer_name", "customer_group", "payment_terms", "credit_limit", "balance_wo_so",
        "unbilled_sales_orders", "balance_w_so", "overdues",
    )


def customer_performance(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """Sales, cost, margin and balances of customers with any of them."""
    measures = ("sales_qty", "sales_amount", "cogs", "balance_wo_so", "orders_to_bill")
    sales = sales_by(t, "customer", from_date, to_date).select(
        "customer", F.col("qty").alias("sales_qty"), F.col("net_amount").alias("sales_amount")
    )
    report = (
        t.customer_master.select(F.col("name").alias("customer"), "customer_name", "customer_group")
        .join(P.party_balance(t, to_date).withColumnRenamed("balance", "balance_wo_so"), "customer", "left")
        .join(P.unbilled_orders(t, to_date).withColumnRenamed("unbilled", "orders_to_bill"), "customer", "left")
        .join(sales, "customer", "left")
        .join(cogs_by_customer(t, from_date, to_date).withColumnRenamed("cost", "cogs"), "customer", "left")
        .withColumns({c: or_zero(c) for c in measures})
    )
    any_sum = F.abs("sales_qty") + F.abs("sales_amount") + F.abs("cogs") + F.abs("balance_wo_so") + F.col("orders_to_bill")
    report = (
        report.filter(any_sum > 0)
        .withColumn("markup_pct", percent(F.col("sales_amount") - F.col("cogs"), F.col("sales_amount")))
        .withColumn("balance_w_so", F.col("balance_wo_so") + F.col("orders_to_bill"))
        .orderBy(F.desc(F.abs("sales_amount")), F.desc(F.abs("balance_wo_so")))
    )
    rounded = {c: F.round(c, 4).cast("double") for c in ("orders_to_bill", "balance_w_so")}
    return doubles(report.withColumns(rounded), "sales_qty", "sales_amount", "cogs", "balance_wo_so").select(
        "customer", "customer_name", "customer_group", "sales_qty", "sales_amount", "cogs",
        percent_text(F.col("markup_pct")).alias("markup"), "balance_wo_so", "orders_to_bill", "balance_w_so",
    )
