"""Sales quantities and amounts by item or customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import or_zero, percent, percent_text
from ledgerloom.functions.predicates import submitted, within
from ledgerloom.operators.stock import cogs_by_item
from ledgerloom.sources.tables import Tables


def sales_by(t: Tables, key: str, from_date: str, to_date: str) -> DataFrame:
    """Quantity and net amount of submitted invoice lines in the period; ``key`` is item_code or customer."""
    invoices = within(submitted(t.sales_invoice), from_date, to_date).select(F.col("name").alias("parent"), "customer")
    lines = submitted(t.sales_invoice_item).select("parent", "item_code", "qty", "net_amount")
    if key == "customer":
        # One row per invoice travels to the join.
        lines = lines.groupBy("parent").agg(F.sum("qty").alias("qty"), F.sum("net_amount").alias("net_amount"))
    return (
        lines.join(invoices, "parent").groupBy(key).agg(F.sum("qty").alias("qty"), F.sum("net_amount").alias("net_amount"))
    )


def item_markup(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """Markup on cost of each item sold or issued in the period, as a number and as text (NULL without cost)."""
    both = sales_by(t, "item_code", from_date, to_date).join(cogs_by_item(t, from_date, to_date), "item_code", "full")
    value = percent(or_zero("net_amount") - or_zero("cost"), or_zero("cost"))
    return both.select("item_code", value.alias("markup_percent"), percent_text(value).alias("markup"))
