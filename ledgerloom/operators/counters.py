"""Counters of the start pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import not_cancelled
from ledgerloom.sources.tables import Tables

# Which columns besides the document state tell the counted groups apart, per document.
FACETS = {
    "sales_order": ("delivery_status", "billing_status", "reservation_status"),
    "sales_invoice": ("is_return",),
    "delivery_note": ("billing_status",),
    "stock_entry": ("stock_entry_type",),
    "purchase_receipt": ("virtual_receipt",),
    "receipt_voucher": (),
    "payment_voucher": (),
    "transfer_voucher": (),
    "clearing_voucher": (),
    "debt_voucher": (),
    "sales_adjustment_request": (),
}


def document_counters(t: Tables) -> DataFrame:
    """How many documents there are per state and status; one grouping per document table."""

    def counted(name: str, facets: tuple[str, ...]) -> DataFrame:
        group = F.concat_ws("; ", *(F.concat(F.lit(f"{f}="), F.coalesce(F.col(f).cast("string"), F.lit("-"))) for f in facets))
        facet: Column = group if facets else F.lit("")
        return getattr(t, name).groupBy(F.lit(name).alias("document"), "docstatus", facet.alias("facet")).agg(F.count("*").alias("n"))

    return reduce(DataFrame.unionByName, [counted(n, f) for n, f in FACETS.items()])


def master_counters(t: Tables) -> DataFrame:
    """How many accounts that everybody may see, and how many customers, are enabled or disabled."""
    state = F.when(F.coalesce("disabled", F.lit(0)) == 1, "disabled").otherwise("enabled").alias("state")
    accounts = t.account.filter("is_group = 0 AND restrict_account_view = 'No'")
    return (
        accounts.groupBy(F.lit("account").alias("document"), state).agg(F.count("*").alias("n"))
        .unionByName(t.customer_master.groupBy(F.lit("customer").alias("document"), state).agg(F.count("*").alias("n")))
    )


def receipts_by_year(t: Tables) -> DataFrame:
    """Number, quantity and amount of receipts per year, submitted ones and expected ones."""
    qty = not_cancelled(t.purchase_receipt_item).groupBy(F.col("parent").alias("name")).agg(F.sum("qty").alias("_qty"))
    rows = not_cancelled(t.purchase_receipt).filter("is_return = 0").join(qty, "name", "left")
    state = F.when(F.col("docstatus") == 1, "submitted").otherwise("future")
    return rows.groupBy(F.year("posting_date").alias("year"), state.alias("state")).agg(
        F.count("*").alias("receipts"), F.coalesce(F.sum("_qty"), F.lit(0)).cast("double").alias("qty"),
        F.sum("base_grand_total").cast("double").alias("amount"),
    )
