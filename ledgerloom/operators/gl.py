"""General-ledger blocks: voucher names, openings, period rows and running balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.predicates import live, submitted, within
from ledgerloom.operators.running import running_total
from ledgerloom.sources.tables import Tables

# Labels of the statements.
OPENING = "Opening"
TOTAL_LABEL = "الإجمالي"
OPENING_REMARK = ("رصيد إفتتاحي - عميل (", ")")
OPENING_ROW, PERIOD_ROW, TOTAL_ROW = 0, 1, 2
# Stand for "before every date" and "after every date", since opening and total rows have no date of their own.
_BEFORE_ALL, _AFTER_ALL = "0001-01-01", "9999-12-31"


def custom_voucher_map(t: Tables, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
    """Which user-facing voucher a submitted payment or journal entry was made for."""

    def mapped(df: DataFrame, kind: str) -> DataFrame:
        df = submitted(df).filter("custom_voucher_type IS NOT NULL")
        if from_date is not None:
            df = within(df, from_date, to_date)
        return df.select(
            F.lit(kind).alias("voucher_type"), F.col("name").alias("voucher_no"), "custom_voucher_type", "custom_voucher_no"
        )

    return mapped(t.payment_entry, "Payment Entry").unionByName(mapped(t.journal_entry, "Journal Entry"))


def system_journals(t: Tables) -> DataFrame:
    return submitted(t.journal_entry).filter("is_system_generated = 1").select(F.col("name").alias("voucher_no"))


def exclude_system_je(gl: DataFrame, t: Tables) -> DataFrame:
    """Ledger rows that do not come from a system-generated journal."""
    return gl.join(system_journals(t), "voucher_no", "left_anti")


def with_custom_vouchers(gl: DataFrame, t: Tables, from_date: str, to_date: str) -> DataFrame:
    """Period rows without system journals, under the voucher type and number the user knows.

    The journals to drop and the vouchers to rename are both looked up by voucher number, so they are
    gathered into one row per number first and the ledger is shuffled once instead of twice.
    """
    vouchers = custom_voucher_map(t, from_date, to_date).withColumn("_system", F.lit(0))
    journals = system_journals(t).select(
        F.lit(None).cast("string").alias("voucher_type"), "voucher_no",
        F.lit(None).cast("string").alias("custom_voucher_type"), F.lit(None).cast("string").alias("custom_voucher_no"),
        F.lit(1).alias("_system"),
    )
    by_number = vouchers.unionByName(journals).groupBy("voucher_no").agg(
        F.max("_system").alias("_system"),
        *(
            F.max(F.when(F.col("voucher_type") == kind, F.struct("custom_voucher_type", "custom_voucher_no"))).alias(alias)
            for kind, alias in (("Payment Entry", "_payment"), ("Journal Entry", "_journal"))
        ),
    )
    named = gl.join(by_number, "voucher_no", "left").filter(F.coalesce("_system", F.lit(0)) != 1)
    custom = F.when(F.col("voucher_type") == "Payment Entry", F.col("_payment")).when(
        F.col("voucher_type") == "Journal Entry", F.col("_journal")
    )
    return named.withColumns(
        {
            "voucher_type": F.coalesce(custom["custom_voucher_type"], "voucher_type"),
            "voucher_no": F.coalesce(custom["custom_voucher_no"], "voucher_no"),
        }
    ).drop("_system", "_payment", "_journal")


def _is_opening(from_date: str) -> Column:
    before = (F.col("is_opening") == "No") & (F.col("posting_date") < F.lit(from_date).cast("date"))
    return before | (F.col("is_opening") == "Yes")


def opening_balance(gl: DataFrame, keys: list[str], from_date: str, key_list: DataFrame | None = None) -> DataFrame:
    """Debit and credit before the period, and opening rows of any date; zero for listed keys without rows."""
    rows = live(gl).filter(_is_opening(from_date)).select(*keys, "debit", "credit")
    if key_list is not None:
        nothing = key_list.select(*keys, *(F.lit(0).cast(rows.schema[c].dataType).alias(c) for c in ("debit", "credit")))
        rows = rows.unionByName(nothing)
    return rows.groupBy(*keys).agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))


def period_transactions(gl: DataFrame, t: Tables, keys: list[str], from_date: str, to_date: str, by_remarks: bool = True) -> DataFrame:
    """Sums per user-facing voucher and day (and remark) within the period."""
    rows = within(live(gl).filter("is_opening = 'No'"), from_date, to_date)
    rows = with_custom_vouchers(rows, t, from_date, to_date)
    group = [*keys, "posting_date", "voucher_type", "voucher_no"]
    sums = [F.sum("debit").alias("debit"), F.sum("credit").alias("credit")]
    if by_remarks:
        return rows.groupBy(*group, "remarks").agg(*sums)
    return rows.groupBy(*group).agg(*sums, F.min("remarks").alias("remarks"))


def translate_voucher_type(df: DataFrame, t: Tables, language: str = "ar") -> DataFrame:
    words = (
        t.translation.filter(F.col("language") == language)
        .groupBy(F.col("source_text").alias("voucher_type"))
        .agg(F.min("translated_text").alias("_text"))
    )
    return (
        df.join(words, "voucher_type", "left")
        .withColumn("translated_voucher_type", F.coalesce("_text", "voucher_type"))
        .drop("_text")
    )


def key_balances(
    ledger: DataFrame, keys: list[str], from_date: str, to_date: str, key_list: DataFrame, own: Column | None = None
) -> DataFrame:
    """Opening debit and credit and the closing balance of every key in one pass; see ``opening_balance``.

    ``own`` narrows the opening, not the closing balance, to some of the rows.
    """
    opening = _is_opening(from_date) if own is None else own & _is_opening(from_date)
    closing = F.col("posting_date") <= F.lit(to_date).cast("date")
    debit, credit = F.col("debit"), F.col("credit")
    rows = live(ledger).filter(opening | closing).select(
        *keys, F.when(opening, debit).alias("debit"), F.when(opening, credit).alias("credit"),
        F.when(closing, debit - credit).alias("closing"),
    )
    nothing = key_list.select(*keys, *(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name not in keys))
    sums = {c: F.sum(c) for c in ("debit", "credit", "closing")}
    return rows.unionByName(nothing).groupBy(*keys).agg(
        *(F.coalesce(sums[c], F.lit(0)).alias(c) for c in ("debit", "credit")), sums["closing"].alias("closing")
    )


def statement_lines(
    balances: DataFrame, period: DataFrame, keys: list[str], totals: bool = True
) -> DataFrame:
    """Opening, period and total rows of every key, with the balance after each.

    The opening row comes before every date and the total row after it, so that one running pass gives the
    balances and, at the total row, the sums of the period (NULL without period rows).  The total's balance is
    the closing balance of the ledger, found independently.
    """
    amount = "decimal(38,6)"
    no_date, no_text = F.lit(None).cast("date"), F.lit(None).cast("string")

    def mark(kind: int, day: str, label: Column, debit: Column, credit: Column, closing: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("row_kind"), F.lit(day).cast("date").alias("_day"), no_date.alias("posting_date"),
            label.alias("voucher_type"), no_text.alias("voucher_no"), debit.cast(amount).alias("debit"),
            credit.cast(amount).alias("credit"), no_text.alias("remarks"), closing.cast(amount).alias("closing"),
        )

    nothing = F.lit(None)
    marks = [mark(OPENING_ROW, _BEFORE_ALL, F.lit(OPENING), F.col("debit"), F.col("credit"), nothing)]
    if totals:
        marks.append(mark(TOTAL_ROW, _AFTER_ALL, no_text, F.lit(0), F.lit(0), F.col("closing")))
    movements = period.select(
        *keys, F.lit(PERIOD_ROW).alias("row_kind"), F.col("posting_date").alias("_day"), "posting_date", "voucher_type", "voucher_no",
        F.col("debit").cast(amount).alias("debit"), F.col("credit").cast(amount).alias("credit"), "remarks",
        nothing.cast(amount).alias("closing"),
    )
    rows = balances.select(*keys, F.inline(F.array(*marks))).unionByName(movements)
    moved, total = F.col("row_kind") == PERIOD_ROW, F.col("row_kind") == TOTAL_ROW
    zero = F.lit(0).cast(amount)
    rows = rows.withColumns(
        {
            "_move": F.col("debit") - F.col("credit"), "_debit": F.when(moved, F.col("debit")).otherwise(zero),
            "_credit": F.when(moved, F.col("credit")).otherwise(zero), "_n": moved.cast("long"),
        }
    )
    sums = {"_move": "_balance", "_debit": "_period_debit", "_credit": "_period_credit", "_n": "_rows"}
    summed = running_total(rows, keys, "_day", ["voucher_no", "remarks"], sums if totals else {"_move": "_balance"})
    shown = {"balance": F.col("_balance")}
    if totals:
        any_row = F.col("_rows") > 0
        shown = {
            "balance": F.when(total, F.col("closing")).otherwise(F.col("_balance")),
            "debit": F.when(total, F.when(any_row, F.col("_period_debit"))).otherwise(F.col("debit")),
            "credit": F.when(total, F.when(any_row, F.col("_period_credit"))).otherwise(F.col("credit")),
        }
    columns = [*keys, "row_kind", "posting_date", "voucher_type", "voucher_no", "debit", "credit", "balance", "remarks"]
    return summed.withColumns(shown).select(*columns)


def statement_total(
    period: DataFrame, ledger: DataFrame, keys: list[str], to_date: str, key_list: DataFrame | None = None
) -> DataFrame:
    """Per key the period sums and, independently, the balance of all live rows up to ``to_date``.

    Sums over no rows stay NULL.  ``ledger`` may be wider than the period rows (system journals count here).
    """
    empty = F.lit(None).cast("decimal(38,6)")
    last = F.lit(to_date).cast("date")
    closing = live(ledger).filter(F.col("posting_date") <= last).select(
        *keys, empty.alias("debit"), empty.alias("credit"), (F.col("debit") - F.col("credit")).cast("decimal(38,6)").alias("balance")
    )
    parts = period.select(
        *keys, F.col("debit").cast("decimal(38,6)").alias("debit"), F.col("credit").cast("decimal(38,6)").alias("credit"),
        empty.alias("balance"),
    ).unionByName(closing)
    if key_list is not None:
        parts = parts.unionByName(key_list.select(*keys, empty.alias("debit"), empty.alias("credit"), empty.alias("balance")))
    return parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("debit", "credit", "balance")))


def against_party(t: Tables) -> DataFrame:
    """The counter party shown beside a cash movement, by voucher."""

    def named(df: DataFrame, kind: str, against: Column) -> DataFrame:
        return submitted(df).select(F.lit(kind).alias("voucher_type"), F.col("name").alias("voucher_no"), against.alias("against"))

    has_party = F.col("party_type").isNotNull() & (F.col("party_type") != "")
    return (
        named(t.transfer_voucher, "Transfer Voucher", F.col("paid_to"))
        .unionByName(named(t.payment_voucher, "Payment Voucher", F.when(has_party, F.col("party_name")).otherwise(F.col("paid_to"))))
        .unionByName(named(t.receipt_voucher, "Receipt Voucher", F.when(has_party, F.col("party_name")).otherwise(F.col("paid_from"))))
        .unionByName(named(t.sales_invoice.filter("is_paid = 1"), "Sales Invoice", F.col("customer_name")))
    )


def invoice_order_link(t: Tables, from_date: str | None = None, to_date: str | None = None) -> DataFrame:
    """The sales order an invoice was made from (the first by name where there are several)."""
    invoices = submitted(t.sales_invoice).filter("is_return = 0")
    if from_date is not None:
        invoices = within(invoices, from_date, to_date)
    return (
        submitted(t.sales_invoice_item)
        .filter("qty > 0 AND sales_order IS NOT NULL AND sales_order <> ''")
        .groupBy(F.col("parent").alias("sales_invoice"))
        .agg(F.min("sales_order").alias("sales_order"))
        .join(invoices.select(F.col("name").alias("sales_invoice")), "sales_invoice", "left_semi")
    )
