"""Cash vouchers: company-currency amounts, checks and the ledger lines they make."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import or_zero
from ledgerloom.functions.predicates import submitted
from ledgerloom.operators.gl import custom_voucher_map
from ledgerloom.sources.tables import Tables

# The company currency, whose rate is 1, and the voucher names.
COMPANY_CURRENCY = "LYD"
RECEIPT, PAYMENT, TRANSFER = "Receipt Voucher", "Payment Voucher", "Transfer Voucher"
CLEARING, DEBT = "Clearing Voucher", "Debt Voucher"
PAYMENT_ENTRY, JOURNAL_ENTRY = "Payment Entry", "Journal Entry"



def voucher_amounts(t: Tables) -> DataFrame:
    """Both sides of every voucher: amounts, currencies and rates under common names."""

    def side(df: DataFrame, kind: str, paid: tuple[str, str, str], received: tuple[str, str, str]) -> DataFrame:
        names = ("amount", "currency", "rate")
        return df.select(
            F.lit(kind).alias("voucher_type"), F.col("name").alias("voucher_no"),
            *(F.col(c).alias(f"paid_{n}") for c, n in zip(paid, names)),
            *(F.col(c).alias(f"received_{n}") for c, n in zip(received, names)),
        )

    usual = (
        ("paid_amount", "paid_from_account_currency", "source_exchange_rate"),
        ("received_amount", "paid_to_account_currency", "target_exchange_rate"),
    )
    clearing = (
        ("deducted_amount", "from_account_currency", "source_exchange_rate"),
        ("added_amount", "to_account_currency", "target_exchange_rate"),
    )
    return (
        side(t.receipt_voucher, RECEIPT, *usual)
        .unionByName(side(t.payment_voucher, PAYMENT, *usual))
        .unionByName(side(t.transfer_voucher, TRANSFER, *usual))
        .unionByName(side(t.clearing_voucher, CLEARING, *clearing))
    )


def voucher_base_amounts(t: Tables) -> DataFrame:
    """Amounts in company currency; the company currency has rate 1, equal currencies share rate and amount."""
    rows = voucher_amounts(t)
    paid_rate = F.when(F.col("paid_currency") == COMPANY_CURRENCY, F.lit(1)).otherwise(F.col("paid_rate"))
    same = F.col("paid_currency") == F.col("received_currency")
    received_rate = (
        F.when(F.col("received_currency") == COMPANY_CURRENCY, F.lit(1)).when(same, paid_rate).otherwise(F.col("received_rate"))
    )
    received = F.when(same, F.col("paid_amount")).otherwise(F.col("received_amount"))
    return rows.withColumns(
        {"received_amount": received, "paid_rate": paid_rate.cast("decimal(21,9)"), "received_rate": received_rate.cast("decimal(21,9)")}
    ).withColumns(
        {
            "base_paid_amount": F.round(F.col("paid_amount") * F.col("paid_rate"), 3),
            "base_received_amount": F.round(F.col("received_amount") * F.col("received_rate"), 3),
        }
    )


def voucher_balance_violations(t: Tables) -> DataFrame:
    """Vouchers as entered whose two sides differ in company currency."""
    paid = F.round(F.col("paid_amount") * F.col("paid_rate"), 3)
    received = F.round(F.col("received_amount") * F.col("received_rate"), 3)
    rows = voucher_amounts(t).withColumns({"base_paid_amount": paid, "base_received_amount": received})
    return rows.filter(F.coalesce("base_paid_amount", F.lit(0)) != F.coalesce("base_received_amount", F.lit(0))).select(
        "voucher_type", "voucher_no", "base_paid_amount", "base_received_amount"
    )


def _line(document: str | Column, account: Column, rate: Column, debit: Column | None, credit: Column | None,
          party_type: Column | None = None, party: Column | None = None, part: str = "main") -> Column:
    """One ledger line; ``part`` tells a voucher's main entry from the one for its charges."""
    text, money = "string", "decimal(21,3)"

    def value(c: Column | None, kind: str) -> Column:
        return (F.lit(None) if c is None else c).cast(kind)

    return F.struct(
        (F.lit(document) if isinstance(document, str) else document).alias("document"), F.lit(part).alias("part"),
        account.cast(text).alias("account"), value(party_type, text).alias("party_type"), value(party, text).alias("party"),
        rate.cast("decimal(21,9)").alias("exchange_rate"),
        F.coalesce(value(debit, money), F.lit(0).cast(money)).alias("debit"),
        F.coalesce(value(credit, money), F.lit(0).cast(money)).alias("credit"),
    )


def _expand(df: DataFrame, kind: str, lines: list[Column]) -> DataFrame:
    """One row per line of each submitted voucher, lines that do not apply (NULL) left out."""
    return submitted(df).select(
        F.lit(kind).alias("custom_voucher_type"), F.col("name").alias("custom_voucher_no"), "posting_date", "remark",
        F.inline(F.array_compact(F.array(*lines))),
    )


def voucher_ledger_lines(t: Tables) -> DataFrame:
    """The double-entry lines behind the five voucher types, amounts in account currency and positive."""
    col = F.col
    paid, received, charges = F.abs("paid_amount"), F.abs("received_amount"), F.abs("banking_charges")
    source, target = col("source_exchange_rate"), col("target_exchange_rate")
    charged = or_zero("banking_charges") != 0
    party = (col("party_type"), col("party"))

    receipt_doc = F.when(col("receipt_from") == "Customer", PAYMENT_ENTRY).otherwise(JOURNAL_ENTRY)
    receipts = _expand(
        t.receipt_voucher, RECEIPT,
        [
            _line(receipt_doc, col("paid_from"), source, None, paid, *party),
            _line(receipt_doc, col("paid_to"), target, received, None),
            F.when(charged, _line(JOURNAL_ENTRY, col("paid_to"), source, None, charges, part="charges")),
            F.when(charged, _line(JOURNAL_ENTRY, col("paid_from"), target, charges, None, *party, part="charges")),
        ],
    )
    payment_doc = F.when(col("payment_to") == "Supplier", PAYMENT_ENTRY).otherwise(JOURNAL_ENTRY)
    payments = _expand(
        t.payment_voucher, PAYMENT,
        [_line(payment_doc, col("paid_from"), source, None, paid), _line(payment_doc, col("paid_to"), target, received, None, *party)],
    )
    by_sender = or_zero("sender") == 1
    transfers = _expand(
        t.transfer_voucher, TRANSFER,
        [
            _line(PAYMENT_ENTRY, col("paid_from"), source, None, paid),
            _line(PAYMENT_ENTRY, col("paid_to"), target, received, None),
            F.when(charged, _line(
                JOURNAL_ENTRY, F.when(by_sender, col("paid_from")).otherwise(col("paid_to")),
                F.when(by_sender, source).otherwise(target), None, charges, part="charges")),
            F.when(charged, _line(JOURNAL_ENTRY, col("charge_account"), F.lit(1), charges, None, part="charges")),
        ],
    )
    clearings = _expand(
        t.clearing_voucher, CLEARING,
        [
            _line(JOURNAL_ENTRY, col("from_account"), source, None, F.abs("deducted_amount"), col("from_party_type"), col("from_party")),
            _line(JOURNAL_ENTRY, col("to_account"), target, F.abs("added_amount"), None, col("to_party_type"), col("to_party")),
        ],
    )
    accounts = t.company.select(F.col("name").alias("company"), "write_up_account", "write_off_account")
    amount, rate = F.abs("amount"), col("exchange_rate")
    base = F.round(amount * rate, 3)
    add = col("type") == "Add"
    debts = _expand(
        t.debt_voucher.join(accounts, "company", "left"), DEBT,
        [
            F.when(add, _line(JOURNAL_ENTRY, col("write_up_account"), F.lit(1), None, amount)),
            F.when(add, _line(JOURNAL_ENTRY, col("from_or_to_account"), rate, amount, None, *party)),
            F.when(~add, _line(JOURNAL_ENTRY, col("from_or_to_account"), rate, None, amount, *party)),
            F.when(~add, _line(JOURNAL_ENTRY, col("write_off_account"), F.lit(1), base, None)),
        ],
    )
    return reduce(DataFrame.unionByName, [receipts, payments, transfers, clearings, debts])


def unbalanced_vouchers(lines: DataFrame) -> DataFrame:
    """Generated entries whose debit and credit differ in company currency."""
    base = [F.sum(F.round(F.col(c) * F.col("exchange_rate"), 3)).alias(f"base_{c}") for c in ("debit", "credit")]
    sums = lines.groupBy("custom_voucher_type", "custom_voucher_no", "part").agg(*base)
    return sums.filter("base_debit <> base_credit")


def cash_invoice_lines(t: Tables) -> DataFrame:
    """Receipt or refund lines of paid invoices, and write-off lines where another amount was paid.

    An invoice whose paid amount is not below the invoice is rejected as a whole: one row with its ``problem`` and no line.
    """
    company = t.company.select(F.col("name").alias("company"), "write_off_account")
    other = (F.col("custom_payment_value_is_different") == 1) & (or_zero("custom_payment_value") != 0)
    total = F.abs("grand_total")
    rows = submitted(t.sales_invoice).join(company, "company", "left").withColumns(
        {"_other": other, "_amount": F.when(other, F.col("custom_payment_value")).otherwise(total)}
    ).withColumn("_rest", F.when(F.col("_other"), total - F.col("custom_payment_value")))
    amount, rest, rate = F.col("_amount"), F.col("_rest"), F.col("conversion_rate")
    cash, debtor = F.col("payment_account"), F.col("debit_to")
    customer = (F.lit("Customer"), F.col("customer"))
    paid, back = F.col("is_paid") == 1, F.col("is_return") == 1
    sale, refund = paid & ~back, paid & back
    too_much = F.col("_other") & (rest <= 0)
    write_off = F.col("_other") & (rest > 0)
    one = F.lit(1)
    lines = [
        F.when(sale, _line(PAYMENT_ENTRY, cash, rate, amount, None)),
        F.when(sale, _line(PAYMENT_ENTRY, debtor, rate, None, amount, *customer)),
        F.when(refund, _line(JOURNAL_ENTRY, cash, rate, None, amount)),
        F.when(refund, _line(JOURNAL_ENTRY, debtor, rate, amount, None, *customer)),
        F.when(write_off & ~back, _line(JOURNAL_ENTRY, debtor, one, None, rest, *customer, part="write-off")),
        F.when(write_off & ~back, _line(JOURNAL_ENTRY, F.col("write_off_account"), one, rest, None, part="write-off")),
        F.when(write_off & back, _line(JOURNAL_ENTRY, F.col("write_off_account"), one, None, rest, part="write-off")),
        F.when(write_off & back, _line(JOURNAL_ENTRY, debtor, one, rest, None, *customer, part="write-off")),
    ]
    rejected = F.coalesce(too_much, F.lit(False))
    problem = F.when(rejected, "payment is not below the invoice")
    # A rejected invoice has one empty line, so that its row stays.
    empty = F.slice(F.array(F.when(F.lit(False), lines[0])), 1, 1)
    made = F.when(rejected, empty).otherwise(F.array_compact(F.array(*lines)))
    return rows.select(
        F.lit("Sales Invoice").alias("custom_voucher_type"), F.col("name").alias("custom_voucher_no"), "posting_date",
        problem.alias("problem"), F.explode(made).alias("_line"),
    ).select("custom_voucher_type", "custom_voucher_no", "posting_date", "problem", "_line.*")


# The kinds of landed cost, with their column prefix and whether a zero amount still makes a row.
_FOREIGN_COSTS = {"Freight": "freight", "Inspection": "inspection", "Foreign Bank Charges": "foreign_bank_charges"}


def landed_cost_lines(t: Tables) -> DataFrame:
    """Cost rows of each submitted receipt: charges in foreign currency and bank charges only where there are any."""
    none = F.lit(None)

    def cost(kind: str, prefix: str, foreign: bool) -> Column:
        return F.struct(
            F.lit(kind).alias("description"), F.col(f"{prefix}_account").alias("expense_account"),
            (F.col(f"{prefix}_account_currency") if foreign else none).cast("string").alias("account_currency"),
            (F.col(f"{prefix}_exchange_rate") if foreign else none).cast("decimal(21,9)").alias("exchange_rate"),
            F.col(f"{prefix}_amount").cast("decimal(21,3)").alias("amount"),
        )

    optional = [F.when(or_zero(f"{p}_amount") != 0, cost(k, p, True)) for k, p in _FOREIGN_COSTS.items()]
    local = F.when(or_zero("local_bank_charges_amount") != 0, cost("Local Bank Charges", "local_bank_charges", False))
    always = [cost("Clearance", "clearance", False), cost("Transport", "transport", False)]
    costs = F.array_compact(F.array(*optional, local, *always))
    return submitted(t.purchase_receipt).select(
        F.col("name").alias("purchase_receipt"), F.col("title").alias("receipt_title"), F.inline(costs)
    )


def landed_cost_completeness(t: Tables) -> DataFrame:
    """Fields that invoices without stock update still lack: clearance and transport account and amount."""
    accounts = [F.when(F.coalesce(f"{p}_account", F.lit("")) == "", F.lit(f"{p}_account")) for p in ("clearance", "transport")]
    amounts = [F.when(or_zero(f"{p}_amount") == 0, F.lit(f"{p}_amount")) for p in ("clearance", "transport")]
    missing = F.array_compact(F.array(*accounts, *amounts))
    return t.purchase_invoice.filter("update_stock = 0").select(
        F.col("name").alias("purchase_invoice"), F.explode(missing).alias("missing_field")
    )


def clean_incoterm_costs(t: Tables, clear_freight: bool = True) -> DataFrame:
    """Purchase invoices without the charges their terms exclude, missing amounts as zero.

    Under CFR the seller bears freight; inspection is paid only with a letter of credit.  ``clear_freight``
    off leaves freight alone at save, when only the rule on the payment method is live.
    """
    cfr = F.lit(clear_freight) & (F.coalesce("custom_incoterm", F.lit("")) == "CFR")
    no_credit = F.coalesce("payment_method", F.lit("")) != "LC"

    def cleared(prefix: str, when: Column) -> dict[str, Column]:
        text = {f"{prefix}_{c}": F.when(~when, F.col(f"{prefix}_{c}")) for c in ("account", "account_currency")}
        numbers = {f"{prefix}_{c}": F.when(when, F.lit(0)).otherwise(or_zero(f"{prefix}_{c}")) for c in ("amount", "exchange_rate")}
        return text | numbers

    zeros = ("transport_amount", "clearance_amount", "foreign_bank_charges_exchange_rate", "foreign_bank_charges_amount",
             "local_bank_charges_amount")
    return t.purchase_invoice.withColumns(
        cleared("freight", cfr) | cleared("inspection", no_credit) | {c: or_zero(c) for c in zeros}
    )


def remark_propagation(t: Tables) -> DataFrame:
    """Ledger rows with the remark of the voucher that their payment or journal entry was made for."""
    kinds = {RECEIPT: t.receipt_voucher, PAYMENT: t.payment_voucher, TRANSFER: t.transfer_voucher,
             CLEARING: t.clearing_voucher, DEBT: t.debt_voucher}
    remarks = reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(k).alias("custom_voucher_type"), F.col("name").alias("custom_voucher_no"), F.col("remark").alias("_remark"))
            for k, df in kinds.items()
        ],
    )
    linked = custom_voucher_map(t).join(remarks, ["custom_voucher_type", "custom_voucher_no"])
    by_entry = linked.groupBy("voucher_type", "voucher_no").agg(F.min("_remark").alias("_remark"))
    return (
        t.gl_entry.join(by_entry, ["voucher_type", "voucher_no"], "left")
        .withColumn("remarks", F.coalesce("_remark", "remarks"))
        .drop("_remark")
    )
