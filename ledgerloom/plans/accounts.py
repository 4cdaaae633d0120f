"""Account balances and the four statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import doubles, or_zero
from ledgerloom.functions.predicates import live, only, up_to, within
from ledgerloom.operators import gl as G
from ledgerloom.operators.running import running_total
from ledgerloom.sources.tables import Tables

_AMOUNTS = ("debit", "credit", "balance")


def account_balances(t: Tables, as_of: str) -> DataFrame:
    """Net balance of each visible account on its own side."""
    net = up_to(live(t.gl_entry), as_of).groupBy(F.col("account").alias("name")).agg(
        (F.sum("debit") - F.sum("credit")).alias("_net")
    )
    accounts = t.account.filter("restrict_account_view = 'No' AND is_group = 0")
    report = accounts.join(net, "name", "left").select(
        "account_number", "account_name", "parent_account",
        F.greatest(or_zero("_net"), F.lit(0)).cast("double").alias("debit"),
        F.greatest(-or_zero("_net"), F.lit(0)).cast("double").alias("credit"),
    )
    return report.orderBy("parent_account", "account_number")


def _lines(
    t: Tables, ledger: DataFrame, keys: list[str], key_list: DataFrame, from_date: str, to_date: str, by_remarks: bool = True,
    own: Column | None = None, totals: bool = True,
) -> DataFrame:
    """Opening, period and total rows of every key; ``own`` narrows all but the closing balance."""
    narrowed = ledger if own is None else ledger.filter(own)
    balances = G.key_balances(ledger, keys, from_date, to_date, key_list, own)
    period = G.period_transactions(narrowed, t, keys, from_date, to_date, by_remarks)
    lines = G.statement_lines(balances, period, keys, totals)
    label = F.when(F.col("row_kind") == G.TOTAL_ROW, F.lit(G.TOTAL_LABEL)).otherwise(F.col("translated_voucher_type"))
    return G.translate_voucher_type(lines, t).withColumn("translated_voucher_type", label)


def _accounts(t: Tables, accounts: list[str] | None) -> DataFrame:
    return only(t.account.filter("is_group = 0"), "name", accounts).select(F.col("name").alias("account"), "account_name")


def account_statement(t: Tables, from_date: str, to_date: str, accounts: list[str] | None = None) -> DataFrame:
    """Opening, movements with running balance and total, for all accounts or the given ones."""
    named = _accounts(t, accounts)
    ledger = only(t.gl_entry, "account", accounts)
    lines = _lines(t, ledger, ["account"], named, from_date, to_date).join(named, "account", "left")
    is_total = F.col("row_kind") == G.TOTAL_ROW
    report = doubles(lines, *_AMOUNTS).select(
        "account", "row_kind", "posting_date", "translated_voucher_type", "voucher_no", *_AMOUNTS, "remarks",
        F.when(~is_total, F.col("account_name")).alias("account_name"), "voucher_type",
    )
    return report.orderBy("account", "row_kind", "posting_date", "voucher_no")


def cash_bank_statement(t: Tables, from_date: str, to_date: str, accounts: list[str] | None = None) -> DataFrame:
    """The account statement of cash and bank accounts with the counter party of each movement."""
    named = _accounts(t, accounts).join(
        t.account.filter(F.col("account_type").isin("Cash", "Bank")).select(F.col("name").alias("account")), "account", "left_semi"
    )
    ledger = t.gl_entry.join(named.select("account"), "account", "left_semi")
    lines = _lines(t, ledger, ["account"], named, from_date, to_date).join(
        G.against_party(t), ["voucher_type", "voucher_no"], "left"
    )
    report = doubles(lines, *_AMOUNTS).select(
        "account", "row_kind", "posting_date", "translated_voucher_type", "voucher_no", *_AMOUNTS, "against", "remarks", "voucher_type"
    )
    return report.orderBy("account", "row_kind", "posting_date", "voucher_no")


def customer_statement(t: Tables, from_date: str, to_date: str, customers: list[str] | None = None) -> DataFrame:
    """The statement of each customer, with the sales order behind each invoice."""
    named = only(t.customer_master, "name", customers).select(F.col("name").alias("customer"), "customer_name")
    by_party = only(t.gl_entry, "party", customers).filter("party IS NOT NULL").withColumnRenamed("party", "customer")
    is_customer = F.col("party_type") == "Customer"
    lines = _lines(t, by_party, ["customer"], named, from_date, to_date, by_remarks=False, own=is_customer)
    links = G.invoice_order_link(t, from_date, to_date).select(
        F.lit("Sales Invoice").alias("voucher_type"), F.col("sales_invoice").alias("voucher_no"), "sales_order"
    )
    lines = lines.join(links, ["voucher_type", "voucher_no"], "left").join(named, "customer", "left")
    kind = F.col("row_kind")
    opening_remark = F.concat(F.lit(G.OPENING_REMARK[0]), "customer_name", F.lit(G.OPENING_REMARK[1]))
    report = doubles(lines, *_AMOUNTS).select(
        "customer", "row_kind", "posting_date", "translated_voucher_type", "voucher_no", "sales_order", *_AMOUNTS,
        F.when(kind == G.OPENING_ROW, opening_remark).otherwise(F.col("remarks")).alias("remarks"),
        F.when(kind != G.TOTAL_ROW, F.col("customer_name")).alias("customer_name"), "voucher_type",
    )
    return report.orderBy("customer", "row_kind", "posting_date", "voucher_no")


def consolidated_statement(t: Tables, pairs: DataFrame, from_date: str, to_date: str) -> DataFrame:
    """Statements over an account and a customer together; ``pairs`` has columns account and customer.

    A ledger row of the customer on that very account counts once: the second branch leaves it out.
    """
    keys = ["pair_account", "pair_customer"]
    pairs = pairs.select(F.col("account").alias("pair_account"), F.col("customer").alias("pair_customer")).distinct()
    by_account = t.gl_entry.join(pairs, F.col("account") == F.col("pair_account"))
    by_customer = t.gl_entry.filter("party_type = 'Customer'").join(
        pairs, (F.col("party") == F.col("pair_customer")) & ~F.col("account").eqNullSafe(F.col("pair_account"))
    )
    lines = _lines(t, by_account.unionByName(by_customer), keys, pairs, from_date, to_date, totals=False)
    accounts = t.account.select(F.col("name").alias("pair_account"), "account_name")
    customers = t.customer_master.select(F.col("name").alias("pair_customer"), "customer_name")
    lines = lines.join(accounts, "pair_account", "left").join(customers, "pair_customer", "left")
    report = doubles(lines, *_AMOUNTS).select(
        *keys, "row_kind", "posting_date", "translated_voucher_type", "voucher_no", *_AMOUNTS, "remarks", "account_name",
        "customer_name", "voucher_type",
    )
    return report.orderBy(*keys, "row_kind", "posting_date", "voucher_no")


_PART = ("part_account", "part_customer")
_LINE = ("row_kind", "posting_date", "voucher_type", "voucher_no", "remarks")


def consolidated_parts(t: Tables, from_date: str, to_date: str) -> DataFrame:
    """What the statement of any account and customer together is made of: the lines of every account, of every customer, and of
    every customer on every account, each with its running balance.

    The lines of a pair are those of its account and of its customer less those they share, and so are its balances. So the lines of all pairs
    take one statement of the ledger, not one of each pair. ``part_customer`` is NULL in lines of an account and ``part_account`` in
    those of a customer. ``n`` is the number of ledger rows in a line. Accounts and customers without rows have an opening; a
    customer on an account has one if it has opening rows.
    """
    account, customer = F.col("account"), F.when(F.col("party_type") == "Customer", F.col("party"))
    nobody = F.lit(None).cast("string")

    def part(a: Column, c: Column) -> Column:
        return F.struct(a.alias(_PART[0]), c.alias(_PART[1]))

    shared = account.isNotNull() & customer.isNotNull()
    memberships = F.array_compact(F.array(
        F.when(account.isNotNull(), part(account, nobody)), F.when(customer.isNotNull(), part(nobody, customer)), F.when(shared, part(account, customer))))

    def in_parts(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.select(*columns, F.inline(memberships))

    everyone = t.account.filter("is_group = 0").select(F.col("name").alias(_PART[0]), nobody.alias(_PART[1])).unionByName(
        t.customer_master.select(nobody.alias(_PART[0]), F.col("name").alias(_PART[1])))
    opening = G.opening_balance(in_parts(t.gl_entry, "debit", "credit", "posting_date", "is_opening", "is_cancelled"), [*_PART], from_date, everyone)
    moved = G.with_custom_vouchers(within(live(t.gl_entry).filter("is_opening = 'No'"), from_date, to_date), t, from_date, to_date)
    period = in_parts(moved, "posting_date", "voucher_type", "voucher_no", "remarks", "debit", "credit").groupBy(
        *_PART, "posting_date", "voucher_type", "voucher_no", "remarks").agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"), F.count("*").alias("n"))
    nothing = {"posting_date": "date", "voucher_no": "string", "remarks": "string"}
    opening = opening.withColumns({c: F.lit(None).cast(kind) for c, kind in nothing.items()} | {"row_kind": F.lit(G.OPENING_ROW), "voucher_type": F.lit(G.OPENING), "n": F.lit(0).cast("long")})
    return _with_balance(opening.unionByName(period.withColumn("row_kind", F.lit(G.PERIOD_ROW))), [*_PART])


def _with_balance(rows: DataFrame, keys: list[str]) -> DataFrame:
    amounts = {c: F.col(c).cast("decimal(38,6)") for c in ("debit", "credit")}
    rows = rows.withColumns(amounts).withColumns({"_day": F.coalesce("posting_date", F.lit("0001-01-01").cast("date")), "_move": F.col("debit") - F.col("credit")})
    summed = running_total(rows, keys, "_day", ["voucher_no", "remarks"], {"_move": "balance"})
    return summed.select(*keys, *_LINE, *_AMOUNTS, "n")


def consolidated_from_parts(parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The lines and balances of ``pairs`` (account, customer) from ``consolidated_parts``, without the ledger."""
    keys = ["pair_account", "pair_customer"]
    pairs = pairs.select(F.col("account").alias(keys[0]), F.col("customer").alias(keys[1])).distinct()
    own, of = (F.col(c) for c in _PART)
    amounts = ("debit", "credit", "n")

    def lines(some: DataFrame, condition: Column, sign: int) -> DataFrame:
        return some.join(pairs, condition).select(*keys, *_LINE, *((sign * F.col(c)).alias(c) for c in amounts))

    a = lines(parts.filter(of.isNull()), own == F.col(keys[0]), 1)
    c = lines(parts.filter(own.isNull()), of == F.col(keys[1]), 1)
    both = lines(parts.filter(own.isNotNull() & of.isNotNull()), (own == F.col(keys[0])) & (of == F.col(keys[1])), -1)
    rows = a.unionByName(c).unionByName(both).groupBy(*keys, *_LINE).agg(*(F.sum(x).alias(x) for x in amounts))
    return _with_balance(rows.filter((F.col("row_kind") == G.OPENING_ROW) | (F.col("n") > 0)), keys)


def unexplained_balance(statement: DataFrame, key: str) -> DataFrame:
    """Per key the total's balance less the last running balance: system journals and late opening rows."""
    last = F.max_by("balance", F.struct("posting_date", "voucher_no", "remarks"))
    total = F.max(F.when(F.col("row_kind") == G.TOTAL_ROW, F.col("balance")))
    running = statement.filter(F.col("row_kind") != G.TOTAL_ROW).groupBy(key).agg(last.alias("_last"))
    return statement.groupBy(key).agg(total.alias("_total")).join(running, key).select(
        key, F.round(or_zero("_total") - F.col("_last"), 2).alias("unexplained")
    )
