"""Small ledgers with the traps of the statements."""

from __future__ import annotations

import pytest

from ledgerloom.operators import gl
from ledgerloom.plans import accounts

FROM, TO = "2024-01-01", "2024-12-31"


def entry(no, debit=0, credit=0, date="2024-03-01", kind="Sales Invoice", account="A", opening="No", cancelled=0, party=None, remarks=None):
    return {"account": account, "party_type": "Customer" if party else None, "party": party, "posting_date": date, "voucher_type": kind,
            "voucher_no": no, "debit": debit, "credit": credit, "is_opening": opening, "is_cancelled": cancelled, "remarks": remarks}


@pytest.fixture
def t(tables):
    return tables(
        account=[{"name": n, "account_name": f"{n} name", "is_group": 0, "account_type": "Cash"} for n in ("A", "B", "EMPTY")]
        + [{"name": "G", "is_group": 1}],
        gl_entry=[
            entry("S0", debit=100, date="2023-05-01"),
            entry("JV9", debit=7, date="2023-06-01", kind="Journal Entry"),
            entry("S1", debit=50, date="2024-02-01"),
            entry("S2", debit=5, date="2024-02-01", remarks="x"),
            entry("S2", debit=6, date="2024-02-01", remarks="x"),
            entry("P1", credit=30, date="2024-03-01", kind="Payment Entry", party="C1"),
            entry("P2", credit=1, date="2024-03-02", kind="Payment Entry"),
            entry("JV1", debit=1000, date="2024-03-03", kind="Journal Entry"),
            entry("OLD", debit=9, date="2025-06-01", opening="Yes"),
            entry("S3", debit=77, date="2024-04-01", cancelled=1),
            entry("S4", debit=2, date="2025-01-01"),
            entry("S5", debit=3, account="B", party="C1"),
        ],
        payment_entry=[
            {"name": "P1", "docstatus": 1, "posting_date": "2024-03-01", "custom_voucher_type": "Receipt Voucher", "custom_voucher_no": "RV1"},
            {"name": "P2", "docstatus": 2, "posting_date": "2024-03-02", "custom_voucher_type": "Receipt Voucher", "custom_voucher_no": "RV2"},
        ],
        journal_entry=[
            {"name": "JV1", "docstatus": 1, "posting_date": "2024-03-03", "is_system_generated": 1},
            {"name": "JV9", "docstatus": 1, "posting_date": "2023-06-01", "is_system_generated": 1},
        ],
        translation=[{"language": "ar", "source_text": "Sales Invoice", "translated_text": "b"},
                     {"language": "ar", "source_text": "Sales Invoice", "translated_text": "a"},
                     {"language": "fr", "source_text": "Payment Entry", "translated_text": "z"}],
        receipt_voucher=[{"name": "RV1", "docstatus": 1, "party_type": "Customer", "party_name": "Ali", "paid_from": "B"}],
        customer_master=[{"name": "C1", "customer_name": "Ali"}, {"name": "C2", "customer_name": "Huda"}],
    )


def lines(df, **where):
    rows = [r.asDict() for r in df.collect()]
    return [r for r in rows if all(r[k] == v for k, v in where.items())]


def test_account_statement(t):
    rows = lines(accounts.account_statement(t, FROM, TO), account="A")
    # The opening holds system journals and opening rows of any date, the period neither.
    assert [(r["row_kind"], r["voucher_no"], r["debit"], r["credit"], r["balance"]) for r in rows] == [
        (0, None, 116.0, 0.0, 116.0), (1, "S1", 50.0, 0.0, 166.0), (1, "S2", 11.0, 0.0, 177.0), (1, "RV1", 0.0, 30.0, 147.0),
        (1, "P2", 0.0, 1.0, 146.0), (2, None, 61.0, 31.0, 1137.0),
    ]
    assert rows[1]["translated_voucher_type"] == "a" and rows[3]["voucher_type"] == "Receipt Voucher"
    assert rows[4]["translated_voucher_type"] == "Payment Entry"
    assert rows[-1]["translated_voucher_type"] == gl.TOTAL_LABEL and rows[-1]["account_name"] is None


def test_account_without_rows_has_a_zero_opening_and_an_empty_total(t):
    rows = lines(accounts.account_statement(t, FROM, TO), account="EMPTY")
    assert [(r["row_kind"], r["debit"], r["balance"]) for r in rows] == [(0, 0.0, 0.0), (2, None, None)]


def test_statement_of_given_accounts_only(t):
    assert {r["account"] for r in accounts.account_statement(t, FROM, TO, ["B"]).collect()} == {"B"}


def test_unexplained_balance(t):
    statement = accounts.account_statement(t, FROM, TO)
    # 1000 + 7 of system journals are in the total, 7 also in the opening; the late opening row is not in the total.
    assert {r["account"]: r["unexplained"] for r in accounts.unexplained_balance(statement, "account").collect()}["A"] == 991.0


def test_cash_statement_names_the_counter_party(t):
    rows = lines(accounts.cash_bank_statement(t, FROM, TO), account="A", voucher_no="RV1")
    assert [r["against"] for r in rows] == ["Ali"]


def test_customer_statement(t):
    rows = lines(accounts.customer_statement(t, FROM, TO), customer="C1")
    assert [(r["row_kind"], r["voucher_no"], r["balance"]) for r in rows] == [(0, None, 0.0), (1, "RV1", -30.0), (1, "S5", -27.0), (2, None, -27.0)]
    assert rows[0]["remarks"] == "رصيد إفتتاحي - عميل (Ali)"
    assert len(lines(accounts.customer_statement(t, FROM, TO), customer="C2")) == 2


def test_consolidated_statement_counts_each_row_once(t, spark):
    pairs = spark.createDataFrame([("A", "C1")], "account string, customer string")
    rows = lines(accounts.consolidated_statement(t, pairs, FROM, TO))
    assert [r["voucher_no"] for r in rows] == [None, "S1", "S2", "RV1", "S5", "P2"]
    assert rows[-1]["balance"] == 149.0


def test_statements_of_all_pairs_from_their_parts(t, spark):
    parts = accounts.consolidated_parts(t, FROM, TO)
    pairs = spark.createDataFrame([(a, c) for a in ("A", "B", "EMPTY") for c in ("C1", "C2")], "account string, customer string")
    columns = ["pair_account", "pair_customer", "row_kind", "posting_date", "voucher_type", "voucher_no", "remarks", "debit", "credit", "balance"]
    whole = sorted(str([float(v) if k > 6 else v for k, v in enumerate(r)]) for r in accounts.consolidated_statement(t, pairs, FROM, TO).select(*columns).collect())
    assert sorted(str([float(v) if k > 6 else v for k, v in enumerate(r)]) for r in accounts.consolidated_from_parts(parts, pairs).select(*columns).collect()) == whole
    shared = [r.voucher_no for r in parts.where("part_account = 'B' and part_customer = 'C1'").collect()]
    assert shared == ["S5"] and parts.where("part_account is null and part_customer = 'C2'").count() == 1


def test_pairs_of_the_test_data(spark, sf_dir):
    from ledgerloom import Tables
    from ledgerloom.plans.registry import FROM as start
    from ledgerloom.plans.registry import TO as end
    from ledgerloom.plans.registry import busiest_pairs

    t = Tables.from_star_schema(spark, sf_dir)
    columns = ["pair_account", "pair_customer", "row_kind", "posting_date", "voucher_type", "voucher_no", "remarks", "debit", "credit", "balance"]
    text = lambda df: sorted(str([float(v) if k > 6 else v for k, v in enumerate(r)]) for r in df.select(*columns).collect())
    pairs = busiest_pairs(t)
    assert text(accounts.consolidated_from_parts(accounts.consolidated_parts(t, start, end), pairs)) == text(accounts.consolidated_statement(t, pairs, start, end))


def test_account_balances_are_net_and_one_sided(tables):
    t = tables(
        account=[{"name": n, "account_number": n, "is_group": 0, "restrict_account_view": v} for n, v in (("1", "No"), ("2", "No"), ("3", "Yes"), ("4", "No"))],
        gl_entry=[entry("x", debit=5, credit=8, account="1"), entry("x", debit=9, credit=8, account="2"), entry("x", debit=9, account="3")],
    )
    assert [(r["account_number"], r["debit"], r["credit"]) for r in accounts.account_balances(t, TO).collect()] == [
        ("1", 0.0, 3.0), ("2", 1.0, 0.0), ("4", 0.0, 0.0)]


def test_rows_without_an_account_have_a_statement(tables):
    t = tables(account=[{"name": "A", "account_name": "A name", "is_group": 0}],
               gl_entry=[entry("S0", debit=4, date="2023-05-01", account=None), entry("S1", debit=5, account=None), entry("S2", credit=2, account=None), entry("S3", debit=1)])
    rows = lines(accounts.account_statement(t, FROM, TO), account=None)
    assert [(r["row_kind"], r["voucher_no"], r["balance"]) for r in rows] == [(0, None, 4.0), (1, "S1", 9.0), (1, "S2", 7.0), (2, None, 7.0)]
