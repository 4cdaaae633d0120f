"""Customer balances, limits, overdue dates and their edges."""

from __future__ import annotations

import pytest

from ledgerloom.operators import parties as P
from ledgerloom.plans import customers as C

AS_OF = "2024-12-31"


def invoice(name, customer, date, outstanding, is_return=0, docstatus=1):
    return {"name": name, "customer": customer, "posting_date": date, "outstanding_amount": outstanding, "is_return": is_return,
            "docstatus": docstatus}


@pytest.fixture
def t(tables):
    return tables(
        customer_master=[
            {"name": "C1", "customer_name": "one", "payment_terms": "T30", "bypass_overdue_check": 0},
            {"name": "C2", "customer_name": "two", "payment_terms": None},
            {"name": "C3", "customer_name": "three", "payment_terms": "T30", "bypass_overdue_check": 1},
            {"name": "C4", "customer_name": "four", "payment_terms": "T10"},
        ],
        payment_terms_detail=[{"parent": "T30", "credit_days": 30}, {"parent": "T30", "credit_days": 20}, {"parent": "T10", "credit_days": 10}],
        customer_credit_limit=[
            {"parent": "C1", "parenttype": "Customer", "credit_limit": 100}, {"parent": "C1", "parenttype": "Customer", "credit_limit": 50},
            {"parent": "C1", "parenttype": "Customer Group", "credit_limit": 999},
        ],
        sales_invoice=[
            invoice("a", "C1", "2024-12-01", 10), invoice("b", "C1", "2024-12-02", 20), invoice("c", "C1", "2024-12-07", 40),
            invoice("d", "C1", "2024-01-01", 500, docstatus=0), invoice("e", "C1", "2024-01-01", -5, is_return=1),
            invoice("f", "C2", "2024-12-31", 1), invoice("g", "C3", "2024-01-01", 7), invoice("h", "C4", "2024-12-30", 3),
        ],
        gl_entry=[
            {"party_type": "Customer", "party": "C1", "posting_date": "2024-01-01", "debit": 120, "credit": 0, "is_cancelled": 0},
            {"party_type": "Customer", "party": "C1", "posting_date": "2025-01-01", "debit": 1, "credit": 0, "is_cancelled": 0},
            {"party_type": "Customer", "party": "C4", "posting_date": "2024-01-01", "debit": 0, "credit": 2, "is_cancelled": 0},
            {"party_type": "Supplier", "party": "C4", "posting_date": "2024-01-01", "debit": 0, "credit": 2, "is_cancelled": 0},
        ],
        sales_order=[
            {"name": "S1", "customer": "C1", "docstatus": 1, "status": "To Bill", "transaction_date": "2024-05-05", "total": 100, "grand_total": 110},
            {"name": "S2", "customer": "C1", "docstatus": 1, "status": "Closed", "transaction_date": "2024-05-05", "total": 100, "grand_total": 110},
            {"name": "S3", "customer": "C4", "docstatus": 1, "status": "To Bill", "transaction_date": "2024-05-05", "total": 0, "grand_total": 0},
        ],
        sales_order_item=[
            {"parent": "S1", "docstatus": 1, "amount": 60, "billed_amt": 20}, {"parent": "S1", "docstatus": 1, "amount": 40, "billed_amt": 60},
            {"parent": "S2", "docstatus": 1, "amount": 60, "billed_amt": 0}, {"parent": "S3", "docstatus": 1, "amount": 60, "billed_amt": 0},
        ],
    )


def by_customer(df, column):
    return {r["customer"]: None if r[column] is None else float(r[column]) for r in df.collect()}


def test_overdue_includes_the_due_day_and_soon_starts_at_85_percent(t):
    # 30 days: due on 31 December for 1 December; 85 percent are 25 days.
    assert by_customer(P.overdue(t, AS_OF), "overdue") == {"C1": 10.0, "C2": 1.0, "C3": 7.0}
    assert by_customer(P.potential_overdue(t, AS_OF), "potential_overdue") == {"C1": 20.0}


def test_limits_are_summed_and_unbilled_scaled(t):
    assert by_customer(P.credit_limit(t), "credit_limit") == {"C1": 150.0}
    # An order with a zero total has no share to scale by.
    assert by_customer(P.unbilled_orders(t, AS_OF), "unbilled") == {"C1": 44.0, "C4": None}


def test_overdue_blocks(t):
    rows = {r["customer"]: r["reason"] for r in P.overdue_blocks(t, AS_OF).collect()}
    # C1's invoice of 1 December is exactly 30 days old, not older; its return takes the rest below zero.
    assert rows == {"C2": "no terms"}
    assert {r["customer"] for r in P.overdue_blocks(t, "2025-02-28").collect()} == {"C1", "C2", "C4"}


def test_indicator(t):
    status = {r["customer"]: r["indicator"] for r in P.customer_credit_status(t, "2024-12-06").collect()}
    # C1: 121 + 44 is above 150.  C2 owes nothing yet, C4 nothing at all.
    assert status["C1"] == P.RED and status["C3"] == P.RED and status["C4"] == P.GREEN


@pytest.mark.parametrize("mode,names", [
    (C.ALL, {"C1", "C2", "C3", "C4"}), (C.DEBIT_WITHOUT, {"C1"}), (C.CREDIT_WITHOUT, {"C4"}), (C.ZERO_WITHOUT, {"C2", "C3"}),
    (C.DEBIT_WITH, {"C1"}), (C.CREDIT_WITH, {"C4"}), (C.ZERO_WITH, {"C2", "C3"}), (C.OVERDUE, {"C1", "C2", "C3"}), (C.OVER_CREDIT, {"C1"}),
    ("something else", set()),
])
def test_choices_of_the_balances_report(t, mode, names):
    assert {r["customer"] for r in C.customer_balances(t, AS_OF, mode).collect()} == names


def test_balances_are_sorted_by_what_customers_owe_with_orders(t):
    rows = C.customer_balances(t, AS_OF).collect()
    assert [(r["customer"], r["balance_w_so"]) for r in rows] == [("C1", 164.0), ("C2", 0.0), ("C3", 0.0), ("C4", -2.0)]
