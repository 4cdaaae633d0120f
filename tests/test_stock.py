"""Stock, ageing, reservations, availability: blank years, negative lines, the FIFO remainder."""

from __future__ import annotations

import pytest

from ledgerloom.functions.columns import sanitize_cells, with_total_row
from ledgerloom.functions.predicates import filter_spec
from ledgerloom.operators import atp, stock
from ledgerloom.plans import items, stock as reports
from ledgerloom.plans.items import brand_performance, item_performance

AS_OF = "2024-12-31"


def move(item, qty, date="2024-06-01", kind="Purchase Receipt", no="PR1", year=None, value=None, cancelled=0, warehouse="W1"):
    return {"item_code": item, "actual_qty": qty, "posting_date": date, "voucher_type": kind, "voucher_no": no, "production_year": year,
            "stock_value_difference": qty * 10 if value is None else value, "is_cancelled": cancelled, "warehouse": warehouse}


def order(name, status="To Deliver and Bill", reservation="Reserve with Delivery", docstatus=1, warehouse="W1", date="2024-07-01"):
    return {"name": name, "customer": "C", "docstatus": docstatus, "status": status, "reservation_status": reservation,
            "set_warehouse": warehouse, "transaction_date": date}


def line(parent, item, qty, delivered=0, year=None, docstatus=1, name=None):
    return {"parent": parent, "item_code": item, "qty": qty, "delivered_qty": delivered, "production_year": year, "docstatus": docstatus,
            "name": name or f"{parent}-{item}"}


ITEMS = [{"name": n, "item_code": n, "item_name": n, "brand": b, "is_stock_item": s, "tire_size": "9"} for n, b, s in
         (("A", "x", 1), ("B", "x", 1), ("S", "y", 0), ("N", "y", 1))]


def key(df, *columns):
    return sorted(tuple(r[c] if not hasattr(r[c], "as_tuple") else float(r[c]) for c in columns) for r in df.collect())


def test_blank_and_missing_year_are_one(tables):
    t = tables(stock_ledger_entry=[move("A", 3, year=None), move("A", 4, year=""), move("A", 5, year="2020"), move("A", 99, cancelled=1),
                                   move("B", 1), move("B", -1), move("A", 7, date="2025-01-01")])
    assert key(stock.stock_qty(t, AS_OF, positive=True), "production_year", "actual_qty") == [("", 7.0), ("2020", 5.0)]
    assert key(stock.stock_qty(t, AS_OF), "item_code", "production_year", "actual_qty") == [("A", "", 7.0), ("A", "2020", 5.0), ("B", "", 0.0)]


def test_reservations_ignore_over_delivery_unless_offset(tables):
    t = tables(sales_order=[order("O1"), order("O2", status="Closed"), order("O3", date="2025-06-01")],
               sales_order_item=[line("O1", "A", 10, 4), line("O1", "A", 1, 3, name="l2"), line("O2", "A", 50), line("O3", "A", 2)])
    assert key(stock.reserved_qty(t, AS_OF), "qty_to_deliver") == [(6.0,)]
    assert key(stock.reserved_qty(t), "qty_to_deliver") == [(8.0,)]
    assert key(stock.reserved_qty_having(t), "qty_to_deliver") == [(6.0,)]


def test_ageing_takes_the_newest_receipts(tables):
    t = tables(
        item=ITEMS,
        purchase_receipt=[{"name": "PR1", "docstatus": 1, "is_return": 0, "posting_date": "2024-01-01"},
                          {"name": "PR2", "docstatus": 1, "is_return": 1, "posting_date": "2024-01-01"}],
        legacy_purchase_ledger=[{"item_code": "A", "posting_date": "2024-12-01", "actual_qty": 1}],
        stock_ledger_entry=[
            move("A", 10, date="2024-11-01"), move("A", 5, date="2024-12-01"), move("A", 4, date="2024-12-21", no="PR2"),
            move("A", -9, date="2024-12-22", kind="Sales Invoice", no="SI"), move("B", 2), move("B", -2, kind="Sales Invoice", no="SI"),
        ],
    )
    left = key(reports.fifo_remainder(t, AS_OF), "item_code", "os_qty", "age")
    # 10 in stock: 5 + 1 legacy of 1 December, then 4 of the 10 of 1 November.  Returns are not receipts.
    assert left == [("A", 4.0, 61), ("A", 6.0, 31)]
    report = reports.stock_ageing(t, AS_OF).collect()
    assert [(r["item_code"], r["avg_age"]) for r in report] == [("A", 43.0)]
    assert reports.stock_ageing(t, AS_OF, min_age=44).isEmpty()


def test_remainder_never_exceeds_the_balance(spark, sf_dir):
    from ledgerloom import Tables

    rows = reports.fifo_remainder(Tables.from_star_schema(spark, sf_dir), "1999-12-31")
    assert rows.groupBy("item_code", "actual_qty").sum("os_qty").filter("`sum(os_qty)` > actual_qty").isEmpty()


def promise(tables, **extra):
    return tables(item=ITEMS, **extra)


def test_promise_uses_expected_goods_first(tables):
    t = promise(
        tables,
        stock_ledger_entry=[move("A", 10)],
        purchase_receipt=[{"name": "V", "docstatus": 0, "virtual_receipt": 1, "is_return": 0}, {"name": "X", "docstatus": 0, "virtual_receipt": 0}],
        purchase_receipt_item=[{"name": "v1", "parent": "V", "docstatus": 0, "item_code": "A", "qty": 5, "warehouse": "W1"},
                               {"name": "x1", "parent": "X", "docstatus": 0, "item_code": "A", "qty": 50, "warehouse": "W1"}],
        sales_order=[order("N"), order("F", reservation="Reserve against Future Receipts"), order("U", reservation=None)],
        sales_order_item=[line("N", "A", 3), line("F", "A", 9), line("U", "A", 100), line("N", "S", 4)],
    )
    row = atp.available_to_promise(t).filter("item_code = 'A'").first()
    # 9 - 5 of the future orders eat into stock; the order without a status counts nowhere; S is no stock item.
    assert [float(row[c]) for c in ("stock", "expected", "reserved_now", "reserved_future", "actual_available", "future_available")] == [10, 5, 3, 9, 3, 3]
    assert atp.available_to_promise(t).filter("item_code = 'S'").isEmpty()
    assert atp.order_shortages(t).isEmpty()
    # Without the 5 expected units 3 - 5 would be left.
    assert key(atp.unvirtualize_check(t), "name", "missing") == [("v1", 2.0)]


def test_shortages_by_warehouse_and_year(tables):
    t = promise(tables, stock_ledger_entry=[move("A", 10, warehouse="W2"), move("A", 2, year="2020")],
                sales_order=[order("N")], sales_order_item=[line("N", "A", 3, year="2020"), line("N", "B", 1)])
    assert key(atp.order_shortages(t), "item_code", "shortage") == [("A", 1.0), ("B", 1.0)]
    assert key(atp.order_shortages(t, any_year=True), "item_code", "shortage") == [("A", 1.0), ("B", 1.0)]


@pytest.fixture
def shop(tables):
    return promise(
        tables, tire_size=[{"name": "9", "sorting_code": "009"}],
        stock_ledger_entry=[move("A", 10), move("A", 1, year="2020"), move("B", 2), move("S", 5)],
        sales_order=[order("N")], sales_order_item=[line("N", "A", 3), line("N", "B", 2)],
        item_price=[{"name": "p", "item_code": "A", "price_list": "Std", "selling": 1, "price_list_rate": 9, "production_year": ""}],
        singles=[{"doctype": "Selling Settings", "field": "selling_price_list", "value": "Std"}],
    )


def test_balance_modes(shop):
    names = ("item_code", "production_year", "qty_to_deliver")
    assert key(reports.stock_balance(shop, AS_OF, reports.AVAILABLE), *names) == [
        ("A", "", 3.0), ("A", "2020", 0.0), ("B", "", 0.0), ("S", "", 0.0)]
    assert key(reports.stock_balance(shop, AS_OF, reports.AVAILABLE, strict=True), *names) == [("A", "", 3.0), ("A", "2020", 0.0)]
    assert key(reports.available_items(shop, AS_OF, reports.AVAILABLE, 7), "item_code", "price_list_rate") == [("A", 9.0)]
    assert reports.available_items(shop, AS_OF, "no such mode").isEmpty()


def test_items_without_stock_appear_at_minimum_zero(shop):
    assert ("N", "") in key(reports.stock_balance_prices(shop, AS_OF, minimum_qty=0), "item_code", "production_year")
    assert ("N", "") not in key(reports.stock_balance_prices(shop, AS_OF), "item_code", "production_year")
    assert key(reports.stock_balance_prices(shop, AS_OF, brands=[" y ", ""], minimum_qty=0), "item_code") == [("N",)]


def test_opening_reconciliation_counts_a_day_earlier(tables):
    t = tables(item=ITEMS, stock_reconciliation=[{"name": "R1", "docstatus": 1, "purpose": "Opening Stock", "posting_date": "2024-01-01"}],
               stock_ledger_entry=[move("A", 10, date="2024-01-01", kind="Stock Reconciliation", no="R1"),
                                   move("A", 4, date="2024-01-01"), move("B", 4, date="2024-01-01", kind="Stock Reconciliation", no="R2")])
    moves = key(items.item_transactions(t, "2024-01-01", AS_OF), "item_code", "opening_stock", "purchases", "ending_stock")
    assert moves == [("A", 10.0, 4.0, 14.0), ("B", 0.0, 0.0, 4.0)]


def test_brand_report_is_the_sum_of_the_item_report(spark, sf_dir):
    from ledgerloom import Tables

    t = Tables.from_star_schema(spark, sf_dir)
    per_item = item_performance(t, "1997-01-01", "1999-12-31").groupBy("brand").sum("sales_amount", "stock_qty")
    per_brand = brand_performance(t, "1997-01-01", "1999-12-31")
    both = per_item.join(per_brand, "brand").filter("abs(`sum(sales_amount)` - sales_amount) > 0.01 OR `sum(stock_qty)` <> stock_qty")
    assert both.isEmpty() and per_item.count() == per_brand.count()


def test_item_ledger_rows_of_a_voucher_share_the_balance(tables):
    t = tables(item=ITEMS[:1], customer_master=[{"name": "C", "customer_name": "Ali"}],
               sales_invoice=[{"name": "SI", "customer": "C", "docstatus": 1, "update_stock": 1, "posting_date": "2024-06-02"}],
               stock_ledger_entry=[move("A", 10, date="2023-01-01"), move("A", -1, date="2024-06-02", kind="Sales Invoice", no="SI", year="2020"),
                                   move("A", -2, date="2024-06-02", kind="Sales Invoice", no="SI"), move("A", 5, date="2024-07-01")])
    rows = items.item_ledger(t, "2024-01-01", AS_OF).collect()
    assert [r["balance"] for r in rows] == [10.0, 7.0, 7.0, 12.0]
    assert rows[1]["customer_name"] == "Ali"


def test_item_ledger_keeps_rows_without_an_item(tables):
    t = tables(item=ITEMS[:1], stock_ledger_entry=[move(None, 4, date="2023-01-01"), move(None, -1, date="2024-06-02", no="X"), move("A", 5, date="2024-07-01")])
    rows = items.item_ledger(t, "2024-01-01", AS_OF).collect()
    assert [(r["item_code"], r["balance"]) for r in rows] == [(None, 4.0), (None, 3.0), ("A", 0.0), ("A", 5.0)]


def test_total_row_and_cells(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.5)], "n string, x double")
    assert [tuple(r) for r in with_total_row(df, "n", ["x"]).collect()][-1] == ("Total", 3.5, 1)
    cells = spark.createDataFrame([("<p>x &lt; 3</p>\x07",), (None,)], "c string")
    assert [r["c"] for r in sanitize_cells(cells).collect()] == ["x &lt; 3", None]


@pytest.mark.parametrize("spec,names", [
    ('[["Item Price","x",">",1],["n","!=","c"]]', ["b"]), ('{"n":"a"}', ["a"]), ('{"x":["<=",2]}', ["a", "b"]),
    ('[["n","in",["a","c"]]]', ["a", "c"]), ("[]", ["a", "b", "c"]), ('[["n","not in",["a"]]]', ["b", "c"]),
])
def test_filter_lists(spark, spec, names):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "n string, x int")
    assert [r["n"] for r in filter_spec(df, spec).collect()] == names


def test_unknown_filter_operator(spark):
    with pytest.raises(ValueError):
        filter_spec(spark.range(1), '[["id","like","x"]]')


def test_lines_without_a_year_may_take_any_year(tables):
    def order(name, status="Reserve with Delivery"):
        return {"name": name, "docstatus": 1, "status": "To Deliver", "reservation_status": status, "set_warehouse": "W", "customer": "C"}

    def line(name, parent, year, qty):
        return {"name": name, "parent": parent, "docstatus": 1, "item_code": "A", "production_year": year, "qty": qty, "delivered_qty": 0}

    stock = [{"name": "s", "item_code": "A", "production_year": "2024", "warehouse": "W", "actual_qty": 50, "is_cancelled": 0, "posting_date": "2024-01-01"}]
    t = tables(item=[{"name": "A", "is_stock_item": 1}], stock_ledger_entry=stock, sales_order=[order("o")], sales_order_item=[line("any", "o", None, 5)])
    assert atp.order_shortages(t).isEmpty()
    t = tables(item=[{"name": "A", "is_stock_item": 1}], stock_ledger_entry=stock, sales_order=[order("o")], sales_order_item=[line("any", "o", None, 5), line("old", "o", "2020", 3), line("new", "o", "2024", 4)])
    assert key(atp.order_shortages(t), "name", "shortage") == [("old", 3.0)]
    assert atp.order_shortages(t, any_year=True).isEmpty()
    receipts = {"purchase_receipt": [{"name": "r", "docstatus": 0, "virtual_receipt": 1}],
                "purchase_receipt_item": [{"name": "x", "parent": "r", "docstatus": 0, "item_code": "A", "production_year": "2024", "warehouse": "W", "qty": 20}]}
    t = tables(item=[{"name": "A", "is_stock_item": 1}], stock_ledger_entry=stock, sales_order=[order("o", "Reserve against Future Receipts")], sales_order_item=[line("l", "o", "2024", 60)], **receipts)
    assert atp.order_shortages(t).isEmpty()
    assert atp.order_shortages(t, reserves_future=False).isEmpty() and atp.available_to_promise(t).first().actual_available == 10
