"""The expected results as DuckDB SQL over the business views.

Each text is written against the views of ``ledgerloom.sources.erp_views``; those it names are put in front
as WITH items.  Amounts are summed as decimals and become DOUBLE at the end, dates stay DATE.
"""

from __future__ import annotations

from ledgerloom.sources.erp_views import views_in, with_clause

FROM, TO = "DATE '1997-01-01'", "DATE '1999-12-31'"
YEAR = "coalesce(production_year, '')"
OPEN = "docstatus = 1 AND status NOT IN ('Completed', 'Closed')"


def D(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def R(expr: str, places: int) -> str:
    """Rounded half up on decimals."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,9)), {places}) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def percent_text(profit: str, base: str) -> str:
    return f"format('{{:,.1f}}', {R(f'({ratio(profit, base)}) * 100', 1)}) || '%'"


# --- shared CTEs -------------------------------------------------------------------------------------------------

STOCK = f"""q_stock AS (
  SELECT item_code, {YEAR} AS production_year, sum(actual_qty) AS actual_qty FROM stock_ledger_entry
  WHERE is_cancelled = 0 AND posting_date <= {TO} GROUP BY 1, 2 HAVING sum(actual_qty) > 0)"""
RESERVED = f"""q_res AS (
  SELECT i.item_code, coalesce(i.production_year, '') AS production_year, sum(i.qty - i.delivered_qty) AS qty_to_deliver
  FROM sales_order_item i JOIN sales_order o ON i.parent = o.name
  WHERE i.docstatus = 1 AND o.docstatus = 1 AND o.status NOT IN ('Completed', 'Closed') AND i.qty - i.delivered_qty > 0
    AND o.transaction_date <= {TO} GROUP BY 1, 2)"""
PRICE = f"""q_price AS (
  SELECT item_code, {YEAR} AS production_year, price_list_rate, name AS price_name FROM item_price WHERE selling = 1 AND price_list IN
  (SELECT value FROM singles WHERE doctype = 'Selling Settings' AND field = 'selling_price_list'))"""
RATE = f"""q_rate AS (
  SELECT item_code, sum(actual_qty) AS actual_qty, {ratio('sum(stock_value_difference)', 'sum(actual_qty)')} AS valuation_rate
  FROM stock_ledger_entry WHERE is_cancelled = 0 AND posting_date <= {TO} GROUP BY 1 HAVING sum(actual_qty) > 0)"""
VIRTUAL = """q_virtual AS (
  SELECT i.item_code, coalesce(i.production_year, '') AS production_year, sum(i.qty) AS qty_to_receive
  FROM purchase_receipt_item i JOIN purchase_receipt r ON i.parent = r.name
  WHERE i.docstatus = 0 AND r.docstatus = 0 AND r.virtual_receipt = 1 AND r.is_return = 0 AND i.qty > 0 GROUP BY 1, 2)"""
ITEM_YEARS = f"""q_items AS (
  SELECT i.*, coalesce(s.y, '') AS production_year FROM item i
  LEFT JOIN (SELECT DISTINCT item_code AS ic, {YEAR} AS y FROM stock_ledger_entry WHERE is_cancelled = 0) s ON i.name = s.ic)"""
BALANCE = f"""q_bal AS (
  SELECT party AS customer, sum(debit) - sum(credit) AS balance FROM gl_entry
  WHERE is_cancelled = 0 AND party_type = 'Customer' AND posting_date <= {TO} GROUP BY 1)"""


def unbilled(date_filter: bool = True) -> str:
    when = f"AND o.transaction_date <= {TO}" if date_filter else ""
    return f"""q_unb AS (
  SELECT o.customer, sum(CAST((i.amount - i.billed_amt) AS DOUBLE) * CAST(o.grand_total AS DOUBLE) / nullif(CAST(o.total AS DOUBLE), 0)) AS unbilled
  FROM sales_order_item i JOIN sales_order o ON i.parent = o.name
  WHERE i.docstatus = 1 AND o.docstatus = 1 AND o.status NOT IN ('Completed', 'Closed') AND i.amount - i.billed_amt > 0 {when} GROUP BY 1)"""


LIMIT = """q_limit AS (SELECT parent AS customer, sum(credit_limit) AS credit_limit FROM customer_credit_limit
  WHERE parenttype = 'Customer' GROUP BY 1)"""
TERMS = """q_terms AS (
  SELECT c.name AS customer, c.payment_terms, c.bypass_overdue_check, coalesce(d.days, 0) AS days FROM customer_master c
  LEFT JOIN (SELECT parent, max(credit_days) AS days FROM payment_terms_detail GROUP BY 1) d ON c.payment_terms = d.parent)"""
OVERDUE = f"""q_over AS (
  SELECT s.customer, sum(s.outstanding_amount) FILTER (WHERE {TO} >= s.posting_date + t.days) AS overdue,
    sum(s.outstanding_amount) FILTER (WHERE {TO} < s.posting_date + t.days
      AND {TO} >= s.posting_date + CAST(floor(t.days * 0.85) AS INT)) AS potential_overdue
  FROM sales_invoice s JOIN q_terms t ON s.customer = t.customer
  WHERE s.docstatus = 1 AND s.is_return = 0 AND s.outstanding_amount > 0 GROUP BY 1)"""


def sales(key: str) -> str:
    return f"""q_sales AS (
  SELECT {key}, sum(i.qty) AS qty, sum(i.net_amount) AS net_amount FROM sales_invoice_item i JOIN sales_invoice s ON i.parent = s.name
  WHERE i.docstatus = 1 AND s.docstatus = 1 AND s.posting_date BETWEEN {FROM} AND {TO} GROUP BY 1)"""


COGS_ITEM = f"""q_cogs AS (
  SELECT item_code, -sum(stock_value_difference) AS cost FROM stock_ledger_entry WHERE is_cancelled = 0
  AND voucher_type IN ('Sales Invoice', 'Delivery Note') AND posting_date BETWEEN {FROM} AND {TO} GROUP BY 1)"""
COGS_CUSTOMER = f"""q_cogs AS (
  SELECT v.customer, -sum(e.stock_value_difference) AS cost FROM stock_ledger_entry e JOIN (
    SELECT name, customer FROM sales_invoice WHERE docstatus = 1 AND update_stock = 1 AND posting_date BETWEEN {FROM} AND {TO}
    UNION SELECT name, customer FROM delivery_note WHERE docstatus = 1 AND posting_date BETWEEN {FROM} AND {TO}) v ON e.voucher_no = v.name
  WHERE e.is_cancelled = 0 AND e.voucher_type IN ('Sales Invoice', 'Delivery Note') AND e.posting_date BETWEEN {FROM} AND {TO} GROUP BY 1)"""
MOVES = f"""q_moves AS (
  SELECT e.item_code,
    sum(e.actual_qty) FILTER (WHERE coalesce(r.d, e.posting_date) < {FROM}) AS opening_stock,
    sum(e.actual_qty) FILTER (WHERE e.posting_date BETWEEN {FROM} AND {TO} AND e.voucher_type IN ('Purchase Invoice', 'Purchase Receipt')) AS purchases,
    -sum(e.actual_qty) FILTER (WHERE e.posting_date BETWEEN {FROM} AND {TO} AND e.voucher_type IN ('Sales Invoice', 'Delivery Note')) AS sales,
    sum(e.actual_qty) FILTER (WHERE e.posting_date <= {TO}) AS ending_stock
  FROM stock_ledger_entry e LEFT JOIN (SELECT name, posting_date - 1 AS d FROM stock_reconciliation
    WHERE docstatus = 1 AND purpose = 'Opening Stock') r ON e.voucher_no = r.name
  WHERE e.is_cancelled = 0 AND e.posting_date <= {TO} GROUP BY 1)"""
ITEM_MOVES = f"""{MOVES}, q_im AS (
  SELECT i.*, coalesce(m.opening_stock, 0) AS o, coalesce(m.purchases, 0) AS p, coalesce(m.sales, 0) AS s, coalesce(m.ending_stock, 0) AS e
  FROM item i LEFT JOIN q_moves m ON i.name = m.item_code
  WHERE coalesce(m.opening_stock, 0) + abs(coalesce(m.purchases, 0)) + abs(coalesce(m.sales, 0)) + coalesce(m.ending_stock, 0) > 0)"""
ITEM_RESULTS = f"""{sales('i.item_code')}, {COGS_ITEM}, q_qty AS (
  SELECT item_code, sum(actual_qty) AS q FROM stock_ledger_entry WHERE is_cancelled = 0 AND posting_date <= {TO} GROUP BY 1), q_ir AS (
  SELECT i.name AS item_code, i.item_name, i.brand, coalesce(s.qty, 0) AS sales_qty, coalesce(s.net_amount, 0) AS sales_amount,
    coalesce(c.cost, 0) AS sales_cost, coalesce(q.q, 0) AS stock_qty
  FROM item i LEFT JOIN q_sales s ON i.name = s.item_code LEFT JOIN q_cogs c ON i.name = c.item_code LEFT JOIN q_qty q ON i.name = q.item_code
  WHERE abs(coalesce(s.qty, 0)) + coalesce(q.q, 0) > 0)"""

VOUCHER_MAP = f"""q_map AS (
  SELECT 'Payment Entry' AS vt, name AS vn, custom_voucher_type AS ct, custom_voucher_no AS cn FROM payment_entry
  WHERE docstatus = 1 AND custom_voucher_type IS NOT NULL AND posting_date BETWEEN {FROM} AND {TO}
  UNION ALL SELECT 'Journal Entry', name, custom_voucher_type, custom_voucher_no FROM journal_entry
  WHERE docstatus = 1 AND custom_voucher_type IS NOT NULL AND posting_date BETWEEN {FROM} AND {TO})"""
SYSTEM = "(SELECT name FROM journal_entry WHERE docstatus = 1 AND is_system_generated = 1)"
WORDS = """q_words AS (SELECT source_text, min(translated_text) AS word FROM translation WHERE language = 'ar' GROUP BY 1)"""


def period(source: str, keys: str, by_remarks: bool = True) -> str:
    group = ", remarks" if by_remarks else ""
    remark = "remarks" if by_remarks else "min(remarks) AS remarks"
    return f"""{VOUCHER_MAP}, q_period AS (
  SELECT {keys}, g.posting_date, coalesce(m.ct, g.voucher_type) AS voucher_type, coalesce(m.cn, g.voucher_no) AS voucher_no,
    sum(debit) AS debit, sum(credit) AS credit, count(*) AS n, {remark}
  FROM {source} g LEFT JOIN q_map m ON g.voucher_type = m.vt AND g.voucher_no = m.vn
  WHERE g.is_cancelled = 0 AND g.is_opening = 'No' AND g.voucher_no NOT IN {SYSTEM} AND g.posting_date BETWEEN {FROM} AND {TO}
  GROUP BY {keys}, g.posting_date, coalesce(m.ct, g.voucher_type), coalesce(m.cn, g.voucher_no){group})"""


def opening(source: str, keys: str, key_list: str) -> str:
    return f"""q_opening AS (
  SELECT {keys}, coalesce(sum(debit), 0) AS debit, coalesce(sum(credit), 0) AS credit FROM (
    SELECT {keys}, debit, credit FROM {source} WHERE is_cancelled = 0 AND ((is_opening = 'No' AND posting_date < {FROM}) OR is_opening = 'Yes')
    UNION ALL SELECT {keys}, 0, 0 FROM {key_list}) GROUP BY {keys})"""


def statement(source: str, keys: str, key_list: str, by_remarks: bool = True, total_source: str | None = None) -> str:
    """CTEs up to q_lines: opening, period and (with total_source) total rows."""
    total = ""
    if total_source:
        total = f"""UNION ALL SELECT {keys}, 2, NULL, NULL, NULL, sum(debit), sum(credit), sum(bal), NULL, 'الإجمالي' FROM (
    SELECT {keys}, debit, credit, NULL::DECIMAL(38,2) AS bal FROM q_period
    UNION ALL SELECT {keys}, NULL, NULL, debit - credit FROM {total_source} WHERE is_cancelled = 0 AND posting_date <= {TO}
    UNION ALL SELECT {keys}, NULL, NULL, NULL FROM {key_list}) GROUP BY {keys}"""
    return f"""{period(source, keys, by_remarks)}, {opening(source, keys, key_list)}, {WORDS}, q_rows AS (
  SELECT {keys}, 0 AS row_kind, NULL::DATE AS posting_date, 'Opening' AS voucher_type, NULL::VARCHAR AS voucher_no, debit, credit,
    NULL::VARCHAR AS remarks FROM q_opening
  UNION ALL SELECT {keys}, 1, posting_date, voucher_type, voucher_no, debit, credit, remarks FROM q_period), q_lines AS (
  SELECT {keys}, row_kind, posting_date, voucher_type, voucher_no, debit, credit,
    sum(debit - credit) OVER (PARTITION BY {keys} ORDER BY posting_date NULLS FIRST, voucher_no NULLS FIRST, remarks NULLS FIRST) AS balance,
    remarks, coalesce(w.word, voucher_type) AS translated_voucher_type
  FROM q_rows LEFT JOIN q_words w ON voucher_type = w.source_text {total})"""


LINE_OUT = f"""posting_date, translated_voucher_type, voucher_no, {D('debit')} AS debit, {D('credit')} AS credit, {D('balance')} AS balance"""

ATP_PARTS = f"""q_open AS (
  SELECT i.item_code, coalesce(i.production_year, '') AS production_year, o.set_warehouse AS warehouse, o.reservation_status AS rs,
    i.qty - i.delivered_qty AS pending
  FROM sales_order_item i JOIN sales_order o ON i.parent = o.name JOIN item t ON i.item_code = t.name AND t.is_stock_item = 1
  WHERE i.docstatus = 1 AND o.docstatus = 1 AND o.status NOT IN ('Completed', 'Closed') AND i.qty - i.delivered_qty > 0),
q_parts AS (
  SELECT item_code, {YEAR} AS production_year, warehouse, actual_qty AS s, 0 AS v, 0 AS ra, 0 AS rf FROM stock_ledger_entry WHERE is_cancelled = 0
  UNION ALL SELECT i.item_code, coalesce(i.production_year, ''), i.warehouse, 0, i.qty, 0, 0 FROM purchase_receipt_item i
    JOIN purchase_receipt r ON i.parent = r.name WHERE i.docstatus = 0 AND r.docstatus = 0 AND r.virtual_receipt = 1
  UNION ALL SELECT item_code, production_year, warehouse, 0, 0, pending, 0 FROM q_open WHERE rs NOT IN ('Reserve against Future Receipts')
  UNION ALL SELECT item_code, production_year, warehouse, 0, 0, 0, pending FROM q_open WHERE rs IN ('Reserve against Future Receipts'))"""


def atp(keys: str) -> str:
    return f"""{ATP_PARTS}, q_atp AS (
  SELECT {keys}, sum(s) AS stock, sum(v) AS expected, sum(ra) AS reserved_now, sum(rf) AS reserved_future,
    CASE WHEN sum(rf) > sum(v) THEN sum(s) - (sum(ra) + (sum(rf) - sum(v))) ELSE sum(s) - sum(ra) END AS actual_available,
    (sum(s) + sum(v)) - (sum(ra) + sum(rf)) AS future_available
  FROM q_parts GROUP BY {keys})"""


def atp_out(keys: str) -> str:
    columns = ("stock", "expected", "reserved_now", "reserved_future", "actual_available", "future_available")
    return f"WITH {atp(keys)} SELECT {keys}, {', '.join(f'{D(c)} AS {c}' for c in columns)} FROM q_atp"


METRICS = f"""q_brate AS (SELECT item_code, {ratio('sum(stock_value)', 'sum(actual_qty)')} AS r FROM bin WHERE actual_qty > 0 GROUP BY 1),
q_all AS (SELECT item_code, {YEAR} AS y, sum(actual_qty) AS q FROM stock_ledger_entry WHERE is_cancelled = 0 GROUP BY 1, 2),
q_wait AS (SELECT i.item_code, coalesce(i.production_year, '') AS y, sum(i.qty - i.delivered_qty) AS q FROM sales_order_item i
  JOIN sales_order o ON i.parent = o.name WHERE i.docstatus = 1 AND o.docstatus = 1 AND o.status NOT IN ('Completed', 'Closed')
  AND i.qty - i.delivered_qty > 0 GROUP BY 1, 2),
q_ip AS (SELECT p.*, coalesce(b.r, 0) AS stock_valuation_rate, coalesce(a.q, 0) AS stock_qty, coalesce(a.q, 0) - coalesce(w.q, 0) AS available_qty
  FROM item_price p LEFT JOIN q_brate b ON p.item_code = b.item_code
  LEFT JOIN q_all a ON p.item_code = a.item_code AND coalesce(p.production_year, '') = a.y
  LEFT JOIN q_wait w ON p.item_code = w.item_code AND coalesce(p.production_year, '') = w.y)"""

WORKSHEET = f"""q_share AS (
  SELECT name, {ratio("coalesce(freight_amount, 0) * coalesce(freight_exchange_rate, 0) + coalesce(inspection_amount, 0) * coalesce(inspection_exchange_rate, 0) + coalesce(clearance_amount, 0) + coalesce(transport_amount, 0) + coalesce(foreign_bank_charges_amount, 0) * coalesce(foreign_bank_charges_exchange_rate, 0) + coalesce(local_bank_charges_amount, 0)", "base_grand_total")} AS share
  FROM purchase_receipt WHERE docstatus <> 2),
q_lines AS (
  SELECT parent, item_code, {YEAR} AS y, max(docstatus) AS ds, sum(qty) AS qty, sum(base_net_amount + item_tax_amount) AS goods
  FROM purchase_receipt_item WHERE docstatus <> 2 GROUP BY 1, 2, 3),
q_all AS (SELECT item_code, {YEAR} AS y, sum(actual_qty) AS q FROM stock_ledger_entry WHERE is_cancelled = 0 GROUP BY 1, 2),
q_val AS (SELECT item_code, sum(actual_qty) AS q, sum(stock_value_difference) AS v FROM stock_ledger_entry WHERE is_cancelled = 0 GROUP BY 1),
q_hav AS (SELECT i.item_code, coalesce(i.production_year, '') AS y, sum(i.qty - i.delivered_qty) AS q FROM sales_order_item i
  JOIN sales_order o ON i.parent = o.name WHERE i.docstatus = 1 AND o.docstatus = 1 AND o.status NOT IN ('Completed', 'Closed')
  GROUP BY 1, 2 HAVING sum(i.qty - i.delivered_qty) > 0), {PRICE},
q_ws AS (
  SELECT l.parent AS purchase_receipt, l.item_code, i.item_name, i.brand, l.y AS production_year, {D('l.qty')} AS receipt_qty,
    {ratio('CAST(l.goods AS DOUBLE) * (1 + s.share)', 'l.qty')} AS receipt_valuation_rate,
    {D('CASE WHEN l.ds = 1 THEN a.q ELSE coalesce(a.q, 0) + l.qty END')} AS stock_qty,
    {D('CASE WHEN l.ds = 1 THEN a.q ELSE coalesce(a.q, 0) + l.qty END - coalesce(h.q, 0)')} AS available_qty,
    {ratio('CASE WHEN l.ds = 1 THEN CAST(v.v AS DOUBLE) ELSE coalesce(CAST(v.v AS DOUBLE), 0) + CAST(l.goods AS DOUBLE) * (1 + s.share) END', 'CASE WHEN l.ds = 1 THEN v.q ELSE coalesce(v.q, 0) + l.qty END')} AS stock_valuation_rate,
    {D('p.price_list_rate')} AS selling_price, p.price_name
  FROM q_lines l JOIN q_share s ON l.parent = s.name JOIN item i ON l.item_code = i.name
  LEFT JOIN q_all a ON l.item_code = a.item_code AND l.y = a.y LEFT JOIN q_hav h ON l.item_code = h.item_code AND l.y = h.y
  LEFT JOIN q_val v ON l.item_code = v.item_code LEFT JOIN q_price p ON l.item_code = p.item_code AND l.y = p.production_year)"""

MARGIN = f"""CASE WHEN coalesce(price_list_rate, 0) <> 0 THEN CASE WHEN rate > price_list_rate THEN 'Amount' ELSE '' END END AS margin_type,
  CASE WHEN coalesce(price_list_rate, 0) <> 0 THEN CASE WHEN rate > price_list_rate THEN {R('rate - price_list_rate', 6)} ELSE 0 END END AS margin_rate_or_amount,
  CASE WHEN coalesce(price_list_rate, 0) <> 0 THEN CASE WHEN rate > price_list_rate THEN rate ELSE 0 END END AS rate_with_margin,
  CASE WHEN coalesce(price_list_rate, 0) <> 0 THEN CASE WHEN rate > price_list_rate THEN 0 ELSE {R('(1 - rate / price_list_rate) * 100', 6)} END END AS discount_percentage,
  CASE WHEN coalesce(price_list_rate, 0) <> 0 AND NOT rate > price_list_rate THEN {R('price_list_rate - rate', 6)} END AS discount_amount"""

BALANCES = f"""WITH {BALANCE}, {unbilled()}, {LIMIT}, {TERMS}, {OVERDUE}, q_cb AS (
  SELECT c.name AS customer, c.customer_name, c.customer_group, c.payment_terms, coalesce(l.credit_limit, 0) AS credit_limit,
    coalesce(b.balance, 0) AS balance_wo_so, {R('coalesce(u.unbilled, 0)', 4)} AS unbilled_sales_orders,
    {R('CAST(coalesce(b.balance, 0) AS DOUBLE) + coalesce(u.unbilled, 0)', 4)} AS balance_w_so, coalesce(o.overdue, 0) AS overdues
  FROM customer_master c LEFT JOIN q_bal b ON c.name = b.customer LEFT JOIN q_unb u ON c.name = u.customer
  LEFT JOIN q_limit l ON c.name = l.customer LEFT JOIN q_over o ON c.name = o.customer)
SELECT customer, customer_name, customer_group, payment_terms, {D('credit_limit')} AS credit_limit, {D('balance_wo_so')} AS balance_wo_so,
  unbilled_sales_orders, balance_w_so, {D('overdues')} AS overdues FROM q_cb"""


def stock_report(columns: str, extra_join: str, where: str, ctes: str = "") -> str:
    return f"""WITH {STOCK}, {RESERVED}, {PRICE}, {RATE}{ctes} SELECT s.item_code, i.item_name, s.production_year, i.brand, {columns}
FROM q_stock s JOIN item i ON s.item_code = i.name
LEFT JOIN q_res r ON s.item_code = r.item_code AND s.production_year = r.production_year {extra_join} WHERE {where}"""


_LEFT = "s.actual_qty - coalesce(r.qty_to_deliver, 0)"
_PRICE_JOIN = "LEFT JOIN q_price p ON s.item_code = p.item_code AND s.production_year = p.production_year"

BY_YEAR = f"""WITH {ITEM_YEARS}, {STOCK}, {RESERVED}, {PRICE}, {VIRTUAL} SELECT i.name AS item_code, i.item_name, i.production_year, i.brand,
  {D('coalesce(s.actual_qty, 0)')} AS actual_qty, {D('coalesce(r.qty_to_deliver, 0)')} AS qty_to_deliver,
  {D('coalesce(s.actual_qty, 0) - coalesce(r.qty_to_deliver, 0)')} AS available_qty, {D('coalesce(v.qty_to_receive, 0)')} AS qty_to_receive,
  {D('p.price_list_rate')} AS price_list_rate
FROM q_items i LEFT JOIN q_stock s ON i.name = s.item_code AND i.production_year = s.production_year
LEFT JOIN q_res r ON i.name = r.item_code AND i.production_year = r.production_year
LEFT JOIN q_virtual v ON i.name = v.item_code AND i.production_year = v.production_year
LEFT JOIN q_price p ON i.name = p.item_code AND i.production_year = p.production_year WHERE i.is_stock_item = 1"""


#: The flag of the default company, or of the first one by name.
CHECKED = """(SELECT validate_selling_price_so FROM company
  ORDER BY name <> coalesce((SELECT max(value) FROM singles WHERE doctype = 'Global Defaults' AND field = 'default_company'), ''), name LIMIT 1) = 1"""


def price_floor(line_table: str, order_table: str, match_year: bool, value: str, order_filter: str) -> str:
    exact = "CASE WHEN coalesce(l.production_year, '') = '' THEN f.r ELSE e.r END" if match_year else "f.r"
    return f"""WITH q_any AS (SELECT item_code, price_list, min(price_list_rate) AS r FROM item_price GROUP BY 1, 2),
q_exact AS (SELECT item_code, price_list, {YEAR} AS y, min(price_list_rate) AS r FROM item_price GROUP BY 1, 2, 3),
q_l AS (SELECT l.name, l.parent, l.item_code, coalesce(l.production_year, '') AS production_year, l.net_rate, l.{value} AS value, {exact} AS listed
  FROM {line_table} l JOIN {order_table} o ON l.parent = o.name
  LEFT JOIN q_any f ON l.item_code = f.item_code AND o.selling_price_list = f.price_list
  LEFT JOIN q_exact e ON l.item_code = e.item_code AND o.selling_price_list = e.price_list AND coalesce(l.production_year, '') = e.y
  WHERE l.docstatus <> 2 AND o.docstatus <> 2 {order_filter})
SELECT name, parent, item_code, production_year, {R('net_rate', 6)} AS net_rate, 'valuation' AS rule, {R('value', 6)} AS floor FROM q_l WHERE net_rate < value
UNION ALL SELECT name, parent, item_code, production_year, {R('net_rate', 6)}, 'price list', {R('listed', 6)} FROM q_l WHERE net_rate < listed"""


def two_sides(kind: str, table: str, paid: tuple[str, str, str], received: tuple[str, str, str]) -> str:
    return f"""SELECT '{kind}' AS voucher_type, name AS voucher_no, {paid[0]} AS pa, {paid[1]} AS pc, {paid[2]} AS pr,
  {received[0]} AS ra, {received[1]} AS rc, {received[2]} AS rr FROM {table}"""


_USUAL = (("paid_amount", "paid_from_account_currency", "source_exchange_rate"),
          ("received_amount", "paid_to_account_currency", "target_exchange_rate"))
SIDES = " UNION ALL ".join(
    [two_sides(f"{k} Voucher", f"{k.lower()}_voucher", *_USUAL) for k in ("Receipt", "Payment", "Transfer")]
    + [two_sides("Clearing Voucher", "clearing_voucher", ("deducted_amount", "from_account_currency", "source_exchange_rate"),
                 ("added_amount", "to_account_currency", "target_exchange_rate"))]
)


def entry_line(kind: str, table: str, document: str, part: str, account: str, rate: str, debit: str, credit: str,
               party: tuple[str, str] | None = None, where: str = "TRUE") -> str:
    party_type, name = party or ("NULL", "NULL")
    return f"""SELECT '{kind}' AS custom_voucher_type, name AS custom_voucher_no, posting_date, remark, {document} AS document, '{part}' AS part,
  {account} AS account, CAST({party_type} AS VARCHAR) AS party_type, CAST({name} AS VARCHAR) AS party, {D(rate)} AS exchange_rate,
  {D(f'coalesce({debit}, 0)')} AS debit, {D(f'coalesce({credit}, 0)')} AS credit FROM {table} WHERE docstatus = 1 AND {where}"""


_RECEIPT = ("Receipt Voucher", "receipt_voucher")
_RD = "CASE WHEN receipt_from = 'Customer' THEN 'Payment Entry' ELSE 'Journal Entry' END"
_PAYMENT = ("Payment Voucher", "payment_voucher")
_PD = "CASE WHEN payment_to = 'Supplier' THEN 'Payment Entry' ELSE 'Journal Entry' END"
_TRANSFER = ("Transfer Voucher", "transfer_voucher")
_CLEARING = ("Clearing Voucher", "clearing_voucher")
_DEBT = ("Debt Voucher", "debt_voucher LEFT JOIN (SELECT name AS company, write_up_account, write_off_account FROM company) USING (company)")
_PARTY = ("party_type", "party")
_JE, _PE = "'Journal Entry'", "'Payment Entry'"
VOUCHER_LINES = " UNION ALL ".join([
    entry_line(*_RECEIPT, _RD, "main", "paid_from", "source_exchange_rate", "0", "abs(paid_amount)", _PARTY),
    entry_line(*_RECEIPT, _RD, "main", "paid_to", "target_exchange_rate", "abs(received_amount)", "0"),
    entry_line(*_RECEIPT, _JE, "charges", "paid_to", "source_exchange_rate", "0", "abs(banking_charges)", None, "banking_charges <> 0"),
    entry_line(*_RECEIPT, _JE, "charges", "paid_from", "target_exchange_rate", "abs(banking_charges)", "0", _PARTY, "banking_charges <> 0"),
    entry_line(*_PAYMENT, _PD, "main", "paid_from", "source_exchange_rate", "0", "abs(paid_amount)"),
    entry_line(*_PAYMENT, _PD, "main", "paid_to", "target_exchange_rate", "abs(received_amount)", "0", _PARTY),
    entry_line(*_TRANSFER, _PE, "main", "paid_from", "source_exchange_rate", "0", "abs(paid_amount)"),
    entry_line(*_TRANSFER, _PE, "main", "paid_to", "target_exchange_rate", "abs(received_amount)", "0"),
    entry_line(*_TRANSFER, _JE, "charges", "CASE WHEN sender = 1 THEN paid_from ELSE paid_to END",
               "CASE WHEN sender = 1 THEN source_exchange_rate ELSE target_exchange_rate END", "0", "abs(banking_charges)", None, "banking_charges <> 0"),
    entry_line(*_TRANSFER, _JE, "charges", "charge_account", "1", "abs(banking_charges)", "0", None, "banking_charges <> 0"),
    entry_line(*_CLEARING, _JE, "main", "from_account", "source_exchange_rate", "0", "abs(deducted_amount)", ("from_party_type", "from_party")),
    entry_line(*_CLEARING, _JE, "main", "to_account", "target_exchange_rate", "abs(added_amount)", "0", ("to_party_type", "to_party")),
    entry_line(*_DEBT, _JE, "main", "write_up_account", "1", "0", "abs(amount)", None, "type = 'Add'"),
    entry_line(*_DEBT, _JE, "main", "from_or_to_account", "exchange_rate", "abs(amount)", "0", _PARTY, "type = 'Add'"),
    entry_line(*_DEBT, _JE, "main", "from_or_to_account", "exchange_rate", "0", "abs(amount)", _PARTY, "type <> 'Add'"),
    entry_line(*_DEBT, _JE, "main", "write_off_account", "1", "round(abs(amount) * exchange_rate, 3)", "0", None, "type <> 'Add'"),
])


def cash_line(document: str, part: str, account: str, rate: str, debit: str, credit: str, where: str, party: bool = False) -> str:
    p = ("'Customer'", "customer") if party else ("NULL", "NULL")
    return f"""SELECT 'Sales Invoice' AS custom_voucher_type, name AS custom_voucher_no, posting_date,
  CAST(NULL AS VARCHAR) AS problem, '{document}' AS document, '{part}' AS part,
  {account} AS account, CAST({p[0]} AS VARCHAR) AS party_type, CAST({p[1]} AS VARCHAR) AS party, {D(rate)} AS exchange_rate,
  {D(debit)} AS debit, {D(credit)} AS credit FROM q_si WHERE NOT coalesce(other AND rest <= 0, FALSE) AND {where}"""


CASH = f"""WITH q_si AS (
  SELECT s.*, c.write_off_account, x.other, CASE WHEN x.other THEN custom_payment_value ELSE abs(grand_total) END AS amt,
    CASE WHEN x.other THEN abs(grand_total) - custom_payment_value END AS rest
  FROM sales_invoice s JOIN company c ON s.company = c.name
  JOIN (SELECT name AS n, custom_payment_value_is_different = 1 AND coalesce(custom_payment_value, 0) <> 0 AS other FROM sales_invoice) x ON s.name = x.n
  WHERE s.docstatus = 1) """ + " UNION ALL ".join([
    cash_line("Payment Entry", "main", "payment_account", "conversion_rate", "amt", "0", "is_paid = 1 AND is_return = 0"),
    cash_line("Payment Entry", "main", "debit_to", "conversion_rate", "0", "amt", "is_paid = 1 AND is_return = 0", True),
    cash_line("Journal Entry", "main", "payment_account", "conversion_rate", "0", "amt", "is_paid = 1 AND is_return = 1"),
    cash_line("Journal Entry", "main", "debit_to", "conversion_rate", "amt", "0", "is_paid = 1 AND is_return = 1", True),
    cash_line("Journal Entry", "write-off", "debit_to", "1", "0", "rest", "other AND rest > 0 AND is_return = 0", True),
    cash_line("Journal Entry", "write-off", "write_off_account", "1", "rest", "0", "other AND rest > 0 AND is_return = 0"),
    cash_line("Journal Entry", "write-off", "write_off_account", "1", "0", "rest", "other AND rest > 0 AND is_return = 1"),
    cash_line("Journal Entry", "write-off", "debit_to", "1", "rest", "0", "other AND rest > 0 AND is_return = 1", True),
    """SELECT 'Sales Invoice', name, posting_date, 'payment is not below the invoice', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM q_si WHERE other AND rest <= 0""",
])


def cost(kind: str, prefix: str, foreign: bool, where: str) -> str:
    currency = f"{prefix}_account_currency" if foreign else "NULL"
    rate = f"{prefix}_exchange_rate" if foreign else "NULL"
    return f"""SELECT name AS purchase_receipt, title AS receipt_title, '{kind}' AS description, {prefix}_account AS expense_account,
  CAST({currency} AS VARCHAR) AS account_currency, {D(rate)} AS exchange_rate, {D(f'{prefix}_amount')} AS amount
  FROM purchase_receipt WHERE docstatus = 1 AND {where}"""


COSTS = " UNION ALL ".join(
    [cost(k, p, True, f"{p}_amount <> 0") for k, p in (("Freight", "freight"), ("Inspection", "inspection"), ("Foreign Bank Charges", "foreign_bank_charges"))]
    + [cost("Local Bank Charges", "local_bank_charges", False, "local_bank_charges_amount <> 0"),
       cost("Clearance", "clearance", False, "TRUE"), cost("Transport", "transport", False, "TRUE")]
)


def counter(table: str, *facets: str) -> str:
    facet = " || '; ' || ".join(f"'{f}=' || coalesce(CAST({f} AS VARCHAR), '-')" for f in facets) or "''"
    return f"SELECT '{table}' AS document, docstatus, {facet} AS facet, count(*) AS n FROM {table} GROUP BY 1, 2, 3"


COUNTERS = " UNION ALL ".join([
    counter("sales_order", "delivery_status", "billing_status", "reservation_status"), counter("sales_invoice", "is_return"),
    counter("delivery_note", "billing_status"), counter("stock_entry", "stock_entry_type"), counter("purchase_receipt", "virtual_receipt"),
    counter("receipt_voucher"), counter("payment_voucher"), counter("transfer_voucher"), counter("clearing_voucher"),
    counter("debt_voucher"), counter("sales_adjustment_request"),
])

_ACCOUNT_KEYS = "(SELECT name AS account FROM account WHERE is_group = 0)"
_CUSTOMER_KEYS = "(SELECT name AS customer FROM customer_master)"
_PAIRS = """q_pairs AS (SELECT a.name AS pair_account, c.party AS pair_customer FROM account a CROSS JOIN (
  SELECT party FROM gl_entry WHERE party_type = 'Customer' GROUP BY party ORDER BY sum(debit + credit) DESC, party DESC LIMIT 1) c WHERE a.is_group = 0),
q_gl AS (SELECT p.pair_account, p.pair_customer, g.* FROM gl_entry g JOIN q_pairs p
  ON g.account = p.pair_account OR (g.party_type = 'Customer' AND g.party = p.pair_customer))"""

ORACLES: dict[str, str] = {
    "normalize_dim": f"SELECT {YEAR} AS production_year, count(*) AS n FROM sales_order_item GROUP BY 1",
    "stock_qty": f"WITH {STOCK} SELECT item_code, production_year, {D('actual_qty')} AS actual_qty FROM q_stock",
    "valuation_rate_ledger": f"WITH {RATE} SELECT item_code, {R('valuation_rate', 6)} AS valuation_rate FROM q_rate",
    "valuation_rate_bin": f"SELECT item_code, {R(ratio('sum(stock_value)', 'sum(actual_qty)'), 6)} AS valuation_rate FROM bin WHERE actual_qty > 0 GROUP BY 1",
    "reserved_qty": f"WITH {RESERVED} SELECT item_code, production_year, {D('qty_to_deliver')} AS qty_to_deliver FROM q_res",
    "reserved_qty_having": f"""SELECT i.item_code, coalesce(i.production_year, '') AS production_year, {D('sum(i.qty - i.delivered_qty)')} AS qty_to_deliver
FROM sales_order_item i JOIN sales_order o ON i.parent = o.name
WHERE i.docstatus = 1 AND o.docstatus = 1 AND o.status NOT IN ('Completed', 'Closed') GROUP BY 1, 2 HAVING sum(i.qty - i.delivered_qty) > 0""",
    "virtual_receipt_qty": f"WITH {VIRTUAL} SELECT item_code, production_year, {D('qty_to_receive')} AS qty_to_receive FROM q_virtual",
    "selling_price": f"WITH {PRICE} SELECT item_code, production_year, {D('price_list_rate')} AS price_list_rate, price_name FROM q_price",
    "item_dim_by_year": f"WITH {ITEM_YEARS} SELECT name AS item_code, item_name, brand, is_stock_item, tire_size, production_year FROM q_items",
    "custom_voucher_map": f"WITH {VOUCHER_MAP} SELECT vt AS voucher_type, vn AS voucher_no, ct AS custom_voucher_type, cn AS custom_voucher_no FROM q_map",
    "exclude_system_je": f"SELECT account, voucher_type, voucher_no, {D('debit')} AS debit, {D('credit')} AS credit FROM gl_entry WHERE voucher_no NOT IN {SYSTEM}",
    "opening_balance": f"WITH {opening('gl_entry', 'account', _ACCOUNT_KEYS)} SELECT account, {D('debit')} AS debit, {D('credit')} AS credit FROM q_opening",
    "period_transactions": f"""WITH {period('gl_entry', 'account')} SELECT account, posting_date, voucher_type, voucher_no, remarks,
{D('debit')} AS debit, {D('credit')} AS credit FROM q_period""",
    "statement_total": f"""WITH {statement('gl_entry', 'account', _ACCOUNT_KEYS, True, 'gl_entry')}
SELECT account, {D('debit')} AS debit, {D('credit')} AS credit, {D('balance')} AS balance FROM q_lines WHERE row_kind = 2""",
    "running_balance": f"""WITH {statement('gl_entry', 'account', _ACCOUNT_KEYS)}
SELECT account, row_kind, posting_date, voucher_no, remarks, {D('balance')} AS balance FROM q_lines""",
    "translate_voucher_type": f"""WITH {period('gl_entry', 'account')}, {WORDS}
SELECT account, voucher_type, voucher_no, coalesce(w.word, voucher_type) AS translated_voucher_type FROM q_period LEFT JOIN q_words w ON voucher_type = w.source_text""",
    "against_party": """SELECT 'Transfer Voucher' AS voucher_type, name AS voucher_no, paid_to AS against FROM transfer_voucher WHERE docstatus = 1
UNION ALL SELECT 'Payment Voucher', name, CASE WHEN party_type IS NOT NULL AND party_type <> '' THEN party_name ELSE paid_to END FROM payment_voucher WHERE docstatus = 1
UNION ALL SELECT 'Receipt Voucher', name, CASE WHEN party_type IS NOT NULL AND party_type <> '' THEN party_name ELSE paid_from END FROM receipt_voucher WHERE docstatus = 1
UNION ALL SELECT 'Sales Invoice', name, customer_name FROM sales_invoice WHERE docstatus = 1 AND is_paid = 1""",
    "invoice_order_link": """SELECT i.parent AS sales_invoice, min(i.sales_order) AS sales_order FROM sales_invoice_item i JOIN sales_invoice s ON i.parent = s.name
WHERE i.docstatus = 1 AND s.docstatus = 1 AND i.qty > 0 AND s.is_return = 0 AND i.sales_order IS NOT NULL AND i.sales_order <> '' GROUP BY 1""",
    "party_balance": f"WITH {BALANCE} SELECT customer, {D('balance')} AS balance FROM q_bal",
    "unbilled_orders": f"WITH {unbilled()} SELECT customer, {R('unbilled', 4)} AS unbilled FROM q_unb",
    "credit_limit": f"WITH {LIMIT} SELECT customer, {D('credit_limit')} AS credit_limit FROM q_limit",
    "overdue": f"WITH {TERMS}, {OVERDUE} SELECT customer, {D('overdue')} AS overdue FROM q_over WHERE overdue IS NOT NULL",
    "potential_overdue": f"WITH {TERMS}, {OVERDUE} SELECT customer, {D('potential_overdue')} AS potential_overdue FROM q_over WHERE potential_overdue IS NOT NULL",
    "sales_by_item": f"WITH {sales('i.item_code')} SELECT item_code, {D('qty')} AS qty, {D('net_amount')} AS net_amount FROM q_sales",
    "sales_by_customer": f"WITH {sales('s.customer')} SELECT customer, {D('qty')} AS qty, {D('net_amount')} AS net_amount FROM q_sales",
    "cogs_by_item": f"WITH {COGS_ITEM} SELECT item_code, {D('cost')} AS cost FROM q_cogs",
    "cogs_by_customer": f"WITH {COGS_CUSTOMER} SELECT customer, {D('cost')} AS cost FROM q_cogs",
    "movement_sums": f"""WITH {MOVES} SELECT item_code, {D('opening_stock')} AS opening_stock, {D('purchases')} AS purchases, {D('sales')} AS sales,
{D('ending_stock')} AS ending_stock FROM q_moves""",
}

ORACLES |= {
    "opening_stock_reclass": f"WITH {MOVES} SELECT item_code, {D('opening_stock')} AS opening_stock FROM q_moves",
    "markup_text": f"""WITH {sales('i.item_code')}, {COGS_ITEM}, q_m AS (
  SELECT coalesce(s.item_code, c.item_code) AS item_code, coalesce(s.net_amount, 0) AS a, coalesce(c.cost, 0) AS c
  FROM q_sales s FULL JOIN q_cogs c ON s.item_code = c.item_code)
SELECT item_code, {R(f"{ratio('a - c', 'c')} * 100", 1)} AS markup_percent, {percent_text('a - c', 'c')} AS markup FROM q_m""",
    "master_counters": """SELECT 'account' AS document, CASE WHEN disabled = 1 THEN 'disabled' ELSE 'enabled' END AS state, count(*) AS n
FROM account WHERE is_group = 0 AND restrict_account_view = 'No' GROUP BY 1, 2
UNION ALL SELECT 'customer', CASE WHEN disabled = 1 THEN 'disabled' ELSE 'enabled' END, count(*) FROM customer_master GROUP BY 1, 2""",
}

_ACCOUNT_BALANCES = f"""SELECT a.account_number, a.account_name, a.parent_account,
  {D('CASE WHEN coalesce(g.d, 0) > coalesce(g.c, 0) THEN g.d - g.c ELSE 0 END')} AS debit,
  {D('CASE WHEN coalesce(g.c, 0) > coalesce(g.d, 0) THEN g.c - g.d ELSE 0 END')} AS credit
FROM account a LEFT JOIN (SELECT account, sum(debit) AS d, sum(credit) AS c FROM gl_entry WHERE is_cancelled = 0 AND posting_date <= {TO} GROUP BY 1) g
  ON a.name = g.account WHERE a.restrict_account_view = 'No' AND a.is_group = 0"""

ORACLES |= {
    "account_balances": _ACCOUNT_BALANCES,
    "with_total_row": f"""WITH q_ab AS ({_ACCOUNT_BALANCES}) SELECT *, 0 AS is_total FROM q_ab
UNION ALL SELECT NULL, 'Total', NULL, sum(debit), sum(credit), 1 FROM q_ab""",
    "account_statement": f"""WITH {statement('gl_entry', 'account', _ACCOUNT_KEYS, True, 'gl_entry')}
SELECT l.account, row_kind, {LINE_OUT}, remarks, CASE WHEN row_kind < 2 THEN a.account_name END AS account_name, voucher_type
FROM q_lines l LEFT JOIN account a ON l.account = a.name""",
    "unexplained_balance": f"""WITH {statement('gl_entry', 'account', _ACCOUNT_KEYS, True, 'gl_entry')}, q_last AS (
  SELECT account, coalesce(max(CASE WHEN row_kind = 2 THEN balance END), 0) AS total, sum(CASE WHEN row_kind < 2 THEN debit - credit END) AS running
  FROM q_lines GROUP BY 1) SELECT account, {R('total - running', 2)} AS unexplained FROM q_last""",
    "cash_bank_statement": f"""WITH q_cash AS (SELECT g.* FROM gl_entry g JOIN account a ON g.account = a.name WHERE a.account_type IN ('Cash', 'Bank') AND a.is_group = 0),
q_keys AS (SELECT name AS account FROM account WHERE is_group = 0 AND account_type IN ('Cash', 'Bank')),
{statement('q_cash', 'account', 'q_keys', True, 'q_cash')}, q_against AS ({ORACLES['against_party']})
SELECT l.account, row_kind, {LINE_OUT.replace('voucher_no', 'l.voucher_no')}, a.against, remarks, l.voucher_type FROM q_lines l
LEFT JOIN q_against a ON l.voucher_type = a.voucher_type AND l.voucher_no = a.voucher_no""",
    "customer_statement": f"""WITH q_party AS (SELECT party AS customer, * FROM gl_entry WHERE party IS NOT NULL),
q_cust AS (SELECT * FROM q_party WHERE party_type = 'Customer'),
{statement('q_cust', 'customer', _CUSTOMER_KEYS, False, 'q_party')},
q_link AS (SELECT i.parent AS si, min(i.sales_order) AS so FROM sales_invoice_item i JOIN sales_invoice s ON i.parent = s.name
  WHERE i.docstatus = 1 AND s.docstatus = 1 AND i.qty > 0 AND s.is_return = 0 AND i.sales_order <> '' AND s.posting_date BETWEEN {FROM} AND {TO} GROUP BY 1)
SELECT l.customer, row_kind, {LINE_OUT}, k.so AS sales_order,
  CASE WHEN row_kind = 0 THEN 'رصيد إفتتاحي - عميل (' || c.customer_name || ')' ELSE remarks END AS remarks,
  CASE WHEN row_kind < 2 THEN c.customer_name END AS customer_name, voucher_type
FROM q_lines l LEFT JOIN customer_master c ON l.customer = c.name
LEFT JOIN q_link k ON l.voucher_type = 'Sales Invoice' AND l.voucher_no = k.si""",
    "consolidated_statement": f"""WITH {_PAIRS}, {statement('q_gl', 'pair_account, pair_customer', 'q_pairs')}
SELECT pair_account, pair_customer, row_kind, {LINE_OUT}, remarks, a.account_name, c.customer_name, voucher_type FROM q_lines l
LEFT JOIN account a ON l.pair_account = a.name LEFT JOIN customer_master c ON l.pair_customer = c.name""",
    "consolidated_parts": f"""WITH q_member AS (
  SELECT account AS part_account, NULL::VARCHAR AS part_customer, * FROM gl_entry WHERE account IS NOT NULL
  UNION ALL SELECT NULL, party, * FROM gl_entry WHERE party_type = 'Customer' AND party IS NOT NULL
  UNION ALL SELECT account, party, * FROM gl_entry WHERE party_type = 'Customer' AND party IS NOT NULL AND account IS NOT NULL),
q_everyone AS (SELECT name AS part_account, NULL::VARCHAR AS part_customer FROM account WHERE is_group = 0 UNION ALL SELECT NULL, name FROM customer_master),
{statement('q_member', 'part_account, part_customer', 'q_everyone')}
SELECT l.part_account, l.part_customer, row_kind, l.posting_date, l.voucher_type, l.voucher_no, l.remarks, {D('l.debit')} AS debit, {D('l.credit')} AS credit, {D('balance')} AS balance,
  coalesce(q_n.n, 0) AS n
FROM q_lines l LEFT JOIN q_period q_n ON row_kind = 1 AND l.part_account IS NOT DISTINCT FROM q_n.part_account AND l.part_customer IS NOT DISTINCT FROM q_n.part_customer
  AND l.posting_date = q_n.posting_date AND l.voucher_type = q_n.voucher_type AND l.voucher_no = q_n.voucher_no AND l.remarks IS NOT DISTINCT FROM q_n.remarks""",
    "customer_balances": BALANCES,
    "customer_balances_overdue": f"{BALANCES} WHERE round(overdues, 2) > 0",
    "customer_balances_over_credit": f"{BALANCES} WHERE q_cb.credit_limit > 0 AND round(q_cb.credit_limit, 2) < round(CAST(balance_w_so AS DECIMAL(28,4)), 2)",
    "customer_balances_credit": f"{BALANCES} WHERE round(q_cb.balance_wo_so, 2) < 0",
    "customer_performance": f"""WITH {BALANCE}, {unbilled()}, {sales('s.customer')}, {COGS_CUSTOMER}, q_cp AS (
  SELECT c.name AS customer, c.customer_name, c.customer_group, coalesce(s.qty, 0) AS sales_qty, coalesce(s.net_amount, 0) AS sales_amount,
    coalesce(g.cost, 0) AS cogs, coalesce(b.balance, 0) AS balance_wo_so, coalesce(u.unbilled, 0) AS ub
  FROM customer_master c LEFT JOIN q_bal b ON c.name = b.customer LEFT JOIN q_unb u ON c.name = u.customer
  LEFT JOIN q_sales s ON c.name = s.customer LEFT JOIN q_cogs g ON c.name = g.customer)
SELECT customer, customer_name, customer_group, {D('sales_qty')} AS sales_qty, {D('sales_amount')} AS sales_amount, {D('cogs')} AS cogs,
  {percent_text('sales_amount - cogs', 'sales_amount')} AS markup, {D('balance_wo_so')} AS balance_wo_so, {R('ub', 4)} AS orders_to_bill,
  {R('CAST(balance_wo_so AS DOUBLE) + ub', 4)} AS balance_w_so
FROM q_cp WHERE abs(sales_qty) + abs(sales_amount) + abs(cogs) + abs(balance_wo_so) + ub > 0""",
    "item_performance": f"""WITH {ITEM_RESULTS} SELECT item_code, item_name, brand, {D('sales_qty')} AS sales_qty, {D('sales_amount')} AS sales_amount,
  {D('sales_cost')} AS sales_cost, {D('sales_amount - sales_cost')} AS gross_profit,
  {percent_text('sales_amount - sales_cost', 'sales_cost')} AS markup, {D('stock_qty')} AS stock_qty FROM q_ir""",
    "brand_performance": f"""WITH {ITEM_RESULTS}, q_br AS (SELECT brand, sum(sales_qty) AS sales_qty, sum(sales_amount) AS sales_amount,
  sum(sales_cost) AS sales_cost, sum(stock_qty) AS stock_qty FROM q_ir GROUP BY 1)
SELECT brand, {D('sales_qty')} AS sales_qty, {D('sales_amount')} AS sales_amount, {D('sales_cost')} AS sales_cost,
  {D('sales_amount - sales_cost')} AS gross_profit, {percent_text('sales_amount - sales_cost', 'sales_cost')} AS markup, {D('stock_qty')} AS stock_qty FROM q_br""",
    "item_transactions": f"""WITH {ITEM_MOVES} SELECT name AS item_code, item_name, item_group, brand, country_of_origin, {D('o')} AS opening_stock,
  {D('p')} AS purchases, {D('s')} AS sales, {D('e')} AS ending_stock FROM q_im""",
    "brand_transactions": f"""WITH {ITEM_MOVES} SELECT brand, item_group, country_of_origin, {D('sum(o)')} AS opening_stock, {D('sum(p)')} AS purchases,
  {D('sum(s)')} AS sales, {D('sum(e)')} AS ending_stock FROM q_im GROUP BY 1, 2, 3""",
    "item_ledger": f"""WITH {WORDS}, q_v AS (
  SELECT 'Sales Invoice' AS vt, s.name AS vn, c.customer_name FROM sales_invoice s JOIN customer_master c ON s.customer = c.name
    WHERE s.docstatus = 1 AND s.update_stock = 1 AND s.posting_date BETWEEN {FROM} AND {TO}
  UNION ALL SELECT 'Delivery Note', d.name, c.customer_name FROM delivery_note d JOIN customer_master c ON d.customer = c.name
    WHERE d.docstatus = 1 AND d.posting_date BETWEEN {FROM} AND {TO}),
q_rows AS (
  SELECT i.name AS item_code, 0 AS row_kind, NULL::DATE AS posting_date, 'Opening' AS voucher_type, NULL::VARCHAR AS voucher_no, NULL::VARCHAR AS customer_name,
    NULL::VARCHAR AS production_year, coalesce(sum(CASE WHEN e.actual_qty > 0 THEN e.actual_qty END), 0) AS qty_in,
    coalesce(-sum(CASE WHEN e.actual_qty < 0 THEN e.actual_qty END), 0) AS qty_out
  FROM item i LEFT JOIN stock_ledger_entry e ON i.name = e.item_code AND e.is_cancelled = 0 AND e.posting_date < {FROM} GROUP BY 1
  UNION ALL SELECT e.item_code, 1, e.posting_date, e.voucher_type, e.voucher_no, v.customer_name, coalesce(e.production_year, ''),
    sum(CASE WHEN e.actual_qty > 0 THEN e.actual_qty ELSE 0 END), -sum(CASE WHEN e.actual_qty < 0 THEN e.actual_qty ELSE 0 END)
  FROM stock_ledger_entry e LEFT JOIN q_v v ON e.voucher_type = v.vt AND e.voucher_no = v.vn
  WHERE e.is_cancelled = 0 AND e.posting_date BETWEEN {FROM} AND {TO} GROUP BY 1, 2, 3, 4, 5, 6, 7)
SELECT r.item_code, row_kind, posting_date, coalesce(w.word, voucher_type) AS translated_voucher_type, voucher_no, customer_name, production_year,
  {D('qty_in')} AS qty_in, {D('qty_out')} AS qty_out,
  {D('sum(qty_in - qty_out) OVER (PARTITION BY r.item_code ORDER BY posting_date NULLS FIRST, voucher_no NULLS FIRST)')} AS balance, i.item_name, voucher_type
FROM q_rows r JOIN item i ON r.item_code = i.name LEFT JOIN q_words w ON voucher_type = w.source_text""",
    "item_reservations": f"""SELECT l.item_code, i.item_name, i.brand, o.name AS sales_order, o.transaction_date, c.customer_name,
  coalesce(l.production_year, '') AS production_year, {D('sum(l.qty - l.delivered_qty)')} AS qty_to_deliver, max(l.rate) AS rate
FROM sales_order_item l JOIN sales_order o ON l.parent = o.name JOIN item i ON l.item_code = i.name JOIN customer_master c ON o.customer = c.name
WHERE o.docstatus = 1 AND l.docstatus = 1 AND o.status NOT IN ('Completed', 'Closed') AND l.qty - l.delivered_qty > 0 GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "item_sales_ledger": f"""SELECT l.item_code, i.item_name, l.parent AS sales_invoice, s.posting_date, s.customer, c.customer_name,
  coalesce(l.production_year, '') AS production_year, {D('CASE WHEN l.qty < 0 THEN -l.qty ELSE 0 END')} AS in_qty,
  {D('CASE WHEN l.qty > 0 THEN l.qty ELSE 0 END')} AS out_qty, {D('l.rate')} AS rate
FROM sales_invoice_item l JOIN sales_invoice s ON l.parent = s.name JOIN item i ON l.item_code = i.name JOIN customer_master c ON s.customer = c.name
WHERE l.docstatus = 1 AND s.docstatus = 1 AND s.is_opening = 'No' AND s.posting_date BETWEEN {FROM} AND {TO}""",
    "receipt_details": f"""SELECT r.name AS purchase_receipt, r.title AS shipment_name, l.item_code, l.item_name, l.production_year, l.brand, {D('sum(l.qty)')} AS qty
FROM purchase_receipt_item l JOIN purchase_receipt r ON l.parent = r.name JOIN item i ON l.item_code = i.name
WHERE l.docstatus <> 2 AND r.docstatus <> 2 AND l.qty > 0 AND r.is_return = 0 GROUP BY 1, 2, 3, 4, 5, 6""",
    "stock_ageing": f"""WITH {RATE}, q_docs AS (
  SELECT name FROM purchase_receipt WHERE docstatus = 1 AND is_return = 0 AND posting_date <= {TO}
  UNION SELECT name FROM purchase_invoice WHERE docstatus = 1 AND is_return = 0 AND update_stock = 1 AND posting_date <= {TO}
  UNION SELECT name FROM stock_entry WHERE docstatus = 1 AND stock_entry_type = 'Material Receipt' AND posting_date <= {TO}),
q_rec AS (SELECT item_code, posting_date, sum(actual_qty) AS q FROM (
  SELECT item_code, posting_date, actual_qty FROM legacy_purchase_ledger
  UNION ALL SELECT item_code, posting_date, actual_qty FROM stock_ledger_entry WHERE is_cancelled = 0 AND actual_qty > 0
    AND voucher_type IN ('Purchase Receipt', 'Purchase Invoice', 'Stock Entry') AND voucher_no IN (SELECT name FROM q_docs) AND posting_date <= {TO}) GROUP BY 1, 2),
q_rt AS (SELECT r.*, b.actual_qty AS bal, sum(r.q) OVER (PARTITION BY r.item_code ORDER BY r.posting_date DESC) AS rt FROM q_rec r JOIN q_rate b ON r.item_code = b.item_code),
q_os AS (SELECT item_code, CASE WHEN bal >= rt THEN q ELSE greatest(q - (rt - bal), 0) END AS os, date_diff('day', posting_date, {TO}) + 1 AS age FROM q_rt),
q_age AS (SELECT item_code, {ratio('sum(os * age)', 'sum(os)')} AS avg_age FROM q_os WHERE os > 0 GROUP BY 1)
SELECT b.item_code, i.item_name, i.item_group, i.country_of_origin AS origin, i.brand, {D('b.actual_qty')} AS actual_qty,
  {R('b.valuation_rate', 6)} AS valuation_rate, {R('a.avg_age', 6)} AS avg_age
FROM q_rate b JOIN item i ON b.item_code = i.name JOIN q_age a ON b.item_code = a.item_code WHERE a.avg_age >= 0""",
    "stock_balance": stock_report(
        f"""{D('s.actual_qty')} AS actual_qty,
  {D(f'CASE WHEN i.is_stock_item = 1 AND {_LEFT} > 0 THEN coalesce(r.qty_to_deliver, 0) ELSE 0 END')} AS qty_to_deliver,
  {D(f's.actual_qty - CASE WHEN i.is_stock_item = 1 AND {_LEFT} > 0 THEN coalesce(r.qty_to_deliver, 0) ELSE 0 END')} AS available_qty""", "", "TRUE"),
    "stock_balance_strict": stock_report(
        f"{D('s.actual_qty')} AS actual_qty, {D('coalesce(r.qty_to_deliver, 0)')} AS qty_to_deliver, {D(_LEFT)} AS available_qty", "",
        f"i.is_stock_item = 1 AND {_LEFT} > 0"),
    "available_items": stock_report(f"{D('p.price_list_rate')} AS price_list_rate", _PRICE_JOIN, f"i.is_stock_item = 1 AND {_LEFT} >= 1"),
    "stock_balance_prices": f"{BY_YEAR} AND coalesce(s.actual_qty, 0) >= 1",
    "stock_balance_prices_future": f"{BY_YEAR} AND coalesce(s.actual_qty, 0) - coalesce(r.qty_to_deliver, 0) + coalesce(v.qty_to_receive, 0) >= 0",
    "stock_balance_cost_prices": stock_report(
        f"""{D('s.actual_qty')} AS actual_qty, {D('coalesce(r.qty_to_deliver, 0)')} AS qty_to_deliver, {D(_LEFT)} AS available_qty,
  {D('p.price_list_rate')} AS price_list_rate, {R('v.valuation_rate', 6)} AS valuation_rate""",
        f"{_PRICE_JOIN} LEFT JOIN q_rate v ON s.item_code = v.item_code", "i.is_stock_item = 1"),
    "available_to_promise": atp_out("item_code, production_year, warehouse"),
    "available_to_promise_any_year": atp_out("item_code, warehouse"),
    "order_shortages": f"""WITH {atp('item_code, production_year, warehouse')}, q_line AS (
  SELECT l.parent, l.name, o.customer, l.item_code, coalesce(l.production_year, '') AS production_year, o.set_warehouse AS warehouse, l.qty,
    o.reservation_status = 'Reserve against Future Receipts' AS later
  FROM sales_order_item l JOIN sales_order o ON l.parent = o.name
  WHERE l.docstatus = 1 AND o.docstatus = 1 AND o.status NOT IN ('Completed', 'Closed')
), q_years AS (
  SELECT n.name, sum(a.stock) AS s, sum(a.expected) AS e, sum(a.reserved_now) AS n, sum(a.reserved_future) AS f, any_value(n.later) AS later
  FROM q_line n JOIN q_atp a ON n.item_code = a.item_code AND n.warehouse = a.warehouse AND (n.production_year = '' OR n.production_year = a.production_year)
  GROUP BY n.name
), q_need AS (
  SELECT l.*, CASE WHEN y.later THEN y.s + y.e - y.n - y.f ELSE y.s - y.n - greatest(y.f - y.e, 0) END AS available
  FROM q_line l JOIN q_years y ON l.name = y.name)
SELECT parent, name, customer, item_code, production_year, warehouse, {D('qty')} AS qty, {D('-available')} AS shortage FROM q_need WHERE available < 0""",
    "unvirtualize_check": f"""WITH {atp('item_code, production_year, warehouse')}
SELECT l.parent, l.name, l.item_code, coalesce(l.production_year, '') AS production_year, l.warehouse, {D('l.qty')} AS qty,
  {D('a.future_available')} AS future_available, {D('l.qty - a.future_available')} AS missing
FROM purchase_receipt_item l JOIN purchase_receipt r ON l.parent = r.name
JOIN q_atp a ON l.item_code = a.item_code AND coalesce(l.production_year, '') = a.production_year AND l.warehouse = a.warehouse
WHERE l.docstatus = 0 AND r.docstatus = 0 AND r.virtual_receipt = 1 AND a.future_available - l.qty < 0""",
    "customer_credit_status": f"""WITH {BALANCE.replace(f' AND posting_date <= {TO}', '')}, {unbilled(False)}, {LIMIT}, {TERMS}, {OVERDUE}, q_cs AS (
  SELECT c.name AS customer, coalesce(b.balance, 0) AS balance, coalesce(o.overdue, 0) AS overdue, coalesce(o.potential_overdue, 0) AS potential_overdue,
    coalesce(l.credit_limit, 0) AS credit_limit, coalesce(u.unbilled, 0) AS unbilled, {R('CAST(coalesce(b.balance, 0) AS DOUBLE) + coalesce(u.unbilled, 0)', 4)} AS exposure
  FROM customer_master c LEFT JOIN q_bal b ON c.name = b.customer LEFT JOIN q_unb u ON c.name = u.customer
  LEFT JOIN q_limit l ON c.name = l.customer LEFT JOIN q_over o ON c.name = o.customer)
SELECT customer, {D('balance')} AS balance, {D('overdue')} AS overdue, {D('potential_overdue')} AS potential_overdue,
  {D('credit_limit')} AS credit_limit, {R('unbilled', 4)} AS unbilled,
  CASE WHEN (exposure > credit_limit AND credit_limit > 0) OR overdue > 0 THEN '#FF0000'
    WHEN (exposure > credit_limit * 0.85 AND credit_limit > 0) OR potential_overdue > 0 THEN '#FFA500' ELSE '#008000' END AS indicator FROM q_cs""",
    "overdue_blocks": f"""WITH {TERMS}, q_owed AS (SELECT s.customer, sum(s.outstanding_amount) AS outstanding FROM sales_invoice s JOIN q_terms t ON s.customer = t.customer
  WHERE s.docstatus = 1 AND t.payment_terms IS NOT NULL AND s.posting_date < {TO} - t.days GROUP BY 1)
SELECT t.customer, CASE WHEN t.payment_terms IS NULL THEN 'no terms' ELSE 'overdue' END AS reason, {D('o.outstanding')} AS outstanding
FROM q_terms t LEFT JOIN q_owed o ON t.customer = o.customer WHERE t.payment_terms IS NULL OR (o.outstanding > 0 AND t.bypass_overdue_check <> 1)""",
    "price_metrics_refresh": f"""WITH {METRICS} SELECT name, item_code, production_year, {R('stock_valuation_rate', 6)} AS stock_valuation_rate,
{D('stock_qty')} AS stock_qty, {D('available_qty')} AS available_qty FROM q_ip""",
    "price_metrics_stream": f"""WITH {METRICS} SELECT name, item_code, production_year, {R('stock_valuation_rate', 6)} AS stock_valuation_rate,
{D('stock_qty')} AS stock_qty, {D('available_qty')} AS available_qty FROM q_ip
WHERE item_code IN (SELECT 'I-' || CAST(l_partkey AS VARCHAR) FROM lineitem)""",
    "price_sheet_import": f"""WITH {METRICS} SELECT name, item_code, production_year, price_list, {D("CASE WHEN selling = 1 THEN CAST(ceil(round(CAST(stock_valuation_rate AS DECIMAL(28,9)) * 1.15, 6)) AS DECIMAL(21,3)) ELSE price_list_rate END")} AS price_list_rate
FROM q_ip""",
    "price_floor_violations": price_floor("sales_order_item", "sales_order", True, "valuation_rate", "").replace("net_rate < value", f"net_rate < value AND {CHECKED}"),
    "invoice_price_violations": price_floor("sales_invoice_item", "sales_invoice", False, "incoming_rate", "AND o.is_return = 0"),
    "price_increase": f"""WITH {METRICS} SELECT name, {D('ceil(round(CAST(stock_valuation_rate AS DECIMAL(28,9)) * 1.15, 6))')} AS price_list_rate
FROM q_ip WHERE selling = 1""",
    "receipt_pricing_worksheet": f"""WITH {WORKSHEET} SELECT purchase_receipt, item_code, item_name, brand, production_year, receipt_qty,
  {R('receipt_valuation_rate', 4)} AS receipt_valuation_rate, stock_qty, available_qty, {R('stock_valuation_rate', 4)} AS stock_valuation_rate,
  selling_price, price_name FROM q_ws""",
    "proposed_price": f"""WITH {WORKSHEET} SELECT purchase_receipt, item_code, production_year,
  {D('ceil(round(receipt_valuation_rate / 0.8::DOUBLE, 6))')} AS proposed_price FROM q_ws""",
    "price_upsert": f"""SELECT p.name, p.item_code, p.production_year, p.price_list, {D('coalesce(c.price, p.price_list_rate)')} AS price_list_rate,
  CASE WHEN c.price <> p.price_list_rate THEN 'update' ELSE 'keep' END AS action
FROM item_price p LEFT JOIN price_change c ON p.name = c.name
UNION ALL SELECT c.name, c.item_code, c.production_year, 'Standard Selling', {D('c.price')}, 'insert' FROM price_change c
WHERE c.name IS NULL OR c.name NOT IN (SELECT name FROM item_price)""",
    "price_grid_completion": f"""WITH q_want AS (SELECT DISTINCT item_code, {YEAR} AS y FROM purchase_receipt_item)
SELECT w.item_code, l.name AS price_list, w.y AS production_year, 0::DOUBLE AS price_list_rate, 1 AS selling, i.item_name, i.brand, i.description AS item_description
FROM q_want w CROSS JOIN price_list l LEFT JOIN item i ON w.item_code = i.name
WHERE l.selling = 1 AND NOT EXISTS (SELECT 1 FROM item_price p WHERE p.item_code = w.item_code AND p.price_list = l.name AND coalesce(p.production_year, '') = w.y)""",
    "item_price_defaults": """SELECT i.name AS item_code, l.name AS price_list, 0::DOUBLE AS price_list_rate, 1 AS selling, i.item_name, i.brand, i.description AS item_description
FROM item i CROSS JOIN price_list l WHERE l.selling = 1 AND NOT EXISTS (SELECT 1 FROM item_price p WHERE p.item_code = i.name AND p.price_list = l.name)""",
    "price_attribute_sync": """SELECT p.name, CASE WHEN l.selling = 1 THEN i.item_name ELSE p.item_name END AS item_name,
  CASE WHEN l.selling = 1 THEN i.brand ELSE p.brand END AS brand, CASE WHEN l.selling = 1 THEN i.description END AS item_description
FROM item_price p JOIN item i ON p.item_code = i.name JOIN price_list l ON p.price_list = l.name""",
    "duplicate_prices": f"""SELECT item_code, price_list, {YEAR} AS production_year, coalesce(packing_unit, 0) AS packing_unit, count(*) AS n, min(name) AS first_name
FROM item_price GROUP BY item_code, price_list, {YEAR}, coalesce(packing_unit, 0), coalesce(uom, ''), coalesce(CAST(valid_from AS VARCHAR), ''),
  coalesce(CAST(valid_upto AS VARCHAR), ''), coalesce(customer, ''), coalesce(supplier, ''), coalesce(batch_no, '') HAVING count(*) > 1""",
    "price_segments": f"""WITH {METRICS} SELECT name, CAST(stock_qty > 0 AS INT) AS in_stock, CAST(available_qty > 0 AS INT) AS available,
  CAST(price_list_rate = 0 AND stock_valuation_rate > 0 AND selling = 1 AS INT) AS non_priced,
  CAST(price_list_rate > 0 AND stock_valuation_rate > 0 AND price_list_rate < stock_valuation_rate AND selling = 1 AS INT) AS non_profitable FROM q_ip""",
    "price_lookup": f"""WITH q_i AS (SELECT item_code, min(price_list_rate) AS r FROM item_price WHERE price_list = 'Standard Selling' GROUP BY 1),
q_y AS (SELECT item_code, {YEAR} AS y, min(price_list_rate) AS r FROM item_price WHERE selling = 1 GROUP BY 1, 2)
SELECT l.name, l.item_code, coalesce(l.production_year, '') AS production_year, {D('i.r')} AS list_price, {D('y.r')} AS return_price
FROM sales_invoice_item l LEFT JOIN q_i i ON l.item_code = i.item_code LEFT JOIN q_y y ON l.item_code = y.item_code AND coalesce(l.production_year, '') = y.y""",
    "pending_delivery_lines": f"""SELECT l.parent AS against_sales_order, o.customer, l.name AS so_detail, l.item_code, l.production_year, {D('l.qty - l.delivered_qty')} AS qty,
  o.set_warehouse AS warehouse, l.rate, l.price_list_rate, CASE WHEN coalesce(l.brand, '') <> '' THEN l.brand ELSE coalesce(i.brand, '') END AS brand
FROM sales_order_item l JOIN sales_order o ON l.parent = o.name LEFT JOIN item i ON l.item_code = i.name
WHERE l.docstatus = 1 AND o.docstatus = 1 AND l.qty - l.delivered_qty > 0
  AND l.parent NOT IN (SELECT against_sales_order FROM delivery_note_item WHERE docstatus = 0)""",
    "pending_billing_lines": f"""SELECT l.parent AS delivery_note, o.customer, l.name AS dn_detail, l.so_detail, l.against_sales_order AS sales_order, l.item_code,
  l.production_year, {D('l.qty - l.billed_qty')} AS qty, o.set_warehouse AS warehouse, l.rate, l.price_list_rate
FROM delivery_note_item l JOIN delivery_note o ON l.parent = o.name WHERE l.docstatus = 1 AND o.docstatus = 1 AND l.qty - l.billed_qty > 0
  AND l.parent NOT IN (SELECT delivery_note FROM sales_invoice_item WHERE docstatus = 0 AND delivery_note IS NOT NULL)""",
    "billed_qty_rollup": f"""WITH q_b AS (SELECT i.so_detail, i.dn_detail, i.qty FROM sales_invoice_item i JOIN sales_invoice s ON i.parent = s.name
  WHERE i.docstatus = 1 AND s.docstatus = 1 AND s.is_return = 0 AND s.update_stock = 0 AND s.is_opening <> 'Yes')
SELECT 'Sales Order Item' AS line_type, so_detail AS line, {D('sum(qty)')} AS billed_qty FROM q_b WHERE so_detail IS NOT NULL GROUP BY 2
UNION ALL SELECT 'Delivery Note Item', dn_detail, {D('sum(qty)')} FROM q_b WHERE dn_detail IS NOT NULL GROUP BY 2""",
    "delivery_billing_status": f"""WITH q_d AS (SELECT parent, sum(billed_qty) AS b, sum(qty) AS q FROM delivery_note_item GROUP BY 1)
SELECT parent AS delivery_note, CASE WHEN b = 0 THEN 0 WHEN b > 0 AND b < q THEN {R(f"{ratio('b', 'q')} * 100", 6)} ELSE 100 END AS per_billed,
  CASE WHEN b = 0 THEN 'Not Billed' WHEN b > 0 AND b < q THEN 'Partly Billed' ELSE 'Fully Billed' END AS billing_status FROM q_d""",
    "orders_to_close": """WITH q_l AS (SELECT parent, bool_and(qty = billed_qty) AS done FROM sales_order_item GROUP BY 1)
SELECT o.name, CASE WHEN l.done AND o.per_billed < 100 THEN 'all lines billed' ELSE 'delivered, partly billed' END AS reason
FROM sales_order o LEFT JOIN q_l l ON o.name = l.parent
WHERE o.docstatus = 1 AND o.status <> 'Closed' AND ((coalesce(l.done, FALSE) AND o.per_billed < 100) OR (o.billing_status = 'Partly Billed' AND o.delivery_status = 'Fully Delivered'))""",
    "delivery_status": """SELECT name, CASE WHEN status IN ('On Hold', 'Closed') THEN status WHEN docstatus <> 1 THEN NULL WHEN per_delivered = 0 THEN 'Not Delivered'
  WHEN per_delivered < 100 THEN 'Partly Delivered' WHEN per_delivered = 100 THEN 'Fully Delivered' END AS indicator FROM sales_order""",
    "reconciliation_candidates": f"""WITH q_p AS (SELECT party, sum(unallocated_amount) AS a FROM payment_entry WHERE docstatus = 1 AND unallocated_amount > 0 GROUP BY 1),
q_j AS (SELECT party, sum(credit) AS a FROM journal_entry_account WHERE docstatus = 1 AND credit > 0 AND reference_name IS NULL GROUP BY 1),
q_r AS (SELECT customer, sum(outstanding_amount) AS a FROM sales_invoice WHERE docstatus = 1 AND is_return = 1 AND outstanding_amount < 0 GROUP BY 1),
q_c AS (SELECT DISTINCT customer FROM sales_invoice WHERE docstatus = 1 AND outstanding_amount > 0)
SELECT c.customer, {D('coalesce(p.a, 0)')} AS unallocated_amount, {D('coalesce(j.a, 0)')} AS credit_amount, {D('coalesce(r.a, 0)')} AS return_amount
FROM q_c c LEFT JOIN q_p p ON c.customer = p.party LEFT JOIN q_j j ON c.customer = j.party LEFT JOIN q_r r ON c.customer = r.customer
WHERE coalesce(p.a, 0) <> 0 OR coalesce(j.a, 0) <> 0 OR coalesce(r.a, 0) <> 0""",
    "voucher_base_amounts": f"""WITH q_s AS ({SIDES}), q_t AS (SELECT *, CASE WHEN pc = 'LYD' THEN 1 ELSE pr END AS prate,
  CASE WHEN rc = 'LYD' THEN 1 WHEN pc = rc THEN pr ELSE rr END AS rrate, CASE WHEN pc = rc THEN pa ELSE ra END AS ramount FROM q_s)
SELECT voucher_type, voucher_no, {D('prate')} AS paid_rate, {D('rrate')} AS received_rate, {D('ramount')} AS received_amount,
  {D('round(pa * prate, 3)')} AS base_paid_amount, {D('round(ramount * rrate, 3)')} AS base_received_amount FROM q_t""",
    "voucher_balance_violations": f"""WITH q_s AS ({SIDES}) SELECT voucher_type, voucher_no, {D('round(pa * pr, 3)')} AS base_paid_amount,
  {D('round(ra * rr, 3)')} AS base_received_amount FROM q_s WHERE coalesce(round(pa * pr, 3), 0) <> coalesce(round(ra * rr, 3), 0)""",
    "voucher_ledger_lines": VOUCHER_LINES,
    "unbalanced_vouchers": f"""WITH q_v AS ({VOUCHER_LINES}), q_s AS (SELECT custom_voucher_type, custom_voucher_no, part,
  sum(round(CAST(debit AS DECIMAL(18,3)) * CAST(exchange_rate AS DECIMAL(12,6)), 3)) AS d,
  sum(round(CAST(credit AS DECIMAL(18,3)) * CAST(exchange_rate AS DECIMAL(12,6)), 3)) AS c FROM q_v GROUP BY 1, 2, 3)
SELECT custom_voucher_type, custom_voucher_no, part, {D('d')} AS base_debit, {D('c')} AS base_credit FROM q_s WHERE d <> c""",
    "cash_invoice_lines": CASH,
    "landed_cost_lines": COSTS,
    "landed_cost_completeness": " UNION ALL ".join(
        f"SELECT name AS purchase_invoice, '{f}' AS missing_field FROM purchase_invoice WHERE update_stock = 0 AND ({c})"
        for f, c in (("clearance_account", "coalesce(clearance_account, '') = ''"), ("transport_account", "coalesce(transport_account, '') = ''"),
                     ("clearance_amount", "coalesce(clearance_amount, 0) = 0"), ("transport_amount", "coalesce(transport_amount, 0) = 0"))),
    "clean_incoterm_costs": f"""SELECT name, CASE WHEN custom_incoterm <> 'CFR' THEN freight_account END AS freight_account,
  {D("CASE WHEN custom_incoterm = 'CFR' THEN 0 ELSE coalesce(freight_amount, 0) END")} AS freight_amount,
  {D("CASE WHEN custom_incoterm = 'CFR' THEN 0 ELSE coalesce(freight_exchange_rate, 0) END")} AS freight_exchange_rate,
  CASE WHEN payment_method = 'LC' THEN inspection_account END AS inspection_account,
  {D("CASE WHEN payment_method <> 'LC' THEN 0 ELSE coalesce(inspection_amount, 0) END")} AS inspection_amount,
  {D("CASE WHEN payment_method <> 'LC' THEN 0 ELSE coalesce(inspection_exchange_rate, 0) END")} AS inspection_exchange_rate,
  {D('coalesce(transport_amount, 0)')} AS transport_amount, {D('coalesce(clearance_amount, 0)')} AS clearance_amount,
  {D('coalesce(foreign_bank_charges_amount, 0)')} AS foreign_bank_charges_amount, {D('coalesce(local_bank_charges_amount, 0)')} AS local_bank_charges_amount
FROM purchase_invoice""",
    "moving_average_valuation": f"""WITH RECURSIVE q_o AS (
  SELECT name, item_code, warehouse, posting_date, voucher_no, actual_qty, CAST(actual_qty AS DOUBLE) AS a, coalesce(is_adjustment_entry, 0) = 1 AS adjusts,
    row_number() OVER (PARTITION BY item_code, warehouse ORDER BY posting_date, posting_datetime NULLS FIRST, voucher_no, name) AS n,
    voucher_type = 'Stock Reconciliation' AND {YEAR} = '' AND qty_after_transaction IS NOT NULL AS reset, qty_after_transaction AS given,
    CASE WHEN voucher_type = 'Stock Reconciliation' AND {YEAR} = '' AND qty_after_transaction IS NOT NULL THEN CAST(valuation_rate AS DOUBLE)
      ELSE coalesce({ratio('stock_value_difference', 'actual_qty')}, 0) END AS p
  FROM stock_ledger_entry WHERE is_cancelled = 0),
q_s AS (
  SELECT item_code, warehouse, 0::BIGINT AS n, NULL::VARCHAR AS name, 0::DECIMAL(28,3) AS qty, 0::DOUBLE AS rate, 0::DOUBLE AS value, 0::DOUBLE AS change,
    NULL::VARCHAR AS voucher, 0::DOUBLE AS before, FALSE AS taken, 0::DOUBLE AS total
  FROM q_o GROUP BY item_code, warehouse
  UNION ALL SELECT item_code, warehouse, n, name, qty, r2, worth, change, voucher, before, taken OR adjusts, round(total + change, 2)
  FROM (SELECT *, CASE WHEN adjusts AND taken THEN 0 WHEN adjusts THEN -before ELSE round(worth - value, 2) END AS change
  FROM (SELECT *, CASE WHEN a < 0 AND qty <> 0 AND NOT reset THEN round(CAST(qty AS DOUBLE) * r1, 2) / CAST(qty AS DOUBLE) ELSE r1 END AS r2,
    CASE WHEN qty = 0 THEN 0 ELSE round(CAST(qty AS DOUBLE) * r1, 2) END AS worth
  FROM (SELECT o.item_code, o.warehouse, o.n, o.name, o.a, o.reset, s.value, o.adjusts, o.voucher_no AS voucher, s.total,
      CASE WHEN s.n > 0 AND o.voucher_no = s.voucher THEN s.before ELSE s.total END AS before, s.n > 0 AND o.voucher_no = s.voucher AND s.taken AS taken,
      CAST(CASE WHEN o.reset THEN o.given ELSE s.qty + o.actual_qty END AS DECIMAL(28,3)) AS qty,
      CASE WHEN o.reset OR (o.a > 0 AND s.qty <= 0) THEN o.p
        WHEN o.a > 0 THEN (CAST(s.qty AS DOUBLE) * s.rate + o.a * o.p) / (CAST(s.qty AS DOUBLE) + o.a) ELSE s.rate END AS r1
    FROM q_s s JOIN q_o o ON o.item_code = s.item_code AND o.warehouse = s.warehouse AND o.n = s.n + 1))))
SELECT s.name, s.item_code, s.warehouse, o.posting_date, o.voucher_no, o.a AS actual_qty, {D('s.qty')} AS qty_after, {R('s.rate', 6)} AS valuation_rate,
  s.value AS stock_value, s.change AS stock_value_difference
FROM q_s s JOIN q_o o ON s.item_code = o.item_code AND s.warehouse = o.warehouse AND s.n = o.n""",
    "remark_propagation": f"""WITH q_r AS (SELECT 'Receipt Voucher' AS ct, name AS cn, remark FROM receipt_voucher UNION ALL SELECT 'Payment Voucher', name, remark FROM payment_voucher
  UNION ALL SELECT 'Transfer Voucher', name, remark FROM transfer_voucher UNION ALL SELECT 'Clearing Voucher', name, remark FROM clearing_voucher
  UNION ALL SELECT 'Debt Voucher', name, remark FROM debt_voucher),
q_e AS (SELECT 'Payment Entry' AS vt, e.name AS vn, r.remark FROM payment_entry e JOIN q_r r ON e.custom_voucher_type = r.ct AND e.custom_voucher_no = r.cn WHERE e.docstatus = 1
  UNION ALL SELECT 'Journal Entry', e.name, r.remark FROM journal_entry e JOIN q_r r ON e.custom_voucher_type = r.ct AND e.custom_voucher_no = r.cn WHERE e.docstatus = 1)
SELECT g.account, g.voucher_type, g.voucher_no, {D('g.debit')} AS debit, {D('g.credit')} AS credit, coalesce(e.remark, g.remarks) AS remarks
FROM gl_entry g LEFT JOIN q_e e ON g.voucher_type = e.vt AND g.voucher_no = e.vn""",
    "order_line_changes": f"""WITH q_c AS (SELECT l.parent, l.name, l.item_code, l.production_year, l.qty, l.rate, l.price_list_rate, l.delivered_qty, l.billed_amt,
    c.docname, c.qty AS nq, c.rate AS nr, c.production_year AS ny, {R('c.rate', 2)} AS rr FROM sales_order_item l LEFT JOIN order_line_change c ON l.name = c.docname),
q_o AS (SELECT *, CASE WHEN docname IS NULL THEN 'kept' WHEN nq = qty AND nr = rate THEN 'unchanged' ELSE 'given' END AS state,
  CASE WHEN nq = 0 THEN 'quantity is zero' WHEN nq < delivered_qty THEN 'below delivered quantity'
    WHEN round(billed_amt, 2) > round(CAST(rr * CAST(nq AS DOUBLE) AS DECIMAL(28,9)), 2) AND rr > 0 THEN 'below billed amount' END AS why FROM q_c),
q_n AS (SELECT parent, name, item_code, CASE WHEN state = 'given' AND why IS NULL AND coalesce(ny, '') <> '' THEN ny ELSE production_year END AS production_year,
    CASE WHEN state = 'given' AND why IS NULL THEN nq ELSE qty END AS qty, CASE WHEN state = 'given' AND why IS NULL THEN rr ELSE rate END AS rate, price_list_rate,
    CASE WHEN state <> 'given' THEN state WHEN why IS NOT NULL THEN 'rejected' ELSE 'changed' END AS outcome, CASE WHEN state = 'given' THEN why END AS reason FROM q_o
  UNION ALL SELECT parent, NULL, item_code, production_year, qty, {R('rate', 2)}, NULL, CASE WHEN coalesce(qty, 0) = 0 THEN 'rejected' ELSE 'added' END,
    CASE WHEN coalesce(qty, 0) = 0 THEN 'quantity is zero' END FROM order_line_change WHERE docname IS NULL)
SELECT parent, name, item_code, production_year, {D('qty')} AS qty, rate, price_list_rate, outcome, reason, {MARGIN} FROM q_n""",
    "line_margin_discount": f"SELECT name, {MARGIN} FROM sales_order_item",
    "adjustment_lines": " UNION ALL ".join(
        f"""SELECT r.name AS request, '{doc}' AS document, r.sales_invoice, s.customer, s.company, s.currency, s.set_warehouse, s.selling_price_list,
  d.idx, d.item_code, d.production_year, {D(f'{sign} * d.qty')} AS qty, d.rate
FROM {table} d JOIN sales_adjustment_request r ON d.parent = r.name JOIN sales_invoice s ON r.sales_invoice = s.name WHERE r.docstatus = 1"""
        for doc, table, sign in (("Sales Order", "sales_adjustment_increase", 1), ("Delivery Note", "sales_adjustment_increase", 1),
                                 ("Sales Invoice", "sales_adjustment_decrease", -1))),
    "empty_adjustments": """SELECT name AS request, sales_invoice, docstatus FROM sales_adjustment_request
WHERE name NOT IN (SELECT parent FROM sales_adjustment_increase) AND name NOT IN (SELECT parent FROM sales_adjustment_decrease)""",
    "document_counters": COUNTERS,
    "receipts_by_year": f"""WITH q_q AS (SELECT parent, sum(qty) AS q FROM purchase_receipt_item WHERE docstatus <> 2 GROUP BY 1)
SELECT CAST(year(r.posting_date) AS INT) AS year, CASE WHEN r.docstatus = 1 THEN 'submitted' ELSE 'future' END AS state, count(*) AS receipts,
  {D('coalesce(sum(q.q), 0)')} AS qty, {D('sum(r.base_grand_total)')} AS amount
FROM purchase_receipt r LEFT JOIN q_q q ON r.name = q.parent WHERE r.docstatus <> 2 AND r.is_return = 0 GROUP BY 1, 2""",
    "filter_spec": f"""SELECT name, {D('price_list_rate')} AS price_list_rate, packing_unit FROM item_price
WHERE price_list = 'Standard Selling' AND selling = 1 AND price_list_rate > 905 AND packing_unit IN (0, 4)""",
    "receipt_list": f"""SELECT name AS purchase_receipt, title AS shipment_name, virtual_receipt, {D('total_qty')} AS total_qty, currency,
  {D('grand_total')} AS grand_total, {D('base_grand_total')} AS base_grand_total,
  CASE WHEN docstatus = 1 THEN posting_date END AS posting_date, CASE WHEN docstatus = 1 THEN 1 ELSE 0 END AS actual_receipt
FROM purchase_receipt WHERE docstatus <> 2""",
    "export_prices": f"""WITH {METRICS} SELECT name, item_code, item_name, brand, {D('price_list_rate')} AS price_list_rate, {R('stock_valuation_rate', 6)} AS stock_valuation_rate,
{D('stock_qty')} AS stock_qty, price_list FROM q_ip""",
    "export_receipts": f"""SELECT l.parent AS receipt, l.idx, l.name AS line, CASE WHEN x.n = 1 THEN l.parent ELSE '' END AS name, CASE WHEN x.n = 1 THEN r.title ELSE '' END AS title,
  l.brand, l.item_code, l.item_name, l.production_year, {D('l.qty')} AS qty, l.rate, {D('l.amount')} AS amount
FROM purchase_receipt_item l JOIN purchase_receipt r ON l.parent = r.name
JOIN (SELECT name, row_number() OVER (PARTITION BY parent ORDER BY idx, name) AS n FROM purchase_receipt_item) x ON l.name = x.name""",
    "sanitize_cells": "SELECT name, item_name || ' ' || description AS description FROM item",
    "stock_entry_totals": f"""SELECT s.name, s.posting_date, s.docstatus, s.stock_entry_type, s.expense_account, {D('coalesce(sum(d.qty), 0)')} AS total_qty
FROM stock_entry s LEFT JOIN stock_entry_detail d ON s.name = d.parent GROUP BY 1, 2, 3, 4, 5""",
    "stock_entry_lines": f"""SELECT d.parent, d.name, d.item_code, {D('d.qty')} AS qty, CASE WHEN coalesce(s.expense_account, '') <> '' THEN s.expense_account ELSE d.expense_account END AS expense_account
FROM stock_entry_detail d LEFT JOIN stock_entry s ON d.parent = s.name""",
}


def _line_difference(lines: str, listed: str, done: str, date: str) -> str:
    word, rate = done.removesuffix("_qty"), R("coalesce(g.rate, 0)", 2)
    factor = R("g.conversion_factor", 2)
    return f"""WITH q_p AS (
  SELECT coalesce(l.parent, g.parent) AS parent, coalesce(l.name, g.docname) AS name, l.name IS NOT NULL AS found, g.docname IS NOT NULL AS given, FALSE AS fresh,
    coalesce(l.item_code, g.item_code) AS item_code, l.production_year, l.brand, l.qty, l.rate, l.uom, l.stock_uom, l.conversion_factor, l.{date} AS due_date, l.price_list_rate,
    coalesce(l.{done}, 0) AS done, coalesce(l.billed_amt, 0) AS billed, g.item_code AS gi, g.production_year AS gy, g.brand AS gb, coalesce(g.qty, 0) AS gq,
    coalesce(g.rate, 0) AS graw, {rate} AS gr, g.uom AS gu, coalesce(g.conversion_factor, 0) AS gcraw, nullif({factor}, 0) AS gc, g.{date} AS gd
  FROM (SELECT * FROM {lines} WHERE parent IN (SELECT parent FROM {listed})) l
  FULL JOIN (SELECT * FROM {listed} WHERE docname IS NOT NULL) g ON l.parent = g.parent AND l.name = g.docname
  WHERE l.name IS NOT NULL OR coalesce(g.item_code, '') <> ''
  UNION ALL SELECT g.parent, NULL, TRUE, TRUE, TRUE, g.item_code, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0, 0, g.item_code, g.production_year, g.brand,
    coalesce(g.qty, 0), coalesce(g.rate, 0), {rate}, g.uom, coalesce(g.conversion_factor, 0), nullif({factor}, 0), g.{date}
  FROM {listed} g WHERE g.docname IS NULL AND coalesce(g.item_code, '') <> ''),
q_s AS (SELECT p.*, c.conversion_factor AS table_factor,
    found AND given AND (coalesce(gi, '') = '' OR NOT fresh AND gq = qty AND graw = rate AND gcraw = p.conversion_factor AND gu IS NOT DISTINCT FROM p.uom AND coalesce(gd = due_date, FALSE)) AS same
  FROM q_p p LEFT JOIN uom_conversion_detail c ON p.item_code = c.parent AND p.gu = c.uom AND found),
q_r AS (SELECT *, CASE WHEN NOT found THEN 'no such line' WHEN NOT given THEN CASE WHEN done > 0 THEN 'already {word}' WHEN billed <> 0 THEN 'already billed' END
    WHEN NOT same THEN CASE WHEN gq = 0 THEN 'quantity is zero' WHEN gq < done THEN 'below {word} quantity'
      WHEN round(billed, 2) > round(CAST(gr * CAST(gq AS DOUBLE) AS DECIMAL(28,9)), 2) AND gr > 0 THEN 'below billed amount' END END AS reason FROM q_s),
q_o AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN NOT given THEN 'removed' WHEN same THEN 'same' WHEN fresh THEN 'new' ELSE 'changed' END AS outcome FROM q_r),
q_f AS (SELECT *, fresh OR NOT found OR outcome = 'changed' AS takes,
    CASE WHEN coalesce(gu, '') <> '' THEN coalesce(gc, table_factor, 1) WHEN gcraw = 0 THEN CASE WHEN fresh THEN 1 ELSE conversion_factor END
      WHEN found AND NOT fresh AND stock_uom IS NOT DISTINCT FROM uom THEN 1 ELSE coalesce(gc, 0) END AS nf FROM q_o),
q_v AS (SELECT parent, name, item_code, outcome, reason, price_list_rate,
    CASE WHEN takes AND coalesce(gy, '') <> '' THEN gy ELSE production_year END AS production_year, CASE WHEN takes AND coalesce(gb, '') <> '' THEN gb ELSE brand END AS brand,
    CASE WHEN takes THEN gq ELSE qty END AS qty, CASE WHEN takes THEN gr ELSE rate END AS rate, CASE WHEN takes AND coalesce(gu, '') <> '' THEN gu ELSE uom END AS uom,
    CASE WHEN takes THEN nf ELSE conversion_factor END AS conversion_factor, CASE WHEN takes THEN coalesce(gd, due_date) ELSE due_date END AS due_date FROM q_f)
SELECT parent, name, item_code, production_year, brand, {D('qty')} AS qty, rate, price_list_rate, uom, conversion_factor, due_date, outcome, reason,
  CASE WHEN parent IN (SELECT parent FROM q_v WHERE outcome = 'rejected') THEN 0 ELSE 1 END AS applied,
  {R('CAST(qty AS DOUBLE) * conversion_factor', 6)} AS stock_qty, {MARGIN} FROM q_v"""


ORACLES |= {
    "sales_line_difference": _line_difference("sales_order_item", "sales_line_list", "delivered_qty", "delivery_date"),
    "purchase_line_difference": _line_difference("purchase_order_item", "purchase_line_list", "received_qty", "schedule_date"),
}

# Amounts, quantities and rates of the reports with a total row; the total is named in the first column.
_TOTALS = {
    "account_balances": ("account_number", "debit credit"),
    "available_items": ("item_code", "price_list_rate"),
    "brand_performance": ("brand", "sales_qty sales_amount sales_cost gross_profit stock_qty"),
    "brand_transactions": ("brand", "opening_stock purchases sales ending_stock"),
    "customer_balances": ("customer", "credit_limit balance_wo_so unbilled_sales_orders balance_w_so overdues"),
    "customer_performance": ("customer", "sales_qty sales_amount cogs balance_wo_so orders_to_bill balance_w_so"),
    "item_performance": ("item_code", "sales_qty sales_amount sales_cost gross_profit stock_qty"),
    "item_reservations": ("item_code", "qty_to_deliver rate"),
    "item_sales_ledger": ("item_code", "in_qty out_qty rate"),
    "item_transactions": ("item_code", "opening_stock purchases sales ending_stock"),
    "receipt_details": ("purchase_receipt", "qty"),
    "stock_ageing": ("item_code", "actual_qty valuation_rate avg_age"),
    "stock_balance": ("item_code", "actual_qty qty_to_deliver available_qty"),
    "stock_balance_cost_prices": ("item_code", "actual_qty qty_to_deliver available_qty price_list_rate valuation_rate"),
    "stock_balance_prices": ("item_code", "actual_qty qty_to_deliver available_qty qty_to_receive price_list_rate"),
}


def _with_total(report: str, label: str, numbers: str) -> str:
    sums = ", ".join(f"{D(f'sum(CAST({c} AS DECIMAL(28,9)))')} AS {c}" for c in numbers.split())
    return f"""WITH q_report AS ({report}) SELECT *, 0 AS is_total FROM q_report
UNION ALL BY NAME SELECT 'Total' AS {label}, {sums}, 1 AS is_total FROM q_report HAVING count(*) > 0"""


ORACLES |= {f"{name}_totals": _with_total(ORACLES[name], *columns) for name, columns in _TOTALS.items()}


def oracle_texts() -> dict[str, str]:
    """Complete statements: the needed views, then the query."""
    texts = {}
    for name, sql in ORACLES.items():
        views = with_clause(views_in(sql))
        body = sql.strip()
        if body.startswith("WITH RECURSIVE "):
            views, body = views.replace("WITH ", "WITH RECURSIVE ", 1), "WITH " + body[15:]
        texts[name] = f"{views},\n{body[5:]}" if body.startswith("WITH ") else f"{views}\n{body}"
    return texts
