"""Business-document views over the TPC-H-like test tables.

Each view is one SELECT in the subset of SQL that Spark and DuckDB read alike.  ``{lineitem}`` and the
like stand for the raw tables, plain names for other views in this module.  Every raw row of the tables
a view reads takes part; a view only leaves out rows by what they mean (an unpaid order has no payment).

Doubles become decimals before any arithmetic, since the two engines round ``double * constant``
differently when casting the product.
"""

from __future__ import annotations

import re

# The raw tables the views read, with their types, so that no file is opened to find them out.
RAW_TABLES: dict[str, str] = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

_YEAR = (
    "CASE WHEN l_linenumber % 4 = 0 THEN NULL WHEN l_linenumber % 4 = 1 THEN '' "
    "ELSE cast(year(l_shipdate) AS string) END"
)
# (order, line number) repeats in the test data; with these columns a line key is unique.
_LINE = (
    "cast(l_orderkey AS string) || '/' || cast(l_linenumber AS string) || '/' || cast(l_partkey AS string) || '/' || "
    "cast(l_suppkey AS string) || '/' || cast(cast(l_shipdate AS date) AS string) || '/' || "
    "cast(cast(l_extendedprice AS decimal(18,2)) AS string)"
)
_ORDER_STATE = "CASE WHEN l_orderkey % 20 = 0 THEN 2 WHEN l_orderkey % 20 = 1 THEN 0 ELSE 1 END"
_PRICE = "cast(l_extendedprice AS decimal(18,2))"
_QTY = "cast(l_quantity AS decimal(18,3))"
_RATE = "l_extendedprice / l_quantity"
_TOTAL = "cast(o_totalprice AS decimal(18,2))"
_UPDATES_STOCK = "o_orderpriority IN ('1-URGENT', '2-HIGH')"

# Units and date of an order line: every second line is in boxes of four, some lines have no date.
_TERMS = (
    "CASE WHEN l_linenumber % 2 = 0 THEN 'Box' ELSE 'Nos' END AS uom, 'Nos' AS stock_uom, "
    "CASE WHEN l_linenumber % 2 = 0 THEN cast(4 AS double) ELSE cast(1 AS double) END AS conversion_factor, "
    "CASE WHEN l_tax = 0 THEN NULL ELSE cast(l_shipdate AS date) END"
)


def _line_list(order: str, date: str) -> str:
    """What users make of the lines of an order: most stay, some are left out, changed, new, without item, or of no such line."""
    return f"""
SELECT '{order}-' || cast(l_orderkey AS string) AS parent,
  CASE WHEN l_discount = 0.07 AND l_linenumber > 4 THEN NULL WHEN l_partkey % 60 = 7 THEN '{order}I-' || {_LINE} || '/?' ELSE '{order}I-' || {_LINE} END AS docname,
  l_linenumber AS idx, CASE WHEN l_partkey % 70 = 9 THEN NULL ELSE 'I-' || cast(l_partkey AS string) END AS item_code,
  CASE WHEN l_tax > 0.06 THEN '2031' END AS production_year, CASE WHEN l_tax > 0.06 THEN 'Brand#99' ELSE '' END AS brand,
  CASE WHEN l_discount = 0.01 THEN {_QTY} - cast(10 AS decimal(18,3)) WHEN l_discount = 0.02 THEN {_QTY} + cast(3 AS decimal(18,3))
    WHEN l_discount = 0.03 AND l_linenumber = 1 THEN cast(0 AS decimal(18,3)) ELSE {_QTY} END AS qty,
  CASE WHEN l_discount = 0.04 THEN {_RATE} * cast(0.5 AS double) WHEN l_discount = 0.05 THEN {_RATE} * cast(2 AS double) ELSE {_RATE} END AS rate,
  CASE WHEN l_discount = 0.06 THEN 'Box' WHEN l_discount >= 0.09 THEN NULL WHEN l_linenumber % 2 = 0 THEN 'Box' ELSE 'Nos' END AS uom,
  CASE WHEN l_discount = 0.06 THEN NULL WHEN l_discount = 0.08 THEN cast(2.5 AS double) WHEN l_linenumber % 2 = 0 THEN cast(4 AS double) ELSE cast(1 AS double) END
    AS conversion_factor,
  CASE WHEN l_tax = 0 THEN NULL WHEN l_tax = 0.01 THEN cast(l_shipdate AS date) + 5 ELSE cast(l_shipdate AS date) END AS {date}
FROM {{lineitem}} WHERE l_orderkey % 3 > 0 AND NOT (l_returnflag = 'A' AND l_linenumber = 3)"""


VIEWS: dict[str, str] = {
    "item": """
SELECT 'I-' || cast(p_partkey AS string) AS name, 'I-' || cast(p_partkey AS string) AS item_code,
  p_name AS item_name, p_brand AS brand, p_type AS item_group, cast(p_partkey % 25 AS string) AS country_of_origin,
  cast(p_size AS string) AS tire_size, p_size % 4 AS ply_rating,
  CASE WHEN p_partkey % 20 = 0 THEN 0 ELSE 1 END AS is_stock_item, p_name || ' / ' || p_type AS description
FROM {part}""",
    "tire_size": """
SELECT DISTINCT cast(p_size AS string) AS name, lpad(cast(p_size AS string), 3, '0') AS sorting_code
FROM {part} WHERE p_size < 45""",
    "customer_master": """
SELECT 'C-' || cast(c_custkey AS string) AS name, c_name AS customer_name, c_mktsegment AS customer_group,
  CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE 'T' || cast(c_nationkey % 5 * 30 AS string) END AS payment_terms,
  CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS bypass_overdue_check,
  CASE WHEN c_acctbal < -900 THEN 1 ELSE 0 END AS disabled
FROM {customer}""",
    "payment_terms_detail": """
SELECT 'T30' AS parent, 30 AS credit_days UNION ALL SELECT 'T60', 60 UNION ALL SELECT 'T60', 45
UNION ALL SELECT 'T90', 90 UNION ALL SELECT 'T120', 120""",
    "customer_credit_limit": """
SELECT 'C-' || cast(c_custkey AS string) AS parent, 'Customer' AS parenttype,
  cast(cast(c_acctbal AS decimal(18,2)) * cast(100 AS decimal(3,0)) AS decimal(18,2)) AS credit_limit
FROM {customer} WHERE c_acctbal > 0
UNION ALL SELECT 'C-' || cast(c_custkey AS string), 'Customer', cast(5000 AS decimal(18,2))
FROM {customer} WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT DISTINCT c_mktsegment, 'Customer Group', cast(1000 AS decimal(18,2)) FROM {customer}""",
    "sales_order": f"""
SELECT 'SO-' || cast(o_orderkey AS string) AS name, 'C-' || cast(o_custkey AS string) AS customer,
  cast(o_orderdate AS date) AS transaction_date,
  CASE WHEN o_orderkey % 20 = 0 THEN 2 WHEN o_orderkey % 20 = 1 THEN 0 ELSE 1 END AS docstatus,
  CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN CASE WHEN o_orderkey % 9 = 4 THEN 'Closed' ELSE 'To Bill' END ELSE
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'On Hold' ELSE 'To Deliver and Bill' END END AS status,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Reserve against Future Receipts' WHEN o_orderkey % 7 = 1 THEN NULL
    ELSE 'Reserve with Delivery' END AS reservation_status,
  'WH-' || cast(o_orderkey % 3 AS string) AS set_warehouse, {_TOTAL} AS total,
  cast({_TOTAL} * CASE WHEN o_orderpriority = '1-URGENT' THEN cast(0.95 AS decimal(3,2)) ELSE cast(1 AS decimal(3,2)) END
    AS decimal(18,4)) AS grand_total,
  'Standard Selling' AS selling_price_list,
  CASE o_orderstatus WHEN 'F' THEN 'Fully Billed' WHEN 'P' THEN 'Partly Billed' ELSE 'Not Billed' END AS billing_status,
  CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '4-NOT SPECIFIED' THEN 'Fully Delivered' ELSE 'Not Delivered' END
    AS delivery_status,
  CASE o_orderstatus WHEN 'F' THEN cast(100 AS double) WHEN 'P' THEN cast(40 AS double) ELSE cast(0 AS double) END AS per_billed,
  CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '4-NOT SPECIFIED' THEN cast(100 AS double)
    WHEN o_orderstatus = 'P' THEN cast(25 AS double) ELSE cast(0 AS double) END AS per_delivered
FROM {{orders}}""",
    "sales_order_item": f"""
SELECT 'SOI-' || {_LINE} AS name, 'SO-' || cast(l_orderkey AS string) AS parent, {_ORDER_STATE} AS docstatus,
  l_linenumber AS idx, 'I-' || cast(l_partkey AS string) AS item_code, {_YEAR} AS production_year, {_QTY} AS qty,
  CASE WHEN l_linestatus = 'F' THEN {_QTY} ELSE cast(floor(l_quantity / 2) AS decimal(18,3)) END AS delivered_qty,
  CASE WHEN l_returnflag = 'N' THEN cast(0 AS decimal(18,3)) ELSE {_QTY} END AS billed_qty,
  {_PRICE} AS amount,
  CASE WHEN l_returnflag = 'R' THEN {_PRICE} ELSE cast(0 AS decimal(18,2)) END AS billed_amt,
  {_RATE} AS rate,
  {_RATE} AS net_rate,
  {_RATE} * CASE WHEN l_discount >= 0.05 THEN cast(1.25 AS double) WHEN l_discount >= 0.03 THEN cast(1 AS double)
    WHEN l_discount >= 0.01 THEN cast(0.5 AS double) ELSE cast(0 AS double) END AS price_list_rate,
  {_RATE} * CASE WHEN l_tax > 0.07 THEN cast(1.5 AS double) ELSE cast(0.5 AS double) END AS valuation_rate,
  CASE WHEN l_tax < 0.02 THEN NULL WHEN l_tax < 0.04 THEN '' ELSE 'Brand#' || cast(l_partkey % 25 AS string) END AS brand, {_TERMS} AS delivery_date
FROM {{lineitem}}""",
    "purchase_order_item": f"""
SELECT 'POI-' || {_LINE} AS name, 'PO-' || cast(l_orderkey AS string) AS parent, {_ORDER_STATE} AS docstatus, l_linenumber AS idx,
  'I-' || cast(l_partkey AS string) AS item_code, {_YEAR} AS production_year, 'Brand#' || cast(l_partkey % 25 AS string) AS brand, {_QTY} AS qty,
  CASE WHEN l_suppkey % 3 = 0 THEN cast(floor(l_quantity / 2) AS decimal(18,3)) ELSE cast(0 AS decimal(18,3)) END AS received_qty,
  CASE WHEN l_suppkey % 6 = 0 THEN {_PRICE} ELSE cast(0 AS decimal(18,2)) END AS billed_amt, {_RATE} AS rate,
  {_RATE} * CASE WHEN l_discount >= 0.05 THEN cast(1.25 AS double) WHEN l_discount >= 0.02 THEN cast(0.5 AS double) ELSE cast(0 AS double) END
    AS price_list_rate, {_TERMS} AS schedule_date
FROM {{lineitem}}""",
    "sales_line_list": _line_list("SO", "delivery_date"),
    "purchase_line_list": _line_list("PO", "schedule_date"),
    "uom_conversion_detail": """
SELECT 'I-' || cast(p_partkey AS string) AS parent, 'Box' AS uom, cast(p_size % 5 + 1 AS double) AS conversion_factor FROM {part} WHERE p_size % 3 > 0""",
    "order_line_change": f"""
SELECT 'SO-' || cast(l_orderkey AS string) AS parent,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN NULL ELSE 'SOI-' || {_LINE} END AS docname,
  l_linenumber AS idx, 'I-' || cast(l_partkey AS string) AS item_code, {_YEAR} AS production_year,
  CASE WHEN l_returnflag = 'R' THEN {_QTY} - cast(20 AS decimal(18,3)) WHEN l_returnflag = 'N' THEN {_QTY}
    ELSE {_QTY} + cast(1 AS decimal(18,3)) END AS qty,
  CASE WHEN l_tax > 0.04 THEN {_RATE} * cast(0.5 AS double) ELSE {_RATE} END AS rate
FROM {{lineitem}} WHERE l_linestatus = 'O'""",
    "sales_invoice": f"""
SELECT 'SI-' || cast(o_orderkey AS string) AS name, 'C-' || cast(o_custkey AS string) AS customer,
  'Customer ' || cast(o_custkey AS string) AS customer_name, cast(o_orderdate AS date) + 7 AS posting_date,
  CASE WHEN o_orderkey % 30 = 0 THEN 2 ELSE 1 END AS docstatus,
  CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS is_return,
  CASE WHEN o_orderkey % 50 = 7 THEN 'Yes' ELSE 'No' END AS is_opening,
  CASE WHEN {_UPDATES_STOCK} THEN 1 ELSE 0 END AS update_stock,
  CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS is_paid,
  CASE WHEN o_orderkey % 17 = 0 THEN -{_TOTAL} ELSE {_TOTAL} END AS grand_total,
  CASE WHEN o_orderstatus = 'F' THEN cast(0 AS decimal(18,2)) WHEN o_orderkey % 17 = 0 THEN -{_TOTAL}
    ELSE {_TOTAL} END AS outstanding_amount,
  'A-1100' AS debit_to, 'A-1000' AS payment_account,
  CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS custom_payment_value_is_different,
  CASE WHEN o_orderstatus <> 'P' THEN NULL WHEN o_totalprice < 5000 THEN cast(6000 AS decimal(18,2))
    ELSE cast({_TOTAL} * cast(0.90 AS decimal(3,2)) AS decimal(18,2)) END AS custom_payment_value,
  cast(1 AS decimal(21,9)) AS conversion_rate, 'LYD' AS currency, 'Main Company' AS company,
  'WH-' || cast(o_orderkey % 3 AS string) AS set_warehouse, 'Standard Selling' AS selling_price_list
FROM {{orders}}""",
    "sales_invoice_item": f"""
SELECT 'SII-' || {_LINE} AS name, 'SI-' || cast(l_orderkey AS string) AS parent,
  CASE WHEN l_orderkey % 30 = 0 THEN 2 WHEN l_orderkey % 30 = 11 THEN 0 ELSE 1 END AS docstatus,
  'I-' || cast(l_partkey AS string) AS item_code,
  CASE WHEN l_linenumber = 6 THEN '' WHEN l_linenumber = 5 THEN NULL ELSE 'SO-' || cast(l_orderkey AS string) END AS sales_order,
  {_YEAR} AS production_year,
  CASE WHEN l_orderkey % 17 = 0 THEN -{_QTY} ELSE {_QTY} END AS qty,
  CASE WHEN l_orderkey % 17 = 0 THEN -{_PRICE} ELSE {_PRICE} END AS net_amount,
  {_RATE} AS rate, {_RATE} AS net_rate,
  {_RATE} * CASE WHEN l_tax > 0.07 THEN cast(1.5 AS double) ELSE cast(0.5 AS double) END AS incoming_rate,
  'SOI-' || {_LINE} AS so_detail,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'DNI-' || {_LINE} END AS dn_detail,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'DN-' || cast(l_orderkey AS string) END AS delivery_note
FROM {{lineitem}}""",
    "delivery_note": f"""
SELECT 'DN-' || cast(o_orderkey AS string) AS name, 'C-' || cast(o_custkey AS string) AS customer,
  cast(o_orderdate AS date) + 7 AS posting_date,
  CASE WHEN o_orderkey % 30 = 0 THEN 2 WHEN o_orderkey % 30 = 13 THEN 0 ELSE 1 END AS docstatus,
  'WH-' || cast(o_orderkey % 3 AS string) AS set_warehouse,
  CASE o_orderstatus WHEN 'F' THEN 'Fully Billed' WHEN 'P' THEN 'Partly Billed' ELSE 'Not Billed' END AS billing_status
FROM {{orders}} WHERE NOT ({_UPDATES_STOCK})""",
    "delivery_note_item": f"""
SELECT 'DNI-' || {_LINE} AS name, 'DN-' || cast(l_orderkey AS string) AS parent,
  CASE WHEN l_orderkey % 30 = 0 THEN 2 WHEN l_orderkey % 30 = 13 THEN 0 ELSE 1 END AS docstatus,
  'I-' || cast(l_partkey AS string) AS item_code, {_YEAR} AS production_year, {_QTY} AS qty,
  CASE WHEN l_returnflag = 'R' THEN {_QTY} WHEN l_returnflag = 'A' THEN cast(floor(l_quantity / 3) AS decimal(18,3))
    ELSE cast(0 AS decimal(18,3)) END AS billed_qty,
  {_RATE} AS rate, {_RATE} * cast(1.25 AS double) AS price_list_rate,
  'SOI-' || {_LINE} AS so_detail, 'SO-' || cast(l_orderkey AS string) AS against_sales_order
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey WHERE NOT ({_UPDATES_STOCK})""",
    "stock_ledger_entry": f"""
SELECT CASE l_linenumber WHEN 6 THEN 'Purchase Invoice' WHEN 7 THEN 'Stock Entry' ELSE 'Purchase Receipt' END AS voucher_type,
  CASE l_linenumber WHEN 6 THEN 'PI-' WHEN 7 THEN 'SE-' ELSE 'PR-' END || cast(l_suppkey AS string) AS voucher_no,
  'R-' || {_LINE} AS name,
  'I-' || cast(l_partkey AS string) AS item_code, {_YEAR} AS production_year,
  'WH-' || cast(l_orderkey % 3 AS string) AS warehouse, cast(l_shipdate AS date) - 60 AS posting_date,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE cast(cast(l_shipdate AS date) - 60 - cast(l_suppkey % 2 AS int) AS timestamp) END AS posting_datetime,
  {_QTY} AS actual_qty,
  cast({_PRICE} * cast(0.5 AS decimal(2,1)) AS decimal(18,3)) AS stock_value_difference,
  CASE WHEN l_orderkey % 25 = 0 THEN 1 ELSE 0 END AS is_cancelled,
  cast(NULL AS decimal(18,3)) AS qty_after_transaction, cast(NULL AS decimal(21,9)) AS valuation_rate,
  CASE WHEN l_linenumber = 7 AND l_suppkey % 4 < 2 THEN 1 ELSE 0 END AS is_adjustment_entry
FROM {{lineitem}}
UNION ALL SELECT CASE WHEN {_UPDATES_STOCK} THEN 'Sales Invoice' ELSE 'Delivery Note' END,
  CASE WHEN {_UPDATES_STOCK} THEN 'SI-' ELSE 'DN-' END || cast(l_orderkey AS string),
  'D-' || {_LINE}, 'I-' || cast(l_partkey AS string), {_YEAR}, 'WH-' || cast(l_orderkey % 3 AS string),
  cast(o_orderdate AS date) + 7, cast(cast(o_orderdate AS date) + 7 AS timestamp), -{_QTY}, cast({_PRICE} * cast(-0.5 AS decimal(2,1)) AS decimal(18,3)),
  CASE WHEN l_orderkey % 30 = 0 THEN 1 ELSE 0 END, NULL, NULL, NULL
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'
UNION ALL SELECT 'Stock Reconciliation', 'SR-' || cast(p_partkey % 5 AS string), 'O-' || cast(p_partkey AS string),
  'I-' || cast(p_partkey AS string), NULL, 'WH-0', DATE '1997-01-01', cast(NULL AS timestamp), cast(10 AS decimal(18,3)),
  cast(cast(p_retailprice AS decimal(18,2)) * cast(10 AS decimal(2,0)) AS decimal(18,3)), 0,
  cast(10 AS decimal(18,3)), cast(cast(p_retailprice AS decimal(18,2)) AS decimal(21,9)), 0
FROM {{part}} WHERE p_type = 'ECONOMY'""",
    "gl_entry": f"""
SELECT 'A-1100' AS account, 'Customer' AS party_type, 'C-' || cast(o_custkey AS string) AS party,
  cast(o_orderdate AS date) + 7 AS posting_date, 'Sales Invoice' AS voucher_type,
  'SI-' || cast(o_orderkey AS string) AS voucher_no, {_TOTAL} AS debit, cast(0 AS decimal(18,2)) AS credit,
  CASE WHEN o_orderkey % 50 = 7 THEN 'Yes' ELSE 'No' END AS is_opening,
  CASE WHEN o_orderkey % 30 = 0 THEN 1 ELSE 0 END AS is_cancelled, 'inv' AS remarks
FROM {{orders}}
UNION ALL SELECT 'A-4000', NULL, NULL, cast(o_orderdate AS date) + 7, 'Sales Invoice', 'SI-' || cast(o_orderkey AS string),
  cast(0 AS decimal(18,2)), {_TOTAL}, CASE WHEN o_orderkey % 50 = 7 THEN 'Yes' ELSE 'No' END,
  CASE WHEN o_orderkey % 30 = 0 THEN 1 ELSE 0 END, 'inv'
FROM {{orders}}
UNION ALL SELECT 'A-1000', NULL, NULL, cast(o_orderdate AS date) + 30, 'Payment Entry', 'PE-' || cast(o_orderkey AS string),
  {_TOTAL}, cast(0 AS decimal(18,2)), 'No', 0, 'pay'
FROM {{orders}} WHERE o_orderstatus = 'F'
UNION ALL SELECT 'A-1100', 'Customer', 'C-' || cast(o_custkey AS string), cast(o_orderdate AS date) + 30, 'Payment Entry',
  'PE-' || cast(o_orderkey AS string), cast(0 AS decimal(18,2)), {_TOTAL}, 'No', 0, 'pay'
FROM {{orders}} WHERE o_orderstatus = 'F'
UNION ALL SELECT 'A-1100', 'Customer', 'C-' || cast(o_custkey AS string), cast(o_orderdate AS date) + 14, 'Journal Entry',
  'JV-' || cast(o_orderkey AS string), cast(25 AS decimal(18,2)), cast(0 AS decimal(18,2)), 'No', 0, 'jv'
FROM {{orders}} WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'A-4000', NULL, NULL, cast(o_orderdate AS date) + 14, 'Journal Entry', 'JV-' || cast(o_orderkey AS string),
  cast(0 AS decimal(18,2)), cast(25 AS decimal(18,2)), 'No', 0, 'jv'
FROM {{orders}} WHERE o_orderpriority = '5-LOW'""",
    "payment_entry": f"""
SELECT 'PE-' || cast(o_orderkey AS string) AS name, CASE WHEN o_orderkey % 40 = 3 THEN 2 ELSE 1 END AS docstatus,
  cast(o_orderdate AS date) + 30 AS posting_date, 'C-' || cast(o_custkey AS string) AS party,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN {_TOTAL} ELSE cast(0 AS decimal(18,2)) END AS unallocated_amount,
  CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 'Receipt Voucher' ELSE NULL END AS custom_voucher_type,
  CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 'RV-' || cast(o_orderkey AS string) ELSE NULL END AS custom_voucher_no
FROM {{orders}} WHERE o_orderstatus = 'F'""",
    "journal_entry": """
SELECT 'JV-' || cast(o_orderkey AS string) AS name, 1 AS docstatus, cast(o_orderdate AS date) + 14 AS posting_date,
  CASE WHEN o_orderstatus = 'P' THEN 'Debt Voucher' ELSE NULL END AS custom_voucher_type,
  CASE WHEN o_orderstatus = 'P' THEN 'DV-' || cast(o_orderkey AS string) ELSE NULL END AS custom_voucher_no,
  CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS is_system_generated
FROM {orders} WHERE o_orderpriority = '5-LOW'""",
    "journal_entry_account": f"""
SELECT 'JV-' || cast(o_orderkey AS string) AS parent, 'C-' || cast(o_custkey AS string) AS party,
  CASE WHEN o_orderstatus = 'O' THEN {_TOTAL} ELSE cast(0 AS decimal(18,2)) END AS credit,
  CASE WHEN o_orderkey % 3 = 0 THEN 'SI-' || cast(o_orderkey AS string) ELSE NULL END AS reference_name,
  CASE WHEN o_orderkey % 30 = 5 THEN 0 ELSE 1 END AS docstatus
FROM {{orders}} WHERE o_orderpriority = '5-LOW'""",
    "stock_reconciliation": """
SELECT DISTINCT 'SR-' || cast(p_partkey % 5 AS string) AS name, DATE '1997-01-01' AS posting_date, 1 AS docstatus,
  CASE WHEN p_partkey % 5 = 4 THEN 'Stock Reconciliation' ELSE 'Opening Stock' END AS purpose
FROM {part}""",
    "account": """
SELECT 'A-1000' AS name, '1000' AS account_number, 'Cash' AS account_name, 'Assets' AS parent_account, 0 AS is_group,
  'No' AS restrict_account_view, 'Cash' AS account_type, 0 AS disabled
UNION ALL SELECT 'A-1100', '1100', 'Receivable', 'Assets', 0, 'No', 'Receivable', 0
UNION ALL SELECT 'A-4000', '4000', 'Sales', 'Income', 0, 'No', 'Income', 0
UNION ALL SELECT 'A-5000', '5000', 'Unused', 'Expenses', 0, 'No', 'Expense', 1
UNION ALL SELECT 'A-9000', '9000', 'Hidden', 'Income', 0, 'Yes', NULL, 0
UNION ALL SELECT 'A-1', '1', 'Assets', NULL, 1, 'No', NULL, 0""",
    "singles": """
SELECT 'Selling Settings' AS doctype, 'selling_price_list' AS field, 'Standard Selling' AS value
UNION ALL SELECT 'Buying Settings', 'buying_price_list', 'Buying'
UNION ALL SELECT 'Global Defaults', 'default_company', 'Main Company'""",
    "item_price": """
SELECT 'IP-' || cast(p_partkey AS string) || '-' || y AS name, 'I-' || cast(p_partkey AS string) AS item_code,
  nullif(y, '1998') AS production_year, 'Standard Selling' AS price_list, 1 AS selling,
  CASE WHEN p_partkey % 11 = 0 THEN cast(0 AS decimal(18,2)) ELSE cast(p_retailprice AS decimal(18,2)) END AS price_list_rate,
  'Nos' AS uom, cast(NULL AS date) AS valid_from, cast(NULL AS date) AS valid_upto, cast(NULL AS string) AS customer,
  cast(NULL AS string) AS supplier, cast(NULL AS string) AS batch_no,
  CASE WHEN p_size < 20 THEN NULL WHEN p_size < 40 THEN 0 ELSE 4 END AS packing_unit, p_name AS item_name, p_brand AS brand
FROM (SELECT *, '1997' AS y FROM {part} UNION ALL SELECT *, '1998' AS y FROM {part} WHERE p_size < 35) p
UNION ALL SELECT 'IP-' || cast(p_partkey AS string) || '-e', 'I-' || cast(p_partkey AS string), '', 'Standard Selling', 1,
  cast(p_retailprice AS decimal(18,2)), 'Nos', NULL, NULL, NULL, NULL, NULL, 0, 'old ' || p_name, p_brand
FROM {part} WHERE p_type = 'PROMO' OR p_size >= 35
UNION ALL SELECT 'IP-' || cast(p_partkey AS string) || '-w', 'I-' || cast(p_partkey AS string), '', 'Wholesale', 1,
  cast(cast(p_retailprice AS decimal(18,2)) * cast(0.9 AS decimal(2,1)) AS decimal(18,2)), 'Nos', NULL, NULL, NULL, NULL,
  NULL, 0, p_name, p_brand
FROM {part} WHERE p_type = 'LARGE'
UNION ALL SELECT 'IP-' || cast(p_partkey AS string) || '-b', 'I-' || cast(p_partkey AS string), '', 'Buying', 0,
  cast(p_retailprice AS decimal(18,2)), 'Nos', NULL, NULL, NULL, NULL, NULL, 0, p_name, p_brand
FROM {part} WHERE p_type = 'SMALL'""",
    "price_change": """
SELECT 'IP-' || cast(p_partkey AS string) || '-1997' AS name, 'I-' || cast(p_partkey AS string) AS item_code,
  p_name AS item_name, '1997' AS production_year,
  CASE WHEN p_size < 25 THEN cast(p_retailprice AS decimal(18,2)) + cast(5 AS decimal(18,2))
    ELSE cast(p_retailprice AS decimal(18,2)) END AS price
FROM {part} WHERE p_type = 'MEDIUM'
UNION ALL SELECT NULL, 'I-' || cast(p_partkey AS string), p_name, '2001', cast(p_retailprice AS decimal(18,2))
FROM {part} WHERE p_type = 'PROMO'""",
    "price_list": """
SELECT 'Standard Selling' AS name, 1 AS selling UNION ALL SELECT 'Wholesale', 1 UNION ALL SELECT 'Buying', 0""",
    "purchase_receipt": """
SELECT 'PR-' || cast(s_suppkey AS string) AS name, s_name AS title,
  DATE '1999-06-01' + cast(s_suppkey % 90 AS int) AS posting_date,
  CASE WHEN s_suppkey % 3 = 0 THEN 0 WHEN s_suppkey % 20 = 1 THEN 2 ELSE 1 END AS docstatus,
  CASE WHEN s_suppkey % 40 = 7 THEN 1 ELSE 0 END AS is_return,
  CASE WHEN s_suppkey % 6 = 0 THEN 1 ELSE 0 END AS virtual_receipt,
  cast(1000000 + s_suppkey AS decimal(18,2)) AS base_grand_total, cast(200000 + s_suppkey AS decimal(18,2)) AS grand_total,
  CASE WHEN s_suppkey % 4 = 0 THEN 'EUR' ELSE 'USD' END AS currency, cast(s_suppkey % 90 AS decimal(18,3)) AS total_qty, 'Supplier ' || cast(s_suppkey AS string) AS supplier,
  'A-6000' AS freight_account, 'USD' AS freight_account_currency,
  CASE WHEN s_nationkey < 5 THEN cast(0 AS decimal(18,2)) ELSE cast(s_suppkey * 10 + 1 AS decimal(18,2)) END AS freight_amount,
  cast(4.85 AS decimal(18,4)) AS freight_exchange_rate,
  'A-6100' AS inspection_account, 'USD' AS inspection_account_currency,
  CASE WHEN s_nationkey < 12 THEN NULL ELSE cast(s_nationkey AS decimal(18,2)) END AS inspection_amount,
  cast(4.80 AS decimal(18,4)) AS inspection_exchange_rate,
  'A-6200' AS clearance_account, cast(100 AS decimal(18,2)) AS clearance_amount,
  'A-6300' AS transport_account, cast(50 AS decimal(18,2)) AS transport_amount,
  'A-6400' AS foreign_bank_charges_account, 'EUR' AS foreign_bank_charges_account_currency,
  CASE WHEN s_acctbal < 0 THEN cast(30 AS decimal(18,2)) ELSE cast(0 AS decimal(18,2)) END AS foreign_bank_charges_amount,
  cast(5.25 AS decimal(18,4)) AS foreign_bank_charges_exchange_rate,
  'A-6500' AS local_bank_charges_account,
  CASE WHEN s_acctbal > 5000 THEN cast(12.5 AS decimal(18,2)) ELSE NULL END AS local_bank_charges_amount
FROM {supplier}""",
    "purchase_receipt_item": f"""
SELECT 'PRI-' || {_LINE} AS name, 'PR-' || cast(l_suppkey AS string) AS parent, l_linenumber AS idx,
  CASE WHEN l_suppkey % 3 = 0 THEN 0 WHEN l_suppkey % 20 = 1 THEN 2 ELSE 1 END AS docstatus,
  'I-' || cast(l_partkey AS string) AS item_code, 'Brand#' || cast(l_partkey % 25 AS string) AS brand,
  'item ' || cast(l_partkey AS string) AS item_name, {_YEAR} AS production_year,
  'WH-' || cast(l_orderkey % 3 AS string) AS warehouse, {_QTY} AS qty, {_RATE} AS rate, {_PRICE} AS amount,
  {_PRICE} AS base_net_amount,
  cast({_PRICE} * cast(l_tax AS decimal(4,2)) AS decimal(18,4)) AS item_tax_amount
FROM {{lineitem}} WHERE l_linenumber <= 5""",
    "purchase_invoice": """
SELECT 'PI-' || cast(s_suppkey AS string) AS name, DATE '1999-06-01' AS posting_date,
  CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE 1 END AS docstatus, CASE WHEN s_suppkey % 9 = 0 THEN 1 ELSE 0 END AS is_return,
  CASE WHEN s_acctbal > 1000 THEN 1 ELSE 0 END AS update_stock,
  CASE WHEN s_nationkey < 8 THEN 'CFR' ELSE 'FOB' END AS custom_incoterm,
  CASE WHEN s_nationkey < 12 THEN 'LC' ELSE 'TT' END AS payment_method,
  'A-6000' AS freight_account, 'USD' AS freight_account_currency, cast(s_suppkey + 1 AS decimal(18,2)) AS freight_amount,
  cast(4.85 AS decimal(18,4)) AS freight_exchange_rate,
  'A-6100' AS inspection_account, 'USD' AS inspection_account_currency, cast(s_nationkey AS decimal(18,2)) AS inspection_amount,
  cast(4.80 AS decimal(18,4)) AS inspection_exchange_rate,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'A-6200' END AS clearance_account,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE cast(100 AS decimal(18,2)) END AS clearance_amount,
  CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE 'A-6300' END AS transport_account,
  CASE WHEN s_suppkey % 8 = 0 THEN cast(0 AS decimal(18,2)) ELSE cast(50 AS decimal(18,2)) END AS transport_amount,
  CASE WHEN s_acctbal < 0 THEN cast(30 AS decimal(18,2)) ELSE NULL END AS foreign_bank_charges_amount,
  CASE WHEN s_acctbal < 0 THEN cast(5.25 AS decimal(18,4)) ELSE NULL END AS foreign_bank_charges_exchange_rate,
  CASE WHEN s_acctbal > 5000 THEN cast(12.5 AS decimal(18,2)) ELSE NULL END AS local_bank_charges_amount
FROM {supplier}""",
    "stock_entry": """
SELECT 'SE-' || cast(s_suppkey AS string) AS name, DATE '1999-06-01' AS posting_date,
  CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 END AS docstatus,
  CASE WHEN s_nationkey < 15 THEN 'Material Receipt' ELSE 'Material Transfer' END AS stock_entry_type,
  CASE WHEN s_nationkey < 10 THEN 'A-7000' ELSE NULL END AS expense_account
FROM {supplier}""",
    "stock_entry_detail": f"""
SELECT 'SED-' || {_LINE} AS name, 'SE-' || cast(l_suppkey AS string) AS parent, 'I-' || cast(l_partkey AS string) AS item_code,
  CASE WHEN l_discount < 0.02 THEN NULL ELSE {_QTY} END AS qty, 'A-7999' AS expense_account
FROM {{lineitem}} WHERE l_linenumber = 7""",
    "bin": """
SELECT item_code, warehouse, sum(actual_qty) AS actual_qty, sum(stock_value_difference) AS stock_value
FROM stock_ledger_entry WHERE is_cancelled = 0 GROUP BY item_code, warehouse""",
    "translation": """
SELECT 'ar' AS language, 'Sales Invoice' AS source_text, 'SI_ar' AS translated_text
UNION ALL SELECT 'ar', 'Sales Invoice', 'SI_ar_2' UNION ALL SELECT 'ar', 'Receipt Voucher', 'RV_ar'
UNION ALL SELECT 'ar', 'Purchase Receipt', 'PR_ar' UNION ALL SELECT 'fr', 'Sales Invoice', 'SI_fr'""",
    "legacy_purchase_ledger": """
SELECT 'I-' || cast(p_partkey AS string) AS item_code, DATE '1994-06-01' AS posting_date, cast(5 AS decimal(18,3)) AS actual_qty
FROM {part} WHERE p_size <= 25""",
    "receipt_voucher": """
SELECT 'RV-' || cast(o_orderkey AS string) AS name, 1 AS docstatus,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Account' ELSE 'Customer' END AS receipt_from,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Customer' END AS party_type,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'C-' || cast(o_custkey AS string) END AS party,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Customer ' || cast(o_custkey AS string) END AS party_name,
  cast(o_orderdate AS date) + 30 AS posting_date, 'A-1100' AS paid_from, 'A-1000' AS paid_to,
  cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) AS paid_amount, cast(1 AS decimal(21,9)) AS source_exchange_rate,
  cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) AS received_amount,
  CASE WHEN o_orderkey % 101 = 0 THEN cast(1.01 AS decimal(21,9)) ELSE cast(1 AS decimal(21,9)) END AS target_exchange_rate,
  CASE WHEN o_orderkey % 5 = 0 THEN cast(10 AS decimal(21,3)) ELSE cast(0 AS decimal(21,3)) END AS banking_charges,
  'LYD' AS paid_from_account_currency,
  CASE WHEN o_orderkey % 101 = 0 THEN 'USD' ELSE 'LYD' END AS paid_to_account_currency, 'receipt ' || o_orderpriority AS remark
FROM {orders} WHERE o_orderstatus = 'F' AND o_orderpriority <> '3-MEDIUM'""",
    "payment_voucher": """
SELECT 'PV-' || cast(o_orderkey AS string) AS name, CASE WHEN o_orderkey % 50 = 1 THEN 0 ELSE 1 END AS docstatus,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Supplier' WHEN o_orderkey % 3 = 1 THEN 'Customer' ELSE 'Account' END AS payment_to,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Supplier' WHEN o_orderkey % 3 = 1 THEN 'Customer' ELSE '' END AS party_type,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE 'X-' || cast(o_custkey AS string) END AS party,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE 'Party ' || cast(o_custkey AS string) END AS party_name,
  cast(o_orderdate AS date) + 21 AS posting_date, 'A-1000' AS paid_from, 'A-2100' AS paid_to,
  -cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) AS paid_amount, cast(4.85 AS decimal(21,9)) AS source_exchange_rate,
  CASE WHEN o_orderkey % 60 = 2 THEN NULL ELSE -cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) END AS received_amount,
  cast(4.85 AS decimal(21,9)) AS target_exchange_rate, cast(0 AS decimal(21,3)) AS banking_charges, 'USD' AS paid_from_account_currency, 'USD' AS paid_to_account_currency,
  'payment ' || o_orderpriority AS remark
FROM {orders} WHERE o_orderstatus = 'P'""",
    "transfer_voucher": """
SELECT 'TV-' || cast(o_orderkey AS string) AS name, 1 AS docstatus, cast(o_orderdate AS date) + 2 AS posting_date,
  'A-1000' AS paid_from, 'A-1010' AS paid_to,
  cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) AS paid_amount, cast(1 AS decimal(21,9)) AS source_exchange_rate,
  cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) AS received_amount, cast(1 AS decimal(21,9)) AS target_exchange_rate,
  CASE WHEN o_orderstatus = 'O' THEN cast(7.5 AS decimal(21,3)) ELSE NULL END AS banking_charges,
  CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS sender, 'A-6600' AS charge_account,
  'LYD' AS paid_from_account_currency, 'LYD' AS paid_to_account_currency, 'transfer ' || o_orderpriority AS remark
FROM {orders} WHERE o_orderpriority = '2-HIGH'""",
    "clearing_voucher": """
SELECT 'CV-' || cast(o_orderkey AS string) AS name, 1 AS docstatus, cast(o_orderdate AS date) + 3 AS posting_date,
  'A-1100' AS from_account, 'Customer' AS from_party_type, 'C-' || cast(o_custkey AS string) AS from_party,
  'A-2100' AS to_account, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'Supplier' END AS to_party_type,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'X-' || cast(o_custkey AS string) END AS to_party,
  cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) AS deducted_amount, cast(1 AS decimal(21,9)) AS source_exchange_rate,
  cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) AS added_amount,
  CASE WHEN o_orderkey % 77 = 0 THEN cast(1.5 AS decimal(21,9)) ELSE cast(1 AS decimal(21,9)) END AS target_exchange_rate,
  'LYD' AS from_account_currency, CASE WHEN o_orderkey % 77 = 0 THEN 'EUR' ELSE 'LYD' END AS to_account_currency,
  'clearing ' || o_orderpriority AS remark
FROM {orders} WHERE o_orderpriority = '3-MEDIUM'""",
    "debt_voucher": """
SELECT 'DV-' || cast(o_orderkey AS string) AS name, 1 AS docstatus, cast(o_orderdate AS date) + 14 AS posting_date,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Add' ELSE 'Deduct' END AS type, 'Main Company' AS company,
  'A-1100' AS from_or_to_account, 'Customer' AS party_type, 'C-' || cast(o_custkey AS string) AS party,
  cast(cast(o_totalprice AS decimal(18,2)) AS decimal(21,3)) AS amount,
  CASE WHEN o_orderkey % 9 = 0 THEN cast(4.85 AS decimal(21,9)) ELSE cast(1 AS decimal(21,9)) END AS exchange_rate,
  CASE WHEN o_orderkey % 9 = 0 THEN 'USD' ELSE 'LYD' END AS account_currency, 'debt ' || o_orderpriority AS remark
FROM {orders} WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'""",
    "company": """
SELECT 'Main Company' AS name, 'A-8100' AS write_up_account, 'A-8200' AS write_off_account, 1 AS validate_selling_price_so
UNION ALL SELECT 'Another Company', 'A-8101', 'A-8201', 0""",
    "sales_adjustment_request": """
SELECT 'SAR-' || cast(o_orderkey AS string) AS name, 'SI-' || cast(o_orderkey AS string) AS sales_invoice,
  'C-' || cast(o_custkey AS string) AS customer, 1 AS docstatus
FROM {orders} WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "sales_adjustment_increase": f"""
SELECT 'SAR-' || cast(l_orderkey AS string) AS parent, l_linenumber AS idx, 'I-' || cast(l_partkey AS string) AS item_code,
  {_YEAR} AS production_year, {_QTY} AS qty, {_RATE} AS rate
FROM {{lineitem}} WHERE l_returnflag = 'A' AND l_linestatus = 'O'""",
    "sales_adjustment_decrease": f"""
SELECT 'SAR-' || cast(l_orderkey AS string) AS parent, l_linenumber AS idx, 'I-' || cast(l_partkey AS string) AS item_code,
  {_YEAR} AS production_year, {_QTY} AS qty, {_RATE} AS rate
FROM {{lineitem}} WHERE l_returnflag = 'R' AND l_linestatus = 'O'""",
}

_READS = {"bin": ("stock_ledger_entry",)}


def with_clause(names: list[str] | tuple[str, ...], raw: dict[str, str] | None = None) -> str:
    """``WITH`` items for the views in ``names`` and whatever these read, raw tables named by ``raw``."""
    raw = raw or {t: t for t in RAW_TABLES}
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        for parent in _READS.get(name, ()):
            visit(parent)
        needed.append(name)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].format(**raw)})" for n in needed)


def views_in(sql: str) -> list[str]:
    """The views of this module that a query text names."""
    words = set(re.findall(r"[a-z_]+", sql))
    return [v for v in VIEWS if v in words]
