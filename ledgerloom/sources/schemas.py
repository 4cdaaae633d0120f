"""Column types of the business tables, one Spark DDL string per table.

Amounts are decimals, never doubles, so that sums do not depend on the order in which tasks finish.
Checks (0/1) stay integers.  ``production_year`` may be NULL or '' and both mean "no year".
"""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = "decimal(21,3)"
_QTY = "decimal(18,3)"
_RATE = "decimal(21,9)"

TABLES: dict[str, str] = {
    "gl_entry": f"account string, party_type string, party string, posting_date date, voucher_type string, voucher_no string, "
    f"debit {_MONEY}, credit {_MONEY}, is_opening string, is_cancelled int, remarks string",
    "stock_ledger_entry": f"name string, voucher_type string, voucher_no string, item_code string, production_year string, "
    f"warehouse string, posting_date date, posting_datetime timestamp, actual_qty {_QTY}, stock_value_difference {_MONEY}, is_cancelled int, "
    f"qty_after_transaction {_QTY}, valuation_rate {_RATE}, is_adjustment_entry int",
    "bin": f"item_code string, warehouse string, actual_qty {_QTY}, stock_value {_MONEY}",
    "item": "name string, item_code string, item_name string, brand string, item_group string, country_of_origin string, "
    "tire_size string, ply_rating int, is_stock_item int, description string",
    "tire_size": "name string, sorting_code string",
    "customer_master": "name string, customer_name string, customer_group string, payment_terms string, bypass_overdue_check int, disabled int",
    "payment_terms_detail": "parent string, credit_days int",
    "customer_credit_limit": f"parent string, parenttype string, credit_limit {_MONEY}",
    "sales_order": f"name string, customer string, transaction_date date, docstatus int, status string, reservation_status string, "
    f"set_warehouse string, total {_MONEY}, grand_total {_MONEY}, selling_price_list string, billing_status string, "
    "delivery_status string, per_billed double, per_delivered double",
    "sales_order_item": f"name string, parent string, docstatus int, idx int, item_code string, production_year string, qty {_QTY}, "
    f"delivered_qty {_QTY}, billed_qty {_QTY}, amount {_MONEY}, billed_amt {_MONEY}, rate double, net_rate double, "
    "price_list_rate double, valuation_rate double, brand string, uom string, stock_uom string, conversion_factor double, delivery_date date",
    "sales_invoice": f"name string, customer string, customer_name string, posting_date date, docstatus int, is_return int, "
    f"is_opening string, update_stock int, is_paid int, grand_total {_MONEY}, outstanding_amount {_MONEY}, debit_to string, "
    f"payment_account string, custom_payment_value_is_different int, custom_payment_value {_MONEY}, conversion_rate {_RATE}, "
    "currency string, company string, set_warehouse string, selling_price_list string",
    "sales_invoice_item": f"name string, parent string, docstatus int, item_code string, sales_order string, production_year string, "
    f"qty {_QTY}, net_amount {_MONEY}, rate double, net_rate double, incoming_rate double, so_detail string, dn_detail string, "
    "delivery_note string",
    "delivery_note": "name string, customer string, posting_date date, docstatus int, set_warehouse string, billing_status string",
    "delivery_note_item": f"name string, parent string, docstatus int, item_code string, production_year string, qty {_QTY}, "
    f"billed_qty {_QTY}, rate double, price_list_rate double, so_detail string, against_sales_order string",
    "purchase_receipt": f"name string, title string, posting_date date, docstatus int, is_return int, virtual_receipt int, "
    f"base_grand_total {_MONEY}, grand_total {_MONEY}, currency string, total_qty {_QTY}, supplier string, freight_account string, freight_account_currency string, freight_amount {_MONEY}, "
    f"freight_exchange_rate {_RATE}, inspection_account string, inspection_account_currency string, inspection_amount {_MONEY}, "
    f"inspection_exchange_rate {_RATE}, clearance_account string, clearance_amount {_MONEY}, transport_account string, "
    f"transport_amount {_MONEY}, foreign_bank_charges_account string, foreign_bank_charges_account_currency string, "
    f"foreign_bank_charges_amount {_MONEY}, foreign_bank_charges_exchange_rate {_RATE}, local_bank_charges_account string, "
    f"local_bank_charges_amount {_MONEY}",
    "purchase_receipt_item": f"name string, parent string, idx int, docstatus int, item_code string, brand string, item_name string, "
    f"production_year string, warehouse string, qty {_QTY}, rate double, amount {_MONEY}, base_net_amount {_MONEY}, "
    f"item_tax_amount {_MONEY}",
    "purchase_invoice": f"name string, posting_date date, docstatus int, is_return int, update_stock int, custom_incoterm string, "
    f"payment_method string, freight_account string, freight_account_currency string, freight_amount {_MONEY}, "
    f"freight_exchange_rate {_RATE}, inspection_account string, inspection_account_currency string, inspection_amount {_MONEY}, "
    f"inspection_exchange_rate {_RATE}, clearance_account string, clearance_amount {_MONEY}, transport_account string, "
    f"transport_amount {_MONEY}, foreign_bank_charges_amount {_MONEY}, foreign_bank_charges_exchange_rate {_RATE}, "
    f"local_bank_charges_amount {_MONEY}",
    "stock_entry": "name string, posting_date date, docstatus int, stock_entry_type string, expense_account string",
    "stock_entry_detail": f"name string, parent string, item_code string, qty {_QTY}, expense_account string",
    "stock_reconciliation": "name string, posting_date date, docstatus int, purpose string",
    "legacy_purchase_ledger": f"item_code string, posting_date date, actual_qty {_QTY}",
    "item_price": f"name string, item_code string, production_year string, price_list string, selling int, price_list_rate {_MONEY}, "
    "uom string, valid_from date, valid_upto date, customer string, supplier string, batch_no string, packing_unit int, "
    "item_name string, brand string",
    "price_list": "name string, selling int",
    "singles": "doctype string, field string, value string",
    "account": "name string, account_number string, account_name string, parent_account string, is_group int, "
    "restrict_account_view string, account_type string, disabled int",
    "payment_entry": f"name string, docstatus int, posting_date date, party string, unallocated_amount {_MONEY}, "
    "custom_voucher_type string, custom_voucher_no string",
    "journal_entry": "name string, docstatus int, posting_date date, custom_voucher_type string, custom_voucher_no string, "
    "is_system_generated int",
    "journal_entry_account": f"parent string, party string, credit {_MONEY}, reference_name string, docstatus int",
    "translation": "language string, source_text string, translated_text string",
    "receipt_voucher": f"name string, docstatus int, receipt_from string, party_type string, party string, party_name string, "
    f"posting_date date, paid_from string, paid_to string, paid_amount {_MONEY}, source_exchange_rate {_RATE}, "
    f"received_amount {_MONEY}, target_exchange_rate {_RATE}, banking_charges {_MONEY}, paid_from_account_currency string, "
    "paid_to_account_currency string, remark string",
    "payment_voucher": f"name string, docstatus int, payment_to string, party_type string, party string, party_name string, "
    f"posting_date date, paid_from string, paid_to string, paid_amount {_MONEY}, source_exchange_rate {_RATE}, "
    f"received_amount {_MONEY}, target_exchange_rate {_RATE}, banking_charges {_MONEY}, paid_from_account_currency string, "
    "paid_to_account_currency string, remark string",
    "transfer_voucher": f"name string, docstatus int, posting_date date, paid_from string, paid_to string, paid_amount {_MONEY}, "
    f"source_exchange_rate {_RATE}, received_amount {_MONEY}, target_exchange_rate {_RATE}, banking_charges {_MONEY}, sender int, "
    "charge_account string, paid_from_account_currency string, paid_to_account_currency string, remark string",
    "clearing_voucher": f"name string, docstatus int, posting_date date, from_account string, from_party_type string, "
    f"from_party string, to_account string, to_party_type string, to_party string, deducted_amount {_MONEY}, "
    f"source_exchange_rate {_RATE}, added_amount {_MONEY}, target_exchange_rate {_RATE}, from_account_currency string, "
    "to_account_currency string, remark string",
    "debt_voucher": f"name string, docstatus int, posting_date date, type string, company string, from_or_to_account string, "
    f"party_type string, party string, amount {_MONEY}, exchange_rate {_RATE}, account_currency string, remark string",
    "company": "name string, write_up_account string, write_off_account string, validate_selling_price_so int",
    "sales_adjustment_request": "name string, sales_invoice string, customer string, docstatus int",
    "sales_adjustment_increase": f"parent string, idx int, item_code string, production_year string, qty {_QTY}, rate double",
    "sales_adjustment_decrease": f"parent string, idx int, item_code string, production_year string, qty {_QTY}, rate double",
    "order_line_change": f"parent string, docname string, idx int, item_code string, production_year string, qty {_QTY}, rate double",
    "purchase_order_item": f"name string, parent string, docstatus int, idx int, item_code string, production_year string, brand string, qty {_QTY}, "
    f"received_qty {_QTY}, billed_amt {_MONEY}, rate double, price_list_rate double, uom string, stock_uom string, "
    "conversion_factor double, schedule_date date",
    "sales_line_list": f"parent string, docname string, idx int, item_code string, production_year string, brand string, qty {_QTY}, rate double, "
    "uom string, conversion_factor double, delivery_date date",
    "purchase_line_list": f"parent string, docname string, idx int, item_code string, production_year string, brand string, qty {_QTY}, rate double, "
    "uom string, conversion_factor double, schedule_date date",
    "uom_conversion_detail": "parent string, uom string, conversion_factor double",
    "price_change": f"name string, item_code string, item_name string, production_year string, price {_MONEY}",
}


def struct(name: str) -> T.StructType:
    """The schema of one table."""
    return T.StructType.fromDDL(TABLES[name])
