"""Every public operator and report under its name, with the parameters of the default run."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import normalize_dim, report_with_total, sanitize_cells, with_total_row
from ledgerloom.functions.predicates import filter_spec
from ledgerloom.operators import atp, counters, export, fulfilment, gl, parties, pricing, sales, stock, valuation, vouchers
from ledgerloom.plans import accounts, customers, items
from ledgerloom.plans import stock as stock_reports
from ledgerloom.session import checkpoint_dir
from ledgerloom.sources.erp_views import RAW_TABLES
from ledgerloom.sources.tables import Tables
from ledgerloom.streaming.price_state import ledger_deltas, order_deltas, order_line_images, price_state_stream, price_table, sums_table

FROM, TO = "1997-01-01", "1999-12-31"
PRICE_FILTER = '[["Item Price","price_list","=","Standard Selling"],["selling","=",1],["price_list_rate",">",905],["packing_unit","in",[0,4]]]'


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles at the very end."""
    exact = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in exact})


def busiest_pairs(t: Tables) -> DataFrame:
    """Each account paired with the customer whose balance moved most, for the consolidated statement."""
    moved = t.gl_entry.filter("party_type = 'Customer'").groupBy("party").agg(F.sum(F.col("debit") + F.col("credit")).alias("_m"))
    customer = moved.agg(F.max_by("party", F.struct("_m", "party")).alias("customer"))
    return t.account.filter("is_group = 0").select(F.col("name").alias("account"), customer.scalar().alias("customer"))


def _account_key(t: Tables) -> DataFrame:
    return t.account.filter("is_group = 0").select(F.col("name").alias("account"))


def _period(t: Tables) -> DataFrame:
    return gl.period_transactions(t.gl_entry, t, ["account"], FROM, TO)


def _running_balance(t: Tables) -> DataFrame:
    balances = gl.key_balances(t.gl_entry, ["account"], FROM, TO, _account_key(t))
    lines = gl.statement_lines(balances, _period(t), ["account"], totals=False)
    return lines.select("account", "row_kind", "posting_date", "voucher_no", "remarks", "balance")


def _total_row(t: Tables) -> DataFrame:
    return with_total_row(accounts.account_balances(t, TO), "account_name", ["debit", "credit"])


def _doubled(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("decimal(28,9)"), places).cast("double") for c in columns})


_RATES = ("receipt_valuation_rate", "stock_valuation_rate")

OPERATORS: dict[str, Callable[[Tables], DataFrame]] = {
    # shared blocks
    "normalize_dim": lambda t: normalize_dim(t.sales_order_item).groupBy("production_year").agg(F.count("*").alias("n")),
    "stock_qty": lambda t: stock.stock_qty(t, TO, positive=True),
    "valuation_rate_ledger": lambda t: _doubled(stock.valuation_rate_ledger(t, TO), 6, "valuation_rate"),
    "valuation_rate_bin": lambda t: _doubled(stock.valuation_rate_bin(t), 6, "valuation_rate"),
    "reserved_qty": lambda t: stock.reserved_qty(t, TO),
    "reserved_qty_having": stock.reserved_qty_having,
    "virtual_receipt_qty": stock.virtual_receipt_qty,
    "selling_price": stock.selling_price,
    "item_dim_by_year": lambda t: stock.item_years(t).select("item_code", "item_name", "brand", "is_stock_item", "tire_size", "production_year"),
    "custom_voucher_map": lambda t: gl.custom_voucher_map(t, FROM, TO),
    "exclude_system_je": lambda t: gl.exclude_system_je(t.gl_entry, t).select("account", "voucher_type", "voucher_no", "debit", "credit"),
    "opening_balance": lambda t: gl.opening_balance(t.gl_entry, ["account"], FROM, _account_key(t)),
    "period_transactions": _period,
    "statement_total": lambda t: gl.statement_total(_period(t), t.gl_entry, ["account"], TO, _account_key(t)),
    "running_balance": _running_balance,
    "translate_voucher_type": lambda t: gl.translate_voucher_type(_period(t), t).select("account", "voucher_type", "voucher_no", "translated_voucher_type"),
    "against_party": gl.against_party,
    "invoice_order_link": gl.invoice_order_link,
    "party_balance": lambda t: parties.party_balance(t, TO),
    "unbilled_orders": lambda t: _doubled(parties.unbilled_orders(t, TO), 4, "unbilled"),
    "credit_limit": parties.credit_limit,
    "overdue": lambda t: parties.overdue(t, TO),
    "potential_overdue": lambda t: parties.potential_overdue(t, TO),
    "sales_by_item": lambda t: sales.sales_by(t, "item_code", FROM, TO),
    "sales_by_customer": lambda t: sales.sales_by(t, "customer", FROM, TO),
    "cogs_by_item": lambda t: stock.cogs_by_item(t, FROM, TO),
    "cogs_by_customer": lambda t: stock.cogs_by_customer(t, FROM, TO),
    "movement_sums": lambda t: stock.stock_movements(t, FROM, TO),
    "opening_stock_reclass": lambda t: stock.stock_movements(t, FROM, TO).select("item_code", "opening_stock"),
    "markup_text": lambda t: sales.item_markup(t, FROM, TO),
    "with_total_row": _total_row,
    # reports
    "account_balances": lambda t: accounts.account_balances(t, TO),
    "account_statement": lambda t: accounts.account_statement(t, FROM, TO),
    "unexplained_balance": lambda t: accounts.unexplained_balance(accounts.account_statement(t, FROM, TO), "account"),
    "cash_bank_statement": lambda t: accounts.cash_bank_statement(t, FROM, TO),
    "customer_statement": lambda t: accounts.customer_statement(t, FROM, TO),
    "consolidated_statement": lambda t: accounts.consolidated_statement(t, busiest_pairs(t), FROM, TO),
    "consolidated_parts": lambda t: accounts.consolidated_parts(t, FROM, TO),
    "customer_balances": lambda t: customers.customer_balances(t, TO),
    "customer_balances_overdue": lambda t: customers.customer_balances(t, TO, customers.OVERDUE),
    "customer_balances_over_credit": lambda t: customers.customer_balances(t, TO, customers.OVER_CREDIT),
    "customer_balances_credit": lambda t: customers.customer_balances(t, TO, customers.CREDIT_WITHOUT),
    "customer_performance": lambda t: customers.customer_performance(t, FROM, TO),
    "item_performance": lambda t: items.item_performance(t, FROM, TO),
    "brand_performance": lambda t: items.brand_performance(t, FROM, TO),
    "item_transactions": lambda t: items.item_transactions(t, FROM, TO),
    "brand_transactions": lambda t: items.brand_transactions(t, FROM, TO),
    "item_ledger": lambda t: items.item_ledger(t, FROM, TO),
    "item_reservations": items.item_reservations,
    "item_sales_ledger": lambda t: items.item_sales_ledger(t, FROM, TO),
    "receipt_details": items.receipt_details,
    "stock_ageing": lambda t: stock_reports.stock_ageing(t, TO),
    "stock_balance": lambda t: stock_reports.stock_balance(t, TO, stock_reports.AVAILABLE),
    "stock_balance_strict": lambda t: stock_reports.stock_balance(t, TO, stock_reports.AVAILABLE, strict=True),
    "available_items": lambda t: stock_reports.available_items(t, TO, stock_reports.AVAILABLE),
    "stock_balance_prices": lambda t: stock_reports.stock_balance_prices(t, TO),
    "stock_balance_prices_future": lambda t: stock_reports.stock_balance_prices(t, TO, stock_reports.FUTURE, 0),
    "stock_balance_cost_prices": lambda t: stock_reports.stock_balance_cost_prices(t, TO),
    # batch jobs
    "available_to_promise": atp.available_to_promise,
    "available_to_promise_any_year": lambda t: atp.available_to_promise(t, any_year=True),
    "order_shortages": atp.order_shortages,
    "unvirtualize_check": atp.unvirtualize_check,
    "customer_credit_status": lambda t: _doubled(parties.customer_credit_status(t, TO), 4, "unbilled"),
    "overdue_blocks": lambda t: parties.overdue_blocks(t, TO),
    "price_metrics_refresh": lambda t: _doubled(pricing.price_metrics_refresh(t).select("name", "item_code", "production_year", *pricing.METRICS), 6, "stock_valuation_rate"),
    "price_floor_violations": lambda t: _doubled(pricing.order_price_violations(t), 6, "net_rate", "floor"),
    "invoice_price_violations": lambda t: _doubled(pricing.invoice_price_violations(t), 6, "net_rate", "floor"),
    "price_increase": lambda t: pricing.price_increase(pricing.price_metrics_refresh(t), 15, '[["selling","=",1]]').select("name", "price_list_rate"),
    "receipt_pricing_worksheet": lambda t: _doubled(pricing.receipt_pricing_worksheet(t), 4, *_RATES),
    "proposed_price": lambda t: pricing.proposed_price(pricing.receipt_pricing_worksheet(t), 20).select("purchase_receipt", "item_code", "production_year", "proposed_price"),
    "price_upsert": lambda t: pricing.price_upsert(t, t.price_change).select("name", "item_code", "production_year", "price_list", "price_list_rate", "action"),
    "price_grid_completion": lambda t: pricing.price_grid_completion(t, t.purchase_receipt_item),
    "item_price_defaults": pricing.item_price_defaults,
    "price_attribute_sync": lambda t: pricing.price_attribute_sync(t).select("name", "item_name", "brand", "item_description"),
    "duplicate_prices": lambda t: pricing.duplicate_prices(t).select("item_code", "price_list", "production_year", "packing_unit", "n", "first_name"),
    "price_segments": lambda t: pricing.price_segments(pricing.price_metrics_refresh(t)).select("name", "in_stock", "available", "non_priced", "non_profitable"),
    "price_lookup": lambda t: pricing.price_lookup(t, t.sales_invoice_item).select("name", "item_code", "production_year", "list_price", "return_price"),
    "pending_delivery_lines": fulfilment.pending_delivery_lines,
    "pending_billing_lines": fulfilment.pending_billing_lines,
    "billed_qty_rollup": fulfilment.billed_qty_rollup,
    "delivery_billing_status": fulfilment.delivery_billing_status,
    "orders_to_close": fulfilment.orders_to_close,
    "delivery_status": lambda t: fulfilment.delivery_status(t.sales_order).select("name", "indicator"),
    "reconciliation_candidates": fulfilment.reconciliation_candidates,
    "voucher_base_amounts": lambda t: vouchers.voucher_base_amounts(t).select(
        "voucher_type", "voucher_no", "paid_rate", "received_rate", "received_amount", "base_paid_amount", "base_received_amount"),
    "voucher_balance_violations": vouchers.voucher_balance_violations,
    "voucher_ledger_lines": vouchers.voucher_ledger_lines,
    "unbalanced_vouchers": lambda t: vouchers.unbalanced_vouchers(vouchers.voucher_ledger_lines(t)),
    "cash_invoice_lines": vouchers.cash_invoice_lines,
    "landed_cost_lines": vouchers.landed_cost_lines,
    "landed_cost_completeness": vouchers.landed_cost_completeness,
    "clean_incoterm_costs": lambda t: vouchers.clean_incoterm_costs(t).select(
        "name", "freight_account", "freight_amount", "freight_exchange_rate", "inspection_account", "inspection_amount",
        "inspection_exchange_rate", "transport_amount", "clearance_amount", "foreign_bank_charges_amount", "local_bank_charges_amount"),
    "moving_average_valuation": lambda t: _doubled(valuation.moving_average_valuation(t), 6, "valuation_rate"),
    "remark_propagation": lambda t: vouchers.remark_propagation(t).select("account", "voucher_type", "voucher_no", "debit", "credit", "remarks"),
    "order_line_changes": lambda t: fulfilment.order_line_changes(t, t.order_line_change),
    "sales_line_difference": lambda t: fulfilment.sales_line_difference(t, t.sales_line_list),
    "purchase_line_difference": lambda t: fulfilment.purchase_line_difference(t, t.purchase_line_list),
    "line_margin_discount": lambda t: fulfilment.line_margin_discount(t.sales_order_item).select(
        "name", "margin_type", "margin_rate_or_amount", "rate_with_margin", "discount_percentage", "discount_amount"),
    "adjustment_lines": fulfilment.adjustment_lines,
    "empty_adjustments": fulfilment.empty_adjustments,
    "document_counters": counters.document_counters,
    "master_counters": counters.master_counters,
    "receipts_by_year": counters.receipts_by_year,
    "filter_spec": lambda t: filter_spec(t.item_price, PRICE_FILTER).select("name", "price_list_rate", "packing_unit"),
    "receipt_list": fulfilment.receipt_list,
    "export_prices": lambda t: _doubled(export.export_prices(pricing.price_metrics_refresh(t)), 6, "stock_valuation_rate"),
    "export_receipts": export.export_receipts,
    "sanitize_cells": lambda t: sanitize_cells(t.item.select("name", F.concat(F.lit("<b>"), "item_name", F.lit("</b>\x01 "), "description").alias("description")), ["description"]),
    "stock_entry_totals": fulfilment.stock_entry_totals,
    "stock_entry_lines": fulfilment.stock_entry_lines,
}


# The reports that users see with a total row.
WITH_TOTALS = (
    "account_balances", "available_items", "brand_performance", "brand_transactions", "customer_balances", "customer_performance",
    "item_performance", "item_reservations", "item_sales_ledger", "item_transactions", "receipt_details", "stock_ageing", "stock_balance",
    "stock_balance_cost_prices", "stock_balance_prices",
)
OPERATORS |= {f"{name}_totals": lambda t, report=OPERATORS[name]: report_with_total(plain(report(t))) for name in WITH_TOTALS}


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Batches in which the changes arrive at any size. Each batch rewrites what it touches of the sums and prices, with many items nearly all,
#: so batches of a fixed size would rewrite tables that grow more and more often.
PRICE_BATCHES = 2


def _in_batches(spark: SparkSession, changes: DataFrame, folder: str) -> DataFrame:
    """The changes, written to ``folder``, as a stream that arrives in ``PRICE_BATCHES`` batches, or fewer of one file each."""
    changes.write.parquet(folder)
    files = len(spark.read.schema(changes.schema).parquet(folder).inputFiles())
    return spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", max(1, -(-files // PRICE_BATCHES))).parquet(folder)


def price_changes(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The ledger and the order lines as signed changes that end in the tables as they are.

    A tenth of the ledger rows arrives with another quantity first, which is taken back; every order line arrives as it was when its
    order was submitted, and is replaced by what became of it: delivered, finished or cancelled.
    """
    def images(rows: DataFrame, before: dict[str, Column], replaced: Column) -> DataFrame:
        """Every row as it is, and where ``replaced`` as it was ``before`` and that taken back, from one pass over the joins behind it."""
        types = rows.unionByName(rows.withColumns(before)).schema

        def image(sign: int, other: dict[str, Column]) -> Column:
            return F.struct(*(other.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in types), F.lit(sign).alias("sign"))

        now, then = F.array(image(1, {})), F.array(image(1, before), image(-1, before))
        return rows.select(F.inline(F.when(replaced, F.concat(now, then)).otherwise(now)))

    ledger = t.stock_ledger_entry.select("item_code", "production_year", "warehouse", "actual_qty", "stock_value_difference", "is_cancelled")
    is_wrong = F.pmod(F.xxhash64(*ledger.columns), F.lit(10)) == 0
    submitted = {"delivered_qty": F.lit(0).cast("decimal(18,3)"), "docstatus": F.lit(1), "order_docstatus": F.lit(1), "order_status": F.lit("To Deliver and Bill")}
    return (
        images(ledger, {"actual_qty": F.col("actual_qty") + 1, "is_cancelled": F.lit(0)}, is_wrong),
        images(order_line_images(t.sales_order, t.sales_order_item), submitted, F.lit(True)),
    )


def streamed_price_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger and order changes as streams, read in several batches; the price rows of the items in the raw line table at the end."""
    t = Tables.from_star_schema(spark, sf_dir)
    root = _folder(spark, "price-metrics")
    prices = price_table(spark, f"{root}/prices").create(t.item_price.select("*", *(F.lit(None).alias(m) for m in pricing.METRICS)))
    ledger, orders = price_changes(t)
    deltas = ledger_deltas(_in_batches(spark, ledger, f"{root}/ledger")), order_deltas(_in_batches(spark, orders, f"{root}/orders"))
    price_state_stream(deltas[0].unionByName(deltas[1]), sums_table(spark, f"{root}/sums"), prices, f"{root}/checkpoint", once=True).awaitTermination()
    lines = spark.read.schema(RAW_TABLES["lineitem"]).parquet(f"{sf_dir}/lineitem.parquet")
    items = lines.select(F.concat(F.lit("I-"), F.col("l_partkey").cast("string")).alias("item_code")).distinct()
    rows = prices.read().join(items, "item_code", "left_semi")
    return _doubled(rows.select("name", "item_code", "production_year", *pricing.METRICS), 6, "stock_valuation_rate")


def imported_price_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Increased selling prices written as a sheet, read back and imported into a price table of versions."""
    t = Tables.from_star_schema(spark, sf_dir)
    root = _folder(spark, "price-sheet")
    prices = price_table(spark, f"{root}/prices").create(t.item_price.select("*", *(F.lit(None).alias(m) for m in pricing.METRICS)))
    increased = pricing.price_increase(pricing.price_metrics_refresh(t), 15, '[["selling","=",1]]')
    export.write_sheet(export.export_prices(increased), f"{root}/sheet")
    pricing.commit_price_changes(prices, t, pricing.import_price_sheet(export.read_sheet(spark, f"{root}/sheet")), writer=("sheet", 0))
    return prices.read().select("name", "item_code", "production_year", "price_list", "price_list_rate")
