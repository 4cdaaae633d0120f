"""Row conditions that many operators share, and filter lists given as JSON."""

from __future__ import annotations

import json
import operator
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Document states.
DRAFT, SUBMITTED, CANCELLED = 0, 1, 2
FINISHED_ORDER = ("Completed", "Closed")
SALES_VOUCHERS = ("Sales Invoice", "Delivery Note")
PURCHASE_VOUCHERS = ("Purchase Invoice", "Purchase Receipt")
RECEIPT_VOUCHERS = ("Purchase Receipt", "Purchase Invoice", "Stock Entry")
FUTURE_RESERVATION = "Reserve against Future Receipts"


def submitted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("docstatus") == SUBMITTED)


def draft(df: DataFrame) -> DataFrame:
    return df.filter(F.col("docstatus") == DRAFT)


def not_cancelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("docstatus") != CANCELLED)


def live(ledger: DataFrame) -> DataFrame:
    """Ledger rows that were not cancelled."""
    return ledger.filter(F.col("is_cancelled") == 0)


def up_to(df: DataFrame, as_of: str | None, column: str = "posting_date") -> DataFrame:
    return df if as_of is None else df.filter(F.col(column) <= F.lit(as_of).cast("date"))


def within(df: DataFrame, from_date: str, to_date: str, column: str = "posting_date") -> DataFrame:
    return df.filter(F.col(column).between(F.lit(from_date).cast("date"), F.lit(to_date).cast("date")))


def open_orders(orders: DataFrame, as_of: str | None = None) -> DataFrame:
    """Submitted orders that are neither completed nor closed, placed by ``as_of``."""
    return up_to(submitted(orders).filter(~F.col("status").isin(*FINISHED_ORDER)), as_of, "transaction_date")


def only(df: DataFrame, column: str, keys: list[str] | None) -> DataFrame:
    """Rows of the wanted keys; all rows without a wish."""
    return df if keys is None else df.filter(F.col(column).isin(list(keys)))


_COMPARE = {"=": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def _condition(field: str, op: str, value: Any) -> Column:
    column = F.col(field)
    if op == "in":
        return column.isin(list(value))
    if op == "not in":
        return ~column.isin(list(value))
    if op not in _COMPARE:
        raise ValueError(f"unknown filter operator {op!r}")
    return _COMPARE[op](column, F.lit(value))


def filter_spec(df: DataFrame, spec: str | list | dict) -> DataFrame:
    """Rows that meet a filter list: ``[[document?, field, op, value], …]`` or ``{field: value | [op, value]}``."""
    parsed = json.loads(spec) if isinstance(spec, str) else spec
    if isinstance(parsed, dict):
        triples = [(f, *v) if isinstance(v, (list, tuple)) else (f, "=", v) for f, v in parsed.items()]
    else:
        triples = [tuple(entry[-3:]) for entry in parsed]
    return df.filter(reduce(operator.and_, (_condition(*t) for t in triples), F.lit(True)))
