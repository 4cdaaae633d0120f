"""Sheets for users: price and receipt exports, and files of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import sanitize_cells
from ledgerloom.functions.predicates import filter_spec
from ledgerloom.sources.tables import Tables

# Columns of the two sheets, in their order.
PRICE_SHEET = ["name", "item_code", "item_name", "brand", "price_list_rate", "stock_valuation_rate", "stock_qty", "price_list"]
RECEIPT_SHEET = ["name", "title", "brand", "item_code", "item_name", "production_year", "qty", "rate", "amount"]


def export_prices(prices: DataFrame, spec: str | list | dict | None = None) -> DataFrame:
    """The price sheet; ``prices`` carries the stock metrics."""
    rows = filter_spec(prices, spec) if spec is not None else prices
    return sanitize_cells(rows.select(*PRICE_SHEET))


def export_receipts(t: Tables, receipts: list[str] | None = None) -> DataFrame:
    """The receipt sheet, name and title only on the first line of a receipt.

    The first line is found by a grouped minimum and joined back by line name, so a receipt with very many
    lines is never sorted in one task.
    """
    headers = t.purchase_receipt if receipts is None else t.purchase_receipt.filter(F.col("name").isin(receipts))
    headers = headers.select(F.col("name").alias("parent"), "title")
    lines = t.purchase_receipt_item.join(headers, "parent")
    first = t.purchase_receipt_item.groupBy("parent").agg(F.min(F.struct("idx", "name"))["name"].alias("name")).select(
        "name", F.lit(True).alias("_first")
    )
    rows = lines.join(first, "name", "left")
    is_first = F.col("_first").isNotNull()
    return rows.select(
        F.col("parent").alias("receipt"), F.col("idx"), F.col("name").alias("line"),
        F.when(is_first, F.col("parent")).otherwise("").alias("name"), F.when(is_first, F.col("title")).otherwise("").alias("title"),
        *RECEIPT_SHEET[2:],
    ).orderBy("receipt", "idx", "line")


def write_sheet(df: DataFrame, path: str) -> None:
    """CSV files with a header line, written by all tasks; what was there is replaced."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_sheet(spark, path: str) -> DataFrame:
    """A CSV sheet with a header line, every cell as text."""
    return spark.read.option("header", True).csv(path)
