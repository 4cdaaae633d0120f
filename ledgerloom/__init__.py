"""Receivables, cash, stock and profitability analytics over two ledgers, on PySpark DataFrames."""

from ledgerloom.sources.tables import Tables

__all__ = ["Tables"]
