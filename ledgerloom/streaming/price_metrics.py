"""Keeping price rows fresh while ledger rows and orders arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.pricing import price_metrics_refresh
from ledgerloom.sources.tables import Tables


def refreshed_prices(t: Tables, touched: DataFrame) -> DataFrame:
    """Price rows of the touched items with metrics recomputed from the whole ledger, whatever its dates.

    All years of an item are refreshed, since its value per unit is shared by them.  The ledger, bins, orders
    and prices are reduced to the touched items before anything is summed.
    """
    items = touched.select("item_code").distinct()

    def of_items(df: DataFrame) -> DataFrame:
        return df.join(items, "item_code", "left_semi")

    reduced = t.replace(
        item_price=of_items(t.item_price), stock_ledger_entry=of_items(t.stock_ledger_entry), bin=of_items(t.bin),
        sales_order_item=of_items(t.sales_order_item),
    )
    return price_metrics_refresh(reduced)


class PriceLog:
    """Refreshed price rows, one folder per micro-batch; the latest version of a row counts.

    Only touched rows are written.  A batch that runs again after a failure replaces its own folder.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")

    def latest(self) -> DataFrame:
        """The newest version of every row in the log."""
        rows = self.spark.read.parquet(self.root)
        columns = [c for c in rows.columns if c != "batch"]
        newest = rows.groupBy("name").agg(F.max_by(F.struct(*columns), "batch").alias("_row"))
        return newest.select("_row.*")

    def current(self, prices: DataFrame) -> DataFrame:
        """``prices`` with the rows of the log in place of their old versions."""
        latest = self.latest()
        return prices.join(latest.select("name"), "name", "left_anti").unionByName(latest, allowMissingColumns=True)

    def compact(self, root: str) -> PriceLog:
        """The same rows as one batch in a new folder, to go on from there."""
        log = PriceLog(self.spark, root)
        log.write(-1, self.latest())
        return log


def price_metrics_stream(
    touched: DataFrame, tables: Callable[[], Tables], log: PriceLog, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Refreshes, per micro-batch, the price rows of the items in ``touched``.

    ``touched`` is a stream with item_code: new or changed ledger rows, order lines of changed orders, or
    their union.  ``tables`` gives the tables as they are when a batch runs.  With ``once`` the stream ends
    when all that has arrived is done.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        # Four tables are reduced to the items of the batch, so these are worked out once.
        items = batch.distinct().persist()
        try:
            log.write(batch_id, refreshed_prices(tables(), items))
        finally:
            items.unpersist()

    writer = touched.select("item_code").writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
