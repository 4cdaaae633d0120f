"""Price rows kept fresh from running sums: a micro-batch reads its own rows and the touched part of the sums, never the ledger.

Changes are signed rows: +1 for a row as it is now, -1 for a row as it was before. A correction is both, a cancelled order or ledger
row the one with -1 (or a new row that no longer counts). Each row's share of an item's stock, bins and reservations is a sum, so
rows may come in any order and in any batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.functions.columns import or_zero, ratio, year_or_blank
from ledgerloom.functions.predicates import FINISHED_ORDER, SUBMITTED
from ledgerloom.operators.pricing import METRICS
from ledgerloom.sources import schemas
from ledgerloom.sources.versions import VersionedTable

#: Kinds of sums: stock by year, bins by warehouse, reservations by year.
STOCK, BIN, RESERVED = "stock", "bin", "reserved"
DELTA = "item_code string, kind string, part string, qty decimal(28,3), value decimal(28,3)"
KEYS = ["item_code", "kind", "part"]
#: Columns of a stream of order line changes, besides sign.
ORDER_LINE = "item_code string, production_year string, qty decimal(18,3), delivered_qty decimal(18,3), docstatus int, order_docstatus int, order_status string"


def _deltas(changes: DataFrame, *parts: tuple[str, str | Column, Column, Column]) -> DataFrame:
    """One row per kind and change; rows that do not count stay, with zero, since they touch their item."""
    amount = lambda c: (or_zero(c) * F.col("sign")).cast("decimal(28,3)")
    rows = F.array(*(
        F.struct(F.lit(kind).alias("kind"), (F.col(part) if isinstance(part, str) else part).alias("part"), amount(qty).alias("qty"), amount(value).alias("value"))
        for kind, part, qty, value in parts
    ))
    return changes.select("item_code", F.inline(rows))


def ledger_deltas(changes: DataFrame, with_bins: bool = True) -> DataFrame:
    """Shares of signed stock ledger rows; ``with_bins`` if no stream of bin changes comes besides."""
    counts = F.col("is_cancelled") == 0
    qty, value = (F.when(counts, F.col(c)) for c in ("actual_qty", "stock_value_difference"))
    parts = [(STOCK, year_or_blank(), qty, F.lit(0))]
    return _deltas(changes, *parts, *([(BIN, "warehouse", qty, value)] if with_bins else []))


def bin_deltas(changes: DataFrame) -> DataFrame:
    """Shares of signed bin rows."""
    return _deltas(changes, (BIN, "warehouse", F.col("actual_qty"), F.col("stock_value")))


def order_deltas(changes: DataFrame) -> DataFrame:
    """Shares of signed order lines: what submitted lines of submitted, unfinished orders still wait for."""
    waits = F.col("qty") - F.col("delivered_qty")
    is_open = (F.col("docstatus") == SUBMITTED) & (F.col("order_docstatus") == SUBMITTED) & ~F.col("order_status").isin(*FINISHED_ORDER)
    return _deltas(changes, (RESERVED, year_or_blank(), F.when(is_open & (waits > 0), waits), F.lit(0)))


def order_line_images(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order lines with the state of their order, as a stream of changes has them (without sign)."""
    heads = orders.select(F.col("name").alias("parent"), F.col("docstatus").alias("order_docstatus"), F.col("status").alias("order_status"))
    return lines.join(heads, "parent").select(*(f.split()[0] for f in ORDER_LINE.split(", ")))


def added(sums: DataFrame, deltas: DataFrame, bucket: Column | None = None) -> DataFrame:
    """The sums with the deltas; those that have come to nothing go. With ``bucket`` the rows of a bucket come together on the way."""
    rows = sums.unionByName(deltas)
    if bucket is not None:
        rows = rows.withColumn("_bucket", bucket).repartition("_bucket")
    rows = rows.groupBy(*KEYS, *(["_bucket"] if bucket is not None else [])).agg(F.sum("qty").alias("qty"), F.sum("value").alias("value"))
    return rows.filter("qty <> 0 OR value <> 0").select(*KEYS, "qty", "value")


def metrics(sums: DataFrame) -> DataFrame:
    """One row per item: value per unit, and of each year stock and unreserved stock."""
    of_kind = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("qty")))
    in_bins = (F.col("kind") == BIN) & (F.col("qty") > 0)
    # One shuffle by item for all that follows; the bins of an item are one of its parts.
    part = F.when(F.col("kind") != BIN, F.struct(F.col("part").alias("of")))
    parts = sums.repartition("item_code").groupBy("item_code", part.alias("_year")).agg(
        or_zero(of_kind(STOCK)).alias("stock_qty"), or_zero(of_kind(RESERVED)).alias("_reserved"),
        F.sum(F.when(in_bins, F.col("value"))).alias("_value"), F.sum(F.when(in_bins, F.col("qty"))).alias("_qty"),
    )
    year = F.struct("stock_qty", (F.col("stock_qty") - F.col("_reserved")).alias("available_qty"))
    known = F.col("_year.of").isNotNull()
    return parts.groupBy("item_code").agg(
        ratio(F.sum("_value"), F.sum("_qty")).alias("stock_valuation_rate"),
        F.map_from_entries(F.collect_list(F.when(known, F.struct(F.col("_year.of").alias("year"), year.alias("sums"))))).alias("_years"),
    )


def price_schema() -> T.StructType:
    """Price rows with their metrics."""
    fields = schemas.struct("item_price").fields
    return T.StructType([*fields, T.StructField(METRICS[0], T.DoubleType()), *(T.StructField(m, T.DecimalType(28, 3)) for m in METRICS[1:])])


def price_table(spark: SparkSession, root: str, buckets: int = 64) -> VersionedTable:
    return VersionedTable(spark, root, "item_code", price_schema(), buckets)


def sums_table(spark: SparkSession, root: str, buckets: int = 64) -> VersionedTable:
    return VersionedTable(spark, root, "item_code", T.StructType.fromDDL(DELTA), buckets)


def with_metrics(prices: DataFrame, items: DataFrame, sums: DataFrame) -> DataFrame:
    """Price rows, those of ``items`` with metrics from the sums. Price rows and sums travel once, by item."""
    of_items = items.select("item_code", F.lit(True).alias("_touched")).join(metrics(sums), "item_code", "left")
    of_items = of_items.select("item_code", "_touched", F.col(METRICS[0]).alias(f"_{METRICS[0]}"), "_years")
    joined = prices.join(of_items, "item_code", "left").withColumn("_sums", F.col("_years")[year_or_blank()])
    new = {METRICS[0]: F.col(f"_{METRICS[0]}")} | {m: F.col(f"_sums.{m}") for m in METRICS[1:]}
    fresh = {c: F.when(F.col("_touched"), or_zero(value)).otherwise(F.col(c)) for c, value in new.items()}
    return joined.withColumns(fresh).select(*prices.columns)


def refresh(deltas: DataFrame, sums: VersionedTable, prices: VersionedTable, writer: tuple[str, int]) -> None:
    """Adds a batch of deltas to the sums and refreshes the price rows of its items; done once, however often it runs.

    The two tables are written one after the other. A batch that failed between them finds the sums done and refreshes the prices.
    """
    # Summed before anything is joined, so a batch on one item is one row a task.
    batch = deltas.groupBy(*KEYS).agg(F.sum("qty").alias("qty"), F.sum("value").alias("value")).persist()
    try:
        sums.apply(batch, lambda rows, new: added(rows, new, sums.bucket()), writer, dealt=True)
        items = batch.select("item_code").distinct()
        if not prices.done(writer):
            of_batch = sums.read(buckets=sums.buckets_of(batch))
            prices.apply(batch, lambda rows, _: with_metrics(rows, items, of_batch), writer)
    finally:
        batch.unpersist()


def price_state_stream(deltas: DataFrame, sums: VersionedTable, prices: VersionedTable, checkpoint: str, name: str = "prices", once: bool = False) -> StreamingQuery:
    """Keeps ``prices`` fresh while deltas arrive: the union of streams made by ``ledger_deltas``, ``bin_deltas`` and ``order_deltas``.

    ``name`` tells the writers of a table apart; a new checkpoint needs a new name, since its batches count from 0. With ``once`` the
    stream ends when all that has arrived is done.
    """
    columns = [f.split()[0] for f in DELTA.split(", ")]
    step: Callable[[DataFrame, int], None] = lambda batch, number: refresh(batch, sums, prices, (name, number))
    writer = deltas.select(*columns).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
