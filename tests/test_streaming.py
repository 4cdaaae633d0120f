"""The streamed price refresh ends where the batch refresh does, however the ledger arrives."""

from __future__ import annotations

import pytest

from ledgerloom import Tables
from ledgerloom.operators.pricing import METRICS, price_metrics_refresh
from ledgerloom.plans import registry
from ledgerloom.sources.schemas import struct
from ledgerloom.streaming import price_state as P
from ledgerloom.streaming.price_metrics import PriceLog, price_metrics_stream


def rows(df):
    return sorted(
        (r["name"], *(round(float(r[m]), 6) for m in METRICS)) for r in df.select("name", *METRICS).collect()
    )


@pytest.fixture
def store(spark, sf_dir, tmp_path):
    """The test tables as parquet folders, the ledger empty at first."""
    source = Tables.from_star_schema(spark, sf_dir)
    for name in ("item_price", "sales_order", "sales_order_item"):
        table = getattr(source, name)
        table.select(*(table[f.name].cast(f.dataType) for f in struct(name).fields)).write.parquet(f"{tmp_path}/{name}")
    ledger = source.stock_ledger_entry
    ledger = ledger.select(*(ledger[f.name].cast(f.dataType) for f in struct("stock_ledger_entry").fields))
    parts = ledger.randomSplit([0.5, 0.3, 0.2], seed=5)
    return tmp_path, parts


def tables_of(spark, root):
    t = Tables.from_parquet(spark, str(root))
    t.stock_ledger_entry.createOrReplaceTempView("arrived_ledger")
    # Bins follow the ledger.
    bins = spark.sql(
        "SELECT item_code, warehouse, sum(actual_qty) AS actual_qty, sum(stock_value_difference) AS stock_value "
        "FROM arrived_ledger WHERE is_cancelled = 0 GROUP BY item_code, warehouse"
    )
    return t.replace(bin=bins)


@pytest.mark.parametrize("batches", [1, 3])
def test_stream_equals_batch(spark, store, tmp_path, batches):
    root, parts = store
    ledger_path, log = f"{root}/stock_ledger_entry", PriceLog(spark, f"{tmp_path}/log")

    def run():
        touched = spark.readStream.schema(struct("stock_ledger_entry")).parquet(ledger_path)
        query = price_metrics_stream(touched, lambda: tables_of(spark, root), log, f"{tmp_path}/checkpoint", once=True)
        query.awaitTermination()

    if batches == 1:
        for part in parts:
            part.write.mode("append").parquet(ledger_path)
        run()
    else:
        for part in parts:
            part.write.mode("append").parquet(ledger_path)
            run()
    t = tables_of(spark, root)
    want = price_metrics_refresh(t).join(t.stock_ledger_entry.select("item_code").distinct(), "item_code", "left_semi")
    assert rows(log.latest()) == rows(want)


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path, table):
    log = PriceLog(spark, f"{tmp_path}/log")
    first = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "name string, stock_qty double")
    again = spark.createDataFrame([("a", 2.0)], "name string, stock_qty double")
    log.write(0, first)
    log.write(1, again)
    log.write(1, again)
    assert sorted(map(tuple, log.latest().select("name", "stock_qty").collect())) == [("a", 2.0), ("b", 1.0)]
    log.write(0, first.filter("name = 'a'"))
    assert sorted(map(tuple, log.latest().select("name", "stock_qty").collect())) == [("a", 2.0)]
    compact = log.compact(f"{tmp_path}/compact")
    compact.write(0, spark.createDataFrame([("c", 5.0)], "name string, stock_qty double"))
    prices = spark.createDataFrame([("a", 0.0), ("z", 9.0)], "name string, stock_qty double")
    current = compact.current(prices).select("name", "stock_qty")
    assert sorted(map(tuple, current.collect())) == [("a", 2.0), ("c", 5.0), ("z", 9.0)]


def test_changes_arrive_in_as_many_batches_whatever_their_files(spark, tmp_path):
    def batches(files):
        seen, root = [], f"{tmp_path}/{files}"
        changes = registry._in_batches(spark, spark.range(files).repartition(files), f"{root}/changes")
        query = changes.writeStream.foreachBatch(lambda batch, number: seen.extend([(number, r.id) for r in batch.collect()])).option("checkpointLocation", f"{root}/checkpoint")
        query.trigger(availableNow=True).start().awaitTermination()
        assert sorted(i for _, i in seen) == list(range(files))
        return len({number for number, _ in seen})

    assert batches(5) == batches(50) == registry.PRICE_BATCHES


def test_price_rows_and_sums_travel_once_by_item(spark):
    prices = spark.createDataFrame([("p", "a", "2020"), ("q", "a", None), ("r", "b", "2020"), ("s", None, "2020")], "name string, item_code string, production_year string")
    prices = prices.selectExpr("*", "7D AS stock_valuation_rate", "CAST(7 AS DECIMAL(28,3)) AS stock_qty", "CAST(7 AS DECIMAL(28,3)) AS available_qty")
    sums = [("a", P.STOCK, "2020", 5, 0), ("a", P.RESERVED, "2020", 2, 0), ("a", P.BIN, None, 4, 12), ("a", P.BIN, "W", -1, 9), ("a", P.RESERVED, "", 1, 0), ("a", P.STOCK, None, 3, 0)]
    sums = spark.createDataFrame(sums, "item_code string, kind string, part string, qty int, value int").selectExpr(*P.KEYS, *(f"CAST({c} AS DECIMAL(28,3)) AS {c}" for c in ("qty", "value")))
    items = spark.createDataFrame([("a",), ("c",), (None,)], "item_code string")
    out = P.with_metrics(prices, items, sums)
    assert rows(out) == [("p", 3.0, 5.0, 3.0), ("q", 3.0, 0.0, -1.0), ("r", 7.0, 7.0, 7.0), ("s", 7.0, 7.0, 7.0)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = P.with_metrics(prices, items, sums)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 3  # prices, items, sums


def test_order_changes_read_the_joined_lines_once(spark, sf_dir):
    _, orders = registry.price_changes(Tables.from_star_schema(spark, sf_dir))
    assert orders._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
