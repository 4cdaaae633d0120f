"""Tables of versions, and the price state that is kept in them."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import export, pricing
from ledgerloom.sources.schemas import struct
from ledgerloom.sources.versions import VersionConflict, VersionedTable
from ledgerloom.streaming import price_state as P

SCHEMA = T.StructType().add("k", "string").add("n", "long")


def upsert(old, new):
    return new.unionByName(old.join(new.select("k").distinct(), "k", "left_anti"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def numbers(spark, tmp_path):
    return lambda: VersionedTable(spark, f"{tmp_path}/numbers", "k", SCHEMA, 8)


def frame(spark, *some):
    return spark.createDataFrame(list(some), SCHEMA)


def test_versions(spark, numbers):
    table = numbers()
    assert table.version() == -1 and rows(table.read()) == []
    table.create(frame(spark, *((f"k{i}", i) for i in range(40)), (None, 7)))
    assert table.apply(frame(spark, ("k3", 300), ("new", 1)), upsert, ("job", 0))
    assert dict(rows(table.read())) | {} == {f"k{i}": i for i in range(40)} | {"k3": 300, "new": 1, None: 7}
    assert dict(rows(table.read(0)))["k3"] == 3
    # The same batch, or an earlier one, changes nothing.
    assert not table.apply(frame(spark, ("k3", 1)), upsert, ("job", 0)) and table.version() == 1
    assert numbers().apply(frame(spark, ("k3", 1)), upsert, ("other", 0)) and dict(rows(table.read()))["k3"] == 1
    # Buckets that no row touches keep their folders.
    one, two = (table.manifest(v)["folders"] for v in (1, 2))
    assert sum(one[b] != two[b] for b in one) == 1
    # A bucket whose rows all go is gone.
    table.apply(table.read().select("k"), lambda old, _: old.limit(0))
    assert rows(table.read()) == [] and table.manifest()["folders"] == {}
    table.clean(keep=1)
    assert rows(table.read()) == [] and table.version() == 3
    with pytest.raises(VersionConflict):
        table.create(frame(spark))


def test_a_failed_write_leaves_the_old_version(spark, numbers):
    table = numbers().create(frame(spark, ("a", 1), ("b", 2)))
    fails = F.udf(lambda n: 1 // 0, "long")
    with pytest.raises(Exception):  # noqa: B017
        table.apply(frame(spark, ("a", 5)), lambda old, new: upsert(old, new).withColumn("n", fails("n")), ("job", 1))
    assert rows(table.read()) == [("a", 1), ("b", 2)] and table.version() == 0
    assert table.apply(frame(spark, ("a", 5)), upsert, ("job", 1)) and rows(table.read()) == [("a", 5), ("b", 2)]
    table.clean(keep=1)
    assert rows(table.read()) == [("a", 5), ("b", 2)]


def test_of_two_writers_one_wins(spark, numbers):
    table = numbers().create(frame(spark, ("a", 1)))

    def slow(old, new):
        numbers().apply(frame(spark, ("a", 2)), upsert)
        return upsert(old, new)

    with pytest.raises(VersionConflict):
        table.apply(frame(spark, ("a", 3)), slow)
    assert rows(table.read()) == [("a", 2)]


def test_rows_of_other_buckets_are_refused(spark, numbers):
    table = numbers().create(frame(spark, ("a", 1)))
    with pytest.raises(ValueError):
        table.apply(frame(spark, ("a", 1)), lambda old, new: frame(spark, *((f"x{i}", i) for i in range(30))))
    assert rows(table.read()) == [("a", 1)]


# Price state

ITEMS, YEARS = ["A", "B", "C"], [None, "", "1999"]


def changes(seed: int, n: int = 120) -> tuple[list[dict], list[dict]]:
    """Signed ledger and order changes: rows that stay, are corrected, cancelled, delivered or closed."""
    rnd = random.Random(seed)
    ledger, orders = [], []
    for _ in range(n):
        row = {"item_code": rnd.choice(ITEMS), "production_year": rnd.choice(YEARS), "warehouse": rnd.choice("WV"), "actual_qty": Decimal(rnd.randint(-9, 12)),
               "stock_value_difference": Decimal(rnd.randint(-900, 1200)) / 10, "is_cancelled": 0}
        ledger.append(row | {"sign": 1})
        if rnd.random() < 0.3:
            ledger.append(row | {"sign": -1})
            if rnd.random() < 0.6:
                ledger.append(row | {"sign": 1, "is_cancelled": rnd.randint(0, 1), "actual_qty": row["actual_qty"] + 1})
        line = {"item_code": rnd.choice(ITEMS), "production_year": rnd.choice(YEARS), "qty": Decimal(rnd.randint(1, 9)), "delivered_qty": Decimal(0), "docstatus": 1,
                "order_docstatus": 1, "order_status": "To Deliver and Bill"}
        orders.append(line | {"sign": 1})
        if rnd.random() < 0.5:
            orders.append(line | {"sign": -1})
            became = rnd.choice([{"docstatus": 2, "order_docstatus": 2}, {"order_status": "Closed"}, {"delivered_qty": line["qty"] - 1}, {"delivered_qty": line["qty"] + 2}, None])
            if became:
                orders.append(line | became | {"sign": 1})
    return ledger, orders


LEDGER = "item_code string, production_year string, warehouse string, actual_qty decimal(18,3), stock_value_difference decimal(21,3), is_cancelled int, sign int"
PRICES = [{"name": f"{i}-{y}", "item_code": i, "production_year": y, "price_list": "S", "selling": 1, "price_list_rate": 5} for i in [*ITEMS, "D"] for y in YEARS]


def left(rows_: list[dict]) -> list[dict]:
    """What is left of signed rows."""
    kept: list[dict] = []
    for r in rows_:
        bare = {k: v for k, v in r.items() if k != "sign"}
        kept.append(bare) if r["sign"] > 0 else kept.remove(bare)
    return kept


def wanted(tables, ledger, orders):
    sums: dict = {}
    for r in left(ledger):
        if not r["is_cancelled"]:
            q, v = sums.get((r["item_code"], r["warehouse"]), (0, 0))
            sums[r["item_code"], r["warehouse"]] = q + r["actual_qty"], v + r["stock_value_difference"]
    lines = left(orders)
    t = tables(
        item_price=PRICES, stock_ledger_entry=left(ledger), bin=[{"item_code": i, "warehouse": w, "actual_qty": q, "stock_value": v} for (i, w), (q, v) in sums.items()],
        sales_order=[{"name": str(k), "docstatus": r["order_docstatus"], "status": r["order_status"]} for k, r in enumerate(lines)],
        sales_order_item=[{k: v for k, v in r.items() if not k.startswith("order_")} | {"parent": str(k)} for k, r in enumerate(lines)],
    )
    touched = {r["item_code"] for r in [*ledger, *orders]}
    return {r.name: tuple(round(float(r[m]), 6) for m in pricing.METRICS) for r in pricing.price_metrics_refresh(t).collect() if r.item_code in touched}


def found(prices):
    return {r.name: tuple(round(float(r[m]), 6) for m in pricing.METRICS) for r in prices.read().collect() if r.stock_qty is not None}


@pytest.fixture
def state(spark, table, tmp_path):
    start = table("item_price", *PRICES)
    prices = P.price_table(spark, f"{tmp_path}/prices", 4).create(start.select("*", *(F.lit(None).alias(m) for m in pricing.METRICS)))
    return P.sums_table(spark, f"{tmp_path}/sums", 4), prices


def deltas(spark, ledger, orders):
    both = P.ledger_deltas(spark.createDataFrame([tuple(r[c.split()[0]] for c in LEDGER.split(", ")) for r in ledger], LEDGER))
    schema = f"{P.ORDER_LINE}, sign int"
    return both.unionByName(P.order_deltas(spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in orders], schema)))


@pytest.mark.parametrize("batches", [1, 4])
def test_any_split_of_changes_gives_the_batch_result(spark, tables, state, batches):
    ledger, orders = changes(batches)
    sums, prices = state
    # Rows of one document may arrive in any order.
    mixed_l, mixed_o = random.Random(1).sample(ledger, len(ledger)), random.Random(2).sample(orders, len(orders))
    for b in range(batches):
        some = deltas(spark, mixed_l[b::batches], mixed_o[b::batches])
        P.refresh(some, sums, prices, ("test", b))
        P.refresh(some, sums, prices, ("test", b))  # a replay
    assert found(prices) == wanted(tables, ledger, orders)
    assert {r.name for r in prices.read().where("stock_qty is null").collect()} == {f"D-{y}" for y in YEARS}


def test_a_batch_that_failed_between_the_tables_is_finished(spark, tables, state):
    ledger, orders = changes(9, 30)
    sums, prices = state
    some = deltas(spark, ledger, orders)
    sums.apply(some.groupBy(*P.KEYS).agg(F.sum("qty").alias("qty"), F.sum("value").alias("value")), P.added, ("test", 0))
    P.refresh(some, sums, prices, ("test", 0))
    assert found(prices) == wanted(tables, ledger, orders) and sums.version() == 0


def test_a_batch_reads_its_rows_and_the_touched_sums_only(spark, state, tmp_path):
    ledger, orders = changes(3, 20)
    sums, prices = state
    P.refresh(deltas(spark, ledger, orders), sums, prices, ("test", 0))
    spark.createDataFrame([("A", P.STOCK, "", Decimal(1), Decimal(0))], P.DELTA).write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    touched = sums.buckets_of(batch)
    assert len(touched) == 1
    for rows_ in (P.added(sums.read(buckets=touched), batch), P.with_metrics(prices.read(buckets=touched), batch.select("item_code"), sums.read(buckets=touched))):
        files = {f.split(str(tmp_path))[1].split("/")[1] for f in rows_.inputFiles()}
        assert files <= {"batch", "sums", "prices"} and all(f"_bucket={touched[0]}/" in f for f in rows_.inputFiles() if "/batch/" not in f)


def test_streams_of_ledger_and_order_changes(spark, tables, state, tmp_path):
    ledger, orders = changes(5)
    sums, prices = state
    order_schema = f"{P.ORDER_LINE}, sign int"
    ready = []
    for name, some, schema, shares in (("ledger", ledger, LEDGER, P.ledger_deltas), ("orders", orders, order_schema, P.order_deltas)):
        data = [tuple(r[c.split()[0]] for c in schema.split(", ")) for r in some]
        spark.createDataFrame(data, schema).repartition(6).write.parquet(f"{tmp_path}/{name}")
        ready.append(shares(spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/{name}")))
    union = ready[0].unionByName(ready[1])
    P.price_state_stream(union, sums, prices, f"{tmp_path}/checkpoint", once=True).awaitTermination()
    assert found(prices) == wanted(tables, ledger, orders) and sums.version() >= 2
    # An order that is cancelled later.
    line = next(r for r in left(orders) if r["order_docstatus"] == 1 and r["order_status"] != "Closed" and r["qty"] > r["delivered_qty"]) | {"sign": -1}
    spark.createDataFrame([tuple(line[c.split()[0]] for c in order_schema.split(", "))], order_schema).write.mode("append").parquet(f"{tmp_path}/orders")
    before = found(prices)
    P.price_state_stream(union, sums, prices, f"{tmp_path}/checkpoint", once=True).awaitTermination()
    assert found(prices) == wanted(tables, ledger, [*orders, line]) != before


def test_bins_as_their_own_changes(spark, state):
    sums, prices = state
    bins = spark.createDataFrame([("A", "W", Decimal(4), Decimal(40), 1), ("A", "W", Decimal(4), Decimal(40), -1), ("A", "W", Decimal(2), Decimal(30), 1), ("A", "V", Decimal(-1), Decimal(-5), 1)],
                                 "item_code string, warehouse string, actual_qty decimal(18,3), stock_value decimal(21,3), sign int")
    P.refresh(P.bin_deltas(bins), sums, prices, ("bins", 0))
    assert found(prices)["A-"] == (15.0, 0.0, 0.0)


# Price changes as versions

def test_a_sheet_becomes_a_version(spark, tables, state, tmp_path):
    _, prices = state
    t = tables(singles=[{"doctype": "Selling Settings", "field": "selling_price_list", "value": "S"}])
    columns = ["name", "item_code", "item_name", "production_year", "price_list_rate", "valuation", "stock", "available"]
    sheet = spark.createDataFrame([("A-1999", "A", "", "", "7.5", "", "", ""), ("D-None", "D", "", "", "9", "", "", ""), ("gone", "A", "", "", "1", "", "", ""), ("", "A", "", "", "2", "", "", "")], columns)
    export.write_sheet(sheet, f"{tmp_path}/sheet")
    changes_ = pricing.import_price_sheet(export.read_sheet(spark, f"{tmp_path}/sheet"))
    for _ in range(2):
        pricing.commit_price_changes(prices, t, changes_, writer=("sheet", 1))
    rates = {r.name: float(r.price_list_rate) for r in prices.read().collect()}
    assert rates == {p["name"]: 5.0 for p in PRICES} | {"A-1999": 7.5, "D-None": 9.0} and prices.version() == 1
    new = spark.createDataFrame([("B-", None, None, None, Decimal(8)), (None, "E", "e", "2001", Decimal(3))], struct("price_change"))
    pricing.commit_price_changes(prices, t, new)
    added = [r for r in prices.read().collect() if r.name is None]
    assert [(r.item_code, r.price_list, float(r.price_list_rate)) for r in added] == [("E", "S", 3.0)] and prices.read().where("name = 'B-'").first().price_list_rate == 8
    assert prices.read(0).where("name = 'A-1999'").first().price_list_rate == 5
