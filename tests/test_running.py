"""Running totals and valuation chains give the same result however they are cut."""

from __future__ import annotations

import datetime
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.operators.running import cut_days, running_total
from ledgerloom.operators.valuation import moving_average_valuation
from pyspark.sql import functions as F

DAY0 = datetime.date(2020, 1, 1)


def ledger(seed: int, n: int = 1500):
    rnd = random.Random(seed)
    numbers = [None] + [f"v{i}" for i in range(30)]
    return [
        # One key has half of the rows, and half of these on one day.
        ("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(4)}",
         DAY0 if rnd.random() < 0.5 else DAY0 + datetime.timedelta(days=rnd.randrange(1, 6)), rnd.choice(numbers), None if rnd.random() < 0.1 else rnd.randrange(-50, 50))
        for _ in range(n)
    ]


def expected(rows):
    def position(r):
        return (r[1], r[2] is not None, r[2] or "")

    def total(r):
        amounts = [s[3] for s in rows if s[0] == r[0] and position(s) <= position(r) and s[3] is not None]
        return sum(amounts) if amounts else None

    return sorted(str((*r, total(r))) for r in rows)


@pytest.mark.parametrize("spread", [False, True])
def test_ranges_do_not_change_running_totals(spark, spread):
    rows = ledger(7)
    df = spark.createDataFrame(rows, "k string, d date, v string, x long").repartition(5)
    out = running_total(df, ["k"], "d", ["v"], {"x": "t"}, spread=spread)
    assert sorted(str(tuple(r)) for r in out.select("k", "d", "v", "x", "t").collect()) == expected(rows)


@pytest.fixture
def without_coalescing(spark):
    """Partitions stay as they are dealt, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_key_and_day_is_spread_over_tasks(spark, without_coalescing):
    """Half of the rows on one day of one key: no task gets many more than the others."""
    rnd = random.Random(2)
    rows = [("hot" if i % 2 else f"k{i % 40}", DAY0 if i % 2 else DAY0 + datetime.timedelta(days=rnd.randrange(9)), f"v{rnd.randrange(10**6)}", i) for i in range(8000)]
    df = spark.createDataFrame(rows, "k string, d date, v string, x long")
    out = running_total(df, ["k"], "d", ["v"], {"x": "t"}, spread=True)
    got = {(r.k, r.d, r.v, r.x): r.t for r in out.collect()}
    totals = {}
    for r in sorted(rows, key=lambda r: r[:3]):
        totals[r[0]] = totals.get(r[0], 0) + r[3]
        want = (got[r], totals[r[0]])
        assert want[0] >= want[1]  # ties count rows behind them too
    assert {k: t for k, t in totals.items()} == {k: max(t for (of, *_), t in got.items() if of == k) for k in totals}
    tasks = out.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 6 and max(r["count"] for r in tasks) < 2500


def test_spread_plans_its_rows_once(spark, tmp_path):
    df = spark.createDataFrame(ledger(5, 200), "k string, d date, v string, x long")
    df.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    window = running_total(rows, ["k"], "d", ["v"], {"x": "t"})
    plan = window._jdf.queryExecution().toString()
    assert plan.count("FileScan parquet") == 1 and plan.split("== Physical Plan ==")[1].count("Join") == 0
    spark.conf.set("spark.ledgerloom.spreadFromBytes", "1")
    try:
        ranges = running_total(rows, ["k"], "d", ["v"], {"x": "t"})
    finally:
        spark.conf.unset("spark.ledgerloom.spreadFromBytes")
    physical = ranges._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "FileScan parquet" not in physical and "SortMergeJoin" not in physical
    assert sorted(map(str, ranges.collect())) == sorted(map(str, window.collect()))


def test_large_days_are_cut_and_ties_stay_together(spark):
    df = spark.createDataFrame(ledger(3), "k string, d date, v string, x long")
    parts = cut_days(df, ["k"], "d", ["v"], 3)
    per_day = parts.filter("k = 'hot'").groupBy("d").agg(F.countDistinct("_slot").alias("n")).collect()
    assert max(r["n"] for r in per_day) > 3
    assert parts.groupBy("k", "d", "v").agg(F.countDistinct("_slot").alias("n")).filter("n > 1").isEmpty()


def moving_average(rows):
    """Row by row, as a book-keeper would."""

    def cents(x):
        import math

        return math.copysign(math.floor(abs(x) * 100 + 0.5) / 100, x)

    out, state, changes = {}, {}, {}
    for key, date, no, name, qty, price, reset, *adjusts in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        q, rate, value = state.get(key, (0.0, 0.0, 0.0))
        if reset is not None:
            q2, rate = float(reset), price
        elif qty > 0:
            q2 = q + qty
            rate = price if q <= 0 else (q * rate + qty * price) / q2
        else:
            q2 = q + qty
        worth = cents(q2 * rate)
        if reset is None and qty < 0 and q2 != 0:
            rate = worth / q2
        worth = worth if q2 != 0 else 0.0
        change = cents(worth - value)
        earlier = changes.setdefault(key, [])
        if adjusts and adjusts[0]:  # takes back all differences but those of its own voucher, once
            again = any(n == no and a for n, _, a in earlier)
            change = 0.0 if again else -round(sum(d for n, d, _ in earlier if n != no), 2)
        earlier.append((no, change, bool(adjusts and adjusts[0])))
        out[name] = (q2, round(rate, 6), worth, change)
        state[key] = (q2, rate, worth)
    return out


def valuation_case(seed: int, n: int):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        qty = rnd.choice([1, 2, 5, 10, -1, -2, -4, -8])
        reset = rnd.choice([0, 3, 20]) if rnd.random() < 0.03 else None
        rows.append(("A" if rnd.random() < 0.7 else "B", DAY0 + datetime.timedelta(days=rnd.randrange(20)), f"v{rnd.randrange(40)}",
                     f"n{i}", qty, round(rnd.uniform(1, 90), 2), reset))
    return rows


@pytest.mark.parametrize("rows_per_slice", [1 << 18, 40, 5])
def test_valuation_equals_row_by_row(tables, rows_per_slice):
    rows = valuation_case(11, 600)
    t = tables(
        stock_ledger_entry=[
            {"name": name, "item_code": key, "warehouse": "W", "posting_date": date, "voucher_no": no, "actual_qty": qty,
             "voucher_type": "Stock Reconciliation" if reset is not None else "Stock Entry", "is_cancelled": 0,
             "stock_value_difference": round(qty * price, 3), "qty_after_transaction": reset, "valuation_rate": price}
            for key, date, no, name, qty, price, reset in rows
        ]
    )
    prices = [(k, d, no, n, q, p if r is not None else round(q * p, 3) / q, r) for k, d, no, n, q, p, r in rows]
    want = moving_average(prices)
    got = {
        r["name"]: (r["qty_after"], round(r["valuation_rate"], 6), r["stock_value"], r["stock_value_difference"])
        for r in moving_average_valuation(t, rows_per_slice).collect()
    }
    assert got == want


@pytest.mark.parametrize("rows_per_slice", [1 << 18, 30, 4])
def test_adjustments_take_back_what_came_before(tables, rows_per_slice):
    rnd = random.Random(4)
    # A voucher has one day, so vouchers are numbered by day.
    rows = [(k, d, f"v{d.day:02d}-{no[1:]}", n, q, round(p, 1) if r is not None else round(q * round(p, 1), 3) / q, r, rnd.random() < 0.1)
            for k, d, no, n, q, p, r in valuation_case(21, 500)]
    t = tables(
        stock_ledger_entry=[
            {"name": name, "item_code": key, "warehouse": "W", "posting_date": date, "voucher_no": no, "actual_qty": qty, "is_adjustment_entry": int(adjusts),
             "voucher_type": "Stock Reconciliation" if reset is not None else "Stock Entry", "is_cancelled": 0,
             "stock_value_difference": round(qty * price, 3), "qty_after_transaction": reset, "valuation_rate": price}
            for key, date, no, name, qty, price, reset, adjusts in rows
        ]
    )
    want = {n: tuple(x + 0.0 for x in v) for n, v in moving_average(rows).items()}
    got = {r["name"]: (r["qty_after"], round(r["valuation_rate"], 6), r["stock_value"], r["stock_value_difference"]) for r in moving_average_valuation(t, rows_per_slice).collect()}
    assert got == want and sum(v[3] != 0 for n, v in got.items()) > 100


@pytest.mark.parametrize("rows_per_slice, counts", [(10, [["_bucket"]]), (6, [["_bucket"], ["item_code", "warehouse"]]), (4, [["_bucket"], ["item_code", "warehouse"]])])
def test_chains_are_counted_one_by_one_only_in_full_buckets(tables, monkeypatch, rows_per_slice, counts):
    """Two chains of five rows share the only bucket: it is full from nine rows a slice down, a chain from four."""
    from ledgerloom.operators import valuation

    asked, count = [], valuation.large_keys
    monkeypatch.setattr(valuation, "BUCKETS", 1, raising=False)
    monkeypatch.setattr(valuation, "large_keys", lambda rows, keys, more_than: asked.append(keys) or count(rows, keys, more_than))
    ledger = [{"name": f"{item}{k}", "item_code": item, "warehouse": "W", "posting_date": DAY0 + datetime.timedelta(k), "voucher_no": f"v{k}", "actual_qty": 1,
               "is_cancelled": 0, "voucher_type": "Stock Entry", "stock_value_difference": k} for item in "AB" for k in range(5)]
    out = {r["name"]: r.stock_value for r in moving_average_valuation(tables(stock_ledger_entry=ledger[:5]), rows_per_slice).collect()}
    asked.clear()
    both = [r.stock_value for r in moving_average_valuation(tables(stock_ledger_entry=ledger), rows_per_slice).orderBy("name").collect()]
    assert asked == counts and both == [out[f"A{k}"] for k in range(5)] * 2 == [0.0, 1.0, 3.0, 6.0, 10.0] * 2


def test_an_adjusted_chain_by_hand(tables):
    def row(name, voucher, day, qty, value, adjusts=0):
        return {"name": name, "item_code": "A", "warehouse": "W", "posting_date": DAY0 + datetime.timedelta(day), "voucher_no": voucher, "actual_qty": qty, "is_cancelled": 0,
                "voucher_type": "Stock Entry", "stock_value_difference": value, "is_adjustment_entry": adjusts}

    ledger = [row("a", "1", 0, 10, 100), row("b", "2", 1, -4, None), row("c", "3", 2, 2, 40), row("d", "3", 2, 0, 0, 1), row("e", "4", 3, -1, None), row("f", "5", 4, 0, 0, 1)]
    out = {r["name"]: (r.stock_value, r.stock_value_difference) for r in moving_average_valuation(tables(stock_ledger_entry=ledger)).collect()}
    # 60 stood before voucher 3, which leaves its own 40; -12.5 follow, so voucher 5 takes back 27.5.
    assert out == {"a": (100.0, 100.0), "b": (60.0, -40.0), "c": (100.0, 40.0), "d": (100.0, -60.0), "e": (87.5, -12.5), "f": (87.5, -27.5)}


def test_precision_of_values_and_quantities(tables):
    ledger = [{"name": n, "item_code": "A", "warehouse": "W", "posting_date": DAY0 + datetime.timedelta(k), "voucher_no": n, "actual_qty": q, "is_cancelled": 0,
               "voucher_type": "Stock Entry", "stock_value_difference": v} for k, (n, q, v) in enumerate([("a", 3, 10), ("b", "-1.26", None), ("c", -1, None)])]
    t = tables(stock_ledger_entry=ledger)
    values = lambda **places: [r.stock_value for r in moving_average_valuation(t, **places).orderBy("posting_date").collect()]
    assert values() == [10.0, 5.8, 2.47] and values(value_places=3) == [10.0, 5.8, 2.467] and values(value_places=0) == [10.0, 6.0, 3.0]
    assert values(qty_places=1) == [10.0, 5.67, 2.33]


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10_000))
def test_running_totals_of_random_ledgers(spark, seed):
    rows = ledger(seed, 200)
    df = spark.createDataFrame(rows, "k string, d date, v string, x long")
    out = running_total(df, ["k"], "d", ["v"], {"x": "t"}, spread=seed % 2 == 0)
    assert sorted(str(tuple(r)) for r in out.select("k", "d", "v", "x", "t").collect()) == expected(rows)


def test_a_missing_amount_adds_nothing(spark):
    rows = [("a", DAY0, "1", 5), ("a", DAY0 + datetime.timedelta(1), "2", None), ("a", DAY0 + datetime.timedelta(2), "3", 1), ("b", DAY0, "1", None)]
    df = spark.createDataFrame(rows, "k string, d date, v string, x long")
    for spread in (False, True):
        out = running_total(df, ["k"], "d", ["v"], {"x": "t"}, spread=spread).orderBy("k", "d").collect()
        assert [r.t for r in out] == [5, 5, 6, None]


def test_no_job_runs_while_a_statement_is_built(spark, tables):
    from ledgerloom.plans.accounts import account_statement

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    account_statement(tables(), "2024-01-01", "2024-12-31")
    assert list(tracker.getJobIdsForGroup("building")) == []


def test_rows_of_one_day_are_valued_in_posting_order(tables):
    def row(name, hour, qty, value):
        return {"name": name, "item_code": "A", "warehouse": "W", "posting_date": DAY0, "voucher_no": name, "actual_qty": qty, "is_cancelled": 0,
                "posting_datetime": datetime.datetime(2020, 1, 1, hour), "voucher_type": "Stock Entry", "stock_value_difference": value}

    ledger = [row("z", 8, 10, 100), row("a", 9, -4, None), row("m", 10, None, None)]
    for rows_per_slice in (1 << 18, 1):
        out = {r["name"]: (r.qty_after, r.valuation_rate, r.stock_value) for r in moving_average_valuation(tables(stock_ledger_entry=ledger), rows_per_slice).collect()}
        assert out == {"z": (10.0, 10.0, 100.0), "a": (6.0, 10.0, 60.0), "m": (6.0, 10.0, 60.0)}
