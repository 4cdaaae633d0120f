"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from ledgerloom import Tables
from ledgerloom.plans.registry import OPERATORS, plain
from ledgerloom.sources.schemas import TABLES, struct


@pytest.fixture(scope="module")
def plan_of(spark, sf_dir, tmp_path_factory):
    """Plans over empty parquet tables, as on real storage where nothing is a literal."""
    root = tmp_path_factory.mktemp("empty")
    for name in TABLES:
        spark.createDataFrame([], struct(name)).write.parquet(f"{root}/{name}")
    t = Tables.from_parquet(spark, str(root))

    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")

    def plan(name: str) -> str:
        old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return plain(OPERATORS[name](t))._jdf.queryExecution().explainString(mode)
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)

    return plan


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_cross_join_and_no_window_without_a_key(plan_of, name):
    plan = plan_of(name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A window without a partition key would need all rows in one place right below it.
    assert not re.search(r"Window \(\d+\)\n[^\n]*Sort \(\d+\)\n[^\n]*Exchange \(\d+\)[^\n]*SinglePartition", plan)
    for window in re.findall(r"\(\d+\) Window\n.*\nArguments: (.*)", plan):
        assert re.search(r"\], \[[a-z_]+#", window), window


def test_filters_and_columns_reach_the_scan(plan_of):
    plan = plan_of("stock_qty")
    assert "LessThanOrEqual(posting_date,1999-12-31)" in plan and "EqualTo(is_cancelled,0)" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "warehouse" not in read and "stock_value_difference" not in read


def test_item_movements_scan_the_ledger_once(plan_of):
    assert plan_of("item_transactions").count("/stock_ledger_entry]") == 1


def test_no_operator_uses_python(plan_of):
    with_python = {n for n in OPERATORS if re.search(r"MapInPandas|BatchEvalPython|ArrowEvalPython|FlatMapGroups", plan_of(n))}
    assert with_python == set()


@pytest.mark.parametrize("name, scans", [("account_statement", 15), ("item_ledger", 12)])
def test_statement_rows_are_planned_once(plan_of, name, scans):
    plan = plan_of(name)
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) <= scans


def test_all_pairs_take_two_scans_of_the_ledger(plan_of):
    assert plan_of("consolidated_parts").count("/gl_entry]") == 2


def test_statements_of_spread_ledgers(spark, sf_dir):
    """The same lines, whether keys are windows or ranges."""
    from ledgerloom.plans import accounts, items

    t = Tables.from_star_schema(spark, sf_dir)
    for report in (accounts.account_statement, accounts.customer_statement, items.item_ledger):
        want = sorted(map(str, report(t, "1997-01-01", "1999-12-31").collect()))
        spark.conf.set("spark.ledgerloom.spreadFromBytes", "0")
        try:
            assert sorted(map(str, report(t, "1997-01-01", "1999-12-31").collect())) == want
        finally:
            spark.conf.unset("spark.ledgerloom.spreadFromBytes")


@pytest.mark.parametrize("name, scans", [("item_performance", 1), ("brand_performance", 1), ("stock_balance_cost_prices", 1), ("receipt_pricing_worksheet", 1),
                                         ("item_performance_totals", 1), ("item_transactions_totals", 1), ("stock_balance_totals", 1)])
def test_reports_scan_the_ledger_once(plan_of, name, scans):
    assert plan_of(name).count("/stock_ledger_entry]") == scans


def joins_of_small_files(spark, sf_dir, name):
    """How a query joins files that are small enough to broadcast every one of them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plain(OPERATORS[name](Tables.from_star_schema(spark, sf_dir)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin")


@pytest.mark.parametrize("name", ["price_floor_violations", "invoice_price_violations"])
def test_lines_meet_items_and_documents_by_merge_at_any_size(spark, sf_dir, name):
    assert joins_of_small_files(spark, sf_dir, name) == (2, 0)


@pytest.mark.parametrize("name", ["sales_line_difference", "purchase_line_difference"])
def test_order_lines_and_their_lists_are_shuffled_once(spark, sf_dir, name):
    """By order, without a join; the one join is that of the changed units with the factors."""
    assert sum(joins_of_small_files(spark, sf_dir, name)) == 1


def test_total_rows_read_one_shuffle_and_group_no_rows(plan_of):
    plan = plan_of("item_reservations_totals")
    assert "ReusedExchange" in plan and "Expand" not in plan and "SortAggregate" not in plan


def test_ledger_is_summed_before_it_meets_the_other_parts_of_the_promise(spark, sf_dir):
    plan = OPERATORS["available_to_promise_any_year"](Tables.from_star_schema(spark, sf_dir))._jdf.queryExecution().sparkPlan().toString()
    ledger = plan[plan.index("Union"):]
    assert plan.count("HashAggregate", 0, plan.index("Union")) == 2 and ledger.count("HashAggregate") == 2


def test_worksheet_joins_one_row_per_item(plan_of):
    plan = plan_of("receipt_pricing_worksheet")
    assert not re.search(r"Left keys \[2\]: \[item_code#\d+, production_year#\d+\]", plan)
    assert len(re.findall(r"Left keys \[1\]: \[item_code#\d+\]", plan)) == 4
