"""Price rows: stock metrics, floors, increases, changes, gaps and duplicates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import normalize_dim, or_zero, ratio, year_or_blank
from ledgerloom.functions.predicates import SUBMITTED, filter_spec, not_cancelled
from ledgerloom.operators import stock as S
from ledgerloom.sources.tables import Tables
from ledgerloom.sources.versions import VersionedTable

METRICS = ("stock_valuation_rate", "stock_qty", "available_qty")


def price_metrics(t: Tables, keys: DataFrame | None = None) -> DataFrame:
    """Value per unit, stock and unreserved stock for each (item, year) of ``keys`` (default: all priced ones)."""
    keys = keys if keys is not None else normalize_dim(t.item_price).select(*S.ITEM_YEAR).distinct()
    rates = S.valuation_rate_bin(t).withColumnRenamed("valuation_rate", "stock_valuation_rate")
    stock = S.stock_qty(t).withColumnRenamed("actual_qty", "stock_qty")
    joined = (
        keys.join(rates, "item_code", "left").join(stock, S.ITEM_YEAR, "left").join(S.reserved_qty(t), S.ITEM_YEAR, "left")
    )
    return joined.withColumn("available_qty", or_zero("stock_qty") - or_zero("qty_to_deliver")).withColumns(
        {"stock_valuation_rate": F.coalesce("stock_valuation_rate", F.lit(0.0)), "stock_qty": or_zero("stock_qty")}
    ).drop("qty_to_deliver")


def price_metrics_refresh(t: Tables) -> DataFrame:
    """Every price row with fresh stock metrics: three aggregates instead of three queries per row."""
    prices = t.item_price.drop(*METRICS).withColumn("_year", year_or_blank())
    metrics = price_metrics(t).withColumnRenamed("production_year", "_year")
    return prices.join(metrics, ["item_code", "_year"], "left").drop("_year")


def _floors_by_item(t: Tables) -> DataFrame:
    """One row per item: its price lists, each with the lowest price of any year and of every year.

    Of price rows by customer, batch or date only the lowest of a list and year is kept before an item's are gathered.
    """
    floors = normalize_dim(t.item_price).filter("item_code IS NOT NULL AND price_list IS NOT NULL")
    by_year = floors.groupBy("item_code", "price_list", "production_year").agg(F.min("price_list_rate").alias("_exact"))
    by_list = by_year.groupBy("item_code", "price_list").agg(
        F.min("_exact").alias("any"), F.map_from_entries(F.collect_list(F.struct("production_year", "_exact"))).alias("years")
    )
    return by_list.groupBy("item_code").agg(F.collect_list(F.struct("price_list", "any", "years")).alias("_lists"))


def price_floor_violations(
    t: Tables, lines: DataFrame, parents: DataFrame, value_column: str, match_year: bool, check_valuation: bool = True, bypass_list: bool = False
) -> DataFrame:
    """Lines sold below value per unit or below the list price of their item (and year, where one is set).

    ``lines`` has name, parent, item_code, production_year, net_rate and ``value_column``, ``parents`` the documents that count, with
    parent and price_list.  Of several price rows the lowest counts.  ``bypass_list`` is the right to sell below list.

    Lines meet the floors of their item in all lists first, in one join; only those below one of them, or below value, are shuffled
    once more to meet their document, which says which list counts.  Items and documents grow with the lines, so both joins merge at
    any size instead of copying one side to every executor as long as its files are small.
    """
    rate, value, year = F.col("net_rate"), F.col(value_column), F.col("production_year")
    priced = normalize_dim(lines).select("name", "parent", "item_code", "production_year", "net_rate", value.alias("_value"))
    value = F.col("_value")
    below_value = F.lit(check_valuation) & (rate < value)
    if bypass_list:
        priced = priced.withColumn("_above", F.lit(None).cast("array<struct<price_list: string, price: double>>"))
    else:
        def price(floor: Column) -> Column:
            return F.when(year == "", floor["any"]).otherwise(floor["years"][year]) if match_year else floor["any"]

        lists = F.transform("_lists", lambda f: F.struct(f["price_list"].alias("price_list"), price(f).cast("double").alias("price")))
        above = F.filter(lists, lambda f: rate < f["price"])
        priced = priced.join(_floors_by_item(t).hint("merge"), "item_code", "left").withColumn("_above", above).drop("_lists")
    candidates = priced.filter(below_value | (F.size("_above") > 0))
    checked = candidates.join(parents.hint("merge"), "parent")
    list_price = F.filter("_above", lambda f: f["price_list"] == F.col("price_list"))
    rules = F.array(
        F.when(below_value, F.struct(F.lit("valuation").alias("rule"), value.cast("double").alias("floor"))),
        F.when(F.size(list_price) > 0, F.struct(F.lit("price list").alias("rule"), F.get(list_price, F.lit(0))["price"].alias("floor"))),
    )
    broken = checked.select("name", "parent", "item_code", "production_year", rate.cast("double").alias("net_rate"), F.explode(F.array_compact(rules)).alias("_r"))
    return broken.select("name", "parent", "item_code", "production_year", "net_rate", "_r.rule", "_r.floor")


def order_price_violations(t: Tables, bypass_list: bool = False) -> DataFrame:
    """Order lines below their floors; the value check runs if the default company asks for it.

    The default company is that of the settings, or else the first by name.
    """
    default = t.singles.filter("doctype = 'Global Defaults' AND field = 'default_company'").agg(F.max("value"))
    by_choice = F.struct(F.col("name") != F.coalesce(default.scalar(), F.lit("")), F.col("name"))
    checks = t.company.agg(F.min_by("validate_selling_price_so", by_choice).alias("_check"))
    orders = not_cancelled(t.sales_order).select(F.col("name").alias("parent"), F.col("selling_price_list").alias("price_list"))
    # The company flag becomes part of the value floor: without it there is none.
    lines = not_cancelled(t.sales_order_item).withColumn("_floor", F.when(checks.scalar() == 1, F.col("valuation_rate")))
    return price_floor_violations(t, lines, orders, "_floor", match_year=True, bypass_list=bypass_list)


def invoice_price_violations(t: Tables, bypass_list: bool = False) -> DataFrame:
    """Lines of invoices (not returns) below their floors; list prices regardless of the year."""
    invoices = not_cancelled(t.sales_invoice).filter("is_return = 0").select(
        F.col("name").alias("parent"), F.col("selling_price_list").alias("price_list")
    )
    return price_floor_violations(t, not_cancelled(t.sales_invoice_item), invoices, "incoming_rate", match_year=False, bypass_list=bypass_list)


def price_increase(prices: DataFrame, percent: int, spec: str | list | dict | None = None) -> DataFrame:
    """Rows of the filter list priced at value per unit plus ``percent``, rounded up; other rows stay out."""
    factor = F.lit(Decimal(100 + percent) / Decimal(100))
    chosen = filter_spec(prices, spec) if spec is not None else prices
    # Six decimals before rounding up, so that a value of 12 * 1.15 does not turn into 13.800000000000001.
    raised = F.ceil(F.round(F.col("stock_valuation_rate").cast("decimal(28,9)") * factor, 6))
    return chosen.withColumn("price_list_rate", raised.cast("double"))


def proposed_price(worksheet: DataFrame, profit_percent: float) -> DataFrame:
    """Worksheet rows with the price that leaves ``profit_percent`` of it as profit, rounded up."""
    margin = F.lit(1 - profit_percent / 100)
    price = F.ceil(F.round(F.try_divide(F.col("receipt_valuation_rate"), margin), 6))
    return worksheet.withColumn("proposed_price", price.cast("double"))


def landed_cost_share(t: Tables) -> DataFrame:
    """Landed cost of each receipt relative to its goods; missing charges count as zero."""
    rated = [("freight_amount", "freight_exchange_rate"), ("inspection_amount", "inspection_exchange_rate"),
             ("foreign_bank_charges_amount", "foreign_bank_charges_exchange_rate")]
    costs = sum(
        (or_zero(a) * or_zero(r) for a, r in rated),
        or_zero("clearance_amount") + or_zero("transport_amount") + or_zero("local_bank_charges_amount"),
    )
    return not_cancelled(t.purchase_receipt).select(
        F.col("name").alias("parent"), ratio(costs, F.col("base_grand_total")).alias("_share")
    )


def receipt_pricing_worksheet(t: Tables, receipts: list[str] | None = None) -> DataFrame:
    """Per receipt line group: cost with landed charges, stock, availability, value per unit and current price."""
    lines = normalize_dim(not_cancelled(t.purchase_receipt_item)).drop("item_name", "brand")
    if receipts is not None:
        lines = lines.filter(F.col("parent").isin(receipts))
    # Goods value per receipt, item and year first; the landed share is the same for the whole receipt. Lines are dealt by item once,
    # and what is known of an item's years comes as one row per item, so no join deals them again.
    grouped = lines.select("parent", *S.ITEM_YEAR, "docstatus", "qty", "base_net_amount", "item_tax_amount").repartition("item_code").groupBy("parent", *S.ITEM_YEAR).agg(
        F.max("docstatus").alias("docstatus"), F.sum("qty").alias("receipt_qty"),
        F.sum(F.col("base_net_amount") + F.col("item_tax_amount")).alias("_goods"),
    )
    items = t.item.select(F.col("name").alias("item_code"), "item_name", "brand", "tire_size", "ply_rating")

    def by_year(value: str | Column) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("production_year", value)))

    # Stock of an item and its years from one pass over the ledger; an item without a line's year still has its own sums.
    years = S.valued_stock(t).groupBy("item_code").agg(
        by_year("actual_qty").alias("_years"), F.max("item_qty").alias("_item_qty"), F.max("item_value").alias("_item_value"),
    )
    reserved = S.reserved_qty_having(t).groupBy("item_code").agg(by_year("qty_to_deliver").alias("_reserved"))
    prices = S.selling_price(t).groupBy(*S.ITEM_YEAR).agg(F.collect_list(F.struct("price_list_rate", "price_name")).alias("_of_year"))
    prices = prices.groupBy("item_code").agg(by_year("_of_year").alias("_prices"))
    year = F.col("production_year")
    rows = (
        grouped.join(landed_cost_share(t), "parent")
        .join(items, "item_code")
        .join(reserved, "item_code", "left")
        .join(years, "item_code", "left")
        .join(prices, "item_code", "left")
        .withColumns({"actual_qty": F.col("_years")[year], "qty_to_deliver": F.col("_reserved")[year]})
        .select("*", F.inline_outer(F.col("_prices")[year]))
        .withColumn("_cost", F.col("_goods").cast("double") * (1 + F.col("_share")))
    )
    done = F.col("docstatus") == SUBMITTED
    qty = F.col("receipt_qty")
    stock = F.when(done, F.col("actual_qty")).otherwise(or_zero("actual_qty") + qty)
    value = F.when(done, F.col("_item_value").cast("double")).otherwise(or_zero(F.col("_item_value").cast("double")) + F.col("_cost"))
    value_qty = F.when(done, F.col("_item_qty")).otherwise(or_zero("_item_qty") + qty)
    return rows.select(
        F.col("parent").alias("purchase_receipt"), "item_code", "item_name", "brand", "production_year",
        qty.cast("double").alias("receipt_qty"), ratio(F.col("_cost"), qty).alias("receipt_valuation_rate"),
        stock.cast("double").alias("stock_qty"), (stock - or_zero("qty_to_deliver")).cast("double").alias("available_qty"),
        ratio(value, value_qty).alias("stock_valuation_rate"), F.col("price_list_rate").cast("double").alias("selling_price"),
        "price_name",
    )


def _default_list(t: Tables) -> DataFrame:
    return t.singles.filter("doctype = 'Selling Settings' AND field = 'selling_price_list'").agg(F.max("value"))


def price_upsert(t: Tables, changes: DataFrame, price_list: str | None = None) -> DataFrame:
    """The price table after a change list (name, item_code, item_name, production_year, price).

    A known name with another price is updated, an unknown or missing name becomes a new row in
    ``price_list`` (default: the selling list of the settings).  ``action`` says what happened to a row.
    """
    # Of several changes of a row the last counts: by idx where the list has one, else the highest price.
    position = "idx" if "idx" in changes.columns else "price"
    known = changes.filter("name IS NOT NULL").groupBy("name").agg(F.max_by("price", position).alias("_price"))
    updated = t.item_price.join(known, "name", "left")
    differs = F.col("_price").isNotNull() & ~F.col("_price").eqNullSafe(F.col("price_list_rate"))
    updated = (
        updated.withColumn("action", F.when(differs, "update").otherwise("keep"))
        .withColumn("price_list_rate", F.when(differs, F.col("_price")).otherwise(F.col("price_list_rate")))
        .drop("_price")
    )
    if "item_code" not in changes.columns:  # a list of updates only
        return updated
    added = changes.join(t.item_price.select("name"), "name", "left_anti").select(
        "name", "item_code", "item_name", "production_year", F.col("price").alias("price_list_rate"),
        (F.lit(price_list) if price_list else _default_list(t).scalar()).alias("price_list"), F.lit("insert").alias("action"),
    )
    return updated.unionByName(added, allowMissingColumns=True)


def import_price_sheet(sheet: DataFrame) -> DataFrame:
    """A price sheet (columns as ``export_prices`` writes them) as a change list of updates, in the order of its ``idx`` if it has one.

    The row's name is its first column and the price its fifth; rows without a name are left out, as a sheet adds no prices.
    """
    name, price = sheet.columns[0], sheet.columns[4]
    order = ["idx"] if "idx" in sheet.columns else []
    rows = sheet.select(F.nullif(F.col(name), F.lit("")).alias("name"), F.col(price).cast("decimal(21,3)").alias("price"), *order)
    return rows.filter("name IS NOT NULL")


def commit_price_changes(prices: VersionedTable, t: Tables, changes: DataFrame, price_list: str | None = None, writer: tuple[str, int] | None = None) -> bool:
    """``price_upsert`` on a price table of versions: one new version with all changes, or none.

    Known names are looked up for their items, whose buckets alone are rewritten. Names that are unknown become new rows where the
    list says their item, and are left out where it has none (a sheet).  ``writer`` makes a repeated import change nothing.
    """
    places = prices.read().groupBy("name").agg(F.min("item_code").alias("_place"))
    named = changes.join(places, "name", "left")
    has_item = "item_code" in changes.columns
    place = F.coalesce("_place", "item_code") if has_item else F.col("_place")
    # A change of a known name goes to the row's own item.
    placed = named.withColumn("item_code", place).drop("_place")
    placed = placed if has_item else placed.filter("item_code IS NOT NULL")

    def merge(rows: DataFrame, some: DataFrame) -> DataFrame:
        return price_upsert(t.replace(item_price=rows), some if has_item else some.drop("item_code"), price_list).drop("action")

    return prices.apply(placed, merge, writer)


def _selling_lists(t: Tables) -> DataFrame:
    """The selling price lists in one row; price lists are settings, not data, so there are a handful."""
    return t.price_list.filter("selling = 1").agg(F.sort_array(F.collect_set("name")))


def price_grid_completion(t: Tables, lines: DataFrame) -> DataFrame:
    """Zero-priced rows for each (item, selling list, year) that ``lines`` mention and no price row covers."""
    wanted = normalize_dim(lines).select(*S.ITEM_YEAR).distinct()
    grid = wanted.withColumn("price_list", F.explode(_selling_lists(t).scalar()))
    priced = normalize_dim(t.item_price).select("price_list", *S.ITEM_YEAR)
    missing = grid.join(priced, ["price_list", *S.ITEM_YEAR], "left_anti")
    items = t.item.select(F.col("name").alias("item_code"), "item_name", "brand", "description")
    return missing.join(items, "item_code", "left").select(
        "item_code", "price_list", "production_year", F.lit(0.0).alias("price_list_rate"), F.lit(1).alias("selling"),
        "item_name", "brand", F.col("description").alias("item_description"),
    )


def item_price_defaults(t: Tables) -> DataFrame:
    """Zero-priced rows for each item and selling list without any price row (new items)."""
    items = t.item.select(F.col("name").alias("item_code"), "item_name", "brand", "description")
    grid = items.withColumn("price_list", F.explode(_selling_lists(t).scalar()))
    return grid.join(t.item_price.select("item_code", "price_list"), ["item_code", "price_list"], "left_anti").select(
        "item_code", "price_list", F.lit(0.0).alias("price_list_rate"), F.lit(1).alias("selling"), "item_name", "brand",
        F.col("description").alias("item_description"),
    )


def price_attribute_sync(t: Tables) -> DataFrame:
    """Price rows of selling lists with name, brand and description taken from their item."""
    items = t.item.select(
        F.col("name").alias("item_code"), F.col("item_name").alias("_name"), F.col("brand").alias("_brand"), "description"
    )
    lists = t.price_list.filter("selling = 1").select(F.col("name").alias("price_list"), F.lit(True).alias("_selling"))
    rows = t.item_price.join(items, "item_code", "left").join(lists, "price_list", "left")
    ours = F.col("_selling") & F.col("_name").isNotNull()
    return rows.withColumns(
        {
            "item_name": F.when(ours, F.col("_name")).otherwise(F.col("item_name")),
            "brand": F.when(ours, F.col("_brand")).otherwise(F.col("brand")),
            "item_description": F.when(ours, F.col("description")),
        }
    ).drop("_name", "_brand", "_selling", "description")


def duplicate_prices(t: Tables) -> DataFrame:
    """Groups of price rows that differ in nothing a buyer could choose by."""
    # What a buyer could choose by.
    text = ("uom", "valid_from", "valid_upto", "customer", "supplier", "batch_no", "production_year")
    normal = t.item_price.select(
        "item_code", "price_list", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in text),
        or_zero("packing_unit").alias("packing_unit"), "name",
    )
    groups = normal.groupBy("item_code", "price_list", *text, "packing_unit").agg(
        F.count("*").alias("n"), F.min("name").alias("first_name")
    )
    return groups.filter("n > 1")


def price_segments(prices: DataFrame) -> DataFrame:
    """The quick filters of the price list as flags; ``prices`` carries the stock metrics."""
    price, value, selling = F.col("price_list_rate"), F.col("stock_valuation_rate"), F.col("selling") == 1
    flags = {
        "in_stock": F.col("stock_qty") > 0,
        "available": F.col("available_qty") > 0,
        "non_priced": (price == 0) & (value > 0) & selling,
        "non_profitable": (price > 0) & (value > 0) & (price < value) & selling,
    }
    return prices.withColumns({k: F.coalesce(v, F.lit(False)).cast("int") for k, v in flags.items()})


def price_lookup(t: Tables, lines: DataFrame) -> DataFrame:
    """Lines with the default-list price of their item and the selling price of their item and year."""
    default = t.singles.filter("doctype = 'Selling Settings' AND field = 'selling_price_list'").select(
        F.col("value").alias("price_list")
    )
    by_item = (
        t.item_price.join(default, "price_list", "left_semi").groupBy("item_code").agg(F.min("price_list_rate").alias("list_price"))
    )
    by_year = normalize_dim(t.item_price.filter("selling = 1")).groupBy(*S.ITEM_YEAR).agg(
        F.min("price_list_rate").alias("return_price")
    )
    return normalize_dim(lines).join(by_item, "item_code", "left").join(by_year, S.ITEM_YEAR, "left")
