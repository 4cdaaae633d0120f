"""Moving-average valuation of the stock ledger, item by item and warehouse by warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import or_zero, ratio, year_or_blank
from ledgerloom.functions.predicates import live
from ledgerloom.operators.running import cut_days, large_keys, running_total
from ledgerloom.session import checkpoint_dir
from ledgerloom.sources.tables import Tables

KEYS = ["item_code", "warehouse"]
# Rows of one day in posting order; rows without a time come first, by voucher and row name.
ORDER = ["posting_date", "posting_datetime", "voucher_no", "name"]
SLICE = [*KEYS, "_slice"]
# Rows of one item and warehouse that are folded as one array, and how many of them leave the fold together.
ROWS_PER_SLICE, CHUNK = 1 << 15, 256
# Chains fall into so many buckets to be counted; only those of a bucket with more rows than a slice are counted one by one.
BUCKETS = 1 << 16
# Decimals of stock values and of quantities.
VALUE_PLACES, QTY_PLACES = 2, 3

# A row's own part in the fold; quantities are whole numbers of their smallest unit.
_ROW = ["moved", "set_to", "incoming", "adjusts"]
# The state between rows: quantity, rate, value, and for adjustments the voucher, the value before it, whether it has taken back,
# and by how much the adjustments so far have moved the sum of differences away from the value.
_STATE = "qty: bigint, rate: double, value: double, voucher: string, before: double, taken: boolean, moved_off: double"
_OUT = "struct<qty_after: double, valuation_rate: double, stock_value: double, stock_value_difference: double>"
_ENTRY = ["_entry_qty", "_entry", "_entry_value", "_entry_off"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _rounded(value: Column, places: int) -> Column:
    """Half away from zero."""
    scale = 10.0**places
    return F.signum(value) * (F.floor(F.abs(value) * scale + 0.5) / scale)


def _units(column: str | Column, places: int) -> Column:
    return F.round((F.col(column) if isinstance(column, str) else column).cast("decimal(28,9)") * 10**places).cast("long")


def _step(value_places: int, qty_places: int, with_rows: bool) -> Callable[[Column, Column], Column]:
    """The state after a row. An issue turns the rounded value of what is left back into the rate, so each rate depends on the one before."""
    unit = 10.0**qty_places

    def step(state: Column, row: Column) -> Column:
        reset, moved = row["set_to"].isNotNull(), row["moved"]
        qty = F.when(reset, row["set_to"]).otherwise(state["qty"] + moved)
        had, came = state["qty"] / unit, moved / unit
        rate = (
            F.when(reset | ((moved > 0) & (state["qty"] <= 0)), row["incoming"])
            .when(moved > 0, (had * state["rate"] + came * row["incoming"]) / (had + came)).otherwise(state["rate"])
        )
        same = state["voucher"].eqNullSafe(row["voucher_no"])
        first = F.struct(
            qty.alias("qty"), rate.alias("rate"), F.when(same, state["before"]).otherwise(state["value"]).alias("before"),
            (same & state["taken"]).alias("taken"),
        )

        def valued(x: Column) -> Column:
            left = x["qty"] / unit
            return _let(_rounded(left * x["rate"], value_places), lambda worth: finished(x, left, worth))

        def finished(x: Column, left: Column, worth: Column) -> Column:
            rate = F.when((moved < 0) & (x["qty"] != 0) & ~reset, worth / left).otherwise(x["rate"])
            value = F.when(x["qty"] != 0, worth).otherwise(0.0)
            plain = _rounded(value - state["value"], value_places)
            # An adjustment takes back the differences before its voucher; further ones of the voucher nothing more.
            takes = F.when(x["taken"], 0.0).otherwise(-_rounded(x["before"] + state["moved_off"], value_places))
            change = F.when(row["adjusts"], takes).otherwise(plain)
            off = F.when(row["adjusts"], _rounded(state["moved_off"] + takes - plain, value_places)).otherwise(state["moved_off"])
            new = [
                x["qty"].alias("qty"), rate.alias("rate"), value.alias("value"), row["voucher_no"].alias("voucher"), x["before"].alias("before"),
                (x["taken"] | row["adjusts"]).alias("taken"), off.alias("moved_off"),
            ]
            if not with_rows:
                return F.struct(*new)
            shown = F.struct(left.alias("qty_after"), rate.alias("valuation_rate"), value.alias("stock_value"), change.alias("stock_value_difference"))
            return F.struct(*new, F.concat(state["rows"], F.array(shown)).alias("rows"))

        return _let(first, valued)

    return step


def _state(of: Column | None, rows: bool) -> Column:
    """A state with an empty list of rows: that of a slice's entry, or what another state has reached."""
    if of is None:
        fields = [F.col("_entry_qty"), F.col("_entry"), F.col("_entry_value"), F.lit(None), F.lit(0.0), F.lit(False), F.col("_entry_off")]
    else:
        fields = [of[f.split(":")[0]] for f in _STATE.split(", ")]
    typed = [c.cast(f.split(": ")[1]).alias(f.split(":")[0]) for c, f in zip(fields, _STATE.split(", "), strict=True)]
    return F.struct(*typed, F.array().cast(f"array<{_OUT}>").alias("rows")) if rows else F.struct(*typed)


def _sorted_slices(rows: DataFrame) -> DataFrame:
    """One row a slice, its rows in order as an array."""
    entry = [F.first(c).alias(c) for c in _ENTRY]
    return rows.groupBy(*SLICE).agg(F.sort_array(F.collect_list(F.struct(*ORDER, "actual_qty", *_ROW))).alias("_rows"), *entry)


def _folded(rows: DataFrame, value_places: int, qty_places: int) -> DataFrame:
    """Quantity, rate, value and difference after each row. Chunks of a slice keep the lists that grow in the fold short."""
    slices = _sorted_slices(rows)
    step = _step(value_places, qty_places, with_rows=True)
    starts = F.sequence(F.lit(0), F.floor((F.size("_rows") - 1) / CHUNK).cast("int"))
    chunks = F.transform(starts, lambda k: F.slice("_rows", k * CHUNK + 1, CHUNK))
    start = F.struct(_state(None, rows=False).alias("state"), F.array().cast(f"array<array<{_OUT}>>").alias("done"))

    def chunk_done(so_far: Column, chunk: Column) -> Column:
        return _let(
            F.aggregate(chunk, _state(so_far["state"], rows=True), step),
            lambda end: F.struct(_state(end, rows=False).alias("state"), F.concat(so_far["done"], F.array(end["rows"])).alias("done")),
        )

    out = F.aggregate(chunks, start, chunk_done, lambda end: F.flatten(end["done"]))
    lines = slices.select(*KEYS, F.explode(F.arrays_zip(F.col("_rows").alias("r"), out.alias("o"))).alias("l"))
    return lines.select("l.r.name", *KEYS, "l.r.posting_date", "l.r.posting_datetime", "l.r.voucher_no", F.col("l.r.actual_qty").cast("double").alias("actual_qty"), "l.o.*")


def _ends(rows: DataFrame, value_places: int, qty_places: int) -> DataFrame:
    """The state each slice ends with; ``_exit_off`` is NULL where it is that of the entry, since the slice has no adjustment."""
    end = F.aggregate("_rows", _state(None, rows=False), _step(value_places, qty_places, with_rows=False))
    adjusts = F.exists("_rows", lambda r: r["adjusts"])
    ends = _sorted_slices(rows).select(*SLICE, end.alias("e"), adjusts.alias("a"))
    return ends.select(*SLICE, F.col("e.rate").alias("_exit"), F.col("e.value").alias("_exit_value"), F.when(F.col("a"), F.col("e.moved_off")).alias("_exit_off"))


def _ledger(t: Tables, qty_places: int) -> DataFrame:
    """Live ledger rows; a reconciliation without a year sets quantity and rate anew, a missing quantity moves nothing."""
    ledger = live(t.stock_ledger_entry)
    resets = (F.col("voucher_type") == "Stock Reconciliation") & (year_or_blank() == "") & F.col("qty_after_transaction").isNotNull()
    paid = ratio(F.col("stock_value_difference"), F.col("actual_qty"))
    adjusts = or_zero("is_adjustment_entry") == 1 if "is_adjustment_entry" in ledger.columns else F.lit(False)
    return ledger.select(
        "name", *KEYS, "posting_date", "posting_datetime", "voucher_no", or_zero("actual_qty").alias("actual_qty"),
        _units(or_zero("actual_qty"), qty_places).alias("moved"), F.when(resets, _units("qty_after_transaction", qty_places)).alias("set_to"),
        F.coalesce(F.when(resets, F.col("valuation_rate").cast("double")).otherwise(paid), F.lit(0.0)).alias("incoming"), adjusts.alias("adjusts"),
    )


def moving_average_valuation(t: Tables, rows_per_slice: int = ROWS_PER_SLICE, value_places: int = VALUE_PLACES, qty_places: int = QTY_PLACES) -> DataFrame:
    """Quantity, rate, value and value difference after each ledger row, values rounded to ``value_places`` at every step.

    The rows of one item and warehouse form a chain, since a value is rounded before it becomes the next rate.
    Short chains are folded as they are.  Chains of more than ``rows_per_slice`` rows are cut into slices that
    all tasks fold at once, each from a guessed rate; then every slice whose guess differs from the rate its
    predecessor ended with is folded again, until none does.  At that point the result is exactly that of
    folding row by row.  As rounding swallows small differences and receipts and issues shrink larger
    ones, the last rate of a slice hardly ever depends on its first and a second round only confirms.

    The difference of an adjustment entry (``is_adjustment_entry``) is not that of its value: it takes back the sum of all
    differences before its voucher, earlier adjustments included; of several in one voucher the first does.  It needs no second
    pass: that sum is the value before the voucher and what earlier adjustments moved it by, and after an adjustment the latter no
    longer depends on what it was before.
    """
    ledger = _ledger(t, qty_places)
    entry = [F.lit(0).cast("long").alias("_entry_qty"), *(F.lit(0.0).alias(c) for c in _ENTRY[1:])]
    # At most one long chain per rows_per_slice ledger rows. Rows are counted by their chain's bucket first, which sends next to nothing.
    bucket = F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS)).cast("int")
    full = [r["_bucket"] for r in large_keys(ledger.select(bucket.alias("_bucket")), ["_bucket"], rows_per_slice).select("_bucket").collect()]
    long_chains = large_keys(ledger.where(bucket.isin(full)), KEYS, rows_per_slice) if full else None
    if long_chains is None or long_chains.isEmpty():
        return _folded(ledger.select("*", F.lit(0).alias("_slice"), *entry), value_places, qty_places).drop("posting_datetime")
    checkpoint_dir(ledger.sparkSession)
    long_chains = long_chains.select(*KEYS).checkpoint()
    short = ledger.join(long_chains, KEYS, "left_anti").select(*ledger.columns, F.lit(0).cast("long").alias("_slice"), *entry)
    sliced = _slices(ledger.join(long_chains, KEYS), rows_per_slice).checkpoint()
    entries = _settle(sliced, _first_guess(sliced), value_places, qty_places)
    long_rows = sliced.join(entries, SLICE).select(*ledger.columns, "_slice", *_ENTRY)
    return _folded(short.unionByName(long_rows), value_places, qty_places).drop("posting_datetime")


def _slices(rows: DataFrame, rows_per_slice: int) -> DataFrame:
    """Rows with the quantity before them and the number of their slice.

    Each step reads its input several times, so the input of each is written to the checkpoint folder first.
    """
    tie_break = ORDER[1:]
    resets = F.col("set_to").isNotNull()
    rows = rows.withColumns({"_reset": resets.cast("int"), "_move": F.coalesce("set_to", "moved")})
    rows = running_total(rows, KEYS, "posting_date", tie_break, {"_reset": "_segment"}, spread=True)
    in_segment = [*KEYS, "_segment"]
    rows = running_total(rows, in_segment, "posting_date", tie_break, {"_move": "_after"}, spread=True)
    rows = rows.withColumn("_before", F.when(resets, F.lit(0)).otherwise(F.col("_after") - F.col("_move")))
    # Not within a voucher, whose adjustments look back to its beginning.
    parts = cut_days(rows.checkpoint(), KEYS, "posting_date", tie_break[:-1], rows_per_slice)
    part = [*KEYS, "posting_date", "_slot"]
    earlier = Window.partitionBy(*KEYS).orderBy("posting_date", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy(*part).agg(F.count("*").alias("_n"))
    number = F.floor(F.coalesce(F.sum("_n").over(earlier), F.lit(0)) / F.lit(rows_per_slice)).cast("long").alias("_slice")
    return parts.join(counts.select(*part, number), part).drop("_slot", "_after", "_move", "_reset", "_segment")


def _first_guess(sliced: DataFrame) -> DataFrame:
    """Per slice the exact quantity it starts with and the mean price of the slice before as its rate."""
    received = F.when(F.col("actual_qty") > 0, F.col("actual_qty").cast("double")).otherwise(0.0)
    sums = sliced.groupBy(*SLICE).agg(
        F.min_by("_before", F.struct(*ORDER)).alias("_entry_qty"),
        F.sum(received * F.col("incoming")).alias("_paid"), F.sum(received).alias("_in"),
    )
    by_slice = Window.partitionBy(*KEYS).orderBy("_slice")
    guess = F.coalesce(F.lag(ratio(F.col("_paid"), F.col("_in"))).over(by_slice), F.lit(0.0))
    return sums.select(*SLICE, "_entry_qty", guess.alias("_entry")).checkpoint()


def _settle(sliced: DataFrame, entries: DataFrame, value_places: int, qty_places: int) -> DataFrame:
    """The state every slice starts from, once all agree with the ends of their predecessors."""
    by_slice = Window.partitionBy(*KEYS).orderBy("_slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    exits = ["_exit", "_exit_value", "_exit_off"]
    chain = entries.withColumns({c: F.lit(None).cast("double") for c in exits} | {"_stale": F.lit(True)})
    while True:
        stale = chain.filter("_stale").select(*SLICE, "_entry_qty", "_entry", F.lit(0.0).alias("_entry_value"), F.lit(0.0).alias("_entry_off"))
        ends = _ends(sliced.join(stale, SLICE), value_places, qty_places)
        ends = ends.unionByName(chain.filter("NOT _stale").select(*SLICE, *exits))
        chain = (
            chain.select(*SLICE, "_entry_qty", "_entry").join(ends, SLICE)
            .withColumn("_new", F.coalesce(F.lag("_exit").over(by_slice), F.col("_entry")))
            .withColumn("_stale", ~F.col("_new").eqNullSafe(F.col("_entry")))
            .withColumn("_entry", F.col("_new"))
            .drop("_new")
            .checkpoint()
        )
        if chain.filter("_stale").isEmpty():
            break
    # A slice folded from a value of 0 ends with the same rate and value; what its adjustments moved does not depend on it either,
    # unless its first voucher adjusts: then the value before it is the entry's, so slices are folded once more from true values.
    values = chain.withColumn("_entry_value", F.coalesce(F.lag("_exit_value").over(by_slice), F.lit(0.0))).select(*SLICE, *_ENTRY[:3]).checkpoint()
    if sliced.filter("adjusts").isEmpty():
        return values.withColumn("_entry_off", F.lit(0.0))
    offs = _ends(sliced.join(values, SLICE).withColumn("_entry_off", F.lit(0.0)), value_places, qty_places).select(*SLICE, "_exit_off")
    off = F.coalesce(F.last("_exit_off", ignorenulls=True).over(earlier), F.lit(0.0))
    return values.join(offs, SLICE).withColumn("_entry_off", off).select(*SLICE, *_ENTRY)
