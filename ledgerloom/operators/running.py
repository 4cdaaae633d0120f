"""Running totals per key that do not need all rows of a large key in one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint_dir

#: Reads of fewer bytes are small enough that any key of theirs fits a task; a session setting of this name overrides it.
SPREAD_FROM, SPREAD_SETTING = 256 << 20, "spark.ledgerloom.spreadFromBytes"


def large_keys(rows: DataFrame, keys: list[str], more_than: int) -> DataFrame:
    """Keys with more than ``more_than`` rows and how many; there is at most one for so many rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > more_than)


def cut_days(rows: DataFrame, keys: list[str], day: str, order: list[str], cut_every: int) -> DataFrame:
    """Adds ``_slot``, the part of its day a row belongs to, in the order of the ``order`` columns.

    Days are cut at some of their own values of these columns, about one row in ``cut_every``, picked by a hash so that
    every attempt of a task picks the same.  Rows with the same values stay together.  Most days have no cut and are one slot.
    """
    value = F.struct(*order)
    picked = rows.filter(F.pmod(F.xxhash64(value), F.lit(cut_every)) == 0)
    cuts = picked.groupBy(*keys, day).agg(F.collect_set(value).alias("_cuts"))
    slot = F.size(F.filter("_cuts", lambda c: c < value))
    return rows.join(cuts, [*keys, day], "left").withColumn("_slot", F.when(F.col("_cuts").isNull(), 0).otherwise(slot)).drop("_cuts")


def bytes_read(df: DataFrame) -> int:
    """Bytes of the files a frame reads, by their listing; no job runs.  Frames that are not read from files count as nothing."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = (int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return sum(size for size in sizes if size < 1 << 62)


def running_total(rows: DataFrame, keys: list[str], day: str, order: list[str], amounts: dict[str, str], spread: bool | None = None) -> DataFrame:
    """Adds, per ``keys``, the sums of ``amounts`` over all rows up to (``day``, ``order``), ties included.

    ``amounts`` maps each input column to its output column.  A NULL amount adds nothing, and the sum is NULL until the first
    amount that is not.  A NULL in a key is a key of its own.

    Rows are planned once.  With ``spread`` they are dealt into ranges of (keys, day, order) and kept in the checkpoint folder
    (a job runs), so a key, and a day of a key, may be of any size: it takes as many tasks as it has ranges.  Otherwise each key is
    one window.  If not said, frames that read ``SPREAD_FROM`` bytes of files or more are spread.  Only rows alike in all of
    (keys, day, order) meet in one task whatever their number.
    """
    if spread is None:
        setting = rows.sparkSession.conf.get(SPREAD_SETTING, None)
        spread = bytes_read(rows) >= (SPREAD_FROM if setting is None else int(setting))
    if spread:
        return _by_ranges(rows, keys, day, order, amounts)
    in_key = Window.partitionBy(*keys).orderBy(day, *order)
    return rows.withColumns({out: F.sum(c).over(in_key) for c, out in amounts.items()})


def _by_ranges(rows: DataFrame, keys: list[str], day: str, order: list[str], amounts: dict[str, str]) -> DataFrame:
    """Ranges of the rows in order, the sum of each key in each range, and what came before added to the totals within a range."""
    checkpoint_dir(rows.sparkSession)
    dealt = rows.repartitionByRange(*keys, day, *order).withColumn("_range", F.spark_partition_id()).checkpoint()
    sums = dealt.groupBy(*keys, "_range").agg(*(F.sum(c).alias(f"_{c}") for c in amounts))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.sum(f"_{c}").over(earlier).alias(f"_before_{c}") for c in amounts]
    renamed = {c: f"_of_{c}" for c in (*keys, "_range")}
    carried = sums.select(*keys, "_range", F.count("*").over(earlier).alias("_n"), *before).filter("_n > 0").drop("_n").withColumnsRenamed(renamed)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(of)) for c, of in renamed.items()))
    in_range = Window.partitionBy("_range", *keys).orderBy(day, *order)

    def total(c: str) -> Column:
        so_far, own = F.col(f"_before_{c}"), F.sum(c).over(in_range)
        return F.coalesce(so_far + own, so_far, own)

    # Keys are in order, so only the first key of a range can have begun before it: at most one row a range.
    joined = dealt.join(F.broadcast(carried), same, "left")
    totals = joined.withColumns({out: total(c) for c, out in amounts.items()})
    return totals.drop("_range", *(f"_before_{c}" for c in amounts), *renamed.values())
