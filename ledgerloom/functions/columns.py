"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters a spreadsheet cell may not hold.
ILLEGAL_CELL_CHARACTERS = r"[\x00-\x08\x0B-\x0C\x0E-\x1F]"


def year_or_blank(column: str | Column = "production_year") -> Column:
    """A missing production year and an empty one are the same dimension value."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def normalize_dim(df: DataFrame, column: str = "production_year") -> DataFrame:
    """``df`` with the production year in its one spelling."""
    return df.withColumn(column, year_or_blank(column))


def or_zero(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0))


def ratio(numerator: Column, divisor: Column) -> Column:
    """Division in doubles, NULL where the divisor is zero."""
    return F.try_divide(numerator.cast("double"), divisor.cast("double"))


def rounded(value: Column, places: int) -> Column:
    """Half up on decimals: 617.285 is 617.29 although its double lies a little below."""
    return F.round(value.cast("decimal(28,9)"), places).cast("double")


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Amounts leave an operator as doubles once their exact decimal sums are done."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def percent(profit: Column, base: Column) -> Column:
    """``profit / base`` in percent to one place, NULL on a zero base."""
    return rounded(ratio(profit, base) * 100, 1)


def percent_text(value: Column) -> Column:
    """``1234.5`` as ``1,234.5%``."""
    return F.concat(F.format_number(value, 1), F.lit("%"))


def with_total_row(df: DataFrame, label: str, numeric: list[str], text: str = "Total") -> DataFrame:
    """``df`` plus one row with the sums of ``numeric`` and ``text`` in the ``label`` column, in one pass over ``df``.

    Rows are numbered and dealt by number once, and read twice: as they are, and for the sums, so no task sorts or groups whole rows.
    Doubles are summed as decimals, which do not depend on the order of tasks.  Rows keep their order, the total comes last; no rows have no total.
    """
    def exact(c: str) -> Column:
        value = F.col("_first")[c]
        return value.cast("decimal(28,9)") if df.schema[c].dataType.typeName() in ("double", "float") else value

    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    # A row that could be NULL has to be there to be counted, so both parts read the same shuffle and the plan below it runs once.
    numbered = numbered.select("_row", F.when(F.col("_row") >= 0, F.struct(*df.columns)).alias("_first")).repartition("_row")
    total = numbered.agg(F.count("_first").alias("_n"), *(F.sum(exact(c)).alias(f"_sum_{c}") for c in numeric)).filter("_n > 0")
    rows = numbered.withColumn("is_total", F.lit(0)).unionByName(total.drop("_n").withColumn("is_total", F.lit(1)), allowMissingColumns=True)
    is_total = F.col("is_total") == 1

    def cell(c: str) -> Column:
        one, kind = F.col("_first")[c], df.schema[c].dataType
        if c == label:
            return F.when(is_total, F.lit(text)).otherwise(one)
        if c in numeric:
            total = F.col(f"_sum_{c}")
            return F.when(is_total, total.cast(kind) if kind.typeName() in ("double", "float") else total).otherwise(one)
        return F.when(~is_total, one)

    # The number of all rows together is NULL.
    return rows.orderBy(F.col("_row").asc_nulls_last()).select(*(cell(c).alias(c) for c in df.columns), "is_total")


def report_with_total(df: DataFrame) -> DataFrame:
    """A report plus its total row: sums of all amounts, quantities and rates, ``Total`` in the first column."""
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "decimal")]
    return with_total_row(df, df.columns[0], numeric)


def sanitize_cells(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text columns without HTML tags and without characters a sheet may not hold."""
    chosen = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns(
        {c: F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", ""), ILLEGAL_CELL_CHARACTERS, "") for c in chosen}
    )
