"""A set of business tables, each read on first use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources import erp_views, schemas


class Tables:
    """Business tables by name: ``tables.gl_entry`` is a DataFrame.

    The three constructors differ in where the rows are: parquet folders per table (``from_parquet``),
    views over the star-schema test data (``from_star_schema``) or frames at hand (``from_frames``).
    """

    def __init__(self, read: Callable[[str], DataFrame]):
        self._read = read
        self._known: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            self._known[name] = self._read(name)
        return self._known[name]

    def replace(self, **frames: DataFrame) -> Tables:
        """The same tables with some of them swapped, e.g. a price table with fresh metrics."""
        return Tables(lambda name: frames[name] if name in frames else getattr(self, name))

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Tables:
        """``root/<table>`` parquet folders read with the declared schema, without inference."""
        return cls(lambda name: spark.read.schema(schemas.struct(name)).parquet(f"{root}/{name}"))

    @classmethod
    def from_csv(cls, spark: SparkSession, root: str, **options: str) -> Tables:
        """``root/<table>`` CSV folders with a header line, read with the declared schema."""
        reader = lambda name: spark.read.schema(schemas.struct(name)).option("header", True).options(**options)
        return cls(lambda name: reader(name).csv(f"{root}/{name}"))

    @classmethod
    def from_frames(cls, **frames: DataFrame) -> Tables:
        def read(name: str) -> DataFrame:
            if name not in frames:
                raise KeyError(f"no table {name!r} among {sorted(frames)}")
            return frames[name]

        return cls(read)

    @classmethod
    def from_star_schema(cls, spark: SparkSession, sf_dir: str) -> Tables:
        """The business views over ``sf_dir/*.parquet``.  Each raw file is listed once for all views."""
        raw = cls(lambda table: spark.read.schema(erp_views.RAW_TABLES[table]).parquet(f"{sf_dir}/{table}.parquet"))

        def view(name: str) -> DataFrame:
            text = erp_views.with_clause([name], {table: f"{{{table}}}" for table in erp_views.RAW_TABLES})
            used = {table: getattr(raw, table) for table in erp_views.RAW_TABLES if f"{{{table}}}" in text}
            return spark.sql(f"{text}\nSELECT * FROM {name}", **used)

        return cls(view)
