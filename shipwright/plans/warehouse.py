"""The model context: raw frames in, named model DataFrames out.

A model is a plain function ``Warehouse -> DataFrame`` registered under its name. Models ask
the context for their inputs by name, so each one is built once per context and the whole
dependency chain stays one lazy Catalyst plan until an action (write, collect) runs it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwright.operators import skew

MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {}


def model(name: str):
    def register(fn):
        MODELS[name] = fn
        return fn
    return register


class Warehouse:
    """Holds the raw layer and memoises model frames (the frames, not their data)."""

    def __init__(self, spark: SparkSession, raw: dict, params: dict | None = None):
        self.spark = spark
        self.raw = dict(raw)
        self.params = dict(DEFAULT_PARAMS, **(params or {}))
        self._built: dict[str, DataFrame] = {}
        self._months: dict[str, tuple[DataFrame, str]] = {}      # written by month: (frame with the partition column, its name)
        self._measured: dict[str, dict[str, int]] = {}           # seen while a model was written: failures by row test
        self._written_rows: dict[str, int] = {}                  # seen while a model was written: its rows
        self._unique: dict[tuple[str, str], bool] = {}           # by model and column, as looked up
        self._rows: dict[str, int] = {}                          # by raw table, as counted
        self._small: dict[str, bool] = {}                        # by model, as counted
        self._null: dict[tuple[str, str], bool] = {}             # by model and column, as looked up
        self._given: set[str] = set()                            # models replaced by a frame

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.raw:
            raw = self.raw[name]
            if callable(raw):  # raw tables may be given as builders, resolved on first use
                raw = self.raw[name] = raw()
            return raw
        if name not in self._built:
            if name not in MODELS:
                raise KeyError(f"unknown model {name!r}")
            self._built[name] = MODELS[name](self)
        return self._built[name]

    def override(self, name: str, df: DataFrame) -> None:
        """Replace a model by a given frame (e.g. a materialised table read back)."""
        self._built[name] = df
        self._given.add(name)
        self._months.pop(name, None)
        self._measured.pop(name, None)
        self._written_rows.pop(name, None)
        self._unique, self._small, self._null = {}, {}, {}       # other models may be made of this one

    def written(self, name: str, df: DataFrame, columns: list[str], month: str | None, measured: dict[str, int],
                rows: int | None = None) -> None:
        """Replace a model by its files, read back as ``df``: their columns, month folders, measures and number of rows."""
        seen = self._unique, self._small, self._null
        self.override(name, df.select(*columns))
        self._unique, self._small, self._null = seen             # the files hold the model's own rows
        if month:
            self._months[name] = (df, month)
        self._measured[name] = dict(measured)
        if rows is not None:
            self._written_rows[name] = rows

    def staged(self, name: str, df: DataFrame, rows: int) -> None:
        """Replace a model by a working copy of its own rows; models that aren't files or given are made anew, of the copy."""
        self._built = {n: built for n, built in self._built.items() if n in self._given}
        self.written(name, df, df.columns, None, {}, rows)

    def written_rows(self, name: str) -> int | None:
        """Rows of a model's files, as counted when they were written; None if it isn't read from files."""
        return self._written_rows.get(name)

    def measured(self, name: str) -> dict[str, int]:
        """Failures by row test of the model's files, as seen while they were written."""
        return self._measured.get(name, {})

    def has_unique(self, name: str, column: str) -> bool:
        """Whether no value of a model's column occurs twice (NULLs aside); looked up once a context."""
        if (name, column) not in self._unique:
            self._unique[name, column] = skew.has_unique_keys(self[name].select(column), column)
        return self._unique[name, column]

    def raw_rows(self, name: str) -> int:
        """Rows of a raw table; counted once a context."""
        if name not in self._rows:
            self._rows[name] = self[name].count()
        return self._rows[name]

    def has_null(self, name: str, column: str) -> bool:
        """Whether a model's column is NULL in some row; looked up once a context."""
        if (name, column) not in self._null:
            self._null[name, column] = not self[name].filter(F.col(column).isNull()).select(column).isEmpty()
        return self._null[name, column]

    def is_small(self, name: str) -> bool:
        """Whether a dimension has few enough rows to be sent to every executor, whatever the size of the tables; counted once a context."""
        if name not in self._small:
            self._small[name] = skew.is_small(self[name])
        return self._small[name]

    def lookup(self, name: str, key: str, *columns: str) -> DataFrame:
        """Columns of a dimension to be left joined by ``key``.

        Where each key is there once, as a rule, the plan says so, and readers that use none of the columns don't run the join.
        A small dimension is then sent to the rows, so that they stay where they are.
        """
        df = self[name].select(key, *columns)
        if not self.has_unique(name, key):
            return df
        once = df.dropDuplicates([key])
        return F.broadcast(once) if self.is_small(name) else once

    def is_given(self, name: str) -> bool:
        """Whether a frame stands in for the model."""
        return name in self._given or name in self.raw

    def is_written(self, name: str) -> bool:
        """Whether a model is read from files of this context."""
        return name in self._measured

    def between(self, name: str, column: str, start: str, end: str) -> DataFrame:
        """Rows of a model with start <= column <= end; of files in month folders only those months are read."""
        df = self[name]
        lo, hi = F.to_date(F.lit(start)), F.to_date(F.lit(end))
        if name not in self._months:
            return df.filter(F.col(column).between(lo, hi))
        files, month = self._months[name]
        inside = F.col(month).between(F.trunc(lo, "month"), F.trunc(hi, "month"))
        return files.filter(inside & F.col(column).between(lo, hi)).select(*df.columns)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, params: dict | None = None) -> Warehouse:
        from shipwright.sources.testbed import lazy_raw_tables
        return cls(spark, lazy_raw_tables(spark, sf_dir), params)


# Unit-economics assumptions (fixed values of the reference model).
DEFAULT_PARAMS = {
    "marketplace_take_rate": 0.20,
    "payment_processing_rate": 0.03,
    "delivery_cost_ratio": 1.0,
    "handling_cost_per_order": 3.0,
    "handling_cost_per_extra_item": 1.0,
}
