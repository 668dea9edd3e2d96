"""The warehouse: raw tables plus lazily built models.

A model is a function ``build(wh) -> DataFrame``. Models stay lazy, so a staging model read by
an intermediate model collapses into one Catalyst plan; ``materialise`` writes chosen models to
Parquet, after which every reader sees the written table instead of recomputing it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from excursio.shared import shared_folder, write_shared

Builder = Callable[["Warehouse"], DataFrame]

# The calendar's default half-open range.
CALENDAR_START = dt.date(2025, 5, 1)
CALENDAR_END = dt.date(2028, 1, 1)


def models() -> dict[str, Builder]:
    """Every model in dependency order."""
    from excursio.plans import features, intermediate, marts, staging

    return {
        **staging.MODELS,
        **intermediate.MODELS,
        **marts.MODELS,
        **features.MODELS,
    }


def _builder(name: str) -> Builder:
    from excursio.plans.intermediate import HELPERS

    return HELPERS.get(name) or models()[name]


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame | Callable[[], DataFrame]],
        as_of: dt.date | None = None,
        calendar: tuple[dt.date, dt.date] = (CALENDAR_START, CALENDAR_END),
    ) -> None:
        self.spark = spark
        self._raw = dict(raw)
        self.calendar = calendar
        self._as_of = as_of
        self._built: dict[str, DataFrame] = {}
        self.written: set[str] = set()

    def as_of(self) -> Column:
        return F.current_date() if self._as_of is None else F.lit(self._as_of)

    def flagged_at(self) -> Column:
        if self._as_of is None:
            return F.current_timestamp()
        return F.lit(self._as_of).cast("timestamp_ntz")

    def source(self, name: str) -> DataFrame:
        """A raw table; sources given as functions are opened on first use."""
        if callable(self._raw[name]):
            self._raw[name] = self._raw[name]()
        return self._raw[name]

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _builder(name)(self)
        return self._built[name]

    def materialise(self, *names: str) -> "Warehouse":
        """Write the named models once; later reads come from the written files."""
        for name in names:
            if name not in self.written:
                self.replace(name, write_shared(self.table(name), name))
        return self

    def materialise_stages(self, stages: Iterable[Iterable[str]]) -> "Warehouse":
        """Write stage after stage; the models of one stage are written side by side."""
        shared_folder(self.spark)  # settled before the writers start
        for stage in stages:
            pending = {name: self.table(name) for name in stage if name not in self.written}
            with ThreadPoolExecutor(max(1, len(pending))) as pool:
                copies = list(pool.map(write_shared, pending.values(), pending))
            for name, copy in zip(pending, copies):
                self.replace(name, copy)
        return self

    def settled(self, df: DataFrame, label: str, *upstream: str) -> DataFrame:
        """``df`` itself when its models are written already, otherwise a written copy of it.

        For plans that read ``df`` more than once and would recompute it each time.
        """
        return df if self.written.issuperset(upstream) else write_shared(df, label)

    def replace(self, name: str, df: DataFrame) -> None:
        """Swap a model for an already written copy; unwritten models are rebuilt on it."""
        self._built = {k: v for k, v in self._built.items() if k in self.written}
        self._built[name] = df
        self.written.add(name)

    def create_views(self, names: Iterable[str] | None = None) -> None:
        """Expose models to ``spark.sql`` under their own names."""
        for name in names or models():
            self.table(name).createOrReplaceTempView(name)
