"""Named models on top of the cleaned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {}


class Warehouse:
    """Cleaned tables plus the models built from them.

    ``source(name)`` is a cleaned table, ``ref(name)`` a model; each model is planned once and
    shared. Tables given in ``built`` (for example facts read back from Parquet) replace the
    model of that name, so later models start from stored data.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame],
        run_ts: dt.datetime | None = None,
        calendar: tuple[dt.date, dt.date] = (dt.date(2000, 1, 1), dt.date(2030, 12, 31)),
        built: Mapping[str, DataFrame] | None = None,
    ):
        self.spark = spark
        self.sources = sources
        self.run_ts = run_ts
        self.calendar = calendar
        self._built = dict(built or {})

    def source(self, name: str) -> DataFrame:
        return self.sources[name]

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODELS[name](self)
        return self._built[name]

    def put(self, name: str, df: DataFrame) -> None:
        """From now on ``ref(name)`` is ``df``."""
        self._built[name] = df

    def loaded(self, df: DataFrame, column: str = "loaded_at") -> DataFrame:
        """Keep a load time that came with the data; stamp the run time otherwise."""
        if column in df.columns:
            return df
        now = F.current_timestamp() if self.run_ts is None else F.lit(self.run_ts).cast("timestamp")
        return df.withColumn(column, now)


def model(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a function under its own name."""
    MODELS[fn.__name__] = fn
    return fn
