"""Registry of checked queries."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import pitchlake.plans.dimensions
import pitchlake.plans.facts
import pitchlake.plans.marts
import pitchlake.plans.staging  # noqa: F401 - importing registers the models
from checks import standins
from pitchlake.operators.clean import clean
from pitchlake.plans.specs import SPECS
from pitchlake.plans.warehouse import Warehouse

AS_OF = dt.date(2024, 6, 30)
RUN_TS = dt.datetime(2024, 7, 1)


class Context:
    """Test tables, the raw tables derived from them, and everything built on those."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._warehouse: Warehouse | None = None

    @functools.cache
    def base(self, name: str) -> DataFrame:
        return standins.base(self.spark, self.sf_dir, name)

    @functools.cache
    def raw(self, name: str) -> DataFrame:
        return standins.raw_table(self.spark, name, self.base)

    def silver(self, name: str) -> DataFrame:
        spec = SPECS[name]
        args = {"as_of": AS_OF} if name == "players" else {}
        return clean(self.raw(name), spec, order_by=spec.silver_columns, **args)

    @property
    def warehouse(self) -> Warehouse:
        if self._warehouse is None:
            self._warehouse = Warehouse(self.spark, SilverTables(self), run_ts=RUN_TS)
        return self._warehouse

    def ref(self, name: str) -> DataFrame:
        return self.warehouse.ref(name)


class SilverTables(Mapping):
    """Cleaned tables by name, each planned when a model first asks for it."""

    def __init__(self, ctx: Context):
        self._ctx = ctx
        self._ready: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._ready:
            self._ready[name] = self._ctx.silver(name)
        return self._ready[name]

    def __iter__(self):
        return iter(SPECS)

    def __len__(self) -> int:
        return len(SPECS)


@dataclass(frozen=True)
class Entry:
    name: str
    covers: str
    run: Callable[[Context], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def check(name: str, covers: str, sql: str | None = None):
    """Register a query under ``name``; ``covers`` lists the operators it exercises."""

    def register(run: Callable[[Context], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(name, covers, run, sql)
        return run

    return register


def days_as_text(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that both engines return the same values."""
    timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, timed) else f.name
            for f in df.schema
        ]
    )


def run_entry(entry: Entry, spark: SparkSession, sf_dir: str) -> DataFrame:
    return days_as_text(entry.run(Context(spark, sf_dir)))


# --- SQL composed from named common table expressions ---------------------------------------------

CTES: dict[str, tuple[Sequence[str], str]] = {}


def cte(name: str, needs: Sequence[str], sql: str) -> None:
    CTES[name] = (tuple(needs), sql)


for _name in standins.RAW_SQL:
    cte(f"raw_{_name}", (), standins.raw_oracle(_name))


def with_ctes(needs: Sequence[str], final: str) -> str:
    """``final`` preceded by the expressions it needs, in order of dependency."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for parent in CTES[name][0]:
                visit(parent)
            ordered.append(name)

    for name in needs:
        visit(name)
    parts = ",\n".join(f"{n} as ({CTES[n][1]})" for n in ordered)
    return f"with {parts}\n{final}" if parts else final


def table_sql(name: str, as_text: Sequence[str] = (), without: Sequence[str] = ()) -> str:
    """Everything of one common table expression, with days as text."""
    star = "*"
    if without:
        star += f" exclude ({', '.join(without)})"
    if as_text:
        star += " replace (" + ", ".join(f"cast({c} as varchar) as {c}" for c in as_text) + ")"
    return with_ctes([name], f"select {star} from {name}")
