"""Declarative cleaning: a ``TableSpec`` describes a table, ``clean`` turns it into one plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.operators.scale import first_rows, split_repeated

CASTS = {
    "string": "{}",
    "int": "try_cast({} as int)",
    "long": "try_cast({} as bigint)",
    "long_via_double": "try_cast(try_cast({} as double) as bigint)",
    "double": "try_cast({} as double)",
    "float": "try_cast({} as float)",
    "date": "try_to_date({})",
    "day": "to_date({})",
}


def literal(value: str | int) -> str:
    """SQL literal of a default value."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


@dataclass(frozen=True)
class Col:
    """One raw column and what happens to it, in this order.

    trim (text) -> ``sentinel`` to NULL -> cast to ``kind`` -> ``lower`` -> ``remap`` ->
    NULL outside ``low``..``high`` -> ``blank`` default -> NULL to ``fill``.
    """

    name: str
    kind: str = "string"
    raw: str = "string"
    drop: bool = False
    sentinel: str | None = None
    lower: bool = False
    remap: Mapping[str, str] | None = None
    remap_ignore_case: bool = False
    low: int | None = None
    high: int | None = None
    blank: str | None = None
    fill: str | int | None = None

    def sql(self, blank_as_null: bool = False) -> str:
        """The cleaned column as one SQL expression."""
        c = f"`{self.name}`"
        if self.raw == "string":
            c = f"trim({c})"
            if blank_as_null:
                c = f"nullif({c}, '')"
        if self.sentinel is not None:
            c = f"nullif({c}, {literal(self.sentinel)})"
        c = CASTS[self.kind].format(c)
        if self.lower:
            c = f"lower({c})"
        if self.remap:
            probe = f"lower({c})" if self.remap_ignore_case else c
            arms = " ".join(
                f"when {literal(old.lower() if self.remap_ignore_case else old)} then {literal(new)}"
                for old, new in self.remap.items()
            )
            c = f"case {probe} {arms} else {c} end"
        bounds = [
            f"{c} {op} {bound}"
            for op, bound in ((">=", self.low), ("<=", self.high))
            if bound is not None
        ]
        if bounds:
            c = f"case when {' and '.join(bounds)} then {c} end"
        if self.blank is not None:
            c = f"case when coalesce({c}, '') = '' then {literal(self.blank)} else {c} end"
        if self.fill is not None:
            c = f"coalesce({c}, {literal(self.fill)})"
        return f"{c} as `{self.name}`"


@dataclass(frozen=True)
class TableSpec:
    """A table: raw columns in file order, row rules, key, and columns derived afterwards.

    ``derive`` sees the raw columns that are marked ``drop`` as well; ``finish`` runs on the
    de-duplicated table, for whole-table derivations. ``rarely_repeated`` says that most keys occur
    once, see ``dedup``.
    """

    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...]
    keep: tuple[Callable[[], Column], ...] = ()
    derive: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    finish: Callable[..., DataFrame] | None = None
    rarely_repeated: bool = False

    @property
    def raw_schema(self) -> T.StructType:
        types = {"string": T.StringType(), "int": T.IntegerType(), "timestamp": T.TimestampType()}
        return T.StructType([T.StructField(c.name, types[c.raw]) for c in self.columns])

    @property
    def silver_columns(self) -> list[str]:
        kept = [c.name for c in self.columns if not c.drop]
        return kept + [d for d in self.derive if d not in kept]


def clean(
    raw: DataFrame,
    spec: TableSpec,
    order_by: Sequence[Column | str] | None = None,
    blank_as_null: bool = False,
    **finish_args,
) -> DataFrame:
    """Apply a spec: one projection, one filter, one de-duplication.

    ``order_by`` makes the surviving row of a duplicate key deterministic.
    """
    kept = [c.sql(blank_as_null) for c in spec.columns if not c.drop]
    if spec.derive:
        kept += [f"`{c.name}` as `_raw_{c.name}`" for c in spec.columns if c.drop]
    df = raw.selectExpr(*kept)
    if spec.derive:
        df = df.withColumns({name: make() for name, make in spec.derive.items()})
        df = df.select(*spec.silver_columns)
    for predicate in spec.keep:
        df = df.filter(predicate())
    df = dedup(df, spec.key, order_by, spec.rarely_repeated)
    if spec.finish:
        df = spec.finish(df, **finish_args)
    return df


def dedup(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None,
    rarely_repeated: bool = False,
) -> DataFrame:
    """One row per key: any row, or the first by ``order_by``. NULL keys count as equal.

    If keys are ``rarely_repeated`` only their hashes are sorted out and shuffled, and whole rows of
    the few that may be repeated. The result is the same however many are.
    """
    if rarely_repeated and not df.isStreaming:
        once, others = split_repeated(df, keys)
        return once.unionByName(dedup(others, keys, order_by))
    if order_by is None:
        return df.dropDuplicates(list(keys))
    return first_rows(df, keys, order_by)


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f.name: F.trim(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)}
    )


def safe_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all of ``columns`` are known; written so that the scan can skip by it."""
    return df.filter(" and ".join(f"`{c}` is not null" for c in columns))


def flatten(df: DataFrame, struct: str, *others: str) -> DataFrame:
    return df.select(f"{struct}.*", *others)


def with_literals(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def stamp(df: DataFrame, name: str, run_ts=None) -> DataFrame:
    """Load time; a given ``run_ts`` makes a run repeatable."""
    when = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return df.withColumn(name, when)
