"""Building stored models in the order of their dependencies."""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.operators.stored import Folder, materialize
from pitchlake.plans.facts import INCREMENTAL
from pitchlake.plans.warehouse import MODELS, Warehouse
from pitchlake.session import shuffles_removed


def kind_of(name: str) -> str:
    """Staging models are views, facts with a key are merged, all others are tables."""
    if name.startswith("stg_"):
        return "view"
    return "merge" if name in INCREMENTAL else "table"


@dataclass
class Graph:
    """What each model reads; models that could not even be planned, with the reason."""

    models: dict[str, set[str]] = field(default_factory=dict)
    sources: dict[str, set[str]] = field(default_factory=dict)
    broken: dict[str, str] = field(default_factory=dict)

    def levels(self) -> list[list[str]]:
        """Models by the length of their longest chain of parents."""

        @functools.cache
        def depth(name: str) -> int:
            return 1 + max((depth(p) for p in self.models[name]), default=-1)

        out: dict[int, list[str]] = {}
        for name in sorted(self.models):
            out.setdefault(depth(name), []).append(name)
        return [out[d] for d in sorted(out)]

    def ancestors(self, name: str) -> set[str]:
        return set().union(*({p} | self.ancestors(p) for p in self.models[name]))


class _Recorder(Warehouse):
    """Plans models and notes what each asks for."""

    def __init__(self, wh: Warehouse):
        super().__init__(wh.spark, wh.sources, wh.run_ts, wh.calendar)
        self.graph = Graph()
        self._open: list[str] = []

    def source(self, name: str) -> DataFrame:
        self.graph.sources[self._open[-1]].add(name)
        return super().source(name)

    def ref(self, name: str) -> DataFrame:
        if self._open:
            self.graph.models[self._open[-1]].add(name)
        if name in self.graph.broken:
            raise LookupError(name)
        if name not in self._built:
            self.graph.models[name], self.graph.sources[name] = set(), set()
            self._open.append(name)
            try:
                self._built[name] = MODELS[name](self)
            except Exception as exc:  # noqa: BLE001 - a model's own failure is part of the report
                self.graph.broken[name] = f"{type(exc).__name__}: {exc}".splitlines()[0]
                raise
            finally:
                self._open.pop()
        return self._built[name]


def dependencies(wh: Warehouse, names: Iterable[str] | None = None) -> Graph:
    """The graph of the given models, or of all, from the references they make while planned."""
    recorder = _Recorder(wh)
    for name in names or MODELS:
        try:
            recorder.ref(name)
        except Exception:  # noqa: BLE001, S112 - noted in the graph
            continue
    return recorder.graph


def files_token(df: DataFrame) -> str:
    """A digest of the files behind a stored table; it changes when one is written or goes."""
    return hashlib.md5("\n".join(sorted(df.inputFiles())).encode()).hexdigest()


LOG = "run string, at timestamp, model string, kind string, status string, rows long, " \
      "parents string, error string"


class ModelStore:
    """Stored models below ``root``, and the log of their builds."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def log(self) -> DataFrame:
        if not Folder(self.spark, self.root).names("builds"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.root}/builds")

    def _last_parents(self) -> dict[str, str]:
        """Of each model, the state of its parents when it was last built: a row per model."""
        built = self.log().where(F.col("status") == "built")
        return {r.model: r.parents for r in built.groupBy("model").agg(
            F.max_by("parents", "at").alias("parents")).collect()}

    def build(
        self, wh: Warehouse, names: Iterable[str] | None = None, run: str | None = None,
        at_once: int = 4, stored_sources: bool = False,
    ) -> tuple[Warehouse, DataFrame]:
        """Build models level by level, ``at_once`` of a level at a time.

        A model is built again only if a parent has changed: a stored parent's files, or what is
        below a view. A model that fails is reported, and only its descendants are skipped.
        ``stored_sources`` says that the cleaned tables are files and not cleaned at each use. Returns
        a warehouse on the stored models and the report (model, kind, status, rows, error).
        """
        run = run or uuid.uuid4().hex
        graph = dependencies(wh, names)
        stored = Warehouse(self.spark, wh.sources, wh.run_ts, wh.calendar)
        before, tokens, failed = self._last_parents(), {}, set()
        sources = {s: files_token(wh.source(s)) for s in sorted(set().union(
            *(graph.sources[m] for m in graph.models if m not in graph.broken)))}
        report = []
        for level in graph.levels():
            def job(name: str) -> tuple:
                if graph.ancestors(name) & failed:
                    return name, "skipped", None, None, None
                if name in graph.broken:
                    return name, "failed", None, None, graph.broken[name]
                parents = hashlib.md5(repr(sorted(
                    [(p, tokens[p]) for p in graph.models[name]]
                    + [(s, sources[s]) for s in graph.sources[name]])).encode()).hexdigest()
                kind = kind_of(name)
                try:
                    return self._build_one(
                        stored, name, kind, parents, before, run, stored_sources)
                except Exception as exc:  # noqa: BLE001 - every failure belongs in the report
                    return name, "failed", None, None, str(exc).splitlines()[0]

            with shuffles_removed(self.spark), ThreadPoolExecutor(at_once) as pool:
                done = list(pool.map(inheritable_thread_target(self.spark)(job), level))
            at = dt.datetime.now()
            for name, status, rows, state, error in done:
                if status in ("failed", "skipped"):
                    failed.add(name)
                else:
                    parents, tokens[name] = state
                report.append((run, at, name, kind_of(name), status, rows,
                               state and state[0], error))
            rows_ = report[-len(level):]
            self.spark.createDataFrame(rows_, LOG).coalesce(1).write.mode("append").parquet(
                f"{self.root}/builds")
        return stored, self.spark.createDataFrame(report, LOG).drop("run", "at", "parents")

    def _build_one(
        self, stored: Warehouse, name: str, kind: str, parents: str, before: Mapping[str, str],
        run: str, stored_sources: bool,
    ) -> tuple:
        """(model, status, rows, (parents, own state), error); puts the model into ``stored``."""
        path, key = f"{self.root}/{name}", [INCREMENTAL[name]] if kind == "merge" else None
        if kind == "view":
            stored.put(name, materialize(MODELS[name](stored), name, kind))
            return name, "view", None, (parents, parents), None
        status = "unchanged"
        if before.get(name) != parents:
            status = "built"
            materialize(
                MODELS[name](stored), name, kind, path, key, run, reread=stored_sources)
        table = materialize(None, name, kind, path, key, spark=self.spark)
        stored.put(name, table)
        return name, status, table.count(), (parents, files_token(table)), None
