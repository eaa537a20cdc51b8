"""Figures of writes and streams that are taken on the way, without a second scan."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from pitchlake.operators.quality import Check

ROW_KINDS = ("not_null", "range", "values")
#: Name of the observed figures of a stream.
FIGURES = "figures"


def _figures(checks: Sequence[Check]) -> list:
    if any(c.kind not in ROW_KINDS for c in checks):
        raise ValueError("only tests of single rows can be taken on the way")
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(c.broken()).alias(c.label) for c in checks]]


def observed_write(
    df: DataFrame, name: str, checks: Sequence[Check], write: Callable[[DataFrame], None]
) -> DataFrame:
    """Write ``df`` and report (model, test, severity, violations), counted by the write itself.

    Test ``rows`` is the number of rows. Only tests of single rows can be counted this way; keys
    and references need ``run_checks``.
    """
    seen = Observation(name)
    write(df.observe(seen, *_figures(checks)))
    found, severity = seen.get, {c.label: c.severity for c in checks}
    return df.sparkSession.createDataFrame(
        [(name, test, severity.get(test, "info"), n) for test, n in found.items()],
        "model string, test string, severity string, violations long")


def observed_stream(stream: DataFrame, checks: Sequence[Check] = ()) -> DataFrame:
    """A stream whose progress carries its rows and violations; see ``ProgressTable``."""
    return stream.observe(FIGURES, *_figures(checks))


PROGRESS = (
    "query string, run string, batch_id long, at timestamp, input_rows long, rows long, "
    "state_rows long, watermark string, violations map<string,long>, error string")


class ProgressTable(StreamingQueryListener):
    """A listener that keeps a row per batch of every query, and appends them to a table.

    Progress arrives on a thread of its own, so it is only collected here; ``flush`` writes what has
    arrived since the last call, a few rows per batch. A query that fails leaves a row with its error.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path
        self._rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        figures = (p.get("observedMetrics") or {}).get(FIGURES) or {}
        states = p.get("stateOperators") or []
        self._rows.append((
            p.get("name"), p["runId"], p["batchId"],
            dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")), p["numInputRows"],
            figures.get("rows"), sum(s["numRowsTotal"] for s in states) if states else None,
            (p.get("eventTime") or {}).get("watermark"),
            {k: v for k, v in figures.items() if k != "rows"}, None))

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._rows.append((
                None, str(event.runId), None, dt.datetime.now(dt.timezone.utc), None, None, None,
                None, {}, event.exception.splitlines()[0]))

    def flush(self) -> None:
        taken, self._rows = self._rows, []
        if taken:
            self.spark.createDataFrame(taken, PROGRESS).coalesce(1).write.mode("append").parquet(
                self.path)

    def read(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(PROGRESS).parquet(self.path)
