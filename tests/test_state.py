import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchlake.operators.quality import (
    QualityError, accepted_range, accepted_values, enforce, not_null, relationship, run_checks,
    unique, with_status,
)
from pitchlake.operators.state import (
    VersionedTable, build_incremental, merge_partitions, merge_upsert, run_tables, scd2_check,
    snapshot,
)
from pitchlake.operators.stored import materialize
from conftest import rows

T1, T2, T3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))


def facts(spark, *data):
    return spark.createDataFrame(list(data), "id int, goals int, loaded_at timestamp")


def test_merge_replaces_adds_and_repeats(spark):
    base = facts(spark, (1, 1, T1), (2, 2, T1), (3, 3, T1))
    delta = facts(spark, (2, 9, T2), (4, 4, T2))
    once = merge_upsert(base, delta, ["id"])
    want = [(1, 1, T1), (2, 9, T2), (3, 3, T1), (4, 4, T2)]
    assert rows(once) == want
    assert rows(merge_upsert(once, delta, ["id"])) == want


def test_merge_takes_the_newest_of_repeated_keys(spark):
    delta = facts(spark, (1, 5, T2), (1, 6, T3))
    out = merge_upsert(facts(spark, (1, 1, T1)), delta, ["id"], [F.desc("loaded_at")])
    assert rows(out) == [(1, 6, T3)]


def test_incremental_runs(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "fact"))
    assert table.read() is None
    build_incremental(table, facts(spark, (1, 1, T1), (2, 2, T1)), ["id"])
    second = facts(spark, (1, 7, T1), (2, 8, T2), (3, 3, T2))
    out = build_incremental(table, second, ["id"])
    # The row that is not newer than the table stays out.
    assert rows(out) == [(1, 1, T1), (2, 8, T2), (3, 3, T2)]
    assert rows(build_incremental(table, second, ["id"])) == rows(out)
    assert table.versions() == [1, 2, 3]


def test_unfinished_version_is_not_read(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(facts(spark, (1, 1, T1)))
    (tmp_path / "t" / "v=2").mkdir()
    assert table.versions() == [1]
    table.write(facts(spark, (2, 2, T1)))
    assert rows(table.read()) == [(2, 2, T1)]


CHECKS = ["club", "value"]


def players(spark, *data):
    return spark.createDataFrame(list(data), "player_id int, club string, value int, note string")


def test_history(spark, tmp_path):
    first = players(spark, (1, "A", 5, "x"), (2, "B", None, "x"), (3, "C", 1, "x"), (5, "E", 1, "x"))
    second = players(spark, (1, "A", 5, "y"), (2, "B", 7, "y"), (3, "D", 1, "y"), (4, "F", 2, "y"))
    table = VersionedTable(spark, str(tmp_path / "h"))
    snapshot(table, first, "player_id", CHECKS, T1)
    out = snapshot(table, second, "player_id", CHECKS, T2)
    got = rows(out.select("player_id", "club", "value", "note", "valid_from", "valid_to"))
    assert got == sorted(
        [
            (1, "A", 5, "x", T1, None),  # only an unchecked column differs
            (2, "B", None, "x", T1, T2), (2, "B", 7, "y", T2, None),  # NULL to value
            (3, "C", 1, "x", T1, T2), (3, "D", 1, "y", T2, None),
            (4, "F", 2, "y", T2, None),
            (5, "E", 1, "x", T1, None),  # missing in the source: left open
        ],
        key=lambda t: [(v is not None, str(v)) for v in t],
    )
    assert out.select("scd_id").distinct().count() == out.count()
    again = snapshot(table, second, "player_id", CHECKS, T3)
    assert rows(again.select("player_id", "valid_from", "valid_to")) == rows(
        out.select("player_id", "valid_from", "valid_to"))


def test_first_history_is_all_open(spark):
    out = scd2_check(None, players(spark, (1, "A", 1, "x")), "player_id", CHECKS, T1)
    assert out.first()["valid_to"] is None


SEASONS = "id int, season int, goals int"


def test_partition_merge_touches_only_what_changed(spark, tmp_path):
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage-1")
    base = spark.createDataFrame([(1, 2020, 1), (2, 2020, 2), (3, 2021, 3), (4, 2022, 4)], SEASONS)
    base.coalesce(1).write.partitionBy("season").parquet(path)
    untouched = sorted(p.name for p in (tmp_path / "t" / "season=2020").iterdir())
    # Key 3 moves to another season and was the only row of its own; 5 is new.
    delta = spark.createDataFrame([(3, 2022, 9), (5, 2023, 5)], SEASONS)
    for _ in range(2):  # the second run repeats a published stage
        merge_partitions(spark, path, stage, delta, ["id"], "season")
        got = rows(spark.read.parquet(path).select("id", "season", "goals"))
        assert got == [(1, 2020, 1), (2, 2020, 2), (3, 2022, 9), (4, 2022, 4), (5, 2023, 5)]
    assert sorted(p.name for p in (tmp_path / "t" / "season=2020").iterdir()) == untouched


def test_a_failed_job_does_not_stop_the_run(spark):
    def broken():
        raise ValueError("bad file\nmore")

    report = run_tables(spark, {"a": lambda: spark.range(3), "b": broken, "c": lambda: spark.range(0)})
    assert [tuple(r) for r in report.select("table", "status", "rows", "error").collect()] == [
        ("a", "ok", 3, None), ("b", "failed", None, "bad file"), ("c", "ok", 0, None)]


def test_jobs_may_share_the_cluster(spark):
    jobs = {f"t{n}": (lambda n=n: spark.range(n)) for n in range(5)}
    report = run_tables(spark, jobs, at_once=3)
    assert [(r["table"], r["rows"]) for r in report.collect()] == [(f"t{n}", n) for n in range(5)]


def test_materialize(spark, tmp_path):
    view = materialize(spark.range(2), "two_rows", "view")
    assert spark.table("two_rows").count() == view.count()
    assert materialize(spark.range(2), "t", "table", str(tmp_path / "m")).count() == 2
    assert materialize(spark.range(3), "t", "table", str(tmp_path / "m")).count() == 3
    assert materialize(None, "t", "table", str(tmp_path / "m"), spark=spark).count() == 3
    for n in (2, 4):
        merged = materialize(spark.range(n), "k", "merge", str(tmp_path / "k"), ["id"], str(n))
    assert merged.count() == 4
    for kind, path, key in (("table", None, None), ("merge", "x", None), ("file", "x", None)):
        with pytest.raises(ValueError):
            materialize(spark.range(2), "t", kind, path, key)


def test_quality_report(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, -1, "b"), (2, None, "z"), (None, 200, None)], "k int, v int, s string")
    parent = spark.createDataFrame([(1,), (7,)], "p int")
    checks = [
        unique("k", "warn"), not_null("k"), accepted_range("v", 0, 100), accepted_values("s", ["a", "b"]),
        relationship("k", "parent", "p"), not_null("s", "warn"), unique("s"),
    ]
    report = with_status(run_checks("m", df, checks, {"parent": parent}))
    got = {r["test"]: (r["severity"], r["violations"], r["status"]) for r in report.collect()}
    assert got == {
        "unique_k": ("warn", 1, "warn"), "not_null_k": ("error", 1, "error"),
        "range_v": ("error", 2, "error"), "values_s": ("error", 1, "error"),
        "relationship_k": ("error", 1, "error"), "not_null_s": ("warn", 1, "warn"),
        "unique_s": ("error", 0, "pass"),
    }
    with pytest.raises(QualityError, match="m.range_v: 2"):
        enforce(report)
    passing = run_checks("m", df, [unique("s"), not_null("k", "warn")], {})
    assert enforce(passing) is passing


def test_a_column_without_values_has_no_violations(spark):
    df = spark.createDataFrame([(None,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "p int")
    report = run_checks("m", df, [unique("k"), relationship("k", "parent", "p")], {"parent": parent})
    assert {r["test"]: r["violations"] for r in report.collect()} == {
        "unique_k": 0, "relationship_k": 0}


def test_tests_of_rows_and_of_values_read_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, -1), (1, 5), (None, 7)], "k int, v int").write.parquet(path)
    report = run_checks("m", spark.read.parquet(path), [unique("k"), not_null("k"), accepted_range("v", 0)], {})
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["test"]: r["violations"] for r in report.collect()} == {
        "unique_k": 1, "not_null_k": 1, "range_v": 1}
