"""Keyed tables with fingerprints, and histories in two parts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchlake.operators.state import VersionedTable
from pitchlake.operators.stored import HistoryTable, KeyedTable, fingerprint
from pitchlake.sources.files import write_silver
from conftest import rows

T1, T2, T3, T4 = (dt.datetime(2024, m, 1) for m in (1, 2, 3, 4))
COLUMNS = "id int, club string, note string, goals int, loaded_at timestamp"


def facts(spark, n, at, change=lambda i: False, club=None):
    data = [(i, club or f"c{i % 3}", None, i + 1000 * change(i), at) for i in range(n)]
    return spark.createDataFrame(data, COLUMNS)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns
            for p in path.rglob("*.parquet") if "/runs/" not in str(p)}


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    path = tmp_path / "t"
    table = KeyedTable(spark, str(path), ["id"], buckets=16)
    assert table.read() is None
    table.upsert(facts(spark, 400, T1), "1")
    first = files(path)
    assert rows(table.upsert(facts(spark, 400, T2), "2")) == rows(facts(spark, 400, T1))
    assert files(path) == first  # not one file was written
    third = facts(spark, 402, T3, lambda i: i in (7, 100, 333))
    out = table.upsert(third, "3")
    want = {r.id: r for r in facts(spark, 400, T1).collect()}
    want |= {r.id: r for r in third.collect() if r.id in (7, 100, 333, 400, 401)}
    assert rows(out) == sorted((tuple(r) for r in want.values()), key=lambda t: [
        (v is not None, str(v)) for v in t])
    bucket = F.pmod(F.xxhash64("id"), F.lit(16))
    touched = {r[0] for r in third.where(F.col("id").isin(7, 100, 333, 400, 401)).select(
        bucket).collect()}
    written = {name.split("_bucket=")[1].split("/")[0] for name in files(path) if name not in first}
    assert written == {str(b) for b in touched} and len(written) < 16
    # A table that was stored with another number of buckets keeps it.
    assert KeyedTable(spark, str(path), ["id"], buckets=3).buckets == 16


def test_a_value_that_moves_beside_a_null_is_a_change(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    one = spark.createDataFrame([(1, "x", None, 5, T1)], COLUMNS)
    other = spark.createDataFrame([(1, None, "x", 5, T2)], COLUMNS)
    table.upsert(one, "1")
    assert rows(table.upsert(other, "2")) == rows(other)


def test_repeated_and_null_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    data = [(1, "a", None, 1, T1), (1, "b", None, 2, T2), (None, "n", None, 3, T1)]
    table.upsert(spark.createDataFrame(data, COLUMNS), "1", [F.desc("loaded_at")])
    assert rows(table.read().select("id", "club")) == [(None, "n"), (1, "b")]
    table.upsert(spark.createDataFrame([(None, "m", None, 3, T1)], COLUMNS), "2")
    assert rows(table.read().select("id", "club")) == [(None, "m"), (1, "b")]
    empty = spark.createDataFrame([], COLUMNS)
    assert table.upsert(empty, "3").count() == 2


def test_runs_that_break_off_are_repeated(spark, tmp_path, monkeypatch):
    path = tmp_path / "t"
    table = KeyedTable(spark, str(path), ["id"], buckets=4)
    second = facts(spark, 60, T2, lambda i: i % 10 == 0)

    def stop(self, *args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # the first build doesn't end
        m.setattr(KeyedTable, "_write", stop)
        with pytest.raises(RuntimeError):
            table.upsert(facts(spark, 50, T1), "1")
    assert table.read() is None
    table.upsert(facts(spark, 50, T1), "1")
    with monkeypatch.context() as m:  # staged, but not published
        m.setattr(KeyedTable, "_write", stop)
        with pytest.raises(RuntimeError):
            table.upsert(second, "2")
    assert rows(table.read()) == rows(facts(spark, 50, T1))
    # A published bucket may be lost half way; the stage holds its content.
    for p in (path / "buckets=4" / "_bucket=1").iterdir():
        p.unlink()
    out = table.upsert(second, "2")
    assert out.count() == 60 and out.where("goals >= 1000").count() == 6
    before = files(path)
    assert rows(table.upsert(facts(spark, 99, T3), "2")) == rows(out)  # this name is done
    assert files(path) == before and not (path / "runs" / "2").exists()


CHECKS = ["club", "value"]


def players(spark, *data):
    return spark.createDataFrame(list(data), "player_id int, club string, value int, note string")


def test_history_in_two_parts(spark, tmp_path, monkeypatch):
    path = tmp_path / "h"
    table = HistoryTable(spark, str(path))
    assert table.read() is None
    table.snapshot(players(spark, (1, "A", 5, "x"), (2, "B", None, "x"), (5, "E", 1, "x")),
                   "player_id", CHECKS, T1)
    second = players(spark, (1, "A", 5, "y"), (2, "B", 7, "y"), (4, "F", 2, "y"))
    with monkeypatch.context() as m:  # rows are written, the mark is not
        m.setattr("pitchlake.operators.stored.Folder.mark", lambda self, name: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.snapshot(players(spark, (1, "Z", 0, "z")), "player_id", CHECKS, T2)
    assert table.read().count() == 3
    table.snapshot(second, "player_id", CHECKS, T2)
    closed = path / "rows" / "state=closed"
    kept = {p: p.stat().st_mtime_ns for p in closed.rglob("*.parquet")}
    for at in (T2, T3):
        out = table.snapshot(second, "player_id", CHECKS, at)
    out = table.snapshot(players(spark, (2, "C", 7, "w")), "player_id", CHECKS, T4)
    assert rows(out.select("player_id", "club", "value", "note", "valid_from", "valid_to")) == sorted([
        (1, "A", 5, "x", T1, None), (5, "E", 1, "x", T1, None), (4, "F", 2, "y", T2, None),
        (2, "B", None, "x", T1, T2), (2, "B", 7, "y", T2, T4), (2, "C", 7, "w", T4, None),
    ], key=lambda t: [(v is not None, str(v)) for v in t])
    assert {p: p.stat().st_mtime_ns for p in kept} == kept
    assert len(list((path / "rows" / "state=open").iterdir())) == 1
    with pytest.raises(ValueError):
        table.snapshot(second, "player_id", CHECKS, T3.replace(day=2))


def test_a_merge_compares_keys_before_it_moves_rows(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"])
    table.upsert(facts(spark, 400, T1), "1")
    seen, changes = [], table.changes
    monkeypatch.setattr(table, "changes", lambda rows, *a: seen.append(rows.count()) or changes(rows, *a))
    later = facts(spark, 401, T2, lambda i: i in (7, 9))
    twice = later.unionByName(facts(spark, 8, T3, lambda i: i == 7))  # repeated keys, 7 differs
    table.upsert(twice, "2")
    assert seen == [4]  # ids 7, 7, 9 and 400
    assert table.read().where("loaded_at > timestamp '2024-01-15'").count() == 3
    nulls = spark.createDataFrame([(None, "n", None, 3, T1)], COLUMNS)
    table.upsert(nulls, "3")
    table.upsert(nulls, "4")
    assert seen == [4, 1, 0] and table.read().count() == 402


def test_stored_tables_take_half_the_space_of_their_hexadecimal_keys(spark, tmp_path):
    df = spark.range(20_000, numPartitions=1).select(F.md5(F.col("id").cast("string")).alias("sk"))
    write_silver(df, str(tmp_path / "silver"))
    VersionedTable(spark, str(tmp_path / "version")).write(df)
    KeyedTable(spark, str(tmp_path / "keyed"), ["sk"], buckets=1).upsert(df, "1")
    for name, more in (("silver", 0), ("version", 0), ("keyed", 8)):  # a fingerprint has 8 bytes
        size = sum(f.stat().st_size for f in (tmp_path / name).rglob("*.parquet"))
        assert size < 20_000 * (0.6 * 32 + more), name


def test_a_first_run_on_stored_rows_keeps_one_row_of_a_key(spark, tmp_path):
    data = [(i, f"c{i}", None, i, T1) for i in range(50)]
    again = [(7, "newer", None, 1, T2), (None, "n", None, 3, T1), (None, "m", None, 3, T2)]
    for name, more in (("unique", []), ("repeated", again)):
        df = spark.createDataFrame(data + more, COLUMNS)
        wide = KeyedTable(spark, str(tmp_path / f"{name}1"), ["id"]).upsert(
            df, "1", [F.desc("loaded_at")])
        table = KeyedTable(spark, str(tmp_path / f"{name}2"), ["id"])
        out = table.upsert(df, "1", [F.desc("loaded_at")], reread=True)
        assert rows(out) == rows(wide) and out.count() == 50 + bool(more)
        assert not table.folder.has("runs/1")
    # Rows without repeated keys are not ordered by key at all.
    marked = KeyedTable(spark, str(tmp_path / "t"), ["id"])._without_repeats(
        spark.createDataFrame(data, COLUMNS), [], "runs/1")
    assert "Exchange" not in marked._jdf.queryExecution().executedPlan().toString()


def test_keys_pass_a_shuffle_as_bytes(spark, tmp_path):
    sk = "0123456789abcdef" * 2
    texts = [sk, sk.upper(), sk[:31], sk[:31] + "g", "", None, "\x01" + sk, "é" * 32, "f" * 32]
    df = spark.createDataFrame(
        [(str(i), x, x, x, i) for i, x in enumerate(texts)],
        "id string, sk_a string, b_key string, other string, n int")
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], buckets=4)
    for reread in (False, True):
        table = KeyedTable(spark, str(tmp_path / f"t{reread}"), ["id"], buckets=4)
        out = table.upsert(df, "1", reread=reread)
        assert out.schema == df.schema and rows(out) == rows(df)
        stored = table._stored()
        assert stored.where(F.col("_fingerprint") == fingerprint(df)).count() == len(texts)
        later = df.where("n < 5").withColumn("n", F.when(F.col("n") == 0, 9).otherwise(F.col("n")))
        assert rows(table.upsert(later, "2")) == rows(df.withColumn(
            "n", F.when(F.col("n") == 0, 9).otherwise(F.col("n"))))
    wide = table._dealt(table._marked(df), False)._jdf.queryExecution().optimizedPlan().toString()
    below = wide[wide.index("Rebalance"):]
    assert "xxhash64(b_key" not in below and "unhex(sk_a" in below
