"""Loads that keep good rows and report bad cells."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.sources import files
from conftest import rows

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType()),
    T.StructField("value", T.DoubleType()), T.StructField("note", T.StringType()),
])


def test_bad_cells_are_named_and_their_rows_left_out(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-05", "2.5", "x", 0), ("two", "2024-01-05", "1", "y", 0), (None, None, None, None, 0),
         ("4", "31.12.2023", "many", "z", 0)], "ID string, Day string, value string, note string, extra int")
    checked = files.load_checked(df, SCHEMA)
    assert rows(files.rejected_cells(checked, "t")) == [
        ("t", "day", "date", "31.12.2023"), ("t", "id", "int", "two"), ("t", "value", "double", "many")]
    assert [(r.id, r.value, r.note) for r in files.load_raw(df, SCHEMA).orderBy("id").collect()] == [
        (None, None, None), (1, 2.5, "x")]
    assert files.load_raw(df, SCHEMA).columns == SCHEMA.names
    empty = files.load_checked(spark.range(3), SCHEMA)
    assert empty.where(F.size(files.REASONS) > 0).count() == 0 and empty.count() == 3


def test_csv_lines_of_the_wrong_length(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "id,day,value,note\n1,2024-01-05,2.5,a\n2,2024-01-06\n3,2024-01-07,1,b,c\nx,2024-01-08,1,d\n,,,\n")
    checked = files.read_csv_checked(spark, str(tmp_path / "in.csv"), SCHEMA)
    found = {r.text: (r.column, r.type) for r in files.rejected_cells(checked, "t").collect()}
    assert found == {"2,2024-01-06": ("*", "line"), "3,2024-01-07,1,b,c": ("*", "line"), "x": ("id", "int")}
    good = checked.where(F.size(files.REASONS) == 0)
    assert rows(good.select("id", "note")) == [(None, None), (1, "a")]


def test_loads_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = spark.createDataFrame([("1", "a"), ("x", "b")], "id string, note string")
    for _ in range(2):
        report = files.append_load(files.load_checked(first, SCHEMA), path, "t", "one")
        assert rows(report) == [("t", "one", 1, 1)]
    second = spark.createDataFrame([("2", "c")], "id string, note string")
    assert rows(files.append_load(files.load_checked(second, SCHEMA), path, "t", "two")) == [
        ("t", "two", 1, 0)]
    assert rows(files.loaded_rows(spark, path).select("id", "note", "run")) == [
        (1, "a", "one"), (2, "c", "two")]
    bad = spark.read.parquet(f"{path}/rejected").select("note", F.col("_rejected")[0]["text"], "run")
    assert rows(bad) == [("b", "x", "one")]
