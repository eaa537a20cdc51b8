"""Value tables, reports and sketches."""

from pyspark.sql import functions as F

from pitchlake.operators import sketches
from pitchlake.operators.aggregates import distinct_counts, value_table
from pitchlake.operators.profile import ProfileSpec, dq_report, key_counts
from conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_have_two_exchanges(spark):
    df = spark.range(1000).select(*[(F.col("id") % n).alias(f"c{n}") for n in range(1, 15)])
    out = distinct_counts(df)
    plan = plan_of(out)
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert {r["column"]: r["distinct"] for r in out.collect()} == {f"c{n}": n for n in range(1, 15)}


def test_values_of_odd_columns(spark):
    df = spark.createDataFrame([(0.0, None), (-0.0, None), (float("nan"), None), (None, None)],
                               "`a b` double, empty string")
    assert rows(value_table(df, df.columns)) == [
        ("a b", None, 1), ("a b", "0.0", 2), ("a b", "NaN", 1), ("empty", None, 4)]
    assert rows(distinct_counts(df)) == [("a b", 2), ("empty", 0)]
    assert rows(distinct_counts(df.limit(0))) == [("a b", 0), ("empty", 0)]


def test_repeated_keys_of_one_and_two_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, "y"), (None, "y")], "a int, b string")
    for key, repeated in ((("a",), 2), (("a", "b"), 2), (("b",), 2)):
        found = key_counts(df, ProfileSpec("t", key)).where("metric = 'repeated_keys'")
        assert rows(found) == [("repeated_keys", ",".join(key), repeated)]


def test_report_of_an_empty_and_a_constant_table(spark):
    one = spark.createDataFrame([(1.0, None)] * 3, "a double, b int")
    found = {(r.section, r.subject): r.value for r in dq_report(one, ("a",)).collect()}
    assert found[("rows", "*")] == 3 and found[("columns", "*")] == 2
    assert found[("constant", "a")] == found[("constant", "b")] == 1
    assert found[("mostly_missing", "b")] == 100 and found[("duplicates", "*")] == 2
    assert found[("summary_p50", "a")] == 1 and found[("outliers", "a")] == 0
    empty = {(r.section, r.subject): r.value for r in dq_report(one.limit(0), ("a",)).collect()}
    assert empty[("rows", "*")] == 0 and ("constant", "a") not in empty


def test_merged_sketches_equal_those_of_the_union(spark):
    df = spark.range(5000).select(
        (F.col("id") % 700).alias("k"), (F.col("id") * 1.5).alias("v"),
        F.lit(None).cast("double").alias("nothing"), F.lit("x").alias("word"))
    columns, numeric = df.columns, ["v", "nothing"]
    parts = [sketches.sketch_columns(df.where(F.col("k") % 4 == n), columns, numeric) for n in range(4)]
    stored = parts[0]
    for p in parts[1:]:
        stored = stored.union(p)
    found = {r["column"]: r for r in sketches.estimates(sketches.merge_sketches(stored)).collect()}
    assert found["k"]["rows"] == 5000 and abs(found["k"]["distinct"] - 700) <= 700 * sketches.DISTINCT_ERROR
    assert abs(found["v"]["quantiles"][1] / 7500 - 0.5) <= sketches.RANK_ERROR
    assert (found["v"]["low"], found["v"]["high"]) == (0.0, 7498.5)
    assert found["nothing"]["known"] == 0 and found["nothing"]["quantiles"] is None
    assert found["word"]["distinct"] == 1 and found["word"]["quantiles"] is None


def test_keys_of_several_columns_are_not_written_as_text(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (None, "y")], "a int, b string")
    out = key_counts(df, ProfileSpec("t", ("a", "b")))
    assert "to_json" not in plan_of(out)
    assert rows(out) == [("distinct", "a", 1), ("distinct", "b", 2), ("repeated_keys", "a,b", 2)]
