import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchlake.operators import joins, limits, windows
from pitchlake.operators.aggregates import constant_cols, iqr_outliers, summary
from pitchlake.operators.scale import (
    exact_quantiles, first_rows, row_numbers, running, with_totals,
)
from conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, another third without a key."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(40)}"
        data.append((i, key, rng.randrange(50), rng.choice([0, 1, None])))
    return data, spark.createDataFrame(data, "id int, k string, at int, hit int").repartition(6)


def brute_running(data):
    out = {}
    for key in {d[1] for d in data}:
        total, seen = None, 0
        for row in sorted((d for d in data if d[1] == key), key=lambda d: (d[2], d[0])):
            seen += 1
            if row[3] is not None:
                total = (total or 0) + row[3]
            out[row[0]] = (seen, total)
    return out


@pytest.mark.parametrize("chunk_rows", [1, 7, 50, 200_000])
def test_running_sums_equal_brute_force(skewed, chunk_rows):
    data, df = skewed
    out = running(df, ["k"], ["at", "id"], {"n": F.lit(1), "total": F.col("hit")}, chunk_rows)
    got = {r["id"]: (r["n"], r["total"]) for r in out.collect()}
    assert got == brute_running(data)


@pytest.mark.parametrize("chunk_rows", [1, 20, 200_000])
@pytest.mark.parametrize("down", ["desc", "desc_nulls_first", "asc_nulls_last"])
def test_order_of_nulls(spark, chunk_rows, down):
    data = [(i, None if i % 4 == 0 else i % 13, None if i % 3 == 0 else float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(data, "id int, a int, b double").repartition(4).withColumn(
        "k", F.lit("one"))
    order = [getattr(F, down)("a"), F.col("b"), F.desc("id")]
    want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(
        Window.partitionBy("k").orderBy(*order))).collect()}
    assert {r.id: r.rn for r in row_numbers(df, ["k"], order, "rn", chunk_rows).collect()} == want


def test_one_full_shuffle_and_no_job_while_planning(spark, skewed):
    _, df = skewed
    spark.range(1).count()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    out = row_numbers(df, ["k"], ["at", "id"])
    plan = plan_of(out)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs
    # The rows, and the sums of chunks; the other exchanges hold bounds and chunks only.
    assert len(re.findall(r"hashpartitioning\(k#\d+, _chunk#", plan)) == 2
    assert "BroadcastHashJoin" in plan and "RangePartitioning" not in plan
    with pytest.raises(ValueError):
        running(df, ["k"], [F.col("at") + 1], {"n": F.lit(1)})


@pytest.mark.parametrize("chunk_rows", [9, 200_000])
def test_descending_rank(skewed, chunk_rows):
    data, df = skewed
    out = row_numbers(df, ["k"], [F.desc("at"), F.desc("id")], "rn", chunk_rows)
    got = {r["id"]: r["rn"] for r in out.collect()}
    for key in {d[1] for d in data}:
        ordered = sorted((d for d in data if d[1] == key), key=lambda d: (-d[2], -d[0]))
        assert [got[d[0]] for d in ordered] == list(range(1, len(ordered) + 1))


def test_one_large_group_is_dealt_to_several_tasks(spark):
    df = spark.range(0, 400_000, 1, 8).select(F.lit("hot").alias("k"), "id")
    out = row_numbers(df, ["k"], ["id"])
    assert out.select(F.spark_partition_id()).distinct().count() > 1
    assert out.filter(F.col("rn") != F.col("id") + 1).count() == 0


def test_totals_keep_every_row_and_count_null_as_a_group(skewed):
    data, df = skewed
    out = with_totals(
        df,
        [(["k"], {"n": F.count(F.lit(1))}), (["at"], {"most": F.max("id")})],
    )
    got = {r["id"]: (r["n"], r["most"]) for r in out.collect()}
    assert len(got) == len(data)
    for d in data:
        assert got[d[0]] == (
            sum(x[1] == d[1] for x in data), max(x[0] for x in data if x[2] == d[2]))


def test_totals_plan_can_split_a_skewed_partition(spark, skewed):
    """The detail side has its own exchange right below the join's sort."""
    _, df = skewed
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = with_totals(df, [(["k"], {"n": F.count(F.lit(1))})])
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("hashpartitioning(_d0") == 1
    assert text.count("hashpartitioning(_h0") == 1


def test_first_rows_are_limited_before_the_shuffle(skewed):
    data, df = skewed
    out = first_rows(df, ["k"], ["at", "id"])
    want = {k: min((d[2], d[0]) for d in data if d[1] == k)[1] for k in {d[1] for d in data}}
    assert {r["k"]: r["id"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_exact_quantiles_equal_numpy(spark):
    rng = random.Random(3)
    data = [(float(rng.randrange(200)), rng.random() * 10 if i % 7 else None) for i in range(501)]
    df = spark.createDataFrame(data, "a double, b double").repartition(5)
    got = {
        (r["column"], r["probability"]): r["value"]
        for r in exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.9]).collect()
    }
    for i, c in enumerate("ab"):
        known = [d[i] for d in data if d[i] is not None]
        for p in (0.25, 0.5, 0.9):
            assert got[(c, p)] == pytest.approx(np.quantile(known, p))


def test_summary_modes(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 102)], "v double")
    exact = summary(df, ["v"], quartiles="exact").first()
    assert (exact["count"], exact["p25"], exact["p50"], exact["p75"]) == (101, 26.0, 51.0, 76.0)
    approx = summary(df, ["v"]).first()
    assert abs(approx["p50"] - 51) <= 1
    assert "p50" not in summary(df, ["v"], quartiles="none").columns


def test_outliers(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,)], "v double")
    r = iqr_outliers(df, ["v"]).first()
    assert (r["outliers"], r["outlier_pct"]) == (1, 4.76)


def test_constant_columns_count_null_as_a_value(spark):
    df = spark.createDataFrame([(1, 1, None), (1, None, None)], "a int, b int, c int")
    assert sorted(r[0] for r in constant_cols(df).collect()) == ["a", "c"]


def test_running_counts(skewed):
    data, df = skewed
    out = windows.running_totals(df, ["k"], ["at", "id"], {"hits": F.col("hit") == 1})
    top = {r["k"]: r["m"] for r in out.groupBy("k").agg(F.max("hits").alias("m")).collect()}
    assert top == {k: sum(d[3] == 1 for d in data if d[1] == k) for k in top}


def test_sampled_keys_do_not_depend_on_row_order(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(500)], "g int")
    a = rows(limits.sample_keys(df, "g", 20))
    b = rows(limits.sample_keys(df.orderBy(F.desc("g")).repartition(3), "g", 20))
    assert a == b and len(a) == 20
    assert rows(limits.sample_keys(df, "g", 20, seed=1)) != a


def test_unmatched_rows_get_a_null_key(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, club int")
    dim = spark.createDataFrame([(10,), (11,)], "club_id int")
    out = joins.with_keys(fact, [joins.KeyLookup(dim, "club_id", "club", "sk")])
    assert {r["id"]: r["sk"] is None for r in out.collect()} == {1: False, 2: True, 3: True}


def test_null_keys_match_only_when_asked(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 8), ("a", 9)], "k string, w int")
    assert rows(joins.enrich(left, (right, ["k"]))) == [(None, 1, None), ("a", 2, 9)]
    assert rows(joins.enrich(left, (right, ["k"]), null_matches_null=True)) == [
        (None, 1, 8), ("a", 2, 9)]


def test_merge_of_two_key_sets(spark):
    a = spark.createDataFrame([(1, "A", 5), (2, None, 6)], "id int, name string, size int")
    b = spark.createDataFrame([(2, "B"), (3, "C")], "id int, name string")
    out = joins.extend_dimension(a, b, "id", ["name"], ["name"])
    assert rows(out) == [(1, "A", 5), (2, "B", 6), (3, "C", None)]


def test_orphans_ignore_null(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "c int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(joins.orphans(child, "c", parent, "p")) == [(5, 2)]


def test_aqe_splits_the_hot_group(spark):
    """A third of the rows share one key; the join of the totals handles it in several tasks."""
    df = spark.range(0, 300_000, 1, 8).selectExpr(
        "id", "case when id % 3 = 0 then -1 else id % 5000 end as k", "repeat('x', 100) as pad")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = with_totals(df, [(["k"], {"n": F.count(F.lit(1))})])
        assert out.agg(F.sum("n"), F.count("pad")).first()[1] == 300_000
        # The executed plan belongs to the frame that ran, so run the join itself once more.
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    """Staging on stored tables: the key gate and the used columns go into the Parquet scan."""
    from pitchlake.operators.clean import clean
    from pitchlake.plans import dimensions, facts, marts, staging  # noqa: F401
    from pitchlake.plans.specs import SPECS
    from pitchlake.plans.warehouse import Warehouse

    for name, spec in SPECS.items():
        raw = spark.createDataFrame([], spec.raw_schema)
        clean(raw, spec).write.parquet(str(tmp_path / name))
    stored = {n: spark.read.parquet(str(tmp_path / n)) for n in SPECS}
    wh = Warehouse(spark, stored)
    scan = plan_of(wh.ref("stg_appearances").select("player_id", "goals"))
    assert "IsNotNull(appearance_id)" in scan and "IsNotNull(player_id)" in scan
    assert "ReadSchema: struct<appearance_id:string,game_id:int,player_id:int,goals:int>" in scan
    # Small stored dimensions are broadcast: the fact is not shuffled to find its keys.
    fact = plan_of(wh.ref("fact_matches"))
    assert fact.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in fact
    # The mart adds up ids before it joins names.
    mart = plan_of(wh.ref("mart_club_match_stats"))
    assert mart.index("club_name") < mart.index("HashAggregate(keys=[club_id")


def test_joins_within_a_match_shuffle_the_events_once(spark):
    events = spark.createDataFrame(
        [("a", "1", "x", 1), ("a", "2", "y", 2), ("b", "1", None, 3), (None, "1", "x", 4),
         (None, "1", "x", 5), ("c", None, "x", 6)], "game string, player string, club string, n int")
    lineups = spark.createDataFrame(
        [("a", "1", "L1"), ("a", "1", "L2"), ("b", "2", "L3"), (None, "1", "L4"), ("c", None, "L5"),
         ("b", "1", "L6")], "game string, player string, line string")
    results = spark.createDataFrame(
        [("a", "x", 7), ("a", "y", 8), ("b", None, 9), (None, "x", 10)],
        "game string, club string, goals int")
    games = spark.createDataFrame([("a", "r1"), ("b", "r2"), (None, "r3")], "game string, round string")
    sides = [(lineups, ["game", "player"]), (results, ["game", "club"]), (games, ["game"])]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.enrich_within(events, "game", *sides)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4  # one for each table
        assert rows(out) == rows(joins.enrich(events, *sides))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_enriched_events_are_shuffled_by_the_match_once(spark, sf_dir):
    from checks import catalog  # noqa: F401 - registers the queries
    from checks.registry import ENTRIES, run_entry

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = run_entry(ENTRIES["q_enrich"], spark, sf_dir)._jdf.queryExecution().executedPlan()
        # Players, clubs, competitions: both sides. The match: four tables. Regions of nations: two.
        assert plan.toString().count("Exchange hashpartitioning") == 12
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
