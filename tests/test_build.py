"""Building models by their dependencies."""

import time

import pytest
from pyspark.sql import functions as F

from checks.registry import Context, SilverTables
from pitchlake.plans import build
from pitchlake.plans.build import ModelStore, dependencies
from pitchlake.plans.warehouse import MODELS, Warehouse
from pitchlake.session import shuffles_removed


def test_the_graph_of_all_models(spark, sf_dir):
    graph = dependencies(Context(spark, sf_dir).warehouse)
    assert set(graph.models) == set(MODELS) and not graph.broken
    assert graph.models["fact_matches"] == {"stg_games", "dim_club", "dim_competitions", "dim_date"}
    assert graph.sources["dim_player"] == {"player_valuations"}
    at = {name: n for n, level in enumerate(graph.levels()) for name in level}
    assert all(at[p] < at[m] for m, parents in graph.models.items() for p in parents)
    assert at["stg_games"] == 0 and at["mart_club_match_stats"] == max(at.values())
    assert "stg_games" in graph.ancestors("mart_club_match_stats")


@pytest.fixture
def small(spark, tmp_path, monkeypatch):
    """a -> stg_b -> c -> d, and e beside them, over two stored sources."""
    models = {
        "a": lambda wh: wh.source("x").withColumn("n", F.col("id") + 1),
        "stg_b": lambda wh: wh.ref("a").where("n > 0"),
        "c": lambda wh: wh.ref("stg_b").groupBy().agg(F.sum("n").alias("n")),
        "d": lambda wh: wh.ref("c").withColumn("m", F.col("n") * 2),
        "e": lambda wh: wh.source("y").select(F.col("id").cast("string").alias("id")),
    }
    monkeypatch.setattr(build, "MODELS", models)

    def write(name, n):
        path = str(tmp_path / f"{name}-{n}")
        spark.range(n).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return models, write, ModelStore(spark, str(tmp_path / "store"))


def statuses(report):
    return {r.model: (r.status, r.rows) for r in report.collect()}


def test_only_what_is_below_a_change_is_built(spark, small):
    models, write, store = small
    x, y = write("x", 5), write("y", 3)
    wh = Warehouse(spark, {"x": x, "y": y})
    stored, report = store.build(wh)
    assert statuses(report) == {
        "a": ("built", 5), "stg_b": ("view", None), "c": ("built", 1), "d": ("built", 1),
        "e": ("built", 3)}
    assert [tuple(r) for r in stored.ref("d").collect()] == [(15, 30)]
    plan = stored.ref("d")._jdf.queryExecution().toString()
    assert "Aggregate" not in plan  # reads its own files, not its parents
    assert {s for s, _ in statuses(store.build(wh)[1]).values()} == {"unchanged", "view"}
    stored, report = store.build(Warehouse(spark, {"x": write("x", 7), "y": y}), names=["d", "e"])
    assert {m for m, (s, _) in statuses(report).items() if s == "built"} == {"a", "c", "d"}
    assert stored.ref("c").first()[0] == 28
    assert store.log().groupBy("run").count().count() == 3


def test_a_failure_skips_its_descendants_only(spark, small):
    models, write, store = small
    wh = Warehouse(spark, {"x": write("x", 5), "y": write("y", 3)})
    good = models["c"]
    models["c"] = lambda wh: wh.ref("stg_b").groupBy().agg(F.sum(F.raise_error(F.lit("bad"))).alias("n"))
    found = statuses(store.build(wh)[1])
    assert found["c"] == ("failed", None) and found["d"] == ("skipped", None)
    assert found["a"] == ("built", 5) and found["e"] == ("built", 3)
    models["c"] = lambda wh: wh.source("missing")  # can't even be planned
    report = store.build(wh)[1]
    assert statuses(report)["c"] == ("failed", None) and statuses(report)["d"] == ("skipped", None)
    assert "missing" in report.where("model = 'c'").first().error
    models["c"] = good
    found = statuses(store.build(wh)[1])
    assert found["c"] == ("built", 1) and found["d"] == ("built", 1)
    assert found["a"] == ("unchanged", 5)


def test_marts_read_stored_parents(spark, sf_dir, tmp_path):
    ctx = Context(spark, sf_dir)
    wh = Warehouse(spark, SilverTables(ctx), run_ts=ctx.warehouse.run_ts)
    store = ModelStore(spark, str(tmp_path / "gold"))
    stored, _ = store.build(wh, ["fact_transfers"])
    plan = MODELS["mart_club_transfer_spending"](stored)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "try_cast" not in plan and "trim(" not in plan


def test_marts_shuffle_ids_and_no_long_keys(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    for name in ("mart_club_transfer_spending", "mart_player_performance"):
        plan = MODELS[name](ctx.warehouse)._jdf.queryExecution().optimizedPlan().toString()
        assert "md5(" not in plan, name


def test_a_build_removes_what_its_queries_shuffled(spark, tmp_path, monkeypatch):
    own = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen, plain, before = [], build.materialize, spark.conf.get(own)

    def materialize(df, name, kind, *args, **options):
        seen.append((name, spark.conf.get(own)))
        return plain(df, name, kind, *args, **options)

    monkeypatch.setattr(build, "materialize", materialize)
    wh = Warehouse(spark, {})
    ModelStore(spark, str(tmp_path / "store")).build(wh, ["dim_date"])
    assert seen and set(seen) == {("dim_date", "true")} and spark.conf.get(own) == before


def test_a_query_leaves_no_shuffle_files(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        names = {found.apply(i).getName() for i in range(found.size())}
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    with shuffles_removed(spark):
        spark.range(1000, numPartitions=4).repartition(4, "id").write.parquet(str(tmp_path / "t"))
    for _ in range(200):  # files are removed in the background
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and spark.read.parquet(str(tmp_path / "t")).count() == 1000
