"""Registered queries against their SQL on the smallest test tables.

Every name runs when ``ALL_QUERIES`` is set; otherwise one query per area, and all others whose
plan can be built without running anything are planned.
"""

import os

import pytest

from checks import catalog
from checks.compare import connect, difference
from checks.registry import ENTRIES, run_entry
from __spark_entry__ import entry, oracle_sql, queries

SAMPLE = (
    "silver_appearances", "silver_clubs", "silver_players", "silver_transfers", "stg_games",
    "dim_player", "dim_club_extended", "fact_appearances", "fact_matches", "fact_transfers",
    "mart_player_performance", "mart_club_match_stats", "mart_club_transfer_spending",
    "mart_match_events_live", "q_enrich", "q_incremental_fact", "q_snapshot_stored",
    "q_quality_fact_matches", "profile_games", "q_iqr_split", "q_running_totals_split",
    "q_latest_split", "q_sources_csv", "q_stream_parse", "q_stream_window", "q_sink_points",
    "q_live_score", "q_net_spend", "q_numeric_summary", "q_warehouse_build", "q_fingerprint_fact",
    "q_history_runs", "q_stream_fact", "q_load_checked", "q_dq_report",
)
#: Queries that write tables or run streams while they are built.
EAGER = (
    "q_stream_", "q_sink_", "q_stored_", "q_sources_", "q_incremental_", "q_run_tables",
    "q_parquet", "q_snapshot", "q_valuation_history", "q_union_stream", "q_touched", "q_failing",
    "q_completeness", "q_point_store", "q_profile_sketches", "q_merge",
)
NAMES = catalog.names() if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, con, sf_dir, name):
    assert difference(spark, con, name, sf_dir) is None


def test_every_other_plan_can_be_built(spark, sf_dir):
    for name in catalog.names():
        if name not in NAMES and not name.startswith(EAGER):
            assert run_entry(ENTRIES[name], spark, sf_dir).columns, name


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries()) >= set(ENTRIES)
    assert entry(spark).count() > 0
