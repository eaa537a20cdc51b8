import datetime as dt
import re
from collections import Counter

import pytest

from checks.registry import Context
from pitchlake.operators import clean as cl
from pitchlake.operators.scale import split_repeated
from pitchlake.plans.specs import SPECS
from pitchlake.sources import files
from conftest import rows


def raw(spark, table, *partial):
    """Raw rows with the given cells, all other cells NULL."""
    schema = SPECS[table].raw_schema
    data = [tuple(p.get(f.name) for f in schema) for p in partial]
    return spark.createDataFrame(data, schema)


def cleaned(spark, table, *partial, **options):
    return cl.clean(raw(spark, table, *partial), SPECS[table], **options)


def test_appearances_keep_1_to_135_minutes(spark):
    cells = [{"appearance_id": f"1_{i}", "minutes_played": m}
             for i, m in enumerate(["0", "1", "135", "136", None, "x"])]
    out = cleaned(spark, "appearances", *cells)
    assert sorted(r["minutes_played"] for r in out.collect()) == [1, 135]
    assert {r["player_name"] for r in out.collect()} == {"Unknown"}


def test_blank_is_not_null_unless_asked(spark):
    cell = {"appearance_id": "1_1", "minutes_played": "90", "player_name": "   "}
    assert cleaned(spark, "appearances", cell).first()["player_name"] == ""
    assert cleaned(spark, "appearances", cell, blank_as_null=True).first()["player_name"] == "Unknown"


def test_lineups(spark):
    cells = [
        {"game_lineups_id": "a", "number": "880", "position": "Goalkeeper"},
        {"game_lineups_id": "b", "number": None, "position": " MIDFIELD "},
        {"game_lineups_id": "c", "number": "99", "position": "Attack"},
        {"game_lineups_id": "d", "number": "5", "position": "  "},
        {"game_lineups_id": "e", "number": "5", "position": None},
    ]
    out = cleaned(spark, "game_lineups", *cells).select("game_lineups_id", "position", "number")
    assert rows(out) == [("b", "Central Midfield", None), ("c", "Forward", 99)]


def test_competition_sentinel_and_defaults(spark):
    out = cleaned(spark, "competitions", {"competition_id": "CL", "country_id": "-1"}).first()
    assert (out["country_id"], out["country_name"], out["domestic_league_code"]) == (
        None, "International", "N/A")


def test_club_ranges_and_money(spark):
    out = cleaned(spark, "clubs", {
        "club_id": "3", "squad_size": "0", "stadium_seats": "-5", "net_transfer_record": " €-72.30m "
    }).first()
    assert (out["squad_size"], out["stadium_seats"], out["net_transfer_record_eur"]) == (
        None, None, -72_300_000)
    assert out.__fields__ == SPECS["clubs"].silver_columns


def test_club_games_flags_come_from_goals(spark):
    out = cleaned(spark, "club_games",
                  {"game_id": "1", "club_id": "1", "own_goals": "1", "opponent_goals": "1", "is_win": "1"},
                  {"game_id": "1", "club_id": "2", "own_goals": None, "opponent_goals": "1", "is_win": "1"})
    assert rows(out.select("club_id", "is_win", "is_draw", "is_loss")) == [
        (1, 0, 1, 0), (2, None, None, None)]


def test_valuations_of_zero_become_null(spark):
    out = cleaned(spark, "player_valuations", {"player_id": "1", "market_value_in_eur": "0"}).first()
    assert (out["market_value_in_eur"], out["player_club_domestic_competition_id"]) == (None, "Unknown")


def test_players(spark):
    out = cleaned(
        spark, "players",
        {"player_id": 1, "position": "Missing", "height_in_cm": 139, "last_season": 2024,
         "date_of_birth": dt.datetime(2000, 2, 29), "international_caps": None},
        {"player_id": 2, "position": "Attack", "height_in_cm": 220, "last_season": 2023,
         "date_of_birth": None, "international_caps": 3},
        {"player_id": 3, "position": None, "height_in_cm": 221, "last_season": None},
        as_of=dt.date(2024, 2, 29),
    )
    got = rows(out.select("player_id", "position", "height_in_cm", "age", "is_active",
                          "is_international", "current_club_name"))
    assert got == [
        (1, "Unknown", None, 24, True, False, "Unknown Club"),
        (2, "Attack", 220, None, False, True, "Unknown Club"),
        (3, None, None, None, None, False, "Unknown Club"),
    ]


def test_transfer_defaults(spark):
    out = cleaned(spark, "transfers", {"player_id": "1", "transfer_fee": "1000.7", "transfer_season": " "},
                  {"player_id": "2", "transfer_fee": "loan"})
    assert rows(out.select("player_id", "transfer_fee", "transfer_season", "market_value_in_eur",
                           "player_name")) == [
        (1, 1000, "Unknown", None, "Unknown Player"), (2, 0, "Unknown", None, "Unknown Player")]


def test_event_type_is_lower_case_and_minute_unchecked(spark):
    out = cleaned(spark, "game_events", {"game_event_id": "e", "type": " Goals ", "minute": "300"})
    assert rows(out.select("type", "minute", "description")) == [("goals", 300, "Unknown")]


def test_dedup_with_order_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (None, "y")], "k int, v string")
    assert rows(cl.dedup(df, ["k"], ["v"])) == [(None, "y"), (1, "a")]
    assert cl.dedup(df, ["k"]).count() == 2


@pytest.mark.parametrize("slots", [1, 64, 1 << 22])
def test_dedup_of_rarely_repeated_keys(spark, slots, monkeypatch):
    monkeypatch.setattr(cl, "split_repeated", lambda df, keys: split_repeated(df, keys, slots))
    data = [(i % 90 if i % 7 else None, "ab"[i % 2] if i % 5 else None, i) for i in range(130)]
    df = spark.createDataFrame(data, "a int, b string, v int").repartition(5)
    for keys in (["a", "b"], ["v"], ["b"]):
        want = rows(cl.dedup(df, keys, ["a", "b", "v"]))
        assert rows(cl.dedup(df, keys, ["a", "b", "v"], rarely_repeated=True)) == want
        assert cl.dedup(df, keys, rarely_repeated=True).count() == len(want)
    once, others = split_repeated(df, ["a", "b"], slots)
    assert rows(once.unionByName(others)) == rows(df)
    alone = {k for k, n in Counter((a, b) for a, b, _ in data).items() if n == 1}
    assert {(r.a, r.b) for r in once.collect()} <= alone
    if slots > 64:
        assert once.count() == len(alone)


def test_transfers_are_not_shuffled_whole(spark, sf_dir):
    silver = Context(spark, sf_dir).silver("transfers")
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+?)#", silver._jdf.queryExecution()
                           .executedPlan().toString())
    assert exchanges.count("player_id") == 1 and {"_h", "_slot"} < set(exchanges)
    single = silver._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
    assert "LeftAnti" in single and "Window" not in single


@pytest.mark.parametrize("table", sorted(SPECS))
def test_every_spec_runs_on_an_empty_table(spark, table):
    out = cleaned(spark, table)
    assert out.count() == 0
    assert out.columns[: len(SPECS[table].silver_columns)] == SPECS[table].silver_columns


def test_literals_with_quotes(spark):
    spec = cl.TableSpec("t", (cl.Col("k"), cl.Col("v", fill="don't \\ know")), key=("k",))
    out = cl.clean(spark.createDataFrame([("1", None)], "k string, v string"), spec)
    assert rows(out) == [("1", "don't \\ know")]


def test_header_must_match(spark, tmp_path):
    path = str(tmp_path / "countries.csv")
    names = SPECS["countries"].raw_schema.names
    with open(path, "w") as f:
        f.write(",".join(reversed(names)) + "\n" + ",".join("12345678") + "\n")
    with pytest.raises(Exception, match="header"):
        files.read_raw(spark, str(tmp_path), SPECS["countries"]).collect()
    loose = files.read_raw(spark, str(tmp_path), SPECS["countries"], check_header=False)
    assert loose.first()["country_id"] == "1"
