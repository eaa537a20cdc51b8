import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from pitchlake.functions import calendar, casting, football, rules
from pitchlake.functions.keys import surrogate_key


def values(spark, ddl, data, column):
    return [r[0] for r in spark.createDataFrame(data, ddl).coalesce(1).select(column).collect()]


def text(spark, items, column):
    return values(spark, "c string", [(i,) for i in items], column)


def C():  # noqa: N802
    return F.col("c")


@pytest.mark.parametrize(
    "raw, euros",
    [
        ("+€5.90m", 5_900_000), ("€-72.30m", -72_300_000), ("+€900k", 900_000),
        ("€-131k", -131_000), ("+-0", 0), (None, None), ("", None), ("€16.06m", 16_060_000),
        ("-€2m", -2_000_000), ("€1.2bn", 1_200_000_000), ("n/a", None),
    ],
)
def test_money(spark, raw, euros):
    assert text(spark, [raw], casting.parse_money(C())) == [euros]


def test_safe_casts_never_raise(spark):
    items = ["7", " 7 ", "", "x", "12.0", None, "99999999999"]
    assert text(spark, items, casting.safe_int(C())) == [7, 7, None, None, None, None, None]
    assert text(spark, items, casting.safe_int(C(), via_double=True))[4] == 12
    assert text(spark, items, casting.safe_long(C()))[6] == 99999999999
    assert text(spark, ["1000.7", "-3.9", "x"], casting.safe_long(C(), True)) == [1000, -3, None]
    assert text(spark, ["2024-02-30", "2024-02-29", "", None], casting.safe_date(C())) == [
        None, dt.date(2024, 2, 29), None, None]


def test_regex_int_and_flag(spark):
    items = ["3. Goal, Header", "Goal", None]
    assert text(spark, items, casting.regex_int(C(), r"^(\d+)\.")) == [3, None, None]
    assert values(spark, "a int, b int", [(1, 0), (0, 1), (None, 1)],
                  casting.flag01(F.col("a") > F.col("b"))) == [1, 0, None]


def test_null_rules(spark):
    assert text(spark, ["-1", "2", None], rules.null_if(C(), "-1")) == [None, "2", None]
    heights = [(139,), (140,), (220,), (221,), (None,)]
    assert values(spark, "c int", heights, rules.null_unless(C(), 140, 220)) == [
        None, 140, 220, None, None]
    assert text(spark, ["MIDFIELD", "Attack", "Sweeper"], rules.remap(
        C(), {"midfield": "Central Midfield", "attack": "Forward"}, ignore_case=True)) == [
        "Central Midfield", "Forward", "Sweeper"]
    assert text(spark, ["", None, "24/25"], rules.blank_to(C(), "Unknown")) == [
        "Unknown", "Unknown", "24/25"]
    assert text(spark, [" ", "", None, "a"], rules.is_blank(C())) == [True, True, True, False]


def test_ratio_rounds_half_away_from_zero_as_written(spark):
    data = [(1, 40), (1, 8), (201, 200), (0, 5), (1, 0), (None, 3)]
    ratio = rules.ratio(F.col("a"), F.col("b"))
    assert values(spark, "a long, b long", data, ratio) == [0.03, 0.13, 1.01, 0.0, None, None]
    assert values(spark, "a long, b long", [(2, 3)], rules.ratio(F.col("a"), F.col("b"), 100, 1)) == [66.7]


def test_surrogate_key_matches_the_published_recipe(spark):
    got = values(spark, "a int, b string", [(7, None)], surrogate_key("a", "b"))
    assert got == [hashlib.md5(b"7-_dbt_utils_surrogate_key_null_").hexdigest()]


def test_seasons_and_ages(spark):
    days = [(dt.date(2024, 6, 30),), (dt.date(2024, 7, 1),), (dt.date(1999, 12, 1),), (None,)]
    assert values(spark, "c date", days, calendar.season_of(C())) == [
        "2023/24", "2024/25", "1999/00", None]
    born = [(dt.date(2000, 2, 29),), (dt.date(2000, 3, 1),), (None,)]
    assert values(spark, "c date", born, calendar.age(C(), dt.date(2024, 2, 29))) == [24, 23, None]
    sunday = calendar.date_parts(C())
    assert values(spark, "c date", [(dt.date(2023, 1, 1),)], F.struct(
        sunday["day_of_week"], sunday["day_name"], sunday["week_of_year"]))[0] == (0, "Sun", 52)


def test_missing_score_is_a_loss_for_both(spark):
    m = football.match_measures(F.col("h"), F.col("a"))
    out = values(spark, "h int, a int", [(None, 1), (2, 2), (3, 1)], F.struct(
        m["home_win"], m["away_win"], m["is_draw"], m["total_goals"],
        football.result_label(m["home_win"], m["is_draw"]).alias("r")))
    assert [tuple(r) for r in out] == [
        (False, False, False, None, "LOSS"), (False, False, True, 4, "DRAW"),
        (True, False, False, 4, "WIN")]


def test_fee_type(spark):
    fees = [(None,), (0,), (10,)]
    assert values(spark, "c long", fees, football.fee_type(C())) == [
        "FREE_OR_UNKNOWN", "FREE_OR_UNKNOWN", "PAID"]


def test_event_classes(spark):
    items = [None, " ", "Yellow card, foul", "Red card after goal", "Penalty missed", "Tactical",
             "TAP-IN"]
    assert text(spark, items, football.classify_event(C())) == [
        "substitutions", "substitutions", "cards", "cards", "goals", "substitutions", "goals"]
    cards = ["Second yellow", "Yellow card", "x" * 60 + "red"]
    assert text(spark, cards, football.card_colour(C())) == ["red", "yellow", "red"]
    assert text(spark, ["Scored", "Missed it", "scored", None], football.penalty_result(C())) == [
        "scored", "missed", None, None]


def test_match_phase(spark):
    minutes = [(45,), (46,), (90,), (91,), (106,)]
    assert values(spark, "c int", minutes, football.match_phase(C())) == [
        "FIRST HALF", "SECOND HALF", "SECOND HALF", "EXTRA TIME 1ST", "EXTRA TIME 2ND"]
    ends = [(90,), (91,), (125,)]
    assert values(spark, "c int", ends, football.match_end(C())["end_minute"]) == [90, 120, 120]


def test_slug_and_side(spark):
    assert text(spark, ["Bosnia  and Herzegovina"], football.slug(C())) == ["bosnia-and-herzegovina"]
    assert values(spark, "c int, away int", [(1, 1), (2, 1), (None, 1)],
                  football.event_side(C(), F.col("away"))) == ["away", "home", "home"]
