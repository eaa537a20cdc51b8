"""Match-specific derivations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that decide the class of an event description. Cards are tested first.
CARD_WORDS = ("yellow card", "second yellow", "red card")
GOAL_WORDS = (
    "goal", "scored", "missed", "shot", "header", "penalty", "free kick", "tap-in", "own-goal",
)


def known(predicate: Column) -> Column:
    """Predicate with 'unknown' counted as false."""
    return F.coalesce(predicate, F.lit(False))


def match_measures(home: Column, away: Column) -> dict[str, Column]:
    """Totals and outcome flags of one match; a missing score makes every flag false."""
    return {
        "total_goals": home + away,
        "goal_difference": home - away,
        "home_win": known(home > away),
        "away_win": known(home < away),
        "is_draw": known(home == away),
    }


def result_flags(own: Column, opponent: Column) -> dict[str, Column]:
    """1/0 outcome flags from one club's side; NULL when a score is missing."""
    return {
        "is_draw": (own == opponent).cast("int"),
        "is_loss": (own < opponent).cast("int"),
        "is_win": (own > opponent).cast("int"),
    }


def result_label(win: Column, draw: Column) -> Column:
    return F.when(win, "WIN").when(draw, "DRAW").otherwise("LOSS")


def fee_type(fee: Column) -> Column:
    return F.when(fee.isNull() | (fee == 0), "FREE_OR_UNKNOWN").otherwise("PAID")


def penalty_result(description: Column) -> Column:
    return F.when(description.contains("Scored"), "scored").when(
        description.contains("Missed"), "missed"
    )


def season_counter(description: Column) -> Column:
    """Leading counter of a description: '3. Goal, Header' -> 3."""
    return F.regexp_extract(description, r"^(\d+)\.", 1).try_cast("int")


def classify_event(description: Column) -> Column:
    """Event class for feeds whose events carry only a description."""
    text = F.lower(F.coalesce(description, F.lit("")))
    return (
        F.when(text.rlike("|".join(CARD_WORDS)), "cards")
        .when(text.rlike("|".join(GOAL_WORDS)), "goals")
        .otherwise("substitutions")
    )


def card_colour(description: Column) -> Column:
    text = F.lower(description)
    return F.when(text.contains("red") | text.contains("second yellow"), "red").otherwise("yellow")


def event_side(club_id: Column, away_club_id: Column) -> Column:
    return F.when(club_id == away_club_id, "away").otherwise("home")


def match_end(last_minute: Column) -> dict[str, Column]:
    """Length and label of a match from the minute of its last event."""
    return {
        "end_minute": F.when(last_minute <= 90, 90).otherwise(120),
        "end_label": F.when(last_minute <= 90, "FULL TIME").otherwise("EXTRA TIME"),
    }


def match_phase(minute: Column) -> Column:
    return (
        F.when(minute <= 45, "FIRST HALF")
        .when(minute <= 90, "SECOND HALF")
        .when(minute <= 105, "EXTRA TIME 1ST")
        .otherwise("EXTRA TIME 2ND")
    )


def slug(c: Column) -> Column:
    """Lower case with runs of white space as one hyphen."""
    return F.regexp_replace(F.lower(c), r"\s+", "-")
