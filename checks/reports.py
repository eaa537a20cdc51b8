"""Report queries."""

from __future__ import annotations

from checks.registry import check, with_ctes
from checks.models import rounded
from pitchlake.plans import reports


@check(
    "q_top_scorers", "BI-1",
    with_ctes(
        ["mart_player_performance"],
        """select player_full_name, cast(sum(total_goals) as bigint) as total_goals
           from mart_player_performance group by 1 order by 2 desc, 1 limit 10""",
    ),
)
def _(ctx):
    return reports.top_players(ctx.ref("mart_player_performance"), "total_goals")


@check(
    "q_top_assists", "BI-2",
    with_ctes(
        ["mart_player_performance"],
        """select player_full_name, cast(sum(total_assists) as bigint) as total_assists
           from mart_player_performance group by 1 order by 2 desc, 1 limit 10""",
    ),
)
def _(ctx):
    return reports.top_players(ctx.ref("mart_player_performance"), "total_assists")


@check(
    "q_most_valuable", "BI-3",
    with_ctes(
        ["dim_player"],
        """select player_id, player_full_name, latest_market_value_eur from dim_player
           order by latest_market_value_eur desc nulls last, player_id limit 10""",
    ),
)
def _(ctx):
    return reports.top_values(ctx.ref("dim_player"))


@check(
    "q_nationalities", "BI-4 AGG-7",
    with_ctes(["dim_player"], "select nationality, count(*) as count from dim_player group by 1"),
)
def _(ctx):
    return reports.nationalities(ctx.ref("dim_player"))


@check(
    "q_player_totals", "BI-5",
    with_ctes(
        ["mart_player_performance", "dim_player"],
        """select cast(sum(total_goals) as bigint) as total_goals,
                  cast(sum(total_assists) as bigint) as total_assists,
                  cast(sum(total_yellow_cards) as bigint) as total_yellow_cards,
                  (select count(*) from dim_player) as players,
                  (select cast(sum(latest_market_value_eur) as bigint) from dim_player)
                      as total_market_value_eur
           from mart_player_performance""",
    ),
)
def _(ctx):
    return reports.player_totals(ctx.ref("mart_player_performance"), ctx.ref("dim_player"))


@check(
    "q_club_rates", "BI-6",
    with_ctes(
        ["mart_club_match_stats"],
        f"""select *, {rounded('wins', 'total_matches', 100, 1)} as win_rate_pct,
                   {rounded('losses', 'total_matches', 100, 1)} as loss_rate_pct
            from (select club_name, cast(sum(total_matches) as bigint) as total_matches,
                         cast(sum(wins) as bigint) as wins, cast(sum(draws) as bigint) as draws,
                         cast(sum(losses) as bigint) as losses
                  from mart_club_match_stats group by 1)""",
    ),
)
def _(ctx):
    return reports.club_rates(ctx.ref("mart_club_match_stats"))


@check(
    "q_squad_profile", "BI-7",
    with_ctes(
        ["dim_club"],
        f"""select count(*) as clubs, {rounded('sum(squad_size)', 'count(squad_size)')}
                       as avg_squad_size,
                   min(average_age) as lowest_average_age, max(average_age) as highest_average_age,
                   cast(sum(foreigners_number) as bigint) as foreigners,
                   cast(sum(national_team_players) as bigint) as national_team_players,
                   max(stadium_seats) as largest_stadium
            from dim_club""",
    ),
)
def _(ctx):
    return reports.squad_profile(ctx.ref("dim_club"))


@check(
    "q_top_spenders", "BI-8",
    with_ctes(
        ["fact_transfers", "dim_club"],
        """select to_club_id, cast(sum(transfer_fee_eur) as bigint) as spent_eur, club_name
           from fact_transfers left join dim_club on to_club_id = club_id
           group by to_club_id, club_name order by 2 desc nulls last, 1 nulls first limit 10""",
    ),
)
def _(ctx):
    return reports.top_spenders(ctx.ref("fact_transfers"), ctx.ref("dim_club"))


@check(
    "q_goals_balance", "BI-9",
    with_ctes(
        ["mart_club_match_stats"],
        """select club_name, cast(sum(total_goals_scored) as bigint) as scored,
                  cast(sum(total_goals_conceded) as bigint) as conceded
           from mart_club_match_stats group by 1""",
    ),
)
def _(ctx):
    return reports.goals_balance(ctx.ref("mart_club_match_stats"))


@check(
    "q_transfer_totals", "BI-10",
    with_ctes(
        ["fact_transfers"],
        """select count(*) as transfers, cast(sum(transfer_fee_eur) as bigint) as total_fee_eur,
                  max(transfer_fee_eur) as largest_fee_eur,
                  (select min(player_id) from fact_transfers where transfer_fee_eur =
                      (select max(transfer_fee_eur) from fact_transfers)) as player_id
           from fact_transfers""",
    ),
)
def _(ctx):
    return reports.transfer_totals(ctx.ref("fact_transfers"))


@check(
    "q_net_spend", "BI-11 JON-9",
    with_ctes(
        ["fact_transfers"],
        """select club_id, cast(sum(s) as bigint) as spent_eur, cast(sum(r) as bigint) as received_eur,
                  cast(sum(r) - sum(s) as bigint) as net_eur
           from (select to_club_id as club_id, transfer_fee_eur as s, 0 as r from fact_transfers
                 union all select from_club_id, 0, transfer_fee_eur from fact_transfers)
           where club_id is not null group by 1""",
    ),
)
def _(ctx):
    return reports.net_spend(ctx.ref("fact_transfers"))


@check(
    "q_volume_by_season", "BI-12",
    with_ctes(
        ["fact_transfers", "dim_date"],
        """select d.season_label as season, count(*) as transfers,
                  cast(sum(transfer_fee_eur) as bigint) as total_fee_eur
           from fact_transfers t left join dim_date d on t.sk_date = d.sk_date group by 1""",
    ),
)
def _(ctx):
    return reports.volume_by_season(ctx.ref("fact_transfers"), ctx.ref("dim_date"))


@check(
    "q_spend_by_league", "BI-13",
    with_ctes(
        ["fact_transfers", "dim_club", "dim_competitions"],
        """select competition_name, count(*) as transfers,
                  cast(sum(transfer_fee_eur) as bigint) as total_fee_eur
           from fact_transfers t left join dim_club c on t.sk_to_club = c.sk_club
           left join dim_competitions k on c.domestic_competition_id = k.competition_id
           group by 1""",
    ),
)
def _(ctx):
    return reports.spend_by_league(
        ctx.ref("fact_transfers"), ctx.ref("dim_club"), ctx.ref("dim_competitions")
    )
