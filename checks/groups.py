"""Joins, aggregates, windows, reshaping, profiles and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.models import rounded
from checks.registry import check, with_ctes
from pitchlake.functions import football, rules
from pitchlake.operators import aggregates as agg
from pitchlake.operators import clean as cl
from pitchlake.operators import joins, profile, quality, reshape, sketches, windows
from pitchlake.operators.state import run_tables
from pitchlake.plans.profiles import PROFILES
from pitchlake.session import work_path
from pitchlake.sources import files

# --- joins ---------------------------------------------------------------------------------------


@check(
    "q_star_inner", "JON-3 AGG-14 AGG-16 AGG-17",
    f"""select p_brand, s_nationkey, count(*) as n, cast(sum(q) as bigint) as quantity,
               {rounded('sum(q)', 'count(*)')} as avg_quantity,
               {rounded('sum(q)', 'sum(l_linenumber)', 90)} as per_90
        from (select *, cast(l_quantity as integer) as q from lineitem)
        join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
        group by 1, 2""",
)
def _(ctx):
    rows = ctx.base("lineitem").withColumn("q", F.col("l_quantity").cast("int"))
    joined = joins.star_inner(
        rows,
        (ctx.base("part").select("p_partkey", "p_brand"), {"l_partkey": "p_partkey"}),
        (ctx.base("supplier").select("s_suppkey", "s_nationkey"), {"l_suppkey": "s_suppkey"}),
    )
    n, q = F.count(F.lit(1)), F.sum("q")
    return agg.star_agg(
        joined, ["p_brand", "s_nationkey"],
        {"n": n, "quantity": q, "avg_quantity": rules.ratio(q, n),
         "per_90": rules.ratio(q, F.sum("l_linenumber"), 90)},
    )


@check(
    "q_lookup", "JON-4 JON-2 PRJ-9",
    """select c_custkey, n.n_name as home, a.n_name as away
       from customer left join nation n on c_nationkey = n.n_nationkey
       left join nation a on c_custkey % 30 = a.n_nationkey""",
)
def _(ctx):
    nation = ctx.base("nation")
    rows = ctx.base("customer").selectExpr("c_custkey", "c_nationkey", "c_custkey % 30 as away_key")
    home = joins.lookup(
        rows, joins.role(nation, {"n_nationkey": "h", "n_name": "home"}), {"c_nationkey": "h"}
    )
    away = joins.lookup(
        home, joins.role(nation, {"n_nationkey": "a", "n_name": "away"}), {"away_key": "a"}
    )
    return away.select("c_custkey", "home", "away")


@check(
    "q_semi_anti", "JON-6",
    """select c_custkey from customer where c_custkey not in
       (select o_custkey from orders where o_orderpriority = '1-URGENT')
       and c_custkey in (select o_custkey from orders where o_orderstatus = 'F')""",
)
def _(ctx):
    orders = ctx.base("orders").withColumnRenamed("o_custkey", "c_custkey")
    kept = joins.keep_keys(ctx.base("customer"), orders.filter("o_orderstatus = 'F'"), "c_custkey")
    urgent = orders.filter("o_orderpriority = '1-URGENT'")
    return kept.join(urgent, "c_custkey", "left_anti").select("c_custkey")


@check(
    "q_orphans", "JON-7 QLT-3",
    """select l_partkey as value, count(*) as rows from lineitem
       where l_partkey not in (select c_custkey from customer) group by 1""",
)
def _(ctx):
    return joins.orphans(ctx.base("lineitem"), "l_partkey", ctx.base("customer"), "c_custkey")


@check(
    "q_with_global", "JON-8 AGG-20",
    """select o_orderkey, o_orderkey = (select max(o_orderkey) from orders) as newest,
              (select count(*) from orders) as n
       from orders""",
)
def _(ctx):
    rows = joins.with_global(ctx.base("orders"), top=F.max("o_orderkey"), n=F.count(F.lit(1)))
    return rows.select("o_orderkey", (F.col("o_orderkey") == F.col("top")).alias("newest"), "n")


@check(
    "q_full_outer", "JON-9 SET-2",
    """select coalesce(a.id, b.id) as id, coalesce(a.name, b.name) as name, a.s_nationkey, b.lines
       from (select s_suppkey as id, s_name as name, s_nationkey from supplier
             where s_suppkey % 3 <> 0) a
       full join (select l_partkey % 130 as id, 'seen' as name, count(*) as lines
                  from lineitem group by 1) b on a.id = b.id""",
)
def _(ctx):
    clubs = ctx.base("supplier").filter("s_suppkey % 3 <> 0").selectExpr(
        "s_suppkey as id", "s_name as name", "s_nationkey"
    )
    seen = ctx.base("lineitem").groupBy((F.col("l_partkey") % 130).alias("id")).agg(
        F.lit("seen").alias("name"), F.count(F.lit(1)).alias("lines")
    )
    return joins.merge_dims(clubs, seen, "id", ["name"])


@check(
    "q_distinct_union", "SET-2",
    """select l_suppkey as id from lineitem union select l_partkey % 500 from lineitem
       union select o_custkey from orders""",
)
def _(ctx):
    lines = ctx.base("lineitem")
    return joins.distinct_union(
        lines.selectExpr("l_suppkey as id"), lines.selectExpr("l_partkey % 500 as id"),
        ctx.base("orders").selectExpr("o_custkey as id"),
    )


# --- aggregates ----------------------------------------------------------------------------------


@check("q_row_count", "AGG-1 STM-10", "select count(*) as rows from lineitem")
def _(ctx):
    return agg.count_rows(ctx.base("lineitem"))


def _missing(c: str) -> str:
    return f"count(*) filter ({c} is null or trim({c}) = '')"


_GAME_COLUMNS = "game_id season date home_club_goals away_club_goals home_club_position round".split()


@check(
    "q_null_profile", "AGG-2 AGG-3",
    with_ctes(
        ["raw_games"],
        " union all ".join(
            f"""select '{c}' as "column", count(*) as rows, {_missing(c)} as missing,
                       round({_missing(c)} * 100.0::double / count(*), 2) as missing_pct
                from raw_games"""
            for c in _GAME_COLUMNS
        ),
    ),
)
def _(ctx):
    return agg.null_profile(ctx.raw("games").select(*_GAME_COLUMNS), digits=2)


@check(
    "q_blank_profile", "AGG-2",
    with_ctes(
        ["raw_clubs"],
        """select 'net_transfer_record' as "column", 'null' as mode,
                  count(*) filter (net_transfer_record is null) as missing from raw_clubs
           union all
           select 'net_transfer_record', 'blank',
                  count(*) filter (trim(net_transfer_record) = '') from raw_clubs""",
    ),
)
def _(ctx):
    rows = ctx.raw("clubs").select("net_transfer_record")
    nulls, blanks = (
        agg.null_profile(rows, mode).select("column", F.lit(mode).alias("mode"), "missing")
        for mode in ("null", "blank")
    )
    return nulls.union(blanks)


_ORDER_COLUMNS = "o_orderkey o_custkey o_orderstatus o_orderdate o_orderpriority".split()


@check(
    "q_distinct_counts", "AGG-4",
    " union all ".join(
        f"""select '{c}' as "column", count(distinct {c}) as "distinct" from orders"""
        for c in _ORDER_COLUMNS
    ),
)
def _(ctx):
    return agg.distinct_counts(ctx.base("orders"), _ORDER_COLUMNS)


_LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_quantity l_shipdate l_returnflag".split()


@check(
    "q_distinct_counts_approx", "AGG-4",
    " union all ".join(
        f"""select '{c}' as "column", true as near, count(distinct {c}) as "distinct" from lineitem"""
        for c in ("l_orderkey", "l_partkey", "l_quantity")),
)
def _(ctx):
    """Whether each estimate lies within three standard errors of the exact count."""
    columns = ["l_orderkey", "l_partkey", "l_quantity"]
    about = agg.distinct_counts(ctx.base("lineitem"), columns, approx=True).withColumnRenamed(
        "distinct", "estimate")
    exact = agg.distinct_counts(ctx.base("lineitem"), columns)
    near = F.abs(F.col("estimate") - F.col("distinct")) <= 0.15 * F.col("distinct")
    return exact.join(about, "column").select("column", near.alias("near"), "distinct")


@check(
    "q_dup_keys", "AGG-5",
    """select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2
       having count(*) > 1""",
)
def _(ctx):
    return agg.dup_keys(ctx.base("lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    "q_dup_count", "AGG-6",
    """select 'key' as kind, count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicates
       from lineitem
       union all
       select 'row', (select count(*) from events)
                     - (select count(*) from (select distinct user_id, event_type from events))""",
)
def _(ctx):
    by_key = agg.dup_count(ctx.base("lineitem"), ["l_orderkey", "l_linenumber"])
    by_row = agg.dup_count(ctx.base("events").select("user_id", "event_type"))
    return by_key.select(F.lit("key").alias("kind"), "duplicates").union(
        by_row.select(F.lit("row"), "duplicates")
    )


@check(
    "q_value_counts", "AGG-7 SRT-1",
    """select * from (select p_brand as value, count(*) as count from part group by 1
                      order by 2 desc, 1 limit 10)
       union all
       select lower(trim(type)), count(*) from raw_game_events group by 1""".replace(
        "raw_game_events",
        """(select case event_type when 'purchase' then ' Goals ' when 'click' then 'Cards'
            when 'view' then 'SUBSTITUTIONS' when 'signup' then 'Shootout' end as type from events)""",
    ),
)
def _(ctx):
    top = agg.value_counts(ctx.base("part"), "p_brand", 10, as_name="value")
    return top.union(agg.value_counts(ctx.raw("game_events"), "type", normalise=True))


@check(
    "q_min_max", "AGG-8",
    """select 'o_orderdate' as "column", cast(min(o_orderdate) as varchar) as min,
              cast(max(o_orderdate) as varchar) as max from orders
       union all
       select 'o_orderkey', cast(min(o_orderkey) as varchar), cast(max(o_orderkey) as varchar)
       from orders""",
)
def _(ctx):
    return agg.min_max(ctx.base("orders"), ["o_orderdate", "o_orderkey"])


def _summary_sql(table: str, columns: list[str], quartiles: bool) -> str:
    parts = []
    for c in columns:
        q = "".join(
            f", round(quantile_cont({c}, {p}), 4) as p{int(p * 100)}" for p in (0.25, 0.5, 0.75)
        ) if quartiles else ""
        parts.append(
            f"""select '{c}' as "column", count({c}) as count, round(avg({c}), 4) as mean,
                       round(stddev_samp({c}), 4) as stddev, min({c}) as min, max({c}) as max{q}
                from {table}"""
        )
    return " union all ".join(parts)


def _rounded_summary(df):
    return df.select(
        *[
            F.round(c, 4).alias(c) if c in ("mean", "stddev", "p25", "p50", "p75") else c
            for c in df.columns
        ]
    )


@check("q_summary", "AGG-9", _summary_sql("lineitem", ["l_quantity", "l_extendedprice"], True))
def _(ctx):
    columns = ["l_quantity", "l_extendedprice"]
    return _rounded_summary(agg.summary(ctx.base("lineitem"), columns, quartiles="exact"))


@check("q_describe", "AGG-9", _summary_sql("events", ["value"], False))
def _(ctx):
    return _rounded_summary(agg.summary(ctx.base("events"), ["value"], quartiles="none"))


@check(
    "q_summary_approx", "AGG-9",
    " union all ".join(
        f"""select '{c}' as "column", count({c}) as count, true as near from lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_tax")),
)
def _(ctx):
    """Whether the share of values up to each estimated quartile is near its probability."""
    columns, rows = ["l_quantity", "l_extendedprice", "l_tax"], ctx.base("lineitem")
    about = agg.summary(rows, columns)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                      for c in columns])
    near, at = F.lit(True), F.lit(0.001)
    ranked = rows.select(F.inline(cells)).join(F.broadcast(about), "column").groupBy(
        "column", "count").agg(*[
            F.avg((F.col("v") < F.col(q)).cast("double")).alias(f"{q}_low") for q in ("p25", "p50", "p75")
        ], *[
            F.avg((F.col("v") <= F.col(q)).cast("double")).alias(f"{q}_high")
            for q in ("p25", "p50", "p75")])
    for q, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        near = near & (F.col(f"{q}_low") - at <= p) & (F.col(f"{q}_high") + at >= p)
    return ranked.select("column", "count", near.alias("near"))


@check(
    "q_profile_sketches", "AGG-4 AGG-8 AGG-9 QLT-7",
    " union all ".join(
        f"""select '{c}' as "column", count(*) as rows, count({c}) as known,
                   {f'cast(min({c}) as double)' if n else 'null'} as low,
                   {f'cast(max({c}) as double)' if n else 'null'} as high,
                   true as distinct_near, {'true' if n else 'null'} as quantiles_near from lineitem"""
        for c, n in ((c, c not in ("l_shipdate", "l_returnflag")) for c in _LINE_COLUMNS)),
)
def _(ctx):
    """Sketches of three loads, stored one by one and merged, next to exact counts and ranks."""
    numeric = [c for c in _LINE_COLUMNS if c not in ("l_shipdate", "l_returnflag")]
    rows = ctx.base("lineitem")
    path = work_path(ctx.spark, "sketches")
    for load in range(3):
        part = rows.where(F.col("l_orderkey") % 3 == load)
        sketches.sketch_columns(part, _LINE_COLUMNS, numeric).write.mode("append").parquet(path)
    about = sketches.estimates(sketches.merge_sketches(ctx.spark.read.parquet(path)))
    counted = agg.value_table(rows, _LINE_COLUMNS).join(
        F.broadcast(about.select("column", "quantiles")), "column")
    number, checks = F.col("value").try_cast("double"), []
    for i, p in enumerate((0.25, 0.5, 0.75)):
        q = F.col("quantiles")[i]
        below, upto = (F.sum(F.when(c, F.col("n")).otherwise(0)) / F.sum("n")
                       for c in (number < q, number <= q))
        checks.append((below - sketches.RANK_ERROR <= p) & (upto + sketches.RANK_ERROR >= p))
    exact = counted.where("value is not null").groupBy("column").agg(
        F.count("value").alias("exact"), (checks[0] & checks[1] & checks[2]).alias("ranks"))
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(
        F.lit(1), sketches.DISTINCT_ERROR * F.col("exact"))
    return about.join(exact, "column").select(
        "column", "rows", "known", "low", "high", near.alias("distinct_near"),
        F.when(F.col("column").isin(numeric), F.col("ranks")).alias("quantiles_near"))


@check(
    "q_length_summary", "AGG-10",
    _summary_sql("(select cast(length(text) as double) as text_length from documents)", ["text_length"], True),
)
def _(ctx):
    return _rounded_summary(agg.length_summary(ctx.base("documents"), "text", quartiles="exact"))


@check(
    "q_count_stats", "AGG-11",
    f"""select min(n) as min_rows, max(n) as max_rows, {rounded('sum(n)', 'count(*)', digits=4)}
               as avg_rows, quantile_cont(n, 0.5) as median_rows
        from (select user_id, count(*) as n from events group by 1)""",
)
def _(ctx):
    return agg.per_key_count_stats(ctx.base("events"), "user_id")


def _iqr_sql(table: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        parts.append(
            f"""select '{c}' as "column", round(lo, 4) as lower, round(hi, 4) as upper,
                       count(*) filter ({c} < lo or {c} > hi) as outliers,
                       {rounded(f'count(*) filter ({c} < lo or {c} > hi)', 'count(*)', 100)}
                           as outlier_pct
                from {table}, (select q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi
                    from (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3
                          from {table})) group by lo, hi"""
        )
    return " union all ".join(parts)


def _rounded_bounds(df):
    return df.withColumns({"lower": F.round("lower", 4), "upper": F.round("upper", 4)})


@check("q_iqr", "AGG-12", _iqr_sql("lineitem", ["l_extendedprice", "l_quantity"]))
def _(ctx):
    return _rounded_bounds(agg.iqr_outliers(ctx.base("lineitem"), ["l_extendedprice", "l_quantity"]))


@check("q_iqr_split", "AGG-12", _iqr_sql("events", ["value"]))
def _(ctx):
    """The same report while the ranking of distinct values is split into chunks."""
    return _rounded_bounds(agg.iqr_outliers(ctx.base("events"), ["value"]))


@check(
    "q_constant", "AGG-13 AGG-3",
    with_ctes(
        ["raw_clubs"],
        """select 'constant' as kind, c as "column" from (
               select unnest(['total_market_value', 'coach_name', 'filename', 'url']) as c)
           union all
           select 'missing', c from (
               select 'total_market_value' as c, count(total_market_value) as n from raw_clubs
               union all select 'coach_name', count(coach_name) from raw_clubs) where n = 0""",
    ),
)
def _(ctx):
    clubs = ctx.raw("clubs")
    constant = agg.constant_cols(clubs).select(F.lit("constant").alias("kind"), "column")
    return constant.union(agg.high_missing(clubs).select(F.lit("missing"), "column"))


@check("q_global_max", "AGG-20", "select max(l_orderkey) as l_orderkey from lineitem")
def _(ctx):
    return agg.global_max(ctx.base("lineitem"), "l_orderkey")


@check(
    "q_sum_if", "AGG-15 AGG-16 NUL-9",
    f"""select user_id, cast(sum(case when event_type = 'purchase' then 1 else 0 end) as bigint)
               as purchases, {rounded("sum(case when event_type = 'purchase' then 1 else 0 end)",
                                      "sum(case when event_type = 'view' then 1 else 0 end)",
                                      100, 1)} as rate
        from events group by 1""",
)
def _(ctx):
    bought, seen = (
        agg.sum_if(F.col("event_type") == kind) for kind in ("purchase", "view")
    )
    return agg.star_agg(
        ctx.base("events"), ["user_id"],
        {"purchases": bought, "rate": rules.ratio(bought, seen, 100, 1)},
    )


_CASTS = {"season": "int", "home_club_goals": "int", "date": "date"}


@check(
    "q_cast_failures", "CST-13",
    with_ctes(
        ["raw_games"],
        " union all ".join(
            f"""select '{c}' as "column", count(*) filter (trim({c}) <> '' and
                try_cast({c} as {t}) is null) as failures from raw_games"""
            for c, t in _CASTS.items()
        ),
    ),
)
def _(ctx):
    return agg.cast_failures(ctx.raw("games"), _CASTS)


@check(
    "q_date_failures", "QLT-9 CST-13",
    with_ctes(
        ["raw_games"],
        """select 'date' as "column", date as value, game_id from raw_games
           where trim(date) <> '' and try_cast(date as date) is null""",
    ),
)
def _(ctx):
    return agg.failed_values(ctx.raw("games"), {"date": "date"}, ["game_id"])


# --- windows -------------------------------------------------------------------------------------

_LATEST = """select event_id, cast(row_number() over (partition by user_id
                        order by ts desc, event_id desc) as integer) as rn,
                    row_number() over (partition by user_id order by ts desc, event_id desc) = 1
                        as is_latest
             from events where value is not null"""


@check("q_latest", "WIN-1 FLT-5 SCL-11", _LATEST)
def _(ctx):
    rows = cl.require(ctx.base("events"), "value")
    ranked = windows.latest_per_key(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return ranked.select("event_id", "rn", "is_latest")


@check("q_latest_split", "WIN-1", _LATEST)
def _(ctx):
    """The same ranking; every group is cut into chunks."""
    ranked = windows.latest_per_key(
        ctx.base("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]
    )
    return ranked.select("event_id", "rn", "is_latest")


_RUNNING = """select event_id,
        cast(sum(case when event_type = 'purchase' then 1 else 0 end) over w as bigint) as goals,
        cast(sum(case when event_type = 'click' then 1 else 0 end) over w as bigint) as cards
    from events window w as (partition by user_id order by ts, event_id
                             rows between unbounded preceding and current row)"""


def _running(ctx):
    totals = windows.running_totals(
        ctx.base("events"), ["user_id"], ["ts", "event_id"],
        {"goals": F.col("event_type") == "purchase", "cards": F.col("event_type") == "click"},
    )
    return totals.select("event_id", "goals", "cards")


@check("q_running_totals", "WIN-5", _RUNNING)
def _(ctx):
    return _running(ctx)


@check("q_running_totals_split", "WIN-5", _RUNNING)
def _(ctx):
    return _running(ctx)


@check(
    "q_partition_totals", "WIN-2 WIN-3",
    """select l_orderkey, l_linenumber, l_partkey, club, season,
              cast(sum(cents) over (partition by club, season) as bigint) as spent,
              count(case when l_returnflag = 'R' then 1 end) over (partition by club, season)
                  as returned
       from (select *, nullif(l_suppkey % 40, 7) as club, year(l_shipdate) as season,
                    cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint) as cents
             from lineitem)""",
)
def _(ctx):
    rows = ctx.base("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        "nullif(l_suppkey % 40, 7) as club", "cast(year(l_shipdate) as bigint) as season",
        "cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint) as cents",
    )
    totals = windows.partition_totals(
        rows, ["club", "season"],
        {"spent": F.sum("cents"), "returned": F.count_if(F.col("l_returnflag") == "R")},
    )
    return totals.drop("l_returnflag", "cents")


@check(
    "q_dedup", "WIN-4 AGG-18",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey from (
           select *, row_number() over (partition by l_orderkey, l_linenumber
                                        order by l_partkey, l_suppkey, l_extendedprice) as rn
           from lineitem) where rn = 1""",
)
def _(ctx):
    order = ["l_partkey", "l_suppkey", "l_extendedprice"]
    kept = cl.dedup(ctx.base("lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@check(
    "q_dedup_any", "AGG-18",
    "select distinct l_orderkey, l_linenumber from lineitem",
)
def _(ctx):
    kept = cl.dedup(ctx.base("lineitem"), ["l_orderkey", "l_linenumber"])
    return kept.select("l_orderkey", "l_linenumber")


@check(
    "q_match_phase", "SCL-15 WIN-3",
    with_ctes(
        ["game_events"],
        """select game_event_id, case when last <= 90 then 90 else 120 end as end_minute,
                  case when last <= 90 then 'FULL TIME' else 'EXTRA TIME' end as end_label,
                  case when minute <= 45 then 'FIRST HALF' when minute <= 90 then 'SECOND HALF'
                       when minute <= 105 then 'EXTRA TIME 1ST' else 'EXTRA TIME 2ND' end as phase
           from (select *, max(minute) over (partition by game_id) as last from game_events
                 where minute is not null)""",
    ),
)
def _(ctx):
    events = cl.require(ctx.silver("game_events"), "minute")
    rows = windows.partition_totals(events, ["game_id"], {"last": F.max("minute")})
    return rows.select(
        "game_event_id", *[c.alias(n) for n, c in football.match_end(F.col("last")).items()],
        football.match_phase(F.col("minute")).alias("phase"),
    )


# --- reshaping -----------------------------------------------------------------------------------


@check(
    "q_pivot", "SET-3",
    """select cast(cast(ts as date) as varchar) as day,
              max(case when event_type = 'view' then event_id end) as view,
              max(case when event_type = 'click' then event_id end) as click,
              max(case when event_type = 'nothing' then event_id end) as nothing
       from events group by 1""",
)
def _(ctx):
    rows = ctx.base("events").select(F.to_date("ts").alias("day"), "event_type", "event_id")
    return reshape.pivot_fields(rows, ["day"], "event_type", "event_id", ["view", "click", "nothing"])


@check(
    "q_unpivot", "SET-4",
    """select p_partkey, p_brand, 'p_size' as field, cast(p_size as varchar) as value from part
       union all select p_partkey, p_brand, 'p_type', p_type from part""",
)
def _(ctx):
    return reshape.to_points(ctx.base("part"), ["p_partkey", "p_brand"], ["p_size", "p_type"])


@check(
    "q_two_sides", "SET-1",
    """select o_orderkey, 'Home' as side, o_custkey % 100 as club from orders
       union all select o_orderkey, 'Away', o_orderkey % 100 from orders""",
)
def _(ctx):
    return reshape.views(
        ctx.base("orders"),
        [
            {"o_orderkey": F.col("o_orderkey"), "side": F.lit(s), "club": F.col(c) % 100}
            for s, c in (("Home", "o_custkey"), ("Away", "o_orderkey"))
        ],
    )


# --- quality -------------------------------------------------------------------------------------


@check(
    "q_quality", "QLT-1 QLT-2 QLT-3 QLT-4 QLT-5 QLT-6",
    """select *, case when violations = 0 then 'pass' when severity = 'warn' then 'warn'
                 else 'error' end as status from (
       select 'lineitem' as model, 'not_null_l_tax' as test, 'error' as severity,
              (select count(*) from lineitem where l_tax is null) as violations
       union all select 'lineitem', 'range_l_quantity', 'warn',
              (select count(*) from lineitem where l_quantity < 2 or l_quantity > 48)
       union all select 'lineitem', 'values_l_returnflag', 'error',
              (select count(*) from lineitem where l_returnflag not in ('A', 'N'))
       union all select 'lineitem', 'unique_l_orderkey', 'warn',
              (select count(*) from (select 1 from lineitem group by l_orderkey
                                     having count(*) > 1))
       union all select 'lineitem', 'relationship_l_partkey', 'error',
              (select count(*) from lineitem where l_partkey not in (select c_custkey from customer)))""",
)
def _(ctx):
    checks = [
        quality.not_null("l_tax"),
        quality.accepted_range("l_quantity", 2, 48, "warn"),
        quality.accepted_values("l_returnflag", ["A", "N"]),
        quality.unique("l_orderkey", "warn"),
        quality.relationship("l_partkey", "customer", "c_custkey"),
    ]
    report = quality.run_checks(
        "lineitem", ctx.base("lineitem"), checks, {"customer": ctx.base("customer")}
    )
    return quality.with_status(report)


_DQ = "c_custkey c_nationkey c_acctbal c_mktsegment always seldom".split()
_DQ_NUMERIC = ("c_custkey", "c_nationkey", "c_acctbal")
#: Customers with a constant and a sparse column, and some rows twice.
_DQ_ROWS = """(
    select c_custkey, c_nationkey, cast(c_acctbal as double) as c_acctbal, c_mktsegment, 'x' as always,
           case when c_custkey % 4 = 1 then c_custkey end as seldom
    from customer cross join (select 0 as again union all select 1) as twice
    where again = 0 or c_custkey % 10 = 3)"""


def _dq_sql() -> str:
    parts = [f"select 'rows' as section, '*' as subject, cast(count(*) as double) as value from {_DQ_ROWS}",
             f"select 'columns', '*', {float(len(_DQ))}::double"]
    for c in _DQ:
        parts += [
            f"select 'missing', '{c}', cast(count(*) - count({c}) as double) from {_DQ_ROWS}",
            f"""select 'missing_pct', '{c}',
                round((count(*) - count({c})) * 100.0::double / count(*), 2) from {_DQ_ROWS}""",
            f"select 'distinct', '{c}', cast(count(distinct {c}) as double) from {_DQ_ROWS}",
        ]
    for c in _DQ_NUMERIC:
        stats = {
            "count": f"count({c})", "mean": f"avg({c})", "stddev": f"stddev_samp({c})",
            "min": f"min({c})", "max": f"max({c})",
            **{f"p{p}": f"quantile_cont({c}, {p / 100})" for p in (25, 50, 75)}}
        parts += [
            f"select 'summary_{name}', '{c}', round(cast({x} as double), 4) from {_DQ_ROWS}"
            for name, x in stats.items()]
        parts.append(f"""select 'outliers', "column", cast(outliers as double)
                         from ({_iqr_sql(_DQ_ROWS, [c])})""")
    columns = ", ".join(_DQ)
    parts += [
        f"""select 'duplicates', '*', cast(count(*) - (select count(*) from (
                select distinct {columns} from {_DQ_ROWS})) as double) from {_DQ_ROWS}""",
        "select 'constant', 'always', 1.0::double",
        f"""select 'mostly_missing', 'seldom',
            round((count(*) - count(seldom)) * 100.0::double / count(*), 2) from {_DQ_ROWS}"""]
    return " union all ".join(parts)


@check("q_dq_report", "QLT-7 AGG-2 AGG-3 AGG-4 AGG-6 AGG-9 AGG-12 AGG-13", _dq_sql())
def _(ctx):
    rows = ctx.base("customer").select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment", F.lit("x").alias("always"),
        F.when(F.col("c_custkey") % 4 == 1, F.col("c_custkey")).alias("seldom"))
    return profile.dq_report(rows.union(rows.where("c_custkey % 10 = 3")), _DQ_NUMERIC)


# --- profiles ------------------------------------------------------------------------------------


def _number(c: str, t: str = "integer") -> str:
    return f"try_cast(trim({c}) as {t})"


_RULES_SQL = {
    "yellow_cards_above_2": f"{_number('yellow_cards')} > 2",
    "red_cards_above_1": f"{_number('red_cards')} > 1",
    "negative_goals_or_assists": f"{_number('goals')} < 0 or {_number('assists')} < 0",
    "minutes_outside_1_120": f"{_number('minutes_played')} not between 1 and 120",
    "country_sentinel": "country_id = '-1'",
    "league_code_mismatch": "type = 'domestic_league' and domestic_league_code <> competition_id",
    "minute_below_1": f"{_number('minute')} < 1",
    "minute_above_120": f"{_number('minute')} > 120",
    "captain_not_0_or_1": f"{_number('team_captain')} not in (0, 1)",
    "goals_above_20": f"{_number('home_club_goals')} > 20 or {_number('away_club_goals')} > 20",
    "market_value_not_positive": "false",
    "team_code_is_not_slug": "team_code <> replace(lower(name), ' ', '-')",
    "unknown_club": "current_club_name = 'Unknown'",
    "negative_goals": "false",
}
# The same rule name reads different columns in different tables.
_TABLE_RULES_SQL = {
    ("club_games", "negative_goals"):
        f"{_number('own_goals')} < 0 or {_number('opponent_goals')} < 0",
    ("games", "negative_goals"):
        f"{_number('home_club_goals')} < 0 or {_number('away_club_goals')} < 0",
    ("national_teams", "market_value_not_positive"):
        f"{_number('total_market_value', 'bigint')} <= 0",
    ("player_valuations", "market_value_not_positive"):
        f"{_number('market_value_in_eur', 'bigint')} <= 0",
}
_TYPED = {"players"}


def _profile_sql(table: str, columns: list[str], types: dict[str, str]) -> str:
    spec, raw = PROFILES[table], f"raw_{table}"
    parts = [f"select 'rows' as metric, '*' as subject, count(*) as value from {raw}"]

    def count_if(metric: str, subject: str, predicate: str) -> None:
        parts.append(f"select '{metric}', '{subject}', count(*) filter ({predicate}) from {raw}")

    for c in columns:
        blank = f" or trim({c}) = ''" if types[c] == "string" else ""
        count_if("missing", c, f"{c} is null{blank}")
    for c, t in spec.casts.items():
        count_if("cast_failures", c, f"trim({c}) <> '' and try_cast({c} as {t}) is null")
    for c in spec.dates:
        count_if("date_failures", c, f"trim({c}) <> '' and try_cast({c} as date) is null")
    for c, p in spec.patterns.items():
        count_if("bad_format", c, f"trim({c}) <> '' and not regexp_matches({c}, '{p}')")
    for name in spec.rules:
        count_if("rule", name, _TABLE_RULES_SQL.get((table, name), _RULES_SQL[name]))
    for c in spec.lengths:
        parts.append(f"select 'max_length', '{c}', max(length({c})) from {raw}")
    for c in columns:
        parts.append(f"select 'distinct', '{c}', count(distinct {c}) from {raw}")
    keys = ", ".join(spec.key)
    parts.append(
        f"""select 'repeated_keys', '{",".join(spec.key)}', count(*) from (
            select 1 from {raw} group by {keys} having count(*) > 1)"""
    )
    return with_ctes([raw], " union all ".join(parts))


def _register_profiles() -> None:
    from pitchlake.plans.specs import SPECS

    for table, spec in PROFILES.items():
        schema = SPECS[table].raw_schema
        types = {f.name: f.dataType.simpleString() for f in schema}
        check(
            f"profile_{table}", "TBL-38 AGG-1 AGG-2 AGG-4 AGG-5 CST-13 FLT-8 FLT-9 FLT-10 QLT-9",
            _profile_sql(table, schema.names, types),
        )(lambda ctx, t=table, s=spec: profile.profile(ctx.raw(t), s))


_register_profiles()


def _distribution_sql(table: str) -> str:
    return with_ctes(
        [f"raw_{table}"],
        " union all ".join(
            f"""select '{c}' as "column", {c} as value, count(*) as count
                from raw_{table} group by {c}"""
            for c in PROFILES[table].categories
        ),
    )


for _table in (t for t, p in PROFILES.items() if p.categories):
    check(f"q_distributions_{_table}", "TBL-38 AGG-7", _distribution_sql(_table))(
        lambda ctx, t=_table: profile.distributions(ctx.raw(t), PROFILES[t])
    )


@check(
    "q_date_ranges", "TBL-38 AGG-8",
    with_ctes(
        ["raw_games"],
        """select 'date' as "column", cast(min(try_cast(date as date)) as varchar) as min,
                  cast(max(try_cast(date as date)) as varchar) as max from raw_games""",
    ),
)
def _(ctx):
    return profile.date_ranges(ctx.raw("games"), PROFILES["games"])


@check(
    "q_numeric_summary", "TBL-38 AGG-9",
    with_ctes(
        ["raw_appearances"],
        _summary_sql(
            """(select try_cast(trim(yellow_cards) as double) as yellow_cards,
                       try_cast(trim(red_cards) as double) as red_cards,
                       try_cast(trim(goals) as double) as goals,
                       try_cast(trim(assists) as double) as assists,
                       try_cast(trim(minutes_played) as double) as minutes_played
                from raw_appearances)""",
            ["yellow_cards", "red_cards", "goals", "assists", "minutes_played"], True,
        ),
    ),
)
def _(ctx):
    spec = PROFILES["appearances"]
    return _rounded_summary(
        profile.numeric_summary(ctx.raw("appearances"), spec, quartiles="exact")
    )


def _register_ranges_and_summaries() -> None:
    """Date ranges and numeric summaries of every table that has such columns."""
    for table, spec in PROFILES.items():
        if spec.dates:
            days = " union all ".join(
                f"""select '{c}' as "column", cast(min(try_cast({c} as date)) as varchar) as min,
                           cast(max(try_cast({c} as date)) as varchar) as max from raw_{table}"""
                for c in spec.dates)
            check(f"q_date_ranges_{table}", "TBL-38 AGG-8", with_ctes([f"raw_{table}"], days))(
                lambda ctx, t=table, s=spec: profile.date_ranges(ctx.raw(t), s))
        kinds = {"int": "integer"}
        cells = ", ".join(
            f"cast(try_cast(trim(cast({c} as varchar)) as {kinds.get(t, t)}) as double) as {c}"
            for c, t in spec.numeric.items())
        check(
            f"q_numeric_summary_{table}", "TBL-38 AGG-9",
            with_ctes([f"raw_{table}"], _summary_sql(
                f"(select {cells} from raw_{table})", list(spec.numeric), True)),
        )(lambda ctx, t=table, s=spec: _rounded_summary(
            profile.numeric_summary(ctx.raw(t), s, quartiles="exact")))


_register_ranges_and_summaries()


# --- runs ----------------------------------------------------------------------------------------


@check(
    "q_run_tables", "INC-7 SNK-1",
    """select 'clubs' as "table", 'ok' as status, count(*) as rows from supplier
       union all select 'broken', 'failed', null
       union all select 'countries', 'ok', count(*) from nation""",
)
def _(ctx):
    """Three jobs of which the second fails; the third still runs."""
    folder = work_path(ctx.spark, "silver")

    def write(name: str):
        def job():
            files.write_silver(ctx.silver(name), f"{folder}/{name}")
            return files.read_parquet(ctx.spark, f"{folder}/{name}")

        return job

    def broken():
        raise ValueError("no such table")

    jobs = {"clubs": write("clubs"), "broken": broken, "countries": write("countries")}
    return run_tables(ctx.spark, jobs).select("table", "status", "rows")
