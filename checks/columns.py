"""Sources, projections, casts, NULL rules, filters and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import AS_OF, RUN_TS, check, table_sql, with_ctes
from checks.models import sk
from pitchlake.functions import calendar, casting, football, rules
from pitchlake.functions.keys import surrogate_key
from pitchlake.operators import clean as cl
from pitchlake.operators import filters, limits
from pitchlake.plans.specs import SPECS
from pitchlake.sources import files
from pitchlake.session import work_path
from pitchlake.streaming.events import in_match_order, to_event_json

# --- sources and sinks ---------------------------------------------------------------------------

_RAW_GAMES = SPECS["games"].raw_schema.names


@check(
    "q_sources_csv", "SRC-1 SNK-4",
    with_ctes(
        ["raw_games"],
        f"select {', '.join(f'''nullif({c}, '') as {c}''' for c in _RAW_GAMES)} from raw_games",
    ),
)
def _(ctx):
    """Raw matches to CSV and back: text stays as it is, empty cells become NULL."""
    folder = work_path(ctx.spark, "csv")
    files.write_csv(ctx.raw("games"), f"{folder}/games.csv")
    return files.read_raw(ctx.spark, folder, SPECS["games"])


@check(
    "q_sources_typed", "SRC-2 TBL-11",
    table_sql("players", ("date_of_birth", "contract_expiration_date")),
)
def _(ctx):
    """Players through a typed CSV, then cleaned."""
    folder = work_path(ctx.spark, "csv")
    files.write_csv(ctx.raw("players"), f"{folder}/players.csv")
    return cl.clean(files.read_raw(ctx.spark, folder, SPECS["players"]), SPECS["players"], as_of=AS_OF)


@check(
    "q_sources_several", "SRC-8",
    """select o_orderpriority, o_orderstatus, count(*) as n, count(distinct c_mktsegment) as segments
       from orders join customer on o_custkey = c_custkey group by 1, 2""",
)
def _(ctx):
    folder = work_path(ctx.spark, "csv")
    names = {"orders": ["o_custkey", "o_orderpriority", "o_orderstatus"],
             "customer": ["c_custkey", "c_mktsegment"]}
    for name, columns in names.items():
        files.write_csv(ctx.base(name).select(*columns), f"{folder}/{name}.csv")
    t = files.read_csvs(ctx.spark, folder, {n: files.string_schema(c) for n, c in names.items()})
    joined = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("c_mktsegment").alias("segments")
    )


@check(
    "q_parquet", "SNK-1 SRC-3",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
              cast(o_orderdate as varchar) as o_orderdate from orders""",
)
def _(ctx):
    path = work_path(ctx.spark, "parquet")
    files.write_partitioned(ctx.base("orders"), path, ["o_orderstatus"])
    return files.read_parquet(ctx.spark, path)


@check(
    "q_load_raw", "SRC-4",
    """select club_id, club_name, cast(null as integer) as founded from (
           select cast(s_suppkey as integer) as club_id, s_name as club_name from supplier)""",
)
def _(ctx):
    """Columns match whatever their case, missing ones are NULL, unknown ones are ignored."""
    rows = ctx.base("supplier").select(
        F.col("s_name").alias("CLUB_NAME"), F.col("s_suppkey").alias("Club_Id"), "s_acctbal"
    )
    schema = "club_id int, club_name string, founded int"
    return files.load_raw(rows, ctx.spark.createDataFrame([], schema).schema)


@check(
    "q_load_checked", "SRC-2 SRC-4 CST-13",
    """with s as (
         select o_orderkey, case when o_orderkey % 40 = 5 then 'n/a' when o_orderkey % 50 = 7 then ''
                            else cast(o_custkey as varchar) end as custkey,
                case when o_orderkey % 30 = 4 then 'today' else cast(cast(o_orderdate as date) as varchar)
                end as day from orders)
       select 'rows' as part, cast(count(*) as varchar) as "column", '' as text, count(*) as n,
              cast(sum(try_cast(custkey as integer)) as bigint) as customers
       from s where try_cast(custkey as integer) is not null and try_cast(day as date) is not null
       union all
       select 'rejected', 'custkey', custkey, count(*), null from s
       where try_cast(custkey as integer) is null group by custkey
       union all
       select 'rejected', 'day', day, count(*), null from s
       where try_cast(day as date) is null group by day""",
)
def _(ctx):
    """Two loads of orders with bad cells, the second repeated: good rows once, bad cells named."""
    key = F.col("o_orderkey")
    text = ctx.base("orders").select(
        key, F.when(key % 40 == 5, "n/a").when(key % 50 == 7, "").otherwise(
            F.col("o_custkey").cast("string")).alias("CustKey"),
        F.when(key % 30 == 4, "today").otherwise(
            F.col("o_orderdate").cast("date").cast("string")).alias("day"))
    schema = ctx.spark.createDataFrame([], "o_orderkey long, custkey int, day date").schema
    path = work_path(ctx.spark, "loads")
    halves = [text.where(key % 2 == 0), text.where(key % 2 == 1)]
    for run, part in (("even", halves[0]), ("odd", halves[1]), ("odd", halves[1])):
        files.append_load(files.load_checked(part, schema), path, "orders", run)
    good = files.loaded_rows(ctx.spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.sum("custkey").alias("customers"))
    bad = files.rejected_cells(ctx.spark.read.parquet(f"{path}/rejected"), "orders")
    return good.select(
        F.lit("rows").alias("part"), F.col("n").cast("string").alias("column"), F.lit("").alias("text"),
        "n", "customers",
    ).union(bad.groupBy("column", "text").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("rejected"), "column", "text", "n", F.lit(None).cast("long")))


@check(
    "q_completeness", "SRC-9",
    """select 'clubs' as "table", 'found' as status, true as has_bytes, (select count(*) from supplier) as rows
       union all select 'games', 'found', true, (select count(*) from orders)
       union all select 'coaches', 'missing', false, null
       union all select 'nations', 'extra', true, (select count(*) from nation)""",
)
def _(ctx):
    """Tables written from the given ones, next to what was expected: one is missing, one unasked."""
    path = work_path(ctx.spark, "complete")
    for table, source in (("clubs", "supplier"), ("games", "orders"), ("nations", "nation")):
        files.write_silver(ctx.base(source), f"{path}/{table}")
    found = files.check_manifest(
        files.list_files(ctx.spark, path, "*.parquet"), ["clubs", "games", "coaches"])
    rows = None
    for table in ("clubs", "games", "nations"):
        part = files.read_parquet(ctx.spark, f"{path}/{table}").agg(
            F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), "rows")
        rows = part if rows is None else rows.union(part)
    return found.join(rows, "table", "left").select(
        "table", "status", (F.col("bytes") > 0).alias("has_bytes"), "rows")


@check(
    "q_inspect", "QLT-8 AGG-1 AGG-2 SRT-4",
    with_ctes(
        ["raw_games"],
        " union all ".join(
            f"""select 'games' as "table", '{c}' as "column", 'string' as type, count(*) as rows,
                       count(*) - count({c}) as nulls from raw_games"""
            for c in _RAW_GAMES
        ),
    ),
)
def _(ctx):
    return files.inspect_table(ctx.raw("games"), "games")


@check(
    "q_event_json", "SNK-5",
    with_ctes(
        ["raw_game_events"],
        """select '{"game_event_id":"' || game_event_id || '","game_id":' || game_id
                  || ',"minute":' || coalesce(cast(try_cast(minute as integer) as varchar), 'null')
                  || ',"club_name":' || coalesce('"' || club_name || '"', 'null')
                  || ',"description":' || coalesce('"' || description || '"', 'null')
                  || ',"_ingested_at":"2024-07-01T00:00:00.000Z","_source":"replay",'
                  || '"_pipeline":"match_events"}' as value
           from raw_game_events""",
    ),
)
def _(ctx):
    rows = ctx.raw("game_events").select(
        "game_event_id", "game_id", "minute", "club_name", "description"
    )
    return to_event_json(in_match_order(rows), ("game_id", "minute"), now=RUN_TS)


# --- projections ---------------------------------------------------------------------------------


@check(
    "q_projection", "PRJ-1 PRJ-2 PRJ-7",
    "select p_name as name, p_brand as brand, p_partkey as id from part",
)
def _(ctx):
    renamed = ctx.base("part").drop("p_size", "p_retailprice").withColumnsRenamed(
        {"p_name": "name", "p_brand": "brand", "p_partkey": "id"}
    )
    return cl.safe_columns(renamed, ["name", "colour", "brand", "id"])


@check(
    "q_strings", "PRJ-3 SCL-1 SCL-2 SCL-12 FLT-10",
    """select p_partkey, trim(padded) as padded, lower(trim(padded)) as low,
              replace(lower(p_name), ' ', '-') as slug, right(p_brand, 2) as tail,
              length(p_name) as name_length, p_name like '%ring%' as has_ring,
              p_type like '%Y' as ends_y
       from (select *, case when p_partkey % 2 = 0 then '  ' || p_type || ' ' else p_type end
             as padded from part)""",
)
def _(ctx):
    padded = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("  "), "p_type", F.lit(" ")))
    rows = cl.trim_strings(
        ctx.base("part").withColumn("padded", padded.otherwise(F.col("p_type")))
    )
    return rows.select(
        "p_partkey", "padded", F.lower("padded").alias("low"),
        football.slug(F.col("p_name")).alias("slug"),
        F.right("p_brand", F.lit(2)).alias("tail"), F.length("p_name").alias("name_length"),
        rules.contains("p_name", "ring").alias("has_ring"),
        F.col("p_type").endswith("Y").alias("ends_y"),
    )


@check(
    "q_literals", "PRJ-4 PRJ-5",
    """select c_custkey, 'batch' as source_type, 7 as run, '2024-07-01 00:00:00' as loaded_at
       from customer""",
)
def _(ctx):
    rows = cl.with_literals(ctx.base("customer").select("c_custkey"), source_type="batch", run=7)
    return cl.stamp(rows, "loaded_at", RUN_TS)


@check(
    "q_surrogate_key", "PRJ-8",
    f"""select l_orderkey, {sk('l_orderkey', 'nullif(l_linenumber, 3)', 'l_returnflag',
                              'cast(l_shipdate as date)')} as line_key
        from lineitem""",
)
def _(ctx):
    key = surrogate_key(
        "l_orderkey", F.nullif("l_linenumber", F.lit(3)), "l_returnflag", F.to_date("l_shipdate")
    )
    return ctx.base("lineitem").select("l_orderkey", key.alias("line_key"))


# --- casts ---------------------------------------------------------------------------------------

_TEXT = """case when l_orderkey % 7 = 0 then '' when l_orderkey % 11 = 0 then 'x'
           when l_orderkey % 13 = 0 then null when l_orderkey % 17 = 0 then ' 12 '
           else cast(cast(l_quantity as bigint) * 100000007 as string) end"""


@check(
    "q_safe_cast", "CST-1 CST-2 CST-3 CST-4 CST-5",
    f"""select l_orderkey, l_linenumber, try_cast(v as integer) as as_int,
               try_cast(v as bigint) as as_long, try_cast(v as double) as as_double,
               cast(try_cast(price as float) as double) as as_float,
               cast(trunc(try_cast(price as double)) as bigint) as whole
        from (select *, {_TEXT} as v,
                     cast(cast(l_extendedprice as decimal(12,2)) as string) as price
              from (select l_orderkey, l_linenumber, l_extendedprice, l_quantity from lineitem))""",
)
def _(ctx):
    v, price = F.expr(_TEXT), F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    return ctx.base("lineitem").selectExpr("*", f"{_TEXT} as v").select(
        "l_orderkey", "l_linenumber",
        casting.safe_int(v).alias("as_int"),
        casting.safe_long(v).alias("as_long"),
        casting.safe_double(v).alias("as_double"),
        casting.safe_float(price).cast("double").alias("as_float"),
        casting.safe_long(price, via_double=True).alias("whole"),
    )


_MONEY = """case c_custkey % 6
    when 0 then '+€' || cast(c_custkey % 900 as string) || '.06m'
    when 1 then '€-' || cast(c_custkey % 900 as string) || 'k'
    when 2 then '+-0' when 3 then null when 4 then ''
    else '-€' || cast(c_custkey % 9 as string) || '.5bn' end"""


@check(
    "q_money", "CST-8",
    f"""select c_custkey,
               cast(try_cast(regexp_replace(m, '[^0-9.]', '', 'g') as decimal(20,4))
                    * case when m like '%bn' then 1000000000 when m like '%m' then 1000000
                           when m like '%k' then 1000 else 1 end
                    * case when m like '%-%' then -1 else 1 end as bigint) as eur
        from (select c_custkey, nullif({_MONEY}, '') as m from customer)""",
)
def _(ctx):
    return ctx.base("customer").select("c_custkey", casting.parse_money(F.expr(_MONEY)).alias("eur"))


_DAY_TEXT = """case when o_orderkey % 9 = 0 then '' when o_orderkey % 10 = 0 then '31.12.1999'
               when o_orderkey % 21 = 0 then '1999-02-30' when o_orderkey % 22 = 0 then null
               else cast(cast(o_orderdate as date) as string) end"""


@check(
    "q_dates", "CST-6 CST-7",
    f"""select o_orderkey, cast(try_cast({_DAY_TEXT} as date) as varchar) as parsed,
               cast(cast(o_orderdate as date) as varchar) as day from orders""",
)
def _(ctx):
    return ctx.base("orders").select(
        "o_orderkey", casting.safe_date(F.expr(_DAY_TEXT)).alias("parsed"),
        casting.day_of(F.col("o_orderdate")).alias("day"),
    )


@check(
    "q_event_text", "CST-10 CST-11 CST-12 FLT-13 SCL-13",
    with_ctes(
        ["raw_game_events"],
        r"""select game_event_id, try_cast(regexp_extract(description, '^(\d+)\.', 1) as integer)
                       as season_count,
                   case when description like '%Scored%' then 'scored'
                        when description like '%Missed%' then 'missed' end as penalty_result,
                   cast(try_cast(minute as integer) > 90 as integer) as late, props
            from raw_game_events join (select md5(cast(event_id as varchar)) as id, props
                                       from events) on game_event_id = id""",
    ),
)
def _(ctx):
    payload = F.to_binary("props", F.lit("utf-8"))
    messages = ctx.base("events").select(
        F.md5(F.col("event_id").cast("string")).alias("game_event_id"),
        casting.value_as_string(payload).alias("props"),
    )
    d = F.col("description")
    return ctx.raw("game_events").join(messages, "game_event_id").select(
        "game_event_id", football.season_counter(d).alias("season_count"),
        football.penalty_result(d).alias("penalty_result"),
        casting.flag01(casting.safe_int(F.col("minute")) > 90).alias("late"), "props",
    )


@check(
    "q_json", "CST-9 PRJ-6",
    """select event_id, cast(props->>'$.k' as integer) as k, cast(null as varchar) as missing
       from events where event_id % 10 <> 0
       union all select event_id, null, null from events where event_id % 10 = 0""",
)
def _(ctx):
    """Malformed messages give NULL fields and stay in the result."""
    text = F.when(F.col("event_id") % 10 == 0, F.lit("not json")).otherwise(F.col("props"))
    parsed = F.from_json(text, "k int, missing string")
    return cl.flatten(ctx.base("events").withColumn("data", parsed), "data", "event_id")


# --- NULL rules and filters ----------------------------------------------------------------------


@check(
    "q_null_rules", "NUL-1 NUL-2 NUL-3 NUL-4 NUL-5 NUL-6 NUL-7 NUL-8 NUL-9 NUL-10",
    """select c_custkey, coalesce(seg, 'Unknown') as filled, coalesce(bal, 0) as zero,
              coalesce(bal, c_custkey) as other, nullif(nation, '-1') as nation,
              case when bal between 0 and 5000 then bal end as ranged,
              case when lower(seg) = 'building' then 'Central' when lower(seg) = 'machinery'
                   then 'Forward' else seg end as mapped,
              case when seg is null or seg = '' then 'N/A' else seg end as named,
              case when bal <> 0 then 1000.0::double / bal end as divided,
              coalesce(bal, 0) as point
       from (select c_custkey,
                    case when c_custkey % 5 = 0 then null when c_custkey % 7 = 0 then ''
                         else c_mktsegment end as seg,
                    case when c_custkey % 4 = 0 then null
                         else cast(floor(c_acctbal) as bigint) end as bal,
                    case when c_nationkey = 3 then '-1' else cast(c_nationkey as varchar) end
                        as nation
             from customer)""",
)
def _(ctx):
    rows = ctx.base("customer").selectExpr(
        "c_custkey",
        """case when c_custkey % 5 = 0 then null when c_custkey % 7 = 0 then ''
           else c_mktsegment end as seg""",
        "case when c_custkey % 4 = 0 then null else floor(c_acctbal) end as bal",
        "case when c_nationkey = 3 then '-1' else cast(c_nationkey as string) end as nation",
    )
    seg, bal = F.col("seg"), F.col("bal")
    return rows.select(
        "c_custkey",
        rules.fallback(seg, F.lit("Unknown")).alias("filled"),
        rules.coalesce_zero(bal).alias("zero"),
        rules.fallback(bal, F.col("c_custkey")).alias("other"),
        rules.null_if(F.col("nation"), "-1").alias("nation"),
        rules.null_unless(bal, 0, 5000).alias("ranged"),
        rules.remap(seg, {"building": "Central", "machinery": "Forward"}, True).alias("mapped"),
        rules.blank_to(seg, "N/A").alias("named"),
        rules.safe_div(F.lit(1000.0).cast("double"), bal).alias("divided"),
        rules.falsy_default(bal, 0).alias("point"),
    )


_QUANTITY = "case when l_linenumber = 3 then null else cast(l_quantity as int) end"


@check(
    "q_filters", "FLT-1 FLT-2 FLT-3 FLT-4 FLT-5 FLT-6 FLT-11",
    f"""select 'closed' as kind, l_orderkey, q from (select *, {_QUANTITY} as q from lineitem)
        where q between 5 and 45
        union all
        select 'open', l_orderkey, q from (select *, {_QUANTITY} as q from lineitem)
        where (q is null or q between 5 and 45) and l_returnflag in ('A', 'R')
        union all
        select 'true', l_orderkey, q from (select *, {_QUANTITY} as q from lineitem)
        where l_linestatus = 'F' and q is not null
              and trim(case when l_linenumber = 5 then ' ' else l_returnflag end) <> ''""",
)
def _(ctx):
    rows = ctx.base("lineitem").selectExpr(
        "*", f"{_QUANTITY} as q", "l_linestatus = 'F' as flag",
        "case when l_linenumber = 5 then ' ' else l_returnflag end as text",
    )
    closed = filters.keep_between(rows, "q", 5, 45)
    both = filters.keep_between(rows, "q", 5, 45, keep_null=True)
    opened = filters.keep_in(both, "l_returnflag", ["A", "R"])
    true = filters.keep_nonblank(cl.require(filters.keep_true(rows, "flag"), "q"), "text")
    parts = [
        df.select(F.lit(kind).alias("kind"), "l_orderkey", "q")
        for kind, df in (("closed", closed), ("open", opened), ("true", true))
    ]
    return parts[0].union(parts[1]).union(parts[2])


@check(
    "q_since_last", "FLT-7 JON-8",
    """select event_id, user_id from events
       where ts > (select max(ts) from events where event_type = 'view' and event_id % 3 = 0)
       union all
       select event_id, -1 from events where event_type = 'click'""",
)
def _(ctx):
    events = ctx.base("events").withColumn("ts", F.col("ts").cast("timestamp"))
    seen = events.filter("event_type = 'view' and event_id % 3 = 0")
    newer = filters.since_last(events, seen, "ts").select("event_id", "user_id")
    clicks = events.filter("event_type = 'click'")
    # An empty target and a missing target both let every row through.
    first = filters.since_last(clicks.filter("event_id % 2 = 0"), None, "ts")
    empty = filters.since_last(clicks.filter("event_id % 2 = 1"), clicks.filter("false"), "ts")
    rest = first.union(empty).select("event_id", F.lit(-1).cast("bigint").alias("user_id"))
    return newer.union(rest)


@check(
    "q_regex_violations", "FLT-8",
    """select * from (
         select 'p_brand' as "column", p_brand as value, p_partkey from part
         where not regexp_matches(p_brand, '^Brand#1[0-9]$')
         union all
         select 'p_name', p_name, p_partkey from part where not regexp_matches(p_name, '^[a-m]'))""",
)
def _(ctx):
    patterns = {"p_brand": "^Brand#1[0-9]$", "p_name": "^[a-m]"}
    return filters.regex_violations(ctx.base("part"), patterns, ["p_partkey"])


_BROKEN = {
    "large_quantity": "l_quantity > 45",
    "late_discount": "l_discount > 0.08 and l_linestatus = 'F'",
    "no_tax": "l_tax = 0",
}


@check(
    "q_rule_violations", "FLT-9",
    " union all ".join(
        f"select '{n}' as rule, l_orderkey, l_linenumber from lineitem where {p}"
        for n, p in _BROKEN.items()
    ),
)
def _(ctx):
    broken = {n: F.expr(p) for n, p in _BROKEN.items()}
    return filters.rule_violations(ctx.base("lineitem"), broken, ["l_orderkey", "l_linenumber"])


@check(
    "q_rule_counts", "FLT-9",
    " union all ".join(
        f"select '{n}' as rule, count(*) as violations from lineitem where {p}"
        for n, p in _BROKEN.items()
    ),
)
def _(ctx):
    return filters.rule_counts(ctx.base("lineitem"), {n: F.expr(p) for n, p in _BROKEN.items()})


NOW = dt.datetime(2024, 1, 30, 23, 0)


@check(
    "q_time_range", "FLT-11 FLT-12",
    """select event_id, event_type from events
       where ts between timestamp '2024-01-30 21:00:00' and timestamp '2024-01-30 23:00:00'
         and event_type in ('click', 'purchase', 'view')""",
)
def _(ctx):
    events = ctx.base("events").withColumn("ts", F.col("ts").cast("timestamp"))
    recent = filters.last_hours(events, "ts", 2, NOW)
    return filters.keep_in(recent, "event_type", ["click", "purchase", "view"]).select(
        "event_id", "event_type"
    )


# --- limits --------------------------------------------------------------------------------------


@check(
    "q_top_k", "SRT-1 SRT-2",
    "select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 10",
)
def _(ctx):
    rows = ctx.base("customer").select("c_custkey", "c_acctbal")
    return limits.sort_rows(limits.top_k(rows, "c_acctbal", 10, ["c_custkey"]), "c_custkey")


@check(
    "q_limit_offset", "SRT-3 AGG-19",
    """select 0 as n, min(p_brand) as brand from part
       union all select 1, p_brand from (select distinct p_brand from part order by 1
                                         limit 1 offset 1)""",
)
def _(ctx):
    part = ctx.base("part")
    first, second = (
        limits.nth_distinct(part, "p_brand", n).select(F.lit(n).alias("n"), F.col("p_brand").alias("brand"))
        for n in (0, 1)
    )
    return first.union(second)


@check("q_distinct_values", "AGG-19 SRT-2", "select distinct p_brand from part")
def _(ctx):
    return limits.distinct_values(ctx.base("part"), "p_brand")


@check(
    "q_sample_keys", "SRT-5 SRT-4",
    """select l_orderkey from (select distinct l_orderkey from lineitem)
       order by md5(cast(l_orderkey as varchar) || '/42'), l_orderkey limit 20""",
)
def _(ctx):
    sample = limits.sample_keys(ctx.base("lineitem"), "l_orderkey", 20)
    return limits.head(sample, 20)


# --- scalar functions ----------------------------------------------------------------------------


@check(
    "q_classify", "SCL-14 SCL-16 SCL-17",
    with_ctes(
        ["raw_game_events"],
        """select game_event_id, case
                when coalesce(description, '') = '' then 'substitutions'
                when regexp_matches(lower(description), 'yellow card|second yellow|red card')
                     then 'cards'
                when regexp_matches(lower(description), 'goal|scored|missed|shot|header|penalty'
                                    || '|free kick|tap-in|own-goal') then 'goals'
                else 'substitutions' end as class,
                case when lower(description) like '%red%'
                       or lower(description) like '%second yellow%' then 'red'
                     else 'yellow' end as colour,
                case when try_cast(club_id as integer) = try_cast(player_id as integer) % 100
                     then 'away' else 'home' end as side
           from raw_game_events""",
    ),
)
def _(ctx):
    d = F.col("description")
    club, player = (casting.safe_int(F.col(c)) for c in ("club_id", "player_id"))
    return ctx.raw("game_events").select(
        "game_event_id", football.classify_event(d).alias("class"),
        football.card_colour(d).alias("colour"),
        football.event_side(club, player % 100).alias("side"),
    )


@check(
    "q_scores", "SCL-6 SCL-7 SCL-8 SCL-9 SCL-10",
    """select o_orderkey, h + a as total_goals, h - a as goal_difference,
              coalesce(h > a, false) as home_win, coalesce(h < a, false) as away_win,
              coalesce(h = a, false) as is_draw, cast(h > a as integer) as won,
              case when h > a then 'WIN' when h = a then 'DRAW' else 'LOSS' end as result,
              case when h is null or h = 0 then 'FREE_OR_UNKNOWN' else 'PAID' end as fee
       from (select o_orderkey, nullif(o_orderkey % 5, 4) as h, o_custkey % 4 as a from orders)""",
)
def _(ctx):
    rows = ctx.base("orders").selectExpr(
        "o_orderkey", "nullif(o_orderkey % 5, 4) as h", "o_custkey % 4 as a"
    )
    h, a = F.col("h"), F.col("a")
    m = football.match_measures(h, a)
    return rows.select(
        "o_orderkey", *[c.alias(n) for n, c in m.items()],
        football.result_flags(h, a)["is_win"].alias("won"),
        football.result_label(m["home_win"], m["is_draw"]).alias("result"),
        football.fee_type(h).alias("fee"),
    )


@check(
    "q_seasons", "SCL-2 SCL-3 SCL-4 SCL-5 SCL-18",
    """select o_orderkey,
              case when month(d) >= 7 then year(d) || '/' || right(cast(year(d) + 1 as varchar), 2)
                   else (year(d) - 1) || '/' || right(cast(year(d) as varchar), 2) end as season,
              cast(dayofweek(d) as integer) as day_of_week, strftime(d, '%a') as day_name,
              strftime(d, '%b') as month_name, cast(quarter(d) as integer) as quarter,
              cast(weekofyear(d) as integer) as week,
              cast(2024 - year(d) - case when month(d) * 100 + day(d) > 630 then 1 else 0 end
                   as integer) as age
       from (select o_orderkey, cast(o_orderdate as date) as d from orders)""",
)
def _(ctx):
    d = F.to_date("o_orderdate")
    parts = calendar.date_parts(d)
    return ctx.base("orders").select(
        "o_orderkey", calendar.season_of(d).alias("season"),
        *[parts[n].alias(n) for n in ("day_of_week", "day_name", "month_name", "quarter")],
        parts["week_of_year"].alias("week"), calendar.age(d, AS_OF).alias("age"),
    )
