"""The same results as DuckDB SQL, each found another way than the Spark operator finds it.

Snapshots come from a range join of a year list with the facts, runs of equal values from the
difference between the year and a row number, changes from a self-join on neighbouring years,
and the incremental type 2 table from the full definition.
"""

from __future__ import annotations

from tallybook.sources.tables import FIRST_YEAR, LAST_YEAR

BEFORE = LAST_YEAR - 1


def _class(score: str) -> str:
    bands = " + ".join(f"coalesce({score} > {bound}, false)::int" for bound in (250000, 500000, 800000))
    return f"(['bad', 'average', 'good', 'star'])[1 + {bands}]"


FACTS = """
facts as (
  select c_name as player_name, c_mktsegment as segment, c_nationkey as nation,
         year(o_orderdate)::int as season, count(*)::int as gp,
         sum(o_totalprice::decimal(18,2))::double as pts,
         max(o_totalprice) as reb, min(o_totalprice) as ast
  from orders join customer on c_custkey = o_custkey
  group by all)
"""

SPINE = f"""
spine as (
  select player_name, unnest(range(min(season), {LAST_YEAR + 1}))::int as yr
  from facts group by player_name)
"""

_SNAPS = f"""
snaps as (
  select player_name, any_value(segment) as segment, any_value(nation) as nation,
         {_class('max_by(pts, season)')} as scoring_class,
         (yr - max(season))::int as year_since_last_season,
         yr as current_season,
         max(season) = yr as is_active,
         count(*)::int as n_seasons,
         string_agg(season::varchar, ',' order by season) as seasons,
         sum(gp)::int as all_gp,
         min_by(pts, season) as first_pts,
         max(season) as latest_season,
         max_by(gp, season) as latest_gp,
         max_by(pts, season) as latest_pts,
         max_by(reb, season) as latest_reb,
         max_by(ast, season) as latest_ast
  from spine join facts using (player_name)
  where season <= yr
  group by player_name, yr)
"""
SNAPS = f"{FACTS}, {SPINE}, {_SNAPS}"

# The same without orders that are still pending, of the years that are replayed.
REPLAY = LAST_YEAR - 2
SETTLED = FACTS.replace(
    "group by all", f"where o_orderstatus <> 'P' or year(o_orderdate) < {REPLAY} group by all"
)
SETTLED_SNAPS = f"{SETTLED}, {SPINE}, {_SNAPS}"


def _runs(upto: int, snaps: str = SNAPS) -> str:
    return f"""
    {snaps},
    runs as (
      select player_name, scoring_class, is_active,
             min(current_season) as start_season, max(current_season) as end_season
      from (select *, current_season - row_number() over (
                     partition by player_name, scoring_class, is_active
                     order by current_season) as island
            from snaps where current_season <= {upto})
      group by player_name, scoring_class, is_active, island)
    """


def _stretches() -> str:
    """Year by year: the class record and the year's orders, then years of one record together.
    An open record has one year more than the table, which stands for all that follow."""
    return f"""
    {_runs(LAST_YEAR)},
    years as (
      select player_name, unnest(range(start_season, end_season + if(end_season = {LAST_YEAR}, 2, 1)))::int as yr,
             start_season as record, scoring_class, is_active
      from runs),
    both_sides as (
      select player_name, yr, y.record, y.scoring_class, y.is_active, f.gp, f.season as orders
      from years y full join (select *, season as yr from facts) f using (player_name, yr)),
    stretches as (
      select player_name, min(yr)::int as start_season, max(yr)::int as end_season,
             max(yr) > {LAST_YEAR} as is_open,
             any_value(scoring_class) as scoring_class, any_value(is_active) as is_active,
             any_value(gp) as gp
      from (select *, yr - row_number() over (
                     partition by player_name, record, orders order by yr) as island
            from both_sides)
      group by player_name, record, orders, island)
    """


PAIRED = """
paired as (
  select n.player_name, n.current_season, n.scoring_class, n.is_active,
         p.player_name is not null as had, p.scoring_class as old_class, p.is_active as old_active,
         p.player_name is not null
           and (n.scoring_class <> p.scoring_class or n.is_active <> p.is_active) as changed
  from snaps n left join snaps p
    on p.player_name = n.player_name and p.current_season = n.current_season - 1)
"""

DETAILS = """
details as (
  select l_orderkey as game_id, l_suppkey as player_id, s_name as player_name,
         l_returnflag as team, l_linestatus as start_position, l_quantity as pts,
         l_linenumber as line_no, l_partkey as part_id
  from lineitem join supplier on s_suppkey = l_suppkey),
one_each as (
  select game_id, player_id, arg_min(struct_pack(player_name, team, start_position, pts),
           struct_pack(line_no, part_id, pts, team, start_position)) as r
  from details group by game_id, player_id)
"""

PAIRS = """
pairs as (
  select a.player_id as subject, b.player_id as object,
         if(a.r.team = b.r.team, 'shares_team', 'plays_against') as edge_type,
         any_value(a.r.player_name) as player_name,
         count(*) as num_games, sum(a.r.pts) as subject_points, sum(b.r.pts) as object_points
  from one_each a, one_each b
  where a.game_id = b.game_id and b.player_id < a.player_id and a.r.player_name <> b.r.player_name
  group by all)
"""

USER_EVENTS = """
user_events as (
  select user_id, event_type, ts::date as day, value::decimal(18,2) as value,
         (min(ts) over (partition by user_id))::date as cohort
  from events)
"""


def _additivity(dim: str) -> str:
    return f"""
    select (select sum(n) from (select count(distinct user_id) as n from user_events group by {dim}))::bigint
             as sum_over_members,
           (select count(distinct user_id) from user_events) as total_entities,
           (select count(*) from (select user_id from user_events group by user_id
                                  having min({dim}) <> max({dim}))) as multi_member_entities,
           (select count(*) from (select user_id from user_events group by user_id
                                  having min({dim}) <> max({dim}))) = 0 as is_additive,
           '{dim}' as dimension
    """


_DAYS = """
days as (select distinct user_id, (ts::date - date '2024-01-01')::int as day from events)
"""

_ACTIVITY = f"""
with {_DAYS},
runs as (
  select user_id, count(*) as n from (
    select user_id, day - row_number() over (partition by user_id order by day) as island from days)
  group by user_id, island)
select user_id, 29 as as_of, count(*)::int as days_active, count(*) filter (day > 22)::int as days_of_7,
       count(*) filter (day > 1)::int as days_of_28, max(day) = 29 as is_active,
       (29 - max(day))::int as days_since,
       (select max(n) from runs r where r.user_id = d.user_id)::int as longest_run,
       max(day) = 29 and count(*) filter (day between 26 and 28) = 0 and min(day) < 26 as returned_after_3
from days d group by user_id
"""

# Keys in the order of names: first those of customers known before the last year.
KEYS = f"""
keys as (
  select player_name, row_number() over (order by min(season) = {LAST_YEAR}, player_name) as surrogate_key
  from facts group by player_name)
"""

PROFILES = f"""
profiles as (
  select player_name, season, {_class('pts')} as scoring_class,
         if(gp > 3, 'many', if(gp > 1, 'some', 'one')) as orders
  from facts),
mini as (
  select scoring_class, orders, row_number() over (order by scoring_class, orders) as profile_key
  from (select distinct scoring_class, orders from profiles))
"""

_LAST_FLAT = f"select * from snaps where current_season = {LAST_YEAR}"
_BEFORE_FLAT = f"select * from snaps where current_season = {BEFORE}"

BAG = """
bag as (
  select doc_id, key, kind from (
    select d.doc_id, unnest(['lang', 'n_chars', 'quality', 'toxic']) as key,
           unnest(['STRING', 'BIGINT', 'BIGINT', 'BIGINT']) as kind,
           unnest([lang is not null, n_chars is not null, quality is not null, toxic is not null]) as filled
    from documents d left join labels l on l.doc_id = d.doc_id)
  where filled)
"""

# Every event with all that may be wrong with it: broken JSON, a value of another kind, no
# identifier, an unknown action, a copy of a sound event.
_JUDGED_EVENTS = r"""
        with parsed as (
          select *, props is null or trim(props) = ''
                    or case when json_valid(props) then json_type(props) = 'OBJECT' else false end as is_json,
                 case when json_valid(props) then props->>'k' end as k
          from events),
        typed as (
          select *, case when regexp_full_match(trim(k), '[+-]?\d+') then try_cast(k as int) end as place,
                 try_cast(value as decimal(18,2)) as amount
          from parsed),
        judged as (
          select *, case when not is_json then 'props: not JSON'
                         when k is not null and place is null then 'place: not a int'
                         when value is not null and amount is null then 'amount: not a decimal(18,2)'
                         when event_id is null then 'event_id: missing'
                         when event_type not in ('click', 'view', 'purchase', 'signup')
                         then 'action: not in domain' end as reason
          from typed),
        told as (
          select *, case when reason is not null then reason
                         when row_number() over (
                           partition by reason is null, event_id
                           order by user_id nulls first, event_type nulls first, place nulls first,
                                    amount nulls first, ts::date nulls first) > 1
                         then 'event_id: copy' end as verdict
          from judged)"""

ORACLES: dict[str, str] = {
    "cumulative_step": f"with {SNAPS} {_LAST_FLAT}",
    "cumulative_step_without_activity": f"""
        with {SNAPS} select * exclude (is_active) from snaps where current_season = {LAST_YEAR}""",
    "cumulative_backfill": f"with {SNAPS} select * from snaps",
    "period_spine": f"with {FACTS}, {SPINE} select player_name, yr as season from spine",
    "static_attributes": """
        select c_name as player_name, c_mktsegment as segment, c_nationkey as nation
        from customer where c_custkey in (select o_custkey from orders)""",
    "unnest_history": f"with {FACTS} select player_name, season, gp, pts, reb, ast from facts",
    "snapshot_lookup": f"with {SNAPS} {_BEFORE_FLAT} and player_name = 'Customer#000000007'",
    "snapshot_scan": f"with {SNAPS} {_BEFORE_FLAT}",
    "first_last_season": f"""
        with {FACTS}
        select f.player_name,
               f.season as first_season, f.gp as first_gp, f.pts as first_pts,
               f.reb as first_reb, f.ast as first_ast,
               l.season as latest_season, l.gp as latest_gp, l.pts as latest_pts,
               l.reb as latest_reb, l.ast as latest_ast
        from (select player_name, min(season) as s0, max(season) as s1 from facts group by 1) b
        join facts f on f.player_name = b.player_name and f.season = b.s0
        join facts l on l.player_name = b.player_name and l.season = b.s1""",
    "improvement_ratio": f"""
        with {SNAPS}
        select player_name, round(latest_pts / coalesce(nullif(first_pts, 0), 1), 6) as avg_stats
        from snaps where current_season = {LAST_YEAR} and latest_pts > 800000""",
    "scoring_class": f"""
        with {FACTS} select player_name, season, pts, {_class('pts')} as scoring_class from facts""",
    "recency_activity": f"""
        with {SNAPS}
        select player_name, current_season, is_active, year_since_last_season,
               year_since_last_season as stepped_gap
        from snaps""",
    "change_preview": f"""
        with {SNAPS}, {PAIRED}
        select player_name, current_season, scoring_class, is_active,
               old_class as previous_scoring_class, old_active as previous_is_active
        from paired""",
    "change_streaks": f"""
        with {SNAPS}, {PAIRED}
        select a.player_name, a.current_season, a.scoring_class, a.is_active,
               a.changed::int as change_indicator,
               (select count(*) from paired b where b.player_name = a.player_name
                  and b.changed and b.current_season <= a.current_season) as streak_identifier
        from paired a""",
    "scd2_preview": f"""
        with {_runs(LAST_YEAR)}
        select * from runs r
        where (select count(*) from runs e where e.player_name = r.player_name
                 and e.start_season < r.start_season) >= 2""",
    "scd2_full": f"""
        with {_runs(LAST_YEAR)} select *, {LAST_YEAR} as current_season from runs""",
    "scd2_full_chunked": f"""
        with {_runs(LAST_YEAR)} select *, {LAST_YEAR} as current_season from runs""",
    "scd2_incremental": f"""
        with {_runs(LAST_YEAR)} select *, {LAST_YEAR} as current_season from runs""",
    "cumulative_replay": f"with {SETTLED_SNAPS} select * from snaps where current_season >= {REPLAY}",
    "scd2_correct": f"""
        with {_runs(LAST_YEAR, SETTLED_SNAPS)} select *, {LAST_YEAR} as current_season from runs""",
    "scd2_join": f"""
        with {_stretches()}
        select player_name, start_season, if(is_open, null, end_season) as end_season,
               scoring_class, is_active, gp
        from stretches""",
    "scd2_join_chunked": f"""
        with {_stretches()}
        select player_name, start_season, if(is_open, null, end_season) as end_season,
               scoring_class, is_active, gp
        from stretches where gp is not null and scoring_class is not null""",
    "distinct_rollup": """
        select 'type' as level, event_type, null::varchar as day, count(distinct user_id) as entities
        from events group by event_type
        union all
        select 'day', null, ts::date::varchar, count(distinct user_id) from events group by 3
        union all
        select 'all', null, null, count(distinct user_id) from events""",
    "distinct_estimates": """
        select event_type, count(distinct user_id) as entities, true as hll_is_near, true as theta_is_near
        from events group by event_type""",
    "surrogate_keys": f"with {FACTS}, {KEYS} select * from keys",
    "scd4_profiles": f"with {FACTS}, {PROFILES} select * from mini",
    "scd4_history": f"""
        with {FACTS}, {PROFILES}
        select player_name, profile_key, min(season)::int as start_season, max(season)::int as end_season
        from (select *, row_number() over (partition by player_name order by season)
                        - row_number() over (partition by player_name, profile_key order by season) as island
              from profiles join mini using (scoring_class, orders))
        group by player_name, profile_key, island""",
    "scd6": f"""
        with {_runs(LAST_YEAR)}
        select r.*, {LAST_YEAR} as current_season, n.scoring_class as current_scoring_class,
               n.is_active as current_is_active, r.end_season = {LAST_YEAR} as is_current
        from runs r join snaps n on n.player_name = r.player_name and n.current_season = {LAST_YEAR}""",
    "scd7": f"""
        with {_runs(LAST_YEAR)},
        keyed as (
          select *, row_number() over (order by player_name, start_season) as record_key,
                 dense_rank() over (order by player_name) as durable_key
          from runs)
        select o_orderkey as order_id, year(o_orderdate)::int as season, record_key, durable_key
        from orders join customer on c_custkey = o_custkey
        join keyed on player_name = c_name and year(o_orderdate) between start_season and end_season""",
    "scd2_historical": f"""
        with {_runs(BEFORE)}
        select *, if(end_season = {BEFORE}, 'open', 'closed') as part from runs""",
    "scd2_unchanged": f"""
        with {_runs(LAST_YEAR)}
        select * from runs where end_season = {LAST_YEAR} and start_season < {LAST_YEAR}""",
    "scd2_changed": f"""
        with {_runs(LAST_YEAR)}
        select r.* from runs r
        where r.end_season = {BEFORE}
           or (r.start_season = {LAST_YEAR} and exists (
                 select 1 from runs o where o.player_name = r.player_name
                   and o.end_season = {BEFORE}))""",
    "scd2_new": f"""
        with {SNAPS}
        select player_name, scoring_class, is_active,
               current_season as start_season, current_season as end_season
        from snaps
        group by all having current_season = {LAST_YEAR} and player_name in (
          select player_name from facts group by 1 having min(season) = {LAST_YEAR})""",
    "scd0": f"""
        with {FACTS}
        select distinct on (player_name) player_name, {_class('pts')} as scoring_class, gp
        from facts order by player_name, season""",
    "scd1": f"""
        with {FACTS}
        select distinct on (player_name) player_name, {_class('pts')} as scoring_class, gp
        from facts order by player_name, season desc""",
    "scd3": f"""
        with {FACTS}, ranked as (
          select *, {_class('pts')} as cls,
                 row_number() over (partition by player_name order by season) as up,
                 row_number() over (partition by player_name order by season desc) as down
          from facts)
        select a.player_name, a.cls as original_scoring_class, a.gp as original_gp,
               z.cls as current_scoring_class, z.gp as current_gp
        from ranked a join ranked z using (player_name) where a.up = 1 and z.down = 1""",
    "scd2_asof": f"""
        with {_runs(LAST_YEAR)}
        select o_orderkey as order_id, c_name as player_name, year(o_orderdate)::int as season,
               s.scoring_class, s.is_active, r.start_season, r.end_season
        from orders join customer on c_custkey = o_custkey
        join snaps s on s.player_name = c_name and s.current_season = year(o_orderdate)
        join runs r on r.player_name = c_name
          and s.current_season >= r.start_season and s.current_season <= r.end_season""",
    "scd2_asof_open": f"""
        with {_runs(LAST_YEAR)}
        select o_orderkey as order_id, c_name as player_name, year(o_orderdate)::int as season,
               s.scoring_class, s.is_active, r.start_season,
               if(r.end_season = {LAST_YEAR}, null, r.end_season) as end_season
        from orders join customer on c_custkey = o_custkey
        join snaps s on s.player_name = c_name and s.current_season = year(o_orderdate)
        join runs r on r.player_name = c_name
          and s.current_season >= r.start_season and s.current_season <= r.end_season""",
    "scd2_current": f"""
        with {_runs(LAST_YEAR)}
        select player_name, scoring_class, is_active, start_season,
               case when end_season < {LAST_YEAR} then end_season
                    when style = 'far_future' then 9999 end::int as end_season,
               {LAST_YEAR} as current_season, end_season = {LAST_YEAR} as is_open, style
        from runs, (values ('far_future'), ('null')) t(style)""",
    "overwrite_period": f"with {FACTS} select player_name, season, gp, pts from facts",
    "merge_upsert": f"""
        with {FACTS}
        select player_name, max(season) as season, max_by(gp, season) as gp,
               max_by(pts, season) as pts
        from facts group by player_name""",
    "bounded_window": """
        select event_id, user_id, event_type from events
        where ts::date between date '2024-01-08' and date '2024-01-21'""",
    "missing_partitions": f"""
        select source, period::int as period
        from (values ('orders'), ('lineitem'), ('events')) s(source),
             range({FIRST_YEAR - 2}, 2026) t(period)
        except
        (select 'orders', year(o_orderdate)::int from orders group by all having count(*) > 1
         union all
         select 'lineitem', year(l_shipdate)::int from lineitem group by all having count(*) > 1
         union all
         select 'events', year(ts)::int from events group by all having count(*) > 1)""",
    "depends_on_past": """
        select day::varchar as day from (
          select day, day - lag(day) over (order by day) as step
          from (select distinct o_orderdate::date as day from orders))
        where step is null or step > 1""",
    "snapshot_asof": f"""
        with {SNAPS}
        select o_orderkey as order_id, c_name as player_name, year(o_orderdate)::int as season,
               own.scoring_class as own_scoring_class,
               latest.scoring_class as latest_scoring_class
        from orders join customer on c_custkey = o_custkey
        join snaps own on own.player_name = c_name and own.current_season = year(o_orderdate)
        join snaps latest on latest.player_name = c_name and latest.current_season = {LAST_YEAR}
        where own.scoring_class <> latest.scoring_class""",
    "additivity_check": f"""
        with {USER_EVENTS}
        {_additivity('event_type')} union all {_additivity('day')} union all {_additivity('cohort')}
        """,
    "additivity_by_window": f"""
        with {USER_EVENTS}, pairs as (
          select day, sum(n)::bigint as s
          from (select day, event_type, count(distinct user_id) as n
                from user_events group by all) group by day),
        kinds as (select day, user_id, count(distinct event_type) as k from user_events group by all)
        select pairs.day::varchar as day, any_value(s) as sum_over_members, count(*) as total_entities,
               count(*) filter (k > 1) as multi_member_entities,
               max(k) = 1 as is_additive
        from pairs join kinds using (day) group by pairs.day""",
    "additive_rollup": f"""
        with {USER_EVENTS}
        select 'event_type' as level, event_type as member, sum(value)::double as value,
               count(distinct user_id)::bigint as entities from user_events group by event_type
        union all
        select 'cohort', cohort::varchar, sum(value)::double, count(distinct user_id)::bigint
        from user_events group by cohort""",
    "activity_bits": _ACTIVITY,
    "activity_bits_step": _ACTIVITY,
    "activity_retention": f"""
        with {_DAYS}, firsts as (select user_id, min(day) as cohort from days group by user_id)
        select cohort, n, count(*) as entities, count(d.user_id)::bigint as returned
        from (select *, unnest(range(0, 30 - cohort))::int as n from firsts) f
        left join days d on d.user_id = f.user_id and d.day = f.cohort + f.n
        group by cohort, n""",
    "enum_validate": """
        select 'o_orderstatus' as column_name, o_orderstatus as value, count(*) as n_rows
        from orders group by all having value = 'P'
        union all
        select 'o_orderpriority', o_orderpriority, count(*)
        from orders group by all having o_orderpriority = '4-NOT SPECIFIED'""",
    "enum_candidates": """
        select column_name, distinct_values, distinct_values < 50 as is_candidate from (
          select 'o_orderstatus' as column_name, count(distinct o_orderstatus) as distinct_values from orders
          union all select 'o_orderpriority', count(distinct o_orderpriority) from orders
          union all select 'o_custkey', count(distinct o_custkey) from orders
          union all select 'o_orderdate', count(distinct o_orderdate) from orders)""",
    "enum_subpartition": """
        select y.year, m.o_orderstatus, count(o_orderkey)::bigint as n_rows,
               count(o_orderkey) = 0 as is_missing, m.o_orderstatus <> 'P' as in_domain
        from (select distinct year(o_orderdate)::int as year from orders) y
        cross join (values ('F'), ('O'), ('P'), ('R')) m(o_orderstatus)
        left join orders o on year(o.o_orderdate) = y.year and o.o_orderstatus = m.o_orderstatus
        group by all having count(o_orderkey) > 0 or m.o_orderstatus <> 'P'""",
    "shared_schema": """
        select p_partkey::varchar as id, 'part' as type, p_name as name, null::varchar as nation,
               ((p_brand is not null)::int + (p_size is not null)::int) as n_properties,
               p_brand as brand, p_size::varchar as size, null::varchar as segment from part
        union all
        select s_suppkey::varchar, 'supplier', s_name, s_nationkey::varchar, 0, null, null, null
        from supplier
        union all
        select c_custkey::varchar, 'customer', c_name, c_nationkey::varchar,
               (c_mktsegment is not null)::int, null, null, c_mktsegment from customer""",
    "flexible_schema": """
        select d.doc_id, lang, source,
               ((n_chars is not null)::int + (quality is not null)::int + (toxic is not null)::int)
                 as n_properties,
               n_chars, quality, toxic
        from documents d left join labels l on l.doc_id = d.doc_id""",
    "game_vertices": """
        select o_orderkey::varchar as identifier, 'game' as type,
               o_orderkey % 100 as pts_home, o_custkey % 100 as pts_away,
               case o_orderstatus when 'F' then c_nationkey else (c_nationkey + 1) % 25 end
                 as winning_team
        from orders join customer on c_custkey = o_custkey""",
    "player_vertices": f"""
        with {DETAILS}
        select player_id::varchar as identifier, 'player' as type, min(player_name) as player_name,
               count(*) as number_of_games, sum(pts) as total_points,
               string_agg(distinct team, ',' order by team) as teams
        from details group by player_id""",
    "player_vertices_deduped": f"""
        with {DETAILS}
        select player_id::varchar as identifier, 'player' as type,
               min(r.player_name) as player_name, count(*) as number_of_games,
               sum(r.pts) as total_points, array_to_string(list_sort(list_distinct(list(r.team))), ',') as teams
        from one_each group by player_id""",
    "team_vertices": """
        select n_nationkey::varchar as identifier, 'team' as type, n_name as abbreviation,
               n_name as nickname, r_name as city, r_name as arena, null::int as year_founded
        from nation join region on r_regionkey = n_regionkey""",
    "plays_in_edges": f"""
        with {DETAILS}
        select player_id::varchar as subject_identifier, 'player' as subject_type,
               game_id::varchar as object_identifier, 'game' as object_type,
               'plays_in' as edge_type, r.start_position as start_position, r.pts as pts,
               r.team as team_id, r.team as team_abbreviation
        from one_each""",
    "plays_in_edges_one_game": f"""
        with {DETAILS}
        select player_id::varchar as subject_identifier, 'player' as subject_type,
               min(game_id)::varchar as object_identifier, 'game' as object_type,
               'plays_in' as edge_type, arg_min(r.start_position, game_id) as start_position,
               arg_min(r.pts, game_id) as pts, arg_min(r.team, game_id) as team_id,
               arg_min(r.team, game_id) as team_abbreviation
        from one_each group by player_id""",
    "plays_on_edges": f"""
        with {DETAILS}
        select player_id::varchar as subject_identifier, 'player' as subject_type,
               r.team as object_identifier, 'team' as object_type, 'plays_on' as edge_type,
               count(*) as num_games, sum(r.pts) as points
        from one_each group by player_id, r.team""",
    "player_pair_edges": f"""
        with {DETAILS}, {PAIRS}
        select subject::varchar as subject_identifier, 'player' as subject_type,
               object::varchar as object_identifier, 'player' as object_type, edge_type,
               num_games, subject_points, object_points
        from pairs""",
    "max_points": f"""
        with {DETAILS}
        select r.player_name as player_name, max(trunc(r.pts))::int as max_points
        from one_each group by r.player_name""",
    "opponent_stats": f"""
        with {DETAILS}, {PAIRS},
        career as (select player_id, count(*)::double as games, sum(pts) as points
                   from details group by player_id)
        select subject::varchar as subject_identifier, player_name,
               object::varchar as object_identifier, edge_type,
               round(games / coalesce(nullif(points, 0), 1), 6) as games_per_point,
               round(points / games, 6) as points_per_game, subject_points, num_games
        from pairs join career on player_id = subject""",
    "graph_integrity": f"""
        with {DETAILS},
        lines as (select player_id, game_id, line_no, count(*) as n from details group by all),
        played as (select player_id, game_id, count(*) as n from lines group by all),
        ends as (
          select 'duplicate edge' as problem,
                 player_id || '|player|' || game_id || '|game|plays_in' as key, n
          from played where n > 1
          union all
          select 'duplicate vertex', o_orderkey || '|game', 2 from orders
          union all
          select 'missing vertex', r.team || '|team', count(distinct player_id)
          from one_each group by r.team
          union all
          select 'missing vertex', game_id || '|game', sum(n) from played
          where game_id not in (select o_orderkey from orders) group by game_id)
        select problem, key, n::bigint as n from ends""",
    "fact_dedup": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               strftime(l_shipdate, '%Y-%m-%d') as l_shipdate from (
          select *, count(*) over (
            partition by l_orderkey, l_linenumber
            order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
            rows unbounded preceding) as nth from lineitem)
        where nth = 1""",
    "variant_fill_rates": f"""
        with {BAG}
        select key, count(*) as n_filled, any_value(kind) as value_type,
               2 * count(*) >= (select count(*) from documents) as is_promoted
        from bag group by key""",
    "variant_promotion": f"""
        with {BAG},
        often as (
          select key from bag group by key having 2 * count(*) >= (select count(*) from documents)),
        seldom as (
          select doc_id, string_agg(key, ',' order by key) as keys
          from bag where key not in (from often) group by doc_id)
        select d.doc_id, lang, n_chars, quality, toxic, coalesce(keys, '') as left_in_bag
        from documents d left join labels l on l.doc_id = d.doc_id
        left join seldom s on s.doc_id = d.doc_id""",
    "variant_demotion": f"""
        with {BAG},
        held as (select doc_id, string_agg(key, ',' order by key) as keys from bag group by doc_id)
        select d.doc_id, lang, n_chars, quality, toxic, coalesce(keys, '') as in_bag
        from documents d left join labels l on l.doc_id = d.doc_id
        left join held h on h.doc_id = d.doc_id""",
    "team_reach": f"""
        with recursive {DETAILS},
        ends as (
          select 'player' as kind, player_id::varchar as a, 'game' as bt, game_id::varchar as b
          from one_each
          union select 'player', player_id::varchar, 'team', r.team from one_each),
        ways as (from ends union all select bt, b, kind, a from ends),
        walk as (
          select distinct r.team as seed, 'team' as t, r.team as v, 0 as hops from one_each
          union
          select seed, bt, b, hops + 1 from walk join ways on kind = t and a = v where hops < 3)
        select 'team' as seed_type, seed as seed_identifier, t as type, v as identifier,
               min(hops) as hops
        from walk group by all""",
    "game_reach": f"""
        with {DETAILS}
        select 'player' as seed_type, player_id::varchar as seed_identifier, 'game' as type,
               game_id::varchar as identifier, 1 as hops from one_each
        union
        select 'player', player_id::varchar, 'team', r.team, 1 from one_each
        union
        select 'player', player_id::varchar, 'player', player_id::varchar, 0 from details""",
    "rival_components": f"""
        with recursive {DETAILS}, {PAIRS},
        rivals as (
          select subject::varchar as a, object::varchar as b from pairs
          where 2 * num_games * (select count(*) from pairs)
                > 3 * (select sum(num_games) from pairs)),
        ways as (from rivals union select b, a from rivals),
        walk as (
          select distinct player_id::varchar as v, player_id::varchar as root from details
          union
          select b, root from walk join ways on a = v)
        select 'player' as type, v as identifier, 'player' as component_type,
               min(root) as component_identifier
        from walk group by v""",
    "feed_dedup": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               strftime(l_shipdate, '%Y-%m-%d') as l_shipdate, copies from (
          select *, count(*) over (partition by l_orderkey, l_linenumber) as copies,
                 row_number() over (
                   partition by l_orderkey, l_linenumber
                   order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as nth
          from lineitem)
        where nth = 1""",
    "duplicate_report": """
        select l_orderkey, l_linenumber, count(*) as copies
        from lineitem group by all having count(*) > 1""",
    "fact_denormalize": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               p_name, p_brand, s_name, s_nationkey as nationkey, n_name, n_regionkey as regionkey,
               r_name
        from lineitem
        left join part on p_partkey = l_partkey
        left join supplier on s_suppkey = l_suppkey
        left join nation on n_nationkey = s_nationkey
        left join region on r_regionkey = n_regionkey""",
    "fact_normalize": """
        select l_suppkey, l_returnflag, count(*) over (partition by l_suppkey) as versions
        from (select distinct l_suppkey, l_returnflag from lineitem)""",
    "fact_normalize_narrow": "select l_orderkey, l_linenumber, l_suppkey, l_quantity from lineitem",
    "raw_logs_to_facts": f"""
        {_JUDGED_EVENTS}
        select event_id, user_id, event_type as action, place, amount::double as amount,
               strftime(ts, '%Y-%m-%d') as happened_on
        from told where verdict is null""",
    "raw_logs_rejects": f"""
        {_JUDGED_EVENTS}
        select event_id, event_type, verdict as reason from told where verdict is not null""",
    "fact_five_w": """
        select user_id as who, event_type as what, quality as where,
               strftime(ts, '%Y-%m-%d') as when, 'log' as how
        from events left join labels on doc_id = event_id""",
    "fact_five_w_fill_rates": """
        with n as (select count(*) as total, count(quality) as placed
                   from events left join labels on doc_id = event_id)
        select column_name, total as total_rows,
               if(column_name = 'where', placed, total) as filled_rows,
               round(if(column_name = 'where', placed, total) / total, 6) as fill_rate
        from n, (values ('who'), ('what'), ('where'), ('when'), ('how')) c(column_name)""",
    "retention_filter": """
        select event_id, user_id from events
        where ts::date >= date '2024-01-20'""",
}
