"""The registered queries in plain SQL over the given tables, as an independent check."""

from __future__ import annotations

DISPATCH = """
dispatch as (
  select time_bucket(interval '30 minutes', ts) as trading_interval, cast(user_id as varchar) as unit_id,
         value as generated_mw,
         case event_type when 'view' then 'Coal' when 'click' then 'Gas' when 'purchase' then 'Solar'
                         when 'signup' then 'Wind' when 'error' then 'Hydro' end as fuel_type,
         ts as ingested_at, event_id
  from events)"""

DEDUPED = (
    DISPATCH
    + """,
d as (
  select * exclude (rn) from (
    select *, row_number() over (partition by trading_interval, unit_id
                                 order by ingested_at desc, event_id desc) as rn from dispatch) z
  where rn = 1)"""
)

UNITS = """
units as (
  select cast(c_custkey as varchar) as unit_id, c_mktsegment as fuel_type, c_name as station_name,
         cast(c_nationkey as varchar) as region_id,
         date '2024-01-01' + cast(c_custkey % 30 as integer) as trading_date
  from customer)"""

REGIONS = """
regions as (
  select cast(n_nationkey as varchar) as region_id, r_name || ' / ' || n_name as region_name,
         date '2024-01-01' + n_nationkey as trading_date
  from nation join region on n_regionkey = r_regionkey)"""

SILVER = (
    DEDUPED
    + ","
    + UNITS
    + """,
silver as (
  select d.trading_interval, d.unit_id, d.generated_mw, d.fuel_type, cast(d.trading_interval as date) as trading_date,
         u.station_name
  from d left join units u on d.unit_id = u.unit_id)"""
)

SHARES = (
    DEDUPED
    + """,
shares as (
  select trading_interval as event_time,
         sum(case when fuel_type = 'Solar' then generated_mw end) / nullif(sum(generated_mw), 0) as solar_share
  from d group by trading_interval)"""
)

COAL = (
    DEDUPED
    + """,
coal as (
  select trading_interval as t,
         100 * sum(case when fuel_type = 'Coal' then generated_mw end) / nullif(sum(generated_mw), 0) as p
  from d group by trading_interval)"""
)

MIX = (
    DEDUPED
    + """,
mix as (
  select trading_interval, lower(fuel_type) as source, sum(generated_mw) as mw,
         100 * sum(generated_mw) / nullif(sum(sum(generated_mw)) over (partition by trading_interval), 0) as percent
  from d group by trading_interval, fuel_type)"""
)

MESSAGE = "trading_interval, unit_id, generated_mw, fuel_type"

# Pairs of neighbouring samples per source with the increase between them.
PAIRS = (
    DISPATCH
    + """,
lagged as (
  select lower(fuel_type) as source, ingested_at as ts, generated_mw as v,
         lag(generated_mw) over w as pv, lag(ingested_at) over w as pts
  from dispatch window w as (partition by fuel_type order by ingested_at)),
pairs as (
  select source, ts, pts, pv, case when v >= pv then v - pv else v end as inc from lagged where pts is not null)"""
)

INSTANTS = (
    PAIRS
    + """,
ends as (
  select source, time_bucket(interval '30 minutes', min(ts) + interval '29 minutes 59.999999 seconds') as a,
         time_bucket(interval '30 minutes', max(ts)) as b
  from lagged group by source),
instants as (select source, unnest(generate_series(a, b, interval '30 minutes')) as ts from ends where a <= b),
rates as (
  select i.source, i.ts, round(sum(p.inc) / 21600, 8) as rate
  from instants i join pairs p
    on p.source = i.source and p.ts <= i.ts and p.pts >= i.ts - interval '6 hours'
  group by i.source, i.ts)"""
)


def stretches(rows: str, labels: str, step: str, having: str, peak: str = "") -> str:
    """Gaps and islands over ``rows`` (columns t, br and the labels), ending in the CTE ``found``."""
    by = f"partition by {labels}" if labels else ""
    cols = f"{labels}, " if labels else ""
    return f"""
{rows},
seen as (select *, lag(t) over (w) as pt, lag(br) over (w) as pb, lead(t) over (w) as nt, lead(br) over (w) as nb
         from judged window w as ({by} order by t)),
marked as (select *, sum(case when br and coalesce(pb, false) and t - pt <= interval '{step}' then 0 else 1 end)
                    over ({by} order by t rows unbounded preceding) as isl from seen),
found as (select {cols}min(t) as started_at, max(t) as ended_at, count(*) as n, {peak}
            max(case when not nb and nt - t <= interval '{step}' then nt end) as false_at
          from marked where br group by {cols}isl having {having}),
named as (select {cols}started_at, ended_at, n, {"peak," if peak else ""}
                 coalesce(false_at, ended_at + interval '5 minutes') as resolved_at from found)"""


def coal_stretches(threshold: int, having: str) -> str:
    judged = COAL + f", judged as (select t, p, coalesce(p > {threshold}, false) as br from coal)"
    return stretches(judged, "", "30 minutes", having, "max(p) as peak,")


RUNS = "judged as (select cast(user_id as varchar) as job, ts as t, event_type = 'error' as br from events)"
FAILURES = stretches(RUNS, "job", "1 day", "max(t) - min(t) >= interval '1 minute'")


def check(name: str, column: str, total: str, bad: str, mostly: str, rows: str) -> str:
    return f"""
select '{name}' as name, '{column}' as "column", cast({total} as bigint) as element_count,
       cast({bad} as bigint) as unexpected_count,
       coalesce(cast({bad} as double) / nullif({total}, 0), 0) <= 1 - {mostly} + 1e-12 as success from {rows}"""


def suite(rows: str, tolerance: dict[str, str]) -> str:
    fuels = "('Coal', 'Gas', 'Hydro', 'Wind', 'Solar')"

    def null_check(column: str) -> str:
        bad = f"count(case when {column} is null then 1 end)"
        return check("column_values_to_not_be_null", column, "count(*)", bad, tolerance.get(column, "1.0"), rows)

    repeated = f"(select count(*) as n from {rows} group by trading_interval, unit_id) q"
    parts = [
        null_check("trading_interval"),
        null_check("unit_id"),
        null_check("generated_mw"),
        check("column_values_to_be_of_type", "generated_mw", "count(*)", "0", "1.0", rows),
        check(
            "column_values_to_be_between",
            "generated_mw",
            "count(generated_mw)",
            "count(case when not generated_mw between 0 and 10000 then 1 end)",
            "1.0",
            rows,
        ),
        null_check("fuel_type"),
        check(
            "column_values_to_be_in_set",
            "fuel_type",
            "count(fuel_type)",
            f"count(case when fuel_type not in {fuels} then 1 end)",
            "1.0",
            rows,
        ),
        check(
            "compound_columns_to_be_unique",
            "trading_interval,unit_id",
            "sum(n)",
            "coalesce(sum(case when n > 1 then n end), 0)",
            "1.0",
            repeated,
        ),
    ]
    return " union all ".join(parts)


def model_test(model: str, column: str, test: str, rows: str) -> str:
    failing = {
        "not_null": f"select count(*) from {rows} where {column} is null",
        "accepted_range": f"select count(*) from {rows} where {column} < 0",
        "unique": f"select count(*) from (select {column} from {rows} where {column} is not null "
        f"group by {column} having count(*) > 1) q",
    }[test]
    return f"""
select '{model}' as model, '{column}' as "column", '{test}' as test, ({failing}) as failures,
       ({failing}) = 0 as passed"""


LINEAR = """
h as (
  select event_time as origin_time, solar_share as y,
         epoch(event_time) / 1800 - epoch(timestamp '2024-01-01') / 1800 as x
  from shares where solar_share is not null),
fits as (
  select origin_time, x, count(y) over w as n, regr_slope(y, x) over w as slope, regr_intercept(y, x) over w as base
  from h window w as (order by origin_time range between interval '14 days' preceding and current row))"""

BY_SOURCE_LAST = """
h as (
  select source, trading_interval as t, percent as y from mix where percent is not null),
o as (select source, max(t) as origin_time from h group by source),
w as (select h.*, o.origin_time from h join o on h.source = o.source and h.t >= o.origin_time - interval '14 days')"""


TERMS = 16


def features(at: str, age: str) -> list[str]:
    """Level, trend, four pairs of a day and three of a week; ``at`` in seconds, ``age`` in windows."""
    waves = [(86400, k) for k in range(1, 5)] + [(604800, k) for k in range(1, 4)]
    return ["1.0", f"{age} + 1"] + [f"{f}(2 * pi() * {k} * ({at} % {p}) / {p})" for p, k in waves for f in ("sin", "cos")]


def least_squares(points: str, by: str) -> str:
    """Normal equations per group of ``points`` (``t``, ``y``, ``origin_time``), solved by elimination: CTE ``fits``."""
    upper = [(i, j) for i in range(TERMS) for j in range(i, TERMS)]
    xs = ", ".join(
        f"{x} as x{i}"
        for i, x in enumerate(features("epoch(t)", "(epoch(t) - epoch(origin_time)) / 1209600"))
    )
    ridge = lambda i, j: " + 0.01" if i == j and i > 1 else ""
    sums = [f"sum(x{i} * x{j}){ridge(i, j)} as g{i}_{j}" for i, j in upper] + [f"sum(y * x{i}) as c{i}" for i in range(TERMS)]
    steps = [
        f"terms as (select {by}, origin_time, y, {xs} from {points})",
        f"e0 as materialized (select {by}, origin_time, count(*) as n, {', '.join(sums)} from terms group by {by}, origin_time"
        " having count(*) >= 2)",
    ]
    for p in range(TERMS - 1):
        rows = [f"g{i}_{j} - g{p}_{i} * g{p}_{j} / g{p}_{p} as g{i}_{j}" if i > p else f"g{i}_{j}" for i, j in upper]
        right = [f"c{i} - g{p}_{i} * c{p} / g{p}_{p} as c{i}" if i > p else f"c{i}" for i in range(TERMS)]
        steps.append(f"e{p + 1} as materialized (select {by}, origin_time, n, {', '.join(rows + right)} from e{p})")
    source = f"e{TERMS - 1}"
    for i in reversed(range(TERMS)):
        known = "".join(f" - g{i}_{j} * b{j}" for j in range(i + 1, TERMS))
        steps.append(f"s{i} as materialized (select *, (c{i}{known}) / g{i}_{i} as b{i} from {source})")
        source = f"s{i}"
    return ",\n".join(steps)


def additive(digits: int, by: str) -> str:
    """Forecasts of the fits."""
    future = features("(epoch(origin_time) + 1800 * s)", "s / 672.0")
    yhat = " + ".join(f"b{i} * ({x})" for i, x in enumerate(future))
    return f"""
        select {by} origin_time, n, cast(s as integer) as step, origin_time + s * interval '30 minutes' as event_time,
               round({yhat}, {digits}) as yhat
        from s0, range(1, 49) r(s)"""


def dim_upsert(source: str, key: str, name: str, extra: str) -> str:
    return f"""
with {source},
tgt as (select * from src where trading_date < date '2024-01-15'),
batch as (select {key}, trading_date, {name} || '_v2' as {name}{extra} from src
          where trading_date >= (select max(trading_date) from tgt))
select {key}, trading_date, {name}{extra} from batch
union all
select {key}, trading_date, {name}{extra} from tgt where {key} not in (select {key} from batch)"""


BRONZE_CHECKS = suite("dispatch", {})

ORACLES: dict[str, str] = {
    "dedupe_dispatch": f"with {DEDUPED} select {MESSAGE} from d",
    "enrich_units": f"with {SILVER} select {MESSAGE}, station_name from silver",
    "solar_share": f"with {SHARES} select event_time, round(solar_share, 6) as solar_share from shares",
    "solar_share_filled": f"""with {DEDUPED}
        select trading_interval as event_time,
               round(sum(case when fuel_type = 'Solar' then generated_mw else 0 end)
                     / nullif(sum(generated_mw), 0), 6) as solar_share
        from d group by trading_interval""",
    "csv_parse": f"with {DISPATCH} select {MESSAGE}, cast(trading_interval as date) as trading_date from dispatch",
    "csv_quarantine": f"""with {DISPATCH},
        c as (select *, case when generated_mw > 200 then 'extra' when generated_mw < 2 then 'short'
                             when fuel_type = 'Hydro' then 'time' when fuel_type = 'Wind' then 'number'
                             else 'good' end as kind from dispatch)
        select event_id, case when kind <> 'time' then trading_interval end as trading_interval, unit_id,
               case when kind in ('short', 'number') then null when kind = 'time' then 1.0 else generated_mw end
                 as generated_mw,
               case when kind <> 'short' then fuel_type end as fuel_type, kind <> 'good' as quarantined from c""",
    "feed_rows": f"with {DISPATCH} select unit_id as key, {MESSAGE} from dispatch",
    "solar_share_json": f"""with {SHARES}
        select strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, round(solar_share, 6) as solar_share
        from shares""",
    "share_json_parse": f"""with {SHARES}
        select event_time, round(solar_share, 6) as solar_share from shares where solar_share is not null""",
    "metadata_load": f"""with {UNITS}, {REGIONS}
        select 'unit' as kind, unit_id as id, station_name as name, fuel_type from units
        union all select 'region', region_id, region_name, null from regions""",
    "silver_tables": f"""with {SILVER}
        select {MESSAGE}, trading_date, station_name,
               round(sum(case when fuel_type = 'Solar' then generated_mw end) over w
                     / nullif(sum(generated_mw) over w, 0), 6) as solar_share
        from silver window w as (partition by trading_interval)""",
    "incremental_slice": f"""with {SILVER}
        select {MESSAGE}, trading_date from silver
        where trading_interval >= (select max(trading_interval) from silver where trading_date < date '2024-01-15')""",
    "incremental_late": f"""with {SILVER},
        m as (select max(trading_interval) as m from silver where trading_date < date '2024-01-15')
        select {MESSAGE}, trading_date, trading_interval < m as late from silver, m
        where trading_interval >= m - interval '2 days'""",
    "fact_incremental": f"""with {SILVER}
        select trading_interval, unit_id, fuel_type, trading_date,
               case when trading_interval >= (select max(trading_interval) from silver
                                              where trading_date < date '2024-01-15')
                    then generated_mw + 1 else generated_mw end as generated_mw
        from silver""",
    "dim_unit_upsert": dim_upsert(
        UNITS + ", src as (select unit_id, trading_date, station_name as unit_name, region_id from units)",
        "unit_id",
        "unit_name",
        ", region_id",
    ),
    "dim_region_upsert": dim_upsert(
        REGIONS + ", src as (select region_id, trading_date, region_name from regions)", "region_id", "region_name", ""
    ),
    "generation_by_unit_fuel": f"""with {DISPATCH}
        select trading_interval, unit_id, fuel_type, round(sum(generated_mw), 4) as generated_mw
        from dispatch group by all""",
    "star_generation": f"""with {SILVER}, {REGIONS}
        select r.region_name, s.fuel_type, round(sum(s.generated_mw), 4) as generated_mw, count(*) as n
        from silver s left join units u on s.unit_id = u.unit_id left join regions r on u.region_id = r.region_id
        group by all""",
    "daily_run": f"""with {SILVER}, {REGIONS}
        select s.trading_interval, s.unit_id, s.generated_mw, s.fuel_type, s.trading_date, s.station_name as unit_name,
               r.region_name
        from silver s left join units u on s.unit_id = u.unit_id left join regions r on u.region_id = r.region_id""",
    "daily_run_rejected": f"""with {DISPATCH},
        k as (select count(*) as n from dispatch group by trading_interval, unit_id)
        select 'metadata' as stage, cast(1 as integer) as status union all select 'bronze', 1
        union all select 'bronze_gate', cast(max(n) <= 1 as integer) from k""",
    "daily_rerun": f"""with {DISPATCH},
        parts as (select *, cast(ingested_at >= timestamp '2024-01-15 12:15:00' as integer) as run from dispatch),
        seen as (select p.*, r.run as upto from parts p, (values (0), (1)) r(run) where p.run <= r.run),
        newest as (select * from (select *, row_number() over (partition by upto, trading_interval, unit_id
                                                             order by ingested_at desc, event_id desc) as rn from seen) z
                 where rn = 1),
        shares as (select upto, trading_interval,
                          sum(case when fuel_type = 'Solar' then generated_mw end) / nullif(sum(generated_mw), 0) as s
                   from newest group by all)
        select n.upto as run, strftime(n.trading_interval, '%Y-%m-%d %H:%M:%S') as event_time,
               round(n.s, 6) as solar_share
        from shares n left join shares o on o.upto = n.upto - 1 and o.trading_interval = n.trading_interval
        where o.upto is null or round(n.s, 9) is distinct from round(o.s, 9)""",
    "silver_by_arrival": f"""with {SILVER} select {MESSAGE}, trading_date, station_name from silver""",
    "dq_bronze": f"with {DISPATCH} {BRONZE_CHECKS}",
    "dq_silver": f"""with {SILVER} {suite("silver", {"trading_interval": "0.99", "unit_id": "0.99",
                                                       "generated_mw": "0.98", "fuel_type": "0.95"})}""",
    "dq_narrow": f"with {DISPATCH} "
    + " union all ".join(
        [
            check(
                "column_values_to_be_between",
                "generated_mw",
                "count(generated_mw)",
                "count(case when not generated_mw between 0 and 100 then 1 end)",
                "1.0",
                "dispatch",
            ),
            check(
                "column_values_to_be_between",
                "generated_mw",
                "count(generated_mw)",
                "count(case when generated_mw < 1 then 1 end)",
                "0.95",
                "dispatch",
            ),
            check(
                "column_values_to_be_in_set",
                "fuel_type",
                "count(fuel_type)",
                "count(case when fuel_type not in ('Coal', 'Gas', 'Hydro', 'Wind') then 1 end)",
                "0.75",
                "dispatch",
            ),
            check("column_values_to_be_of_type", "unit_id", "count(*)", "count(*)", "1.0", "dispatch"),
        ]
    ),
    "dq_compound_unique": """
        select cast(sum(n) as bigint) as total, cast(coalesce(sum(case when n > 1 then n end), 0) as bigint) as bad
        from (select count(*) as n from lineitem group by l_orderkey, l_linenumber) q""",
    "dq_checkpoint": f"""with {DISPATCH}
        select 'bronze_checkpoint' as checkpoint, 'run-1' as run_id, q.* from ({BRONZE_CHECKS}) q""",
    "dq_layer_job": f"with {SILVER} select {MESSAGE}, trading_date, station_name from silver",
    "dq_layer_job_failed": f"""with {DISPATCH},
        k as (select count(*) as n from dispatch group by trading_interval, unit_id)
        select 'compound_columns_to_be_unique(trading_interval,unit_id): ' || sum(case when n > 1 then n end) || '/'
               || sum(n) as failed from k""",
    "dbt_tests": f"with {SILVER}, {REGIONS} "
    + " union all ".join(
        model_test(*test)
        for test in [
            ("raw_fact_dispatch", "trading_interval", "not_null", "silver"),
            ("raw_fact_dispatch", "unit_id", "not_null", "silver"),
            ("raw_fact_dispatch", "unit_id", "unique", "silver"),
            ("raw_dim_unit", "unit_id", "not_null", "units"),
            ("raw_dim_unit", "unit_id", "unique", "units"),
            ("raw_dim_region", "region_id", "not_null", "regions"),
            ("raw_dim_region", "region_id", "unique", "regions"),
            ("fact_dispatch", "trading_date", "not_null", "silver"),
            ("fact_dispatch", "generated_mw", "not_null", "silver"),
            ("fact_dispatch", "generated_mw", "accepted_range", "silver"),
            ("dim_unit", "unit_id", "not_null", "units"),
            ("dim_unit", "unit_id", "unique", "units"),
            ("dim_region", "region_id", "not_null", "regions"),
            ("dim_region", "region_id", "unique", "regions"),
        ]
    ),
    "schema_drift": """
        select 'unit_id' as "column", 'type' as kind, 'bigint' as expected, 'string' as actual,
               count(user_id) as affected_rows from events
        union all select 'trading_date', 'missing', 'date', null, count(*) from events
        union all select 'event_id', 'extra', null, 'bigint', count(event_id) from events""",
    "generation_mix": f"""with {MIX}
        select trading_interval, source, round(mw, 4) as mw, round(percent, 4) as percent from mix""",
    "coal_percent": f"with {COAL} select t as trading_interval, round(p, 6) as percent from coal",
    "counter_rate": f"""with {PAIRS},
        sums as (select source, ts, pts, sum(inc) over w as s, first_value(inc) over w as i0,
                        first_value(ts) over w as t0, first_value(pts) over w as p0
                 from pairs
                 window w as (partition by source order by ts range between interval '6 hours' preceding
                              and current row))
        select source, ts,
               round(greatest(s - case when p0 < ts - interval '6 hours' then i0 else 0 end, 0) / 21600, 8) as rate
        from sums where pts >= ts - interval '6 hours'""",
    "generation_mix_rate": f"with {INSTANTS} select source, ts, rate from rates",
    "counter_rate_extrapolated": f"""with {INSTANTS.rsplit("rates as", 1)[0]}
        inside as (
          select i.source, i.ts, sum(p.inc) as inc, count(*) as n, min(p.pts) as t0, max(p.ts) as t1,
                 min_by(p.pv, p.pts) as v0
          from instants i join pairs p
            on p.source = i.source and p.ts <= i.ts and p.pts >= i.ts - interval '6 hours'
          group by i.source, i.ts),
        timed as (
          select *, epoch_us(t1) - epoch_us(t0) as covered, (epoch_us(t1) - epoch_us(t0)) / n as gap,
                 epoch_us(t0) - epoch_us(ts) + 21600000000 as to_start, epoch_us(ts) - epoch_us(t1) as to_end
          from inside),
        sides as (
          select *, case when to_start >= 1.1 * gap then gap / 2 else to_start end as l,
                 case when to_end >= 1.1 * gap then gap / 2 else to_end end as r from timed)
        select source, ts,
               cast(inc * (covered + case when inc > 0 and covered * v0 / inc < l then covered * v0 / inc else l end + r)
                     / covered / 21600 as float) as rate
        from sides""",
    "coal_share_rate": f"""with {INSTANTS}
        select ts, round(100 * sum(case when source = 'coal' then rate end) / nullif(sum(rate), 0), 4) as percent
        from rates group by ts""",
    "instant_sum": f"""with {DISPATCH}
        select round(sum(v), 4) as value
        from (select max_by(generated_mw, ingested_at) as v from dispatch group by unit_id) q""",
    "instant_avg": f"""with {DISPATCH}
        select round(avg(v), 4) as value
        from (select max_by(generated_mw, ingested_at) as v from dispatch group by unit_id) q""",
    "coal_alert": f"""with {coal_stretches(60, "max(t) - min(t) >= interval '30 minutes'")}
        select 'HighCoalPercentage' as alertname, 'warning' as severity, * exclude (peak), round(peak, 4) as peak
        from named""",
    "coal_alert_intervals": f"""with {coal_stretches(30, "count(*) >= 3")}
        select 'HighCoalPercentage' as alertname, 'warning' as severity, * exclude (peak), round(peak, 4) as peak
        from named""",
    "coal_rate_alert": f"""with {stretches(
        INSTANTS + """,
judged as (select ts as t, p, coalesce(p > 30, false) as br
           from (select ts, round(100 * sum(case when source = 'coal' then r end) / nullif(sum(r), 0), 6) as p
                 from (select i.source, i.ts, sum(p.inc) / 21600 as r
                       from instants i join pairs p
                         on p.source = i.source and p.ts <= i.ts and p.pts >= i.ts - interval '6 hours'
                       group by i.source, i.ts) q group by ts) z)""",
        "", "30 minutes", "max(t) - min(t) >= interval '5 minutes'", "max(p) as peak,")}
        select 'HighCoalPercentage' as alertname, 'warning' as severity, * exclude (peak), round(peak, 4) as peak
        from named""",
    "run_failure_alert": f"""with {FAILURES}
        select 'PipelineFailure' as alertname, 'critical' as severity, * from named""",
    "batch_duration_alert": """
        select cast(user_id as varchar) as unit_id, cast(ts as date) as run_date, min(ts) as started_at,
               max(ts) as finished_at
        from events group by 1, 2 having max(ts) > min(ts) + interval '10 minutes'""",
    "alert_groups": f"""
        select 'HighCoalPercentage' as alertname, count(*) as alerts, min(started_at) as first_started_at,
               max(resolved_at) as last_resolved_at
        from (with {coal_stretches(30, "count(*) >= 3")} select * from named) q
        union all
        select 'PipelineFailure', count(*), min(started_at), max(resolved_at)
        from (with {FAILURES} select * from named) q""",
    "history_window": """
        select ts, count(value) over w as n, round(sum(value) over w, 4) as sum_y
        from events window w as (order by ts range between interval '14 days' preceding and current row)""",
    "history_window_by_type": """
        select event_type, ts, count(value) over w as n, round(sum(value) over w, 4) as sum_y
        from events
        window w as (partition by event_type order by ts range between interval '14 days' preceding and current row)""",
    "future_frame": f"""with {SHARES}
        select event_time as origin_time, cast(s as integer) as step, event_time + s * interval '30 minutes' as event_time
        from shares, range(1, 49) r(s)""",
    "forecast_linear": f"""with {SHARES}, {LINEAR}
        select origin_time, n, cast(s as integer) as step, origin_time + s * interval '30 minutes' as event_time,
               round(base + slope * (x + s), 6) as yhat
        from fits, range(1, 49) r(s) where n >= 2""",
    "forecast_linear_last": f"""with {MIX}, {BY_SOURCE_LAST},
        fits as (select source, origin_time, count(*) as n,
                        regr_slope(y, (epoch(t) - epoch(origin_time)) / 1800) as slope,
                        regr_intercept(y, (epoch(t) - epoch(origin_time)) / 1800) as base
                 from w group by source, origin_time having count(*) >= 2)
        select source, origin_time, n, cast(s as integer) as step, origin_time + s * interval '30 minutes' as event_time,
               round(base + slope * s, 4) as yhat
        from fits, range(1, 49) r(s)""",
    "forecast_seasonal": f"""with {SHARES},
        h as (select event_time as t, solar_share as y, (epoch(event_time) % 86400) // 1800 as slot
              from shares where solar_share is not null),
        o as (select t as origin_time, count(*) over (order by t range between interval '14 days' preceding
                                                       and current row) as n from h),
        f as (select origin_time, n, cast(s as integer) as step, origin_time + s * interval '30 minutes' as event_time
              from o, range(1, 49) r(s) where n >= 2)
        select f.origin_time, f.n, f.step, f.event_time, round(avg(h.y), 6) as yhat
        from f join h on h.slot = (epoch(f.event_time) % 86400) // 1800
                     and h.t between f.origin_time - interval '14 days' and f.origin_time
        group by all""",
    "forecast_seasonal_last": f"""with {MIX}, {BY_SOURCE_LAST},
        means as (select source, (epoch(t) % 86400) // 1800 as slot, avg(y) as m from w group by all),
        fits as (select source, origin_time, count(*) as n from w group by all having count(*) >= 2),
        f as (select source, origin_time, n, cast(s as integer) as step,
                     origin_time + s * interval '30 minutes' as event_time from fits, range(1, 49) r(s))
        select f.source, f.origin_time, f.n, f.step, f.event_time, round(m.m, 4) as yhat
        from f join means m on m.source = f.source and m.slot = (epoch(f.event_time) % 86400) // 1800""",
    "forecast_additive": f"""with {SHARES},
        h as (select event_time as t, solar_share as y from shares where solar_share is not null),
        w as (select 0 as one, p.t, p.y, o.t as origin_time
              from h o join h p on p.t between o.t - interval '14 days' and o.t),
        {least_squares("w", "one")}
        {additive(4, "")}""",
    "forecast_additive_last": f"""with {MIX}, {BY_SOURCE_LAST},
        {least_squares("w", "source")}
        {additive(4, "source,")}""",
    "forecast_mape": f"""with {SHARES}, {LINEAR},
        p as (select solar_share as y, base + slope * (x + 1) as yhat
              from fits join shares on event_time = origin_time + interval '30 minutes'
              where n >= 2 and solar_share is not null)
        select count(nullif(y, 0)) as pairs, round(avg(abs((y - yhat) / nullif(y, 0))) * 100, 4) as mape,
               avg(abs((y - yhat) / nullif(y, 0))) * 100 > 20 as drifted
        from p""",
    "forecast_drift_alert": f"""with {MIX},
        h as (select source, trading_interval as t, percent as y, epoch(trading_interval) / 1800 - 946728 as x
              from mix where percent is not null),
        fits as (select source, t, x, count(y) over w as n, regr_slope(y, x) over w as slope,
                        regr_intercept(y, x) over w as base
                 from h
                 window w as (partition by source order by t range between interval '14 days' preceding
                              and current row)),
        p as (select f.source, h.y, f.base + f.slope * (f.x + 1) as yhat
              from fits f join h on h.source = f.source and h.t = f.t + interval '30 minutes' where f.n >= 2)
        select 'ForecastError' as alertname, 'warning' as severity, source, count(nullif(y, 0)) as pairs,
               round(avg(abs((y - yhat) / nullif(y, 0))) * 100, 4) as mape
        from p group by source having avg(abs((y - yhat) / nullif(y, 0))) * 100 > 20""",
    "changed_payloads": """
        select page_id from (select page_id, html, lag(html) over (order by page_id) as before,
                                    row_number() over (order by page_id) as rn from pages) q
        where rn = 1 or html is distinct from before""",
    "payload_text": "select page_id, html as content, md5(html) as digest from pages",
    "model_view": f"""with {DISPATCH},
        g as (select trading_interval, unit_id, fuel_type, sum(generated_mw) as mw from dispatch group by all)
        select unit_id, fuel_type, round(max(mw), 4) as peak from g group by all""",
    "changed_payloads_by_feed": """
        select event_id, user_id, event_type
        from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as before from events) q
        where event_type is distinct from before""",
    "bronze_stream": f"""with {DISPATCH}
        select trading_interval, unit_id, generated_mw, case when fuel_type <> 'Wind' then fuel_type end as fuel_type,
               case when fuel_type <> 'Wind' then cast(trading_interval as date) end as trading_date,
               fuel_type = 'Wind' as quarantined
        from dispatch""",
    "feed_stream": f"with {DISPATCH} select {MESSAGE} from dispatch",
    "stream_dedupe": f"""with {DISPATCH}
        select {MESSAGE}, cast(trading_interval as date) as trading_date, ingested_at, event_id
        from (select *, row_number() over (partition by trading_interval, unit_id order by ingested_at, event_id) as rn
              from dispatch) z where rn = 1""",
    "stream_dedupe_watermark": f"with {DISPATCH} select distinct trading_interval, unit_id from dispatch",
    "changed_payloads_stream": """
        select event_id, user_id, event_type
        from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as before from events) q
        where event_type is distinct from before""",
    "stream_upsert": f"with {DEDUPED} select {MESSAGE} from d",
    "forecast_stream": f"""with {SHARES}, {LINEAR}
        select origin_time, n, cast(s as integer) as step, origin_time + s * interval '30 minutes' as event_time,
               round(base + slope * (x + s), 6) as forecast_solar_share
        from fits, range(1, 49) r(s) where n >= 2""",
    "stream_alert": f"""with {DISPATCH},
        closed as (
          select trading_interval as t,
                 100 * sum(case when fuel_type = 'Coal' then generated_mw end) / nullif(sum(generated_mw), 0) as p
          from dispatch group by 1),
        judged as (select t, coalesce(p > 30, false) as br from closed),
        seen as (select *, lag(t) over (order by t) as pt, lag(br) over (order by t) as pb,
                        lead(t) over (order by t) as nt from judged),
        marked as (select *, sum(case when br and coalesce(pb, false) and t - pt <= interval '30 minutes'
                                      then 0 else 1 end) over (order by t rows unbounded preceding) as isl from seen),
        numbered as (select *, row_number() over (partition by isl order by t) as k,
                            count(*) over (partition by isl) as n, min(t) over (partition by isl) as started_at
                     from marked where br)
        select 'HighCoalPercentage' as alertname, 'warning' as severity, 'firing' as state, t as at, started_at,
               cast(3 as bigint) as n
        from numbered where k = 3
        union all
        select 'HighCoalPercentage', 'warning', 'resolved',
               case when nt - t <= interval '30 minutes' then nt else t + interval '5 minutes' end, started_at, n
        from numbered where k = n and n >= 3""",
    "landed_lines": """
        select event_id, row_number() over (partition by cast(ts as date) order by event_id) - 1 as line from events""",
    "bronze_compacted": f"""with {DISPATCH}
        select {MESSAGE}, cast(trading_interval as date) as trading_date from dispatch""",
    "late_arrivals": """
        with a as (
          select event_id, cast(user_id as varchar) as unit_id, ts as ingested_at,
                 least(2, date_diff('day', date '2024-01-01', cast(ts as date)) // 10) + (event_id % 7 = 0)::int as part
          from events),
        m as (select part, max(ingested_at) as newest from a group by part)
        select event_id, unit_id, ingested_at from a
        where ingested_at < (select max(newest) from m where m.part < a.part) - interval '5 days'""",
    "topic_once": f"""with {SHARES}
        select strftime(event_time, '%Y-%m-%d %H:%M:%S') as event_time, round(solar_share, 6) as solar_share
        from shares""",
}

ORACLES["coal_alert_coded"] = " union all ".join(
    f"""select 'HighCoalPercentage' as alertname, 'warning' as severity, started_at, ended_at, n, resolved_at,
               round(2 * peak, 4) as peak, cast({threshold} as double) as threshold
        from (with {coal_stretches(threshold // 2, having)} select * from named) z{threshold}"""
    for threshold, having in ((60, "max(t) - min(t) >= interval '5 minutes'"), (70, "count(*) >= 3"))
)
ORACLES["stream_rate_alert"] = (
    f"select alertname, severity, started_at, n, resolved_at from ({ORACLES['coal_rate_alert']}) z"
)
ORACLES["stream_forecast_error"] = ORACLES["forecast_mape"]
