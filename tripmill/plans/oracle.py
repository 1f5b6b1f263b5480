"""The registered queries as SQL over the same tables, for DuckDB."""

from __future__ import annotations

from tripmill.operators.quality import NotNull, Unique, model_checks
from tripmill.schemas import ID_COLUMNS, MONEY_COLUMNS, PASSED_COLUMNS, REVENUE_COLUMNS, SERVICES
from tripmill.sources.testtables import DRIFT_YEARS, STATUS, ZONE_IDS

_RAW_COLUMNS = {
    "VendorID": "nullif(l_suppkey, 0)",
    "passenger_count": "l_linenumber",
    "trip_distance": "l_quantity",
    "RatecodeID": "l_quantity / 2",
    "PULocationID": f"l_partkey % {ZONE_IDS}",
    "DOLocationID": f"l_orderkey % {ZONE_IDS}",
    "payment_type": "cast(instr('ANR', l_returnflag) as bigint)",
    "fare_amount": "l_extendedprice",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "tip_amount": "l_discount * 100",
    "tolls_amount": "l_quantity",
    "improvement_surcharge": "cast(0.3 as double)",
    "total_amount": "l_extendedprice + l_quantity",
    "congestion_surcharge": "case when l_tax > 0 then cast(2.5 as double) end",
    "airport_fee": "case when l_discount > 0 then cast(1.25 as double) end",
}


def _raw(service: str) -> str:
    pickup, dropoff = SERVICES[service]
    columns = ", ".join(f'{sql} as "{name}"' for name, sql in _RAW_COLUMNS.items())
    return (
        f"select {columns}, l_shipdate as {pickup}, l_shipdate + to_hours(l_linenumber) as {dropoff} "
        f"from lineitem where l_linestatus = '{STATUS[service]}'"
    )


def _first(service: str) -> str:
    """Raw rows with their rank rn within (vendor, pickup)."""
    pickup, dropoff = SERVICES[service]
    rest = [c for c in [*ID_COLUMNS, *PASSED_COLUMNS, "congestion_surcharge"] if c != "VendorID"]
    order = ", ".join(f'"{c}" asc nulls first' for c in [dropoff, *rest])
    return (
        f'select *, row_number() over (partition by "VendorID", {pickup} order by {order}) as rn '
        f"from raw_{service.lower()}"
    )


def _stage(service: str, suffix: str = "") -> str:
    pickup, dropoff = SERVICES[service]
    ids = ", ".join(f'cast(round("{c}") as bigint) as {alias}' for c, alias in ID_COLUMNS.items())
    return (
        f"select md5(cast(\"VendorID\" as varchar) || '|' || cast({pickup} as varchar) || '{suffix}') as tripid, "
        f"{ids}, {pickup} as pickup_datetime, {dropoff} as dropoff_datetime, {', '.join(PASSED_COLUMNS)}, "
        f"congestion_surcharge from ({_first(service)}) "
        f'where rn = 1 and "VendorID" is not null'
    )


_ZONES = """
    select cast(n_nationkey as bigint) as locationid, r_name as borough,
           case when n_nationkey = 24 then 'NATION_23' else n_name end as zone,
           case when n_regionkey = 1 then 'Yellow Zone' else 'Green Zone' end as service_zone
    from nation join region on n_regionkey = r_regionkey
"""

_FACTS = f"""
    select t.tripid, t.vendorid, t.service_type, t.ratecodeid, t.pickup_locationid,
           p.borough as pickup_borough, p.zone as pickup_zone, t.dropoff_locationid,
           d.borough as dropoff_borough, d.zone as dropoff_zone, t.pickup_datetime, t.dropoff_datetime,
           {', '.join('t.' + c for c in PASSED_COLUMNS)}, t.congestion_surcharge
    from trips t join zones p on t.pickup_locationid = p.locationid
                 join zones d on t.dropoff_locationid = d.locationid
"""

def _dec_sum(column: str, alias: str) -> str:
    return f"round(sum(cast({column} as double)), 4) as {alias}"


_MART = f"""
    select pickup_zone as revenue_zone, cast(date_trunc('month', pickup_datetime) as timestamp) as revenue_month,
           service_type, {', '.join(_dec_sum(c, label) for c, label in REVENUE_COLUMNS.items())},
           count(tripid) as total_monthly_trips, avg(passenger_count) as avg_monthly_passenger_count,
           avg(trip_distance) as avg_monthly_trip_distance
    from facts group by 1, 2, 3
"""

_CITYWIDE = f"""
    select revenue_month, cast(year(revenue_month) as bigint) as trip_year,
           cast(month(revenue_month) as bigint) as trip_month, service_type,
           cast(sum(total_monthly_trips) as bigint) as trips,
           {_dec_sum('revenue_monthly_total_amount', 'revenue_total')}
    from zone_mart group by revenue_month, service_type
"""

_TOTALS = "select service_type, cast(sum(trips) as bigint) as trip_total from citywide group by service_type"

_WINDOWS = """
    select event_type as vendor_id, count(*) as trip_count,
           time_bucket(interval '5 minutes', ts) as window_start,
           time_bucket(interval '5 minutes', ts) + interval '5 minutes' as window_end
    from events group by event_type, time_bucket(interval '5 minutes', ts)
"""

_RECORDS = """
    select cast(event_id as varchar) as id, event_type as type,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as created_at, user_id, value,
           cast(json_extract_string(props, '$.k') as bigint) as k
    from events
"""

# name of each building block -> (SQL, blocks it reads)
_BLOCKS = {
    "raw_yellow": (_raw("Yellow"), []),
    "raw_green": (_raw("Green"), []),
    "stg_yellow": (_stage("Yellow"), ["raw_yellow"]),
    "stg_green": (_stage("Green"), ["raw_green"]),
    "trips": (
        "select *, 'Yellow' as service_type from stg_yellow union all "
        "select *, 'Green' as service_type from stg_green",
        ["stg_yellow", "stg_green"],
    ),
    "zones": (_ZONES, []),
    "facts": (_FACTS, ["trips", "zones"]),
    "zone_mart": (_MART, ["facts"]),
    "citywide": (_CITYWIDE, ["zone_mart"]),
    "totals": (_TOTALS, ["citywide"]),
    "windows": (_WINDOWS, []),
    "records": (_RECORDS, []),
}


def _with(sql: str, *blocks: str) -> str:
    needed: list[str] = []

    def visit(name: str) -> None:
        for inner in _BLOCKS[name][1]:
            visit(inner)
        if name not in needed:
            needed.append(name)

    for b in blocks:
        visit(b)
    return "with " + ", ".join(f"{b} as ({_BLOCKS[b][0]})" for b in needed) + " " + sql


_second, _third = DRIFT_YEARS

_MERGED = f"""
    select '{{service}}' as service_type, "VendorID", {{pickup}} as pickup, {{dropoff}} as dropoff,
           cast(passenger_count as double) as passenger_count, trip_distance, "RatecodeID",
           "PULocationID", "DOLocationID", cast(payment_type as double) as payment_type,
           {', '.join(MONEY_COLUMNS)},
           case when year({{pickup}}) >= {_second} then congestion_surcharge end as congestion_surcharge,
           case when year({{pickup}}) >= {_third} then airport_fee end as airport_fee
    from {{raw}}
"""

_MERGED_TYPES = {
    "VendorID": "bigint",
    "pickup": "timestamp_ntz",
    "dropoff": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "double",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

_UNIFIED = " union all ".join(
    f"select '{{service}}' as service_type, cast({i} as bigint) as position, "
    f"'{ {'pickup': '{pickup}', 'dropoff': '{dropoff}'}.get(c, c)}' as column_name, '{t}' as type_name, "
    f'count("{c}") as non_null from ({_MERGED})'
    for i, (c, t) in enumerate(_MERGED_TYPES.items())
)

_PAYLOAD_FIELDS = """
    cast(coalesce("VendorID", 0) as varchar) as vendor_text,
    strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') as pickup_text,
    strftime(lpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') as dropoff_text
"""

_PAYLOAD = f"""
    select '{{"vendor_id":' || vendor_text || ',"lpep_pickup_datetime":"' || pickup_text
           || '","lpep_dropoff_datetime":"' || dropoff_text || '","passenger_count":' || passenger_count
           || ',"trip_distance":' || cast(trip_distance as varchar)
           || ',"total_amount":' || cast(total_amount as varchar) || '}}' as value
    from (select *, {_PAYLOAD_FIELDS} from raw_green)
"""


def _check(check) -> str:
    head = f"select '{check.name}' as check_name, '{check.table}' as table_name, '{check.column}' as column_name, "
    source = {
        "zone_seed": "zones",
        "dim_zones": "zones",
        "fact_trips": "facts",
        "monthly_zone_revenue": "zone_mart",
        "service_type_totals": "totals",
        "citywide_monthly": "citywide",
    }.get(check.table, check.table)
    if isinstance(check, NotNull):
        return f'{head} count(*) filter ("{check.column}" is null) as violations from {source}'
    if isinstance(check, Unique):
        keys = check.column
        alive = f"where {keys} is not null" if len(check.columns) == 1 else ""
        repeated = f"select {keys} from {source} {alive} group by {keys} having count(*) > 1"
        return f"{head} count(*) as violations from ({repeated})"
    values = ", ".join(repr(v) for v in check.values)
    return f"{head} count(*) filter ({check.column} not in ({values})) as violations from {source}"


def _simple_checks(kind: str, columns: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{kind}' as check_name, '{table}' as table_name, '{c}' as column_name, "
        f"count(*) filter ({bad}) as violations from raw_{table}"
        for table in ("yellow", "green")
        for c, bad in columns.items()
    )


def _both(select: str) -> str:
    """A select for each service, with {raw}, {pickup} and the service's name filled in."""
    return _with(
        " union all ".join(
            select.format(raw=f"raw_{s.lower()}", pickup=p, dropoff=d, service=s) for s, (p, d) in SERVICES.items()
        ),
        "raw_yellow",
        "raw_green",
    )


def _volume(service: str, minimum: int) -> str:
    pickup = SERVICES[service][0]
    return (
        f"select '{service}' as table_name, '1999-03' as ym, count(*) as row_count, "
        f"cast({minimum} as bigint) as min_rows, count(*) >= {minimum} as passed "
        f"from raw_{service.lower()} where year({pickup}) = 1999 and month({pickup}) = 3"
    )


_PIVOT = ", ".join(
    f"cast(sum(trips) filter (trip_year = {y}) as bigint) as y{y}" for y in range(1995, 2002)
) + ", cast(sum(trips) filter (trip_year not between 1995 and 2001) as bigint) as other_years"

ORACLE: dict[str, str] = {
    # sources and ingest
    "scan_trips": _both(
        'select \'{service}\' as service_type, "VendorID", {pickup} as pickup, "PULocationID", trip_distance, total_amount from {raw}'
    ),
    "month_calendar_keys": """
        select strftime(m, '%Y-%m') as ym from (
            select unnest(generate_series(date_trunc('month', min(l_shipdate)),
                                          date_trunc('month', max(l_shipdate)), interval 1 month)) as m
            from lineitem)
    """,
    "month_coverage": _both(
        """
        select '{service}' as service_type, strftime(m, '%Y-%m') as ym from (
            select unnest(generate_series(date_trunc('month', min({pickup})) - interval 2 month,
                                          date_trunc('month', max({pickup})) + interval 2 month, interval 1 month)) as m
            from {raw})
        where not exists (select 1 from {raw} where date_trunc('month', {pickup}) = m)
        """
    ),
    "dim_zones": _with("select * from zones", "zones"),
    "schema_unify": _both(_UNIFIED),
    "schema_align": _both(
        """
        select cast(trunc(fare_amount) as bigint) as fare_amount, cast(trunc("RatecodeID") as bigint) as "RatecodeID",
               cast("VendorID" as double) as "VendorID", cast(null as double) as ehail_fee,
               cast(passenger_count as bigint) as passenger_count, {pickup} as pickup, '{service}' as service_type
        from {raw}
        """
    ),
    "ts_normalize": "select l_orderkey, l_shipdate as tpep_pickup_datetime, l_shipdate as tpep_dropoff_datetime from lineitem",
    "merge_months": _both(_MERGED),
    "load_schema": _both(
        """
        select * exclude ({pickup}, {dropoff}) replace (cast(passenger_count as bigint) as passenger_count),
               {pickup} as pickup, {dropoff} as dropoff, '{service}' as service_type
        from {raw}
        """
    ),
    "profile_years": _both(
        """
        select cast(min(year({pickup})) as bigint) as min_year, cast(max(year({pickup})) as bigint) as max_year,
               count(*) as row_count, '{service}' as service_type
        from {raw}
        """
    ),
    "catalog_reload": _both(
        """
        select '{service}' as service_type, strftime({pickup}, '%Y-%m') as ym, count(*) as trips,
               cast(sum(passenger_count) as bigint) as passengers
        from {raw} group by 2
        """
    ),
    "partitioned_write": _with(
        """
        select strftime(tpep_pickup_datetime, '%Y-%m-%d') as day, count(*) as trips,
               cast(sum(passenger_count) as bigint) as passengers
        from raw_yellow group by 1
        """,
        "raw_yellow",
    ),
    "trip_payload": _with(_PAYLOAD, "raw_green"),
    # staging and core
    "filter_not_null": """
        select l_suppkey as "VendorID", count(*) as trips from lineitem where l_suppkey <> 0 group by 1
    """,
    "dedup_first": _with(
        f"select * exclude (rn, airport_fee) from ({_first('Yellow')}) where rn = 1", "raw_yellow"
    ),
    "stg_trips": _with("select * from trips", "trips"),
    "stg_trips_warehouse_key": _with(
        f"select tripid, vendorid, pickup_datetime from ({_stage('Green', '+00')})", "raw_green"
    ),
    "union_services": _with(
        """
        select service_type, count(*) as trips, cast(sum(passenger_count) as bigint) as passengers
        from trips group by service_type
        """,
        "trips",
    ),
    "join_pickup_zone": _with(
        " union all ".join(
            f"""select '{s}' as service_type, "PULocationID" as pickup_locationid, borough as pickup_borough,
               zone as pickup_zone, {p} as pickup, fare_amount
            from raw_{s.lower()} join zones on "PULocationID" = locationid"""
            for s, (p, _) in SERVICES.items()
        ),
        "raw_yellow",
        "raw_green",
        "zones",
    ),
    "join_role_playing": _with(
        """
        select p.zone as pickup_zone, d.zone as dropoff_zone, d.borough as dropoff_borough, count(*) as trips
        from (select "PULocationID", "DOLocationID" from raw_yellow union all
              select "PULocationID", "DOLocationID" from raw_green) t
        join zones p on "PULocationID" = p.locationid join zones d on "DOLocationID" = d.locationid
        group by 1, 2, 3
        """,
        "raw_yellow",
        "raw_green",
        "zones",
    ),
    "unmatched_zones": _with(
        " union all ".join(
            f"select service_type, '{role}' as role, count(*) as dropped_trips from trips "
            f"where not exists (select 1 from zones where locationid = {role}_locationid) group by service_type"
            for role in ("pickup", "dropoff")
        ),
        "trips",
        "zones",
    ),
    "fact_trips": _with("select * from facts", "facts"),
    # marts and serving
    "monthly_zone_revenue": _with("select * from zone_mart", "zone_mart"),
    "citywide_monthly": _with("select * from citywide", "citywide"),
    "service_type_totals": _with("select * from totals", "totals"),
    "monthly_totals": _with(
        """
        select revenue_month, service_type, cast(sum(total_monthly_trips) as bigint) as total_monthly_trips
        from zone_mart group by 1, 2 order by revenue_month asc, service_type desc
        """,
        "zone_mart",
    ),
    "top_zones": _with(
        f"""
        select revenue_zone, {_dec_sum('revenue_monthly_total_amount', 'total_revenue')},
               cast(sum(total_monthly_trips) as bigint) as total_trips
        from zone_mart group by revenue_zone order by total_revenue desc, revenue_zone limit 5
        """,
        "zone_mart",
    ),
    "mart_filtered": _with(
        """
        select * from zone_mart where service_type = 'Green'
           and revenue_month between timestamp '1998-01-01' and timestamp '1999-12-31'
        """,
        "zone_mart",
    ),
    "service_share": _with(
        "select service_type, trip_total, trip_total / (select sum(trip_total) from totals) as share from totals",
        "totals",
    ),
    "month_by_year": _with(f"select trip_month, {_PIVOT} from citywide group by trip_month", "citywide"),
    "yoy_monthly": _with(
        """
        select c.trip_year, c.trip_month, c.service_type, c.trips, b.trips as trips_year_before,
               c.trips / b.trips - 1 as change
        from citywide c left join citywide b
          on b.trip_year = c.trip_year - 1 and b.trip_month = c.trip_month and b.service_type = c.service_type
        """,
        "citywide",
    ),
    "month_filter_count": _both(
        """select '{service}' as service_type, count(*) as c from {raw}
        where extract(year from {pickup}) = 1999 and extract(month from {pickup}) = 3"""
    ),
    "warehouse_build": _with("select * from citywide", "citywide"),
    # data quality
    "dq_not_null": _both(
        " union all ".join(
            f"""select 'not_null' as check_name, lower('{{service}}') as table_name, '{c}' as column_name,
            count(*) filter ("{c}" is null) as violations from {{raw}}"""
            for c in ("{pickup}", "VendorID", "PULocationID", "congestion_surcharge")
        )
    ),
    "dq_accepted_values": _with(
        _simple_checks(
            "accepted_values",
            {"VendorID": '"VendorID" not in (1, 2)', "payment_type": "payment_type not in (1, 2, 3)"},
        ),
        "raw_yellow",
        "raw_green",
    ),
    "dq_unique": _with(
        "select tripid, count(*) as c from trips where tripid is not null group by tripid having count(*) > 1",
        "trips",
    ),
    "grain_violations": _both(
        """select '{service}' as service_type, "VendorID", {pickup} as pickup, count(*) as c
        from {raw} group by 2, 3 having count(*) > 1"""
    ),
    "mart_grain": _with(
        """
        select revenue_zone, revenue_month, service_type, count(*) as c
        from zone_mart group by 1, 2, 3 having count(*) > 1
        """,
        "zone_mart",
    ),
    "dq_volume": _with(f"{_volume('Yellow', 100)} union all {_volume('Green', 10_000)}", "raw_yellow", "raw_green"),
    "dq_report": _with(
        "select *, violations = 0 as passed from (" + " union all ".join(_check(c) for c in model_checks()) + ")",
        "totals",
        "zones",
    ),
    # event archive
    "events_json_scan": _with("select id, type, created_at, user_id as actor_id from records", "records"),
    "events_json_inferred": _with(
        "select type, count(*) as cnt, cast(sum(k) as bigint) as k_total from records group by type", "records"
    ),
    "events_field_shapes": """
        with kinds as (select hour(ts) % 3 as kind, date_trunc('hour', ts) as h from events),
        held(kind, field, shape) as (values
          (0, 'id', 'BIGINT'), (1, 'id', 'BIGINT'), (2, 'id', 'BIGINT'), (0, 'amount', 'BIGINT'), (1, 'amount', 'DECIMAL'),
          (0, 'user', 'BIGINT'), (1, 'user', 'STRING'), (2, 'user', 'OBJECT<id: BIGINT>'), (1, 'note', 'VOID'))
        select field, count(distinct h) as hours, count(*) as events,
          string_agg(distinct shape, '; ' order by shape) as shapes,
          case when count(distinct shape) = 1 then min(shape)
            when field = 'amount' then 'DECIMAL' else 'VARIANT' end as unified
        from kinds join held using (kind) group by field
        """,
    "events_json_unified": """
        with kinds as (select *, hour(ts) % 3 as kind from events)
        select event_id as id, strftime(ts, '%Y-%m-%d-%-H') as hour,
          case kind when 0 then floor(value) when 1 then floor(value) + 0.25 end::double as amount,
          case kind when 0 then user_id::varchar when 1 then 'u' || user_id
            else '{"id":' || user_id || '}' end as "user",
          case kind when 2 then user_id end as user_id, true as no_note, true as readable
        from kinds
        """,
    "events_count": "select count(*) as cnt from events",
    "events_sample": _with("select id, type, created_at from records order by id limit 5", "records"),
    "json_flatten": _with(
        """
        select id, type, created_at, user_id as actor__id, 'user-' || user_id as actor__login,
               value as payload__size__amount, k as payload__size__k
        from records
        """,
        "records",
    ),
    "json_children": _with(
        """
        select id as parent_id, cast(0 as integer) as list_idx, 'value' as name, value as amount from records
        union all select id, 1, 'k', cast(k as double) from records
        """,
        "records",
    ),
    "append_events": "select event_type as type, 2 * count(*) as cnt from events group by 1",
    "export_ndjson": "select * from events order by event_id limit 100",
    # windows and streams
    "tumble_counts": _with("select * from windows", "windows"),
    "latest_windows": _with("select * from windows order by window_start desc, vendor_id limit 15", "windows"),
    "vendor_activity": _with(
        """
        select 'Vendor ' || vendor_id || ' (' || strftime(window_start, '%H:%M') || ')' as label, trip_count
        from (select * from windows order by window_start desc, vendor_id limit 10)
        """,
        "windows",
    ),
    "stream_json_parse": _with(
        f"""
        select cast(vendor_text as integer) as vendor_id, pickup_text as lpep_pickup_datetime,
               dropoff_text as lpep_dropoff_datetime, passenger_count, trip_distance, total_amount
        from (select *, {_PAYLOAD_FIELDS} from raw_green)
        """,
        "raw_green",
    ),
    "stream_replay": _with(
        """
        select cast(coalesce("VendorID", 0) as varchar) as vendor_id, count(*) as trip_count,
               time_bucket(interval '5 minutes', lpep_pickup_datetime) as window_start,
               time_bucket(interval '5 minutes', lpep_pickup_datetime) + interval '5 minutes' as window_end
        from raw_green group by 1, 3, 4
        """,
        "raw_green",
    ),
    "stream_upsert": _with("select * from windows", "windows"),
    "stream_closed_windows": _with(
        "select * from windows where window_end <= (select date_trunc('millisecond', max(ts)) from events)",
        "windows",
    ),
    "stream_quarantine": f"""
        select case when l_linenumber = 6 then 'malformed' when l_linenumber = 7 then 'no time' else 'counted' end
                 as outcome, count(*) as messages
        from lineitem where l_linestatus = '{STATUS["Green"]}' group by 1
    """,
    "stream_two_runs": _with("select * from windows", "windows"),
    "stream_arrival_windows": """
        select event_type as vendor_id, cast(count(*) as bigint) as trip_count, 2000000::bigint as shortest,
               2000000::bigint as longest, 0::bigint as off_grid, 0::bigint as repeated
        from events group by event_type
    """,
    "stream_compacted": _with("select * from windows", "windows"),
    "tumble_proctime": "select event_type as vendor_id, count(*) as trip_count from events group by 1",
}
