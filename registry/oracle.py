"""The same results in plain SQL for another engine, one statement per query."""

from __future__ import annotations

from quakeframe.defaults import RAW_TOPIC
from quakeframe.schemas import FLAT_EVENT_COLUMNS, HOURLY_COLUMNS
from registry.adapter import RAW_SQL, SOURCE_FEED
from registry.queries import (
    HOURLY_MEASURES,
    LATE_DAYS,
    LISTED_IDS,
    LONG_TTL_SECONDS,
    RUN_IDS,
    USER_TTL_SECONDS,
    WINDOW_DAYS,
    WINDOW_ROWS,
)

FLAT = ", ".join(FLAT_EVENT_COLUMNS)
HOURLY = ", ".join(HOURLY_COLUMNS)

# Reusable table expressions; each names what it needs before it.


def flat_of(source: str, changes: dict[str, str] | None = None) -> str:
    """The fact columns of a raw-like relation, with some expressions replaced."""
    parts = {
        "event_id": "event_id",
        "event_time_utc": "make_timestamp(event_ms * 1000)",
        "updated_time_utc": "make_timestamp(updated_ms * 1000)",
        **{c: c for c in ("place", "mag", "mag_type", "longitude", "latitude", "depth_km")},
        "tz": "cast(null as integer)",
        "sig": "sig",
        "felt": "cast(null as integer)",
        "cdi": "cast(null as double)",
        "mmi": "cast(null as double)",
        **{c: c for c in ("alert", "tsunami", "status", "nst")},
        "dmin": "cast(null as double)",
        "rms": "cast(null as double)",
        "gap": "gap",
        "event_date": "cast(make_timestamp(event_ms * 1000) as date)",
        "year": "cast(year(make_timestamp(event_ms * 1000)) as integer)",
        "month": "cast(month(make_timestamp(event_ms * 1000)) as integer)",
        "day": "cast(day(make_timestamp(event_ms * 1000)) as integer)",
        **(changes or {}),
    }
    listed = ", ".join(f"{sql} as {name}" for name, sql in parts.items())
    return f"select n, {listed} from {source}"


RECENT = "updated_time_utc desc nulls last, event_time_utc desc nulls last"


def latest_of(source: str) -> str:
    return (
        f"select * from {source} where event_id <> '' "
        f"qualify row_number() over (partition by event_id order by {RECENT}, n) = 1"
    )


REGION = "nullif(trim(string_split(trim(place), ' of ')[-1]), '')"
CITY = "trim(string_split({r}, ',')[1])"
STATE = "case when contains({r}, ',') then trim(string_split({r}, ',')[-1]) end"
SEVERITY = (
    "case when mag is null then 'unknown' when mag < 4 then 'small' when mag < 5 then 'moderate'"
    " when mag < 6 then 'strong' when mag < 7 then 'severe' else 'extreme' end"
)


def _average(value: str, precision: int, scale: int) -> str:
    total = f"cast(sum(cast({value} as decimal({precision},{scale}))) as decimal({precision + 10},{scale}))"
    return f"cast(cast({total} / count({value}) as decimal({precision + 4},{scale + 4})) as double)"


def hourly_of(source: str) -> str:
    severities = ", ".join(
        f"count(*) filter ({SEVERITY} = '{name}') as {name}_count"
        for name in ("unknown", "small", "moderate", "strong", "severe", "extreme")
    )
    city, state = CITY.format(r="region_text"), STATE.format(r="region_text")
    return f"""
        select sha256(concat_ws('|', strftime(bucket_start_utc, '%Y-%m-%dT%H:%M:%S'),
                 coalesce(region_text, '__null__'), coalesce(city, '__null__'),
                 coalesce(state, '__null__'))) as document_id, *,
               cast(year(bucket_start_utc) as integer) as year,
               cast(month(bucket_start_utc) as integer) as month,
               cast(day(bucket_start_utc) as integer) as day
        from (
          select bucket_start_utc, region_text, city, state, count(*) as event_count,
                 count(*) filter (tsunami = 1) as tsunami_count, count(mag) as mag_count,
                 cast(sum(cast(mag as decimal(10,4))) as double) as mag_sum, max(mag) as max_mag,
                 {_average('mag', 10, 4)} as avg_mag, {severities},
                 {_average('longitude', 12, 6)} as avg_longitude,
                 {_average('latitude', 12, 6)} as avg_latitude
          from (select *, {city} as city, {state} as state from (
            select *, date_trunc('hour', event_time_utc) as bucket_start_utc,
                   {REGION} as region_text from {source} where event_time_utc is not null))
          group by bucket_start_utc, region_text, city, state)"""


def with_tables(select: str, recursive: bool = False, **tables: str) -> str:
    listed = ", ".join(f"{name} as ({sql})" for name, sql in tables.items())
    return f"with {'recursive ' if recursive else ''}{listed} {select}"


def on_raw(select: str) -> str:
    return with_tables(select, raw=RAW_SQL)


def on_flat(select: str, **more: str) -> str:
    return with_tables(select, raw=RAW_SQL, flat=flat_of("raw"), **more)


def on_latest(select: str, **more: str) -> str:
    return on_flat(select, latest=latest_of("flat"), **more)


def on_hourly(select: str, **more: str) -> str:
    return on_latest(select, hourly=hourly_of("latest"), **more)


# What the two readers make of the payloads.

STRICT_ID = "case when blank_id then '' when number_id then cast(n as varchar) else event_id end"
STRICT_REASON = (
    "case when bad_json then 'no_event_id' when time_as_text then 'no_event_time'"
    " when is_blast then 'not_earthquake' when no_geometry or is_polygon then 'not_point' end"
)
LENIENT_REASON = (
    "case when bad_json then 'not_json' when no_geometry then 'no_geometry'"
    " when is_blast then 'not_earthquake' when is_polygon then 'not_point'"
    " when blank_id or number_id then 'no_event_id' end"
)
SHORT = {
    "latitude": "case when not short_point then latitude end",
    "depth_km": "case when not short_point then depth_km end",
}
STRICT_COLUMNS = {
    "event_id": STRICT_ID,
    "mag": "case when not mag_as_text then mag end",
    "tsunami": "case when not tsunami_fraction then tsunami end",
    **SHORT,
}
LENIENT_COLUMNS = {"tsunami": "case when tsunami_fraction then 1 else tsunami end", **SHORT}
STRICT = f"{flat_of('raw', STRICT_COLUMNS)} where {STRICT_REASON} is null"
LENIENT = f"{flat_of('raw', LENIENT_COLUMNS)} where {LENIENT_REASON} is null"

MESSAGE = """concat('{"event_id":"', event_id, '","n":', cast(n as varchar), '}')"""
ISO = (
    "strftime({t}, '%Y-%m-%dT%H:%M:%S') || case when microsecond({t}) % 1000000 = 0 then ''"
    " else '.' || strftime({t}, '%f') end || 'Z'"
)
EVENT_TIME = "make_timestamp(event_ms * 1000)"
OBSERVED = "make_timestamp(observed_ms * 1000)"


def rejected(reason: str, *names: str) -> str:
    listed = ", ".join(f"'{name}'" for name in names)
    return on_raw(
        f"select * from (select n, {reason} as reject_reason from raw) where reject_reason in ({listed})"
    )


def outcomes(reason: str) -> str:
    return on_raw(
        f"select coalesce({reason}, 'accepted') as outcome, count(*) as row_count from raw group by 1"
    )


# Windows of the run, and merging.

_FIRST = "date '2024-01-01'"
_LAST = "date '2024-01-31'"
# Days outside of the run are in none of its windows.
CHUNKED = (
    f"select *, n as position, {_FIRST} + cast(floor(date_diff('day', {_FIRST}, cast({EVENT_TIME} as date))"
    f" / {WINDOW_DAYS}) * {WINDOW_DAYS} as integer) as chunk_start from raw"
    f" where cast({EVENT_TIME} as date) between {_FIRST} and {_LAST}"
)
IN_RUN = f"select * from chunked where cast({EVENT_TIME} as date) between {_FIRST} and {_LAST}"


def on_chunks(select: str, **more: str) -> str:
    return with_tables(select, raw=RAW_SQL, chunked=CHUNKED, **more)


LAST_COPY = """select chunk_start, event_id, place, mag,
    min(position) over (partition by chunk_start, event_id) as position from chunked
    qualify row_number() over (partition by chunk_start, event_id order by chunked.position desc) = 1"""

REPLACES = (
    "(t.updated_time_utc is null or s.updated_time_utc > t.updated_time_utc"
    " or (s.updated_time_utc = t.updated_time_utc and s.event_time_utc > t.event_time_utc))"
)


def merged(target: str, source: str) -> str:
    take = f"(t.event_id is null or (s.event_id is not null and coalesce({REPLACES}, false)))"
    columns = ", ".join(f"case when {take} then s.{c} else t.{c} end as {c}" for c in FLAT_EVENT_COLUMNS)
    return f"select {columns} from {target} t full join {source} s on t.event_id = s.event_id"


MERGE_SIDES = {
    "target": latest_of("(select flat.* from flat join raw using (n) where revision < 2)"),
    "source": latest_of("(select flat.* from flat join raw using (n) where revision >= 2 or is_redelivered)"),
}
REVISIONS = {
    **{
        f"b{i}": f"select {', '.join('flat.' + c for c in FLAT_EVENT_COLUMNS)} from flat join raw using (n)"
        f" where revision = {i}"
        for i in range(4)
    },
    "m1": merged("b0", "b1"),
    "m2": merged("m1", "b2"),
    "m3": merged("m2", "b3"),
}


CHANGING = {**REVISIONS, "m0": "select * from b0"}


def suppressed(key: str, ttl_seconds: int, missing: str = "false") -> str:
    """Rows where ``missing`` holds have no time and count as seen on 1 March."""
    ttl_ms = ttl_seconds * 1_000
    now = "epoch_ms(timestamp '2024-03-01')"
    return with_tables(
        f"""select n, user_id, event_type, case when not ({missing}) then {OBSERVED} end as observed_at from (
              select raw.* from raw join chain on raw.{key} = chain.k and raw.observed_ms = chain.ms
              qualify row_number() over (partition by raw.{key}, raw.observed_ms order by n) = 1)""",
        recursive=True,
        given=RAW_SQL,
        raw=f"select * replace (case when {missing} then {now} else observed_ms end as observed_ms) from given",
        seen=f"select distinct {key} as k, observed_ms as ms from raw",
        chain=f"""select k, min(ms) as ms from seen group by k union all
            select * from (select chain.k,
              (select min(ms) from seen where seen.k = chain.k and seen.ms > chain.ms + {ttl_ms}) as ms
              from chain) where ms is not null""",
    )


def judged_late(key: str, ttl_seconds: int, late_days: int) -> str:
    """Published rows, and those that come more than ``late_days`` behind an earlier half month's rows."""
    ttl_ms, late_ms = ttl_seconds * 1_000, late_days * 86_400_000
    return with_tables(
        f"""select n, user_id, event_type, {OBSERVED} as observed_at, cast(null as varchar) as mark from (
              select raw.* from raw join chain on raw.{key} = chain.k and raw.observed_ms = chain.ms
              qualify row_number() over (partition by raw.{key}, raw.observed_ms order by n) = 1)
            union all select n, user_id, event_type, {OBSERVED} as observed_at, 'late' as mark
              from arrived where observed_ms <= newest - {late_ms}""",
        recursive=True,
        given=RAW_SQL,
        sent=f"""select *, floor((date_diff('day', date '2024-01-01', cast({OBSERVED} as date)) + n % 3 * 5) / 15) as part
            from given""",
        parts="select part, max(observed_ms) as ms from sent group by part",
        before="select part, max(ms) over (order by part rows between unbounded preceding and 1 preceding) as newest from parts",
        arrived="select sent.*, newest from sent join before using (part)",
        raw=f"select * from arrived where newest is null or observed_ms > newest - {late_ms}",
        seen=f"select distinct {key} as k, observed_ms as ms from raw",
        chain=f"""select k, min(ms) as ms from seen group by k union all
            select * from (select chain.k,
              (select min(ms) from seen where seen.k = chain.k and seen.ms > chain.ms + {ttl_ms}) as ms
              from chain) where ms is not null""",
    )


CHUNK_COUNTS = """select chunk_start, least(chunk_start + 6, date '2024-01-31') as chunk_end,
    cast(sum(copies) as bigint) as fetched_count, count(*) as unique_count,
    count(*) filter (chunk_start = first_chunk) as published_count,
    cast(sum(copies) as bigint) - count(*) filter (chunk_start = first_chunk) as duplicate_count
    from (select *, min(chunk_start) over (partition by event_id) as first_chunk from (
      select chunk_start, event_id, count(*) as copies from chunked group by all)) group by chunk_start"""

# Daily fetches of users; a user stays silent for two days after being published.
LIVE = {
    "fetched": f"""select cast({OBSERVED} as date) as day, user_id, count(*) as copies,
        min(observed_ms) as ms from raw group by all""",
    "chain": """select user_id, min(ms) as ms from fetched group by user_id union all
        select * from (select chain.user_id, (select min(ms) from fetched where fetched.user_id = chain.user_id
          and fetched.ms > chain.ms + 2 * 86400000) as ms from chain) where ms is not null""",
}
RUN_COUNTS = """
    select 'backfill' as mode, count(*) as chunk_count,
           cast(sum(fetched_count) as bigint) as fetched_count, cast(sum(unique_count) as bigint) as unique_count,
           cast(sum(published_count) as bigint) as published_count,
           cast(sum(duplicate_count) as bigint) as duplicate_count from counts
    union all
    select 'realtime', count(distinct day), cast(sum(copies) as bigint), count(*),
           (select count(*) from chain), cast(sum(copies) as bigint) - (select count(*) from chain) from fetched"""


# Documents. Spark writes doubles below one thousandth with an exponent.


def _text(value: str) -> str:
    return f"coalesce('\"' || {value} || '\"', 'null')"


def _double(value: str) -> str:
    small = (
        f"regexp_replace(cast(round({value} * pow(10, -floor(log10(abs({value})))), 9) as varchar) || 'E' ||"
        f" cast(cast(floor(log10(abs({value}))) as integer) as varchar), '^$', '')"
    )
    return (
        f"coalesce(case when {value} <> 0 and abs({value}) < 0.001 then {small}"
        f" else cast({value} as varchar) end, 'null')"
    )


def _document(kinds: dict[str, str], latitude: str, longitude: str) -> str:
    texts = {
        "text": lambda c: _text(c),
        "time": lambda c: _text("(" + ISO.format(t=c) + ")"),
        "date": lambda c: _text(f"cast({c} as varchar)"),
        "double": lambda c: _double(c),
        "int": lambda c: f"coalesce(cast({c} as varchar), 'null')",
    }
    fields = " || ',' || ".join(f"'\"{name}\":' || {texts[kind](name)}" for name, kind in kinds.items())
    location = (
        f"case when {latitude} is not null and {longitude} is not null then ',\"location\":{{\"lat\":' ||"
        f" {_double(latitude)} || ',\"lon\":' || {_double(longitude)} || '}}' else '' end"
    )
    return f"'{{' || {fields} || {location} || '}}'"


def _action(index: str, column: str) -> str:
    return f"'{{\"index\":{{\"_index\":\"{index}\",\"_id\":\"' || {column} || '\"}}}}'"


_DOUBLES = (
    "mag", "longitude", "latitude", "depth_km", "cdi", "mmi", "dmin", "rms", "gap",
    "mag_sum", "max_mag", "avg_mag", "avg_longitude", "avg_latitude",
)
_TEXTS = ("event_id", "place", "mag_type", "alert", "status", "document_id", "region_text", "city", "state")
_TIMES = ("event_time_utc", "updated_time_utc", "bucket_start_utc")


def _kind(name: str) -> str:
    if name in _DOUBLES:
        return "double"
    if name in _TEXTS:
        return "text"
    if name in _TIMES:
        return "time"
    return "date" if name == "event_date" else "int"


LATEST_DOCUMENT = _document({c: _kind(c) for c in FLAT_EVENT_COLUMNS}, "latitude", "longitude")
HOURLY_DOCUMENT = _document({c: _kind(c) for c in HOURLY_COLUMNS}, "avg_latitude", "avg_longitude")

RANGE = "event_time_utc >= timestamp '2024-01-05' and event_time_utc < timestamp '2024-01-21'"
WHOLE_RUN = "event_time_utc >= timestamp '2024-01-01' and event_time_utc < timestamp '2024-02-01'"
CATALOG_ORDER = "order by event_time_utc, event_id"

POINT_LATITUDE = "case when not short_point then latitude end"
AS_FLOAT = (
    "case when mag_as_text then gap when blank_id then null when is_blast then 1.0 else gap end"
)
AS_INT = (
    "case when mag_as_text then case when gap = floor(gap) and contains(cast(gap as varchar), '.') = false"
    " then cast(gap as integer) end when blank_id then null when is_blast then 1"
    " else cast(trunc(gap) as integer) end"
)

FETCH_COUNTS = on_raw(
    f"""select make_timestamp(seconds::bigint * 1000000) as observed_at, '{SOURCE_FEED}' as source_feed, 'realtime' as source_mode,
      '{RAW_TOPIC}' as topic, 't' as title, count(*) as fetched_count, count(distinct event_id) as unique_count,
      count(distinct case when seconds <> 1800 then event_id end) as published_count,
      count(*) - count(distinct case when seconds <> 1800 then event_id end) as duplicate_count
      from raw cross join (values (0), (1800), (7200)) fetches(seconds) group by seconds"""
)

ORACLE: dict[str, str] = {
    "s1_table_scan": "select * from events",
    "s2_key_scan": on_latest(
        f"select {FLAT} from latest where event_id in (select event_id from raw where event_type = 'purchase')"
    ),
    "s3_full_scan_batches": on_hourly(f"select {HOURLY} from hourly"),
    "s4_payload_rows": on_raw(f"select {MESSAGE} as payload_json from raw"),
    "s5_feature_collection": on_raw(
        "select cast(floor(n / 500) as bigint) as document,"
        " concat('u', cast(cast(floor(n / 500) as bigint) as varchar)) as source_url,"
        " cast(row_number() over (partition by floor(n / 500) order by n) - 1 as integer) as position,"
        " event_id, place, 'kept' as extra from raw"
    ),
    "s6_message_stream": on_raw(f"select event_id as key, {MESSAGE} as value from raw"),
    "s7_decode_value": "select event_id, props as value from events",
    "s8_date_chunks": f"""select chunk_start, least(chunk_start + {WINDOW_DAYS - 1}, last) as chunk_end from (
        select cast(unnest(generate_series(first, last, interval {WINDOW_DAYS} day)) as date) as chunk_start, last
        from (select min(cast(ts as date)) as first, max(cast(ts as date)) as last from events))""",
    "s9_catalog_range": on_flat(
        "select event_id, event_time_utc, false as range_truncated"
        f" from flat where {RANGE} {CATALOG_ORDER}"
    ),
    "k1_partitioned_write": on_latest(f"select {FLAT} from latest"),
    "k2_clear_then_append": on_flat(f"select {FLAT} from flat"),
    "k3_create_or_append": on_flat(
        f"select {', '.join('flat.' + c for c in FLAT_EVENT_COLUMNS)},"
        " case when event_type in ('view', 'click') then 'seen' else 'rest' end as run_id"
        " from flat join raw using (n)"
    ),
    "k3_rerun_moved_days": on_flat(
        f"select {', '.join('1 as day' if c == 'day' else c for c in FLAT_EVENT_COLUMNS)} from flat where n % 3 = 0"
        f" union all select {FLAT} from flat where n % 5 = 1"
    ),
    "k3_any_run_id": on_flat(
        f"select {', '.join('flat.' + c for c in FLAT_EVENT_COLUMNS)},"
        f" case n % 5 {' '.join(f'when {i} then {chr(39)}{x}{chr(39)}' for i, x in enumerate(RUN_IDS))} end as run_id from flat"
    ),
    "k4_merge_upsert": on_flat(f"select {FLAT} from m3", **REVISIONS),
    "k4_effective_changes": on_flat(
        " union all ".join(
            f"select {i} as batch_id, now.event_id, now.updated_time_utc, old.event_time_utc as before_time_utc from"
            f" (select {FLAT} from m{i} except all select {FLAT} from m{i - 1}) as now left join m{i - 1} as old using (event_id)"
            if i
            else "select 0 as batch_id, event_id, updated_time_utc, cast(null as timestamp) as before_time_utc from m0"
            for i in range(4)
        ),
        **CHANGING,
    ),
    "t6_changed_ids": on_flat(
        f"select event_id from (select {FLAT} from m3 except all select {FLAT} from m1)", **CHANGING
    ),
    "t6_incremental_hours": on_flat(f"select {HOURLY} from hourly", **CHANGING, hourly=hourly_of("m3")),
    "k5_bulk_payload_latest": on_latest(
        f"select event_id as document_id, {_action('earthquake-latest-event-v1', 'event_id')} as action_line,"
        f" {LATEST_DOCUMENT} as document_line from latest"
    ),
    "k6_bulk_payload_hourly": on_hourly(
        f"select document_id, {_action('earthquake-region-hourly-v1', 'document_id')} as action_line,"
        f" {HOURLY_DOCUMENT} as document_line from hourly"
    ),
    "k7_publish_keyed": on_raw(f"select event_id as key, {MESSAGE} as value from raw"),
    "k8_skip_if_missing": "select count(*) as row_count, true as missing_skipped from events",
    "p1_envelope_build": on_raw(
        f"select event_id, '{SOURCE_FEED}' as source_feed, 'backfill' as source_mode,"
        f" {ISO.format(t=OBSERVED)} as ingest_time_utc, 't' as published_topic,"
        " '2024-01-01' as request_window_start, '2024-01-31' as request_window_end, n, 'kept' as extra from raw"
    ),
    "p2_envelope_encode": on_raw(
        f"select n, event_id as key, event_id, {ISO.format(t=OBSERVED)} as ingest_time_utc,"
        " '2024-01-31' as request_window_end, place, mag from raw"
    ),
    "p3_envelope_decode": on_raw(
        "select n, not bad_json as decoded, case when not bad_json then 'realtime' end as source_mode,"
        " case when not bad_json then sig end as sig from raw"
    ),
    "p4_flatten_strict": on_raw(f"select n, {FLAT} from ({STRICT})"),
    "p5_flatten_lenient": on_raw(f"select n, {FLAT} from ({LENIENT})"),
    "p6_calendar_columns": on_flat("select n, event_time_utc, event_date, year, month, day from flat"),
    "p7_bucket_calendar": on_hourly("select document_id, bucket_start_utc, year, month, day from hourly"),
    "p8_final_select": on_hourly(f"select {HOURLY} from hourly"),
    "p9_drop_helper": on_latest(f"select {FLAT} from latest"),
    "p10_geo_point": on_raw(
        f"select n, {POINT_LATITUDE} is not null as has_location, {POINT_LATITUDE} as lat,"
        " case when not short_point then longitude end as lon from raw"
    ),
    "f1_parsed": rejected(LENIENT_REASON, "not_json"),
    "f2_has_id": rejected(LENIENT_REASON, "no_event_id"),
    "f3_has_time": rejected(STRICT_REASON, "no_event_time"),
    "f4_is_earthquake": rejected(STRICT_REASON, "not_earthquake"),
    "f5_is_point": rejected(STRICT_REASON, "not_point"),
    "f6_has_structs": rejected(LENIENT_REASON, "no_geometry"),
    "f_reject_counts_strict": outcomes(STRICT_REASON),
    "f_reject_counts_lenient": outcomes(LENIENT_REASON),
    "f7_bucketable": on_flat(
        "select document_id, bucket_start_utc, event_count from hourly",
        timed="select flat.* from flat join raw using (n) where not time_as_text",
        hourly=hourly_of("timed"),
    ),
    "f8_top_rank": on_latest("select event_id, updated_time_utc, event_time_utc from latest"),
    "f9_key_in": on_flat(
        f"select {FLAT} from flat where event_id in ({', '.join(repr(i) for i in LISTED_IDS)})"
    ),
    "j1_latest_merge": on_flat(merged("target", "source"), **MERGE_SIDES),
    "j2_merge_counts": on_flat(
        f"""select count(*) filter (t.event_id is null) as inserted_count,
            count(*) filter (t.event_id is not null and {REPLACES}) as updated_count,
            count(*) filter (t.event_id is null or {REPLACES}) as affected_count
            from source s left join target t on t.event_id = s.event_id""",
        **MERGE_SIDES,
    ),
    "d1_latest_in_batch": with_tables(
        f"select n, {FLAT} from newest",
        raw=RAW_SQL,
        flat=flat_of("raw", {"event_id": "case when blank_id then '' else event_id end"}),
        newest=latest_of("flat"),
    ),
    "d2_last_wins": on_chunks(LAST_COPY),
    "d3_first_wins_across": on_chunks(
        "select * from last_copy qualify row_number() over (partition by event_id order by chunk_start, position) = 1",
        last_copy=LAST_COPY,
    ),
    "d4_first_wins_all": on_chunks(
        "select chunk_start, event_id, position, place, mag from chunked"
        " qualify row_number() over (partition by event_id order by chunk_start, position) = 1"
    ),
    "d5_suppress_recent": suppressed("user_id", USER_TTL_SECONDS),
    "d5_suppress_recent_hot_keys": suppressed("event_type", 3_600),
    "d5_suppress_long_ttl": suppressed("event_type", LONG_TTL_SECONDS),
    "d5_suppress_missing_times": suppressed("user_id", USER_TTL_SECONDS, missing="n % 7 = 0"),
    "a1_region_hourly_stats": on_hourly(f"select {HOURLY} from hourly"),
    **{
        name: on_hourly(f"select bucket_start_utc, region_text, {', '.join(columns)} from hourly")
        for name, columns in HOURLY_MEASURES.items()
    },
    "a2_chunk_metrics": on_chunks(CHUNK_COUNTS),
    "a3_run_metrics": with_tables(
        RUN_COUNTS, recursive=True, raw=RAW_SQL, chunked=CHUNKED, counts=CHUNK_COUNTS, **LIVE
    ),
    "a4_row_count": on_hourly(
        "select count(*) as row_count, 'flat_event' as table_name from flat"
        " union all select count(*), 'latest_event' from latest"
        " union all select count(*), 'region_hourly_stats' from hourly"
    ),
    "a5_events_over_time": on_hourly(
        "select bucket_start_utc, cast(sum(event_count) as bigint) as event_count from hourly group by 1"
    ),
    "a6_severity_over_time": on_hourly(
        "select bucket_start_utc, "
        + ", ".join(f"cast(sum({c}) as bigint) as {c}" for c in HOURLY_MEASURES["a1g_severity_counts"])
        + " from hourly group by 1"
    ),
    "a7_mag_over_time": on_hourly(
        "select bucket_start_utc, max(max_mag) as max_mag,"
        " cast(sum(cast(mag_sum as decimal(24,4))) as double) / nullif(sum(mag_count), 0) as avg_mag"
        " from hourly group by 1"
    ),
    "a8_top_regions": on_hourly(
        "select region_text, cast(sum(event_count) as bigint) as event_count from hourly"
        " group by 1 order by 2 desc, 1 nulls first limit 10"
    ),
    "a9_tsunami_by_region": on_hourly(
        "select region_text, cast(sum(tsunami_count) as bigint) as tsunami_count from hourly group by 1"
    ),
    "a10_map_points": on_latest("select event_id, mag, place, latitude as lat, longitude as lon from latest"),
    "w1_latest_rank": on_latest(f"select {FLAT} from latest"),
    "o1_time_order": on_flat(f"select event_id, event_time_utc, mag from flat where {WHOLE_RUN} {CATALOG_ORDER}"),
    "u1_append_union": on_flat(f"select {FLAT} from flat"),
    "x1_epoch_ms": on_raw(
        f"select n, {EVENT_TIME} as event_time_utc, cast(null as timestamp) as beyond_range,"
        f" {EVENT_TIME} + interval 500 microsecond as half_later from raw"
    ),
    "x2_coordinate": on_raw(
        f"select n, longitude, {SHORT['latitude']} as latitude, {SHORT['depth_km']} as depth_km from raw"
    ),
    "x3_region_text": on_raw(f"select n, {REGION} as region_text from raw"),
    "x4_city": on_raw(
        f"select n, {CITY.format(r=REGION)} as city, nullif({CITY.format(r=REGION)}, '') as city_or_null from raw"
    ),
    "x5_state": on_raw(
        f"select n, {STATE.format(r=REGION)} as state, nullif({STATE.format(r=REGION)}, '') as state_or_null from raw"
    ),
    "x6_severity": on_raw(f"select n, {SEVERITY} as severity from raw"),
    "x7_hour_bucket": on_raw(f"select n, date_trunc('hour', {EVENT_TIME}) as bucket_start_utc from raw"),
    "x8_to_decimal": on_raw(
        "select n, cast(mag as decimal(10,4)) as mag_decimal,"
        " try_cast(longitude * 100000 as decimal(12,6)) as large_decimal from raw"
    ),
    "x9_to_float_to_int": on_raw(f"select n, {AS_FLOAT} as as_float, {AS_INT} as as_int from raw"),
    "x10_comma_list": on_raw(
        "select n, concat(event_id, '/', coalesce(mag_type, ''), '/x') as items,"
        " case when mag_type is null then 0 else 1 end as type_count from raw"
    ),
    "x11_iso_text": on_raw(
        f"select n, {ISO.format(t=EVENT_TIME)} as iso_time,"
        f" {ISO.format(t='make_timestamp(updated_ms * 1000)')} as iso_updated,"
        f" strftime({EVENT_TIME}, '%Y-%m-%d') as iso_date from raw"
    ),
    "x12_hash_key": on_raw(
        "select n, sha256(concat_ws('|', event_id, coalesce(place, '__null__'),"
        " coalesce(mag_type, '__null__'))) as hash_key from raw"
    ),
    "x14_date_parts": on_flat("select n, event_date, year, month, day from flat"),
    "x13_json_parse": on_raw(
        f"select n, case when not bad_json then {STRICT_ID} end as event_id,"
        " case when not bad_json and not mag_as_text then mag end as mag,"
        " case when not bad_json then nst end as nst,"
        " case when not bad_json and not no_geometry then longitude end as longitude,"
        " case when not bad_json and not no_geometry and not short_point then latitude end as latitude from raw"
    ),
    "t1_micro_batch": on_raw(f"select event_id as key, {MESSAGE} as value from raw"),
    "t2_batch_write": on_raw(f"select {FLAT} from ({LENIENT})"),
    "t3_commit_after_write": on_raw(f"select {FLAT} from ({LENIENT})"),
    "t4_drain_on_stop": with_tables(
        f"select {FLAT} from latest", raw=RAW_SQL, flat=LENIENT, latest=latest_of("flat")
    ),
    "t5_stateful_suppress": suppressed("user_id", USER_TTL_SECONDS),
    "t5_late_rows": judged_late("user_id", USER_TTL_SECONDS, LATE_DAYS),
    "t5_suppress_by_batch": suppressed("event_type", 3_600),
    "t6_periodic_refresh": with_tables(
        f"select {HOURLY} from hourly",
        raw=RAW_SQL, flat=LENIENT, latest=latest_of("flat"), hourly=hourly_of("latest"),
    ),
    "route_backfill_to_hourly": with_tables(
        f"select {HOURLY} from hourly",
        raw=RAW_SQL,
        chunked=CHUNKED,
        in_run=IN_RUN,
        first_copy="select * from in_run qualify row_number() over"
        " (partition by event_id order by chunk_start, event_ms, n) = 1",
        flat=flat_of("first_copy", {**STRICT_COLUMNS, "event_id": "event_id"})
        + " where not (time_as_text or is_blast or is_polygon or no_geometry)",
        hourly=hourly_of("flat"),
    ),
    "route_backfill_messages": on_chunks(
        "select event_id as key, concat('u', cast(cast(floor(n / 500) as bigint) as varchar)) as source_feed,"
        " cast(chunk_start as varchar) as request_window_start,"
        " cast(least(chunk_start + 6, date '2024-01-31') as varchar) as request_window_end, nst from last_copy"
        " qualify row_number() over (partition by event_id order by chunk_start) = 1",
        in_run=IN_RUN,
        last_copy="select * from in_run qualify row_number() over"
        " (partition by chunk_start, event_id order by event_ms desc, n desc) = 1",
    ),
    "route_realtime_messages": on_raw(
        "select event_id as key, concat('u', cast(cast(floor(n / 500) as bigint) as varchar)) as source_feed,"
        f" {ISO.format(t='make_timestamp(cast(floor(n / 500) as bigint) * 3600000000)')} as ingest_time_utc, nst"
        " from raw qualify row_number() over (partition by event_id order by n desc) = 1"
    ),
    "route_realtime_stream": on_raw(
        "select event_id as key, concat('u', cast(cast(floor(n / 500) as bigint) as varchar)) as source_feed,"
        " hour as ingest_time_utc, nst from (select * from raw"
        " qualify row_number() over (partition by event_id order by n desc) = 1)"
        " cross join (values ('1970-01-01T00:00:00Z'), ('1970-01-01T02:00:00Z')) hours(hour)"
    ),
    "a3_realtime_fetch_metrics": FETCH_COUNTS,
    "a3_fetches_in_one_batch": FETCH_COUNTS,
    "d1_arrival_order": on_raw("select event_id, min(n) as n from raw where event_id <> '' group by event_id"),
    "s9_bounded_windows": on_flat(
        f"""select min(event_time_utc) as window_start, max(event_time_utc) as window_end,
          cast(sum(k) as bigint) as row_count, sum(k) > {WINDOW_ROWS} as exceeds
          from (select event_time_utc, k, (sum(k) over (order by event_time_utc) - k) // {WINDOW_ROWS // 2} as part
            from (select event_time_utc, count(*) as k from flat
              where cast(event_time_utc as date) between date '2024-01-05' and date '2024-01-20' group by 1))
          group by part, case when k > {WINDOW_ROWS // 2} then event_time_utc end"""
    ),
    "k5_bulk_requests": on_latest(
        f"select {_action('earthquake-latest-event-v1', 'event_id')} as action_line,"
        f" {LATEST_DOCUMENT} as document_line from latest"
    ),
}
