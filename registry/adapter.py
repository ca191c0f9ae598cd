"""Seismic rows derived from the ``events`` table, in Spark and in SQL alike.

Four consecutive events become four revisions of one seismic event. Some rows get blank
places, missing magnitudes or times, or a payload with a defect, so that every rule of
the operators meets its edge rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.functions.times import calendar_columns, epoch_ms_expr
from quakeframe.schemas import FLAT_EVENT_COLUMNS
from quakeframe.session import prepare_session
from quakeframe.sources.tables import table_scan

# (column, expression): the same text in both dialects but for {MS}, epoch milliseconds.
RAW_COLUMNS = (
    ("n", "event_id"),
    ("revision", "cast(event_id % 4 as int)"),
    ("is_redelivered", "event_id % 6 = 0"),
    ("event_id", "concat('e', cast(cast(floor(event_id / 4) as bigint) as string))"),
    ("event_ms", "{MS} - (event_id % 4) * 60000"),
    ("updated_ms", "case when event_id % 10 = 0 then null else {MS} end"),
    ("observed_ms", "{MS}"),
    (
        "place",
        "case event_id % 7 when 0 then null when 1 then '   '"
        " when 2 then concat('near City', cast(user_id % 20 as string))"
        " when 3 then concat('5 km S of City', cast(user_id % 20 as string), ',')"
        " when 4 then concat('edge of part of City', cast(user_id % 20 as string), ', Bay, ST',"
        " cast(user_id % 5 as string))"
        " else concat('12 km NE of City', cast(user_id % 20 as string), ', ST',"
        " cast(user_id % 5 as string)) end",
    ),
    ("mag", "case when event_id % 17 = 0 then null else value / 20.0 end"),
    (
        "longitude",
        "cast((user_id * 37) % 360 - 180 as double) + cast(event_id % 4 as double) / 4",
    ),
    ("latitude", "cast((user_id * 17) % 180 - 90 as double)"),
    ("depth_km", "cast(user_id % 60 as double) / 2"),
    ("tsunami", "cast(case when event_type = 'error' then 1 else 0 end as int)"),
    ("mag_type", "case event_id % 3 when 0 then 'ml' when 1 then 'mb' else null end"),
    ("sig", "cast(user_id % 1000 as int)"),
    ("alert", "case when event_type = 'purchase' then 'green' else null end"),
    ("status", "case when event_type = 'view' then 'automatic' else 'reviewed' end"),
    ("nst", "cast(event_id % 50 as int)"),
    ("gap", "value"),
    ("user_id", "user_id"),
    ("event_type", "event_type"),
    ("bad_json", "event_id % 31 = 0"),
    ("is_blast", "event_id % 23 = 0"),
    ("is_polygon", "event_id % 29 = 0"),
    ("no_geometry", "event_id % 53 = 0"),
    ("mag_as_text", "event_id % 13 = 0"),
    ("tsunami_fraction", "event_id % 19 = 0"),
    ("short_point", "event_id % 37 = 0"),
    ("blank_id", "event_id % 41 = 0"),
    ("number_id", "event_id % 43 = 0"),
    ("time_as_text", "event_id % 47 = 0"),
)

RAW_SQL = "select {} from events".format(
    ", ".join(f"{sql.format(MS='(epoch_us(ts) // 1000)')} as {name}" for name, sql in RAW_COLUMNS)
)

SOURCE_FEED = "feed"
INGEST_TIME = "2024-02-01 00:00:00"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_scan(prepare_session(spark), f"{sf_dir}/events.parquet")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = "unix_millis(cast(ts as timestamp))"
    return events(spark, sf_dir).selectExpr(
        *[f"{sql.format(MS=millis)} as {name}" for name, sql in RAW_COLUMNS]
    )


def spread(raw: DataFrame) -> DataFrame:
    """Deal the rows out for the JSON work, which is heavier than the scan."""
    return raw.repartition(raw.sparkSession.sparkContext.defaultParallelism, "n")


def flat_rows(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 25 columns of a fact table, after the columns of ``keep``."""
    return flat_from_raw(raw_rows(spark, sf_dir), keep)


def flat_from_raw(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    typed = raw.withColumns(
        {
            "event_time_utc": epoch_ms_expr("event_ms"),
            "updated_time_utc": epoch_ms_expr("updated_ms"),
            **{name: F.lit(None).cast("int") for name in ("tz", "felt")},
            **{name: F.lit(None).cast("double") for name in ("cdi", "mmi", "dmin", "rms")},
        }
    )
    return typed.select("*", *calendar_columns("event_time_utc")).select(*keep, *FLAT_EVENT_COLUMNS)


def _json(value: str) -> str:
    """JSON of a nullable column whose text needs no escapes."""
    return f"coalesce(concat('\"', {value}, '\"'), 'null')"


def _number(value: str) -> str:
    return f"coalesce(cast({value} as string), 'null')"


def feature_json() -> Column:
    mag = f"case when mag_as_text then {_json('cast(mag as string)')} else {_number('mag')} end"
    time = f"case when time_as_text then {_json('cast(event_ms as string)')} else {_number('event_ms')} end"
    tsunami = "case when tsunami_fraction then '1.7' else cast(tsunami as string) end"
    point = (
        "concat('[', cast(longitude as string), case when short_point then '' else"
        " concat(',', cast(latitude as string), ',', cast(depth_km as string)) end, ']')"
    )
    kind = "case when is_polygon then 'Polygon' else 'Point' end"
    geometry = f"concat('{{\"type\":\"', {kind}, '\",\"coordinates\":', {point}, '}}')"
    pieces = [
        ("mag", mag), ("place", _json("place")), ("time", time),
        ("updated", _number("updated_ms")), ("tsunami", tsunami), ("sig", _number("sig")),
        ("magType", _json("mag_type")), ("alert", _json("alert")), ("status", _json("status")),
        ("nst", _number("nst")), ("gap", _number("gap")),
        ("type", "case when is_blast then '\"quarry blast\"' else '\"earthquake\"' end"),
        ("extra", "'\"kept\"'"),
    ]
    properties = ", ".join(
        f"'{',' if at else ''}\"{name}\":', {sql}" for at, (name, sql) in enumerate(pieces)
    )
    return F.expr(
        f"""concat('{{"type":"Feature","id":"', event_id, '","properties":{{', {properties},
        '}},"geometry":', case when no_geometry then 'null' else {geometry} end, '}}')"""
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n``, ``key`` and ``payload_json``: one envelope text per event, defects included."""
    id_json = (
        "case when blank_id then '\"\"' when number_id then cast(n as string)"
        " else concat('\"', event_id, '\"') end"
    )
    head = F.expr(
        f"""concat('{{"event_id":', {id_json}, ',"source_feed":"{SOURCE_FEED}",'
        '"source_mode":"realtime","ingest_time_utc":"2024-02-01T00:00:00Z",'
        '"published_topic":"t","request_window_start":null,"request_window_end":null,'
        '"feature":')"""
    )
    whole = F.concat(head, feature_json(), F.lit("}"))
    broken = F.concat(F.lit('{"event_id":"'), F.col("event_id"))
    payload = F.when(F.col("bad_json"), broken).otherwise(whole).alias("payload_json")
    return spread(raw_rows(spark, sf_dir)).select("n", F.col("event_id").alias("key"), payload)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id``, ``feature`` as a variant, and the raw columns."""
    return spread(raw_rows(spark, sf_dir)).withColumn("feature", F.parse_json(feature_json()))


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature collections of at most 500 features each, as text."""
    listed = raw_rows(spark, sf_dir).groupBy(F.floor(F.col("n") / 500).alias("document")).agg(
        F.array_sort(F.collect_list(F.struct("n", feature_json().alias("body")))).alias("items")
    )
    body = F.array_join(F.col("items.body"), ",")
    return listed.select(
        "document",
        F.concat(
            F.lit('{"type":"FeatureCollection","metadata":{"url":"'),
            F.concat(F.lit("u"), F.col("document").cast("string")),
            F.lit('","title":"t","status":200},"features":['),
            body,
            F.lit("]}"),
        ).alias("value"),
    )
