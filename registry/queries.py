"""One query per operator of the inventory, over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.functions import places, times, values
from quakeframe.operators import (
    dedup,
    documents,
    envelope,
    flatten,
    hourly,
    latest,
    merge,
    metrics,
    rollups,
    suppress,
)
from quakeframe.plans import backfill, realtime, rebuild
from quakeframe.schemas import FLAT_EVENT_COLUMNS, FLAT_EVENT_DDL, HOURLY_COLUMNS, HOURLY_DDL
from quakeframe.session import materialize, prepare_session, scratch_path
from quakeframe.sinks import messages as message_sinks
from quakeframe.sinks import snapshot
from quakeframe.sinks.runs import append_run, compact_runs, read_runs
from quakeframe.sinks.tables import write_partitioned
from quakeframe.sources import landed, messages, windows
from quakeframe.sources.tables import key_scan, table_scan, table_scan_if_exists
from quakeframe.streaming.consumer import batch_writer, consume
from quakeframe.streaming.suppress import suppress_recent_stream, suppressing_writer
from registry import adapter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANGE_START, RANGE_END = date(2024, 1, 5), date(2024, 1, 20)
RUN_START, RUN_END = date(2024, 1, 1), date(2024, 1, 31)
WINDOW_DAYS = 7
STREAM_DAYS = 15
LATE_STEP_DAYS = 5
LATE_DAYS = 3
SEND_TURNS = 3
WINDOW_ROWS = 250
RUN_IDS = ("Jan run", "a+b", "é", "x&y=1/2", "")
FETCH_SECONDS = (0, 1_800, 7_200)
LISTED_IDS = [f"e{number}" for number in range(0, 400, 3)]
USER_TTL_SECONDS = 6 * 3_600
LONG_TTL_SECONDS = 5 * 86_400
RUN_READ_AT = datetime(2024, 3, 1, tzinfo=UTC)


def query(function: Query) -> Query:
    """Register a query under its name; zoned times come out as plain UTC timestamps."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(function(prepare_session(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


def plain_times(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.build_latest_event_df(adapter.flat_rows(spark, sf_dir))


def hourly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.build_region_hourly_stats_df(latest_rows(spark, sf_dir))


def plain_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose text is the same in every engine."""
    body = F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","n":'), F.col("n"), F.lit("}"))
    return adapter.raw_rows(spark, sf_dir).select(F.col("event_id").alias("key"), body.alias("value"))


def file_count(spark: SparkSession) -> int:
    """Message files to write: enough for every core, and for several micro-batches."""
    return max(6, spark.sparkContext.defaultParallelism)


def message_folder(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(spark, "messages")
    message_sinks.publish_files(rows.repartition(file_count(spark)), path)
    return path


def payload_folder(spark: SparkSession, sf_dir: str) -> str:
    rows = adapter.payloads(spark, sf_dir).select("key", F.col("payload_json").alias("value"))
    return message_folder(spark, rows)


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows in windows of the run, with their position and the time they were seen."""
    raw = adapter.raw_rows(spark, sf_dir).withColumns(
        {"day": F.to_date(times.epoch_ms_expr("event_ms")), "observed_at": times.epoch_ms_expr("observed_ms")}
    )
    in_windows = windows.with_chunk(raw, "day", F.lit(RUN_START), F.lit(RUN_END), WINDOW_DAYS)
    return in_windows.filter("chunk_start is not null").withColumnRenamed("n", "position")


# Sources


@query
def s1_table_scan(spark, sf_dir):
    return table_scan(spark, f"{sf_dir}/events.parquet")


@query
def s2_key_scan(spark, sf_dir):
    bought = adapter.raw_rows(spark, sf_dir).filter("event_type = 'purchase'").select("event_id")
    return key_scan(latest_rows(spark, sf_dir), bought)


@query
def s3_full_scan_batches(spark, sf_dir):
    path = scratch_path(spark, "hourly")
    write_partitioned(hourly_rows(spark, sf_dir), path)
    return spark.read.schema(HOURLY_DDL).parquet(path)


@query
def s4_payload_rows(spark, sf_dir):
    path = scratch_path(spark, "payloads")
    plain_messages(spark, sf_dir).select("value").write.text(path)
    return landed.payload_rows(spark, path)


@query
def s5_feature_collection(spark, sf_dir):
    parsed = landed.parse_feature_collection(adapter.collections(spark, sf_dir))
    return landed.explode_features(parsed).select(
        "document", "source_url", "position", "event_id",
        F.try_variant_get("feature", "$.properties.place", "string").alias("place"),
        F.try_variant_get("feature", "$.properties.extra", "string").alias("extra"),
    )


@query
def s6_message_stream(spark, sf_dir):
    folder = message_folder(spark, plain_messages(spark, sf_dir))
    path = scratch_path(spark, "received")
    received = messages.file_message_stream(spark, folder)
    (
        received.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", scratch_path(spark, "offsets"))
        .format("parquet").start(path).awaitTermination()
    )
    return spark.read.schema(messages.MESSAGE_DDL).parquet(path)


@query
def s7_decode_value(spark, sf_dir):
    as_bytes = adapter.events(spark, sf_dir).select("event_id", F.encode("props", "utf-8").alias("value"))
    return as_bytes.select("event_id", messages.decode_value().alias("value"))


@query
def s8_date_chunks(spark, sf_dir):
    bounds = adapter.events(spark, sf_dir).agg(
        F.min(F.to_date("ts")).alias("start_date"), F.max(F.to_date("ts")).alias("end_date")
    )
    return windows.date_chunks(bounds, WINDOW_DAYS)


@query
def s9_catalog_range(spark, sf_dir):
    flat = adapter.flat_rows(spark, sf_dir)
    return windows.catalog_range(flat, RANGE_START, RANGE_END).select(
        "event_id", "event_time_utc", "range_truncated"
    )


# Sinks


@query
def k1_partitioned_write(spark, sf_dir):
    path = scratch_path(spark, "latest")
    write_partitioned(latest_rows(spark, sf_dir), path)
    return spark.read.schema(FLAT_EVENT_DDL).parquet(path)


@query
def k2_clear_then_append(spark, sf_dir):
    path = scratch_path(spark, "facts")
    chunks = windows.with_chunk(
        adapter.flat_rows(spark, sf_dir), "event_date", F.lit(RUN_START), F.lit(RUN_END), WINDOW_DAYS
    ).select(*FLAT_EVENT_COLUMNS)
    write_partitioned(chunks, path)
    write_partitioned(chunks, path, "overwrite")
    return spark.read.schema(FLAT_EVENT_DDL).parquet(path)


@query
def k3_create_or_append(spark, sf_dir):
    path = scratch_path(spark, "facts")
    flat = adapter.flat_rows(spark, sf_dir, keep=("event_type",))
    seen = F.col("event_type").isin("view", "click")
    for run_id, rows in (("seen", flat.filter(seen)), ("rest", flat.filter(~seen)), ("seen", flat.filter(seen))):
        append_run(rows.drop("event_type"), path, run_id)
    return read_runs(spark, path)


@query
def k3_rerun_moved_days(spark, sf_dir):
    """A run repeated with its days moved and rows gone replaces all it had written."""
    path = scratch_path(spark, "facts")
    flat = adapter.flat_rows(spark, sf_dir, keep=("n",))
    append_run(flat.drop("n"), path, "repeated")
    append_run(flat.filter("n % 5 = 1").drop("n"), path)
    moved = flat.filter("n % 3 = 0").withColumn("day", F.lit(1)).drop("n")
    append_run(moved, path, "repeated")
    return read_runs(spark, path).drop("run_id")


@query
def k3_any_run_id(spark, sf_dir):
    """Run ids of any text, each repeated, and once more after all were folded."""
    path = scratch_path(spark, "facts")
    flat = adapter.flat_rows(spark, sf_dir, keep=("n",))
    for turn in range(3):
        for number, run_id in enumerate(RUN_IDS):
            own = flat.filter(F.col("n") % len(RUN_IDS) == number).drop("n")
            append_run(own if turn else own.limit(10), path, run_id)
        if turn == 1:
            compact_runs(spark, path)
    return read_runs(spark, path)


@query
def k4_merge_upsert(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    flat = adapter.flat_rows(spark, sf_dir, keep=("revision",))
    for batch_id in range(4):
        batch = flat.filter(F.col("revision") == batch_id).drop("revision")
        snapshot.upsert_latest(spark, path, batch, batch_id)
        if batch_id == 1:
            snapshot.compact(spark, path, batch_id)
    return snapshot.read_snapshot(spark, path)


def _merged_batches(spark, sf_dir, path, after=None):
    """Four batches by revision in a snapshot; ``after`` is called with the number of each."""
    flat = adapter.flat_rows(spark, sf_dir, keep=("revision",))
    for batch_id in range(4):
        snapshot.upsert_latest(spark, path, flat.filter(F.col("revision") == batch_id).drop("revision"), batch_id)
        if after is not None:
            after(batch_id)


@query
def k4_effective_changes(spark, sf_dir):
    """What each batch changed, and the time of what it replaced."""
    path = scratch_path(spark, "snapshot")
    _merged_batches(spark, sf_dir, path)
    return snapshot.read_changes(spark, path, snapshot.BEFORE_ALL).select("batch_id", "event_id", "updated_time_utc", "before_time_utc")


@query
def t6_changed_ids(spark, sf_dir):
    """Ids whose row changed between the second batch and the last, with a new base between."""
    path = scratch_path(spark, "snapshot")
    _merged_batches(spark, sf_dir, path, lambda n: n in (1, 2) and snapshot.compact(spark, path, n))
    return snapshot.changed_ids(spark, path, since=1)


@query
def t6_incremental_hours(spark, sf_dir):
    """The hourly table built once, and then brought up to date after each batch."""
    path, hourly_path = scratch_path(spark, "snapshot"), scratch_path(spark, "hourly")

    def refresh(batch_id):
        if batch_id == 0:
            rebuild.refresh_hourly(spark, path, hourly_path, scratch_path(spark, "bulk"))
        else:
            rebuild.refresh_hourly_since(spark, path, hourly_path, scratch_path(spark, "bulk"), batch_id - 1)

    _merged_batches(spark, sf_dir, path, refresh)
    return spark.read.schema(HOURLY_DDL).parquet(hourly_path)


@query
def k5_bulk_payload_latest(spark, sf_dir):
    return documents.latest_documents(latest_rows(spark, sf_dir))


@query
def k6_bulk_payload_hourly(spark, sf_dir):
    return documents.hourly_documents(hourly_rows(spark, sf_dir))


@query
def k7_publish_keyed(spark, sf_dir):
    path = scratch_path(spark, "messages")
    message_sinks.publish_files(plain_messages(spark, sf_dir), path)
    return spark.read.schema(messages.MESSAGE_DDL).json(path)


@query
def k8_skip_if_missing(spark, sf_dir):
    missing = table_scan_if_exists(spark, scratch_path(spark, "nothing"))
    present = table_scan_if_exists(spark, f"{sf_dir}/events.parquet")
    return metrics.row_count(present).withColumn("missing_skipped", F.lit(missing is None))


# Projections


def _envelopes(spark, sf_dir):
    return envelope.build_event_envelope(
        adapter.features(spark, sf_dir), adapter.SOURCE_FEED, "backfill", "t",
        times.epoch_ms_expr("observed_ms"), RUN_START, RUN_END, keep=("n",),
    )


@query
def p1_envelope_build(spark, sf_dir):
    extra = F.try_variant_get("feature", "$.properties.extra", "string").alias("extra")
    return _envelopes(spark, sf_dir).select("*", extra).drop("feature")


@query
def p2_envelope_encode(spark, sf_dir):
    encoded = envelope.encode_envelope(_envelopes(spark, sf_dir), keep=("n",))
    return encoded.select(
        "n", "key",
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.ingest_time_utc").alias("ingest_time_utc"),
        F.get_json_object("value", "$.request_window_end").alias("request_window_end"),
        F.get_json_object("value", "$.feature.properties.place").alias("place"),
        F.get_json_object("value", "$.feature.properties.mag").try_cast("double").alias("mag"),
    )


@query
def p3_envelope_decode(spark, sf_dir):
    rows = adapter.payloads(spark, sf_dir).withColumnRenamed("payload_json", "value")
    decoded = envelope.decode_envelope(rows)
    return decoded.select(
        "n",
        F.col("envelope").isNotNull().alias("decoded"),
        F.try_variant_get("envelope", "$.source_mode", "string").alias("source_mode"),
        F.try_variant_get("envelope", "$.feature.properties.sig", "int").alias("sig"),
    )


@query
def p4_flatten_strict(spark, sf_dir):
    return flatten.flatten_strict(adapter.payloads(spark, sf_dir), keep=("n",))


@query
def p5_flatten_lenient(spark, sf_dir):
    return flatten.flatten_lenient(adapter.payloads(spark, sf_dir), keep=("n",))


@query
def p6_calendar_columns(spark, sf_dir):
    timed = adapter.raw_rows(spark, sf_dir).select("n", times.epoch_ms_expr("event_ms").alias("event_time_utc"))
    return times.with_calendar(timed)


@query
def p7_bucket_calendar(spark, sf_dir):
    return hourly_rows(spark, sf_dir).select("document_id", "bucket_start_utc", "year", "month", "day")


@query
def p8_final_select(spark, sf_dir):
    return hourly_rows(spark, sf_dir).select(*HOURLY_COLUMNS)


@query
def p9_drop_helper(spark, sf_dir):
    return latest.dedupe_latest_rows(adapter.flat_rows(spark, sf_dir, keep=("n",)), "n").drop("n")


@query
def p10_geo_point(spark, sf_dir):
    raw = adapter.raw_rows(spark, sf_dir)
    latitude = F.when(~F.col("short_point"), F.col("latitude"))
    located = raw.select("n", values.geo_point_expr(latitude, "longitude").alias("location"))
    return located.select(
        "n", F.col("location").isNotNull().alias("has_location"),
        F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon"),
    )


# Filters: the rows each predicate rejects first


def _rejected(spark, sf_dir, classify, *reasons):
    rows = classify(adapter.payloads(spark, sf_dir), keep=("n",))
    return rows.select("n", "reject_reason").filter(F.col("reject_reason").isin(*reasons))


@query
def f1_parsed(spark, sf_dir):
    return _rejected(spark, sf_dir, flatten.classify_lenient, "not_json")


@query
def f2_has_id(spark, sf_dir):
    return _rejected(spark, sf_dir, flatten.classify_lenient, "no_event_id")


@query
def f3_has_time(spark, sf_dir):
    return _rejected(spark, sf_dir, flatten.classify_strict, "no_event_time")


@query
def f4_is_earthquake(spark, sf_dir):
    return _rejected(spark, sf_dir, flatten.classify_strict, "not_earthquake")


@query
def f5_is_point(spark, sf_dir):
    return _rejected(spark, sf_dir, flatten.classify_strict, "not_point")


@query
def f6_has_structs(spark, sf_dir):
    return _rejected(spark, sf_dir, flatten.classify_lenient, "no_feature", "no_properties", "no_geometry")


@query
def f_reject_counts_strict(spark, sf_dir):
    return flatten.reject_counts(flatten.classify_strict(adapter.payloads(spark, sf_dir)))


@query
def f_reject_counts_lenient(spark, sf_dir):
    return flatten.reject_counts(flatten.classify_lenient(adapter.payloads(spark, sf_dir)))


@query
def f7_bucketable(spark, sf_dir):
    raw = adapter.raw_rows(spark, sf_dir)
    untimed = raw.withColumn("event_ms", F.when(~F.col("time_as_text"), F.col("event_ms")))
    stats = hourly.build_region_hourly_stats_df(adapter.flat_from_raw(untimed))
    return stats.select("document_id", "bucket_start_utc", "event_count")


@query
def f8_top_rank(spark, sf_dir):
    return latest_rows(spark, sf_dir).select("event_id", "updated_time_utc", "event_time_utc")


@query
def f9_key_in(spark, sf_dir):
    return key_scan(adapter.flat_rows(spark, sf_dir), LISTED_IDS)


# Joins and deduplication


def _merge_sides(spark, sf_dir):
    """Earlier and later revisions, each with one row per id; some come in both."""
    extra = ("n", "revision", "is_redelivered")
    flat = adapter.flat_rows(spark, sf_dir, keep=extra)
    earlier = flat.filter("revision < 2")
    later = flat.filter("revision >= 2 or is_redelivered")
    return (
        latest.dedupe_latest_rows(earlier, "n").drop(*extra),
        latest.dedupe_latest_rows(later, "n").drop(*extra),
    )


@query
def j1_latest_merge(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    return merge.merge_latest(target, source)


@query
def j2_merge_counts(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    return merge.merge_counts(target, source)


@query
def d1_latest_in_batch(spark, sf_dir):
    raw = adapter.raw_rows(spark, sf_dir)
    blank = raw.withColumn("event_id", F.when(~F.col("blank_id"), F.col("event_id")).otherwise(F.lit("")))
    return latest.dedupe_latest_rows(adapter.flat_from_raw(blank, keep=("n",)), "n")


@query
def d2_last_wins(spark, sf_dir):
    rows = chunked(spark, sf_dir).select("chunk_start", "event_id", "position", "place", "mag")
    return dedup.unique_features(rows, ["chunk_start"], keep="last")


@query
def d3_first_wins_across(spark, sf_dir):
    rows = chunked(spark, sf_dir).select("chunk_start", "event_id", "position", "place", "mag")
    return dedup.first_across_chunks(dedup.unique_features(rows, ["chunk_start"], keep="last"))


@query
def d4_first_wins_all(spark, sf_dir):
    rows = chunked(spark, sf_dir).select("chunk_start", "event_id", "position", "place", "mag")
    return dedup.first_across_chunks(rows)


def _seen(spark, sf_dir):
    return adapter.raw_rows(spark, sf_dir).select(
        "n", "user_id", "event_type", times.epoch_ms_expr("observed_ms").alias("observed_at")
    )


@query
def d5_suppress_recent(spark, sf_dir):
    return suppress.suppress_recent(
        _seen(spark, sf_dir), ("user_id",), ttl_seconds=USER_TTL_SECONDS, order=("n",)
    )


@query
def d5_suppress_recent_hot_keys(spark, sf_dir):
    return suppress.suppress_recent(
        _seen(spark, sf_dir), ("event_type",), order=("n",)
    )


@query
def d5_suppress_long_ttl(spark, sf_dir):
    """Few keys, each with very many times inside one time to live."""
    return suppress.suppress_recent(
        _seen(spark, sf_dir), ("event_type",), ttl_seconds=LONG_TTL_SECONDS, order=("n",)
    )


@query
def d5_suppress_missing_times(spark, sf_dir):
    """Every seventh row has no time; it counts as seen when the run reads it."""
    seen = _seen(spark, sf_dir).withColumn("observed_at", F.when(F.col("n") % 7 != 0, F.col("observed_at")))
    return suppress.suppress_recent(
        seen, ("user_id",), ttl_seconds=USER_TTL_SECONDS, order=("n",), now=F.lit(RUN_READ_AT)
    )


# Aggregations


@query
def a1_region_hourly_stats(spark, sf_dir):
    return hourly_rows(spark, sf_dir)


def _measure(name, *columns):
    def run(spark, sf_dir):
        return hourly_rows(spark, sf_dir).select("bucket_start_utc", "region_text", *columns)

    run.__name__ = name
    return query(run)


HOURLY_MEASURES = {
    "a1a_event_count": ("event_count",),
    "a1b_tsunami_count": ("tsunami_count",),
    "a1c_mag_count": ("mag_count",),
    "a1d_mag_sum": ("mag_sum",),
    "a1e_max_mag": ("max_mag",),
    "a1f_avg_mag": ("avg_mag",),
    "a1g_severity_counts": tuple(rollups.SEVERITY_COUNTS),
    "a1h_avg_position": ("avg_longitude", "avg_latitude"),
    "a1i_document_id": ("document_id",),
}
for _name, _columns in HOURLY_MEASURES.items():
    _measure(_name, *_columns)


@query
def a2_chunk_metrics(spark, sf_dir):
    return metrics.chunk_metrics(chunked(spark, sf_dir))


@query
def a3_run_metrics(spark, sf_dir):
    """Both modes: a backfill over the windows, and daily fetches with suppression."""
    rows = chunked(spark, sf_dir)
    backfilled = metrics.chunk_metrics(rows).withColumn("mode", F.lit("backfill"))
    # What is fetched live is in no window of the run, and may be of an event before its first day.
    seen = adapter.raw_rows(spark, sf_dir).withColumn("observed_at", times.epoch_ms_expr("observed_ms"))
    fetched = seen.withColumns({"chunk_start": F.to_date("observed_at"), "chunk_end": F.to_date("observed_at")})
    live = metrics.chunk_metrics(
        fetched.withColumn("event_id", F.col("user_id").cast("string")),
        across_chunks=False, ttl_seconds=2 * 86_400,
    ).withColumn("mode", F.lit("realtime"))
    return metrics.run_metrics(backfilled.unionByName(live), ["mode"])


@query
def a4_row_count(spark, sf_dir):
    tables = {
        "flat_event": adapter.flat_rows(spark, sf_dir),
        "latest_event": latest_rows(spark, sf_dir),
        "region_hourly_stats": hourly_rows(spark, sf_dir),
    }
    counted = [metrics.row_count(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def a5_events_over_time(spark, sf_dir):
    return rollups.events_over_time(hourly_rows(spark, sf_dir))


@query
def a6_severity_over_time(spark, sf_dir):
    return rollups.severity_over_time(hourly_rows(spark, sf_dir))


@query
def a7_mag_over_time(spark, sf_dir):
    return rollups.magnitude_over_time(hourly_rows(spark, sf_dir))


@query
def a8_top_regions(spark, sf_dir):
    return rollups.top_regions(hourly_rows(spark, sf_dir))


@query
def a9_tsunami_by_region(spark, sf_dir):
    return rollups.tsunami_by_region(hourly_rows(spark, sf_dir))


@query
def a10_map_points(spark, sf_dir):
    points = rollups.map_points(latest_rows(spark, sf_dir))
    return points.select(
        "event_id", "mag", "place", F.col("location.lat").alias("lat"), F.col("location.lon").alias("lon")
    )


# Windows, order, union


@query
def w1_latest_rank(spark, sf_dir):
    return latest_rows(spark, sf_dir)


@query
def o1_time_order(spark, sf_dir):
    ordered = windows.catalog_range(adapter.flat_rows(spark, sf_dir), RUN_START, RUN_END)
    return ordered.select("event_id", "event_time_utc", "mag")


@query
def u1_append_union(spark, sf_dir):
    path = scratch_path(spark, "facts")
    flat = adapter.flat_rows(spark, sf_dir)
    later = F.col("event_date") >= F.lit(RANGE_START)
    write_partitioned(flat.filter(~later).unionByName(flat.filter(later)), path)
    return spark.read.schema(FLAT_EVENT_DDL).parquet(path)


# Scalar functions


def _region():
    return places.region_text_expr("place")


@query
def x1_epoch_ms(spark, sf_dir):
    return adapter.raw_rows(spark, sf_dir).select(
        "n",
        times.epoch_ms_expr("event_ms").alias("event_time_utc"),
        times.epoch_ms_expr(F.col("event_ms") * 200).alias("beyond_range"),
        times.fractional_epoch_ms_expr(F.col("event_ms") + F.lit(0.5)).alias("half_later"),
    )


@query
def x2_coordinate(spark, sf_dir):
    point = F.when(F.col("short_point"), F.array("longitude")).otherwise(
        F.array("longitude", "latitude", "depth_km")
    )
    return adapter.raw_rows(spark, sf_dir).select(
        "n", *[values.coordinate_expr(point, at).alias(name) for name, at in flatten.COORDINATE_COLUMNS]
    )


@query
def x3_region_text(spark, sf_dir):
    return adapter.raw_rows(spark, sf_dir).select("n", _region().alias("region_text"))


@query
def x4_city(spark, sf_dir):
    return adapter.raw_rows(spark, sf_dir).select(
        "n", places.city_expr(_region()).alias("city"), places.city_expr(_region(), True).alias("city_or_null")
    )


@query
def x5_state(spark, sf_dir):
    return adapter.raw_rows(spark, sf_dir).select(
        "n", places.state_expr(_region()).alias("state"), places.state_expr(_region(), True).alias("state_or_null")
    )


@query
def x6_severity(spark, sf_dir):
    return adapter.raw_rows(spark, sf_dir).select("n", places.severity_expr("mag").alias("severity"))


@query
def x7_hour_bucket(spark, sf_dir):
    time = times.epoch_ms_expr("event_ms")
    return adapter.raw_rows(spark, sf_dir).select("n", times.hour_bucket_expr(time).alias("bucket_start_utc"))


@query
def x8_to_decimal(spark, sf_dir):
    return adapter.raw_rows(spark, sf_dir).select(
        "n",
        values.to_decimal_expr("mag", 10, 4).alias("mag_decimal"),
        values.to_decimal_expr(F.col("longitude") * 100_000, 12, 6).alias("large_decimal"),
    )


@query
def x9_to_float_to_int(spark, sf_dir):
    """Variant leaves that are numbers, numbers as text, other text, and booleans."""
    leaf = F.parse_json(
        F.when(F.col("mag_as_text"), F.concat(F.lit('"'), F.col("gap"), F.lit('"')))
        .when(F.col("blank_id"), F.lit('"x"'))
        .when(F.col("is_blast"), F.lit("true"))
        .otherwise(F.col("gap").cast("string"))
    )
    return adapter.raw_rows(spark, sf_dir).select(
        "n", values.to_float_expr(leaf).alias("as_float"), values.to_int_expr(leaf).alias("as_int")
    )


@query
def x10_comma_list(spark, sf_dir):
    listed = F.concat(F.lit(",,"), F.col("event_id"), F.lit(","), F.coalesce("mag_type", F.lit("")), F.lit(",x,"))
    return adapter.raw_rows(spark, sf_dir).select(
        "n",
        F.array_join(values.comma_delimited_to_array_expr(listed), "/").alias("items"),
        F.size(values.comma_delimited_to_array_expr("mag_type")).alias("type_count"),
    )


@query
def x11_iso_text(spark, sf_dir):
    return adapter.raw_rows(spark, sf_dir).select(
        "n",
        times.iso_text_expr(times.epoch_ms_expr("event_ms")).alias("iso_time"),
        times.iso_text_expr(times.epoch_ms_expr("updated_ms")).alias("iso_updated"),
        times.iso_date_expr(times.epoch_ms_expr("event_ms")).alias("iso_date"),
    )


@query
def x12_hash_key(spark, sf_dir):
    key = values.hash_key_expr(["event_id", "place", "mag_type"])
    return adapter.raw_rows(spark, sf_dir).select("n", key.alias("hash_key"))


@query
def x14_date_parts(spark, sf_dir):
    parts = times.calendar_columns(times.epoch_ms_expr("event_ms"))
    return adapter.raw_rows(spark, sf_dir).select("n", *parts)


@query
def x13_json_parse(spark, sf_dir):
    parsed = flatten.classify_strict(adapter.payloads(spark, sf_dir), keep=("n",))
    return parsed.select("n", "event_id", "mag", "nst", "longitude", "latitude")


# Streams, drained over files


@query
def t1_micro_batch(spark, sf_dir):
    """A third of the files per batch; every batch adds its rows."""
    folder = message_folder(spark, plain_messages(spark, sf_dir))
    path = scratch_path(spark, "batches")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    stream = messages.file_message_stream(spark, folder, max_files=-(-file_count(spark) // 3))
    consume(stream, write, scratch_path(spark, "offsets"), drain=True).awaitTermination()
    return spark.read.schema(messages.MESSAGE_DDL).parquet(path).select("key", "value")


def _consumed(spark, sf_dir, batches=2):
    folder = payload_folder(spark, sf_dir)
    facts, snapshot_path = scratch_path(spark, "facts"), scratch_path(spark, "snapshot")
    writer = batch_writer(facts, snapshot_path, compact_every=2)
    stream = messages.file_message_stream(spark, folder, max_files=-(-file_count(spark) // batches))
    consume(stream, writer, scratch_path(spark, "offsets"), drain=True).awaitTermination()
    return folder, facts, snapshot_path, writer


@query
def t2_batch_write(spark, sf_dir):
    _, facts, _, _ = _consumed(spark, sf_dir)
    return read_runs(spark, facts).select(*FLAT_EVENT_COLUMNS)


@query
def t3_commit_after_write(spark, sf_dir):
    """A whole batch is written again, as after a crash before its commit."""
    folder, facts, _, writer = _consumed(spark, sf_dir, batches=1)
    writer(spark.read.schema(messages.MESSAGE_DDL).json(folder), 0)
    return read_runs(spark, facts).select(*FLAT_EVENT_COLUMNS)


@query
def t4_drain_on_stop(spark, sf_dir):
    _, _, snapshot_path, _ = _consumed(spark, sf_dir)
    return snapshot.read_snapshot(spark, snapshot_path)


def _seen_in_turn(spark, sf_dir):
    """What was seen, as files that follow each other in time; half a month makes a micro-batch."""
    folder, files = scratch_path(spark, "seen"), file_count(spark)
    rows = _seen(spark, sf_dir)
    part = F.floor(F.date_diff(F.to_date("observed_at"), F.lit(RUN_START)) / STREAM_DAYS)
    first, last = rows.agg(F.min(part), F.max(part)).first()
    for number in range(first, last + 1):
        rows.filter(part == number).repartition(files).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)
    return stream, rows.schema


def _seen_out_of_order(spark, sf_dir):
    """What was seen, a third of it five and a third ten days late; half a month makes a micro-batch.

    A last file holds a tick, long after all rows.
    """
    folder, files = scratch_path(spark, "seen"), file_count(spark)
    rows = _seen(spark, sf_dir).withColumn("tick", F.lit(False))
    day = F.date_diff(F.to_date("observed_at"), F.lit(RUN_START)) + F.col("n") % 3 * LATE_STEP_DAYS
    part = F.floor(day / STREAM_DAYS)
    first, last, newest = rows.agg(F.min(part), F.max(part), F.max("observed_at")).first()
    for number in range(first, last + 1):
        rows.filter(part == number).repartition(files).write.mode("append").parquet(folder)
    after = F.lit(newest) + F.expr("interval 1 year")
    tick = spark.range(1).select(
        *[after.alias(x) if x == "observed_at" else F.lit(None).cast(rows.schema[x].dataType).alias(x) for x in rows.columns[:-1]],
        F.lit(True).alias("tick"),
    )
    tick.write.mode("append").parquet(folder)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)
    return stream, rows.schema


def _judged(spark, sf_dir, late_days):
    stream, schema = _seen_out_of_order(spark, sf_dir)
    path = scratch_path(spark, "published")
    published = suppress_recent_stream(
        stream, ("user_id",), ttl_seconds=USER_TTL_SECONDS, order=("n",), late_seconds=late_days * 86_400, beat="tick"
    )
    (
        published.writeStream.trigger(availableNow=True).outputMode("append")
        .option("checkpointLocation", scratch_path(spark, "offsets"))
        .format("parquet").start(path).awaitTermination()
    )
    judged = T.StructType([*schema.fields, T.StructField("mark", T.StringType())])
    return spark.read.schema(judged).parquet(path).drop("tick")


@query
def t5_stateful_suppress(spark, sf_dir):
    """Rows come up to ten days out of order, and wait as long."""
    return _judged(spark, sf_dir, late_days=12).filter("mark is null").drop("mark")


@query
def t5_late_rows(spark, sf_dir):
    """The same rows wait for three days only; those that come later are marked."""
    return _judged(spark, sf_dir, late_days=LATE_DAYS)


@query
def t5_suppress_by_batch(spark, sf_dir):
    """The rule inside foreachBatch, with keys that hold a fifth of the rows each."""
    stream, schema = _seen_in_turn(spark, sf_dir)
    path = scratch_path(spark, "published")

    def publish(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = suppressing_writer(
        publish, scratch_path(spark, "memory"), ("event_type",), order=("n",)
    )
    consume(stream, writer, scratch_path(spark, "offsets"), drain=True).awaitTermination()
    return spark.read.schema(schema).parquet(path).select(*schema.names)


@query
def t6_periodic_refresh(spark, sf_dir):
    _, _, snapshot_path, _ = _consumed(spark, sf_dir)
    hourly_path = scratch_path(spark, "hourly")
    rebuild.refresh_hourly(spark, snapshot_path, hourly_path, scratch_path(spark, "bulk"))
    return spark.read.schema(HOURLY_DDL).parquet(hourly_path)


# Whole routes


@query
def route_backfill_to_hourly(spark, sf_dir):
    """Landed documents, through facts and snapshot, to the hourly table."""
    folder, facts = scratch_path(spark, "documents"), scratch_path(spark, "facts")
    latest_path, hourly_path = scratch_path(spark, "latest"), scratch_path(spark, "hourly")
    adapter.collections(spark, sf_dir).select("value").repartition(file_count(spark)).write.text(folder)
    backfill.run_backfill(
        spark, folder, facts, RUN_START, RUN_END, WINDOW_DAYS, one_per_line=True
    )
    rebuild.rebuild_latest(spark, facts, latest_path)
    rebuild.rebuild_hourly(spark.read.schema(FLAT_EVENT_DDL).parquet(latest_path), hourly_path)
    return spark.read.schema(HOURLY_DDL).parquet(hourly_path)


@query
def route_backfill_messages(spark, sf_dir):
    """Landed documents to the messages of a backfill."""
    parsed = landed.parse_feature_collection(adapter.collections(spark, sf_dir)).drop("document")
    sent = backfill.backfill_messages(parsed, RUN_START, RUN_END, adapter.SOURCE_FEED, WINDOW_DAYS)
    return sent.select(
        "key",
        F.get_json_object("value", "$.source_feed").alias("source_feed"),
        F.get_json_object("value", "$.request_window_start").alias("request_window_start"),
        F.get_json_object("value", "$.request_window_end").alias("request_window_end"),
        F.get_json_object("value", "$.feature.properties.nst").cast("int").alias("nst"),
    )


@query
def route_realtime_messages(spark, sf_dir):
    """One fetch per document, an hour apart; which ids are published, and with what."""
    parsed = landed.parse_feature_collection(adapter.collections(spark, sf_dir))
    fetches = parsed.withColumn("observed_at", F.timestamp_seconds(F.col("document") * 3_600)).drop("document")
    sent = realtime.realtime_messages(fetches, adapter.SOURCE_FEED)
    return sent.select(
        "key",
        F.get_json_object("value", "$.source_feed").alias("source_feed"),
        F.get_json_object("value", "$.ingest_time_utc").alias("ingest_time_utc"),
        F.get_json_object("value", "$.feature.properties.nst").cast("int").alias("nst"),
    )


def _realtime_stream(spark, sf_dir, fetches_per_batch=1):
    """All documents fetched at the hours 0, 0.5 and 2, one fetch in each micro-batch or more.

    Documents are landed as lines of text in several files, which are read a line at a time by many tasks;
    readers of columns hold thousands of documents at once.
    """
    inbox, path, counts = (scratch_path(spark, x) for x in ("fetched", "published", "counts"))
    documents = adapter.collections(spark, sf_dir)
    # No file without a document, so that every fetch has the same number of files.
    files = max(1, min(file_count(spark), documents.select("document").count()))
    dealt = documents.repartitionById(files, F.pmod("document", F.lit(files)).cast("int")).select("value")
    for seconds in FETCH_SECONDS:
        dealt.write.text(f"{inbox}/fetched={seconds}")

    def publish(messages, batch_id):
        messages.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = realtime.realtime_writer(
        publish, scratch_path(spark, "memory"), adapter.SOURCE_FEED, counts_path=counts
    )

    def write(batch, batch_id):
        writer(landed.parse_feature_collection(batch), batch_id)

    stream = spark.readStream.schema("value string, fetched int").option("maxFilesPerTrigger", files * fetches_per_batch).text(inbox)
    seen = stream.select("value", F.timestamp_seconds("fetched").alias("observed_at"))
    consume(seen, write, scratch_path(spark, "offsets"), drain=True).awaitTermination()
    return path, counts


@query
def route_realtime_stream(spark, sf_dir):
    """Landed documents as a stream; an id is silent for an hour after it was published."""
    path, _ = _realtime_stream(spark, sf_dir)
    return spark.read.parquet(path).select(
        "key",
        F.get_json_object("value", "$.source_feed").alias("source_feed"),
        F.get_json_object("value", "$.ingest_time_utc").alias("ingest_time_utc"),
        F.get_json_object("value", "$.feature.properties.nst").cast("int").alias("nst"),
    )


def _fetch_counts(spark, counts):
    return spark.read.parquet(counts).select(
        "observed_at", "source_feed", "source_mode", "topic", "title",
        "fetched_count", "unique_count", "published_count", "duplicate_count",
    )


@query
def a3_realtime_fetch_metrics(spark, sf_dir):
    """What each fetch of the stream brought, with its feed and title."""
    return _fetch_counts(spark, _realtime_stream(spark, sf_dir)[1])


@query
def a3_fetches_in_one_batch(spark, sf_dir):
    """The same counts where one micro-batch holds all fetches."""
    return _fetch_counts(spark, _realtime_stream(spark, sf_dir, len(FETCH_SECONDS))[1])


@query
def d1_arrival_order(spark, sf_dir):
    """Messages of an event that tie in all times, its copies sent one after another: the first stays."""
    rows = adapter.raw_rows(spark, sf_dir).select("event_id", "n")
    copy = F.row_number().over(Window.partitionBy("event_id").orderBy("n"))
    rows = materialize(rows.withColumn("turn", F.least(copy, F.lit(SEND_TURNS))), "copies")
    body = F.to_json(F.struct("event_id", "n")).alias("value")
    folder, path = scratch_path(spark, "messages"), scratch_path(spark, "first")
    for turn in range(1, SEND_TURNS + 1):
        message_sinks.publish_files(rows.filter(F.col("turn") == turn).select(F.col("event_id").alias("key"), body), folder)

    def write(batch, batch_id):
        told = messages.in_arrival_order(batch).select("arrival", F.from_json("value", "event_id string, n int").alias("m")).select("arrival", "m.*")
        tied = told.withColumns({x: F.lit(None).cast("timestamp") for x in ("updated_time_utc", "event_time_utc")})
        first = latest.dedupe_latest_rows(tied, messages.ARRIVAL).select("event_id", "n")
        first.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    stream = messages.file_message_stream(spark, folder)
    consume(stream, write, scratch_path(spark, "offsets"), drain=True).awaitTermination()
    return spark.read.schema("event_id string, n int").parquet(path).select("event_id", "n")


@query
def s9_bounded_windows(spark, sf_dir):
    flat = adapter.flat_rows(spark, sf_dir)
    return windows.bounded_windows(flat, RANGE_START, RANGE_END, WINDOW_ROWS)


@query
def k5_bulk_requests(spark, sf_dir):
    """Whole requests, taken apart again: every document is in one of them."""
    path = scratch_path(spark, "requests")
    message_sinks.write_bulk_requests(documents.latest_documents(latest_rows(spark, sf_dir)), path, 100, 1 << 16)
    requests = spark.read.schema(documents.REQUEST_DDL).json(path)
    lines = requests.select(F.posexplode(F.split(F.rtrim("body", F.lit("\n")), "\n")), "body")
    pair = F.slice(F.split("body", "\n"), F.col("pos") + 1, 2)
    return lines.filter("pos % 2 = 0").select(pair[0].alias("action_line"), pair[1].alias("document_line"))
