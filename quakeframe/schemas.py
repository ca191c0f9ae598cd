"""Schemas of the JSON documents and of the three tables, as DDL text.

Fixed values: the names, types and order of the fields are those of the data itself.
"""

PROPERTIES_DDL = """
    mag double, place string, time bigint, updated bigint, tz int, sig int, felt int,
    cdi double, mmi double, alert string, tsunami int, status string, magType string,
    net string, code string, ids string, sources string, types string, nst int,
    dmin double, rms double, gap double, type string, url string, detail string,
    title string
"""

FEATURE_DDL = f"""
    type string, id string,
    properties struct<{PROPERTIES_DDL}>,
    geometry struct<type string, coordinates array<double>>
"""

ENVELOPE_DDL = f"""
    event_id string, source_feed string, source_mode string, ingest_time_utc string,
    published_topic string, request_window_start string, request_window_end string,
    feature struct<{FEATURE_DDL}>
"""

METADATA_DDL = "generated bigint, title string, status int, url string, count int"

# Features stay variants, so fields this schema does not know survive re-encoding.
COLLECTION_DDL = f"type string, metadata struct<{METADATA_DDL}>, features array<variant>"

# For documents that only become flat rows: typed features, parsed once. The time stays a
# variant, since the date range also accepts it as text.
TYPED_COLLECTION_DDL = f"features array<struct<{FEATURE_DDL}>>".replace("time bigint", "time variant")

FLAT_EVENT_DDL = """
    event_id string, event_time_utc timestamp, updated_time_utc timestamp, place string,
    mag double, mag_type string, longitude double, latitude double, depth_km double,
    tz int, sig int, felt int, cdi double, mmi double, alert string, tsunami int,
    status string, nst int, dmin double, rms double, gap double,
    event_date date, year int, month int, day int
"""

HOURLY_DDL = """
    document_id string, bucket_start_utc timestamp, region_text string, city string,
    state string, event_count bigint, tsunami_count bigint, mag_count bigint,
    mag_sum double, max_mag double, avg_mag double, unknown_count bigint,
    small_count bigint, moderate_count bigint, strong_count bigint, severe_count bigint,
    extreme_count bigint, avg_longitude double, avg_latitude double,
    year int, month int, day int
"""


def column_names(ddl: str) -> list[str]:
    """Top-level names of a flat DDL text."""
    return [field.split()[0] for field in ddl.split(",")]


FLAT_EVENT_COLUMNS = column_names(FLAT_EVENT_DDL)
HOURLY_COLUMNS = column_names(HOURLY_DDL)
