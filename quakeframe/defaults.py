"""Fixed values of the data model: limits, topic names and index names."""

BACKFILL_WINDOW_DAYS = 30
MAX_WINDOW_DAYS = 366
SUPPRESS_TTL_SECONDS = 3_600

STREAM_BATCH_MESSAGES = 100
STREAM_BATCH_WAIT_SECONDS = 60

RAW_TOPIC = "earthquake.raw.v1"
BACKFILL_TOPIC = "earthquake.backfill.v1"

LATEST_INDEX = "earthquake-latest-event-v1"
HOURLY_INDEX = "earthquake-region-hourly-v1"

CALENDAR_PARTITIONS = ("year", "month", "day")
