"""Small builders shared by the tests."""

import json
from datetime import datetime, timedelta

from quakeframe.schemas import FLAT_EVENT_COLUMNS, FLAT_EVENT_DDL

T0 = datetime(2024, 1, 1)
GOOD_TIME = 1_700_000_000_123


def at(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def flat_frame(spark, rows):
    """Rows of (event_id, updated seconds, event time seconds, mag)."""
    full = []
    for event_id, updated, event_time, mag in rows:
        row = dict.fromkeys(FLAT_EVENT_COLUMNS)
        row.update(
            event_id=event_id, updated_time_utc=at(updated), event_time_utc=at(event_time), mag=mag,
            event_date=at(event_time).date(), year=2024, month=1, day=at(event_time).day,
        )
        full.append(tuple(row[name] for name in FLAT_EVENT_COLUMNS))
    return spark.createDataFrame(full, FLAT_EVENT_DDL)


def envelope(event_id, properties=None, geometry="default", **more):
    """Envelope text; the defaults make a good earthquake."""
    values = {"mag": 1.5, "time": GOOD_TIME, "type": "earthquake", "place": "x", **(properties or {})}
    if geometry == "default":
        geometry = {"type": "Point", "coordinates": [1.0, 2.5, 3]}
    feature = {"type": "Feature", "id": event_id, "properties": values, "geometry": geometry}
    return json.dumps({"event_id": event_id, "feature": feature, **more})


def keys(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())
