"""Nested envelopes to flat rows, strictly typed or tolerant, with reject reasons.

Both readers parse a payload once. The parse sits inside ``inline``, because Catalyst
would otherwise copy it into every filter it pushes down and parse the text again there.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.times import (
    calendar_columns,
    epoch_ms_expr,
    fractional_epoch_ms_expr,
)
from quakeframe.functions.values import coordinate_expr, to_float_expr, to_int_expr
from quakeframe.schemas import ENVELOPE_DDL, FLAT_EVENT_COLUMNS

EARTHQUAKE = "earthquake"
POINT = "Point"

# Fixed values, field names of the data and of the flat table: name, JSON field, type.
PROPERTY_COLUMNS = (
    ("place", "place", "string"),
    ("mag", "mag", "double"),
    ("mag_type", "magType", "string"),
    ("tz", "tz", "int"),
    ("sig", "sig", "int"),
    ("felt", "felt", "int"),
    ("cdi", "cdi", "double"),
    ("mmi", "mmi", "double"),
    ("alert", "alert", "string"),
    ("tsunami", "tsunami", "int"),
    ("status", "status", "string"),
    ("nst", "nst", "int"),
    ("dmin", "dmin", "double"),
    ("rms", "rms", "double"),
    ("gap", "gap", "double"),
)
# Position of each flat column in feature.geometry.coordinates.
COORDINATE_COLUMNS = (("longitude", 0), ("latitude", 1), ("depth_km", 2))


def first_failing(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first check that does not hold, in order; null when all hold.

    A check that is null does not hold, as in a filter.
    """
    return F.coalesce(
        *[F.when(~F.coalesce(passed, F.lit(False)), F.lit(name)) for name, passed in checks],
        F.lit(None).cast("string"),
    )


def strict_flat_columns(root: str = "feature") -> list[Column]:
    """Flat columns out of a typed feature struct, without event id and calendar."""
    properties = f"{root}.properties"
    return [
        epoch_ms_expr(f"{properties}.time").alias("event_time_utc"),
        epoch_ms_expr(f"{properties}.updated").alias("updated_time_utc"),
        *[F.col(f"{properties}.{field}").alias(name) for name, field, _ in PROPERTY_COLUMNS],
        *[
            coordinate_expr(f"{root}.geometry.coordinates", index).alias(name)
            for name, index in COORDINATE_COLUMNS
        ],
    ]


def classify_strict(payloads: DataFrame, payload: str = "payload_json", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every payload as a flat row with ``reject_reason``, null for the good ones.

    A value of another JSON type than the schema's reads as null. A payload that is no
    JSON object reads as all nulls.
    """
    envelope = F.from_json(F.col(payload), ENVELOPE_DDL)
    return classify_typed(payloads.select(*keep, F.inline(F.array(envelope))), keep)


def classify_typed(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``classify_strict`` for rows that already hold ``event_id`` and a typed ``feature``."""
    reason = first_failing(
        [
            ("no_event_id", F.col("event_id").isNotNull()),
            ("no_event_time", epoch_ms_expr("feature.properties.time").isNotNull()),
            ("not_earthquake", F.col("feature.properties.type") == EARTHQUAKE),
            ("not_point", F.col("feature.geometry.type") == POINT),
        ]
    )
    flat = parsed.select(
        *keep, "event_id", *strict_flat_columns(), reason.alias("reject_reason")
    )
    return _finish(flat, keep)


def lenient_envelope_ddl() -> str:
    """The fields the flat columns need: text as it is, everything else as variant leaves."""
    fields = [
        f"{field} {'string' if kind == 'string' else 'variant'}" for _, field, kind in PROPERTY_COLUMNS
    ]
    properties = ", ".join([*fields, "time variant", "updated variant", "type string"])
    return (
        f"event_id variant, feature struct<properties struct<{properties}>,"
        " geometry struct<type string, coordinates array<variant>>>"
    )


def _lenient_property(field: str, kind: str) -> Column:
    leaf = F.col(f"feature.properties.{field}")
    if kind == "string":
        return leaf
    return to_int_expr(leaf) if kind == "int" else to_float_expr(leaf)


def classify_lenient(payloads: DataFrame, payload: str = "payload_json", keep: tuple[str, ...] = ()) -> DataFrame:
    """As ``classify_strict``, but numbers may be text and whole numbers may be fractions.

    Text that is no number is null. A fraction loses its decimals where an int is due,
    but a fraction given as text is null there. An event id must be text, and not empty.
    """
    envelope = F.from_json(F.col(payload), lenient_envelope_ddl())
    parsed = payloads.select(*keep, F.col(payload).alias("_payload"), F.inline(F.array(envelope)))
    event_time = fractional_epoch_ms_expr(_lenient_property("time", "double"))
    updated = fractional_epoch_ms_expr(_lenient_property("updated", "double"))
    event_id = F.when(
        F.schema_of_variant("event_id") == "STRING", F.try_variant_get("event_id", "$", "string")
    )
    leaf_checks = [
        ("not_earthquake", F.col("feature.properties.type") == EARTHQUAKE),
        ("not_point", F.col("feature.geometry.type") == POINT),
        ("no_event_id", event_id != ""),
        ("no_event_time", event_time.isNotNull()),
    ]
    shape_checks = [
        ("not_json", F.try_parse_json("_payload").isNotNull()),
        ("no_feature", F.col("feature").isNotNull()),
        ("no_properties", F.col("feature.properties").isNotNull()),
        ("no_geometry", F.col("feature.geometry").isNotNull()),
    ]
    # Leaves exist only inside objects, so good rows skip the checks of the shape and with
    # them the second parse that tells bad JSON from JSON of another shape.
    good = reduce(and_, [passed for _, passed in leaf_checks])
    reason = F.when(good, F.lit(None).cast("string")).otherwise(
        first_failing(shape_checks + leaf_checks)
    )
    flat = parsed.select(
        *keep,
        event_id.alias("event_id"),
        event_time.alias("event_time_utc"),
        updated.alias("updated_time_utc"),
        *[_lenient_property(field, kind).alias(name) for name, field, kind in PROPERTY_COLUMNS],
        *[
            to_float_expr(coordinate_expr("feature.geometry.coordinates", index)).alias(name)
            for name, index in COORDINATE_COLUMNS
        ],
        reason.alias("reject_reason"),
    )
    return _finish(flat, keep)


def _finish(flat: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    with_dates = flat.select("*", *calendar_columns("event_time_utc"))
    return with_dates.select(*keep, *FLAT_EVENT_COLUMNS, "reject_reason")


def accepted(classified: DataFrame) -> DataFrame:
    """The rows that passed every check."""
    return classified.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def flatten_strict(payloads: DataFrame, payload: str = "payload_json", keep: tuple[str, ...] = ()) -> DataFrame:
    return accepted(classify_strict(payloads, payload, keep))


def flatten_lenient(payloads: DataFrame, payload: str = "payload_json", keep: tuple[str, ...] = ()) -> DataFrame:
    return accepted(classify_lenient(payloads, payload, keep))


def reject_counts(classified: DataFrame) -> DataFrame:
    """Rows per outcome; good rows count as 'accepted', so the sum is the input."""
    outcome = F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")
    return classified.groupBy(outcome).agg(F.count(F.lit(1)).alias("row_count"))
