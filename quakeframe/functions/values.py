"""Tolerant casts, coordinates, lists and keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quakeframe.functions.places import as_column

# Fixed value: what stands for a null part inside a hashed key.
NULL_KEY_PART = "__null__"
SUFFIXED = r"^\s*[-+0-9.eE]*[0-9.][dDfFlL]\s*$"


def to_decimal_expr(value: str | Column, precision: int, scale: int) -> Column:
    """Round a double to a decimal; null when it does not fit, or is NaN."""
    return as_column(value).try_cast(f"decimal({precision},{scale})")


def _plain_number(value: Column) -> Column:
    """A variant leaf, null where it is text with a suffix such as "3.2d" or "5f".

    The cast reads these letters as kinds of numbers; as data they are not numeric.
    """
    # Only text is looked at as text; numbers are most of the leaves.
    plain = ~F.try_variant_get(value, "$", "string").rlike(SUFFIXED)
    return F.when((F.schema_of_variant(value) != "STRING") | plain, value)


def to_float_expr(value: Column) -> Column:
    """A variant leaf to double: numbers, booleans and numeric text; else null."""
    return F.try_variant_get(_plain_number(value), "$", "double")


def to_int_expr(value: Column) -> Column:
    """A variant leaf to int: numbers lose their fraction, text must be a whole number."""
    return F.try_variant_get(_plain_number(value), "$", "int")


def coordinate_expr(coordinates: str | Column, index: int) -> Column:
    """One coordinate, null where the array is too short."""
    return F.get(as_column(coordinates), F.lit(index))


def geo_point_expr(latitude: str | Column, longitude: str | Column) -> Column:
    """A {lat, lon} struct, present only when both coordinates are."""
    lat, lon = as_column(latitude), as_column(longitude)
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def comma_delimited_to_array_expr(column_name: str | Column) -> Column:
    """Split text such as ",a,b," at its inner commas; null or only commas gives []."""
    # btrim with a trim set removes the outer commas in one call.
    inner = F.btrim(as_column(column_name), F.lit(","))
    return F.when(inner != "", F.split(inner, ",")).otherwise(F.array().cast("array<string>"))


def hash_key_expr(parts: Iterable[str | Column]) -> Column:
    """SHA-256 of the parts joined by '|', with a marker in place of nulls."""
    texts = [F.coalesce(as_column(part), F.lit(NULL_KEY_PART)) for part in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)
