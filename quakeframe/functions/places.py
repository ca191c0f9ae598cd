"""Region, city, state and severity as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity names with their exclusive upper magnitude, weakest first.
# A magnitude at or above the last bound, or NaN, is extreme.
SEVERITY_BOUNDS = (("small", 4.0), ("moderate", 5.0), ("strong", 6.0), ("severe", 7.0))
SEVERITY_MISSING = "unknown"
SEVERITY_TOP = "extreme"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def region_text_expr(place: str | Column) -> Column:
    """What follows the last " of " of a place; the whole place where there is none."""
    # substring_index returns its whole input when the delimiter does not occur.
    tail = F.substring_index(F.trim(as_column(place)), " of ", -1)
    return _blank_to_null(F.trim(tail))


def city_expr(region_text: str | Column, blank_as_null: bool = False) -> Column:
    """What precedes the first comma; an empty part is '' unless ``blank_as_null``."""
    region = F.trim(as_column(region_text))
    city = F.when(region != "", F.trim(F.substring_index(region, ",", 1)))
    return _blank_to_null(city) if blank_as_null else city


def state_expr(region_text: str | Column, blank_as_null: bool = False) -> Column:
    """What follows the last comma; null where there is no comma."""
    region = F.trim(as_column(region_text))
    state = F.when(F.contains(region, F.lit(",")), F.trim(F.substring_index(region, ",", -1)))
    return _blank_to_null(state) if blank_as_null else state


def severity_conditions(magnitude: str | Column) -> dict[str, Column]:
    """One boolean per severity; exactly one of them is true for every row."""
    mag = as_column(magnitude)
    conditions = {SEVERITY_MISSING: mag.isNull()}
    lower = None
    for name, upper in SEVERITY_BOUNDS:
        below = mag < upper
        conditions[name] = below if lower is None else (mag >= lower) & below
        lower = upper
    # NaN sorts above every number, so it satisfies this comparison.
    conditions[SEVERITY_TOP] = mag >= lower
    return conditions


def severity_expr(magnitude: str | Column) -> Column:
    """Severity name of a magnitude."""
    labelled = [F.when(test, F.lit(name)) for name, test in severity_conditions(magnitude).items()]
    return F.coalesce(*labelled)
