"""Search documents and the two-line form a bulk request takes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quakeframe.defaults import HOURLY_INDEX, LATEST_INDEX
from quakeframe.functions.times import iso_date_expr, iso_text_expr
from quakeframe.functions.values import geo_point_expr

REQUEST_ROWS = 500
REQUEST_BYTES = 5 << 20
REQUEST_DDL = "document_count bigint, byte_count bigint, body string"
WITH_NULLS = {"ignoreNullFields": "false"}


def document_value(field: T.StructField) -> Column:
    """Times and dates as ISO text, decimals as doubles, the rest unchanged."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        column = iso_text_expr(column)
    elif isinstance(field.dataType, T.DateType):
        column = iso_date_expr(column)
    elif isinstance(field.dataType, T.DecimalType):
        column = column.cast("double")
    return column.alias(field.name)


def bulk_documents(
    df: DataFrame, index_name: str, id_column: str, latitude: str, longitude: str
) -> DataFrame:
    """Columns ``document_id``, ``action_line`` and ``document_line`` for every row.

    Nulls stay in the document. ``location`` is there only when both coordinates are.
    A row without an id fails the job.
    """
    identified = F.when(F.col(id_column) != "", F.col(id_column)).otherwise(
        F.raise_error(F.lit(f"a row has no {id_column}"))
    )
    values = [document_value(field) for field in df.schema.fields]
    location = geo_point_expr(latitude, longitude)
    document = F.when(
        location.isNotNull(),
        F.to_json(F.struct(*values, location.alias("location")), WITH_NULLS),
    ).otherwise(F.to_json(F.struct(*values), WITH_NULLS))
    action = F.struct(F.lit(index_name).alias("_index"), identified.alias("_id"))
    return df.select(
        identified.alias("document_id"),
        F.to_json(F.struct(action.alias("index"))).alias("action_line"),
        document.alias("document_line"),
    )


def latest_documents(latest: DataFrame, index_name: str = LATEST_INDEX) -> DataFrame:
    return bulk_documents(latest, index_name, "event_id", "latitude", "longitude")


def hourly_documents(hourly: DataFrame, index_name: str = HOURLY_INDEX) -> DataFrame:
    return bulk_documents(hourly, index_name, "document_id", "avg_latitude", "avg_longitude")


def bulk_lines(documents: DataFrame) -> DataFrame:
    """One text value per document: its action line, a line break, its document line."""
    return documents.select(F.concat_ws("\n", "action_line", "document_line").alias("value"))


def request_starts(sizes: np.ndarray, max_rows: int, max_bytes: int) -> np.ndarray:
    """Which of the documents begin a request, so that none has more rows or bytes than allowed.

    Documents that begin in the same half of ``max_bytes`` and are no longer than a half go together;
    a longer one has a request of its own.
    """
    half = max_bytes // 2
    large = sizes > half
    first = np.cumsum(sizes) - sizes
    part = first // max(1, half)
    starts = np.ones(len(sizes), dtype=bool)
    starts[1:] = (part[1:] != part[:-1]) | large[1:] | large[:-1]
    # Too many rows between two starts begin more.
    since = np.arange(len(sizes)) - np.maximum.accumulate(np.where(starts, np.arange(len(sizes)), 0))
    return starts | (since % max_rows == 0)


def bulk_requests(documents: DataFrame, max_rows: int = REQUEST_ROWS, max_bytes: int = REQUEST_BYTES) -> DataFrame:
    """Whole bulk requests: ``body`` holds the lines of at most ``max_rows`` documents and ``max_bytes`` bytes.

    Requests are cut inside each partition, without a shuffle, and a file that they are written to holds
    many of them. A document that is too long for any request fails the job.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for batch in batches:
            held += [x.encode() for x in batch["value"].to_pylist()]
            if sum(map(len, held)) > 4 * max_bytes or len(held) > 4 * max_rows:
                # The last request may go on with the next batch.
                bodies, held = requests(held, False)
                yield bodies
        if held:
            yield requests(held, True)[0]

    def requests(lines: list[bytes], whole: bool) -> tuple[pa.RecordBatch, list[bytes]]:
        sizes = np.array([len(x) for x in lines])
        if sizes.max() > max_bytes:
            raise ValueError(f"a document of {sizes.max()} bytes is longer than a request")
        starts = np.flatnonzero(request_starts(sizes, max_rows, max_bytes)).tolist()
        ends = [*starts[1:], len(lines)]
        if not whole:
            last, starts, ends = starts[-1], starts[:-1], ends[:-1]
        parts = [lines[i:j] for i, j in zip(starts, ends, strict=True)]
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([len(x) for x in parts], pa.int64()),
                pa.array([sum(map(len, x)) for x in parts], pa.int64()),
                pa.array([b"".join(x).decode() for x in parts], pa.string()),
            ],
            ["document_count", "byte_count", "body"],
        )
        return out, [] if whole else lines[last:]

    lines = bulk_lines(documents).select(F.concat("value", F.lit("\n")).alias("value"))
    return lines.mapInArrow(cut, REQUEST_DDL)


# Send what runs in Python workers by value, so that they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
