"""The language dimension: bundled rows or a JSON Lines / CSV file on shared storage."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import LANGUAGE_DIMENSION_CSV
from ..schemas import DIM_COLUMNS, LANGUAGE_DIM

# A broadcast side must stay below this many bytes; above it the join shuffles.
MAX_BROADCAST_BYTES = 20 << 20
ROW_BYTES = 64     # of a row beside its strings


def dimension_rows() -> list[tuple]:
    return [tuple(r) for r in csv.reader(io.StringIO(LANGUAGE_DIMENSION_CSV))]


def language_dim(spark: SparkSession, path: str | None = None, fmt: str = "json") -> DataFrame:
    """The 5-column dimension. ``path`` reads a shared JSON Lines/CSV file with a
    fixed schema (only these 5 columns are read); without it, the bundled
    88 rows are used as an in-memory relation of exactly known size."""
    if path is None:
        return spark.createDataFrame(dimension_rows(), LANGUAGE_DIM)
    reader = spark.read.schema(LANGUAGE_DIM)
    df = reader.json(path) if fmt == "json" else reader.option("header", "true").csv(path)
    return df.select(*DIM_COLUMNS)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a static side of strings is proven to stay below the bound: its
    bytes are summed in one pass over it."""
    if df.isStreaming:
        return False
    most = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    row = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in df.columns), F.lit(ROW_BYTES))
    return (df.agg(F.sum(row.cast("long"))).first()[0] or 0) <= most


def checked_broadcast(df: DataFrame, max_bytes: int | None = None, known_rows: int | None = None) -> DataFrame | None:
    """``df`` with a broadcast hint, or None if it is not proven small enough.

    ``known_rows``: the rows of the bundled dimension, whose size is fixed and
    needs no pass.
    """
    small = known_rows is not None and known_rows <= len(dimension_rows())
    return F.broadcast(df) if small or fits_broadcast(df, max_bytes) else None


def bundled_dim_rows() -> int:
    return len(dimension_rows())
