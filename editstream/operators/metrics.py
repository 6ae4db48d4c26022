"""One-minute tumbling metrics per wiki, shared by batch and streaming.

All aggregations are plain ``groupBy(window, wiki)`` so Spark plans a partial
(map-side) HashAggregate before the shuffle: a hot wiki is reduced to one
row per window per input partition before it is exchanged, so it cannot
skew the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import LONG_MAX, ROW_KEY_DIGITS

WINDOW = "1 minute"
WATERMARK_DELAY = "30 seconds"


def _windowed(edits: DataFrame, length: str):
    return edits.groupBy(F.window("event_time", length).alias("window"), F.col("wiki"))


def _with_end(agg: DataFrame) -> DataFrame:
    return agg.select(
        "wiki",
        F.unix_timestamp(F.col("window.end")).alias("window_end_epoch"),
        *[c for c in agg.columns if c not in ("window", "wiki")],
    )


def _counts(edits: DataFrame, length: str) -> DataFrame:
    return _windowed(edits, length).agg(F.count(F.lit(1)).alias("edit_count"))


def _averages(edits: DataFrame, length: str) -> DataFrame:
    return (_windowed(edits.where(F.col("length_delta").isNotNull()), length)
            .agg(F.avg("length_delta").alias("avg_delta")))


def window_edit_count(edits: DataFrame, length: str = WINDOW) -> DataFrame:
    """count(*) per wiki per tumbling window."""
    return _with_end(_counts(edits, length))


def window_avg_delta(edits: DataFrame, length: str = WINDOW) -> DataFrame:
    """avg(length_delta) per wiki per window, only over rows with a delta.

    Windows where a wiki has no delta at all produce no row.
    """
    return _with_end(_averages(edits, length))


def window_metrics(edits: DataFrame, length: str = WINDOW) -> DataFrame:
    """Count and average in ONE aggregation (half the state of two queries).

    ``avg`` skips nulls, so the average is null exactly where the separate
    average query has no row; this equals the full outer merge of the two.
    """
    return _with_end(_windowed(edits, length).agg(
        F.count(F.lit(1)).alias("edit_count"),
        F.avg("length_delta").alias("avg_delta"),
    ))


def metric_merge_outer(edits: DataFrame, length: str = WINDOW) -> DataFrame:
    """The cell-level merge of the two metric writers as a full outer join.

    The join is on the aggregation keys themselves (window, wiki), so both
    sides arrive already hash-partitioned by them and the join adds no
    exchange of its own.
    """
    merged = _counts(edits, length).join(_averages(edits, length), ["window", "wiki"], "full_outer")
    return _with_end(merged).select("wiki", "window_end_epoch", "edit_count", "avg_delta")


def metric_row_key(metrics: DataFrame) -> DataFrame:
    """Newest-first export key ``wiki|%020d(Long.MAX - window_end)``.

    Sorting the export by this key within partitions lists each wiki's newest
    windows first, like a reverse-time row key.
    """
    reverse = (F.lit(LONG_MAX) - F.col("window_end_epoch")).cast("string")
    key = F.concat_ws("|", F.col("wiki"), F.lpad(reverse, ROW_KEY_DIGITS, "0"))
    return metrics.withColumn("row_key", key)
