"""Cleaning: feed text -> raw events -> trimmed edits -> keyed records and back.

Every function is DataFrame -> DataFrame, made of built-in expressions only
(no Python UDFs), and works unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import COMMENT_MAX_CHARS, FEED_DATA_PREFIX
from ..schemas import EDIT, EDIT_COLUMNS, RAW_EVENT


def parse_feed_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Event-feed text (one line per row) -> raw change events.

    Only lines that start exactly with ``data: `` carry an event; blank,
    ``event:``, ``id:`` and comment lines are ignored and multi-line events are
    not joined. A payload that does not decode to a JSON object is dropped
    silently; a wrong-typed field only nulls that field.
    """
    line = F.col(line_col)
    payload = F.expr(f"substr({line_col}, {len(FEED_DATA_PREFIX) + 1})")
    data = lines.where(line.startswith(FEED_DATA_PREFIX)).select(payload.alias("payload"))
    decodable = (F.expr("try_parse_json(payload)").isNotNull()
                 & F.ltrim(F.col("payload")).startswith("{"))
    return (data.where(decodable)
            .select(F.from_json("payload", RAW_EVENT).alias("e"))
            .select("e.*"))


def trim_events(raw: DataFrame, ingestion_ts: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Raw nested event -> the flat 18-field edit.

    Missing ``bot``/``minor`` become false, the comment is cut to its first
    240 code points, the size delta exists only when both sizes do, and the
    ingestion stamp is the SQL expression ``ingestion_ts`` (default: the
    column of that name when present, so replays are deterministic, else the
    current wall-clock second). ``carry`` keeps extra columns.
    """
    if ingestion_ts is None:
        ingestion_ts = ("ingestion_ts" if "ingestion_ts" in raw.columns
                        else "unix_timestamp(current_timestamp())")
    return raw.selectExpr(
        "CAST(id AS BIGINT) AS id", "type", "wiki", "title",
        "CAST(namespace AS BIGINT) AS namespace", "user",
        "coalesce(bot, false) AS bot",
        "coalesce(minor, false) AS minor",
        f"substring(coalesce(comment, ''), 1, {COMMENT_MAX_CHARS}) AS comment",
        "CAST(timestamp AS BIGINT) AS timestamp",
        "server_url", "server_name",
        "length.old AS length_old",
        "length.new AS length_new",
        "length.new - length.old AS length_delta",
        "revision.old AS revision_old",
        "revision.new AS revision_new",
        f"CAST({ingestion_ts} AS BIGINT) AS ingestion_ts", *carry,
    )


def has_wiki() -> Column:
    """wiki is neither null nor empty (one reference, so a pushed-down copy of
    the predicate evaluates the wiki expression once)."""
    return F.length(F.col("wiki")) > 0


def valid_edits(edits: DataFrame) -> DataFrame:
    """Drop edits without a wiki (null or empty) — applied once, up front."""
    return edits.where(has_wiki())


def to_keyed_json(edits: DataFrame, carry: list[str] | None = None, mark: Column | None = None) -> DataFrame:
    """Keyed record for the log: key = wiki, value = JSON of the 18 fields.

    Nulls are written as explicit JSON nulls. Rows without a wiki are not
    published. ``carry`` keeps extra columns (e.g. a target partition). Rows
    for which ``mark`` holds are a source's marks: records without key and value.
    """
    value = F.to_json(F.struct(*[F.col(c) for c in EDIT_COLUMNS]),
                      {"ignoreNullFields": "false"})
    if mark is None:
        return valid_edits(edits).select(F.col("wiki").alias("key"), value.alias("value"), *(carry or []))
    return edits.where(mark | has_wiki()).select(
        F.when(~mark, F.col("wiki")).alias("key"), F.when(~mark, value).alias("value"), *(carry or []))


def decode_edits(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Keyed records (value bytes or text) -> typed edits with ``event_time``.

    Carries the log position columns ``partition`` and ``offset`` when the
    source has them. Records with an empty key are left out unread (the key is
    the wiki). Undecodable values yield all-null rows, which ``valid_edits``
    removes. ``inline`` keeps later filters above it, so a value is parsed once.
    """
    carry = [c for c in ("partition", "offset") if c in records.columns]
    if "key" in records.columns:
        records = records.where(F.length(F.col("key").cast("string")) > 0)
    decoded = records.select(
        *carry, F.inline(F.array(F.from_json(F.col(value_col).cast("string"), EDIT))))
    return with_event_time(decoded.select(*EDIT_COLUMNS, *carry))


def with_event_time(edits: DataFrame) -> DataFrame:
    """Event time is the ingestion second (so the watermark is monotonic)."""
    return edits.withColumn("event_time", F.timestamp_seconds(F.col("ingestion_ts")))
