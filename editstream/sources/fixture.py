"""Replay the driver's ``events`` table as a stream of raw change events.

The event table is a generic click stream; this maps each row onto a raw
change event (FIXTURES.md §2) with integer arithmetic only, so the same
derivation written in SQL gives identical rows. Time is compressed x600 so
that one-minute windows are populated. It is a pure projection: no shuffle,
one output row per input row, and it scales with the input.

The projection is written as SQL expressions (one ``selectExpr`` per stage):
a Column built call by call costs a driver->JVM round trip per literal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import EVENTS

BASE_EPOCH = 1704067200  # 2024-01-01T00:00:00Z
TIME_COMPRESSION = 600

# (upper bound on k, wiki code) — k is the 0..99 bucket in `props`.
WIKI_BUCKETS = [
    (24, "enwiki"), (40, "commonswiki"), (52, "wikidatawiki"), (60, "dewiki"),
    (68, "frwiki"), (74, "jawiki"), (79, "zh_yuewiki"), (83, "ckbwiki"),
    (87, "frwikibooks"), (90, "enwiktionary"), (93, "nepwiki"), (95, "akwiki"),
    (97, "akanwiki"), (98, "zzzwiki"), (99, ""),
]
TYPE_BY_EVENT = {"click": "edit", "purchase": "new", "signup": "log", "view": "categorize"}
NAMESPACE_BY_MOD13 = {4: 1, 5: 2, 6: 3, 7: 6, 8: 14, 9: 14, 10: 102, 11: -1}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``events`` table, read where it lies."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _s(v) -> str:
    return "NULL" if v is None else ("'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v))


def _case_sql(key: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {key} = {_s(k)} THEN {_s(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def _wiki_sql(k: str) -> str:
    """k < 0 -> first bucket; 0..98 index an array of codes (one lookup, so
    the JSON field is read once even where the optimizer inlines it);
    99+ and null -> null."""
    codes, lo = [], 0
    for bound, code in WIKI_BUCKETS:
        codes += [code] * (bound - lo)
        lo = bound
    arr = "array(" + ", ".join(_s(c) for c in codes) + ")"
    return f"CASE WHEN {k} < 0 THEN {_s(WIKI_BUCKETS[0][1])} ELSE try_element_at({arr}, {k} + 1) END"


def flat_raw_columns(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The raw event with its nested pairs shown flat (plus ingestion_ts).
    ``carry``: columns taken along as they are."""
    # Stage 1: the two parsed inputs, each computed once per row.
    base = events.selectExpr(
        "event_id", "event_type", "user_id",
        "try_cast(get_json_object(props, '$.k') AS INT) AS k",
        f"{BASE_EPOCH} + (unix_timestamp(ts) - {BASE_EPOCH}) div {TIME_COMPRESSION} AS minute", *carry,
    )
    fallback = "CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'mystery' ELSE 'external' END"
    namespace = _case_sql("event_id % 13", NAMESPACE_BY_MOD13,
                          "CASE WHEN event_id % 13 = 12 THEN NULL ELSE 0 END")
    no_length = "event_type IN ('signup', 'view')"
    return base.selectExpr(
        "event_id AS id",
        f"{_case_sql('event_type', TYPE_BY_EVENT, fallback)} AS type",
        f"{_wiki_sql('k')} AS wiki",
        "concat('Page_', CAST(event_id % 500 AS STRING)) AS title",
        f"CAST({namespace} AS BIGINT) AS namespace",
        "concat('u', CAST(user_id AS STRING)) AS user",
        "CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id % 3 = 0 END AS bot",
        "CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_id % 2 = 0 END AS minor",
        "CASE WHEN event_id % 29 = 0 THEN NULL ELSE repeat('é', CAST(event_id % 400 AS INT)) END AS comment",
        "minute - event_id % 20 AS timestamp",
        f"CASE WHEN {no_length} THEN NULL ELSE (event_id * 37) % 5000 END AS length_old",
        f"CASE WHEN {no_length} OR event_id % 11 = 0 THEN NULL "
        "ELSE greatest((event_id * 37) % 5000 + event_id % 101 - 50, CAST(0 AS BIGINT)) END AS length_new",
        "CASE WHEN event_type = 'signup' THEN NULL ELSE 1000000 + event_id END AS revision_old",
        "CASE WHEN event_type = 'signup' THEN NULL ELSE 1000001 + event_id END AS revision_new",
        "minute AS ingestion_ts",
        "concat(wiki, '.example.org') AS server_name",
        "concat('https://', wiki, '.example.org') AS server_url", *carry,
    )


def _pair_sql(old: str, new: str, name: str) -> str:
    """A nested {old,new} pair, absent (null) when neither side is known."""
    return (f"CASE WHEN {old} IS NULL AND {new} IS NULL THEN NULL "
            f"ELSE named_struct('old', {old}, 'new', {new}) END AS {name}")


def raw_events(events: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Nested raw change events (RAW_EVENT shape) plus the replay's ingestion_ts."""
    return flat_raw_columns(events, carry).selectExpr(
        "id", "type", "wiki", "title", "namespace", "user", "bot", "minor", "comment",
        "timestamp", "server_url", "server_name",
        _pair_sql("length_old", "length_new", "length"),
        _pair_sql("revision_old", "revision_new", "revision"),
        "ingestion_ts", *carry,
    )


def fixture_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(read_events(spark, sf_dir))
