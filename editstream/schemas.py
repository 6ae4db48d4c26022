"""One fixed StructType per table, declared once."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The driver's click-stream table the replay fixture is derived from.
EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])

_PAIR = StructType([StructField("old", LongType()), StructField("new", LongType())])

# Fixed values (wire field names and types).
# Raw change event as it comes off the feed; `length` / `revision` may be absent.
RAW_EVENT = StructType([
    StructField("id", LongType()),
    StructField("type", StringType()),
    StructField("wiki", StringType()),
    StructField("title", StringType()),
    StructField("namespace", LongType()),
    StructField("user", StringType()),
    StructField("bot", BooleanType()),
    StructField("minor", BooleanType()),
    StructField("comment", StringType()),
    StructField("timestamp", LongType()),
    StructField("server_url", StringType()),
    StructField("server_name", StringType()),
    StructField("length", _PAIR),
    StructField("revision", _PAIR),
])

# Fixed values (wire field names and types).
# Trimmed edit: the flat 18-field record published per edit, keyed by wiki.
EDIT = StructType([
    StructField("id", LongType()),
    StructField("type", StringType()),
    StructField("wiki", StringType()),
    StructField("title", StringType()),
    StructField("namespace", LongType()),
    StructField("user", StringType()),
    StructField("bot", BooleanType()),
    StructField("minor", BooleanType()),
    StructField("comment", StringType()),
    StructField("timestamp", LongType()),
    StructField("server_url", StringType()),
    StructField("server_name", StringType()),
    StructField("length_old", LongType()),
    StructField("length_new", LongType()),
    StructField("length_delta", LongType()),
    StructField("revision_old", LongType()),
    StructField("revision_new", LongType()),
    StructField("ingestion_ts", LongType()),
])
EDIT_COLUMNS = [f.name for f in EDIT.fields]

LANGUAGE_DIM = StructType([
    StructField("wiki", StringType()),
    StructField("language", StringType()),
    StructField("continent", StringType()),
    StructField("region", StringType()),
    StructField("primary_country", StringType()),
])
DIM_COLUMNS = [f.name for f in LANGUAGE_DIM.fields]

# Fixed values (wire field names and types).
# Cells kept per wiki in the live snapshot (key: wiki).
LIVE_COLUMNS = [
    "type", "title", "user", "namespace", "server_name",
    "length_old", "length_new", "length_delta",
    "timestamp", "bot", "minor", "ingestion_ts",
]

# Fixed values (wire field names and types).
# Cells kept per wiki in the enriched snapshot (key: wiki).
ENRICHED_COLUMNS = [
    "type", "title", "user", "bot", "length_delta",
    "language", "continent", "region", "primary_country",
]

# Metric table: key (wiki, window_end_epoch).
METRIC = StructType([
    StructField("wiki", StringType()),
    StructField("window_end_epoch", LongType()),
    StructField("edit_count", LongType()),
    StructField("avg_delta", DoubleType()),
])

# Arrival order for "latest": ingestion second, then event id.
ARRIVAL_ORDER = ["ingestion_ts", "id"]
