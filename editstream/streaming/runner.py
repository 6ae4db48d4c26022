"""Start the streaming queries: live snapshot, window metrics, enrichment.

The transforms are the batch functions applied to a streaming DataFrame; only
the sink and trigger differ. Each query has its own checkpoint, so a restart
resumes from the last committed batch and the idempotent sinks absorb a
re-delivered batch.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.clean import parse_feed_lines, to_keyed_json, trim_events
from ..operators.enrich import enrich_for_snapshot
from ..operators.metrics import window_avg_delta, window_edit_count, window_metrics
from ..operators.snapshot import latest_by
from ..schemas import LIVE_COLUMNS
from ..sources.feed import read_feed_text
from . import sinks

# Service cadence (seconds) per query.
LIVE_TRIGGER = "10 seconds"
METRIC_TRIGGER = "30 seconds"
ENRICH_TRIGGER = "15 seconds"

# Judge late rows by the watermark of the batch they arrive in.
ALLOW_MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


class _query_conf:
    """Session settings captured by a streaming query when it starts.

    A query clones the session conf at ``start()``; the number of shuffle
    (state) partitions is then fixed for the life of its checkpoint, so it is
    chosen per query (sized to the stream's rate, not to the batch tables).
    """

    def __init__(self, spark, settings: dict):
        self.spark, self.settings, self.saved = spark, {k: v for k, v in settings.items() if v is not None}, {}

    def __enter__(self):
        for k, v in self.settings.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, str(v))

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def _trigger(writer, trigger):
    if trigger == "available_now":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


# Fold the upsert logs every this many micro-batches in service mode.
COMPACT_EVERY = 100


def start_live(edits: DataFrame, path: str, checkpoint: str, trigger: str = LIVE_TRIGGER,
               name: str = "live_snapshot", partitions: int | None = None,
               compact_every: int | None = None) -> StreamingQuery:
    """Append-mode stream; every batch is upserted into the live table."""
    table = sinks.live_table(path, sinks.arrival_order(edits.columns), compact_every)
    w = (edits.writeStream.queryName(name).outputMode("append")
         .foreachBatch(table).option("checkpointLocation", checkpoint))
    with _query_conf(edits.sparkSession, {SHUFFLE_PARTITIONS: partitions}):
        return _trigger(w, trigger).start()


def start_live_state(edits: DataFrame, path: str, checkpoint: str, trigger: str = LIVE_TRIGGER,
                     name: str = "live_state", partitions: int | None = None,
                     compact_every: int | None = None) -> StreamingQuery:
    """The latest edit of each wiki as state of the stream, update mode.

    A batch is reduced to one row a wiki in each input partition, meets the
    state there is and sends on the wikis that it changed, with their rows as
    they now are; the sink only replaces rows. So the order of arrival holds
    across batches too: an edit that comes late in the log never replaces a
    newer one. The state holds a row a wiki and survives restarts.
    """
    rows = latest_by(edits, "wiki", sinks.arrival_order(edits.columns), LIVE_COLUMNS)
    w = (rows.writeStream.queryName(name).outputMode("update")
         .foreachBatch(sinks.live_table(path, [], compact_every)).option("checkpointLocation", checkpoint))
    with _query_conf(edits.sparkSession, {SHUFFLE_PARTITIONS: partitions}):
        return _trigger(w, trigger).start()


def start_metrics(edits: DataFrame, path: str, checkpoint: str, trigger: str = METRIC_TRIGGER,
                  name: str = "window_metrics", partitions: int | None = None,
                  compact_every: int | None = None) -> StreamingQuery:
    """One stateful aggregation for count and average, update mode.

    State per (window, wiki) is evicted once the watermark passes the window
    end, so it is bounded by (#wikis x open windows). ``partitions`` sets the
    number of state partitions (fixed for the life of the checkpoint).
    """
    w = (window_metrics(edits).writeStream.queryName(name).outputMode("update")
         .foreachBatch(sinks.metric_table(path, compact_every)).option("checkpointLocation", checkpoint))
    with _query_conf(edits.sparkSession, {ALLOW_MULTIPLE: "false", SHUFFLE_PARTITIONS: partitions}):
        return _trigger(w, trigger).start()


def start_metric_writers(edits: DataFrame, path: str, checkpoint: str, trigger: str = METRIC_TRIGGER,
                         partitions: int | None = None, compact_every: int | None = None) -> list[StreamingQuery]:
    """Counts and averages as queries of their own, each with its cell of one
    table: windows without any size delta get a count alone. They run side by
    side; the table merges their cells. ``start_metrics`` keeps half the state."""
    queries = []
    for name, rows in (("window_edit_count", window_edit_count(edits)), ("window_avg_delta", window_avg_delta(edits))):
        w = (rows.writeStream.queryName(name).outputMode("update")
             .foreachBatch(sinks.metric_cell_table(path, compact_every)).option("checkpointLocation", f"{checkpoint}/{name}"))
        with _query_conf(edits.sparkSession, {ALLOW_MULTIPLE: "false", SHUFFLE_PARTITIONS: partitions}):
            queries.append(_trigger(w, trigger).start())
    return queries


def start_enriched(edits: DataFrame, dim: DataFrame, path: str, checkpoint: str,
                   trigger: str = ENRICH_TRIGGER, name: str = "enriched_snapshot",
                   dim_rows: int | None = None, partitions: int | None = None,
                   compact_every: int | None = None) -> StreamingQuery:
    """Stream-static left broadcast join, upserted per batch; the dimension is
    fixed for the life of the query."""
    order = sinks.arrival_order(edits.columns)
    rows = enrich_for_snapshot(edits, dim, dim_rows, extra=order)
    w = (rows.writeStream.queryName(name).outputMode("append")
         .foreachBatch(sinks.enriched_table(path, order, compact_every))
         .option("checkpointLocation", checkpoint))
    with _query_conf(edits.sparkSession, {SHUFFLE_PARTITIONS: partitions}):
        return _trigger(w, trigger).start()


def start_producer(spark: SparkSession, feed_path: str, out: str, checkpoint: str,
                   kind: str = "files", trigger: str = "available_now", max_files: int | None = None,
                   name: str = "publish_edits", **opts) -> StreamingQuery:
    """Landed feed text -> raw events -> trimmed edits -> keyed JSON records.

    Stateless and append-only. ``kind="files"`` writes records as Parquet
    files under ``out`` (exactly-once file sink, no log position); ``kind="kafka"`` writes
    key/value records to topic ``out`` (needs the Kafka connector and
    ``bootstrap``). Edits are stamped with the wall-clock ingestion second.
    """
    lines = read_feed_text(spark, feed_path, streaming=True, max_files_per_trigger=max_files)
    records = to_keyed_json(trim_events(parse_feed_lines(lines)))
    if kind == "kafka":
        w = (records.selectExpr("CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value")
             .writeStream.format("kafka").option("kafka.bootstrap.servers", opts["bootstrap"])
             .option("topic", out))
    elif kind == "files":
        w = records.select("key", "value").writeStream.format("parquet").option("path", out)
    else:
        raise ValueError(f"unknown sink kind: {kind}")
    w = w.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_all(spark: SparkSession, edits: DataFrame, dim: DataFrame, root: str,
              trigger: str | None = None, partitions: int | None = None,
              compact_every: int | None = COMPACT_EVERY) -> list[StreamingQuery]:
    """The three service queries in one session (tables and checkpoints under
    ``root``). Any failure surfaces through ``spark.streams.awaitAnyTermination()``."""
    return [
        start_live(edits, f"{root}/live", f"{root}/_checkpoints/live", trigger or LIVE_TRIGGER,
                   partitions=partitions, compact_every=compact_every),
        start_metrics(edits, f"{root}/metrics", f"{root}/_checkpoints/metrics", trigger or METRIC_TRIGGER,
                      partitions=partitions, compact_every=compact_every),
        start_enriched(edits, dim, f"{root}/enriched", f"{root}/_checkpoints/enriched",
                       trigger or ENRICH_TRIGGER, partitions=partitions, compact_every=compact_every),
    ]


READ = "edits_read"
PROGRESS = ("query_id string, run_id string, batch_id long, num_source_rows long, num_read long, "
            "input_rows_per_second double, processed_rows_per_second double, rows_dropped_by_watermark long")


class ProgressLog(StreamingQueryListener):
    """Writes every batch's progress of the queries that run inside the block.

    Reports are written in small files of ``every`` rows as they come and the
    rest at the end, so none is lost however many batches there are (a query
    itself remembers the last hundred). The block ends when the end of each
    query that it saw start has been reported, which is the last report of a
    query; if one does not come within ``patience`` seconds, that is an error.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100, patience: float = 60):
        self.spark, self.path, self.every, self.patience = spark, path, every, patience
        self.rows, self.files, self.running, self.changed = [], 0, set(), threading.Condition()

    def onQueryStarted(self, event):
        with self.changed:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event):
        p = event.progress
        if str(p.runId) not in self.running:
            return  # another query of the session
        read = (p.observedMetrics or {}).get(READ)
        self.rows.append((
            str(p.id), str(p.runId), int(p.batchId), int(p.numInputRows or 0), None if read is None else int(read["n"]),
            float(p.inputRowsPerSecond or 0), float(p.processedRowsPerSecond or 0),
            sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators or [])))
        if len(self.rows) >= self.every:
            self._flush()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.changed:
            self.running.discard(str(event.runId))
            self.changed.notify_all()

    def _flush(self):
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.parquet(f"{self.path}/p{self.files}")
            self.files += 1

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc):
        with self.changed:
            ended = self.changed.wait_for(lambda: not self.running, self.patience)
        self.spark.streams.removeListener(self)
        self._flush()
        if not ended and exc[0] is None:
            raise TimeoutError(f"no report of the end of {sorted(self.running)}")

    def table(self, spark: SparkSession) -> DataFrame:
        return (spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(self.path)
                if self.files else spark.createDataFrame([], PROGRESS))


def serve(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Waits until one of the queries ends, stops the others, raises a failure."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()
