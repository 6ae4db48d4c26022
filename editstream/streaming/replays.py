"""Replay the fixture through the streaming path and read back the tables.

The valid edits are published as keyed log records and landed by 6-minute
slice of ingestion time; a slice is a file per log partition, and the file
source reads one slice per trigger under ``availableNow``. In order, nothing
is late, so every table must equal its batch twin. The late variant holds rows
with ``id % 23 == 0`` back by one slice.

Landing: a distributed prefix count gives each record its offset, and its place
in its slice; a slice is written as ``log_partitions`` files of equal size, which
are dated and then moved into the watched folder, so the source lists slices in
order. A record without key marks every
file (a source's heartbeat), so a slice always has the same number of files. A
session lands each replay once and every replay query reads it with its own
checkpoint.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import to_keyed_json, trim_events, valid_edits
from ..operators.numbering import numbered
from ..plans import catalog
from ..schemas import EDIT_COLUMNS
from .. import storage
from ..session import prepare, scratch_dir
from ..sources import dims, fixture
from ..sources.fixture import BASE_EPOCH
from . import log, runner, sinks
from .sources import edit_stream

SLICE_SECONDS = 360
LATE_MOD = 23
STREAM_PARTITIONS = 24
_CORES: dict[str, int] = {}
COMPACT_EVERY = 6          # twice per 12-slice replay, so the gate covers compaction


def log_partitions(spark: SparkSession) -> int:
    """Log partitions of a replay, files of a slice and state partitions of its
    queries: as the session has shuffle partitions, but no more than the cluster
    has cores to work on them, or ``STREAM_PARTITIONS``: each is a task and
    files in every batch, however few rows it has. Fixed for the life of a
    checkpoint, so the cores of a session are counted once."""
    context = spark.sparkContext
    cores = _CORES.setdefault(context.applicationId, context.defaultParallelism)
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(STREAM_PARTITIONS, cores))


def _slice(late_mod: int | None):
    no = F.floor((F.col("ingestion_ts") - F.lit(BASE_EPOCH)) / F.lit(SLICE_SECONDS)).cast("int")
    if late_mod:
        no = no + F.when(F.col("id") % late_mod == 0, 1).otherwise(0)
    return no


#: Columns of ``events`` that an edit is made of.
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "props"]


def log_places(spark: SparkSession, sf_dir: str, late_mod: int | None = None) -> DataFrame:
    """The events of the valid edits with their place in a keyed log: slice,
    partition and offset: 0, 1, 2, .. in each partition by arrival (slice,
    second, id). A wiki is in one partition; ``slice_place`` numbers the records
    of a slice. Rows stay narrow: the edits' JSON is many times wider."""
    n = log_partitions(spark)
    events = fixture.read_events(spark, sf_dir)
    edits = trim_events(fixture.raw_events(events, EVENT_COLUMNS), carry=EVENT_COLUMNS)
    # ``inline`` keeps the filter above the wiki, so its JSON field is parsed once.
    edits = edits.select(F.inline(F.array(F.struct(*EVENT_COLUMNS, "wiki", "ingestion_ts", "id"))))
    edits = valid_edits(edits).withColumn("slice", _slice(late_mod)).withColumn(
        "partition", F.pmod(F.xxhash64("wiki"), F.lit(n)).cast("int"))
    rows = edits.select(*EVENT_COLUMNS, "slice", "partition", "ingestion_ts", "id")
    return numbered(rows, ["slice", "partition", "ingestion_ts", "id"],
                    {"offset": ["partition"], "slice_place": ["slice"]}).drop("ingestion_ts", "id")


def stage_replay(spark: SparkSession, sf_dir: str, folder: str, late_mod: int | None = None) -> int:
    """Publish the valid edits as log records, staged by slice. Returns the
    number of the last slice.

    A slice is cut into files of equal numbers of records, in the order of
    partition and offset, each written by a task of its own: a wiki that holds
    most of a slice is landed by several tasks. A record's JSON is made where
    it is written, so that it is neither sorted nor shuffled.
    """
    prepare(spark)
    n = log_partitions(spark)
    places = log_places(spark, sf_dir, late_mod)
    places = places.withColumn("file", F.floor(F.col("slice_place") * n / F.col("slice_place_of")).cast("int")).select(
        *EVENT_COLUMNS, "partition", "offset", "slice", "file")
    last = places.agg(F.max("slice")).first()[0] or 0
    marks = spark.range((last + 1) * n).select(
        F.floor(F.col("id") / n).cast("int").alias("slice"), (F.col("id") % n).cast("int").alias("file"),
        *[F.lit(None).cast(places.schema[c].dataType).alias(c) for c in (*EVENT_COLUMNS, "partition", "offset")])
    at = (places.unionByName(marks).repartitionById(n * (last + 1), F.col("slice") * n + F.col("file"))
          .withColumn("of", F.concat_ws("-", "slice", "file")).sortWithinPartitions("of", "partition", "offset"))
    carry = ["partition", "offset", "of"]
    edits = trim_events(fixture.raw_events(at, carry), carry=carry)
    to_keyed_json(edits, carry, mark=F.col("offset").isNull()).write.partitionBy("of").parquet(f"{folder}/staged")
    return last


def land_slices(spark: SparkSession, folder: str, start: int, upto: int) -> None:
    """Move the files of slices ``start .. upto`` into the watched folder, dated in order."""
    dated = int(time.time()) - 3600
    for no in range(start, upto + 1):
        for p in range(log_partitions(spark)):
            for k, staged in enumerate(storage.files(spark, f"{folder}/staged/of={no}-{p}")):
                if not staged.endswith(".parquet"):
                    continue
                storage.set_modified(spark, staged, (dated + no) * 1000)
                storage.rename(spark, staged, f"{folder}/in/{no}-{p}-{k}.parquet")


def land_replay(spark: SparkSession, sf_dir: str, folder: str, late_mod: int | None = None) -> int:
    last = stage_replay(spark, sf_dir, folder, late_mod)
    land_slices(spark, folder, 0, last)
    return last


_LANDED: dict[tuple, str] = {}


def landed_replay(spark: SparkSession, sf_dir: str, late_mod: int | None = None) -> str:
    """Folder whose ``in/`` holds the landed replay files for this table.

    Landed files are immutable, so within a session every replay query reads
    the same input (like several queries subscribed to one topic) as long as
    the table's files are the same; each query keeps its own checkpoint and
    output, so it still reads from the start.
    """
    table = f"{sf_dir.rstrip('/')}/events.parquet"
    key = (spark.sparkContext.applicationId, table, storage.stamp(spark, table), late_mod, log_partitions(spark))
    if key not in _LANDED:
        folder = scratch_dir(spark, "replay-in")
        land_replay(spark, sf_dir, folder, late_mod)
        _LANDED[key] = folder
    return _LANDED[key]


def _edits(spark: SparkSession, source: str) -> DataFrame:
    return edit_stream(spark, "files", path=f"{source}/in", max_files=log_partitions(spark))


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def replay_live(spark, sf_dir):
    source, folder = landed_replay(spark, sf_dir), scratch_dir(spark, "live")
    _run(runner.start_live(_edits(spark, source), f"{folder}/live", f"{folder}/ckpt", "available_now",
                           partitions=log_partitions(spark), compact_every=COMPACT_EVERY))
    return sinks.live_table(f"{folder}/live").read(spark)


def replay_metrics(spark, sf_dir, late_mod=None):
    source, folder = landed_replay(spark, sf_dir, late_mod), scratch_dir(spark, "metrics")
    q = runner.start_metrics(_edits(spark, source), f"{folder}/metrics", f"{folder}/ckpt", "available_now",
                             partitions=log_partitions(spark), compact_every=COMPACT_EVERY)
    _run(q)
    return sinks.metric_table(f"{folder}/metrics").read(spark), q


def replay_enriched(spark, sf_dir):
    source, folder = landed_replay(spark, sf_dir), scratch_dir(spark, "enriched")
    q = runner.start_enriched(_edits(spark, source), dims.language_dim(spark), f"{folder}/enriched",
                              f"{folder}/ckpt", "available_now", dim_rows=dims.bundled_dim_rows(),
                              partitions=log_partitions(spark), compact_every=COMPACT_EVERY)
    _run(q)
    return sinks.enriched_table(f"{folder}/enriched").read(spark)


def run_service_replay(spark: SparkSession, sf_dir: str, which: str):
    """Stage, land and run one service query over the in-order replay.

    Returns (table DataFrame, finished StreamingQuery, seconds spent in the
    stream itself), for throughput and per-batch latency reporting.
    """
    source, folder = landed_replay(spark, sf_dir), scratch_dir(spark, f"svc-{which}")
    edits = _edits(spark, source)
    t0 = time.perf_counter()
    if which == "live":
        q = runner.start_live(edits, f"{folder}/t", f"{folder}/ckpt", "available_now", partitions=log_partitions(spark),
                              compact_every=COMPACT_EVERY)
        table = sinks.live_table(f"{folder}/t")
    elif which == "metrics":
        q = runner.start_metrics(edits, f"{folder}/t", f"{folder}/ckpt", "available_now", partitions=log_partitions(spark),
                              compact_every=COMPACT_EVERY)
        table = sinks.metric_table(f"{folder}/t")
    elif which == "enriched":
        q = runner.start_enriched(edits, dims.language_dim(spark), f"{folder}/t", f"{folder}/ckpt",
                                  "available_now", dim_rows=dims.bundled_dim_rows(), partitions=log_partitions(spark),
                                  compact_every=COMPACT_EVERY)
        table = sinks.enriched_table(f"{folder}/t")
    else:
        raise ValueError(which)
    _run(q)
    return table.read(spark), q, time.perf_counter() - t0


def q_src_replay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files -> decode -> validate -> exactly-once Parquet file sink."""
    source, folder = landed_replay(spark, sf_dir), scratch_dir(spark, "source")
    q = (_edits(spark, source).select(*EDIT_COLUMNS).writeStream.format("parquet")
         .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ckpt")
         .outputMode("append").trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(f"{folder}/out").select(*EDIT_COLUMNS)


def q_stream_live_snapshot(spark, sf_dir):
    return replay_live(spark, sf_dir)


def q_stream_window_metrics(spark, sf_dir):
    return replay_metrics(spark, sf_dir)[0]


def q_stream_enriched_snapshot(spark, sf_dir):
    return replay_enriched(spark, sf_dir)


def q_stream_late_data(spark, sf_dir):
    return replay_metrics(spark, sf_dir, late_mod=LATE_MOD)[0]


LOG_RECORDS = 5000         # admitted a batch, or a sixteenth of the log


def q_log_replay_stream(spark, sf_dir):
    """Log source -> decode -> validate -> file sink. The query is stopped half
    way and started again on a log that has grown meanwhile."""
    folder, n = scratch_dir(spark, "log"), log_partitions(spark)
    edits = valid_edits(catalog.edits(spark, sf_dir)).withColumn("partition", F.pmod(F.xxhash64("wiki"), F.lit(n)).cast("int"))
    records = to_keyed_json(edits, carry=["partition", "ingestion_ts", "id"])
    rows, middle = edits.agg(F.count(F.lit(1)), F.avg("ingestion_ts")).first()
    for part in (F.col("ingestion_ts") < middle, F.col("ingestion_ts") >= middle):
        log.append_log(records.filter(part), ["ingestion_ts", "id"], f"{folder}/log")
        read = edit_stream(spark, "log", path=f"{folder}/log", max_records_per_trigger=max(LOG_RECORDS, rows // 16),
                           starting_offsets="earliest")
        q = (read.select(*EDIT_COLUMNS).writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/ckpt").outputMode("append").trigger(processingTime="0 seconds").start())
        log.drain(q, spark, f"{folder}/log")
    return spark.read.parquet(f"{folder}/out").select(*EDIT_COLUMNS)


def q_stream_live_state(spark, sf_dir):
    """The live table from keyed state, over the late replay: the log's order
    decides, not the slice that a record comes in."""
    source, folder = landed_replay(spark, sf_dir, LATE_MOD), scratch_dir(spark, "live-state")
    edits = _edits(spark, source).drop("partition", "offset")      # arrival: second and id
    _run(runner.start_live_state(edits, f"{folder}/live", f"{folder}/ckpt", "available_now",
                                 partitions=log_partitions(spark), compact_every=COMPACT_EVERY))
    return sinks.live_table(f"{folder}/live").read(spark)


def q_stream_metric_writers(spark, sf_dir):
    """Counts and averages by two queries that write to one table at a time."""
    source, folder = landed_replay(spark, sf_dir), scratch_dir(spark, "writers")
    for q in runner.start_metric_writers(_edits(spark, source), f"{folder}/metrics", f"{folder}/ckpt", "available_now",
                                         partitions=log_partitions(spark), compact_every=COMPACT_EVERY):
        _run(q)
    return sinks.metric_cell_table(f"{folder}/metrics").read(spark)


def q_progress_rates(spark, sf_dir):
    """The metric query's progress over the late replay, as a service shows it:
    rates, and state rows that the watermark dropped (not the same in any two runs)."""
    return _progress(spark, sf_dir).select(
        "batch_id", F.col("num_read").alias("num_input_rows"), "input_rows_per_second", "processed_rows_per_second",
        "rows_dropped_by_watermark")


def _progress(spark, sf_dir) -> DataFrame:
    source, folder = landed_replay(spark, sf_dir, LATE_MOD), scratch_dir(spark, "progress")
    with runner.ProgressLog(spark, f"{folder}/progress") as reports:
        edits = _edits(spark, source).observe(runner.READ, F.count(F.lit(1)).alias("n"))
        _run(runner.start_metrics(edits, f"{folder}/metrics", f"{folder}/ckpt", "available_now",
                                  partitions=log_partitions(spark)))
    return reports.table(spark).filter("num_source_rows > 0")


def q_progress_report(spark, sf_dir):
    """Edits that each batch of the metric query reads over the late replay,
    from the progress reports of all batches."""
    return _progress(spark, sf_dir).select("batch_id", F.col("num_read").alias("num_input_rows"))


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "src_replay_stream": q_src_replay_stream,
    "stream_live_snapshot": q_stream_live_snapshot,
    "stream_window_metrics": q_stream_window_metrics,
    "stream_enriched_snapshot": q_stream_enriched_snapshot,
    "stream_late_data": q_stream_late_data,
    "log_replay_stream": q_log_replay_stream,
    "stream_live_state": q_stream_live_state,
    "stream_metric_writers": q_stream_metric_writers,
    "progress_report": q_progress_report,
    "progress_rates": q_progress_rates,
}
