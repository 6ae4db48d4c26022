
import json
import time

from conftest import SF_SMALL
from editstream import storage
from editstream.plans import catalog
from editstream.plans.check import compare, duck
from editstream.plans.oracles import late_data_sql
from editstream.schemas import EDIT_COLUMNS
from editstream.session import scratch_dir
from editstream.streaming import replays, runner, sinks
from editstream.streaming.sources import RECORD, edit_stream


def _same(a, b):
    res = compare(a.toPandas(), b.toPandas())
    assert res["ok"], res


def test_source_replay_equals_valid_edits(spark):
    _same(replays.q_src_replay_stream(spark, SF_SMALL),
          catalog.valid(spark, SF_SMALL).select(*EDIT_COLUMNS))


def test_stream_tables_equal_batch_twins(spark):
    _same(replays.q_stream_window_metrics(spark, SF_SMALL), catalog.metrics(spark, SF_SMALL))
    _same(replays.q_stream_live_snapshot(spark, SF_SMALL), catalog.live(spark, SF_SMALL))
    _same(replays.q_stream_enriched_snapshot(spark, SF_SMALL), catalog.enriched(spark, SF_SMALL))


def test_late_rows_dropped_like_the_oracle(spark):
    got = replays.q_stream_late_data(spark, SF_SMALL).toPandas()
    want = duck(SF_SMALL).execute(late_data_sql()).df()
    res = compare(got, want)
    assert res["ok"], res


def test_restart_resumes_from_checkpoint(spark):
    folder = scratch_dir(spark, "restart")
    last = replays.stage_replay(spark, SF_SMALL, folder)
    table, ckpt = f"{folder}/metrics", f"{folder}/ckpt"
    replays.land_slices(spark, folder, 0, 4)
    q = runner.start_metrics(edit_stream(spark, "files", path=f"{folder}/in", max_files=replays.log_partitions(spark)), table, ckpt, "available_now")
    q.awaitTermination()
    first = q.lastProgress["batchId"]
    replays.land_slices(spark, folder, 5, last)
    q = runner.start_metrics(edit_stream(spark, "files", path=f"{folder}/in", max_files=replays.log_partitions(spark)), table, ckpt, "available_now")
    q.awaitTermination()
    assert q.lastProgress["batchId"] > first
    _same(sinks.metric_table(table).read(spark), catalog.metrics(spark, SF_SMALL))


def test_sink_is_idempotent_per_batch_id(spark):
    path = scratch_dir(spark, "idem")
    live = sinks.live_table(path)
    batch = catalog.valid(spark, SF_SMALL)
    live(batch, 0)
    once = live.read(spark).toPandas()
    live(batch, 0)          # re-delivered after a failure
    twice = live.read(spark).toPandas()
    assert compare(once, twice)["ok"]
    assert len(once) == catalog.live(spark, SF_SMALL).count()


def _land(spark, folder, batches):
    for rows in batches:
        vals = [(r["wiki"], json.dumps(r), 0, r["id"]) for r in rows]
        spark.createDataFrame(vals, RECORD).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        time.sleep(0.01)


def _edit(i, ts, wiki="enwiki"):
    return {"id": i, "wiki": wiki, "ingestion_ts": ts, "length_old": 1, "length_new": 2}


def _run_late(spark, first_max_ts):
    folder = scratch_dir(spark, "wm-edge")
    # batch 0 sets the watermark to first_max_ts - 30; batch 1 holds a row for window [60, 120)
    _land(spark, folder, [[_edit(1, first_max_ts)], [_edit(2, 61)]])
    q = runner.start_metrics(edit_stream(spark, "files", path=f"{folder}/in", max_files=1), f"{folder}/m",
                             f"{folder}/ckpt", "available_now")
    q.awaitTermination()
    rows = sinks.metric_table(f"{folder}/m").read(spark).collect()
    return {r.window_end_epoch for r in rows}


def test_watermark_equal_to_window_end_drops(spark):
    assert 120 not in _run_late(spark, 150)     # watermark 120 = window end -> dropped
    assert 120 in _run_late(spark, 149)         # watermark 119 < window end -> kept


def test_progress_rows(spark):
    df = replays.q_progress_report(spark, SF_SMALL)
    rows = df.collect()
    assert len(rows) >= 2
    assert sum(r.num_input_rows for r in rows) == catalog.valid(spark, SF_SMALL).count()


def test_producer_then_all_service_queries(spark):
    """Feed text -> producer stream -> keyed JSON files -> the three service
    queries in one session, each equal to its batch twin."""
    from editstream.operators.clean import parse_feed_lines, trim_events, valid_edits
    from editstream.sources import dims, feed

    folder = scratch_dir(spark, "producer")
    raw = catalog.raw(spark, SF_SMALL)
    feed.feed_text_from_raw(raw).coalesce(1).write.text(f"{folder}/feed")
    q = runner.start_producer(spark, f"{folder}/feed", f"{folder}/published", f"{folder}/ckpt-p")
    q.awaitTermination()
    assert q.exception() is None

    published = clean_decode(spark, f"{folder}/published")
    expected = valid_edits(trim_events(parse_feed_lines(feed.feed_text_from_raw(raw)), ingestion_ts="0"))
    cols = [c for c in EDIT_COLUMNS if c != "ingestion_ts"]
    _same(published.select(*cols), expected.select(*cols))

    # Three named queries over one replay of the published records (in order).
    root = scratch_dir(spark, "service")
    last = replays.stage_replay(spark, SF_SMALL, root)
    replays.land_slices(spark, root, 0, last)
    edits = edit_stream(spark, "files", path=f"{root}/in", max_files=replays.log_partitions(spark))
    queries = runner.start_all(spark, edits, dims.language_dim(spark), root, trigger="available_now",
                               partitions=4)
    assert sorted(x.name for x in queries) == ["enriched_snapshot", "live_snapshot", "window_metrics"]
    for x in queries:
        x.awaitTermination()
        assert x.exception() is None
    _same(sinks.live_table(f"{root}/live").read(spark), catalog.live(spark, SF_SMALL))
    _same(sinks.metric_table(f"{root}/metrics").read(spark), catalog.metrics(spark, SF_SMALL))
    _same(sinks.enriched_table(f"{root}/enriched").read(spark), catalog.enriched(spark, SF_SMALL))

    # The serving read path over those tables equals the batch serving queries.
    from editstream.plans.views import table_views
    for name, view in table_views(spark, root).items():
        _same(view, catalog.BATCH_QUERIES[name](spark, SF_SMALL))


def clean_decode(spark, path):
    from editstream.operators.clean import decode_edits
    return decode_edits(spark.read.parquet(path))


def test_log_position_orders_latest_when_present(spark):
    """With a keyed-log source, arrival = (partition, offset), not edit fields."""
    path = scratch_dir(spark, "logpos")
    rows = [("enwiki", 0, 5, 100, 1, "late-offset"), ("enwiki", 0, 9, 50, 2, "newest"),
            ("dewiki", 1, 3, 70, 3, "only")]
    batch = spark.createDataFrame(rows, "wiki string, partition int, offset long, ingestion_ts long, "
                                        "id long, title string")
    order = sinks.arrival_order(batch.columns)
    assert order[:2] == ["partition", "offset"]
    table = sinks.UpsertTable(path, ["wiki"], ["title", "ingestion_ts"], order)
    table(batch, 0)
    got = {r.wiki: r.title for r in table.read(spark).collect()}
    assert got == {"enwiki": "newest", "dewiki": "only"}
    assert sinks.arrival_order(["wiki", "ingestion_ts", "id"]) == ["ingestion_ts", "id"]


def test_metric_log_clustered_and_filter_pushed(spark):
    path = scratch_dir(spark, "cluster")
    table = sinks.metric_table(path)
    table(catalog.metrics(spark, SF_SMALL), 0)
    log = spark.read.parquet(f"{path}/{table.manifest(spark)['recent'][0][0]}")
    for f in log.inputFiles():
        rows = [(r.wiki, r.window_end_epoch) for r in spark.read.parquet(f).collect()]
        assert rows == sorted(rows, key=lambda t: (t[0], -t[1]))      # wiki asc, newest first
    plan = log.where("wiki = 'enwiki'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(wiki), EqualTo(wiki,enwiki)]" in plan


def _half_hours(spark):
    from pyspark.sql import functions as F

    edits = catalog.valid(spark, SF_SMALL).withColumn("_b", F.floor((F.col("ingestion_ts") - 1704067200) / 1800))
    return [edits.where(F.col("_b") == b).drop("_b") for b in range(3)]


def test_compaction_keeps_the_table_and_open_readers(spark):
    path = scratch_dir(spark, "compact")
    live = sinks.live_table(path)
    for b, rows in enumerate(_half_hours(spark)):       # three batches in arrival order
        live(rows, b)
    open_before = live.read(spark)
    before = open_before.toPandas()
    assert len(live.manifest(spark)["recent"]) == 3
    assert live.compact(spark) == 4 and live.manifest(spark)["recent"] == []
    assert compare(before, live.read(spark).toPandas())["ok"]
    assert compare(before, open_before.toPandas())["ok"]     # its folders are still there
    live(_half_hours(spark)[2], 2)                           # re-delivered after a restart
    assert live.compact(spark) is None                       # nothing new to fold
    _same(live.read(spark), catalog.live(spark, SF_SMALL))
    live.vacuum(spark, keep=1)
    _same(live.read(spark), catalog.live(spark, SF_SMALL))
    assert len([n for n in storage.names(spark, path) if n.startswith(("rows-", "base-"))]) == 1


def _metric_rows(spark, *rows):
    return spark.createDataFrame(rows, "wiki string, window_end_epoch long, edit_count long, avg_delta double")


def _got(table, spark):
    return {(r.wiki, r.window_end_epoch): r.edit_count for r in table.read(spark).collect()}


def test_fresh_checkpoint_on_an_old_table_loses_nothing(spark):
    table = sinks.metric_table(scratch_dir(spark, "fresh"))
    for b in range(4):
        table.write_batch(_metric_rows(spark, ("a", 60 * (b + 1), 1, 0.0)), b, "old query")
    table.compact(spark)
    table.write_batch(_metric_rows(spark, ("a", 240, 7, 0.0), ("a", 180, 5, 0.0), ("a", 300, 2, 0.0)), 0, "new query")
    assert _got(table, spark) == {("a", 60): 1, ("a", 120): 1, ("a", 180): 5, ("a", 240): 7, ("a", 300): 2}
    table.write_batch(_metric_rows(spark, ("a", 60, 9, 0.0)), 0, "new query")     # delivered again
    assert _got(table, spark)[("a", 60)] == 1


def test_a_batch_counts_only_when_published(spark, monkeypatch):
    table = sinks.metric_table(scratch_dir(spark, "crash"))
    table.write_batch(_metric_rows(spark, ("a", 60, 1, 0.0)), 0, "q")
    with monkeypatch.context() as m:
        m.setattr(table, "_publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        for write in (lambda: table.write_batch(_metric_rows(spark, ("a", 60, 2, 0.0)), 1, "q"), lambda: table.compact(spark)):
            try:
                write()
            except OSError:
                pass
    assert _got(table, spark) == {("a", 60): 1}
    table.write_batch(_metric_rows(spark, ("a", 60, 2, 0.0)), 1, "q")
    assert _got(table, spark) == {("a", 60): 2}


def test_compaction_leaves_closed_days_alone(spark):
    table = sinks.metric_table(scratch_dir(spark, "days"))
    table.write_batch(_metric_rows(spark, ("a", 60, 1, 0.0), ("a", 86460, 1, 0.0)), 0, "q")
    table.compact(spark)
    first = dict(table.manifest(spark)["base"])
    table.write_batch(_metric_rows(spark, ("a", 86460, 2, 0.0)), 1, "q")
    table.compact(spark)
    second = table.manifest(spark)["base"]
    assert first["0"] == second["0"] and first["1"] != second["1"]
    assert _got(table, spark) == {("a", 60): 1, ("a", 86460): 2}


def test_reads_only_wanted_cells(spark):
    live = sinks.live_table(scratch_dir(spark, "cells"))
    live(catalog.valid(spark, SF_SMALL), 0)
    plan = live.read(spark, ["type"])._jdf.queryExecution().executedPlan().toString()
    assert "type" in plan and "title" not in plan.split("ReadSchema")[-1]


def test_progress_of_more_than_a_hundred_batches(spark):
    folder = scratch_dir(spark, "many")
    _land(spark, folder, [[_edit(i, 100 + i)] for i in range(104)])
    with runner.ProgressLog(spark, f"{folder}/progress", every=30) as log:
        q = (edit_stream(spark, "files", path=f"{folder}/in", max_files=1).writeStream.format("noop")
             .option("checkpointLocation", f"{folder}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
    rows = log.table(spark).collect()
    assert sorted(r.batch_id for r in rows if r.num_source_rows) == list(range(104))


def test_one_failing_query_ends_the_service(spark):
    import pytest

    folder = scratch_dir(spark, "serve")
    _land(spark, folder, [[_edit(1, 100)]])

    def broken(batch, batch_id):
        raise ValueError("broken sink")

    edits = edit_stream(spark, "files", path=f"{folder}/in", max_files=1)
    spark.streams.resetTerminated()
    steady = runner.start_live(edits, f"{folder}/live", f"{folder}/c1", "1 seconds")
    failing = edits.writeStream.foreachBatch(broken).option("checkpointLocation", f"{folder}/c2").start()
    with pytest.raises(Exception, match="broken sink"):
        runner.serve(spark, [steady, failing])
    assert not steady.isActive and not failing.isActive
    spark.streams.resetTerminated()
