
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from editstream import storage
from editstream.operators.numbering import milestones, numbered
from editstream.plans import catalog
from editstream.plans.check import compare
from editstream.session import scratch_dir
from editstream.streaming import log, replays, runner, sinks
from editstream.streaming.sources import edit_stream


def _same(a, b):
    res = compare(a.toPandas(), b.toPandas())
    assert res["ok"], res


# ------------------------------------------------------------------ numbers

def test_numbers_are_gapless_in_each_group(spark):
    rows = spark.range(4000).selectExpr("IF(id % 3 = 0, NULL, id % 5 > 1) AS hot", "id % 7 AS g", "id * 37 % 4001 AS t", "id")
    got = numbered(rows, ["g", "hot", "t"], {"n": ["g", "hot"], "k": ["g"]}, tasks=6).collect()
    assert len(got) == 4000
    groups = {}
    for r in sorted(got, key=lambda r: (r.g, r.hot is not None, r.hot, r.t)):
        groups.setdefault((r.g,), []).append((r.k, r.k_of))
        groups.setdefault((r.g, r.hot), []).append((r.n, r.n_of))
    for found in groups.values():
        assert found == [(i, len(found)) for i in range(len(found))]
    assert numbered(rows.limit(0), ["t"], {"n": []}).count() == 0
    with pytest.raises(ValueError):
        numbered(rows, ["t", "g"], {"n": ["g"]})


def test_a_hot_second_is_cut(spark):
    rows = spark.range(2000).selectExpr("IF(id < 1500, 7L, id) AS ingestion_ts", "id", "'w' AS wiki")
    path = scratch_dir(spark, "x").rsplit("/", 1)[0]
    before = set(storage.names(spark, path))
    assert numbered(rows, ["ingestion_ts", "id"], {"n": []}, tasks=4).count() == 2000
    (new,) = {n for n in storage.names(spark, path) if n.startswith("numbered")} - before
    sizes = spark.read.parquet(f"{path}/{new}").groupBy(F.spark_partition_id()).count().collect()
    tasks = spark.read.parquet(f"{path}/{new}").groupBy(F.shiftright("_at", 33)).count().collect()
    assert len(tasks) == 4 and max(r["count"] for r in tasks) <= 2 * 500 and sum(r["count"] for r in sizes) == 2000


def test_milestones(spark):
    rows = spark.createDataFrame([(i, "w", 100 + i // 10) for i in range(95)], "id long, wiki string, ingestion_ts long")
    got = sorted(tuple(r) for r in milestones(rows, ["ingestion_ts", "id"], every=10).collect())
    assert got == [(n, n - 1, "w", 100 + (n - 1) // 10, (n - 1) // 10, n / ((n - 1) // 10) if n > 10 else 0.0) for n in range(10, 91, 10)]


def test_landing_tasks_are_even(spark):
    folder = scratch_dir(spark, "even")
    last, n = replays.stage_replay(spark, SF_SMALL, folder), replays.log_partitions(spark)
    rows = spark.read.parquet(f"{folder}/staged").filter("key IS NOT NULL")
    files = {r["of"]: r["count"] for r in rows.groupBy("of").count().collect()}
    for s in range(last + 1):
        sizes = [files.get(f"{s}-{k}", 0) for k in range(n)]
        assert max(sizes) - min(sizes) <= 1
    offsets = {}
    for r in rows.select("partition", "offset").collect():
        offsets.setdefault(r.partition, []).append(r.offset)
    assert all(sorted(o) == list(range(len(o))) for o in offsets.values())


def test_landing_moves_narrow_rows(spark):
    folder = scratch_dir(spark, "narrow")
    root = folder.rsplit("/", 1)[0]
    before = set(storage.names(spark, root))
    replays.stage_replay(spark, SF_SMALL, folder)
    (new,) = {n for n in storage.names(spark, root) if n.startswith("numbered")} - before
    assert "value" not in spark.read.parquet(f"{root}/{new}").columns      # the JSON is neither sorted nor shuffled
    got = spark.read.parquet(f"{folder}/staged").filter("key IS NOT NULL").select("key", "value")
    want = catalog.q_publish_keyed_json(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("key", "value").collect()))


def test_replay_partitions_follow_the_cores(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "2000")
        assert replays.log_partitions(spark) <= max(replays.STREAM_PARTITIONS, spark.sparkContext.defaultParallelism)
        spark.conf.set(name, "3")
        assert replays.log_partitions(spark) == 3
    finally:
        spark.conf.set(name, before)


# ------------------------------------------------------------------ log source

def test_admission():
    assert log.admit({}, {0: 5, 1: 3}, 100) == {0: 5, 1: 3}
    assert log.admit({0: 10}, {0: 110, 1: 300}, 40) == {0: 20, 1: 30}
    for most in range(1, 12):
        got = log.admit({0: 1}, {0: 4, 1: 5, 2: 1}, most)
        assert sum(got.values()) - 1 == min(most, 9) and all(got[p] <= n for p, n in {0: 4, 1: 5, 2: 1}.items())


def test_segments_without_a_gap():
    name = "{}-{:020d}-{:020d}".format
    got = log.segment_names([name(1, 5, 9), name(1, 0, 5), name(1, 12, 20), name(0, 0, 2), "_temporary", "x-1-2"])
    assert got == {1: [(0, 5, name(1, 0, 5)), (5, 9, name(1, 5, 9))], 0: [(0, 2, name(0, 0, 2))]}


def _records(spark, first, last):
    return spark.range(first, last).selectExpr("concat('w', id % 3) AS key", "CAST(id AS STRING) AS value",
                                               "CAST(IF(id % 10 < 7, 0, 1) AS INT) AS partition", "id AS t")


def test_batches_restart_and_latest(spark):
    folder = scratch_dir(spark, "log")
    sizes, seen = [], []

    def sink(batch, batch_id):
        rows = batch.collect()
        sizes.append(len(rows))
        seen.extend((r.partition, r.offset, int(r.value)) for r in rows)

    def run(start, name):
        q = (log.read_log(spark, f"{folder}/log", 70, start).writeStream.foreachBatch(sink).queryName(name)
             .option("checkpointLocation", f"{folder}/{name}").trigger(processingTime="0 seconds").start())
        log.drain(q, spark, f"{folder}/log", patience=60)

    log.append_log(_records(spark, 0, 200), ["t"], f"{folder}/log", segment=30)
    run("earliest", "all")
    assert len(seen) == 200 and sizes[:2] == [70, 70]
    log.append_log(_records(spark, 200, 400), ["t"], f"{folder}/log", segment=30)
    before = len(sizes)
    run("earliest", "all")                                       # goes on where it ended
    assert max(sizes) <= 70 and len(sizes) >= before + 3
    for p in (0, 1):
        rows = sorted((o, v) for q, o, v in seen if q == p)
        assert rows == list(enumerate(v for v in range(400) if (v % 10 >= 7) == bool(p)))
    seen.clear()
    q = (log.read_log(spark, f"{folder}/log", 1000, "latest").writeStream.foreachBatch(sink).queryName("new")
         .option("checkpointLocation", f"{folder}/new").trigger(processingTime="0 seconds").start())
    import time
    deadline = time.monotonic() + 60
    while not storage.names(spark, f"{folder}/new/offsets") and q.isActive and time.monotonic() < deadline:
        if not q.status["isTriggerActive"] and q.status["message"].startswith("Waiting"):
            break
        time.sleep(0.2)
    log.append_log(_records(spark, 400, 450), ["t"], f"{folder}/log", segment=30)
    log.drain(q, spark, f"{folder}/log", patience=60)
    assert sorted(v for *_, v in seen) == list(range(400, 450))


def test_log_replay_equals_valid_edits(spark, monkeypatch):
    monkeypatch.setattr(replays, "LOG_RECORDS", 100)
    _same(replays.q_log_replay_stream(spark, SF_SMALL), replays.q_src_replay_stream(spark, SF_SMALL))


# ------------------------------------------------------------------ merge on read

def _history(spark, days):
    """A metric table of many days, folded into the base."""
    table = sinks.metric_table(scratch_dir(spark, "history"))
    rows = spark.range(days * 1440 * 2).selectExpr("concat('w', id % 2) AS wiki", "(id div 2 + 1) * 60 AS window_end_epoch",
                                                   "id AS edit_count", "CAST(id AS DOUBLE) AS avg_delta")
    table.write_batch(rows, 0, "q")
    table.compact(spark)
    return table, rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_read_neither_shuffles_nor_reduces_the_base(spark):
    table, rows = _history(spark, 6)
    end = 6 * 86400
    assert "Exchange" not in _plan(table.read(spark)) and "Aggregate" not in _plan(table.read(spark))
    new = spark.createDataFrame([("w0", end, 7, 0.5), ("w9", end + 60, 1, None)], "wiki string, window_end_epoch long, edit_count long, avg_delta double")
    table.write_batch(new, 1, "q")
    read = table.read(spark)
    base = _plan(read).split("Union", 1)[1].split("SortAggregate")[0].split("HashAggregate")[0]
    assert "BroadcastHashJoin" in base and "LeftAnti" in base and "Exchange hashpartitioning" not in base
    got = {(r.wiki, r.window_end_epoch): (r.edit_count, r.avg_delta) for r in read.collect()}
    want = {(r.wiki, r.window_end_epoch): (r.edit_count, r.avg_delta) for r in rows.collect()}
    want.update({("w0", end): (7, 0.5), ("w9", end + 60): (1, None)})
    assert got == want
    assert "EqualTo(wiki,w0)" in _plan(read.filter("wiki = 'w0'"))       # still pushed into the base


def test_a_delta_past_its_bound_is_shuffled_and_folded(spark, monkeypatch):
    table, rows = _history(spark, 1)
    monkeypatch.setattr(sinks, "DELTA_BYTES", 10)
    table.write_batch(rows.withColumn("edit_count", F.lit(1).cast("long")), 1, "q")
    plan = _plan(table.read(spark))
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan or "AdaptiveSparkPlan" in plan
    assert table.read(spark).filter("edit_count <> 1").count() == 0
    table(rows, 2)                                                       # the sink folds it
    assert table.manifest(spark)["recent"] == [] and table.manifest(spark)["recent_bytes"] == 0
    _same(table.read(spark), rows)


def test_files_follow_the_order_of_their_rows(spark):
    table, _ = _history(spark, 2)
    base = table.manifest(spark)["base"]
    for folder in base.values():
        files = spark.read.parquet(f"{table.path}/{folder}")
        spans = {}
        for r in files.select("wiki", "window_end_epoch", F.input_file_name().alias("f")).collect():
            spans.setdefault(r.f, []).append((r.wiki, -r.window_end_epoch))
        edges = sorted((min(v), max(v)) for v in spans.values())
        assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


def test_cells_merge_and_nulls_replace_nothing(spark):
    table = sinks.metric_cell_table(scratch_dir(spark, "cells"))
    counts = lambda *r: spark.createDataFrame(r, "wiki string, window_end_epoch long, edit_count long")
    means = lambda *r: spark.createDataFrame(r, "wiki string, window_end_epoch long, avg_delta double")
    table.write_batch(counts(("a", 60, 1), ("b", 60, 4)), 0, "counts")
    table.write_batch(means(("a", 60, 0.5), ("c", 120, 2.0)), 0, "means")
    want = {("a", 60): (1, 0.5), ("b", 60): (4, None), ("c", 120): (None, 2.0)}
    got = lambda: {(r.wiki, r.window_end_epoch): (r.edit_count, r.avg_delta) for r in table.read(spark).collect()}
    assert got() == want
    table.compact(spark)
    assert got() == want
    table.write_batch(counts(("a", 60, 3), ("c", 120, 9)), 1, "counts")
    table.write_batch(means(("b", 60, -1.0)), 1, "means")
    want = {("a", 60): (3, 0.5), ("b", 60): (4, -1.0), ("c", 120): (9, 2.0)}
    assert got() == want
    table.compact(spark)
    assert got() == want and table.manifest(spark)["recent"] == []


def test_a_writer_that_comes_second_publishes_on_top(spark, monkeypatch):
    table = sinks.metric_cell_table(scratch_dir(spark, "race"))
    rows = lambda n: spark.createDataFrame([(f"w{n}", 60, n)], "wiki string, window_end_epoch long, edit_count long")
    first, publish = [], table._publish

    def late(session, manifest):
        if not first:
            first.append(1)                     # another writer takes the name
            other = sinks.metric_cell_table(table.path)
            with monkeypatch.context() as m:
                m.setattr(sinks, "_PUBLISHING", __import__("threading").Lock())
                other.write_batch(rows(2), 0, "other")
        return publish(session, manifest)

    monkeypatch.setattr(table, "_publish", late)
    table.write_batch(rows(1), 0, "one")
    assert {r.wiki for r in table.read(spark).collect()} == {"w1", "w2"}
    assert table.manifest(spark)["batches"] == {"one": 0, "other": 0}


def test_two_metric_writers(spark):
    _same(replays.q_stream_metric_writers(spark, SF_SMALL), catalog.q_metric_merge_outer(spark, SF_SMALL))


# ------------------------------------------------------------------ keyed state, progress

def test_keyed_state_survives_a_restart(spark):
    folder = scratch_dir(spark, "state")
    n, last = replays.log_partitions(spark), replays.stage_replay(spark, SF_SMALL, folder, replays.LATE_MOD)
    for first, upto in ((0, 5), (6, last)):
        replays.land_slices(spark, folder, first, upto)
        edits = edit_stream(spark, "files", path=f"{folder}/in", max_files=n).drop("partition", "offset")
        q = runner.start_live_state(edits, f"{folder}/live", f"{folder}/ckpt", "available_now", partitions=n)
        q.awaitTermination()
        assert q.exception() is None and q.lastProgress["stateOperators"][0]["numRowsTotal"] > 0
    _same(sinks.live_table(f"{folder}/live").read(spark), catalog.live(spark, SF_SMALL))


def test_an_older_edit_does_not_replace_state(spark):
    import json

    folder = scratch_dir(spark, "older")
    for title, ts in (("new", 200), ("old", 100)):
        value = json.dumps({"id": ts, "wiki": "w", "title": title, "ingestion_ts": ts})
        spark.createDataFrame([("w", value, 0, ts)], log.RECORD).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        edits = edit_stream(spark, "files", path=f"{folder}/in", max_files=1).drop("partition", "offset")
        runner.start_live_state(edits, f"{folder}/live", f"{folder}/ckpt", "available_now", partitions=1).awaitTermination()
    assert [(r.wiki, r.title) for r in sinks.live_table(f"{folder}/live").read(spark).collect()] == [("w", "new")]


def test_progress_rates(spark):
    rows = replays.q_progress_rates(spark, SF_SMALL).collect()
    assert sum(r.num_input_rows for r in rows) == catalog.valid(spark, SF_SMALL).count()
    assert all(r.processed_rows_per_second > 0 for r in rows) and all(r.rows_dropped_by_watermark >= 0 for r in rows)


def test_a_progress_block_that_misses_an_end_fails(spark):
    folder = scratch_dir(spark, "patience")
    spark.createDataFrame([("w", "{}", 0, 1)], log.RECORD).write.parquet(f"{folder}/in")
    with pytest.raises(TimeoutError):
        with runner.ProgressLog(spark, f"{folder}/p", patience=1):
            q = (edit_stream(spark, "files", path=f"{folder}/in", max_files=1).writeStream.format("noop")
                 .option("checkpointLocation", f"{folder}/c").start())
    q.stop()
