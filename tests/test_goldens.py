"""Micro goldens (FIXTURES.md §3) on hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from editstream.functions.names import edit_type_name, namespace_name, wiki_name
from editstream.operators import clean, metrics, serving, snapshot
from editstream.schemas import EDIT, EDIT_COLUMNS, LIVE_COLUMNS, METRIC, RAW_EVENT

SAMPLE = {
    "id": 51, "type": "new", "wiki": "dewiki", "title": "Wattwurm", "namespace": 4,
    "user": "Probe", "bot": True, "minor": True, "comment": "erste Fassung",
    "timestamp": 1600000000, "server_url": "https://de.example.org", "server_name": "de.example.org",
    "length_old": 70, "length_new": 61, "length_delta": -9, "revision_old": 8, "revision_new": 9,
    "ingestion_ts": 1600000003,
}


def _records(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_sample_edit_decodes(spark):
    out = clean.decode_edits(_records(spark, [json.dumps(SAMPLE)])).collect()[0]
    assert {c: out[c] for c in EDIT_COLUMNS} == SAMPLE
    assert int(out.event_time.timestamp()) == 1600000003


def test_a_value_is_parsed_once(spark):
    rows = spark.createDataFrame([("a", json.dumps(SAMPLE))], "key string, value string")
    plan = clean.valid_edits(clean.decode_edits(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_bad_values_are_rejected_and_wrong_types_null_one_field(spark):
    vals = ["{bad", "[]", "", None, '{"id":"abc","wiki":"x"}', '{"wiki":"t"} trailing']
    decoded = clean.decode_edits(_records(spark, vals))
    kept = {r.wiki: r for r in clean.valid_edits(decoded).collect()}
    assert set(kept) == {"x", "t"}
    assert kept["x"].id is None


def _raw(spark, length, comment=None):
    row = {"id": 1, "wiki": "enwiki", "comment": comment, "length": length}
    df = spark.createDataFrame([json.dumps(row)], "string").select(
        F.from_json("value", RAW_EVENT).alias("e")).select("e.*")
    return clean.trim_events(df, ingestion_ts="0").collect()[0]


@pytest.mark.parametrize("length,delta", [
    ({"old": 10}, None), (None, None), ({"old": 0, "new": 0}, 0), ({"old": 5, "new": 9}, 4),
])
def test_guarded_delta(spark, length, delta):
    assert _raw(spark, length).length_delta == delta


def test_comment_cut_to_240_code_points_and_defaults(spark):
    r = _raw(spark, None, "é" * 300)
    assert len(r.comment) == 240
    assert r.bot is False and r.minor is False
    assert _raw(spark, None, None).comment == ""


def test_feed_lines(spark):
    ev = json.dumps({"id": 7, "wiki": "dewiki", "length": {"old": 1, "new": 3}})
    lines = ["event: message", "id: 7", f"data: {ev}", "", ": comment", "data: {bad",
             f"data:{ev}", "data: []", "   ", "data: " + json.dumps({"id": 8, "wiki": "frwiki"})]
    out = clean.parse_feed_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted(r.id for r in out) == [7, 8]
    assert [r.length.new for r in out if r.id == 7] == [3]


@pytest.mark.parametrize("code,name", [
    ("frwikibooks", "French Wikibooks"), ("zhwikisource", "Chinese Wikisource"),
    ("simplewiki", "Simple English Wikipedia"), ("ckbwiki", "Central Kurdish (Sorani) Wikipedia"),
    ("dewikiquote", "German Wikiquote"), ("enwiktionary", "English Wiktionary"),
    ("commonswiki", "Wikimedia Commons"), ("zzzwiki", "zzzwiki"), ("nepwiki", "nepwiki"),
    ("akanwiki", "Akan Wikipedia"), ("akwiki", "Akan Wikipedia"), ("wiki", "wiki"),
    ("", ""), (None, ""),
])
def test_wiki_names(spark, code, name):
    got = spark.createDataFrame([(code,)], "c string").select(wiki_name(F.col("c"))).first()[0]
    assert got == name


@pytest.mark.parametrize("ns,name", [(0, "Article"), (102, "Namespace 102"), (None, "(unknown)"),
                                     (-1, "Special (virtual)"), (829, "Module talk")])
def test_namespace_names(spark, ns, name):
    got = spark.createDataFrame([(ns,)], "n bigint").select(namespace_name(F.col("n"))).first()[0]
    assert got == name


@pytest.mark.parametrize("t,name", [("edit", "Edit (revision to existing page)"),
                                    ("mystery", "mystery"), ("", "(unknown)"), (None, "(unknown)")])
def test_edit_type_names(spark, t, name):
    got = spark.createDataFrame([(t,)], "t string").select(edit_type_name(F.col("t"))).first()[0]
    assert got == name


def test_row_key_newest_first(spark):
    m = spark.createDataFrame([("enwiki", 1709300040, 1, None), ("enwiki", 1709300100, 2, 1.0)], METRIC)
    keys = {r.window_end_epoch: r.row_key for r in metrics.metric_row_key(m).collect()}
    assert keys[1709300040] == "enwiki|09223372035145475767"
    assert keys[1709300100] < keys[1709300040]


def _edit(i, wiki, ts, delta=None, bot=False, type_="edit", ns=0):
    d = dict.fromkeys(EDIT_COLUMNS)
    d.update(id=i, wiki=wiki, ingestion_ts=ts, length_delta=delta, bot=bot, minor=False,
             type=type_, namespace=ns, title=f"T{i}", user=f"u{i}")
    return tuple(d[c] for c in EDIT_COLUMNS)


def test_null_delta_window_served_as_zero(spark):
    e = spark.createDataFrame([_edit(1, "enwiki", 60), _edit(2, "enwiki", 61)], EDIT)
    m = metrics.window_metrics(clean.with_event_time(e))
    row = m.collect()[0]
    assert row.edit_count == 2 and row.avg_delta is None and row.window_end_epoch == 120
    assert serving.latest_window(m).collect()[0].avg_delta == 0.0
    assert metrics.window_avg_delta(clean.with_event_time(e)).count() == 0


def test_latest_by_arrival_not_edit_timestamp(spark):
    rows = [_edit(1, "enwiki", 100), _edit(2, "enwiki", 100), _edit(3, "enwiki", 99)]
    live = snapshot.live_snapshot(spark.createDataFrame(rows, EDIT)).collect()
    assert [r.title for r in live] == ["T2"]


def test_empty_tables_give_typed_empty_results(spark):
    empty_m = spark.createDataFrame([], METRIC)
    empty_live = spark.createDataFrame([], EDIT).select("wiki", *LIVE_COLUMNS)
    latest = serving.latest_window(empty_m)
    assert latest.count() == 0
    assert serving.top_wikis(latest).count() == 0
    assert serving.trend_picker(latest).count() == 0
    assert serving.edit_type_breakdown(empty_live).count() == 0
    k = serving.kpi_summary(latest, empty_live).collect()
    assert len(k) == 1 and k[0].bot_share_pct == 0.0 and k[0].total_edits == 0
    assert k[0].active_wikis == 0 and k[0].top_wiki is None


def test_picker_label_collision(spark):
    m = spark.createDataFrame([("akwiki", 120, 5, 0.0), ("akanwiki", 120, 9, 0.0),
                               ("dewiki", 120, 7, 0.0)], METRIC)
    rows = {r.label: r for r in serving.trend_picker(serving.latest_window(m)).collect()}
    assert rows["Akan Wikipedia"].wiki == "akwiki"          # less active wiki wins the label
    assert rows["Akan Wikipedia"].first_count == 9          # ... at the more active one's position
    assert rows["Akan Wikipedia"].is_default                # no English Wikipedia -> first label
    assert not rows["German Wikipedia"].is_default


def test_latest_window_as_of_and_short_trend(spark):
    m = spark.createDataFrame([("enwiki", 60, 1, 1.0), ("enwiki", 120, 2, None), ("enwiki", 180, 3, 3.0),
                               ("dewiki", 60, 4, -1.0)], METRIC)
    latest = {r.wiki: (r.window_end_epoch, r.edit_count, r.avg_delta) for r in serving.latest_window(m).collect()}
    assert latest == {"enwiki": (180, 3, 3.0), "dewiki": (60, 4, -1.0)}
    cut = {r.wiki: (r.window_end_epoch, r.avg_delta) for r in serving.latest_window(m, as_of=150).collect()}
    assert cut == {"enwiki": (120, 0.0), "dewiki": (60, -1.0)}
    tr = serving.trend(m, "enwiki").collect()
    assert [r.window_end_epoch for r in tr] == [60, 120, 180]          # fewer than 12: all, oldest first
    assert tr[0].window_end == "1970-01-01 00:01:00"
    assert serving.trend(m, "nosuchwiki").count() == 0


def test_namespace_breakdown_keeps_null_group(spark):
    rows = [_edit(1, "a", 1, ns=0), _edit(2, "b", 1, ns=None), _edit(3, "c", 1, ns=None), _edit(4, "d", 1, ns=102)]
    live = snapshot.live_snapshot(spark.createDataFrame(rows, EDIT))
    got = {r.namespace: (r.namespace_name, r.wiki_count) for r in serving.namespace_breakdown(live).collect()}
    assert got == {None: ("(unknown)", 2), 0: ("Article", 1), 102: ("Namespace 102", 1)}
    assert serving.namespace_breakdown(live, n=1).collect()[0].namespace is None


def test_unknown_bot_counts_as_human(spark):
    rows = [_edit(1, "a", 1), _edit(2, "b", 1)]
    live = snapshot.live_snapshot(spark.createDataFrame(rows, EDIT)).withColumn(
        "bot", F.when(F.col("wiki") == "b", F.lit(True)))
    latest = spark.createDataFrame([], "wiki string, window_end_epoch long, edit_count long, avg_delta double")
    k = serving.kpi_summary(latest, live).first()
    assert (k.bot_count, k.human_count) == (1, 1)


def test_limits_cut_and_ties_are_ordered(spark):
    n = 60
    live = spark.createDataFrame([(f"w{i:02d}", i, "edit") for i in range(n)], "wiki string, namespace long, type string")
    assert [r.namespace for r in serving.namespace_breakdown(live, 15).orderBy("namespace").collect()] == list(range(15))
    latest = spark.createDataFrame([(f"w{i:02d}", 60, 5, float((-1) ** i * (i // 2))) for i in range(n)],
                                   "wiki string, window_end_epoch long, edit_count long, avg_delta double")
    assert sorted(r.wiki for r in serving.top_wikis(latest, 15).collect()) == [f"w{i:02d}" for i in range(15)]
    assert sorted(r.wiki for r in serving.top_abs_delta(latest, 15).collect()) == ["w44", *(f"w{i:02d}" for i in range(46, n))]
    enriched = spark.createDataFrame(
        [(f"w{i:02d}", "edit", "t", "u", False, 1, f"lang{i:02d}", "c", "r", "p") for i in range(n)],
        "wiki string, type string, title string, user string, bot boolean, length_delta long, language string, "
        "continent string, region string, primary_country string")
    assert serving.enriched_sample(enriched).count() == 50
    assert sorted(r.language for r in serving.language_breakdown(enriched).collect()) == [f"lang{i:02d}" for i in range(15)]
