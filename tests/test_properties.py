"""

Each example is evaluated as one Spark job over a list of generated inputs.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from editstream.functions.fixed_values import (
    LANGUAGE_CODE_NAMES,
    PROJECT_SUFFIX_NAMES,
    WIKI_DISPLAY_NAMES,
)
from editstream.functions.names import wiki_name
from editstream.operators import clean
from editstream.schemas import RAW_EVENT

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _names(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    return [r[0] for r in df.select(wiki_name(F.col("c"))).collect()]


def test_curated_codes_give_their_names(spark):
    assert _names(spark, list(WIKI_DISPLAY_NAMES)) == list(WIKI_DISPLAY_NAMES.values())


def test_codes_built_from_the_tables_give_both_names(spark):
    built = {lang + suffix: f"{a} {b}" for lang, a in LANGUAGE_CODE_NAMES.items() for suffix, b in PROJECT_SUFFIX_NAMES.items()
             if lang + suffix not in WIKI_DISPLAY_NAMES}
    assert _names(spark, list(built)) == list(built.values())


@SETTINGS
@given(st.lists(st.text("qxzw_09", max_size=7).map(lambda x: x + "9"), min_size=1, max_size=40))
def test_other_codes_give_themselves(spark, batch):
    assert _names(spark, batch) == batch
    assert _names(spark, ["", None]) == ["", ""]


longs = st.one_of(st.none(), st.integers(-10**6, 10**6))
pairs = st.one_of(st.none(), st.fixed_dictionaries({"old": longs, "new": longs}))
raw_events = st.fixed_dictionaries({
    "id": st.integers(0, 10**9),
    "wiki": st.one_of(st.none(), st.sampled_from(["", "enwiki", "dewiki"])),
    "bot": st.one_of(st.none(), st.booleans()),
    "minor": st.one_of(st.none(), st.booleans()),
    "comment": st.one_of(st.none(), st.text(max_size=300)),
    "length": pairs,
    "revision": pairs,
})


@SETTINGS
@given(st.lists(raw_events, min_size=1, max_size=30, unique_by=lambda r: r["id"]))
def test_trimmed_edits_keep_their_invariants(spark, batch):
    rows = [tuple(r.get(f.name) for f in RAW_EVENT.fields) for r in batch]
    out = clean.trim_events(spark.createDataFrame(rows, RAW_EVENT), ingestion_ts="0").collect()
    raw = {r["id"]: r for r in batch}
    assert len(out) == len(raw)
    for e in out:
        was = raw[e.id]
        assert e.bot in (True, False) and (was["bot"] is None or e.bot == was["bot"])
        assert e.minor in (True, False) and (was["minor"] is None or e.minor == was["minor"])
        assert len(e.comment) <= 240 and (was["comment"] or "").startswith(e.comment)
        assert len(e.comment) == 240 or e.comment == (was["comment"] or "")
        assert (e.length_delta is None) == (e.length_old is None or e.length_new is None)
        assert e.length_delta is None or e.length_old + e.length_delta == e.length_new


updates = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 50), st.integers(0, 9)),
                   max_size=12, unique_by=lambda t: (t[1], t[2]))


@settings(parent=SETTINGS, max_examples=4)
@given(updates, updates, updates)
def test_table_keeps_the_last_write_of_each_key(spark, a, b, c):
    from editstream.session import scratch_dir
    from editstream.streaming.sinks import UpsertTable

    schema = "wiki string, ingestion_ts long, id long"
    table = UpsertTable(scratch_dir(spark, "prop"), ["wiki"], ["id"], ["ingestion_ts", "id"])
    expect = {}
    for n, rows in enumerate((a, b, c, c)):
        table.write_batch(spark.createDataFrame(rows, schema), n, "q")
        expect.update({w: i for w, t, i in sorted(rows, key=lambda r: r[1:])})
        if n == 1:
            table.compact(spark)
    assert {r.wiki: r.id for r in table.read(spark).collect()} == expect


edit_rows = st.lists(st.tuples(st.sampled_from(["enwiki", "dewiki", "frwiki", "jawiki"]),
                               st.integers(0, 600), st.one_of(st.none(), st.integers(-50, 50))),
                     min_size=1, max_size=60)


@SETTINGS
@given(edit_rows, st.integers(1, 4))
def test_metrics_latest_and_top_match_model(spark, rows, n):
    from editstream.operators import metrics, serving

    df = spark.createDataFrame([(w, t, d) for w, t, d in rows],
                               "wiki string, ingestion_ts long, length_delta long")
    m = metrics.window_metrics(clean.with_event_time(df))
    model = {}
    for w, t, d in rows:
        key = (w, t - t % 60 + 60)
        cnt, vals = model.get(key, (0, []))
        model[key] = (cnt + 1, vals + ([d] if d is not None else []))
    got = {(r.wiki, r.window_end_epoch): (r.edit_count, r.avg_delta) for r in m.collect()}
    assert got == {k: (c, (sum(v) / len(v)) if v else None) for k, (c, v) in model.items()}

    newest = {}
    for (w, we), (c, v) in model.items():
        if w not in newest or we > newest[w][0]:
            newest[w] = (we, c, (sum(v) / len(v)) if v else 0.0)
    latest = serving.latest_window(m)
    assert {r.wiki: (r.window_end_epoch, r.edit_count, r.avg_delta) for r in latest.collect()} == newest
    top = [r.wiki for r in serving.top_wikis(latest, n).collect()]
    want = [w for w, _ in sorted(newest.items(), key=lambda kv: (-kv[1][1], kv[0]))][:n]
    assert sorted(top) == sorted(want)
