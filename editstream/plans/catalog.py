"""Query catalog: each SURVEY §2 operator wired to the driver's tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame that
reads ``events.parquet`` (whole table) and derives everything else from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import edit_type_name, namespace_name, wiki_name
from ..operators import clean, enrich as enr, metrics as met, serving, snapshot
from ..operators.numbering import milestones
from ..schemas import ARRIVAL_ORDER, EDIT_COLUMNS, RAW_EVENT
from ..session import prepare
from ..sources import dims, feed, fixture

DEFAULT_TREND_WIKI = "enwiki"


# ------------------------------------------------------------------ derived tables

def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fixture.fixture_raw(spark, sf_dir)


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.trim_events(raw(spark, sf_dir))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.valid_edits(edits(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return met.window_metrics(clean.with_event_time(valid(spark, sf_dir)))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_window(metrics(spark, sf_dir))


def live(spark: SparkSession, sf_dir: str, cells: list[str] | None = None) -> DataFrame:
    v = valid(spark, sf_dir)
    if cells is None:
        return snapshot.live_snapshot(v)
    return snapshot.latest_by(v, "wiki", snapshot.ARRIVAL_ORDER, cells)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.enriched_snapshot_of(valid(spark, sf_dir), dims.language_dim(spark),
                                         dim_rows=dims.bundled_dim_rows())


# ------------------------------------------------------------------ batch queries

def q_feed_parse(spark, sf_dir):
    lines = feed.feed_text_from_raw(raw(spark, sf_dir))
    parsed = clean.parse_feed_lines(lines)
    flat = [f.name for f in RAW_EVENT.fields if f.name not in ("length", "revision")]
    return parsed.select(*flat,
                         F.col("length.old").alias("length_old"), F.col("length.new").alias("length_new"),
                         F.col("revision.old").alias("revision_old"),
                         F.col("revision.new").alias("revision_new"))


def q_trim_events(spark, sf_dir):
    return edits(spark, sf_dir)


def q_valid_edits(spark, sf_dir):
    return valid(spark, sf_dir)


def q_publish_keyed_json(spark, sf_dir):
    return clean.to_keyed_json(edits(spark, sf_dir))


def q_publish_milestones(spark, sf_dir):
    return milestones(valid(spark, sf_dir), ARRIVAL_ORDER)


def q_decode_edits(spark, sf_dir):
    records = clean.to_keyed_json(edits(spark, sf_dir))
    decoded = clean.valid_edits(clean.decode_edits(records))
    return decoded.select(*EDIT_COLUMNS, F.unix_timestamp("event_time").alias("event_time_epoch"))


def q_enrich_edits(spark, sf_dir):
    return enr.enrich(valid(spark, sf_dir), dims.language_dim(spark), dim_rows=dims.bundled_dim_rows())


def q_live_snapshot(spark, sf_dir):
    return live(spark, sf_dir)


def q_enriched_snapshot(spark, sf_dir):
    return enriched(spark, sf_dir)


def q_window_edit_count(spark, sf_dir):
    return met.window_edit_count(clean.with_event_time(valid(spark, sf_dir)))


def q_window_avg_delta(spark, sf_dir):
    return met.window_avg_delta(clean.with_event_time(valid(spark, sf_dir)))


def q_window_metrics(spark, sf_dir):
    return metrics(spark, sf_dir)


def q_metric_merge_outer(spark, sf_dir):
    return met.metric_merge_outer(clean.with_event_time(valid(spark, sf_dir)))


def q_metric_row_key(spark, sf_dir):
    return met.metric_row_key(metrics(spark, sf_dir))


def q_wiki_names(spark, sf_dir):
    codes = raw(spark, sf_dir).groupBy("wiki").agg(F.count(F.lit(1)).alias("edit_count"))
    return codes.select("wiki", wiki_name(F.col("wiki")).alias("wiki_name"), "edit_count")


def q_namespace_names(spark, sf_dir):
    ns = edits(spark, sf_dir).groupBy("namespace").agg(F.count(F.lit(1)).alias("edit_count"))
    return ns.select("namespace", namespace_name(F.col("namespace")).alias("namespace_name"), "edit_count")


def q_edit_type_names(spark, sf_dir):
    ts = edits(spark, sf_dir).groupBy("type").agg(F.count(F.lit(1)).alias("edit_count"))
    return ts.select("type", edit_type_name(F.col("type")).alias("edit_type_name"), "edit_count")


def q_latest_window_per_wiki(spark, sf_dir):
    return latest(spark, sf_dir)


def q_wiki_trend(spark, sf_dir):
    return serving.trend(metrics(spark, sf_dir), DEFAULT_TREND_WIKI)


def q_wiki_trend_all(spark, sf_dir):
    return serving.trend_all(metrics(spark, sf_dir))


def q_latest_edit_per_language(spark, sf_dir):
    return serving.latest_edit_per_language(enriched(spark, sf_dir))


def q_edit_type_breakdown(spark, sf_dir):
    return serving.edit_type_breakdown(live(spark, sf_dir, ["type"]))


def q_namespace_breakdown(spark, sf_dir):
    return serving.namespace_breakdown(live(spark, sf_dir, ["namespace"]))


def q_continent_breakdown(spark, sf_dir):
    return serving.continent_breakdown(enriched(spark, sf_dir))


def q_language_breakdown(spark, sf_dir):
    return serving.language_breakdown(enriched(spark, sf_dir))


def q_unmapped_wikis(spark, sf_dir):
    return serving.unmapped_wikis(enriched(spark, sf_dir))


def q_kpi_summary(spark, sf_dir):
    return serving.kpi_summary(latest(spark, sf_dir), live(spark, sf_dir, ["bot"]))


def q_top_wikis(spark, sf_dir):
    return serving.top_wikis(latest(spark, sf_dir))


def q_top_abs_delta(spark, sf_dir):
    return serving.top_abs_delta(latest(spark, sf_dir))


def q_enriched_sample(spark, sf_dir):
    return serving.enriched_sample(enriched(spark, sf_dir))


def q_trend_picker(spark, sf_dir):
    return serving.trend_picker(latest(spark, sf_dir))


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_parse": q_feed_parse,
    "trim_events": q_trim_events,
    "valid_edits": q_valid_edits,
    "decode_edits": q_decode_edits,
    "publish_keyed_json": q_publish_keyed_json,
    "publish_milestones": q_publish_milestones,
    "enrich_edits": q_enrich_edits,
    "live_snapshot": q_live_snapshot,
    "enriched_snapshot": q_enriched_snapshot,
    "window_edit_count": q_window_edit_count,
    "window_avg_delta": q_window_avg_delta,
    "window_metrics": q_window_metrics,
    "metric_merge_outer": q_metric_merge_outer,
    "metric_row_key": q_metric_row_key,
    "wiki_names": q_wiki_names,
    "namespace_names": q_namespace_names,
    "edit_type_names": q_edit_type_names,
    "latest_window_per_wiki": q_latest_window_per_wiki,
    "wiki_trend": q_wiki_trend,
    "wiki_trend_all": q_wiki_trend_all,
    "latest_edit_per_language": q_latest_edit_per_language,
    "edit_type_breakdown": q_edit_type_breakdown,
    "namespace_breakdown": q_namespace_breakdown,
    "continent_breakdown": q_continent_breakdown,
    "language_breakdown": q_language_breakdown,
    "unmapped_wikis": q_unmapped_wikis,
    "kpi_summary": q_kpi_summary,
    "top_wikis": q_top_wikis,
    "top_abs_delta": q_top_abs_delta,
    "enriched_sample": q_enriched_sample,
    "trend_picker": q_trend_picker,
}
