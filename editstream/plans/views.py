"""Serving read path: every serving query over the tables the streams write.

``start_all(.., root)`` maintains ``root/live``, ``root/metrics`` and
``root/enriched``; ``table_views(spark, root)`` returns the serving queries
over them as lazy DataFrames (one refresh of the dashboard's data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import serving
from ..streaming import sinks

DEFAULT_TREND_WIKI = "enwiki"


def table_views(spark: SparkSession, root: str, top_n: int = serving.TOP_N,
                trend_wiki: str = DEFAULT_TREND_WIKI) -> dict[str, DataFrame]:
    metrics = sinks.metric_table(f"{root}/metrics").read(spark)
    live = lambda *c: sinks.live_table(f"{root}/live").read(spark, [*c])
    enriched = lambda *c: sinks.enriched_table(f"{root}/enriched").read(spark, [*c] or None)
    latest = serving.latest_window(metrics)
    return {
        "latest_window_per_wiki": latest,
        "kpi_summary": serving.kpi_summary(latest, live("bot")),
        "top_wikis": serving.top_wikis(latest, top_n),
        "top_abs_delta": serving.top_abs_delta(latest, top_n),
        "trend_picker": serving.trend_picker(latest),
        "wiki_trend": serving.trend(metrics, trend_wiki),
        "wiki_trend_all": serving.trend_all(metrics),
        "edit_type_breakdown": serving.edit_type_breakdown(live("type")),
        "namespace_breakdown": serving.namespace_breakdown(live("namespace"), top_n),
        "continent_breakdown": serving.continent_breakdown(enriched("continent")),
        "language_breakdown": serving.language_breakdown(enriched("language")),
        "unmapped_wikis": serving.unmapped_wikis(enriched("continent")),
        "enriched_sample": serving.enriched_sample(enriched()),
        "latest_edit_per_language": serving.latest_edit_per_language(enriched()),
    }
