"""Serving queries over the metric table and the two snapshots.

Design rules used throughout:
- "newest per key" / "first per key" are grouped ``max_by``/``min_by``
  aggregations (partial + final), never a global sort or a collect;
- top-N is ``orderBy(..).limit(n)`` -> TakeOrderedAndProject (each partition
  keeps n rows, the final merge sees n x partitions rows);
- every sort carries the key as tie-break so results are deterministic;
- global figures are one-row aggregates, attached with scalar subqueries
  (computed once, inlined as a value) instead of joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import DEFAULT_PICKER_LABEL, UNKNOWN_LABEL
from ..functions.names import edit_type_name, namespace_name, wiki_name

TOP_N = 15
TREND_POINTS = 12
SAMPLE_ROWS = 50
LANGUAGE_TOP = 15


def _label(c: str) -> F.Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(UNKNOWN_LABEL))


def _known(c: str) -> F.Column:
    return ~F.col(c).startswith("(")


# ---------------------------------------------------------------- metric table

def latest_window(metrics: DataFrame, as_of: int | None = None) -> DataFrame:
    """Newest window per wiki with its count and average (missing average -> 0).

    The window end is unique per wiki, so per-column ``max_by`` picks one
    consistent row; with primitive buffers this stays a hash aggregation
    (partial + final, no sort). ``as_of`` (epoch seconds) optionally ignores
    windows ending after it.
    """
    m = metrics if as_of is None else metrics.where(F.col("window_end_epoch") <= F.lit(as_of))
    we = F.col("window_end_epoch")
    picked = m.groupBy("wiki").agg(
        F.max(we).alias("window_end_epoch"),
        F.max_by("edit_count", we).alias("edit_count"),
        F.max_by("avg_delta", we).alias("avg_delta"),
    )
    return picked.select("wiki", "window_end_epoch", "edit_count",
                         F.coalesce(F.col("avg_delta"), F.lit(0.0)).alias("avg_delta"))


def _trend_cols(df: DataFrame) -> DataFrame:
    return df.select(
        "wiki", "window_end_epoch",
        F.date_format(F.timestamp_seconds("window_end_epoch"), "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        F.coalesce(F.col("edit_count"), F.lit(0)).alias("edit_count"),
    )


def trend(metrics: DataFrame, wiki: str, n: int = TREND_POINTS) -> DataFrame:
    """Last ``n`` windows of one wiki (filter pushed to the scan), oldest first."""
    last = (metrics.where((F.col("wiki") == F.lit(wiki)) & F.col("window_end_epoch").isNotNull())
            .orderBy(F.desc("window_end_epoch")).limit(n))
    return _trend_cols(last).orderBy("window_end_epoch")


def trend_all(metrics: DataFrame, n: int = TREND_POINTS) -> DataFrame:
    """Last ``n`` windows of every wiki. ``row_number() <= n`` lets Catalyst add
    a partial WindowGroupLimit before the shuffle, so a hot wiki ships at
    most ``n`` rows per partition."""
    w = Window.partitionBy("wiki").orderBy(F.desc("window_end_epoch"))
    ranked = (metrics.where(F.col("window_end_epoch").isNotNull())
              .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n))
    return _trend_cols(ranked)


def top_wikis(latest: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top-n wikis by edits in their newest window."""
    top = latest.orderBy(F.desc("edit_count"), F.asc("wiki")).limit(n)
    return top.select("wiki", wiki_name(F.col("wiki")).alias("wiki_name"), "edit_count", "avg_delta")


def top_abs_delta(latest: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top-n wikis by |average size change| over all wikis, sign kept."""
    top = latest.orderBy(F.desc(F.abs("avg_delta")), F.asc("wiki")).limit(n)
    return top.select("wiki", wiki_name(F.col("wiki")).alias("wiki_name"), "edit_count", "avg_delta")


def trend_picker(latest: DataFrame) -> DataFrame:
    """Picker labels in order of activity, one wiki per label.

    Listing wikis by (count desc, wiki), a label keeps the position of its
    first wiki but resolves to its last (least active) wiki. Position is
    reported as that first wiki's sort key. The default is ``English
    Wikipedia`` when present, else the first label: one global one-row
    aggregate, attached as a single scalar subquery.
    """
    labelled = latest.select("wiki", "edit_count", wiki_name(F.col("wiki")).alias("label"))
    rank_key = F.struct((-F.col("edit_count")).alias("neg_count"), F.col("wiki"))
    labels = labelled.groupBy("label").agg(
        F.max("edit_count").alias("first_count"),
        F.min_by("wiki", rank_key).alias("first_wiki"),
        F.max_by("wiki", rank_key).alias("wiki"),
    )
    # The default (label and the wiki it resolves to) is one global row. The
    # subquery reads every column of `labels`, so its plan matches the main
    # query's and Spark reuses the exchange instead of computing labels twice.
    order = F.struct((-F.col("first_count")).alias("n"), F.col("first_wiki"))
    is_en = (F.col("label") == F.lit(DEFAULT_PICKER_LABEL)).cast("int")
    has_en = F.max(is_en) == 1
    default = labels.select(F.struct(
        F.when(has_en, F.lit(DEFAULT_PICKER_LABEL)).otherwise(F.min_by("label", order)).alias("label"),
        F.when(has_en, F.max_by("wiki", is_en)).otherwise(F.min_by("wiki", order)).alias("wiki"),
    )).scalar()
    return labels.select("label", "wiki", "first_count", "first_wiki",
                         F.coalesce(F.col("label") == default.getField("label"), F.lit(False)).alias("is_default"))


def kpi_summary(latest: DataFrame, live: DataFrame) -> DataFrame:
    """Headline figures: edits and active wikis in the newest windows, the most
    active wiki, and bots vs humans on the live snapshot (share 0 when empty).

    Both inputs are tagged and unioned, so all figures come from one global
    aggregation (partial per partition, one final row): each input is
    computed once, with no join and no subquery.
    """
    m = latest.select(F.lit(True).alias("_m"), "wiki", "edit_count",
                      F.lit(None).cast("boolean").alias("bot"))
    p = live.select(F.lit(False).alias("_m"), F.lit(None).cast("string").alias("wiki"),
                    F.lit(None).cast("long").alias("edit_count"), "bot")
    is_m = F.col("_m")
    bot = F.coalesce("bot", F.lit(False))  # unknown counts as human
    rank_key = F.when(is_m, F.struct((-F.col("edit_count")).alias("neg_count"), F.col("wiki")))
    head = m.unionByName(p).agg(
        F.coalesce(F.sum("edit_count"), F.lit(0)).cast("long").alias("total_edits"),
        F.count_if(is_m).alias("active_wikis"),
        F.min_by("wiki", rank_key).alias("top_wiki"),
        F.max("edit_count").alias("top_wiki_count"),
        F.count_if(~is_m & bot).alias("bot_count"),
        F.count_if(~is_m & ~bot).alias("human_count"),
    )
    total = F.col("bot_count") + F.col("human_count")
    share = F.when(total > 0, F.lit(100.0) * F.col("bot_count") / total).otherwise(F.lit(0.0))
    return head.select(
        "total_edits", "active_wikis", "top_wiki",
        F.when(F.col("top_wiki").isNotNull(), wiki_name(F.col("top_wiki"))).alias("top_wiki_name"),
        "top_wiki_count", "bot_count", "human_count", share.alias("bot_share_pct"),
    )


# ---------------------------------------------------------------- live snapshot

def edit_type_breakdown(live: DataFrame) -> DataFrame:
    """Number of wikis whose latest edit has each type."""
    counted = live.groupBy(_label("type").alias("edit_type")).agg(F.count(F.lit(1)).alias("wiki_count"))
    return counted.select("edit_type", edit_type_name(F.col("edit_type")).alias("edit_type_name"),
                          "wiki_count")


def namespace_breakdown(live: DataFrame, n: int | None = TOP_N) -> DataFrame:
    """Wikis per namespace of their latest edit (null kept as its own group)."""
    counted = live.groupBy("namespace").agg(F.count(F.lit(1)).alias("wiki_count"))
    out = counted.select("namespace", namespace_name(F.col("namespace")).alias("namespace_name"),
                         "wiki_count")
    if n is not None:
        out = out.orderBy(F.desc("wiki_count"), F.asc_nulls_last("namespace")).limit(n)
    return out


# ---------------------------------------------------------------- enriched snapshot

def continent_breakdown(enriched: DataFrame) -> DataFrame:
    counted = enriched.groupBy(_label("continent").alias("continent")).agg(
        F.count(F.lit(1)).alias("wiki_count"))
    return counted.where(_known("continent"))


def language_breakdown(enriched: DataFrame, n: int | None = LANGUAGE_TOP) -> DataFrame:
    counted = enriched.groupBy(_label("language").alias("language")).agg(
        F.count(F.lit(1)).alias("wiki_count")).where(_known("language"))
    if n is not None:
        counted = counted.orderBy(F.desc("wiki_count"), F.asc("language")).limit(n)
    return counted


def unmapped_wikis(enriched: DataFrame) -> DataFrame:
    missing = F.col("continent").isNull() | (F.col("continent") == "")
    return enriched.agg(F.count_if(missing).alias("unmapped_wikis"))


def enriched_sample(enriched: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """First ``n`` enriched rows in key order with decoded names."""
    first = enriched.orderBy("wiki").limit(n)
    return first.select(
        "wiki",
        wiki_name(F.col("wiki")).alias("wiki_name"),
        _label("language").alias("language"),
        _label("continent").alias("continent"),
        _label("region").alias("region"),
        _label("primary_country").alias("primary_country"),
        edit_type_name(F.col("type")).alias("edit_type_name"),
        "title", "user",
        F.coalesce(F.col("bot"), F.lit(False)).alias("bot"),
    )


def latest_edit_per_language(enriched: DataFrame) -> DataFrame:
    """For each known language, its first enriched row in key (wiki) order."""
    labelled = enriched.select(_label("language").alias("language"), "wiki", "title", "user",
                               "type", "bot", "length_delta").where(_known("language"))
    picked = labelled.groupBy("language").agg(
        F.min_by(F.struct("wiki", "title", "user", "type", "bot", "length_delta"),
                 F.col("wiki")).alias("r"))
    return picked.select(
        "language",
        F.col("r.wiki").alias("wiki"), F.col("r.title").alias("title"), F.col("r.user").alias("user"),
        F.col("r.type").alias("type"), F.coalesce(F.col("r.bot"), F.lit(False)).alias("bot"),
        F.coalesce(F.col("r.length_delta"), F.lit(0)).cast("long").alias("length_delta"),
    )
