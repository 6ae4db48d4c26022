"""Independent DuckDB SQL for every query with an exact oracle.

joins), not from the Spark code. Only the lookup rows are shared; they are
inlined as VALUES because DuckDB sees only the driver's tables.
"""

from __future__ import annotations

from ..functions.fixed_values import (
    EDIT_TYPE_NAMES,
    LANGUAGE_CODE_NAMES,
    NAMESPACE_NAMES,
    PROJECT_SUFFIX_NAMES,
    WIKI_DISPLAY_NAMES,
)
from ..sources.dims import dimension_rows


def _q(s) -> str:
    if s is None:
        return "NULL"
    if isinstance(s, (int, float)):
        return str(s)
    return "'" + str(s).replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


EDIT_COLS = ('id, type, wiki, title, namespace, "user", bot, minor, comment, "timestamp", '
             'server_url, server_name, length_old, length_new, length_delta, revision_old, '
             'revision_new, ingestion_ts')

BASE = f"""
ev AS (
  SELECT event_id, event_type, user_id, epoch_us(ts) // 1000000 AS es,
         CAST(props->>'$.k' AS INT) AS k
  FROM events),
raw0 AS (
  SELECT event_id AS id,
    CASE event_type WHEN 'click' THEN 'edit' WHEN 'purchase' THEN 'new' WHEN 'signup' THEN 'log'
      WHEN 'view' THEN 'categorize'
      ELSE CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'mystery' ELSE 'external' END END AS type,
    CASE WHEN k < 24 THEN 'enwiki' WHEN k < 40 THEN 'commonswiki' WHEN k < 52 THEN 'wikidatawiki'
      WHEN k < 60 THEN 'dewiki' WHEN k < 68 THEN 'frwiki' WHEN k < 74 THEN 'jawiki'
      WHEN k < 79 THEN 'zh_yuewiki' WHEN k < 83 THEN 'ckbwiki' WHEN k < 87 THEN 'frwikibooks'
      WHEN k < 90 THEN 'enwiktionary' WHEN k < 93 THEN 'nepwiki' WHEN k < 95 THEN 'akwiki'
      WHEN k < 97 THEN 'akanwiki' WHEN k < 98 THEN 'zzzwiki' WHEN k < 99 THEN '' ELSE NULL END AS wiki,
    'Page_' || CAST(event_id % 500 AS VARCHAR) AS title,
    CAST(CASE event_id % 13 WHEN 4 THEN 1 WHEN 5 THEN 2 WHEN 6 THEN 3 WHEN 7 THEN 6 WHEN 8 THEN 14
      WHEN 9 THEN 14 WHEN 10 THEN 102 WHEN 11 THEN -1 WHEN 12 THEN NULL ELSE 0 END AS BIGINT) AS namespace,
    'u' || CAST(user_id AS VARCHAR) AS "user",
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id % 3 = 0 END AS bot,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_id % 2 = 0 END AS minor,
    CASE WHEN event_id % 29 = 0 THEN NULL ELSE repeat('é', CAST(event_id % 400 AS INT)) END AS comment,
    1704067200 + ((es - 1704067200) // 600) - event_id % 20 AS "timestamp",
    CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE (event_id * 37) % 5000 END AS length_old,
    CASE WHEN event_type IN ('signup', 'view') OR event_id % 11 = 0 THEN NULL
      ELSE greatest((event_id * 37) % 5000 + event_id % 101 - 50, 0) END AS length_new,
    CASE WHEN event_type = 'signup' THEN NULL ELSE 1000000 + event_id END AS revision_old,
    CASE WHEN event_type = 'signup' THEN NULL ELSE 1000001 + event_id END AS revision_new,
    1704067200 + ((es - 1704067200) // 600) AS ingestion_ts
  FROM ev),
raw AS (
  SELECT *, wiki || '.example.org' AS server_name, 'https://' || wiki || '.example.org' AS server_url
  FROM raw0),
edits AS (
  SELECT id, type, wiki, title, namespace, "user", coalesce(bot, false) AS bot,
    coalesce(minor, false) AS minor, substr(coalesce(comment, ''), 1, 240) AS comment,
    "timestamp", server_url, server_name, length_old, length_new,
    length_new - length_old AS length_delta, revision_old, revision_new, ingestion_ts
  FROM raw),
valid AS (SELECT * FROM edits WHERE wiki IS NOT NULL AND wiki <> ''),
metrics AS (
  SELECT wiki, ingestion_ts - ingestion_ts % 60 + 60 AS window_end_epoch,
         count(*) AS edit_count, avg(length_delta) AS avg_delta
  FROM valid GROUP BY 1, 2),
latest AS (
  SELECT wiki, window_end_epoch, edit_count, coalesce(avg_delta, 0) AS avg_delta
  FROM metrics
  QUALIFY row_number() OVER (PARTITION BY wiki ORDER BY window_end_epoch DESC) = 1),
live AS (
  SELECT wiki, type, title, "user", namespace, server_name, length_old, length_new, length_delta,
         "timestamp", bot, minor, ingestion_ts
  FROM valid
  QUALIFY row_number() OVER (PARTITION BY wiki ORDER BY ingestion_ts DESC, id DESC) = 1),
dim AS (SELECT * FROM {_values(dimension_rows(), ['wiki', 'language', 'continent', 'region', 'primary_country'])}),
enriched_rows AS (
  SELECT v.wiki, v.type, v.title, v."user", v.bot, v.length_delta,
         d.language, d.continent, d.region, d.primary_country, v.ingestion_ts, v.id
  FROM valid v LEFT JOIN dim d ON d.wiki = v.wiki),
enriched AS (
  SELECT wiki, type, title, "user", bot, length_delta, language, continent, region, primary_country
  FROM enriched_rows
  QUALIFY row_number() OVER (PARTITION BY wiki ORDER BY ingestion_ts DESC, id DESC) = 1),
wiki_names AS (SELECT * FROM {_values(WIKI_DISPLAY_NAMES.items(), ['code', 'name'])}),
lang_names AS (SELECT * FROM {_values(LANGUAGE_CODE_NAMES.items(), ['code', 'name'])}),
project_names AS (SELECT * FROM {_values(PROJECT_SUFFIX_NAMES.items(), ['code', 'name'])}),
ns_names AS (SELECT * FROM {_values(NAMESPACE_NAMES.items(), ['id', 'name'])}),
type_names AS (SELECT * FROM {_values(EDIT_TYPE_NAMES.items(), ['code', 'name'])})
"""


def _sql(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body.strip()


def _named(rel: str, col: str = "wiki", out: str = "wiki_name") -> str:
    """``rel`` plus a display-name column for wiki code ``col``."""
    return f"""(SELECT r.*,
        CASE WHEN r.{col} IS NULL OR r.{col} = '' THEN ''
             ELSE coalesce(wn.name,
                  CASE WHEN ln.name IS NOT NULL AND pn.name IS NOT NULL THEN ln.name || ' ' || pn.name END,
                  r.{col}) END AS {out}
      FROM {rel} r
      LEFT JOIN wiki_names wn ON wn.code = r.{col}
      LEFT JOIN project_names pn ON ends_with(r.{col}, pn.code)
      LEFT JOIN lang_names ln ON ln.code = left(r.{col}, length(r.{col}) - length(pn.code)))"""


def _label(c: str) -> str:
    return f"coalesce(nullif({c}, ''), '(unknown)')"


NS_NAME = ("CASE WHEN namespace IS NULL THEN '(unknown)' "
           "ELSE coalesce(nn.name, 'Namespace ' || CAST(namespace AS VARCHAR)) END")
TYPE_NAME = "CASE WHEN {c} IS NULL OR {c} = '' THEN '(unknown)' ELSE coalesce(tn.name, {c}) END"

KEYED_JSON = ("json_object(" + ", ".join(
    f"'{c.strip().strip(chr(34))}', {c.strip()}" for c in EDIT_COLS.split(",")) + ")")


def window_end_text(c: str) -> str:
    return f"strftime(make_timestamp({c} * 1000000), '%Y-%m-%d %H:%M:%S')"


ORACLES: dict[str, str] = {
    "feed_parse": _sql("""
        SELECT id, type, wiki, title, namespace, "user", bot, minor, comment, "timestamp",
               server_url, server_name, length_old, length_new, revision_old, revision_new
        FROM raw WHERE id % 41 <> 0 AND id % 43 <> 0"""),
    "trim_events": _sql(f"SELECT {EDIT_COLS} FROM edits"),
    "valid_edits": _sql(f"SELECT {EDIT_COLS} FROM valid"),
    "decode_edits": _sql(f"SELECT {EDIT_COLS}, ingestion_ts AS event_time_epoch FROM valid"),
    "publish_keyed_json": _sql(f"SELECT wiki AS key, CAST({KEYED_JSON} AS VARCHAR) AS value FROM valid"),
    "enrich_edits": _sql("""
        SELECT wiki, type, title, "user", bot, length_delta, language, continent, region, primary_country
        FROM enriched_rows"""),
    "live_snapshot": _sql("SELECT * FROM live"),
    "enriched_snapshot": _sql("SELECT * FROM enriched"),
    "window_edit_count": _sql("""
        SELECT wiki, ingestion_ts - ingestion_ts % 60 + 60 AS window_end_epoch, count(*) AS edit_count
        FROM valid GROUP BY 1, 2"""),
    "window_avg_delta": _sql("""
        SELECT wiki, ingestion_ts - ingestion_ts % 60 + 60 AS window_end_epoch,
               avg(length_delta) AS avg_delta
        FROM valid WHERE length_delta IS NOT NULL GROUP BY 1, 2"""),
    "window_metrics": _sql("SELECT * FROM metrics"),
    "metric_merge_outer": _sql("SELECT * FROM metrics"),
    "metric_row_key": _sql("""
        SELECT *, wiki || '|' || lpad(CAST(9223372036854775807 - window_end_epoch AS VARCHAR), 20, '0')
               AS row_key
        FROM metrics"""),
    "wiki_names": _sql(f"""
        SELECT wiki, wiki_name, edit_count
        FROM {_named("(SELECT wiki, count(*) AS edit_count FROM raw GROUP BY wiki)")} x"""),
    "namespace_names": _sql(f"""
        SELECT g.namespace, {NS_NAME} AS namespace_name, g.edit_count
        FROM (SELECT namespace, count(*) AS edit_count FROM edits GROUP BY namespace) g
        LEFT JOIN ns_names nn ON nn.id = g.namespace"""),
    "edit_type_names": _sql(f"""
        SELECT g.type, {TYPE_NAME.format(c='g.type')} AS edit_type_name, g.edit_count
        FROM (SELECT type, count(*) AS edit_count FROM edits GROUP BY type) g
        LEFT JOIN type_names tn ON tn.code = g.type"""),
    "latest_window_per_wiki": _sql("SELECT * FROM latest"),
    "wiki_trend": _sql(f"""
        SELECT wiki, window_end_epoch, {window_end_text('window_end_epoch')} AS window_end, edit_count
        FROM metrics WHERE wiki = 'enwiki' ORDER BY window_end_epoch DESC LIMIT 12"""),
    "wiki_trend_all": _sql(f"""
        SELECT wiki, window_end_epoch, {window_end_text('window_end_epoch')} AS window_end, edit_count
        FROM metrics
        QUALIFY row_number() OVER (PARTITION BY wiki ORDER BY window_end_epoch DESC) <= 12"""),
    "latest_edit_per_language": _sql(f"""
        SELECT {_label('language')} AS language, wiki, title, "user", type, coalesce(bot, false) AS bot,
               CAST(coalesce(length_delta, 0) AS BIGINT) AS length_delta
        FROM enriched
        WHERE NOT starts_with({_label('language')}, '(')
        QUALIFY row_number() OVER (PARTITION BY {_label('language')} ORDER BY wiki) = 1"""),
    "edit_type_breakdown": _sql(f"""
        SELECT g.edit_type, {TYPE_NAME.format(c='g.edit_type')} AS edit_type_name, g.wiki_count
        FROM (SELECT {_label('type')} AS edit_type, count(*) AS wiki_count FROM live GROUP BY 1) g
        LEFT JOIN type_names tn ON tn.code = g.edit_type"""),
    "namespace_breakdown": _sql(f"""
        SELECT g.namespace, {NS_NAME} AS namespace_name, g.wiki_count
        FROM (SELECT namespace, count(*) AS wiki_count FROM live GROUP BY namespace) g
        LEFT JOIN ns_names nn ON nn.id = g.namespace
        ORDER BY g.wiki_count DESC, g.namespace ASC NULLS LAST LIMIT 15"""),
    "continent_breakdown": _sql(f"""
        SELECT {_label('continent')} AS continent, count(*) AS wiki_count FROM enriched
        GROUP BY 1 HAVING NOT starts_with({_label('continent')}, '(')"""),
    "language_breakdown": _sql(f"""
        SELECT {_label('language')} AS language, count(*) AS wiki_count FROM enriched
        GROUP BY 1 HAVING NOT starts_with({_label('language')}, '(')
        ORDER BY wiki_count DESC, language LIMIT 15"""),
    "unmapped_wikis": _sql("""
        SELECT count(*) FILTER (WHERE continent IS NULL OR continent = '') AS unmapped_wikis
        FROM enriched"""),
    "kpi_summary": _sql(f"""
        , top AS (SELECT wiki, edit_count FROM latest ORDER BY edit_count DESC, wiki LIMIT 1),
        top_named AS (SELECT * FROM {_named('top')} x),
        people AS (SELECT count(*) FILTER (WHERE bot) AS b, count(*) FILTER (WHERE NOT coalesce(bot, false)) AS h FROM live)
        SELECT (SELECT CAST(coalesce(sum(edit_count), 0) AS BIGINT) FROM latest) AS total_edits,
               (SELECT count(*) FROM latest) AS active_wikis,
               t.wiki AS top_wiki, t.wiki_name AS top_wiki_name, t.edit_count AS top_wiki_count,
               p.b AS bot_count, p.h AS human_count,
               CASE WHEN p.b + p.h > 0 THEN CAST(100 AS DOUBLE) * p.b / (p.b + p.h) ELSE 0.0 END
                 AS bot_share_pct
        FROM people p LEFT JOIN top_named t ON true"""),
    "top_wikis": _sql(f"""
        SELECT wiki, wiki_name, edit_count, avg_delta
        FROM {_named('(SELECT * FROM latest ORDER BY edit_count DESC, wiki LIMIT 15)')} x"""),
    "top_abs_delta": _sql(f"""
        SELECT wiki, wiki_name, edit_count, avg_delta
        FROM {_named('(SELECT * FROM latest ORDER BY abs(avg_delta) DESC, wiki LIMIT 15)')} x"""),
    "enriched_sample": _sql(f"""
        SELECT x.wiki, x.wiki_name, {_label('x.language')} AS language,
               {_label('x.continent')} AS continent, {_label('x.region')} AS region,
               {_label('x.primary_country')} AS primary_country,
               {TYPE_NAME.format(c='x.type')} AS edit_type_name, x.title, x."user",
               coalesce(x.bot, false) AS bot
        FROM {_named('(SELECT * FROM enriched ORDER BY wiki LIMIT 50)')} x
        LEFT JOIN type_names tn ON tn.code = x.type"""),
    "trend_picker": _sql(f"""
        , labelled AS (SELECT wiki, edit_count, wiki_name AS label FROM {_named('latest')} x),
        ranked AS (SELECT label, wiki, edit_count,
                          row_number() OVER (ORDER BY edit_count DESC, wiki) AS pos FROM labelled),
        spans AS (SELECT label, min(pos) AS first_pos, max(pos) AS last_pos FROM ranked GROUP BY label),
        picked AS (SELECT s.label, l.wiki, f.edit_count AS first_count, f.wiki AS first_wiki, s.first_pos
                   FROM spans s JOIN ranked f ON f.pos = s.first_pos JOIN ranked l ON l.pos = s.last_pos)
        SELECT label, wiki, first_count, first_wiki,
               CASE WHEN (SELECT count(*) FROM picked WHERE label = 'English Wikipedia') > 0
                    THEN label = 'English Wikipedia'
                    ELSE first_pos = (SELECT min(first_pos) FROM picked) END AS is_default
        FROM picked"""),
}


ORACLES["publish_milestones"] = _sql("""
    , counted AS (SELECT row_number() OVER (ORDER BY ingestion_ts, id) AS sent, id, wiki, ingestion_ts,
                         ingestion_ts - min(ingestion_ts) OVER () AS elapsed FROM valid)
    SELECT sent, id, wiki, ingestion_ts, elapsed, CASE WHEN elapsed > 0 THEN sent / elapsed ELSE 0.0 END::DOUBLE AS rate
    FROM counted WHERE sent % 200 = 0""")


def late_data_sql(late_mod: int = 23, delay_s: int = 30) -> str:
    """Metrics after a replay where rows with id % late_mod = 0 arrive one file
    late; the watermark seen by file n is max(ingestion_ts of files < n) - delay."""
    return _sql(f"""
        , t AS (SELECT *, (ingestion_ts - 1704067200) // 360
                          + CASE WHEN id % {late_mod} = 0 THEN 1 ELSE 0 END AS file_no FROM valid),
        fm AS (SELECT file_no, max(ingestion_ts) AS mx FROM t GROUP BY 1),
        wm AS (SELECT file_no, coalesce(max(mx) OVER (ORDER BY file_no
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay_s}, 0) AS wm FROM fm),
        kept AS (SELECT t.*, t.ingestion_ts - t.ingestion_ts % 60 + 60 AS we
                 FROM t JOIN wm USING (file_no) WHERE t.ingestion_ts - t.ingestion_ts % 60 + 60 > wm.wm)
        SELECT wiki, we AS window_end_epoch, count(*) AS edit_count, avg(length_delta) AS avg_delta
        FROM kept GROUP BY 1, 2""")


STREAM_ORACLES: dict[str, str] = {
    "src_replay_stream": ORACLES["valid_edits"],
    "log_replay_stream": ORACLES["valid_edits"],
    "stream_live_snapshot": ORACLES["live_snapshot"],
    "stream_window_metrics": ORACLES["window_metrics"],
    "stream_enriched_snapshot": ORACLES["enriched_snapshot"],
    "stream_late_data": late_data_sql(),
    "stream_live_state": ORACLES["live_snapshot"],
    "stream_metric_writers": ORACLES["metric_merge_outer"],
    "progress_report": _sql("""
        , t AS (SELECT (ingestion_ts - 1704067200) // 360 + CASE WHEN id % 23 = 0 THEN 1 ELSE 0 END AS batch_id FROM valid)
        SELECT i::BIGINT AS batch_id, count(t.batch_id) AS num_input_rows
        FROM range((SELECT max(batch_id) + 1 FROM t)) r(i) LEFT JOIN t ON t.batch_id = r.i GROUP BY 1"""),
}
