"""Display names as native column expressions (no Python UDFs).

Each lookup is a literal map folded into the plan; they are applied to
already-reduced results (one row per wiki / namespace / type), never to the
raw edit stream. The maps are written as SQL text so each costs one
driver->JVM call to build rather than one per entry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import (
    EDIT_TYPE_NAMES,
    LANGUAGE_CODE_NAMES,
    NAMESPACE_NAMES,
    PROJECT_SUFFIX_NAMES,
    UNKNOWN_LABEL,
    WIKI_DISPLAY_NAMES,
)


def _sql_lit(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else f"{v}L"


_MAP_SQL: dict[int, str] = {}


def _map(mapping: dict) -> Column:
    key = id(mapping)
    if key not in _MAP_SQL:
        _MAP_SQL[key] = "map(" + ", ".join(f"{_sql_lit(k)}, {_sql_lit(v)}" for k, v in mapping.items()) + ")"
    return F.expr(_MAP_SQL[key])


def suffix_pattern() -> str:
    """``^(<lang>)(<project suffix>)$``; no code can end with two suffixes."""
    return "^(.*)(" + "|".join(PROJECT_SUFFIX_NAMES) + ")$"


def wiki_name(code: Column) -> Column:
    """Curated name, else ``<language> <project>`` parsed from the code, else
    the raw code; null or empty code -> empty string."""
    curated = F.try_element_at(_map(WIKI_DISPLAY_NAMES), code)
    pattern = suffix_pattern()
    lang = F.try_element_at(_map(LANGUAGE_CODE_NAMES), F.regexp_extract(code, pattern, 1))
    project = F.try_element_at(_map(PROJECT_SUFFIX_NAMES), F.regexp_extract(code, pattern, 2))
    parsed = F.when(lang.isNotNull() & project.isNotNull(), F.concat_ws(" ", lang, project))
    return (F.when(code.isNull() | (code == ""), F.lit(""))
            .otherwise(F.coalesce(curated, parsed, code)))


def namespace_name(ns: Column) -> Column:
    """Known namespace name, else ``Namespace <n>``; null -> ``(unknown)``."""
    named = F.try_element_at(_map(NAMESPACE_NAMES), ns.cast("long"))
    return (F.when(ns.isNull(), F.lit(UNKNOWN_LABEL))
            .otherwise(F.coalesce(named, F.concat(F.lit("Namespace "), ns.cast("string")))))


def edit_type_name(t: Column) -> Column:
    """Known edit-type description, else the raw type; null/empty -> ``(unknown)``."""
    return (F.when(t.isNull() | (t == ""), F.lit(UNKNOWN_LABEL))
            .otherwise(F.coalesce(F.try_element_at(_map(EDIT_TYPE_NAMES), t), t)))
