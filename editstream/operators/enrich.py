"""Stream-static enrichment: left broadcast equi-join to the language dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ARRIVAL_ORDER, DIM_COLUMNS
from ..sources.dims import checked_broadcast

ENRICHED_OUTPUT = [
    "wiki", "type", "title", "user", "bot", "length_delta",
    "language", "continent", "region", "primary_country",
]


SALTS = 16


def salted_left_join(edits: DataFrame, side: DataFrame, salts: int = SALTS) -> DataFrame:
    """A shuffled left join on ``wiki`` that cuts each wiki into ``salts`` parts.

    For a side too large to broadcast: it is copied once a salt, and the edits
    of a hot wiki are dealt over the salts by a hash of their columns (the same
    when a task runs again). Streams need this, as nothing splits skewed
    partitions there at run time.
    """
    dealt = edits.withColumn("_salt", F.pmod(F.xxhash64(*edits.columns), F.lit(salts)).cast("int"))
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, ["wiki", "_salt"], "left").drop("_salt")


def enrich(edits: DataFrame, dim: DataFrame, keep: list[str] | None = None,
           dim_rows: int | None = None) -> DataFrame:
    """Attach language/continent/region/country to every edit on ``wiki``.

    Unmatched edits are kept with null dimension columns. The dimension is
    broadcast (planned as BroadcastHashJoin LeftOuter BuildRight), so the edit
    stream is never shuffled; its bytes are checked before the hint is given
    (``dim_rows``: the row count of the bundled one, whose size is known). A
    larger one is joined by a shuffle that splits hot wikis.
    """
    keep = keep if keep is not None else ENRICHED_OUTPUT
    side = dim.select(*DIM_COLUMNS)
    small = checked_broadcast(side, known_rows=dim_rows)
    joined = salted_left_join(edits, side) if small is None else edits.join(small, on="wiki", how="left")
    return joined.select(*keep)


def enrich_for_snapshot(edits: DataFrame, dim: DataFrame, dim_rows: int | None = None,
                        extra: list[str] | None = None) -> DataFrame:
    """Enriched rows plus the arrival-order columns the snapshot needs."""
    extra = [c for c in (extra or ARRIVAL_ORDER) if c not in ENRICHED_OUTPUT]
    return enrich(edits, dim, ENRICHED_OUTPUT + extra, dim_rows)
