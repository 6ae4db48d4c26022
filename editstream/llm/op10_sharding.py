"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows of each source are ranked in a seeded shuffle; a row's fractional rank is
``(rank + 1/2) / rows of its source``. Sorted by fractional rank, every stretch
of the sequence holds the sources in their overall proportion, so cutting it
into equal runs gives shards that all match the mixture. The law kept is
``rows``: shard counts differ by one at most. Rows of equal texts are separate
rows (a group of copies may be larger than a shard).

Both rankings deal rows to tasks by ranges of the whole order, with a row's number
at its end, and add the counts of the tasks before (``numbered``). So neither a
source with most rows nor an id or a row that stands in a third of them meets in
one task. Only ids, sizes and checksums are shuffled, never texts.

Defined cases: a null text counts as no bytes (size 8, checksum 0); a null
source is a stratum of its own; a null id is ranked like any other value; rows
that agree in id, size and checksum are interchangeable; an empty table gives
no rows; very long texts count by their bytes and are not moved; columns besides
the id, source and text are not read by the query, and ``interleave`` takes any
names along but ``shard`` and ``slot``, which it writes anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from .shared import fraction_key, read_table, stored

SHARDS = 24
SEED = "interleave-1"


def interleave(rows: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """rows: doc_id, source, and whatever is to travel along -> + shard, slot.

    ``shard`` is 0 to ``shards - 1``, ``slot`` the gapless place in it.
    """
    rows = rows.drop("shard", "slot")
    extra = [c for c in rows.columns if c not in ("doc_id", "source")]
    # Written, so that a row keeps its number when a task is run again.
    keyed = stored(rows.select(
        *rows.columns,
        fraction_key(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_h"),
        F.monotonically_increasing_id().alias("_row")), "interleave")
    ties = ["doc_id", *extra, "_row"]
    within = numbered(keyed, ["source", "_h", *ties], {"_rank": ["source"]})
    spread = within.withColumn("_f", (2 * F.col("_rank") + 1) / (2.0 * F.col("_rank_of"))).drop("_rank", "_rank_of")
    placed = numbered(spread, ["_f", "_h", "source", *ties], {"_place": []}).withColumnsRenamed({"_place": "_at", "_place_of": "_total"})
    each = F.floor(F.col("_total") / shards)
    more = F.col("_total") - each * shards
    edge = more * (each + 1)
    return placed.select(
        *rows.columns,
        F.when(F.col("_at") < edge, F.floor(F.col("_at") / (each + 1)))
        .otherwise(more + F.floor((F.col("_at") - edge) / F.greatest(each, F.lit(1)))).cast("int").alias("shard"),
        F.when(F.col("_at") < edge, F.col("_at") % (each + 1))
        .otherwise((F.col("_at") - edge) % F.greatest(each, F.lit(1))).cast("long").alias("slot"))


def op10_stratified_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard."""
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    return interleave(rows).select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


_BYTES = "list_transform(string_split(rtrim(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1,', 'g'), ','), ','), " \
         "lambda x: CASE WHEN x = '' THEN -1 ELSE (instr('0123456789ABCDEF', x[1]) - 1) * 16 + instr('0123456789ABCDEF', x[2]) - 1 END)"

OP10_SQL = f"""
WITH RECURSIVE crc_bits AS (
  SELECT i AS n, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY n) AS tab FROM crc_bits WHERE k = 8),
sized AS (
  SELECT doc_id, source, strlen(coalesce(text, ''))::BIGINT + 8 AS size,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_filter({_BYTES}, lambda x: x >= 0)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
    md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents, crc_table),
ranked AS (
  SELECT *, (2 * (row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size, text_crc32) - 1) + 1)
    / (2.0::DOUBLE * count(*) OVER (PARTITION BY source)) AS f FROM sized),
placed AS (
  SELECT *, row_number() OVER (ORDER BY f, h, source NULLS FIRST, doc_id NULLS FIRST, size, text_crc32) - 1 AS place,
    count(*) OVER () // {SHARDS} AS each, count(*) OVER () % {SHARDS} AS more FROM ranked)
SELECT doc_id, source, size, text_crc32, 'rows' AS law,
  (CASE WHEN place < more * (each + 1) THEN place // (each + 1)
    ELSE more + (place - more * (each + 1)) // greatest(each, 1) END)::INT AS shard,
  (CASE WHEN place < more * (each + 1) THEN place % (each + 1)
    ELSE (place - more * (each + 1)) % greatest(each, 1) END)::BIGINT AS slot,
  NULL::INT AS grown_shard
FROM placed
"""
