"""Landed event-feed text: read it, and render the replay fixture as feed text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_EVENT


def read_feed_text(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Feed text files, one line per row in column ``value``."""
    if not streaming:
        return spark.read.text(path)
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path)


def feed_text_from_raw(raw: DataFrame) -> DataFrame:
    """Render each raw event as the four lines a feed sends for it.

    ``event: message``, ``id: <id>``, ``data: <json>``, blank. Damaged
    variants for the parser checks: ids divisible by 41 carry an undecodable
    payload, ids divisible by 43 lose the space after ``data:``.
    """
    body = F.to_json(F.struct(*[F.col(f.name) for f in RAW_EVENT.fields]))
    eid = F.col("id")
    data_line = (F.when(eid % 41 == 0, F.lit("data: {bad"))
                 .when(eid % 43 == 0, F.concat(F.lit("data:"), body))
                 .otherwise(F.concat(F.lit("data: "), body)))
    lines = F.array(F.lit("event: message"), F.concat(F.lit("id: "), eid.cast("string")),
                    data_line, F.lit(""))
    return raw.select(F.explode(lines).alias("value"))
