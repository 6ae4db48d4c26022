"""Gapless numbers in arrival order, by a distributed prefix count.

Rows are dealt to tasks by ranges of the order, so a hot group or a hot second
is cut among several tasks and only rows equal in the whole order meet. Each
task numbers its rows by position; the counts of the tasks, one row for each
task and group in it, say how many rows lie before. Nothing is sorted in one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_dir

_TASK_BITS = 33     # of monotonically_increasing_id: the task above, the position below


def numbered(rows: DataFrame, order: list[str], numbers: dict[str, list[str]], tasks: int | None = None) -> DataFrame:
    """Adds, for each ``name: group`` of ``numbers``, ``name`` (0, 1, 2, .. in
    the group by ``order``) and ``name_of`` (the group's rows).

    The columns of all groups come first in ``order``. The sorted rows are
    written once, so that positions stay as they are when a task is run again.
    ``tasks``: how many share the sort; the session's shuffle partitions if not
    given.
    """
    spark = rows.sparkSession
    grain = [c for c in order if any(c in group for group in numbers.values())]
    if grain != order[:len(grain)]:
        raise ValueError(f"groups {grain} do not lead the order {order}")
    path = scratch_dir(spark, "numbered")
    (rows.repartitionByRange(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
     .sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.parquet(path).withColumn("_task", F.shiftright("_at", _TASK_BITS))
    counts = placed.groupBy(*grain, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    for name, group in numbers.items():
        whole = W.partitionBy(*(group or [F.lit(0)]))
        earlier = whole.orderBy(*[c for c in grain if c not in group], "_task").rowsBetween(W.unboundedPreceding, -1)
        counts = counts.withColumn(name, F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).withColumn(
            f"{name}_of", F.sum("_n").over(whole))
    keys = [*grain, "_task"]
    small = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for n in numbers for c in (n, f"{n}_of")])
    same = [placed[k].eqNullSafe(small[f"_k{i}"]) for i, k in enumerate(keys)]
    joined = placed.join(F.broadcast(small), same)      # a row a task and group: the rows stay where they are
    return joined.select(*rows.columns, *[c for n in numbers for c in ((F.col("_at") + F.col(n)).alias(n), f"{n}_of")])


def milestones(edits: DataFrame, order: list[str], every: int = 200) -> DataFrame:
    """The running count of edits at each ``every``-th arrival, and its rate.

    ``order``: ingestion second first. -> sent, id, wiki, ingestion_ts, elapsed
    (seconds since the first arrival), rate (edits a second so far; 0 while no
    second has passed).
    """
    start = edits.agg(F.min("ingestion_ts")).first()[0]
    counted = numbered(edits.select("id", "wiki", "ingestion_ts"), order, {"sent": []}).withColumn("sent", F.col("sent") + 1)
    elapsed = F.col("ingestion_ts") - F.lit(start).cast("long")
    return counted.filter(F.col("sent") % every == 0).select(
        "sent", "id", "wiki", "ingestion_ts", elapsed.alias("elapsed"),
        F.when(elapsed > 0, F.col("sent") / elapsed).otherwise(F.lit(0.0)).alias("rate"))
