"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import scratch_dir

BUCKET_HEX = 3
"""Hex digits of the order key that make a rank bucket: 16^3 buckets a group."""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation, and
    several readers share one computation.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    # Nothing reads this job's shuffle files again: what follows reads the table.
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean, None)
    spark.conf.set(clean, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(clean) if before is None else spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def group_offsets(rows: DataFrame, group: list[str], bucket: str) -> DataFrame:
    """Rows before each (group, bucket) in its group, and the group's total.

    Counts are summed before the shuffle, so the window sees one row a bucket.
    """
    counts = rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    before = whole.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return counts.select(
        *group, bucket,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"))


def ranked(rows: DataFrame, group: list[str], bucket: str, order: list[Column]) -> DataFrame:
    """Adds ``_rank`` (from 0 in each group) and ``_total`` (the group's rows).

    A group is cut into buckets whose order is the order of their rows; rows
    are ranked inside their bucket and shifted by the bucket's offset. No
    group, however hot, meets in one task.
    """
    offsets = group_offsets(rows, group, bucket)
    keys = [*group, bucket]
    right = offsets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_before", "_total")
    same = [rows[k].eqNullSafe(right[f"_k{i}"]) for i, k in enumerate(keys)]
    joined = rows.join(right, same, "inner").drop(*[f"_k{i}" for i in range(len(keys))])
    inside = W.partitionBy(*keys).orderBy(*order)
    return (joined.withColumn("_rank", F.row_number().over(inside) - 1 + F.col("_before"))
            .drop("_before"))


def fraction_key(text: Column) -> Column:
    """A seeded order key: 32 hex digits, uniform, the same in any SQL engine."""
    return F.md5(text)


def slices(batches, column: str, most: int = 8 << 20):
    """Arrow batches cut so that ``column`` holds about ``most`` bytes in each.

    Long texts then never meet by the thousand in one worker's memory.
    """
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 16
        yield batch.slice(start)


def tidy(run, *forget):
    """``run`` for mapInArrow; when a task ends, its worker, which later tasks use
    again, calls ``forget`` (functions of a module) and gives back its memory."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            for empty in forget:
                empty()
            give_back()
    return whole


def give_back() -> None:
    """Free memory that Arrow and the C library keep for later goes back to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: it keeps what it keeps


def discard(*frames: DataFrame) -> None:
    """Deletes tables that ``stored`` wrote and nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
