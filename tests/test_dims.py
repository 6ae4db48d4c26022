"""Dimension load check (S3, A13): 88 rows, unique wiki and language, shared-file reads."""

from pyspark.sql import functions as F

from editstream.plans.check import compare
from editstream.sources import dims
from editstream.session import scratch_dir


def test_bundled_dimension(spark):
    d = dims.language_dim(spark)
    assert d.count() == 88 == dims.bundled_dim_rows()
    assert d.select("wiki").distinct().count() == 88
    assert d.select("language").distinct().count() == 88
    counts = {r.continent: r["count"] for r in d.groupBy("continent").count().collect()}
    assert counts == {"Asia": 33, "Europe": 29, "Multiple": 18, "Africa": 7, "South America": 1}
    assert d.where(F.col("language").startswith("(")).count() == 10


def test_dimension_from_shared_files(spark):
    bundled = dims.language_dim(spark)
    root = scratch_dir(spark, "dim")
    bundled.coalesce(1).write.json(f"{root}/json")
    bundled.coalesce(1).write.option("header", "true").csv(f"{root}/csv")
    for fmt in ("json", "csv"):
        got = dims.language_dim(spark, f"{root}/{fmt}", fmt=fmt)
        assert got.columns == bundled.columns
        assert compare(got.toPandas(), bundled.toPandas())["ok"]


def test_checked_broadcast_withholds_hint_above_bound(spark):
    d = dims.language_dim(spark)
    assert "ResolvedHint (strategy=broadcast)" in dims.checked_broadcast(d, max_bytes=20_000)._jdf.queryExecution().analyzed().toString()
    assert dims.checked_broadcast(d, max_bytes=1_000) is None
    assert dims.checked_broadcast(d, max_bytes=0, known_rows=88) is not None      # the bundled one needs no pass
    assert dims.checked_broadcast(d, max_bytes=0, known_rows=10_000) is None      # a count is no size
    long = d.withColumn("region", F.repeat(F.lit("x"), 1_000_000))
    assert dims.fits_broadcast(d) and not dims.fits_broadcast(long)               # few rows, many bytes
    assert dims.fits_broadcast(d.limit(0), 0)


def _hot_edits(spark):
    return spark.range(6000).selectExpr("IF(id % 3 = 0, 'enwiki', concat('w', id % 50)) AS wiki", "id", "id AS ingestion_ts",
                                        "'t' AS title", "'edit' AS type", "'u' AS user", "false AS bot", "id AS length_delta")


def test_past_the_bound_a_hot_wiki_is_split(spark, monkeypatch):
    from editstream.operators.enrich import SALTS, enrich

    edits, dim = _hot_edits(spark), dims.language_dim(spark)
    near = enrich(edits, dim)
    monkeypatch.setattr(dims, "MAX_BROADCAST_BYTES", 0)
    far = enrich(edits, dim)
    plan = far._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "strategy=broadcast" not in plan
    assert compare(far.toPandas(), near.toPandas())["ok"]
    dealt = edits.filter("wiki = 'enwiki'").groupBy(F.pmod(F.xxhash64(*edits.columns), F.lit(SALTS))).count().collect()
    assert len(dealt) == SALTS and max(r["count"] for r in dealt) < 2 * 2000 / SALTS


def test_a_stream_past_the_bound(spark, monkeypatch):
    from editstream.operators.enrich import enrich

    monkeypatch.setattr(dims, "MAX_BROADCAST_BYTES", 0)
    folder, edits = scratch_dir(spark, "salted"), _hot_edits(spark)
    edits.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(edits.schema).parquet(f"{folder}/in")
    q = (enrich(stream, dims.language_dim(spark)).writeStream.format("parquet").option("path", f"{folder}/out")
         .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    assert compare(spark.read.parquet(f"{folder}/out").toPandas(), enrich(edits, dims.language_dim(spark)).toPandas())["ok"]
