from collections import Counter

from pyspark.sql import functions as F

from editstream.llm.op10_sharding import interleave, op10_stratified_interleave


def place(spark, rows, shards=4):
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, shard_note string")
    return [r.asDict() for r in interleave(df, shards).collect()]


def test_counts_mixture_and_slots(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", i, "x") for i in range(1001)]
    out = place(spark, rows)
    per = Counter(r["shard"] for r in out)
    assert sorted(r["doc_id"] for r in out) == list(range(1001))
    assert max(per.values()) - min(per.values()) <= 1 and set(per) == set(range(4))
    for s in per:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(per[s]))
    hot = Counter(r["shard"] for r in out if r["source"] == "hot")
    assert max(hot.values()) - min(hot.values()) <= 3


def test_nulls_repeats_and_few_rows(spark):
    rows = [(None, None, 8, None), (1, "a", 8, None), (1, "a", 8, None)]
    out = place(spark, rows)
    assert len(out) == 3 and all(r["slot"] == 0 for r in out)
    assert sorted(r["shard"] for r in out) == [0, 1, 2]


def test_empty(spark):
    assert place(spark, []) == []


def test_same_rows_any_partitioning(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 5).cast("string").alias("source"))
    a = {tuple(r) for r in interleave(df.repartition(1)).collect()}
    b = {tuple(r) for r in interleave(df.repartition(7)).collect()}
    assert a == b


def largest_task(spark, run):
    """Rows of the largest and of the mean file of each table that ``numbered`` wrote in ``run``."""
    import glob

    import pyarrow.parquet as pq

    from editstream.session import checkpoint_root

    folder = f"{checkpoint_root(spark)}/editstream".removeprefix("file:")
    before = set(glob.glob(f"{folder}/numbered-*"))
    out = run()
    for table in sorted(set(glob.glob(f"{folder}/numbered-*")) - before):
        rows = [pq.read_metadata(f).num_rows for f in glob.glob(f"{table}/*.parquet")]
        assert max(rows) <= 3 * sum(rows) / len(rows) and len(rows) > 2, rows
    return out


def test_one_null_id_in_a_third_of_the_rows(spark):
    df = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, null, id) as doc_id", "if(id % 2 = 0, 'hot', 'cold') as source", "id as size", "7L as shard", "8L as slot")
    out = largest_task(spark, lambda: interleave(df, 24).collect())
    per = Counter(r["shard"] for r in out)
    assert set(per.values()) == {1250} and set(per) == set(range(24))
    assert Counter(r["doc_id"] is None for r in out)[True] == 10_000
    same = spark.range(12_000).selectExpr("if(id % 3 = 0, id, null) as doc_id", "'s' as source", "1L as size")
    out = largest_task(spark, lambda: interleave(same, 24).collect())
    assert set(Counter(r["shard"] for r in out).values()) == {500}


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, "a", "é" * 50_000, 9), (None, None, None, 9), (2, "a", "", 9), (2, "a", "", 9), (2, "a", "x", 9)]
    spark.createDataFrame(rows, "doc_id long, source string, text string, shard int").write.parquet(f"{tmp_path}/documents.parquet")
    out = op10_stratified_interleave(spark, str(tmp_path)).collect()
    assert sorted(r.size for r in out) == [8, 8, 8, 9, 100_008] and {r.law for r in out} == {"rows"}
    assert [r.text_crc32 for r in out if r.doc_id is None] == [0]
    assert sorted(r.shard for r in out) == [0, 1, 2, 3, 4] and {r.slot for r in out} == {0}
