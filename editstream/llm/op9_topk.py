"""Exact top-k by distributed histogram selection.

Vectors become integers ``floor(256 x)``; a query's score with a candidate is
their inner product, exact in doubles, or in integers for blocks whose norms
pass their bound (long vectors have blocks of their own). Query blocks and candidate blocks meet
on a grid whose cells are dealt out by a shuffle: with p cells, either side is
copied to about sqrt(p) of them. Each pass scores everything again and counts
scores by bin of the query's current interval; counts summed over the grid say
which bin holds the k-th value, which becomes the next interval, until it is a
single integer. The last pass returns the fewer than k scores above it and, of
those equal to it, the k smallest ids of each block; a window over these few
rows breaks ties.

A block leaves out the bins below its own k-th score: they cannot hold the
k-th value of all. Nothing is sampled, and no score list is kept.

Defined cases: vectors that are null or hold null or non-finite components
take no part, nor do null ids; a score that no 64-bit integer holds is an
error, as in SQL; vectors of different dimension do not meet; rows with the
query's id are not its candidates; repeated rows are candidates each, and one
query; different vectors of one id rank their candidates together; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import read_table, stored
from .vectors import matrices, usable

SCALE = 256
BINS = 1024
BLOCK, QUERY_BLOCK = 4096, 1024
SHORT = float(1 << 26)  # products of norms below this are exact in doubles
MOST = (1 << 63) - 2

BLOCKS = "dim int, number long, ids binary, m binary"
QUERY_BLOCKS = BLOCKS + ", low binary, high binary, above binary"


def _blocks(rows: DataFrame, most: int, state: bool) -> DataFrame:
    """Rows (vec_id, v[, low, high, above]) as blocks of one dimension."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", *(("low", "high", "above") if state else ()))}
            out = []
            for part, m in matrices(batch, "v", most):
                out.append({"dim": m.shape[1], "number": number, "m": m.tobytes()} | {
                    "ids" if c == "vec_id" else c: x[part].astype(np.int64).tobytes() for c, x in columns.items()})
                number += 1
            kinds = [("dim", pa.int32()), ("number", pa.int64()), ("ids", pa.binary()), ("m", pa.binary())]
            kinds += [(c, pa.binary()) for c in ("low", "high", "above")] if state else []
            yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    return rows.mapInArrow(run, QUERY_BLOCKS if state else BLOCKS)


def _grid(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """Each query block beside each candidate block of its dimension."""
    cells = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, round(math.sqrt(cells * QUERY_BLOCK / BLOCK / 50)))
    down = -(-cells // across)
    row = F.pmod(F.xxhash64("number"), F.lit(down)).cast("int")
    column = F.pmod(F.xxhash64("number"), F.lit(across)).cast("int")
    left = candidates.select("dim", "ids", "m", row.alias("_r"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("_c"))
    right = queries.select("dim", F.col("ids").alias("q_ids"), F.col("m").alias("q_m"), "low", "high", "above",
                           F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("_r"), column.alias("_c"))
    return left.repartition(cells, "dim", "_r", "_c").join(
        right.repartition(cells, "dim", "_r", "_c"), ["dim", "_r", "_c"])


def inner_products(a, b):
    """Exact inner products of rows of integers in doubles, as int64."""
    import numpy as np

    x, y = (np.sqrt(np.einsum("ij,ij->i", m, m)) for m in (a, b))
    with np.errstate(all="ignore"):
        scores = a @ b.T
        if x.max(initial=0) * y.max(initial=0) < 2.0 ** 53:
            return scores.astype(np.int64)
        # Integer sums are exact modulo 2^64, hence where the sum surely fits; the others are summed without bound.
        unsure = ~(np.abs(scores) + (a.shape[1] + 1) * 2.0 ** -51 * np.multiply.outer(x, y) < 2.0 ** 62)
        wide = [np.abs(m).max(1, initial=0) >= 2.0 ** 62 for m in (a, b)]
        unsure |= wide[0][:, None] | wide[1][None, :]
        whole = [np.where(w[:, None], 0, m).astype(np.int64) for w, m in zip(wide, (a, b))]
        out = whole[0] @ whole[1].T
    for i, j in np.argwhere(unsure):
        score = sum(int(p) * int(q) for p, q in zip(a[i], b[j]))
        if abs(score) > MOST:
            raise OverflowError(f"a score is beyond a 64-bit integer: {score}")
        out[i, j] = score
    return out


def _scored(batches):
    """(q_ids, ids, scores, low, high, above) of each pair of blocks; own rows score below all."""
    import numpy as np

    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda c, t: np.frombuffer(batch.column(c)[i].as_py(), t)
            d = batch.column("dim")[i].as_py()
            ids, q_ids = get("ids", np.int64), get("q_ids", np.int64)
            q, m = get("q_m", np.float64).reshape(len(q_ids), d), get("m", np.float64).reshape(len(ids), d)
            own = q_ids[:, None] == ids[None, :]
            try:
                scores = inner_products(q, m)
            except OverflowError:  # maybe of own rows only
                scores = np.zeros(own.shape, np.int64)
                for x, y in np.argwhere(~own):
                    scores[x, y] = inner_products(q[x:x + 1], m[y:y + 1])[0, 0]
            scores[own] = np.iinfo(np.int64).min
            yield q_ids, ids, scores, get("low", np.int64), get("high", np.int64), get("above", np.int64)


def _histograms(k: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for q_ids, ids, scores, low, high, above in _scored(batches):
            # Differences may pass 2^63: unsigned.
            width = (high.view(np.uint64) - low.view(np.uint64) + np.uint64(BINS - 1)) // np.uint64(BINS)
            inside = (scores >= low[:, None]) & (scores < high[:, None])
            bins = np.where(inside, (scores.view(np.uint64) - low.view(np.uint64)[:, None]) // width[:, None], np.uint64(BINS)).astype(np.int64)
            counts = np.bincount((np.arange(len(q_ids))[:, None] * (BINS + 1) + bins).ravel(),
                                 minlength=len(q_ids) * (BINS + 1)).reshape(len(q_ids), BINS + 1)[:, :BINS]
            higher = np.cumsum(counts[:, ::-1], 1)[:, ::-1] - counts
            q, b = np.nonzero((counts > 0) & (higher < k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[q]), pa.array(b.astype(np.int32)), pa.array(counts[q, b].astype(np.int64))],
                names=["query_id", "bin", "n"])
    return run


def _best(k: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for q_ids, ids, scores, low, high, above in _scored(batches):
            order = np.argsort(ids, kind="stable")
            ids, scores = ids[order], scores[:, order]
            equal = scores == low[:, None]
            keep = (scores > low[:, None]) | (equal & (np.cumsum(equal, 1) <= k))
            q, v = np.nonzero(keep)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[q]), pa.array(ids[v]), pa.array(scores[q, v])], names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query, k: int) -> DataFrame:
    """vectors: vec_id, embedding -> query_id, rank, vec_id, score."""
    scaled = lambda x: x.cast("double") * SCALE
    # From 2^52 on a double is an integer.
    v = F.transform("embedding", lambda x: F.when(F.abs(scaled(x)) < 2.0 ** 52, F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    rows = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    rows = stored(rows.withColumn("_norm", norm), "vectors")
    longest = rows.agg(F.max("_norm")).first()[0]
    if longest is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    candidates = _blocks(rows.filter(F.col("_norm") < SHORT).select("vec_id", "v"), BLOCK, False)
    if longest >= SHORT:
        far = _blocks(rows.filter(F.col("_norm") >= SHORT).select("vec_id", "v"), BLOCK, False)
        candidates = candidates.union(far.withColumn("number", -F.col("number") - 1))
    candidates = stored(candidates, "blocks")
    bound = min(math.ceil(longest * longest * (1 + 2.0 ** -40)) + 1, MOST) if longest < SHORT * SHORT else MOST  # no score is beyond it
    queries = rows.filter(is_query).select("vec_id", "v", F.lit(-bound).cast("long").alias("low"), F.lit(bound + 1).cast("long").alias("high"),
                                           F.lit(0).cast("long").alias("above")).dropDuplicates(["vec_id", "v"])
    queries = stored(queries, "queries")
    span = 2 * bound + 1
    while span > 1:
        span = -(-span // BINS)
        pairs = _grid(candidates, _blocks(queries, QUERY_BLOCK, True))
        counts = pairs.mapInArrow(_histograms(k), "query_id long, bin int, n long").groupBy("query_id", "bin").agg(
            F.sum("n").alias("n"))
        w = W.partitionBy("query_id").orderBy(F.desc("bin"))
        at = counts.withColumn("_upto", F.sum("n").over(w)).join(
            queries.select(F.col("vec_id").alias("query_id"), "above").distinct(), "query_id")
        at = at.filter(F.col("above") + F.col("_upto") >= k).groupBy("query_id").agg(
            F.max(F.struct("bin", (F.col("_upto") - F.col("n")).alias("more"))).alias("at"))
        width = F.expr(f"CAST((CAST(high AS DECIMAL(20)) - CAST(low AS DECIMAL(20)) + {BINS - 1}) DIV {BINS} AS BIGINT)")
        low = F.col("low") + F.col("at.bin") * width
        # No bin: fewer than k candidates, so all scores are wanted.
        queries = stored(queries.join(at, F.col("vec_id") == F.col("query_id"), "left").select(
            "vec_id", "v",
            F.when(F.col("at").isNull(), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("at").isNull(), F.col("high")).otherwise(F.least(low + width, F.col("high"))).alias("high"),
            F.when(F.col("at").isNull(), F.col("above")).otherwise(F.col("above") + F.col("at.more")).alias("above")), "queries")
    found = _grid(candidates, _blocks(queries, QUERY_BLOCK, True)).mapInArrow(
        _best(k), "query_id long, vec_id long, score long")
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op9_histogram_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 best of each vector whose id is divisible by 50."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
