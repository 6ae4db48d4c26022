import math
import random

from pyspark.sql import functions as F

from editstream.llm import op9_topk
from editstream.llm.op9_topk import top_k

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, is_query, k):
    import numpy as np

    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in good:
        if is_query(q):
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
            out |= {(q, r + 1, i, -n) for r, (n, i) in enumerate(s[:k])}
    return out


def run(spark, rows, k=3):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return {tuple(r) for r in top_k(df, F.col("vec_id") % 5 == 0, k).collect()}


def test_brute_force_ties_and_bad_vectors(spark):
    rng = random.Random(2)
    same = [rng.uniform(-1, 1) for _ in range(6)]
    rows = [(i, same if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200, None), (205, [1.0, None] + same[2:]), (210, [float("nan")] + same[1:]), (215, [float("inf")] * 6),
             (220, [0.0] * 6), (225, [1.0, 2.0]), (230, [2.0, -1.0]), (None, same), (240, []), (245, [])]
    assert run(spark, rows) == brute(rows, lambda q: q % 5 == 0, 3)


def test_fewer_candidates_and_empty(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.25, -3.0])]
    assert run(spark, rows, 5) == brute(rows, lambda q: q % 5 == 0, 5)
    assert run(spark, rows[:1], 5) == set() and run(spark, [], 5) == set()


def test_long_vectors_take_more_passes(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-9000, 9000)) for _ in range(4)]) for i in range(60)]
    assert run(spark, rows) == brute(rows, lambda q: q % 5 == 0, 3)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(op9_topk, "BLOCK", 7)
    monkeypatch.setattr(op9_topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(op9_topk, "BINS", 16)
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for i in range(90)]
    assert run(spark, rows) == brute(rows, lambda q: q % 5 == 0, 3)


def test_long_vectors_are_scored_exactly(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(i, [rng.uniform(-1, 1) * 2.0 ** rng.choice([18, 20, 22]) for _ in range(4)]) for i in range(60, 90)]
    rows += [(90, [2.0 ** 50, 0.0, 0.0, 0.0]), (91, [0.0, 2.0 ** 60, 0.0, 0.0]), (95, [0.0, 0.0, 3.0 * 2.0 ** 22, 0.0])]
    rows = [(i, [0.0, 0.0, *v[2:]] if i < 90 else v) for i, v in rows]
    expect = brute(rows, lambda q: q % 5 == 0, 3)
    assert run(spark, rows) == expect and {60, 90, 95} <= {q for q, *_ in expect}


def test_scores_up_to_the_ends_of_64_bits():
    import numpy as np
    import pytest

    a = np.array([[2.0 ** 40 + 1, -3.0, 2.0 ** 31], [2.0 ** 70, 0, 1], [-(2.0 ** 31), 2.0 ** 31, 7]])
    b = np.array([[2.0 ** 22 - 1, 5, 2.0 ** 30 + 3], [0, 2.0 ** 20 + 1, 9], [0, 2.0 ** 31 - 1, 2.0 ** 31]])
    for i, j in [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)]:
        assert op9_topk.inner_products(a[i:i + 1], b[j:j + 1]).tolist() == [[sum(int(x) * int(y) for x, y in zip(a[i], b[j]))]]
    with pytest.raises(OverflowError):
        op9_topk.inner_products(a[1:2], b[:1])


def test_different_vectors_of_one_id_rank_together(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 2.0]), (3, [1.0, 1.5]), (5, [0.5, 0.5])]
    got = {r for r in run(spark, rows) if r[0] == 0}
    assert got == {(0, 1, 1, 3 * 65536), (0, 2, 2, 2 * 65536), (0, 3, 3, 65536 * 3 // 2)}
