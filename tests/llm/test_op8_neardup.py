import math
import random

from editstream.llm import op8_neardup
from editstream.llm.components import components
from editstream.llm.op8_neardup import near_duplicates


def brute(rows):
    def ok(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    n = len(rows)
    links = {i: [j for j in range(n) if i != j and ok(rows[i][1]) and ok(rows[j][1]) and len(rows[i][1]) == len(rows[j][1])
                 and cosine(rows[i][1], rows[j][1]) >= 0.9] for i in range(n)}
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min(rows[j][0] for j in seen)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, rep string")
    return sorted(tuple(r) for r in near_duplicates(df).collect())


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op8_neardup, "BLOCK", 16)
    monkeypatch.setattr(op8_neardup, "PART", 5)
    monkeypatch.setattr(op8_neardup, "FAN", 2)
    rng = random.Random(5)
    centers = [[rng.gauss(0, 1) for _ in range(10)] for _ in range(9)]
    rows = []
    for i in range(260):
        c = centers[i % 3 if i % 2 else i % 9]
        s = rng.choice([0.0, 0.1, 0.25, 0.4])
        rows.append((i * 7 % 1000, [x + rng.gauss(0, s) for x in c]))
    rows += [(2000, None), (2001, []), (2002, [0.0] * 10), (2003, [float("nan")] * 10), (2004, [None] * 10),
             (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (2007, [1e-200, 2e-200]), (2008, [1e200, 2e200])]
    rows += [(3000 + i, centers[0]) for i in range(50)] + [(3000, centers[0])]
    got = run(spark, rows)
    want = brute([(i, v if i not in (2007, 2008) else [1.0, 2.0]) for i, v in rows])
    assert got == want


def test_exact_edge_and_groups_of_one_block(spark, monkeypatch):
    monkeypatch.setattr(op8_neardup, "BLOCK_BYTES", 8 * 4 * 2)
    monkeypatch.setattr(op8_neardup, "GROUP_BYTES", 1)
    rows = [(i, [1.0, 0.0, 0.0, i * 1e-3]) for i in range(9)] + [(20, [9.0, 3.0, 3.0, 1.0]), (21, [9.0, 3.0, 3.0, 1.001])]
    assert run(spark, rows) == brute(rows)
    exact = run(spark, [(1, [1.0, 0.0, 0.0, 0.0]), (2, [9.0, 3.0, 3.0, 1.0]), (3, [8.999999, 3.0, 3.0, 1.0])])
    assert exact == [(1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False)]  # 0.9 itself links


def cells(spark, rows, monkeypatch):
    """(blocks, groups, blocks sent) of a run."""
    seen = {}
    real = op8_neardup._cells

    def spy(blocks, eps, n):
        seen["blocks"] = blocks.count()
        out = seen["sent"] = op8_neardup.stored(real(blocks, eps, n), "sent")
        return out

    monkeypatch.setattr(op8_neardup, "_cells", spy)
    out = run(spark, rows)
    sent = seen["sent"]
    groups = sent.select("a").union(sent.select("b")).distinct().count()
    return out, seen["blocks"], groups, sent.count()


def test_distant_blocks_are_skipped_and_none_is_sent_once_a_pair(spark, monkeypatch):
    monkeypatch.setattr(op8_neardup, "BLOCK", 16)
    monkeypatch.setattr(op8_neardup, "GROUP_BYTES", 2 * 16 * 24 * 8)
    rng = random.Random(9)
    bent = []  # a curve through 24 dimensions: the leading directions hold its spread
    for i in range(500):
        t = rng.random() * 6.28
        bent.append((i, [math.cos(t), math.sin(t), *(rng.gauss(0, 0.01) for _ in range(22))]))
    out, blocks, groups, sent = cells(spark, bent, monkeypatch)
    assert sent < 0.5 * blocks * groups
    assert out == brute(bent)
    monkeypatch.undo()
    monkeypatch.setattr(op8_neardup, "BLOCK", 16)
    even = [(i, [rng.gauss(0, 1) for _ in range(24)]) for i in range(500)]
    out, blocks, groups, sent = cells(spark, even, monkeypatch)
    assert sent <= blocks * (groups + 1) < blocks * (blocks + 1) / 3
    assert out == brute(even)


def test_empty_and_chain(spark):
    assert run(spark, []) == []
    turn = math.acos(0.95)
    rows = [(i, [math.cos(i * turn), math.sin(i * turn)]) for i in range(12)]
    assert {r[2] for r in run(spark, rows)} == {0}


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (5, 5)] + [(1000, i) for i in range(500, 600)]
    out = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {out[i] for i in range(100, 141)} == {100} and out[9] == out[7] == 3 and 5 not in out
    assert out[1000] == 500 and out[599] == 500
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
