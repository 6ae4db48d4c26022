import random
import re

from editstream.llm import op2_jaccard
from editstream.llm.op2_jaccard import (
    candidate_links, grown, met_across, near_duplicates, packed_sets, places, prefix_length, shared_counts, shingle_sets)


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, t=0.8):
    sets = [shingles(x) for _, x in rows]
    n = len(rows)
    links = {i: [j for j in range(n) if i != j and sets[i] and sets[j]
                 and len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]) - 1e-9] for i in range(n)}
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        names = [rows[j][0] for j in seen if rows[j][0] is not None]
        c = min(names) if names else None
        out.append((rows[i][0], c, len(links[i]), rows[i][0] == c))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, name string")
    return sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))
    bases = [[word() for _ in range(rng.randint(60, 300))] for _ in range(6)]
    line = [word() for _ in range(40)]
    rows = []
    for i in range(260):
        w = list(bases[0 if i % 2 else rng.randrange(6)])
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = word()
        if i % 3 == 0:
            w = w + line
        rows.append((i, " ".join(w) if i % 5 else " ".join(w).upper() + "!"))
    rows += [(i, " ".join([word() for _ in range(50)] + line)) for i in range(300, 380)]
    rows += [(400 + i, rows[i][1]) for i in range(40)]
    return rows + [(900, None), (901, ""), (902, " .!? "), (903, "one two"), (904, "One, two."), (905, "two one"),
                   (7, rows[100][1]), (7, "quite another text with its own words"), (None, "a b c d e f"), (8, rows[8][1])]


def test_brute_force(spark):
    rows = corpus(random.Random(11))
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_shared_counts_and_prefix():
    import numpy as np
    import pyarrow as pa

    sets = shingle_sets(pa.array(["a b c d e f", None, "b c d e f g", "a b"]))
    assert [len(s) for s in sets] == [2, 0, 2, 1]
    edges = np.cumsum([0, *map(len, sets)])
    words, packed = packed_sets(sets)
    words, at = np.frombuffer(words, np.uint64), places(packed)
    assert [sorted(words[at[a:b]]) for a, b in zip(edges, edges[1:])] == [s.tolist() for s in sets]
    assert shared_counts(words, at, edges, words, at, edges).tolist() == [[2, 0, 1, 0], [0] * 4, [1, 0, 2, 0], [0, 0, 0, 1]]
    assert prefix_length(0.8) == 4 and prefix_length(0.95) > 4


def test_crowded_buckets_keep_every_pair(spark):
    """No pair of a bucket is lost behind others of its prefix, in blocks or whole."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 16, (900, 64)).astype(">u2")
    values[:600, 8:12] = 7  # one bucket of 600 in the tree that starts at value 8
    values[600:640, 20:24] = 9
    planted = [(i, 599 - i) for i in range(0, 300, 20)] + [(600, 639), (610, 625)]
    for i, j in planted:
        at = rng.permutation([x for x in range(64) if x % 4])[:44]
        values[j, at] = values[i, at]
        for t in range(0, 64, 4):  # the pair shares no other prefix
            if t != (8 if i < 600 else 20):
                values[j, t] = values[i, t] ^ 1
    low = values.view(np.uint8)[:, 1::2]
    same = np.array([[(low[i] == low[j]).sum() for j in range(900)] for i in range(900)])
    assert {(i, j) for i, j in np.argwhere(same >= 0.55 * 64) if i < j} <= set(planted)
    expect = {(i, j) for i, j in planted if same[i, j] >= 0.55 * 64}
    assert len(expect) >= 5
    df = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(values)], "rep long, signature binary")
    for most in (4096, 50):
        got = candidate_links(df.repartition(3), 0.8, most).select(F.least("a", "b"), F.greatest("a", "b")).collect()
        assert expect <= {tuple(r) for r in got} <= set(planted)


def test_forest_and_blocks_span_the_candidates():
    import numpy as np

    rng = np.random.default_rng(5)
    low = rng.integers(0, 3, (12, 64)).astype(np.uint8)[rng.integers(0, 12, 200)]
    noise = rng.random(low.shape) < 0.3
    low[noise] = rng.integers(3, 200, noise.sum())
    near = (low[:, None] == low[None]).sum(2) >= 35.2

    def roots(links):
        to = list(range(200))
        for i, j in links:
            a, b = to[i], to[j]
            to = [min(a, b) if x in (a, b) else x for x in to]
        return to

    expect = roots(np.argwhere(near))
    assert 1 < len(set(expect)) < 200
    assert roots(grown(low, 35.2)[0]) == expect
    one, two = grown(low[:90], 35.2), grown(low[90:], 35.2)
    across = met_across(low[:90], one[1], low[90:], two[1], 35.2)
    assert roots([*one[0], *(two[0] + 90), *(across + [0, 90])]) == expect
    assert len(one[0]) + len(two[0]) + len(across) == 200 - len(set(expect))


def near_copies(n, doc_id):
    words = [f"w{i}" for i in range(60)]
    return [(doc_id(i), " ".join([*words[:59], f"own{i}"])) for i in range(n)]


def test_null_ids_multiply_nothing(spark, monkeypatch):
    fetched, texts_of = [], op2_jaccard._texts_of

    def counted(placed, rows):
        out = texts_of(placed, rows)
        fetched.append(out.count())
        return out

    monkeypatch.setattr(op2_jaccard, "_texts_of", counted)
    rows = near_copies(300, lambda i: None if i % 3 else 5)
    got = run(spark, rows)
    assert fetched == [300] and len(got) == 300 and {r[1] for r in got} == {5} and {r[2] for r in got} == {299}


def test_long_texts_are_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(op2_jaccard, "BLOCK", 16)
    monkeypatch.setattr(op2_jaccard, "SHORT_TEXT", 40)
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join([*words[:20 * (1 + i % 18)], f"own{i}"])) for i in range(90)]
    rows += [(100 + i, " ".join(words) + " " + " ".join(words) + f" x{i}") for i in range(3)] + [(200, "long " * 200_000)]
    assert run(spark, rows) == brute(rows)


def test_recall_at_growing_sizes(spark):
    """Pairs at the threshold meet in a trie, however many others there are."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(11)
    multipliers = op2_jaccard._multipliers()
    draw = lambda n: rng.integers(1, 1 << 63, n, np.int64).astype(np.uint64)
    common = draw(300)
    for size in (400, 1600, 6400):
        rows, pairs = [], 300
        for i in range(pairs):
            own = np.concatenate([draw(60), rng.choice(common, 20, replace=False)])
            for k in (0, 1):  # 80 of 100 shared: 0.8
                rows.append((2 * i + k, bytearray(op2_jaccard.signature(np.unique(np.concatenate([own, draw(10)])), multipliers).tobytes())))
        for i in range(2 * pairs, size):
            other = np.unique(np.concatenate([draw(60), rng.choice(common, 40, replace=False)]))
            rows.append((i, bytearray(op2_jaccard.signature(other, multipliers).tobytes())))
        df = spark.createDataFrame(rows, "rep long, signature binary").repartition(4)
        found = {tuple(r) for r in candidate_links(df, 0.8).select(F.least("a", "b"), F.greatest("a", "b")).collect()}
        assert sum((2 * i, 2 * i + 1) in found for i in range(pairs)) >= 0.99 * pairs
