import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from editstream.llm import op12_runs
from editstream.llm.op12_runs import Positions, document_runs, least_lcp, periodic_runs, planted, suffix_order


def brute(x, length=24, exponent=3):
    """Every period tried at every place; the smallest one of a stretch counts."""
    out = {}
    for q in range(1, len(x) // exponent + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            if i + q - s >= max(length, exponent * q):
                out.setdefault((s, i + q - s), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 15), st.integers(0, 70), st.sampled_from([(24, 3), (6, 3), (12, 4)]))
def test_runs_equal_brute_force(head, period, tail, limits):
    x = head + [(head[-period:] or [7])[i % len(head[-period:] or [7])] for i in range(tail)]
    assert periodic_runs(np.array(x, np.int64), *limits) == brute(x, *limits)


def test_suffix_order():
    rng = random.Random(5)
    for n in (1, 2, 3, 50):
        x = [rng.randrange(2) for _ in range(n)]
        order, lcp = suffix_order(np.array(x))
        want = sorted(range(n), key=lambda i: x[i:])
        assert order.tolist() == want
        for a, b, agree in zip(want, want[1:], lcp.tolist()):
            assert x[a:a + agree] == x[b:b + agree] and x[a + agree:a + agree + 1] != x[b + agree:b + agree + 1]


def test_positions_in_chunks(monkeypatch):
    monkeypatch.setattr(op12_runs, "CHUNK", 2)
    places = random.Random(6).sample(range(1000), 300)
    held = Positions(places[0])
    for k, p in enumerate(places[1:], 1):
        before, behind = held.around(p)
        some = places[:k]
        assert before == max((x for x in some if x < p), default=None) and behind == min((x for x in some if x > p), default=None)
        held.add(p)
    assert list(held) == sorted(places) and held.n == 300


def test_least_lcp():
    assert least_lcp(24, 3) == 16 and least_lcp(24, 3) == min(max(24, 3 * q) - q for q in range(1, 100))


def want(doc_id, text):
    words = text.replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").replace("\t", " ").replace("\n", " ").split(" ") if text else []
    words = [w for w in words if w]
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_frame_equals_brute_force(spark):
    rng = random.Random(7)
    docs = [(i, rng.choice([" ", "\n", "  \t"]).join(rng.choices(["a", "b", "été", "x\u00a0y", "東京"] + [f"w{k}" for k in range(40)],
                                                                 k=rng.randint(0, 120)))) for i in range(150)]
    docs += [(i, "la " * rng.randint(20, 40) + "x y z " * 9 + "end") for i in range(200, 230)]
    docs += [(None, docs[0][1]), (7, docs[7][1]), (7, "q " * 30), (300, None), (301, ""), (302, " \r\n\x0b\x0c\t"), (303, "o " * 5000), (-20, docs[3][1]),
             (304, " ".join(f"v{k}" for k in range(4000)))]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, start string, n_runs int")
    got = [tuple(r) for r in document_runs(df, planted).collect()]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=key) == sorted((want(*d) for d in docs), key=key)
    assert sum(r[1] > 0 for r in got) > 35
    assert document_runs(df.limit(0)).count() == 0
    plain = {r.doc_id: r for r in document_runs(df.filter("doc_id = 303")).collect()}[303]
    assert (plain.n_runs, plain.start, plain.length, plain.period, plain.exponent_milli) == (1, 0, 5000, 1, 5_000_000)
    assert plain.collapsed_sha256 == hashlib.sha256(b"o").hexdigest()
