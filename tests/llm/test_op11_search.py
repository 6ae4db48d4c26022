import math
import random
import re
from collections import Counter

from editstream.llm import op11_search
from editstream.llm.op11_search import PART, TERM, ranked_documents, term_counts

DOCS = "doc_id long, text string, score string, rank int"
ITEMS = "item_id long, text string, doc_id string"


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(TERM, lowered)


def brute(docs, items, best=10):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t, *_ in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in counted), sum(n for *_, n in counted)
    asked = {}
    for i, t, *_ in items:
        asked.setdefault(i, set()).update(terms(t))
    out = set()
    for item, wanted in asked.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c, _ in counted) + 1))) for t in wanted}
        found = []
        for doc, c, n in counted:
            if n:
                m = 10 + 90 * n * n_docs // n_terms
                s = sum(weight[t] * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t])
                if s > 0:
                    found.append((-s, doc is None, doc))
        out |= {(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: x[:2] + ((x[2] or 0),))[:best])}
    return out


def run(spark, docs, items, best=10):
    got = ranked_documents(spark.createDataFrame([(*d, "x", 1) for d in docs], DOCS),
                           spark.createDataFrame([(*i, "x") for i in items], ITEMS), best).collect()
    rows = {(r.item_id, r["rank"], r.doc_id, r.score) for r in got}
    assert len(rows) == len(got)
    return rows


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["Ab", "ab", "été", "Été", "x1", "x-1", "the", "The", "東京", "a_b", "it's", "\u00a0", "q"] + [f"w{i}" for i in range(30)]
    docs = [(i, rng.choice([" ", "\n", ". "]).join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(15)]                    # copies tie
    docs += [(5, docs[5][1]), (5, "the the ab"), (None, docs[3][1]), (None, None), (n + 20, None), (n + 21, ""), (n + 22, " .,- "),
             (n + 23, "the " * 3000 + "w7")]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 9)))) for i in range(12)]
    items += [(3, "w1 w2"), (None, "ab the"), (50, None), (51, "..."), (52, "nowhere"), (53, docs[3][1])]
    return docs, items


def test_brute_force(spark):
    docs, items = corpus(1, 150)
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, 2) == brute(docs, items, 2)


def test_items_in_blocks_and_small_bounds(spark, monkeypatch):
    docs, items = corpus(2, 60)
    monkeypatch.setattr(op11_search, "BLOCK_ITEMS", 4)
    assert len(op11_search._blocks(op11_search.item_terms(spark.createDataFrame([(*i, "x") for i in items], ITEMS)))) > 2
    assert run(spark, docs, items) == brute(docs, items)


def test_parts_of_a_long_text(monkeypatch):
    text = ("Été the-x 東京 " * 200).encode()
    whole = term_counts(text)
    assert PART > len(text) and whole[0] == 800 and whole[1]["東京".encode()] == 200
    for part in (1, 2, 7, 64):
        monkeypatch.setattr(op11_search, "PART", part)
        assert term_counts(text) == whole


def test_heaps_keep_the_best():
    import numpy as np

    rng = np.random.default_rng(4)
    scores = rng.integers(0, 6, (500, 3))
    heaps = op11_search.Heaps(3, 10)
    for at in range(0, 500, 60):
        heaps.update(scores[at:at + 60], [None if i == 7 else i for i in range(at, min(at + 60, 500))])
    for i in range(3):
        want = sorted(((-int(s), d == 7, d) for d, s in enumerate(scores[:, i]) if s > 0))[:10]
        assert sorted(heaps.of[i], reverse=True) == [(-s, heaps.NULL if null else -d) for s, null, d in want]


def test_empty_tables(spark):
    docs, items = corpus(3, 5)
    assert run(spark, [], items) == set() and run(spark, docs, []) == set()
    assert run(spark, [(1, None), (2, "..")], items) == set()
