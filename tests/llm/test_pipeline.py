"""The stages against brute-force versions of what they decide."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
from test_op2_jaccard import shingles
from test_op7_repeats import brute as brute_spans
from tokenizers import Tokenizer

import corpus_pipeline
from editstream.llm import op7_repeats

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base, line = prose(150), prose(40)
    rows = []
    for i in range(160):
        if i % 8 == 1:
            text = prose(30) + " zork " + prose(10) + " murx"
        elif i % 8 == 2:
            w = base.split()
            w[rng.randrange(len(w))] = word()
            text = " ".join(w)
        elif i % 8 == 3:
            text = prose(20) + " " + line + " " + prose(20)
        elif i % 8 == 4:
            text = prose(25) + f" ann.{'abcdefgh'[i % 7]}{i}@mail.example.com " + prose(5)
        else:
            text = prose(rng.randint(1, 80))
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    return rows + [(200, None, None, None, None), (201, "", "en", "s", 0), (202, rows[0][1], "en", "s", len(rows[0][1]))]


def near_duplicates(rows):
    gone, sets = set(), [(i, shingles(t)) for i, t, *_ in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 5 * len(x & y) >= 4 * len(x | y):
                a_, b_ = sorted((find(i), find(j)))
                parent[b_] = a_
    gone = {i for i in parent if find(i) != i}
    return [r for r in rows if r[0] not in gone]


def test_stages(spark, tmp_path):
    rows = corpus(random.Random(17))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int("zork" in t)) for i, t, *_ in rows[:150]],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    expect = list(rows)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        got = {r.doc_id: r for r in out.collect()} if name != "packing" else out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        if name == "toxicity":
            expect = [r for r in expect if "zork" not in (r[1] or "")]
        elif name == "near_duplicates":
            expect = near_duplicates(expect)
            assert 202 not in got and 2 in got and 10 not in got
        elif name == "repeated_strings":
            expect.sort()
            spans = brute_spans([(r[1] or "").encode() for r in expect])
            keep = lambda t, s: t and op7_repeats._kept(t.encode(), s).decode()
            expect = [(r[0], keep(r[1], s), *r[2:4], None if r[1] is None else len(keep(r[1], s)))
                      for r, s in zip(expect, spans)]
            assert any(spans)
        elif name == "personal_data":
            before = {r[0]: r[1] for r in expect}
            for i, r in got.items():
                was = before[i]
                if was and "@" in was:
                    assert r.text != was and re.sub(r"\S+@\S+", "", r.text) == re.sub(r"\S+@\S+", "", was)
                else:
                    assert r.text == was
            assert len({re.search(r"\S+@\S+", r.text)[0] for r in got.values() if r.text and "@" in r.text}) == \
                sum("@" in (t or "") for t in before.values())
            expect = [(i, got[i].text, *r) for i, _, *r in expect]
        else:
            lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            lengths = {r[0]: len(lib.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in expect}
            assert Counter({r.doc_id: r.length for r in got}) == Counter(lengths)
            filled = Counter()
            for r in got:
                filled[r.sequence_id] += r.length
            assert max(filled.values()) <= 2048 and len(filled) <= -(-np.sum([*lengths.values()]) // 2048) + 1
            return
        assert sorted(got) == sorted(r[0] for r in expect)
        for i, text, *_, n in expect:
            assert got[i].text == text and got[i].n_chars == n
        docs = out


def test_one_row_of_each_class_stays(spark):
    """Null ids, repeated rows and different texts of one id."""
    rng = random.Random(3)
    prose = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))
    a, b, c, d, e = (prose() for _ in range(5))
    rows = [(1, a), (None, a), (None, a + " x"), (1, a), (None, b), (None, b), (2, c), (2, d), (3, d), (2, c), (5, e), (4, e),
            (None, None), (None, None), (6, ""), (6, "")]
    docs = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string")
    out = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), "")
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(
        [(1, a), (None, b), (2, c), (2, d), (4, e), (None, None), (None, None), (6, ""), (6, "")])
