import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from editstream.llm.op4_packing import WordTable, best_two_fit, pack, packed

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "Hello, WORLD's  don't''s !!'s ...", "ÀÉÎ ß µm ª2²½ 12a3", "x y­z", "été Σίσυφος ΣΑΣ", "a<|endoftext|>b",
         "東京 🙂", "İstanbul", "w" * 300, "a_b-c\t\n\r\x0bd", "\x1f|\x85", "l'été, «où»", "one " * 5000, "<| x |>", "'ll'LL'"]


def test_ids_are_the_librarys():
    lib = Tokenizer.from_file(PATH)
    t = WordTable(PATH, most=4)
    for part in (TEXTS[:4], TEXTS):
        for text, got in zip(part, t.encode(part)):
            assert np.frombuffer(got, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


def bins(plan):
    out = defaultdict(list)
    for x, a, b, first, offset in plan:
        for r in range(a, b):
            out[first + r - a].append((offset, x))
    return out


def test_plan_places_all_and_packs_tightly():
    rng = random.Random(1)
    for trial in range(40):
        cap = rng.choice([10, 50, 300])
        lengths = [rng.randint(1, cap) for _ in range(rng.randint(1, 400))]
        out = bins(best_two_fit(Counter(lengths), cap))
        assert Counter(x for b in out.values() for _, x in b) == Counter(lengths)
        for b in out.values():
            at = 0
            for offset, x in sorted(b):
                assert offset == at
                at += x
            assert at <= cap
        assert len(out) <= -(-sum(lengths) // cap) * 1.5 + 1
        assert sorted(out) == list(range(len(out)))


def test_two_replace_the_smallest():
    # 6+3 leaves 1; the two 2s fill the room of 4 that the 3 leaves.
    out = bins(best_two_fit({6: 1, 3: 1, 2: 2}, 10))
    assert sorted(sorted(x for _, x in b) for b in out.values()) == [[2, 2, 6], [3]]


def test_same_length_needs_two():
    out = bins(best_two_fit({6: 1, 3: 1, 2: 1}, 10))
    assert sorted(sorted(x for _, x in b) for b in out.values()) == [[2], [3, 6]]


def test_frame(spark):
    lib = Tokenizer.from_file(PATH)
    rows = [(i % 40, TEXTS[i % len(TEXTS)], "x") for i in range(60)] + [(None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    out = packed(df, PATH, 512).collect()
    want = Counter()
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), 512):
            part = ids[p:p + 512]
            want[i, p // 512, p, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    seqs = defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 512
    assert packed(df.limit(0), PATH).count() == 0


def test_hot_length(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "cast(if(id % 3 = 0, 7, id % 50 + 1) as long) as length")
    out = pack(df, 64).collect()
    total = Counter()
    for r in out:
        total[r.sequence_id] += r.length
    assert len(out) == 5000 and max(total.values()) <= 64
    assert len(total) <= -(-sum(r.length for r in out) // 64) * 1.02


def test_one_null_id_of_one_length_in_a_third_of_the_rows(spark, tmp_path):
    from test_op10_sharding import largest_task

    df = spark.range(12_000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "0 as piece", "cast(if(id % 3 = 0, 7, id % 50 + 1) as long) as length")
    df.write.parquet(f"{tmp_path}/rows")
    out = largest_task(spark, lambda: pack(spark.read.parquet(f"{tmp_path}/rows"), 64).collect())
    total = Counter()
    for r in out:
        total[r.sequence_id] += r.length
    assert len(out) == 12_000 and max(total.values()) <= 64
    assert len({(r.sequence_id, r.offset) for r in out}) == 12_000
