import random

from editstream.llm import op7_repeats as op


def brute(texts, length=op.LENGTH):
    """Spans of each text; texts in the order of their documents."""
    seen, out = set(), []
    for t in texts:
        cover = bytearray(len(t) + 1)
        for s in range(len(t) - length + 1):
            x = t[s:s + length]
            if x in seen:
                cover[s:s + length] = b"\1" * length
            seen.add(x)
        spans, i = [], 0
        while i < len(t):
            if cover[i]:
                j = cover.index(0, i)
                spans.append((i, j))
                i = j
            i += 1
        out.append(spans)
    return out


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line, base = prose(30), prose(120)
    texts = ["", "short", "a" * 350, "ab" * 200, base, base, base[:300] + "X" + base[301:], prose(90)]
    for _ in range(40):
        kind = rng.randint(0, 4)
        if kind == 0:
            texts.append(prose(20) + line + prose(25) + line)
        elif kind == 1:
            cut = rng.randint(0, 400)
            texts.append(base[cut:cut + rng.randint(90, 300)] + prose(4) + base[:150])
        elif kind == 2:
            t = list(base)
            for _ in range(rng.randint(1, 4)):
                t[rng.randrange(len(t))] = rng.choice("xyz")
            texts.append("".join(t))
        elif kind == 3:
            texts.append(prose(10) * rng.randint(2, 9) + "é" * rng.randint(0, 160))
        else:
            texts.append(rng.choice(texts))
    return texts


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc bigint, text string").selectExpr("doc", "cast(text as binary) as text")
    return {r.doc: op._joined(r.spans) for r in op.repeated(df).collect()}


def test_brute_force(spark):
    for seed in (1, 2):
        texts = corpus(random.Random(seed))
        got = run(spark, [*enumerate(texts)])
        want = brute([t.encode() for t in texts])
        assert [got.get(i, []) for i in range(len(texts))] == want


def test_pieces_of_long_texts(spark):
    # Workers have their own modules: sizes are shown by real lengths instead.
    rng = random.Random(7)
    part = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    long = "".join(rng.choice("abcdefgh ") for _ in range((1 << 20) + 700))
    texts = [long, part + long[(1 << 20) - 1500:], long[:400] + part]
    got = run(spark, [*enumerate(texts)])
    assert got == {i: s for i, s in enumerate(brute([t.encode() for t in texts])) if s}


def test_removed_text_ids_and_columns(spark):
    rng = random.Random(3)
    a, b = ("".join(rng.choice(x) for _ in range(200)) for x in ("abcdefgh", "éäöü"))
    rows = [(2, a, "s", 1), (1, a, "s", 1), (1, a, "s", 1), (None, a, None, 1), (3, None, "s", 0), (4, "", "s", 0),
            (5, "á" + b, "s", 1), (6, "ö" + b, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc string, n_chars long")
    out = op.removed(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.text, r.n_chars) for r in out.collect() if r.text is not None)
    # The lead byte of a and o with marks is the same, but neither character is gone whole.
    assert [g[1] for g in got] == [a, a, "", "", "á" + b, "ö", ""]
    assert [g for g in got if g[0] == (True, 0)][0][1:] == ("", 0)
    assert all(n == len(t) for _, t, n in got)
    assert op.removed(df.limit(0)).count() == 0


def test_runs_shrink_to_whole_characters():
    raw = "aéb".encode()
    assert op.whole_characters(raw, [(0, 2)]) == [(0, 1)] and op.whole_characters(raw, [(2, 4)]) == [(3, 4)]
    assert op.whole_characters(raw, [(1, 2)]) == [] and op.whole_characters(raw, [(0, 4)]) == [(0, 4)]


def test_runs_of_a_column_are_joined_like_lists():
    import pyarrow as pa

    rng, rows = random.Random(5), [None, [], [(0, 100), (100, 220), (150, 180), (221, 300)]]
    for _ in range(300):
        starts = sorted(rng.randrange(4000) for _ in range(rng.randrange(12)))
        rows.append([(s, s + rng.randrange(100, 240)) for s in starts] if rng.random() < 0.9 else None)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    column = pa.array([r if r is None else [{"start": a, "end": b} for a, b in r] for r in rows], kind)
    for lo, hi in ((0, len(rows)), (3, 90), (0, 2), (7, 7)):
        want = [op._joined([{"start": a, "end": b} for a, b in r or ()]) for r in rows[lo:hi]]
        assert op._joined_rows(column.slice(lo, hi - lo)) == want


def test_factors_cost_no_object_each():
    import tracemalloc

    most = op.PIECE
    tracemalloc.start()
    got = op._factors(3, most)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[:3].tolist() == [1, 3, 3] and len(got) == most and peak < 8 * most + 4096
