import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from editstream.llm import op5_chat as chat


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a: b#\\", ""]),
                          st.text("\\#<:/turn> A\n\u00e9\U0001f642", max_size=30)), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_round_trip(turns):
    import pyarrow as pa

    out, bounds, starts, ends = chat.assemble(pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    raw = out.tobytes()
    assert [(r.decode(), t.decode()) for r, t in chat.read_back(raw)] == turns
    for i, (r, t) in enumerate(turns):
        assert chat.unescape(raw[starts[i]:ends[i]]).decode() == t
        assert raw[bounds[i]:bounds[i + 1]].count(b"### ") == raw[bounds[i]:bounds[i + 1]].count(chat.END) == 1


def test_frame(spark):
    rows = [(1, 1, "assistant", "b<c"), (1, 0, "user", "a"), (1, 1, "assistant", "b<c"), (2, 0, None, None),
            (None, 0, "user", "\\### x: </turn>\n"), (3, None, "assistant", "é"), *chat.HARD_TURNS]
    rows += [(4, i, "user" if i % 2 == 0 else "assistant", f"t{i}" * 50) for i in range(3000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")
    out = {r.conv_id: r for r in chat.digests(chat.format_chat(df)).collect()}
    assert set(out) == {1, 2, 3, 4, None, -7}
    for conv, row in out.items():
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(said), sha(said))
    assert chat.format_chat(df.limit(0)).count() == 0


def test_parts_of_a_long_conversation(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(i // 40, i % 40, "assistant", f"# {i}") for i in range(200)]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        parts = chat.format_chat(df)
        assert parts.filter("part > 0").count() > 0
        out = {r.conv_id: r for r in chat.digests(parts).collect()}
        assert [out[c].n_turns for c in range(5)] == [40] * 5
        assert out[2].loss_sha256 == sha("".join(f"# {i}" for i in range(80, 120)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_conversation_is_formatted_by_many_tasks(spark):
    from pyspark.sql import functions as F

    rows = [(-5 if i % 3 == 0 else None if i % 3 == 1 else i, i, "assistant", f"text {i} " * 5) for i in range(6000)]
    parts = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    tasks = [r.n for r in parts.groupBy(F.shiftright("part", 32).alias("task")).agg(F.sum("n_turns").alias("n")).collect()]
    assert sum(tasks) == 6000 and max(tasks) <= 3 * 6000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = {r.conv_id: r for r in chat.digests(parts).collect()}
    assert out[-5].loss_sha256 == sha("".join(f"text {i} " * 5 for i in range(0, 6000, 3)))
    assert out[None].n_turns == 2000


def test_equal_turns_with_long_roles_and_texts_keep_their_order(spark):
    import random

    rng = random.Random(3)
    long = "r" * (chat.KEY_CHARS - 1)
    rows = [(1, 0, rng.choice([None, "", long, long + "s", long + "st", long + "su", "é" * 80]),
             rng.choice([None, "", "t" * 70, "t" * 70 + "u", "\U0001f642" * 65, "z", "a" * 200_000])) for _ in range(300)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, part long")
    (row,) = chat.digests(chat.format_chat(df)).collect()

    def key(r):
        return [(x is not None, (x or "").encode()) for x in r[2:]]

    assert row.n_turns == 300
    assert row.turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in sorted(rows, key=key)))
