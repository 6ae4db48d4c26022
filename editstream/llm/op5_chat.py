r"""Chat formatting by columnar byte assembly.

Template, one block a turn, blocks of a conversation one after the other::

    ### <role>: <text></turn>\n

Inside roles and texts every ``\``, ``#``, ``<`` and ``:`` (the last in roles
only) gets a ``\`` before it, so neither control string can arise from content
and removing the escapes restores it exactly.

A batch of turns is formatted at once: segment lengths, cumulative offsets and
scatter indices are numpy arrays, and headers, contents and ends are copied
into one preallocated buffer that becomes the Arrow column. The loss mask is
the byte ranges of assistant texts in the formatted text.

Turns are dealt by ranges of conversation, turn, role and text and sorted
inside, so a hot conversation is formatted by many tasks; it comes out in parts
whose numbers grow in its order, and a worker holds a batch, never a whole
conversation. Digests read the parts back where they were made; only the two
hash chains of a conversation, sequential by nature, stream through one task.

Defined cases: a null role or text counts as empty; rows with a null
conversation id are one conversation; equal turn numbers are ordered by role
and text, nulls first; repeated rows are turns each; long texts and roles are
cut into batches by their bytes, and a batch is one row at least (a formatted
turn beyond 2 GB, which no Spark string holds, ends the query with an error);
an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import read_table, slices

HEAD, MIDDLE, END = b"### ", b": ", b"</turn>\n"
LOSS_ROLE = "assistant"
_TURN = re.compile(
    rb"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)
KEY_CHARS = 64
"""Characters of roles and texts in the keys of ranges."""
PARTS = "conv_id {kind}, part long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"


def unescape(text: bytes) -> bytes:
    return re.sub(rb"\\(.)", rb"\1", text, flags=re.S)


def header(role: str) -> bytes:
    return HEAD + re.sub(rb"([\\#<:])", rb"\\\1", role.encode()) + MIDDLE


def assemble(roles, texts):
    """Formatted bytes of a batch of turns: (buffer, segment bounds, text starts, text ends)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "").cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    src = np.frombuffer(data, np.uint8, off[-1] - off[0], off[0]) if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    off = off - off[0]
    special = np.zeros(256, bool)
    special[list(b"\\#<")] = True
    escaped = special[src]
    more = np.concatenate(([0], np.cumsum(escaped, dtype=np.int64)))

    kinds = pc.fill_null(roles, "").dictionary_encode()
    headers = [np.frombuffer(header(r), np.uint8) for r in kinds.dictionary.to_pylist()]
    which = kinds.indices.to_numpy(zero_copy_only=False)
    before = np.array([len(h) for h in headers], np.int64)[which]
    length = np.diff(off) + more[off[1:]] - more[off[:-1]]
    bounds = np.concatenate(([0], np.cumsum(before + length + len(END))))
    starts = bounds[:-1] + before
    out = np.empty(bounds[-1], np.uint8)
    for k, head in enumerate(headers):
        out[bounds[:-1][which == k][:, None] + np.arange(len(head))] = head
    out[(starts + length)[:, None] + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    to = np.arange(len(src)) + more[1:] + np.repeat(starts - off[:-1] - more[off[:-1]], np.diff(off))
    out[to] = src
    out[to[escaped] - 1] = ord("\\")
    return out, bounds, starts, starts + length


def format_chat(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text -> the parts of each conversation:
    conv_id, part (growing in its order, with gaps), n_turns, formatted,
    loss_starts, loss_ends (byte ranges)."""
    rows = turns.select("conv_id", "turn", "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        for batch in slices(slices(batches, "text"), "role"):
            convs = batch.column("conv_id").to_pylist()
            first = [i for i in range(len(convs)) if not i or convs[i] != convs[i - 1]]
            out, bounds, starts, ends = assemble(batch.column("role"), batch.column("text"))
            if bounds[-1] >= 2 ** 31:
                raise OverflowError(f"formatted turns of {bounds[-1]} bytes pass a string's 2 GB")
            edges = np.array([*first, len(convs)])
            parts = range(part, part + len(first))
            part += len(first)
            loss = np.array([r == LOSS_ROLE for r in batch.column("role").to_pylist()])
            masked = np.concatenate(([0], np.cumsum(loss)))[edges]
            base = np.repeat(bounds[edges[:-1]], np.diff(edges))[loss]
            lists = lambda x: pa.ListArray.from_arrays(pa.array(masked, pa.int32()), pa.array(x[loss] - base, pa.int64()))
            text = pa.Array.from_buffers(pa.string(), len(first), [
                None, pa.py_buffer(bounds[edges].astype(np.int32)), pa.py_buffer(out)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([convs[i] for i in first], batch.schema.field("conv_id").type), pa.array(parts, pa.int64()),
                 pa.array(np.diff(edges), pa.int64()), text, lists(starts), lists(ends)],
                names=["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_ends"])

    # Keys of ranges are sampled to the driver, so texts and roles count by their
    # first characters there; behind a longer role they do not, or the order would break.
    longer = F.coalesce(F.length("role") > KEY_CHARS, F.lit(False))
    keys = ["conv_id", "turn", F.left("role", F.lit(KEY_CHARS)), longer, F.when(~longer, F.left("text", F.lit(KEY_CHARS)))]
    cells = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartitionByRange(cells, *keys).sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, PARTS.format(kind=kind)))


def read_back(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of each turn; raises if the text is not made of whole turns."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at byte {at}")
    return found


def _read(batches):
    """Parts -> what their turns and their loss mask say, read back from the formatted text."""
    import pyarrow as pa

    for batch in slices(batches, "formatted"):
        out = []
        for row in batch.to_pylist():
            raw = row["formatted"].encode()
            turns = read_back(raw)
            loss = unescape(b"".join(raw[a:b] for a, b in zip(row["loss_starts"], row["loss_ends"])))
            out.append({"conv_id": row["conv_id"], "part": row["part"], "n_turns": len(turns),
                        "turns": b"".join(role + b"\n" + text + b"\n" for role, text in turns), "loss": loss,
                        "loss_chars": len(loss.decode()), "chars": len(row["formatted"])})
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            ("conv_id", batch.schema.field("conv_id").type), ("part", pa.int64()), ("n_turns", pa.int64()),
            ("turns", pa.binary()), ("loss", pa.binary()), ("loss_chars", pa.int64()), ("chars", pa.int64())]))


def _chained(batches):
    """Sorted parts -> a row a conversation; its hashes take one part after the other."""
    import pyarrow as pa

    conv, done, schema = None, [], None

    def close(x):
        return {"conv_id": x[0], "n_turns": x[1], "turns_sha256": x[2].hexdigest(), "loss_chars": x[3],
                "loss_sha256": x[4].hexdigest(), "formatted_chars": x[5]}

    for batch in slices(batches, "turns"):
        schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()),
                            ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for row in batch.to_pylist():
            if conv is None or row["conv_id"] != conv[0]:
                if conv:
                    done.append(close(conv))
                conv = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            conv[1] += row["n_turns"]
            conv[2].update(row["turns"])
            conv[3] += row["loss_chars"]
            conv[4].update(row["loss"])
            conv[5] += row["chars"]
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if conv:
        yield pa.RecordBatch.from_pylist([close(conv)], schema)


def digests(parts: DataFrame) -> DataFrame:
    """Digests of what ``format_chat`` gave, a row a conversation."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    read = parts.mapInArrow(_read, f"conv_id {kind}, part long, n_turns long, turns binary, loss binary, loss_chars long, chars long")
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        _chained, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


HARD_TURNS = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op5_columnar_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame(HARD_TURNS, "conv_id long, turn long, role string, text string")
    return digests(format_chat(turns.unionByName(hard)))


def _escapes(c: str, chars: str) -> str:
    return " + ".join(f"(length({c}) - length(replace({c}, '{x}', '')))" for x in chars)


OP5_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(HEAD + MIDDLE + END)} + length(role) + {_escapes('role', chr(92) + '#<:')}
    + length(text) + {_escapes('text', chr(92) + '#<')})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
