"""Repeated byte strings by distributed prefix doubling over sparse positions.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.
Ranking every byte position would shuffle many times the corpus, so positions
are taken sparsely and ranked by what surrounds them:

* Anchors. In each window of ``length`` bytes the 32-byte string of least hash
  is its anchor. Equal windows have equal anchors at equal places, and windows
  of one anchor are neighbours: a row is such an interval of windows.
* Rank pairs. A row has two ranks: its core (the bytes that all windows of its
  place share: at first the anchor) and its context (all bytes of its windows).
  Spark brings equal pairs together, takes the earliest document of each, and
  counts contexts of each core. All windows of a row whose pair is there
  earlier are repeats. A row whose core has no second context holds none. Both
  are done; only the earliest rows of cores with several contexts remain.
* Growing. What remains is split into narrower intervals, whose cores are
  longer (32, then 95, then 100 bytes), and ranked again, until the core is the
  window itself: past the threshold, where equal ranks mean equal strings.

Ranks are 64-bit hashes, so a pair has 128 bits. Cores that occur once, most
of them, are dropped before rows are built. Keys are narrow; hot pairs are
pre-aggregated and joined back by joins that Spark can split. Texts are
shuffled by document only, three times.

Defined cases: a null text counts as empty; texts under ``length`` bytes keep
all; rows of one id and text are one document; where ids are null or stand for
several texts, documents are ordered by id (nulls last) and text hash; an
empty table gives no rows. A text of any length is read in pieces.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import discard, read_table, slices, stored, tidy

LENGTH = 100
ANCHOR = 32
SIZES = (6, 1)
PIECE = 1 << 20
BATCH = 512 << 10
SPANS = "__spans"

ROW = "core long, ctx long, doc long, at long, again boolean"


class _Hash:
    """Polynomial hashes of any substring of a buffer, from prefix sums modulo 2^64."""

    seeds = {}

    def __init__(self, seed: int, data):
        import numpy as np

        n = len(data) + 1
        if seed not in self.seeds or len(self.seeds[seed][1]) < n:
            rng = np.random.Generator(np.random.PCG64(seed))
            letters = rng.integers(0, 1 << 64, 256, np.uint64)
            base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
            most = max(n, PIECE + 512)
            powers = lambda b: np.cumprod(_factors(b % (1 << 64), most))
            self.seeds[seed] = letters, powers(base), powers(pow(base, -1, 1 << 64))
        letters, power, self.inverse = self.seeds[seed]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(letters[data] * power[:n - 1], out=self.sums[1:])

    def of(self, start, end):
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def _factors(base: int, most: int):
    """1 and then ``base``: every task makes them anew, so not from a list."""
    import numpy as np

    factors = np.full(most, base, np.uint64)
    factors[0] = 1
    return factors


def _forget() -> None:
    _Hash.seeds.clear()


def mixed(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def _pieces(texts: list[bytes]):
    """(buffer, text number, text offset and buffer offset of each piece): texts
    cut so that every window lies in one piece, put together by the megabyte."""
    part, held = [], 0
    for i, t in enumerate(texts):
        for start in range(0, max(len(t) - LENGTH + 1, 0), PIECE):
            piece = t[start:start + PIECE + LENGTH - 1]
            if held and held + len(piece) > PIECE:
                yield part
                part, held = [], 0
            part.append((i, start, held, piece))
            held += len(piece)
    if part:
        yield part


def _intervals(data, edges):
    """Windows of ``data`` by anchor: (first window, number of windows, anchor)
    of each interval, and the hash of 32-byte strings."""
    import numpy as np

    h = _Hash(1, data)
    n = len(data) - ANCHOR + 1
    grams = h.of(np.arange(n), np.arange(ANCHOR, ANCHOR + n))
    low = np.uint64((1 << 22) - 1)
    least = (grams & ~low) | np.arange(n, dtype=np.uint64)
    span, wide = 1, LENGTH - ANCHOR + 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[:span - wide], least[wide - span:])
    anchor = (least & low).astype(np.int64)
    piece = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[:len(anchor)]
    window = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= edges[piece + 1])
    anchor, piece = anchor[window], piece[window]
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1]))))
    return window[first], np.diff(np.concatenate((first, [len(window)]))), anchor[first], grams, piece[first]


def _scan(texts: list[bytes]):
    """Anchor hash, text number, offset, anchor's distance, windows and context hash of all intervals."""
    import numpy as np

    for part in _pieces(texts):
        data = np.frombuffer(b"".join(p for *_, p in part), np.uint8)
        number, start, held = (np.array([x[i] for x in part]) for i in range(3))
        low, n, anchor, grams, piece = _intervals(data, np.append(held, len(data)))
        yield data, grams[anchor], number[piece], low - held[piece] + start[piece], anchor - low, n, low


def _packed(low, distance, n):
    return (low << 14) | (distance << 7) | n


def _context(data, low, n, distance):
    """Rank of all bytes of intervals; their place counts."""
    import numpy as np

    return mixed(_Hash(2, data).of(low, low + n + LENGTH - 1) + (distance * 128 + n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _lists(column):
    """The values of a column of lists, and where each row's begin (and the last's end)."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.concatenate(([0], np.cumsum(sizes)))


def _batch(docs, core, ctx, at):
    """Rows of a batch; a pair that its document has before is marked."""
    import numpy as np
    import pyarrow as pa

    order = np.lexsort((at, ctx, core, docs))
    same = np.zeros(len(at), bool)
    a, b = order[1:], order[:-1]
    same[a] = (docs[a] == docs[b]) & (core[a] == core[b]) & (ctx[a] == ctx[b])
    return pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(docs),
                                       pa.array(at), pa.array(same)], names=["core", "ctx", "doc", "at", "again"])


def _texts(batch):
    return [t or b"" for t in batch.column("text").to_pylist()]


def _anchors(batches):
    """Anchor hashes and how often they occur."""
    import numpy as np
    import pyarrow as pa

    for batch in slices(batches, "text", BATCH):
        found = [core for _, core, *_ in _scan(_texts(batch))]
        if found:
            core, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array(n)], names=["core", "n"])


def _first_rows(batches):
    import numpy as np

    for batch in slices(batches, "text", BATCH):
        ids = batch.column("doc").to_numpy()
        rows = [(ids[number], core, _context(data, low, n, distance), _packed(offset, distance, n))
                for data, core, number, offset, distance, n, low in _scan(_texts(batch))]
        if rows:
            yield _batch(*(np.concatenate(x) for x in zip(*rows)))


def _narrower(size: int):
    """Rows (doc, text, at list) split into intervals of ``size`` places at most."""
    def run(batches):
        import numpy as np

        for batch in slices(batches, "text", BATCH):
            texts, ids = _texts(batch), batch.column("doc").to_numpy()
            rows = []
            marks, edges = _lists(batch.column("at"))
            marks = marks.to_numpy()
            for i, text in enumerate(texts):
                data = np.frombuffer(text, np.uint8)
                at = marks[edges[i]:edges[i + 1]]
                for start in range(0, len(data), PIECE):
                    # An interval and its windows lie within 256 bytes of its first.
                    mine = at[(at >> 14 >= start) & (at >> 14 < start + PIECE)]
                    if not len(mine):
                        continue
                    part = data[start:start + PIECE + 256]
                    low, distance, n = (mine >> 14) - start, (mine >> 7) & 127, mine & 127
                    lowest, highest = (distance - n + 1) // size, distance // size
                    times = highest - lowest + 1
                    which = np.repeat(np.arange(len(mine)), times)
                    place = lowest[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                    anchor = (low + distance)[which]
                    far = np.minimum(place * size + size - 1, distance[which])
                    near = np.maximum(place * size, (distance - n + 1)[which])
                    first, m = anchor - far, far - near + 1
                    window = anchor - place * size, anchor - place * size - size + 1 + LENGTH
                    core = _Hash(1, part).of(*window)
                    # A window by itself has no context: a second hash of it makes up the 128 bits.
                    ctx = _Hash(2, part).of(*window) if size == 1 else _context(part, first, m, far)
                    rows.append((np.full(len(first), ids[i]), core, ctx, _packed(first + start, far, m)))
            if rows:
                yield _batch(*(np.concatenate(x) for x in zip(*rows)))
    return run


def _settle(rows: DataFrame, last: bool) -> tuple[DataFrame, DataFrame | None, list[DataFrame]]:
    """(repeated (doc, at), what remains (doc, at), tables to discard at the end)."""
    own = rows.filter("NOT again")
    pairs = stored(own.groupBy("core", "ctx").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")), "pairs")
    if last:
        useful = pairs.filter("n > 1").withColumn("several", F.lit(False))
    else:
        cores = stored(pairs.groupBy("core").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("core", F.lit(True).alias("several")), "cores")
        useful = pairs.join(cores, "core", "left").withColumn("several", F.coalesce("several", F.lit(False))).filter("several OR n > 1")
    useful = stored(useful.select("core", "ctx", "first", "several"), "useful")
    found = stored(own.join(useful, ["core", "ctx"]).select("doc", "at", (F.col("doc") > F.col("first")).alias("repeated"), "several")
                   .filter("repeated OR several"), "settled")
    discard(pairs, useful, *([] if last else [cores]))
    again = rows.filter("again").select("doc", "at")
    repeats = stored(found.filter("repeated").select("doc", "at").union(again), "repeats")
    return repeats, None if last else found.filter("NOT repeated").select("doc", "at"), [found]


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """docs with ``doc``, a long that orders documents and names each; whether
    every row is a document of its own."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc"))
    odd = ids.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc IS NULL").limit(1).count()
    if not odd:
        return docs.withColumn("doc", F.col("doc_id").cast("long")), True
    known = docs.select(F.col("doc_id").alias("_id"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("_t")).distinct()
    sort = [F.col("_id").asc_nulls_last(), F.col("_t")]
    order = stored(known.repartitionByRange(*sort).sortWithinPartitions(*sort).select(
        "_id", "_t", F.monotonically_increasing_id().alias("doc")), "order")
    left = docs.withColumn("_t", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    return left.join(order.withColumnRenamed("_t", "_t2"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_t2"))
                     ).drop("_id", "_t", "_t2"), False


def repeated(texts: DataFrame) -> DataFrame:
    """texts: doc (long), text (binary), a row a document -> doc, spans: its
    repeated byte runs as sorted [start, end) pairs, maximal."""
    common = stored(texts.mapInArrow(tidy(_anchors, _forget), "core long, n long").groupBy("core").agg(F.sum("n").alias("n"))
                    .filter("n > 1").select("core"), "anchors")
    rows = stored(texts.mapInArrow(tidy(_first_rows, _forget), ROW).join(common, "core", "left_semi"), "intervals")
    discard(common)
    repeats, done = [], []
    for size in (*SIZES, None):
        found, rest, more = _settle(rows, size is None)
        repeats.append(found)
        if size is None:
            discard(rows, *more)
            break
        marks = rest.groupBy("doc").agg(F.collect_list("at").alias("at"))
        narrower = stored(texts.join(marks, "doc").select("doc", "text", "at").mapInArrow(tidy(_narrower(size), _forget), ROW), "intervals")
        discard(rows, *more)
        rows = narrower
    runs = repeats[0].union(repeats[1]).union(repeats[2]).select(
        "doc", F.shiftright("at", 14).alias("start"), (F.shiftright("at", 14) + F.col("at").bitwiseAND(127) + LENGTH - 1).alias("end"))
    return runs.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _joined(spans) -> list[tuple[int, int]]:
    """Sorted runs, overlapping and touching ones as one."""
    out = []
    for r in spans or ():
        if out and r["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["end"])
        else:
            out.append([r["start"], r["end"]])
    return [tuple(r) for r in out]


def _joined_rows(column) -> list[list[tuple[int, int]]]:
    """``_joined`` for each row of a column of spans, without an object a span."""
    import numpy as np

    spans, edges = _lists(column)
    row = np.repeat(np.arange(len(column)), np.diff(edges))
    shift = row << 40       # a row's runs lie behind those of the rows before
    start, end = (spans.field(c).to_numpy().astype(np.int64) + shift for c in ("start", "end"))
    top = np.maximum.accumulate(end)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(start), 1), bool), start[1:] > top[:-1])))
    last = np.append(first[1:], len(start))[:len(first)] - 1
    runs = list(zip((start[first] - shift[first]).tolist(), (top[last] - shift[first]).tolist()))
    begin = np.searchsorted(row[first], np.arange(len(column) + 1)).tolist()
    return [runs[a:b] for a, b in zip(begin, begin[1:])]


def _kept(text: bytes, spans) -> bytes:
    edges = [0, *(x for r in spans for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(text: bytes, spans) -> list[tuple[int, int]]:
    """Runs shrunk to the characters that lie in them whole."""
    inside = lambda i: 0 < i < len(text) and text[i] & 0xC0 == 0x80
    out = []
    for a, b in spans:
        while inside(a):
            a += 1
        while b > a and inside(b):
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _with_spans(docs: DataFrame, columns: list[str], once: bool) -> DataFrame:
    """``once``: every document is one row."""
    texts = docs.select("doc", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = repeated(texts if once else texts.dropDuplicates(["doc"]))
    return docs.select(F.col("doc").alias("_doc"), F.struct(*columns).alias("_row")).join(
        found, F.col("_doc") == found["doc"], "left").select("_row.*", F.col("spans").alias(SPANS))


def removed(docs: DataFrame) -> DataFrame:
    """docs without repeated strings: characters that lie in a repeated run
    whole leave ``text``; ``n_chars``, if there, is counted anew."""
    names = docs.columns
    keyed, once = _keyed(docs.toDF(*[c if c in ("doc_id", "text") else f"_{i}" for i, c in enumerate(names)]))
    found = _with_spans(keyed, [c for c in keyed.columns if c != "doc"], once).toDF(*names, SPANS)

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, "text"):
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), _joined_rows(batch.column(SPANS))):
                if spans:
                    raw = text.encode()
                    text = _kept(raw, whole_characters(raw, spans)).decode()
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)

    out = found.mapInArrow(tidy(run), docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def op7_sparse_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed, once = _keyed(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, "text"):
            rows = []
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text, runs in zip(batch.column("doc_id").to_pylist(), texts.to_pylist(), _joined_rows(batch.column(SPANS))):
                text = text or b""
                rows.append({"doc_id": doc_id, "n_bytes": len(text), "n_removed": sum(b - a for a, b in runs),
                             "n_spans": len(runs), "kept_sha256": hashlib.sha256(_kept(text, runs)).hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("doc_id", batch.schema.field("doc_id").type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))

    return _with_spans(keyed, ["doc_id", "text"], once).mapInArrow(
        tidy(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


OP7_SQL = """
WITH d AS (
  SELECT doc_id, upper(hex(encode(coalesce(text, '')))) AS h, strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents),
c AS (
  SELECT doc_id, c, substr(h, 2 * c + 1, 2 * 355) AS h FROM (SELECT doc_id, h, unnest(range(0, n_bytes - 99, 256)) AS c FROM d)),
p AS (
  SELECT doc_id, c + i AS s, substr(h, 2 * i + 1, 200) AS x FROM (SELECT doc_id, c, h, unnest(range(0, 256)) AS i FROM c) WHERE length(h) >= 2 * i + 200),
w AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY md5_number(x) ORDER BY doc_id, s) AS k FROM p),
r AS (SELECT doc_id, s, s + 100 AS e FROM w WHERE k > 1),
m AS (
  SELECT doc_id, s, e, CASE WHEN s > max(e) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    OR row_number() OVER (PARTITION BY doc_id ORDER BY s) = 1 THEN 1 ELSE 0 END AS new FROM r),
g AS (SELECT doc_id, s, e, sum(new) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM m),
runs AS (SELECT doc_id, run, min(s) AS s, max(e) AS e FROM g GROUP BY doc_id, run),
parts AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS from_at FROM runs),
kept AS (
  SELECT d.doc_id, count(*)::BIGINT AS n_spans, sum(p.e - p.s)::BIGINT AS n_removed,
    string_agg(substr(d.h, 2 * p.from_at + 1, 2 * (p.s - p.from_at)), '' ORDER BY p.s) || substr(any_value(d.h), 2 * max(p.e) + 1) AS h
  FROM d JOIN parts p ON p.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT d.doc_id, d.n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed, coalesce(k.n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
