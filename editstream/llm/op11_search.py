"""Ranked lexical search the other way round: documents stream past the queries.

1. The items' terms, each once an item, are gathered in blocks of bounded size
   (``BLOCK_POSTINGS`` pairs of item and term, ``BLOCK_ITEMS`` items); a block
   is an inverted index that fits any worker and is broadcast.
2. One pass over the texts cuts each document into terms and writes its length
   and the counts of those that an item asks for. Spark sums the number of
   documents, their terms, and the documents of each term asked for: these
   weights complete the index.
3. The counts stream through the index: each term's share goes to the items of
   its posting list, and a bounded heap for each item keeps the best documents
   of the task. Heaps are merged in two steps, first those of a share of the
   tasks, then these few, so no item's heaps meet in one task at once.

Nothing of the documents is broadcast or sent to the driver but three sums and
one number for each term asked for. Scores are whole numbers: results do not
depend on the order of the documents.

Defined cases: a null text has no terms and counts for nothing; a null doc_id
ranks behind all others of its score; repeated rows are documents each; rows of
one item_id (a null one too) are one item with all their terms; an item without
terms, or whose terms no document holds, has no rows; texts of any length are
cut in parts; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import discard, read_table, slices, stored

BEST = 10
BLOCK_ITEMS = 4096
BLOCK_POSTINGS = 2_000_000
BLOCK_BYTES = 64 << 20
CELLS = 1 << 20      # scores held at once: documents x items
PAIRS = 1 << 22      # additions held at once
PART = 1 << 20       # bytes of a text cut at a time
SCALE, LENGTH_SHARE, SATURATION = 1000, 90, 8

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# A byte of a term as it counts, a blank for any other: bytes above 0x7F belong to letters of terms.
_KEPT = bytes(ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20 for b in range(256))


def term_counts(text: bytes) -> tuple[int, dict[bytes, int]]:
    """Number of terms of a text in UTF-8, and the occurrences of each."""
    from collections import Counter

    counts, n, start = Counter(), 0, 0
    while start < len(text):
        end = start + PART
        if end < len(text):
            # Not inside a term: the part ends before the next blank.
            cut = _BLANK.search(text, end)
            end = cut.start() if cut else len(text)
        words = text[start:end].translate(_KEPT).split()
        counts.update(words)
        n, start = n + len(words), end
    return n, counts


_BLANK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def item_terms(items: DataFrame) -> DataFrame:
    """items: item_id, text -> item_id, term: each once."""
    ascii_lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.explode(F.regexp_extract_all(ascii_lower, F.lit(TERM), F.lit(0)))
    return items.select("item_id", terms.alias("term")).distinct()


def _blocks(postings: DataFrame) -> list[DataFrame]:
    """Postings cut into blocks of items that keep all bounds but for a single item's terms."""
    sizes = postings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term") + 64).alias("b"))
    # Items are spread over blocks by a hash; the number of blocks follows from three sums.
    items, n, b = sizes.agg(F.count(F.lit(1)), F.sum("n"), F.sum("b")).first()
    most = max((items or 0) / BLOCK_ITEMS, (n or 0) / BLOCK_POSTINGS, (b or 0) / BLOCK_BYTES)
    if most <= 1:
        return [postings] if items else []
    # Hashed shares vary: half the bound leaves room.
    blocks = math.ceil(2 * most)
    number = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    return [postings.filter(number == i) for i in range(blocks)]


def _counted(vocabulary):
    """Documents -> doc_id, n, numbers and counts of their terms in the vocabulary (a broadcast dict)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        numbers = vocabulary.value
        for whole in batches:
            for batch in slices([whole], "text"):
                lengths, found, counts = [], [], []
                for text in batch.column("text"):
                    value = text.as_buffer() if text.is_valid else None
                    n, of = term_counts(value.to_pybytes()) if value is not None else (0, {})
                    pairs = [(numbers[t], of[t]) for t in of.keys() & numbers.keys()]
                    lengths.append(n)
                    found.append(np.array([p[0] for p in pairs], "<i4").tobytes())
                    counts.append(np.array([p[1] for p in pairs], "<i8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(found, pa.binary()), pa.array(counts, pa.binary())],
                    names=["doc_id", "n", "terms", "counts"])
    return run


def _frequencies(size: int):
    """Documents that hold each term number, of one task."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = np.zeros(size, np.int64)
        for batch in batches:
            column = batch.column("terms")
            joined = b"".join(v.as_py() for v in column)
            held += np.bincount(np.frombuffer(joined, "<i4"), minlength=size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], names=["term", "df"])
    return run


class Heaps:
    """The best documents of each item: (score, -doc_id), the worst on top."""

    NULL = -(1 << 63) - 1  # a null id is behind all others

    def __init__(self, items: int, best: int):
        import numpy as np

        self.best, self.of = best, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a score below this cannot enter

    def update(self, scores, ids) -> None:
        """scores: documents x items; ids: a Python int or None for each document."""
        import numpy as np

        entering = scores >= self.least
        if len(scores) > self.best:
            entering &= scores >= np.partition(scores, -self.best, axis=0)[-self.best]
        for d, i in zip(*(x.tolist() for x in np.nonzero(entering))):
            heap, entry = self.of[i], (int(scores[d, i]), self.NULL if ids[d] is None else -ids[d])
            if len(heap) < self.best:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.best:
                self.least[i] = heap[0][0]


def _searched(index, best: int):
    """Counted documents -> the best of each item in this task. ``index``: a broadcast
    (offsets, items, weights, N, L, number of items): the posting list of term t
    is ``items[offsets[t]:offsets[t + 1]]``."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        offsets, items, weights, documents, occurrences, size = index.value
        heaps = Heaps(size, best)
        widths = np.diff(offsets)
        chunk = max(1, CELLS // size)
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                lists = part.column("terms").to_pylist()
                terms = np.frombuffer(b"".join(lists), "<i4")
                tf = np.frombuffer(b"".join(part.column("counts").to_pylist()), "<i8")
                owner = np.repeat(np.arange(len(lists)), [len(v) // 4 for v in lists])
                m = np.array([SCALE // 10 - LENGTH_SHARE + LENGTH_SHARE * n * documents // occurrences if n else 0
                              for n in part.column("n").to_pylist()], np.int64)
                share = weights[terms] * ((1_000_000_000 * tf) // (SCALE * tf + SATURATION * m[owner]))
                scores = np.zeros(len(lists) * size, np.int64)
                # Posting lists are laid end to end, as many at a time as the bound allows.
                ends = np.cumsum(widths[terms])
                at = 0
                while at < len(terms):
                    upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
                    t, w = terms[at:upto], widths[terms[at:upto]]
                    before = np.cumsum(w) - w
                    place = np.arange(int(w.sum())) - np.repeat(before, w) + np.repeat(offsets[t], w)
                    cell = np.repeat(owner[at:upto] * size, w) + items[place]
                    np.add.at(scores, cell, np.repeat(share[at:upto], w))
                    at = upto
                heaps.update(scores.reshape(len(lists), size), part.column("doc_id").to_pylist())
        task = TaskContext.get().partitionId()
        rows = [(i, -1 if v == Heaps.NULL else -v, v == Heaps.NULL, s) for i, heap in enumerate(heaps.of) for s, v in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()),
             pa.array([None if r[2] else r[1] for r in rows], pa.int64()),
             pa.array([r[3] for r in rows], pa.int64()),
             pa.array([task] * len(rows), pa.int32())], names=["item", "doc_id", "score", "task"])
    return run


def _search_block(documents: DataFrame, postings: DataFrame, best: int) -> DataFrame | None:
    import numpy as np

    spark = documents.sparkSession
    rows = postings.collect()  # bounded by _blocks
    if not rows:
        return None
    item_ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
    item_number = {i: k for k, i in enumerate(item_ids)}
    vocabulary = {t: k for k, t in enumerate(sorted({r.term for r in rows}))}
    lists = [[] for _ in vocabulary]
    for r in rows:
        lists[vocabulary[r.term]].append(item_number[r.item_id])
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    items = np.array([i for x in lists for i in sorted(x)], np.int64)

    words = spark.sparkContext.broadcast({t.encode(): k for t, k in vocabulary.items()})
    counted = stored(documents.select("doc_id", "text").mapInArrow(
        _counted(words), "doc_id long, n long, terms binary, counts binary"), "term-counts")
    total, occurrences = counted.agg(F.sum(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted.select("terms").mapInArrow(_frequencies(len(vocabulary)), "term int, df long").groupBy("term").agg(
            F.sum("df").alias("df")).collect():  # a row a term of the block
        df[r.term] = r.df
    total, occurrences = int(total or 0), int(occurrences or 0)
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    index = spark.sparkContext.broadcast((offsets, items, weights, total, occurrences, len(item_ids)))

    found = counted.filter("octet_length(terms) > 0").mapInArrow(
        _searched(index, best), "item int, doc_id long, score long, task int")
    ids = spark.createDataFrame(list(enumerate(item_ids)), f"item int, item_id {postings.schema['item_id'].dataType.simpleString()}")
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = W.partitionBy("item", "share").orderBy(*order)
    every = W.partitionBy("item").orderBy(*order)
    merged = (found.withColumn("share", F.pmod(F.xxhash64("task"), F.lit(shares)))
              .withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= best)
              .withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= best))
    result = stored(merged.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
    discard(counted)
    return result


def ranked_documents(documents: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """documents: doc_id, text; items: item_id, text -> item_id, rank, doc_id, score.

    Items beyond one block's bounds are searched block by block, each in a pass
    over the documents.
    """
    postings = stored(item_terms(items), "item-terms")
    kind = items.schema["item_id"].dataType.simpleString()
    out = documents.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in _blocks(postings):
        found = _search_block(documents, block, best)
        out = out if found is None else out.unionByName(found)
    return out


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the 10 best documents of each benchmark item."""
    return ranked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         rf"'{TERM}')"

OP11_SQL = f"""
WITH words AS (
  SELECT row_number() OVER () AS place, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
docs AS (SELECT place, doc_id, len(terms)::BIGINT AS n, terms FROM words WHERE len(terms) > 0),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, whole GROUP BY term),
shares AS (
  SELECT place, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))) AS share
  FROM tf JOIN weights USING (term) JOIN docs USING (place), whole),
scores AS (
  SELECT item_id, place, sum(share)::BIGINT AS score FROM shares JOIN asked USING (term) GROUP BY ALL),
ranks AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scores JOIN docs USING (place) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= {BEST}
"""
