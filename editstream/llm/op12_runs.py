"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words with smallest period q that no neighbour extends.
In each document:

1. Words become numbers and the suffixes are sorted by prefix doubling; the
   ranks kept at each doubling give the LCP of neighbours in the order.
2. Neighbours are united by decreasing LCP (union-find). A class holds its
   suffixes' positions in order; the smaller set goes into the larger, so a
   position moves O(log n) times.
3. Two positions i < i + d that become neighbours in a class as it is united at
   LCP l agree in exactly l words: words i .. i + l + d have period d. If d is
   within l, the pair seeds a run, and it starts there unless the word before
   agrees too.

All runs of length 3 q are found: between i and i + q a third position of the
class would make a smaller period (Fine and Wilf), so both are neighbours when
they meet. For the same reason d is the smallest period of what a pair seeds.

A run of at least 24 words and 3 periods has l >= 16, so LCPs below that are not
united, and a document without a window of 16 words that repeats in it (looked
up by hash, which may only let too many through) has no run and is not sorted.

Documents are handled where they lie, without a shuffle. A text of any length
takes memory in proportion to its words, times the logarithm of its longest
repeat where a window repeats.

Defined cases: a null, empty or blank text has no words and no runs; a null id
leaves the words as they are; repeated rows are handled each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession

from .shared import read_table, slices

LEAST_LENGTH = 24
LEAST_EXPONENT = 3
CHUNK = 1024
_STEP = 0x9E3779B97F4A7C15


def least_lcp(length: int, exponent: int) -> int:
    """The LCP that any run of so many words and periods shows: length - q at its best q."""
    return min(max((exponent - 1) * q, length - q) for q in range(1, length + 1))


class Positions:
    """An ordered set of positions, in chunks so that an insertion moves little."""

    def __init__(self, position: int):
        self.chunks, self.n = [[position]], 1

    def __iter__(self):
        for chunk in self.chunks:
            yield from chunk

    def _chunk(self, position: int) -> int:
        if len(self.chunks) == 1:
            return 0
        return max(0, bisect_left(self.chunks, position, key=lambda c: c[0]) - 1)

    def around(self, position: int) -> tuple[int | None, int | None]:
        """The members before and behind a position that is no member."""
        k = self._chunk(position)
        chunk = self.chunks[k]
        i = bisect_left(chunk, position)
        before = chunk[i - 1] if i else None
        if i < len(chunk):
            return before, chunk[i]
        return before, self.chunks[k + 1][0] if k + 1 < len(self.chunks) else None

    def add(self, position: int) -> None:
        k = self._chunk(position)
        chunk = self.chunks[k]
        insort(chunk, position)
        self.n += 1
        if len(chunk) > 2 * CHUNK:
            self.chunks[k:k + 1] = [chunk[:CHUNK], chunk[CHUNK:]]


def suffix_order(numbers):
    """(suffixes in order, LCP of each with the next) of an array of numbers."""
    import numpy as np

    n = len(numbers)
    _, rank = np.unique(numbers, return_inverse=True)
    ranks, width = [rank.astype(np.int32)], 1
    while True:
        rank = ranks[-1].astype(np.int64)
        later = np.zeros(n, np.int64)
        later[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, np.int32)
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        width *= 2
        if fresh[order[-1]] == n - 1:
            break
        ranks.append(fresh)
    a, b = order[:-1], order[1:]
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        # Equal ranks mean equal words in full: a suffix that ends inside has a rank of its own.
        padded = np.append(ranks[k], -1)
        lcp += (padded[a + lcp] == padded[b + lcp]) * (1 << k)
    return order, lcp


def repeats_window(numbers, width: int) -> bool:
    """Whether a window of so many numbers occurs twice; by hash, so it may say yes once too often."""
    import numpy as np

    if len(numbers) < width:
        return False
    h, have, step = numbers.astype(np.uint64) * np.uint64(_STEP) + np.uint64(1), 1, _STEP
    out, covered = None, 0
    left = width
    while left:
        if left & have:
            part = h[covered:]
            out = part if out is None else out[:len(part)] * np.uint64(step) + part
            covered += have
            left -= have
        if left:
            h = h[:len(h) - have] * np.uint64(step) + h[have:]
            step, have = step * step % (1 << 64), have * 2
    out = np.sort(out[:len(numbers) - width + 1])
    return bool((out[1:] == out[:-1]).any())


def periodic_runs(numbers, length: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start and period, of an array of
    numbers: those of at least ``length`` members and ``exponent`` periods
    (3 at least)."""
    import numpy as np

    least = least_lcp(length, exponent)
    if len(numbers) < length or not repeats_window(numbers, least):
        return []
    order, lcp = suffix_order(numbers)
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    suffix, found, parent, members = order.tolist(), [], {}, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def seed(i, j, agree):
        d = j - i
        if agree >= (exponent - 1) * d and agree + d >= length and (i == 0 or numbers[i - 1] != numbers[j - 1]):
            found.append((i, agree + d, d))

    for e, agree in zip(edges.tolist(), lcp[edges].tolist()):
        a, b = find(e), find(e + 1)
        large = members.pop(a, None) or Positions(suffix[a])
        small = members.pop(b, None) or Positions(suffix[b])
        if large.n < small.n:
            large, small = small, large
        came = list(small)
        for k, x in enumerate(came):
            before, behind = large.around(x)
            # Members of one set were neighbours before and have been looked at.
            if before is not None and not (k and came[k - 1] > before):
                seed(before, x, agree)
            if behind is not None and not (k + 1 < len(came) and came[k + 1] < behind):
                seed(x, behind, agree)
        for x in came:
            large.add(x)
        parent[b] = a
        members[a] = large
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(words: list, doc_id) -> list:
    """The words, of every tenth document made periodic from a place on, as the contract has it."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * ((n - a) // p + 1))[:n - a]


def report(words: list[bytes]) -> tuple:
    """n_runs; start, length, period, exponent_milli of the run of most periods; digests."""
    import numpy as np

    numbers: dict[bytes, int] = {}
    runs = []
    if len(words) >= LEAST_LENGTH:
        runs = periodic_runs(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
    listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    if not runs:
        return 0, None, None, None, None, listed, hashlib.sha256(b" ".join(words)).hexdigest()
    best = runs[0]
    for r in runs[1:]:  # by start, then period: the first of equals stays
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    dropped = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        dropped[s + q] += 1
        dropped[s + n] -= 1
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()
    collapsed = hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest()
    return len(runs), *best, 1000 * best[1] // best[2], listed, collapsed


COLUMNS = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")


def document_runs(documents: DataFrame, change=None) -> DataFrame:
    """documents: doc_id, text -> one row a document, see ``COLUMNS``.

    ``change``: words, doc_id -> words to look at in their place.
    """
    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in COLUMNS.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        for whole in batches:
            for batch in slices([whole], "text"):
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                    # Without an argument, bytes are cut at just the six blanks of the contract.
                    words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                    rows.append((doc_id, *report(change(words, doc_id) if change else words)))
                columns = list(zip(*rows)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return documents.select("doc_id", "text").mapInArrow(run, COLUMNS)


def op12_lcp_kruskal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    return document_runs(read_table(spark, sf_dir, "documents"), planted)


# Stretches of consecutive places whose window of 16 words recurs at one distance.
OP12_SQL = """
WITH RECURSIVE crc_bits AS (
  SELECT i AS n, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY n) AS tab FROM crc_bits WHERE k = 8),
texts AS (
  SELECT row_number() OVER () AS place, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    CASE WHEN doc_id IS NULL THEN 1 ELSE
      xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT END AS h
  FROM documents, crc_table),
sized AS (SELECT *, len(words)::BIGINT AS n, h // 10 AS g FROM texts),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM sized),
docs AS (SELECT place, doc_id, n, words, a, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
word AS (
  SELECT place, i, words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT place, words, a, p, unnest(range(n)) AS i FROM docs)),
windows AS (
  SELECT place, i, md5(string_agg(word, ' ') OVER w) AS seen, count(*) OVER w AS wide
  FROM word WINDOW w AS (PARTITION BY place ORDER BY i ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING)),
pairs AS (
  SELECT x.place, x.i, y.i - x.i AS d FROM windows x JOIN windows y ON x.place = y.place AND x.seen = y.seen AND x.i < y.i
  WHERE x.wide = 16 AND y.wide = 16),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY place, d ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT place, d, min(i) AS s, count(*) + 15 + d AS l FROM islands GROUP BY place, d, island),
runs AS (
  SELECT place, s, l, min(d) AS q FROM stretches WHERE l >= greatest(24, 3 * d) GROUP BY place, s, l),
best AS (
  SELECT place, count(*) AS n_runs,
    string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM runs GROUP BY place),
first AS (
  SELECT r.* FROM (
    SELECT place, s, l, q, row_number() OVER (PARTITION BY place ORDER BY (l::DECIMAL(18, 0) * 1000000 // q) DESC, s, q) AS k
    FROM runs) r WHERE k = 1),
dropped AS (
  SELECT DISTINCT place, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT w.place, string_agg(w.word, ' ' ORDER BY w.i) AS text
  FROM word w ANTI JOIN dropped x ON w.place = x.place AND w.i = x.i GROUP BY w.place)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period,
  (1000 * l // q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (place) LEFT JOIN first USING (place) LEFT JOIN kept USING (place)
"""
