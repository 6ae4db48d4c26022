"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

1. Documents become token ids and an end id inside tasks; only documents
   longer than a sequence are cut. Nothing but (id, piece, start, length,
   checksum) leaves a task.
2. Spark counts pieces by length: at most ``capacity`` numbers, whatever the
   input, and all that the packing has to know.
3. ``best_two_fit`` packs these counts. A bin starts with the longest length
   left and is filled greedily by the longest that fits; then its smallest
   document gives way to the two unpacked documents that together fill the
   expanded gap more tightly, if there are such. The bin is repeated as often
   as the counts allow, so the plan's size depends on the number of lengths.
4. Pieces of a length are numbered in seeded order, dealt to tasks by ranges of
   length, order and row number (a hot length or id is cut among tasks), and the
   plan deals numbers to places by a broadcast join (a few rows a length).

Defined cases: a null or empty text is one piece holding the end id alone;
repeated rows and ids are pieces of their own; a null id is kept; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from .shared import fraction_key, read_table, slices, stored, tidy

CAPACITY = 2048
END_ID = 0
MOST_WORDS = 400_000
LONGEST_KEPT = 64
BATCH_BYTES = 8 << 20
_TABLES: dict[str, "WordTable"] = {}


def _latin1(kind: str) -> str:
    """Characters of a category, to U+00FF, as a regular expression's class."""
    return "".join(re.escape(chr(c)) for c in range(0x21, 0x100) if unicodedata.category(chr(c))[0] == kind)


class WordTable:
    """Token ids of a text as little-endian 32-bit integers.

    The vocabulary's own rule cuts a text into words that are segmented one by
    one and never cross white space. Ids are kept for each distinct stretch
    between white space, made of those of its words, and the library segments
    each distinct word once. The rule is restated here for plain Latin-1 texts
    only; any other text, or one that may hold a special token, goes to the
    library whole.
    """

    plain = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]*")

    def __init__(self, path: str, most: int = MOST_WORDS):
        import numpy as np
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # The same model for words that are normalised and cut already.
        self.bare = Tokenizer(self.library.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        letter, number = _latin1("L"), _latin1("N")
        # The pre-tokenizer's pattern in word_bpe_49k.json.
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^\\s{letter}{number}]+")
        self.most, self.of_word, self.of_chunk = most, {}, {}

    @staticmethod
    def whole(tokenizer, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def each(self, words: list[str]) -> list[bytes]:
        """Ids of each word, from one call: a word's last piece is marked."""
        import numpy as np

        raw = self.whole(self.bare, [" ".join(words)])[0]
        ends = (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1).tolist()
        if len(ends) != len(words):
            return self.whole(self.bare, words)
        return [raw[4 * a:4 * b] for a, b in zip([0, *ends], ends)]

    def of_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each of these distinct stretches."""
        if len(self.of_word) > self.most or len(self.of_chunk) > self.most:
            self.of_word, self.of_chunk = {}, {}
        words, known = self.of_word, self.of_chunk
        missing = [c for c in chunks if c not in known]
        parts = [self.words.findall(c) for c in missing]
        unknown = [*set(itertools.chain.from_iterable(parts)).difference(words)]
        words.update(zip(unknown, self.each(unknown)))
        known.update((c, words[p[0]] if len(p) == 1 else b"".join(map(words.__getitem__, p))) for c, p in zip(missing, parts))
        out = [*map(known.__getitem__, chunks)]
        for kept, new in ((words, unknown), (known, missing)):
            for w in new:  # a word kept is short; a long one is rare and not worth its bytes
                if len(w) > LONGEST_KEPT:
                    del kept[w]
        return out

    def joined(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts: distinct stretches looked up, then gathered by position."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        cut = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.string()))
        coded = cut.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        ids = self.of_chunks(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(size) - size
        n = size[at]
        ends = np.cumsum(n)
        flat = np.frombuffer(b"".join(ids), "<u4")
        raw = flat[np.arange(n.sum()) + np.repeat(first[at] - ends + n, n)].tobytes()
        edges = (4 * np.concatenate(([0], ends))[cut.offsets.to_numpy()]).tolist()
        return [raw[a:b] for a, b in zip(edges, edges[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        fast = [bool(self.plain.fullmatch(t)) and "<|" not in t for t in texts]
        quick = iter(self.joined([t for t, f in zip(texts, fast) if f]))
        rest = iter(self.whole(self.library, [t for t, f in zip(texts, fast) if not f]))
        return [next(quick if f else rest) for f in fast]


def table(path: str) -> WordTable:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    if path not in _TABLES:
        _TABLES[path] = WordTable(path)
    return _TABLES[path]


def _forget() -> None:
    _TABLES.clear()


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, text -> doc_id, piece, start, length, ids_crc32 (and ids as
    little-endian unsigned 32-bit integers, if asked for)."""
    end = end_id.to_bytes(4, "little")

    def run(batches):
        import pyarrow as pa

        words = table(path)
        for batch in slices(batches, "text", BATCH_BYTES):
            coded = [x + end for x in words.encode([t or "" for t in batch.column("text").to_pylist()])]
            cut = [(i, p, x[p * 4 * capacity:(p + 1) * 4 * capacity]) for i, x in enumerate(coded)
                   for p in range(-(-len(x) // (4 * capacity)))]
            columns = [
                batch.column("doc_id").take(pa.array([i for i, _, _ in cut], pa.int64())),
                pa.array([p for _, p, _ in cut], pa.int32()),
                pa.array([p * capacity for _, p, _ in cut], pa.int64()),
                pa.array([len(x) // 4 for _, _, x in cut], pa.int64()),
                pa.array([zlib.crc32(x) for _, _, x in cut], pa.int64()),
                *([pa.array([x for _, _, x in cut], pa.binary())] if with_ids else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run, _forget), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """counts: documents by length, 1 to ``capacity``.

    Returns (length, first rank, end rank, first sequence, offset): documents
    of that length and rank r in the range go to sequence ``first sequence +
    r - first rank`` at that offset.
    """
    import numpy as np

    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    plan, sequence = [], 0

    def fitting(free, gap: int) -> int:
        """The longest length with documents left that fits, or 0."""
        there = np.flatnonzero(free[:gap + 1])
        return int(there[-1]) if len(there) else 0

    while left.any():
        free = left.copy()
        gap, items = capacity, []
        while gap and (x := fitting(free, gap)):
            items.append(x)
            free[x] -= 1
            gap -= x
        if gap and len(items) > 1:
            smallest = items[-1]  # lengths were taken in falling order
            room = gap + smallest
            there = np.flatnonzero(free[:room])
            if len(there):
                mate = there[np.maximum(np.searchsorted(there, room - there, "right") - 1, 0)]
                # A pair of equal lengths takes two documents of that length.
                lone = (mate == there) & (free[there] < 2)
                lower = np.maximum(np.searchsorted(there, there, "left") - 1, 0)
                mate = np.where(lone, there[lower], mate)
                both = there + mate
                both[(both > room) | ((mate == there) & (free[there] < 2))] = 0
                best = int(np.argmax(both))
                if both[best] > smallest:
                    items[-1:] = [int(there[best]), int(mate[best])]
        need = np.bincount(items, minlength=capacity + 1)
        kinds = np.flatnonzero(need)
        times = int((left[kinds] // need[kinds]).min())
        offset = 0
        for x in items:
            plan.append((x, int(used[x]), int(used[x]) + times, sequence, offset))
            used[x] += times
            offset += x
        left[kinds] -= need[kinds] * times
        sequence += times
    return plan


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """rows: doc_id, piece, length and more, of a written table -> + sequence_id, offset."""
    spark = rows.sparkSession
    kept = rows.columns
    # At most ``capacity`` rows reach the driver.
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(best_two_fit(counts, capacity), "length long, _from long, _to long, _first long, offset long")
    key = fraction_key(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("piece").cast("string")))
    order = ["length", "_h", *[c for c in kept if c not in ("length", "ids")], "_row"]
    keyed = rows.withColumn("_h", key).withColumn("_row", F.monotonically_increasing_id())
    placed = numbered(keyed, order, {"_rank": ["length"]}).alias("p").join(
        F.broadcast(plan).alias("q"),
        (F.col("p.length") == F.col("q.length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return placed.select(*[F.col(f"p.{c}") for c in kept],
                         (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for all of docs."""
    return pack(stored(pieces(docs, path, capacity), "pieces"), capacity)


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    import public_tokenizers

    return packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
