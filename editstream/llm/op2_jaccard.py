"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A document is the set of its five-word shingles (lower-cased words of letters
and digits; fewer than five words are one shingle). Documents link where the
Jaccard similarity of their sets is ``threshold`` or more.

1. Equal sets are counted once; one of their documents stands for them.
2. Forest. A signature of 64 MinHash values is read from 16 starting places,
   round its end: 16 prefix tries. Each trie is the sorted list of signatures
   (a range shuffle on tree, prefix and id, so no bucket meets in one task).
   ``prefix_length`` shortens the prefix that a bucket shares until the chance
   that a pair at the threshold shares one in some tree reaches the target
   recall. In a bucket every pair counts: those whose whole signatures agree
   well enough not to be excluded as links are candidates, and a forest that
   spans them is kept. A crowded bucket, or one that a partition's border may
   cut, is written as blocks, which meet pair by pair dealt over the tasks.
3. Components of these candidate links are groups. In a group every pair of
   sets is compared exactly, in blocks, so links the tries did not show are
   found as well. Blocks are bounded in bytes: the longer its texts, the fewer
   sets a block holds. A block pair returns a row for each linked set: its
   number of links there and one set that they lead to.
4. Components of the verified links are the classes.

Only signatures are sorted, and only texts in a group are shuffled.

Defined cases: a document without a word (null, empty, signs only) links with
nothing and is a class of its own; rows with one id and different texts are
separate documents, the class is named by the smallest id in it; repeated rows
are copies that link to each other; null ids count as largest; a text of any
length is one set (beyond 64 MB a block of its own); an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .components import components
from .op8_neardup import LINKS, link_rows
from .shared import discard, ranked, read_table, slices, stored, tidy

WORDS = 5
THRESHOLD = 0.8
TREES, VALUES = 16, 64
TARGET_RECALL = 0.9995
KEY_VALUES = 8
SMALL = 16  # rows of a bucket that are compared step by step with all others
BUCKET = 4096  # rows of a block of a larger bucket
MARGIN = 0.25  # below the threshold by this, 64 values exclude a link (5 standard deviations)
BLOCK = 2048  # sets of a block, if their texts are short
SHORT_TEXT = 32 << 10  # bytes; with each doubling beyond, a block holds half as many
COLUMNS = 4096
BATCH = 4 << 20
DATA = ("ids", "copies", "edges", "vocabulary", "sets")


def prefix_length(threshold: float, trees: int = TREES, target: float = TARGET_RECALL, longest: int = KEY_VALUES) -> int:
    """The longest prefix at which pairs at the threshold still meet with the target recall."""
    k = longest
    while k > 1 and 1 - (1 - threshold ** k) ** trees < target:
        k -= 1
    return k


def shingle_sets(texts) -> list:
    """Sorted distinct 64-bit hashes of the shingles of each text of an Arrow column."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    import xxhash

    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())), r"[^\p{L}\p{N}]+", " ")
    cut = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(plain))
    words = cut.flatten().dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) if w else 0 for w in words.dictionary.to_pylist()], np.uint64)
    hashes = known[words.indices.to_numpy()] if len(known) else known
    edges = np.asarray(cut.offsets) - cut.offsets[0].as_py()
    out = []
    with np.errstate(over="ignore"):
        run = np.zeros(max(len(hashes) - WORDS + 1, 0), np.uint64)
        for i in range(WORDS):
            run = run * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + len(run)]
        run = (run ^ (run >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        run ^= run >> np.uint64(29)
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(run[a:b - WORDS + 1]))
        else:
            part = hashes[a:b]
            one = xxhash.xxh3_64_intdigest(part.tobytes()) if len(part) and (b - a > 1 or part[0]) else 0
            out.append(np.array([one], np.uint64) if one else part[:0])
    return out


def _multipliers():
    import numpy as np

    return np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, VALUES, np.uint32) | np.uint32(1)


def signature(shingles, multipliers):
    """64 values of 16 bits."""
    import numpy as np

    x = ((shingles >> np.uint64(32)) ^ shingles).astype(np.uint32)
    least = np.full(VALUES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(x), 8192):
        least = np.minimum(least, np.multiply.outer(x[i:i + 8192], multipliers).min(0))
    return (least & np.uint32(0xFFFF)).astype(">u2")


def _describe(batches):
    """The other columns, hash of the set, signature."""
    import pyarrow as pa
    import xxhash

    a = _multipliers()
    for batch in slices(batches, "text", BATCH):
        sets = shingle_sets(batch.column("text"))
        names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        signatures = [signature(s, a).tobytes() if len(s) else None for s in sets]
        others = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, others), pa.array(names, pa.binary()), pa.array(signatures, pa.binary())],
                                         names=[*others, "name", "signature"])


def grown(low, need: float):
    """(links, labels) of the rows of one bucket: links of a spanning forest of
    its candidate pairs, and for each row the first row of its tree. A row is
    compared with all that no row before has reached, so no pair that could
    join two trees is left out."""
    import numpy as np

    labels = np.zeros(len(low), np.int64)
    links = [np.zeros((0, 2), np.int64)]
    rest, columns = np.arange(len(low)), np.ascontiguousarray(low.T)
    while len(rest):
        first, rest, columns = rest[0], rest[1:], columns[:, 1:]
        labels[first], todo = first, [first]
        while todo and len(rest):
            row = todo.pop()
            met = (columns == low[row][:, None]).view(np.uint8).sum(0, dtype=np.uint8) >= need
            if met.any():
                found, rest, columns = rest[met], rest[~met], columns[:, ~met]
                labels[found] = first
                links.append(np.stack([np.full(len(found), row), found], 1))
                todo.extend(found.tolist())
    return np.concatenate(links), labels


def met_across(low, labels, other, other_labels, need: float):
    """Links between the rows of two blocks of a bucket that join trees of theirs (rows, other rows)."""
    import numpy as np

    mine, theirs = labels.copy(), other_labels + len(low)
    links, wide, last = [np.zeros((0, 2), np.int64)], np.ascontiguousarray(other.T), None
    for row in np.argsort(labels, kind="stable").tolist():
        if last != mine[row]:
            last = mine[row]
            rest = np.flatnonzero(theirs != last)
            columns = wide[:, rest]
        if not len(rest):
            continue
        met = rest[(columns == low[row][:, None]).view(np.uint8).sum(0, dtype=np.uint8) >= need]
        if len(met):
            roots, at = np.unique(theirs[met], return_index=True)
            links.append(np.stack([np.full(len(at), row), met[at]], 1))
            theirs[np.isin(theirs, roots)] = last
            mine[np.isin(mine, roots)] = last
            rest = np.flatnonzero(theirs != last)
            columns = wide[:, rest]
    return np.concatenate(links)


FOUND = "a long, b long, bucket binary, block long, reps binary, low binary, labels binary"


def _buckets(k: int, need: float, most: int):
    """Candidate links of signatures sorted by (tree, key, rep), and as blocks
    the buckets of more than ``most`` rows or at the border of a partition."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.binary()), ("block", pa.int64()),
                            ("reps", pa.binary()), ("low", pa.binary()), ("labels", pa.binary())])
        number = TaskContext.get().partitionId() << 32

        def linked(pairs):
            pairs = np.unique(np.sort(pairs, 1), axis=0)
            none = pa.nulls(len(pairs), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, pa.nulls(len(pairs), pa.int64()),
                                               none, none, none], schema=schema)

        def block(bucket, rep, low):
            nonlocal number
            links, labels = grown(low, need)
            number += 1
            yield linked(rep[links])
            yield pa.RecordBatch.from_pylist([{"bucket": bucket, "block": number, "reps": rep.tobytes(), "low": low.tobytes(),
                                               "labels": labels.tobytes()}], schema)

        def paired(name, rep, low, edges):
            """Whole buckets."""
            sizes = np.diff(edges)
            small = np.repeat(np.where(sizes <= SMALL, sizes, 0), sizes)
            found = []
            for step in range(1, int(small.max(initial=0))):
                at = np.flatnonzero((small[:-step] > step) & (name[step:] == name[:-step]).all(1))
                found.append(np.stack([at, at + step], 1)[(low[at + step] == low[at]).sum(1) >= need])
            for i in np.flatnonzero(sizes > SMALL).tolist():
                found.append(grown(low[edges[i]:edges[i + 1]], need)[0] + edges[i])
            return linked(rep[np.concatenate(found)]) if found else None

        held, border = None, True  # the rows of the bucket that is open, and whether a partition's border may cut it
        for batch in batches:
            if not batch.num_rows:
                continue
            wide = lambda c, n: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, n)
            tree = batch.column("tree").to_numpy().astype(np.uint8)[:, None]
            now = (np.concatenate([tree, wide("key", 2 * KEY_VALUES)[:, :2 * k]], 1), batch.column("rep").to_numpy(), wide("low", VALUES))
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now))
            name, rep, low = now
            edges = np.concatenate(([0], np.flatnonzero((name[1:] != name[:-1]).any(1)) + 1, [len(rep)]))
            first = 0
            if border and len(edges) > 2:
                yield from block(name[0].tobytes(), rep[:edges[1]], low[:edges[1]])
                first, border = 1, False
            for i in [i for i in range(first, len(edges) - 2) if edges[i + 1] - edges[i] > most]:
                for at in range(edges[i], edges[i + 1], most):
                    end = min(at + most, edges[i + 1])
                    yield from block(name[at].tobytes(), rep[at:end], low[at:end])
            if first < len(edges) - 2:
                lo, hi = edges[first], edges[-2]
                inner = edges[first:-1] - lo
                keep = np.diff(inner) <= most
                rows = np.repeat(keep, np.diff(inner))
                out = paired(name[lo:hi][rows], rep[lo:hi][rows], low[lo:hi][rows], np.concatenate(([0], np.cumsum(np.diff(inner)[keep]))))
                if out is not None:
                    yield out
            held = tuple(x[edges[-2]:] for x in now)
            while len(held[1]) > most:  # the open bucket is crowded: all of it goes as blocks
                yield from block(held[0][0].tobytes(), held[1][:most], held[2][:most])
                held, border = tuple(x[most:] for x in held), True
        if held is not None:
            yield from block(held[0][0].tobytes(), *held[1:])

    return run


def _met_blocks(need: float):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c, t: np.frombuffer(batch.column(c)[i].as_py(), t)
                rep, other = get("reps", np.int64), get("b_reps", np.int64)
                links = met_across(get("low", np.uint8).reshape(-1, VALUES), get("labels", np.int64),
                                   get("b_low", np.uint8).reshape(-1, VALUES), get("b_labels", np.int64), need)
                yield pa.RecordBatch.from_arrays([pa.array(rep[links[:, 0]]), pa.array(other[links[:, 1]])], names=["a", "b"])

    return run


def candidate_links(sets: DataFrame, threshold: float, most: int = BUCKET) -> DataFrame:
    """sets: rep, signature -> a, b: links that span the forest's candidates."""
    # Read from each starting place on: tree t's trie is over the signature from value t * 4 round to the same.
    cells = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = 2 * VALUES // TREES
    need = (threshold - MARGIN) * VALUES
    twice = F.concat("signature", "signature")
    low = F.unhex(F.regexp_replace(F.hex("signature"), "..(..)", "$1"))
    trees = sets.select("rep", low.alias("low"), twice.alias("_s"), F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = trees.select("tree", F.substring(F.col("_s"), F.col("tree") * step + 1, F.lit(2 * KEY_VALUES)).alias("key"), "rep", "low")
    order = ["tree", "key", "rep"]
    found = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _buckets(prefix_length(threshold), need, most), FOUND), "candidates")
    # Blocks of one bucket meet pair by pair; those of a border have mostly no other.
    blocks = found.filter("bucket IS NOT NULL")
    names = blocks.select("bucket", "block", F.pmod("block", F.lit(256)).alias("_b"))
    placed = stored(ranked(names, ["bucket"], "_b", [F.col("block")]).filter("_total > 1").select(
        "bucket", "block", F.col("_rank").alias("rank"), F.col("_total").alias("total")), "blocks")
    data = blocks.select("block", "reps", "low", "labels").join(placed.hint("merge"), "block")
    pairs = placed.select("bucket", F.col("rank").alias("a"), F.explode(F.sequence(F.col("rank"), F.col("total") - 1)).alias("b")).filter("a < b")
    left = data.select("bucket", F.col("rank").alias("a"), "reps", "low", "labels")
    right = data.select("bucket", F.col("rank").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("reps", "low", "labels")])
    across = (pairs.repartition(cells, "bucket", "a").join(left.hint("merge"), ["bucket", "a"])
              .repartition(cells, "bucket", "b").join(right.hint("merge"), ["bucket", "b"]).mapInArrow(_met_blocks(need), "a long, b long"))
    return found.filter("a IS NOT NULL").select("a", "b").union(across).distinct()


def packed_sets(sets) -> tuple[bytes, bytes]:
    """(vocabulary, sets) of a block. A set is its places in the vocabulary,
    which has the most frequent shingles first: sets of near copies are nearly
    runs, and their differences shrink to a small part of the hashes."""
    import numpy as np

    vocabulary, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    at = place[at]
    edges = np.cumsum([0, *map(len, sets)])
    row = np.repeat(np.arange(len(sets)), np.diff(edges))
    at = at[np.lexsort((at, row))]
    return vocabulary[order].tobytes(), zlib.compress(np.diff(at, prepend=np.int32(0)).astype(np.int32).tobytes(), 1)


def places(packed: bytes):
    import numpy as np

    return np.cumsum(np.frombuffer(zlib.decompress(packed), np.int32), dtype=np.int32)


def _blocks(batches):
    """Consecutive rows of one block -> group, block, blocks, ids, copies, edges, vocabulary, sets."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    schema = pa.schema([("group", pa.int64()), ("block", pa.int64()), ("blocks", pa.int64()), *((c, pa.binary()) for c in DATA)])
    now, rows = None, []

    def close():
        sets = [s for _, _, s in rows]
        return dict(zip(("group", "block", "blocks", *DATA), (
            *now, np.array([r for r, _, _ in rows], np.int64).tobytes(), np.array([c for _, c, _ in rows], np.int64).tobytes(),
            np.cumsum([0, *map(len, sets)]).astype(np.int64).tobytes(), *packed_sets(sets))))

    for batch in slices(batches, "text", BATCH):
        done = []
        sets = shingle_sets(batch.column("text"))
        columns = (batch.column(c).to_pylist() for c in ("group", "block", "blocks", "rep", "copies", "name"))
        for group, block, blocks, rep, copies, name, s in zip(*columns, sets):
            if xxhash.xxh3_128_digest(s.tobytes()) != name:
                continue  # another document of that id
            if now != (group, block, blocks):
                if rows:
                    done.append(close())
                now, rows = (group, block, blocks), []
            if not rows or rows[-1][0] != rep:
                rows.append((rep, copies, s))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if rows:
        yield pa.RecordBatch.from_pylist([close()], schema)


def shared_counts(a_words, a, a_edges, b_words, b, b_edges):
    """Sizes of the intersections of all sets of one block with all of another."""
    import numpy as np

    n, m = len(a_edges) - 1, len(b_edges) - 1
    # A shingle of one side only is in no intersection.
    common, in_a, in_b = np.intersect1d(a_words, b_words, assume_unique=True, return_indices=True)
    out = np.zeros((n, m), np.float32)
    sides = []
    for at, edges, here, size in ((a, a_edges, in_a, len(a_words)), (b, b_edges, in_b, len(b_words))):
        column = np.full(size, -1, np.int32)
        column[here] = np.arange(len(common), dtype=np.int32)
        column = column[at]
        hit = np.flatnonzero(column >= 0)
        row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[hit]
        order = np.argsort(column[hit], kind="stable")
        sides.append((row[order], column[hit][order]))
    for first in range(0, len(common), COLUMNS):
        dense = []
        for (row, column), rows in zip(sides, (n, m)):
            lo, hi = np.searchsorted(column, (first, first + COLUMNS))
            part = np.zeros((rows, min(COLUMNS, len(common) - first)), np.float32)
            part[row[lo:hi], column[lo:hi] - first] = 1
            dense.append(part)
        out += dense[0] @ dense[1].T
    return out


def _within(at, edges, size: int):
    """Sets without places from ``size`` on."""
    import numpy as np

    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[at < size]
    return at[at < size], np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(edges) - 1))))


def _verify(threshold: float):
    def run(batches):
        import numpy as np

        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c, t: np.frombuffer(batch.column(c)[i].as_py(), t)
                two = "b_ids" in batch.schema.names and batch.column("b")[i].as_py() != batch.column("a")[i].as_py()
                p = "b_" if two else ""
                ids, other = get("ids", np.int64), get(p + "ids", np.int64)
                edges, b_edges = get("edges", np.int64), get(p + "edges", np.int64)
                words, b_words = get("vocabulary", np.uint64), get(p + "vocabulary", np.uint64)
                at = places(batch.column("sets")[i].as_py())
                b_at = places(batch.column(p + "sets")[i].as_py()) if two else at
                if not two:  # in one block only what two sets have can meet
                    words = b_words = words[:np.searchsorted(-np.bincount(at, minlength=len(words)), -1)]
                    at, edges_in = _within(at, edges, len(words))
                    same = shared_counts(words, at, edges_in, words, at, edges_in)
                else:
                    same = shared_counts(words, at, edges, b_words, b_at, b_edges)
                total = (np.diff(edges)[:, None] + np.diff(b_edges)[None, :]) - same
                mask = same >= threshold * total - 1e-9
                if not two:
                    np.fill_diagonal(mask, False)
                yield link_rows(mask, ids, other, get("copies", np.int64), get(p + "copies", np.int64), not two)
    return run


def _texts_of(placed: DataFrame, rows: DataFrame) -> DataFrame:
    """Members with the text of the row that stands for them: a row meets the
    members of its id and text alone, so null and repeated ids multiply nothing."""
    # Members grow with the corpus: never broadcast, small as they may be at first.
    return rows.join(placed.hint("merge"), F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("mark") == F.col("at_mark"))).select(
        "group", "block", "blocks", "rep", "copies", "name", "text")


def _classified(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """docs: doc_id, text[, row] -> doc_id, name[, row] of each document, and
    name, component, class_id, n_links of each set."""
    cells = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = F.xxhash64("text").alias("mark")  # with the id it names a row's text; what it finds is verified
    rows = docs.select("doc_id", "text", mark)
    others = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
    described = stored(docs.select(*others, "text", mark, F.octet_length("text").alias("size")).mapInArrow(
        tidy(_describe), f"{kinds}, mark long, size int, name binary, signature binary"), "described")
    # Equal rows are counted before sets: of those of a set's text only rows of one id and text are fetched.
    equal = described.filter("name IS NOT NULL").groupBy("name", "doc_id", "mark").agg(
        F.count(F.lit(1)).alias("copies"), F.min("signature").alias("signature"), F.min("size").alias("size"))
    sets = stored(equal.groupBy("name").agg(
        F.min("doc_id").alias("least"), F.sum("copies").alias("copies"), F.min("signature").alias("signature"),
        F.min(F.struct("copies", F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark", "size")).alias("at")), "sets")
    sets = stored(sets.withColumn("rep", F.monotonically_increasing_id()), "sets")

    groups = components(candidate_links(sets.select("rep", "signature"), threshold))
    # Blocks are bounded in bytes: a set of a text of SHORT_TEXT * 2^k bytes is in a block of BLOCK / 2^k.
    longest = BLOCK.bit_length() - 1
    kind = F.least(F.lit(longest), F.greatest(F.lit(0), F.ceil(F.log2(F.col("at.size") / SHORT_TEXT)))).cast("int")
    members = sets.select("rep", "name", "copies", F.col("at.doc_id").alias("at_id"), F.col("at.mark").alias("at_mark"), kind.alias("kind")).join(
        groups.select(F.col("node").alias("rep"), F.col("component").alias("group")), "rep")
    members = members.withColumn("_h", F.pmod(F.xxhash64("rep"), F.lit(1 << 20))).withColumn("_b", F.shiftright("_h", 8))
    each = F.expr(f"shiftright({BLOCK}, kind)")
    of_group = W.partitionBy("group")
    kinds_of = members.groupBy("group", "kind").agg(F.ceil(F.count(F.lit(1)) / each).alias("n")).select(
        "group", "kind", F.sum("n").over(of_group).alias("blocks"),
        F.coalesce(F.sum("n").over(of_group.orderBy("kind").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    placed = stored(ranked(members, ["group", "kind"], "_b", [F.col("_h"), F.col("rep")]).join(kinds_of, ["group", "kind"]).select(
        "rep", "name", "at_id", "at_mark", "copies", "group", "blocks", (F.col("first") + F.floor(F.col("_rank") / each)).alias("block")), "members")
    blocks = stored(_texts_of(placed, rows).repartition(cells, "group", "block").sortWithinPartitions("group", "block", "rep").mapInArrow(
        tidy(_blocks), "group long, block long, blocks long, " + ", ".join(f"{c} binary" for c in DATA)), "blocks")

    alone = blocks.filter("blocks = 1").mapInArrow(tidy(_verify(threshold)), LINKS)
    several = blocks.filter("blocks > 1")
    pairs = several.select("group", F.col("block").alias("a"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("b"))
    left = several.select("group", F.col("block").alias("a"), *DATA)
    right = several.select("group", F.col("block").alias("b"), *[F.col(c).alias(f"b_{c}") for c in DATA])
    # Dealt by the join's own keys, so that neither side is shuffled again.
    across = (pairs.repartition(cells, "group", "a").join(left, ["group", "a"])
              .repartition(cells, "group", "b").join(right, ["group", "b"]).mapInArrow(tidy(_verify(threshold)), LINKS))
    found = stored(alone.union(across), "links")
    discard(blocks, placed)

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = sets.select("rep", "name", "least", "copies").join(classes.withColumnRenamed("node", "rep"), "rep", "left").join(
        links, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = stored(named, "named")
    smallest = named.groupBy("component").agg(F.min("least").alias("class_id"))
    return described, stored(named.join(smallest, "component").select(
        "name", "component", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs: doc_id, text -> doc_id, class_id, n_links, kept, a row a document."""
    described, classes = _classified(docs.select("doc_id", "text"), threshold)
    result = described.select("doc_id", "name").filter("name IS NOT NULL").join(classes, "name").select("doc_id", "class_id", "n_links")
    lone = described.filter("name IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return result.union(lone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def surplus_rows(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs: doc_id, text, row (long, one a row) -> row: all rows of each class but one.

    The one has the smallest id, known before null; of several rows with it the
    smallest set and row. Documents without a word are classes of their own.
    """
    described, classes = _classified(docs.select("doc_id", "text", "row"), threshold)
    rows = stored(described.filter("name IS NOT NULL").join(classes.select("name", "component"), "name").select(
        "component", "row", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "name", "row").alias("_order")), "rows")
    first = rows.groupBy("component").agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    # A row of each class of several: it grows with the corpus, so it is never broadcast.
    several = first.select("component", F.col("_first.row").alias("_kept"))
    return rows.select("component", "row").join(several.hint("merge"), "component").filter("row <> _kept").select("row")


def op2_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id, n_links, kept."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach(doc_id, to_id) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.to_id),
comp AS (SELECT doc_id, min(to_id) AS class_id FROM reach GROUP BY doc_id),
k AS (SELECT a, count(*) AS k FROM link GROUP BY a)
SELECT comp.doc_id, class_id, coalesce(k, 0)::BIGINT AS n_links, comp.doc_id = class_id AS kept
FROM comp LEFT JOIN k ON k.a = comp.doc_id
"""
