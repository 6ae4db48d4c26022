"""Near-duplicate vectors by an epsilon grid order join.

Cosine c between unit vectors is a distance of sqrt(2 - 2c), so the join is for
distance ``eps``. Equal vectors are counted once and stand for their copies.

1. Unit vectors are turned to the corpus's principal directions (from the sum
   of outer products: dim^2 numbers, all that the driver sees) and sorted by
   the grid cell, of side eps, of the leading directions, then by the
   coordinates, so that one full cell still splits over tasks.
2. The sequence is cut into blocks, and these into groups of consecutive blocks
   that a task can hold. An interval has the box of its vectors' leading
   coordinates and of the length left in the other directions. Pairs of
   intervals are split into pairs of their parts, level by level down to
   groups; a pair whose boxes are more than eps apart is dropped: no rotation
   changes distances, so such vectors cannot link.
3. A pair of groups is a cell. A block goes once to each cell of its group, but
   to none whose other group's box is more than eps from the block's own. A
   task holds a cell's first group and streams the second past it, so what is
   shuffled is the blocks times the groups near them, not a block a pair.
4. Blocks are compared in double precision, in parts with boxes of their own.
   Each comparison returns every linked vector's number of links and one
   vector that its links lead to: a row a vector, however dense they are.
5. Components come from these rows; copies take what stands for them.

Where the leading directions hold little of the spread (even data in many
dimensions), no box proves anything and all groups meet; that is the join's
nature and not bounded by dropping pairs.

Defined cases: vectors that are null, zero, empty, or hold null or non-finite
components link with nothing and are their own component; different dimensions
do not link; repeated rows are copies that link to each other; a null id is
kept, but is no component's name unless no id is known; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import group_offsets, read_table, stored
from .vectors import matrices, usable

COSINE = 0.9
LEADING = 8
BLOCK = 1024
BLOCK_BYTES = 4 << 20
"""Vectors of a block, and bytes of them in doubles (one vector at least)."""
GROUP_BYTES = 32 << 20
"""Bytes in doubles of a cell's first group; a task holds up to twice that."""
PART = 128
FAN = 8
SLACK = 1e-9


def _unit(m):
    """Rows scaled to length 1, without overflow or underflow on the way."""
    import numpy as np

    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _directions(rows: DataFrame) -> dict:
    """Orthogonal directions of each dimension, most spread first."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        sums = {}
        for batch in batches:
            for _, m in matrices(batch, "v", 4096):
                u = _unit(m)
                sums[m.shape[1]] = sums.get(m.shape[1], 0) + u.T @ u
        out = [{"dim": d, "at": i, "x": float(x)} for d, s in sums.items() for i, x in enumerate(s.ravel())]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("x", pa.float64())]))

    sums = {}
    for r in rows.mapInArrow(run, "dim int, at int, x double").groupBy("dim", "at").agg(F.sum("x").alias("x")).collect():
        sums.setdefault(r["dim"], np.zeros(r["dim"] ** 2))[r["at"]] = r["x"]
    # Any orthogonal basis keeps distances, so rounding here costs no pair.
    return {d: np.linalg.eigh(s.reshape(d, d))[1][:, ::-1] for d, s in sums.items()}


def _coordinates(u, basis, leading: int):
    """Leading coordinates and the length left in the others (0 where there are none)."""
    import numpy as np

    x = u @ basis[:, :leading]
    rest = np.sqrt(np.maximum(1 - (x * x).sum(1, keepdims=True), 0))
    lead = np.zeros((len(u), leading))
    lead[:, :x.shape[1]] = x
    return np.hstack([lead, rest])


def _sequence(reps: DataFrame, basis: dict, eps: float) -> DataFrame:
    """reps (rep, copies, v) with coordinates x and their grid cells."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for rows, m in matrices(batch, "v", 4096):
                x = _coordinates(_unit(m), basis[m.shape[1]], LEADING)
                cells = np.floor(x[:, :LEADING] / eps).astype(np.int32)
                part = batch.take(pa.array(rows))
                out.append(pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([m.shape[1]] * len(rows), pa.int32()),
                     pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), LEADING).cast(pa.list_(pa.int32())),
                     pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), LEADING + 1).cast(pa.list_(pa.float64()))],
                    names=[*part.schema.names, "dim", "cell", "x"]))
            yield from out

    return reps.mapInArrow(run, "rep long, copies long, v array<double>, dim int, cell array<int>, x array<double>")


def _blocks(sequence: DataFrame, narrow: bool) -> DataFrame:
    """Blocks of consecutive rows: block (its number), dim, n, ids, copies, m,
    parts (boxes of PART rows each), low, high. ``narrow``: the vectors are floats."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        schema = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("dim", pa.int32()), ("n", pa.int64()), ("ids", pa.binary()),
                            ("copies", pa.binary()), ("m", pa.binary()), ("parts", pa.binary()),
                            ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
        for batch in batches:
            ids = batch.column("rep").to_numpy()
            copies = batch.column("copies").to_numpy()
            x = batch.column("x").flatten().to_numpy().reshape(-1, LEADING + 1)
            out = []
            for rows, m in matrices(batch, "v", BLOCK):
                step = max(1, BLOCK_BYTES // (8 * m.shape[1]))
                for i in range(0, len(rows), step):
                    mine = rows[i:i + step]
                    edges = np.arange(0, len(mine), PART)
                    low, high = np.minimum.reduceat(x[mine], edges), np.maximum.reduceat(x[mine], edges)
                    vectors = m[i:i + step].astype(np.float32) if narrow else m[i:i + step]
                    out.append({"part": part, "at": at, "dim": m.shape[1], "n": len(mine), "ids": ids[mine].tobytes(),
                                "copies": copies[mine].tobytes(), "m": vectors.tobytes(),
                                "parts": np.stack([low, high]).tobytes(), "low": low.min(0).tolist(), "high": high.max(0).tolist()})
                    at += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    cut = stored(sequence.mapInArrow(run, "part int, at long, dim int, n long, ids binary, copies binary, m binary, parts binary, "
                                          "low array<double>, high array<double>"), "blocks")
    offsets = group_offsets(cut.select("part"), [], "part")
    return cut.join(offsets, "part").withColumn("block", F.col("_before") + F.col("at")).drop("part", "at", "_before", "_total")


def _near(eps: float):
    """Boxes a and b are at most eps apart (and of one dimension)."""
    gap = F.zip_with(F.col("a.low"), F.col("b.high"), lambda x, y: F.greatest(x - y, F.lit(0.0)))
    other = F.zip_with(F.col("b.low"), F.col("a.high"), lambda x, y: F.greatest(x - y, F.lit(0.0)))
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)
    return (square(gap) + square(other) <= (eps + SLACK) ** 2) & (F.col("a.dims")[0] <= F.col("b.dims")[1]) & (F.col("b.dims")[0] <= F.col("a.dims")[1])


def _boxes(rows: DataFrame, at) -> DataFrame:
    """at, dims, low, high: the box around the boxes of each interval."""
    edge = lambda f, c: F.array(*[f(F.col(c)[i]) for i in range(LEADING + 1)]).alias(c)
    return rows.groupBy(at.alias("at")).agg(F.array(F.min(F.col("dims")[0]), F.max(F.col("dims")[1])).alias("dims"),
                                            edge(F.min, "low"), edge(F.max, "high"))


def _group_pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """Pairs a <= b of groups (boxes: at, dims, low, high) that the boxes do not keep apart."""
    count = boxes.count()
    levels = max(1, math.ceil(math.log(max(count, 2), FAN) - 1e-9))
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in range(levels - 1, -1, -1):
        wider = _boxes(boxes, F.floor(F.col("at") / FAN ** level).cast("long")) if level else boxes
        inside = F.sequence(F.lit(0), F.lit(FAN - 1))
        split = (pairs.withColumn("_i", F.explode(inside)).withColumn("_j", F.explode(inside))
                 .select((F.col("a") * FAN + F.col("_i")).alias("a"), (F.col("b") * FAN + F.col("_j")).alias("b"))
                 .filter(F.col("a") <= F.col("b")))
        pairs = (split.alias("p").join(wider.alias("a"), F.col("p.a") == F.col("a.at"))
                 .join(wider.alias("b"), F.col("p.b") == F.col("b.at")).filter(_near(eps)).select("p.a", "p.b"))
        pairs = stored(pairs, "pairs")
    return pairs


def _cells(blocks: DataFrame, eps: float, cells: int) -> DataFrame:
    """Blocks beside the cells (a, b) they go to; side 0 is held, side 1 streams past."""
    blocks = blocks.withColumn("dims", F.array("dim", "dim"))
    most = blocks.agg(F.count(F.lit(1)).alias("n"), F.max(F.col("n") * F.col("dim") * 8).alias("bytes")).first()
    # As many groups as give each task some cells; more where a task could not hold one.
    size = max(1, min(GROUP_BYTES // max(most["bytes"] or 1, 1), most["n"] // math.ceil(2 * math.sqrt(cells))))
    blocks = stored(blocks.withColumn("group", F.floor(F.col("block") / size).cast("long")), "sequence")
    boxes = stored(_boxes(blocks, F.col("group")), "boxes")
    pairs = _group_pairs(boxes, eps)
    sides = pairs.select(F.col("a").alias("own"), F.col("b").alias("other"), "a", "b", F.lit(0).alias("side")).union(
        pairs.filter("a < b").select("b", "a", "a", "b", F.lit(1)))
    sides = sides.join(boxes, F.col("other") == F.col("at"))
    return (blocks.alias("a").join(sides.alias("b"), F.col("a.group") == F.col("b.own")).filter(_near(eps))
            .select("b.a", "b.b", "side", "block", "dim", "ids", "copies", "m", "parts"))


def joint(mask, left, right, same: bool):
    """For rows and columns with a link: an id that all that the links connect share."""
    import numpy as np

    rows, columns = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    if not len(rows):
        return rows, left[:0], columns, left[:0]
    part = mask[np.ix_(rows, columns)]
    if same:
        part = part | (rows[:, None] == columns[None, :])  # a row and its column are one
    none = np.int32(len(rows))
    label = np.arange(len(rows), dtype=np.int32)
    while True:
        column = np.where(part, label[:, None], none).min(0)
        new = np.where(part, column[None, :], none).min(1)
        if (new == label).all():
            return rows, left[rows[label]], columns, left[rows[column]]
        label = new


def link_rows(mask, ids, other, copies, other_copies, same: bool):
    """A row for each id with a link: its links here, and an id of what the links connect."""
    import numpy as np
    import pyarrow as pa

    rows, root, columns, other_root = joint(mask, ids, other, same)
    found = [(ids[rows], (mask[rows] @ other_copies), root)]
    if not same:
        found.append((other[columns], copies @ mask[:, columns], other_root))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)], names=["rep", "links", "root"])


LINKS = "rep long, links long, root long"


def _cosine(x, y) -> float:
    """From the vectors as they came, each sum rounded once; powers of two keep it in range."""
    import numpy as np

    x, y = (np.ldexp(v.astype(np.float64), -int(np.frexp(np.abs(v).max())[1])) for v in (x, y))
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def _linked(a, b, raw, raw_b, cosine: float):
    """Pairs of rows with the cosine or more; pairs near the edge are computed anew."""
    import numpy as np

    c = a @ b.T
    mask = c >= cosine
    for i, j in np.argwhere(np.abs(c - cosine) < 1e-12):
        mask[i, j] = _cosine(raw[i], raw_b[j]) >= cosine
    return mask


def _block(row: dict, kind) -> dict:
    import numpy as np

    low, high = np.frombuffer(row["parts"], np.float64).reshape(2, -1, LEADING + 1)
    raw = np.frombuffer(row["m"], kind).reshape(-1, row["dim"])
    return {"dim": row["dim"], "ids": np.frombuffer(row["ids"], np.int64), "copies": np.frombuffer(row["copies"], np.int64),
            "raw": raw, "m": _unit(raw.astype(np.float64)), "low": low, "high": high}


def _pair(a: dict, b: dict, cosine: float, eps: float, size: int):
    """Which rows of a and b link; parts whose boxes are apart are not compared (parts of ``size`` rows)."""
    import numpy as np

    mask = np.zeros((len(a["ids"]), len(b["ids"])), bool)
    for p in range(len(a["low"])):
        gap = np.maximum(a["low"][p] - b["high"], 0) + np.maximum(b["low"] - a["high"][p], 0)
        near = (gap * gap).sum(1) <= (eps + SLACK) ** 2
        rows = slice(p * size, (p + 1) * size)
        # Neighbouring parts go in one product.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], near, [0]))))
        for start, end in edges.reshape(-1, 2) * size:
            mask[rows, start:end] = _linked(a["m"][rows], b["m"][start:end], a["raw"][rows], b["raw"][start:end], cosine)
    return mask


def _compare(cosine: float, eps: float, narrow: bool):
    def run(batches):
        import numpy as np

        cell, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if (row["a"], row["b"]) != cell:
                    cell, held = (row["a"], row["b"]), []
                block, own = _block(row, np.float32 if narrow else np.float64), row["a"] == row["b"]
                if own or row["side"]:
                    for other in held:
                        if other["dim"] == block["dim"]:
                            mask = _pair(other, block, cosine, eps, PART)
                            if mask.any():
                                yield link_rows(mask, other["ids"], block["ids"], other["copies"], block["copies"], False)
                if own:
                    mask = _pair(block, block, cosine, eps, PART)
                    np.fill_diagonal(mask, False)
                    yield link_rows(mask, block["ids"], block["ids"], block["copies"], block["copies"], True)
                if not row["side"]:
                    held.append(block)
    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vectors: vec_id, embedding -> vec_id, n_links, component_id, kept; for
    cosines above 0."""
    eps = math.sqrt(2 - 2 * cosine)
    spark = vectors.sparkSession
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select("vec_id", "embedding")
    able = usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    v = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # -0 is 0
    marked = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.coalesce(able, F.lit(False)), v).alias("v"))
    good = marked.filter(F.col("v").isNotNull())
    # Copies: one row a distinct vector, counted before the shuffle.
    groups = stored(good.groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
                    .withColumn("rep", F.xxhash64("v")), "distinct")
    if groups.select("rep").distinct().count() != groups.count():
        groups = stored(groups.withColumn("rep", F.monotonically_increasing_id()), "distinct")
    sequence = _sequence(groups.select("rep", "copies", "v"), _directions(groups), eps)
    sequence = sequence.repartitionByRange(cells, "dim", "cell", "x", "rep").sortWithinPartitions("dim", "cell", "x", "rep")
    narrow = rows.schema["embedding"].dataType.elementType.simpleString() == "float"
    dealt = _cells(_blocks(sequence, narrow), eps, cells).repartition(cells, "a", "b").sortWithinPartitions("a", "b", "side", "block")
    found = stored(dealt.mapInArrow(_compare(cosine, eps, narrow), LINKS), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = groups.join(classes.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    least = stored(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    classes = stored(named.join(least, "component").select(
        "v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    result = marked.filter(F.col("v").isNotNull()).join(classes, "v").select("vec_id", "n_links", "component_id")
    alone = marked.filter(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def op8_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, to_id) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.to_id),
comp AS (SELECT vec_id, min(to_id) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, c.vec_id = component_id AS kept
FROM comp c LEFT JOIN n ON n.a = c.vec_id
"""
