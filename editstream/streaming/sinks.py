"""Keyed upsert tables on plain Parquet, fed by ``foreachBatch``.

Rows lie in folders that are written once and never changed. A manifest names
the folders that make up the table; publishing a version is giving the next
manifest its name. So

- a batch counts from the moment its manifest has its name: a crash before that
  leaves a folder nobody reads, and the batch is delivered and written again;
- versions count up with the table, not with a query's batch ids: a query that
  starts anew on an old table (fresh checkpoint, batch 0) writes newer
  versions. A batch that its query had published is skipped;
- several queries may write to one table: who finds the next version taken reads
  the manifest again and publishes on top of it;
- a reader keeps the folders of the manifest it opened, whatever is compacted
  meanwhile; ``vacuum`` deletes what the last few manifests do not name.

The base holds one row a key. What was written since is the delta, whose bytes
the manifest counts: the sink folds it into the base before it passes
``DELTA_BYTES``, part by part (for metrics: days of windows), so that only parts
that new rows touch are rewritten. A read reduces the delta alone. Rows of the
base are taken as they lie unless the delta has their key, which a broadcast of
the delta's keys decides: no aggregate and no shuffle over the base. A delta
past the bound (a single huge batch, a table written without a sink) is met by
a shuffle instead.

Rows of a key replace each other; with ``by_cell`` cells do: queries that write
different cells of a key (others null) merge, and a null never replaces a value.
Reduction, folding and writing are distributed; the driver sees manifests.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.snapshot import latest_by
from ..schemas import ARRIVAL_ORDER, ENRICHED_COLUMNS, LIVE_COLUMNS

VERSION_COL = "_version"
PART_COL = "_part"
QUERY_ID = "sql.streaming.queryId"
KEPT_MANIFESTS = 8
DELTA_BYTES = 16 << 20     # Parquet bytes of the delta; its keys alone are broadcast
PUBLISH_TRIES = 100
EMPTY = {"version": 0, "base": {}, "base_version": 0, "recent": [], "recent_bytes": 0, "batches": {}}
_PUBLISHING = threading.Lock()   # for the writers of one driver, beside the manifest's name


class UpsertTable:
    """``part``: which part of the table a row belongs to; one if not given.
    ``by_cell``: the cells' types, if cells merge one by one."""

    def __init__(self, path: str, key: list[str], cells: list[str], order: list[str] | None = None,
                 cluster_desc: list[str] | None = None, compact_every: int | None = None,
                 part: Column | None = None, by_cell: dict[str, str] | None = None):
        self.path = path.rstrip("/")
        self.compact_every = compact_every
        self.key = list(key)
        self.cells = list(cells)
        self.order = list(order or [])
        self.part = part
        self.by_cell = by_cell
        # Rows are written sorted by key (these key columns newest first), so
        # Parquet row-group statistics let a `wiki = ...` read skip groups.
        self.cluster = [F.desc(c) if c in (cluster_desc or []) else F.asc(c) for c in self.key]

    # -- manifests ------------------------------------------------------------
    def _versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(n[1:-5]) for n in storage.names(spark, f"{self.path}/manifests")
                      if n.startswith("v") and n.endswith(".json"))

    def manifest(self, spark: SparkSession) -> dict:
        versions = self._versions(spark)
        return self._manifest(spark, versions[-1]) if versions else json.loads(json.dumps(EMPTY))

    def _manifest(self, spark: SparkSession, version: int) -> dict:
        return json.loads(storage.read_text(spark, f"{self.path}/manifests/v{version}.json"))

    def _publish(self, spark: SparkSession, manifest: dict) -> bool:
        return storage.create_text(spark, f"{self.path}/manifests/v{manifest['version']}.json", json.dumps(manifest))

    def _commit(self, spark: SparkSession, change: Callable[[dict], bool]) -> int | None:
        """Publishes ``change`` of the newest manifest; again, if another writer was first.
        None if there is nothing to change any more."""
        for _ in range(PUBLISH_TRIES):
            with _PUBLISHING:
                manifest = self.manifest(spark)
                if not change(manifest):
                    return None
                manifest["version"] += 1
                if self._publish(spark, manifest):
                    return manifest["version"]
        raise RuntimeError(f"{self.path}: other writers were first {PUBLISH_TRIES} times")

    # -- write side ---------------------------------------------------------
    def reduce(self, batch: DataFrame) -> DataFrame:
        if not self.order:
            cells = [F.col(c) if c in batch.columns or not self.by_cell else F.lit(None).cast(self.by_cell[c]).alias(c)
                     for c in self.cells]
            return batch.select(*self.key, *cells)
        cols = list(dict.fromkeys(self.cells + self.order))
        return latest_by(batch, self.key, self.order, cols)

    def _write(self, rows: DataFrame) -> str:
        folder = f"rows-{uuid.uuid4().hex}"
        rows.sortWithinPartitions(*self.cluster).write.parquet(f"{self.path}/{folder}")
        return folder

    def write_batch(self, batch: DataFrame, batch_id: int, query_id: str = "") -> None:
        spark = batch.sparkSession
        if self.manifest(spark)["batches"].get(query_id, -1) >= batch_id:
            return  # published before a restart
        # Rows of a version are told apart by their folder's place in the manifest.
        folder = self._write(self.reduce(batch))
        size = storage.size(spark, f"{self.path}/{folder}")

        def change(manifest: dict) -> bool:
            if manifest["batches"].get(query_id, -1) >= batch_id:
                return False
            manifest["recent"].append([folder, manifest["version"] + 1])
            manifest["recent_bytes"] += size
            manifest["batches"][query_id] = batch_id
            return True

        self._commit(spark, change)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self.write_batch(batch, batch_id, spark.sparkContext.getLocalProperty(QUERY_ID) or "")
        due = self.compact_every and (batch_id + 1) % self.compact_every == 0
        if due or self.manifest(spark)["recent_bytes"] > DELTA_BYTES:
            self.compact(spark)
            self.vacuum(spark)

    # -- read side ----------------------------------------------------------
    def _base(self, spark: SparkSession, manifest: dict, parts: list[str] | None = None) -> DataFrame | None:
        folders = [f"{self.path}/{f}" for p, f in manifest["base"].items() if parts is None or p in parts]
        return spark.read.parquet(*folders) if folders else None

    def _recent(self, spark: SparkSession, manifest: dict) -> DataFrame | None:
        """Rows of the delta with their version."""
        out = None
        if manifest["recent"]:
            versions = F.create_map(*[F.lit(x) for f, v in manifest["recent"] for x in (f, v)])
            rows = spark.read.parquet(*[f"{self.path}/{f}" for f, _ in manifest["recent"]])
            folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            out = rows.withColumn(VERSION_COL, versions[folder].cast("long"))
        return out

    def _folded(self, rows: DataFrame, cells: list[str]) -> DataFrame:
        """One row a key of rows with versions, which hold at most one row a key."""
        if not self.by_cell:
            return latest_by(rows, self.key, [VERSION_COL], cells)
        # max_by leaves out rows of null order: the newest value that is one.
        newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(VERSION_COL))).alias(c) for c in cells]
        return rows.groupBy(*self.key).agg(*newest)

    def _merged(self, base: DataFrame | None, recent: DataFrame | None, cells: list[str], size: int) -> DataFrame:
        if recent is None:
            return base.select(*self.key, *cells)
        recent = recent.select(*self.key, *cells, VERSION_COL)
        if base is None:
            return self._folded(recent, cells)
        base = base.select(*self.key, *cells)
        keys = recent.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.key)])
        keys = F.broadcast(keys) if size <= DELTA_BYTES else keys
        same = [base[k].eqNullSafe(keys[f"_k{i}"]) for i, k in enumerate(self.key)]
        if self.by_cell:
            old = base.join(keys, same, "left_semi").withColumn(VERSION_COL, F.lit(0).cast("long"))
            recent = recent.unionByName(old)
        return base.join(keys, same, "left_anti").unionByName(self._folded(recent, cells))

    def read(self, spark: SparkSession, columns: list[str] | None = None) -> DataFrame:
        """Current table. Only the cells of ``columns`` are read."""
        manifest = self.manifest(spark)
        base, recent = self._base(spark, manifest), self._recent(spark, manifest)
        if base is None and recent is None:
            raise ValueError(f"no version of {self.path} is published yet")
        wanted = [c for c in self.cells if columns is None or c in columns]
        return self._merged(base, recent, wanted, manifest["recent_bytes"])

    # -- maintenance ----------------------------------------------------------
    def compact(self, spark: SparkSession) -> int | None:
        """Folds the delta into the parts of the base that it touches.
        Returns the new version, or None if there is nothing to fold."""
        seen = self.manifest(spark)
        if not seen["recent"]:
            return None
        part = (self.part if self.part is not None else F.lit(0)).cast("string")
        recent = self._recent(spark, seen)
        touched = [r[0] for r in recent.select(part.alias("p")).distinct().collect()]  # days, or one part
        cells = [c for c in recent.columns if c not in self.key and c != VERSION_COL]
        folded = self._merged(self._base(spark, seen, touched), recent, cells, seen["recent_bytes"]).withColumn(PART_COL, part)
        folder = f"base-{uuid.uuid4().hex}"
        # Files follow each other in the order of their rows: a key is looked for in one of many.
        folded.repartitionByRange(F.col(PART_COL), *self.cluster).sortWithinPartitions(
            PART_COL, *self.cluster).write.partitionBy(PART_COL).parquet(f"{self.path}/{folder}")

        def change(manifest: dict) -> bool:
            if manifest["base_version"] != seen["base_version"]:
                return False  # another writer folded the same rows
            manifest["base"].update({p: f"{folder}/{PART_COL}={p}" for p in touched})
            manifest["recent"] = [r for r in manifest["recent"] if r not in seen["recent"]]
            manifest["recent_bytes"] -= seen["recent_bytes"]
            manifest["base_version"] = manifest["version"] + 1
            return True

        return self._commit(spark, change)

    def vacuum(self, spark: SparkSession, keep: int = KEPT_MANIFESTS) -> None:
        """Deletes manifests but the last ``keep``, and rows that the manifest before these named
        and these do not. Rows that no manifest names yet may belong to another writer's batch."""
        with _PUBLISHING:
            versions = self._versions(spark)
            if len(versions) <= keep:
                return
            named = [{f.split("/")[0] for f in [*m["base"].values(), *(r[0] for r in m["recent"])]}
                     for m in (self._manifest(spark, v) for v in versions)]
            for name in set().union(*named[:-keep]) - set().union(*named[-keep:]):
                storage.delete(spark, f"{self.path}/{name}")
            for v in versions[:-keep]:
                storage.delete(spark, f"{self.path}/manifests/v{v}.json")


LOG_ORDER = ["partition", "offset"]


def arrival_order(columns: list[str]) -> list[str]:
    """Arrival order within a batch: the log position when the source carries
    it (one wiki -> one partition, so offsets order its edits), then the
    ingestion second and the event id."""
    return [*(LOG_ORDER if all(c in columns for c in LOG_ORDER) else []), *ARRIVAL_ORDER]


def live_table(path: str, order: list[str] | None = None, compact_every: int | None = None) -> UpsertTable:
    """Latest edit per wiki (12 cells), arrival order within a batch (an empty
    order: batches hold a row a wiki)."""
    return UpsertTable(path, ["wiki"], LIVE_COLUMNS, ARRIVAL_ORDER if order is None else order, compact_every=compact_every)


def enriched_table(path: str, order: list[str] | None = None,
                   compact_every: int | None = None) -> UpsertTable:
    """Latest enriched edit per wiki (9 cells)."""
    return UpsertTable(path, ["wiki"], ENRICHED_COLUMNS, order or ARRIVAL_ORDER, compact_every=compact_every)


def metric_table(path: str, compact_every: int | None = None) -> UpsertTable:
    """Per (wiki, window_end_epoch): count and average. Update mode re-emits a
    changed window with its full current values, so the newest batch wins.
    Parts are days of window ends: compaction leaves closed days alone."""
    return UpsertTable(path, ["wiki", "window_end_epoch"], ["edit_count", "avg_delta"],
                       cluster_desc=["window_end_epoch"], compact_every=compact_every,
                       part=F.floor(F.col("window_end_epoch") / 86400))


def metric_cell_table(path: str, compact_every: int | None = None) -> UpsertTable:
    """The same table for two writers, one of the counts and one of the averages."""
    return UpsertTable(path, ["wiki", "window_end_epoch"], ["edit_count", "avg_delta"],
                       cluster_desc=["window_end_epoch"], compact_every=compact_every,
                       part=F.floor(F.col("window_end_epoch") / 86400),
                       by_cell={"edit_count": "bigint", "avg_delta": "double"})
