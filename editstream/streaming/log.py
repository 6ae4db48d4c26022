"""A keyed log on files, and a streaming source that reads it by offsets.

A log folder holds segments ``<partition>-<from>-<to>``: a folder with the
records from offset ``from`` up to ``to`` of one partition, in order. A segment
gets its name once it is written, and names alone say what the log holds, so

- the source finds the ends of all partitions by listing one folder;
- a batch is a range of offsets for each partition, kept in the query's
  checkpoint: a restart goes on where the last batch ended;
- at most ``max_records`` records are admitted a batch, shared out in proportion
  to what each partition has waiting;
- ``start="latest"`` leaves out what is in the log when a query first starts.

Tasks read their ranges from the segments themselves and yield Arrow batches; a
range longer than ``TASK_RECORDS`` is read by several tasks, so a hot partition
is not one task. Nothing but names passes through the driver.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import storage
from ..operators.numbering import numbered
from ..session import scratch_dir

#: A record of the keyed log.
RECORD = "key string, value string, partition int, offset long"
SEGMENT_RECORDS = 250_000
TASK_RECORDS = 250_000
_NAME = re.compile(r"(\d+)-(\d{20})-(\d{20})")


def segment_names(names) -> dict[int, list[tuple[int, int, str]]]:
    """(from, to, name) of each partition's segments, in order, without a gap."""
    found: dict[int, list[tuple[int, int, str]]] = {}
    for name in names:
        match = _NAME.fullmatch(name)
        if match:
            found.setdefault(int(match[1]), []).append((int(match[2]), int(match[3]), name))
    for partition, segments in found.items():
        segments.sort()
        for k in range(1, len(segments)):
            if segments[k][0] != segments[k - 1][1]:
                del segments[k:]      # a later one was named first; its turn comes
                break
    return found


def admit(start: dict[int, int], end: dict[int, int], most: int) -> dict[int, int]:
    """How far each partition may be read: ``most`` records in all, in proportion
    to what waits; what rounding leaves goes to the first partitions that have more."""
    waiting = {p: max(0, to - start.get(p, 0)) for p, to in end.items()}
    total = sum(waiting.values())
    if total <= most:
        share = waiting
    else:
        share = {p: n * most // total for p, n in waiting.items()}
        left = most - sum(share.values())
        for p in sorted(waiting):
            more = min(left, waiting[p] - share[p])
            share[p], left = share[p] + more, left - more
    return {p: start.get(p, 0) + share.get(p, 0) for p in {*start, *end}}


def _filesystem(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub("^file:", "", path)


class Range(InputPartition):
    """Offsets ``start`` to ``end`` of one segment."""

    def __init__(self, path: str, name: str, partition: int, first: int, start: int, end: int):
        self.path, self.name, self.partition, self.first, self.start, self.end = path, name, partition, first, start, end


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, most: int, latest: bool):
        self.path, self.most, self.latest = path, most, latest
        self.at: dict | None = None   # end of the last planned batch

    def _segments(self) -> dict[int, list[tuple[int, int, str]]]:
        from pyarrow import fs

        files, root = _filesystem(self.path)
        listed = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return segment_names(i.base_name for i in listed)

    def _ends(self) -> dict[int, int]:
        return {p: segments[-1][1] for p, segments in self._segments().items()}

    @staticmethod
    def _numbers(offset: dict) -> dict[int, int]:
        return {int(p): n for p, n in offset.items()}

    @staticmethod
    def _offset(ends: dict[int, int]) -> dict:
        return {str(p): ends[p] for p in sorted(ends)}

    def initialOffset(self) -> dict:
        self.at = self._offset(self._ends() if self.latest else {})
        return self.at

    def latestOffset(self) -> dict:
        if self.at is None:
            self.initialOffset()
        self.at = self._offset(admit(self._numbers(self.at), self._ends(), self.most))
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Range]:
        # After a restart Spark plans the last batch of the checkpoint again: its end is where to go on.
        if self.at is None:
            self.at = end
        begin, out = self._numbers(start), []
        segments = self._segments()
        for p, upto in self._numbers(end).items():
            for first, to, name in segments.get(p, []):
                at, stop = max(first, begin.get(p, 0)), min(to, upto)
                for k in range(at, stop, TASK_RECORDS):
                    out.append(Range(self.path, name, p, first, k, min(k + TASK_RECORDS, stop)))
        return out

    def commit(self, end: dict) -> None:
        if self.at is None:
            self.at = end

    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        files, root = _filesystem(partition.path)
        listed = files.get_file_info(fs.FileSelector(f"{root}/{partition.name}"))
        (name,) = [i.path for i in listed if i.base_name.endswith(".parquet") and not i.base_name.startswith(("_", "."))]
        with files.open_input_file(name) as source:
            table, offset = pq.ParquetFile(source), partition.first
            for group in range(table.num_row_groups):
                rows = table.metadata.row_group(group).num_rows
                if offset + rows > partition.start and offset < partition.end:
                    at = offset
                    for batch in table.iter_batches(row_groups=[group], columns=["key", "value"]):
                        skip = max(0, partition.start - at)
                        part = batch.slice(skip, max(0, min(batch.num_rows, partition.end - at) - skip))
                        if part.num_rows:
                            begin = at + skip
                            yield pa.RecordBatch.from_arrays(
                                [part.column("key"), part.column("value"),
                                 pa.array([partition.partition] * part.num_rows, pa.int32()),
                                 pa.array(range(begin, begin + part.num_rows), pa.int64())],
                                names=["key", "value", "partition", "offset"])
                        at += batch.num_rows
                offset += rows


class LogSource(DataSource):
    """Options: ``path``, ``max_records`` (required), ``start`` (``latest`` or ``earliest``)."""

    @classmethod
    def name(cls) -> str:
        return "edit_log"

    def schema(self) -> str:
        return RECORD

    def streamReader(self, schema: StructType) -> LogReader:
        start = self.options.get("start", "latest")
        if start not in ("latest", "earliest"):
            raise ValueError(f"unknown start: {start}")
        return LogReader(self.options["path"].rstrip("/"), int(self.options["max_records"]), start == "latest")


def read_log(spark: SparkSession, path: str, max_records: int, start: str = "latest") -> DataFrame:
    """The log as a stream of ``RECORD``."""
    spark.dataSource.register(LogSource)
    return (spark.readStream.format("edit_log").option("path", path).option("max_records", max_records)
            .option("start", start).load())


def log_ends(spark: SparkSession, path: str) -> dict[int, int]:
    """The end of each partition of a log."""
    return {p: s[-1][1] for p, s in segment_names(storage.names(spark, path)).items()}


def drain(query: StreamingQuery, spark: SparkSession, path: str, patience: float = 600) -> None:
    """Waits until the query has read what the log holds now, then stops it;
    raises the query's error, or one if nothing moves for ``patience`` seconds."""
    wanted, seen, since = log_ends(spark, path), None, time.monotonic()
    try:
        while True:
            if query.exception() is not None:
                raise query.exception()
            end = (query.lastProgress or {}).get("sources", [{}])[0].get("endOffset")
            if end != seen:
                seen, since = end, time.monotonic()
            read = {int(p): int(n) for p, n in re.findall(r"'?\"?(\d+)\"?'?: (\d+)", str(end or ""))}
            if all(read.get(p, 0) >= n for p, n in wanted.items()):
                return
            if time.monotonic() - since > patience:
                raise TimeoutError(f"{query.name} stays at {end} of {wanted}")
            time.sleep(0.1)
    finally:
        query.stop()


def append_log(records: DataFrame, order: list[str], path: str, segment: int = SEGMENT_RECORDS) -> None:
    """Appends records (key, value, partition and the columns of ``order``) to a log.

    Offsets go on from each partition's end. Segments hold ``segment`` records,
    so a hot partition is written by many tasks, and are named in the order of
    their offsets. One writer at a time.
    """
    spark = records.sparkSession
    path = path.rstrip("/")
    ends = log_ends(spark, path)
    rows = numbered(records, ["partition", *order], {"offset": ["partition"]})
    begin = F.lit(0).cast("long")
    if ends:
        begin = F.coalesce(F.create_map(*[F.lit(x) for p, n in ends.items() for x in (p, n)])[F.col("partition")], begin)
    first = begin + F.floor(F.col("offset") / segment) * segment
    last = F.least(first + segment, begin + F.col("offset_of"))
    name = F.format_string("%d-%020d-%020d", "partition", first.cast("long"), last.cast("long"))
    staged = scratch_dir(spark, "segments")
    (rows.select("key", "value", F.col("offset").alias("at"), name.alias("of")).repartition("of")
     .sortWithinPartitions("of", "at").drop("at").write.option("maxRecordsPerFile", 0).partitionBy("of").parquet(staged))
    for folder in sorted((n for n in storage.names(spark, staged) if n.startswith("of=")),
                         key=lambda n: [int(x) for x in n[3:].split("-")]):
        storage.rename(spark, f"{staged}/{folder}", f"{path}/{folder[3:]}")
