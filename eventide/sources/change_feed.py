"""Change feed over an append-only Parquet table (ST14): a streaming source whose offsets are
row groups.

The feed delivers the table's rows in the order in which its files were written. An offset is
(write time, file, row groups read of it), so a micro-batch can end inside a file, and one task
reads one row group. ``rowGroupsPerTrigger`` admits that many row groups to a micro-batch, however
large the files that wait are.

The newest planned offset is in the query's own offset log. The reader looks there when it is
started (``checkpoint``), since Spark asks a source for its latest offset before telling it where
the query had stopped; a batch that was planned but not finished is planned again from its logged
offsets, with the same row groups.

    feed = change_feed(spark, ".../events", checkpoint=".../ckpt", row_groups_per_trigger=64)
    feed.writeStream.option("checkpointLocation", ".../ckpt").foreachBatch(...).start()

Conditions: files are complete when they appear and are not changed afterwards; a file that is
gone although its rows are asked for fails the query. Files count once they are ``settleSeconds``
old, so that files of equal or slightly disordered write times are not passed over. Names that
begin with ``_`` or ``.`` are no data. An ``availableNow`` trigger ends after one micro-batch; use
a processing time. Tasks read through pyarrow, so the path must be one that it can open.
"""

from __future__ import annotations

import json
import posixpath
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "parquet_change_feed"
ROW_GROUPS_PER_TRIGGER = 64
SETTLE_SECONDS = 2.0
START = {"time": 0, "file": "", "group": 0}


def _filesystem(path: str):
    from pyarrow import fs

    if ":/" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class RowGroup(InputPartition):
    def __init__(self, file: str, group: int):
        super().__init__((file, group))


class ChangeFeedReader(DataSourceStreamReader):
    def __init__(self, options, schema: StructType):
        self.path, self.schema = options["path"], schema
        self.checkpoint = options.get("checkpoint")
        self.source_index = int(options.get("sourceIndex", 0))
        self.limit = int(options.get("rowGroupsPerTrigger", ROW_GROUPS_PER_TRIGGER))
        self.settle = float(options.get("settleSeconds", SETTLE_SECONDS))
        if self.limit < 1:
            raise ValueError("rowGroupsPerTrigger must be at least 1")
        self._planned: dict | None = None
        self._groups: dict[str, int] = {}  # of the files between the last offsets

    # ---- what is there
    def _files(self) -> list[tuple[int, str]]:
        """(write time in ns, path below the table) of all data files, in the feed's order."""
        from pyarrow import fs

        system, root = _filesystem(self.path)
        root = root.rstrip("/")
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        out = []
        for f in found:
            name = posixpath.relpath(f.path, root)
            hidden = any(part[:1] in ("_", ".") for part in name.split("/"))
            if f.type == fs.FileType.File and not hidden:
                out.append((int(f.mtime_ns or 0), name))
        return sorted(out)

    def _count(self, file: str) -> int:
        """Row groups of a file, from its footer."""
        if file not in self._groups:
            import pyarrow.parquet as pq

            system, root = _filesystem(self.path)
            self._groups[file] = pq.ParquetFile(
                f"{root.rstrip('/')}/{file}", filesystem=system).num_row_groups
        return self._groups[file]

    def _logged(self) -> dict:
        """The newest offset in the query's offset log, START without one."""
        if not self.checkpoint:
            return dict(START)
        from pyarrow import fs

        system, root = _filesystem(self.checkpoint)
        folder = f"{root.rstrip('/')}/offsets"
        logs = [f.path for f in system.get_file_info(
            fs.FileSelector(folder, allow_not_found=True)) if f.base_name.isdigit()]
        if not logs:
            return dict(START)
        newest = max(logs, key=lambda p: int(posixpath.basename(p)))
        with system.open_input_stream(newest) as f:
            lines = f.read().decode("utf-8").splitlines()
        line = lines[2 + self.source_index]  # version and batch metadata come first
        return dict(START) if line == "-" else json.loads(line)

    # ---- offsets
    def initialOffset(self) -> dict:
        return dict(START)

    def latestOffset(self) -> dict:
        """The offset ``limit`` row groups after the last planned one, or the newest."""
        at = self._planned or self._logged()
        left, before = self.limit, (time.time() - self.settle) * 1e9
        for written, file in self._files():
            if written > before or left == 0:
                break
            if (written, file) < (at["time"], at["file"]):
                continue
            done = at["group"] if (written, file) == (at["time"], at["file"]) else 0
            take = min(left, self._count(file) - done)
            at = {"time": written, "file": file, "group": done + take}
            left -= take
        self._planned = at
        return at

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        out = []
        first, last = (start["time"], start["file"]), (end["time"], end["file"])
        if start == end:
            return out
        files = [f for f in self._files() if first <= f <= last]
        if last not in files:
            raise FileNotFoundError(f"{end['file']} of the feed at {self.path} is gone or changed")
        for f in files:
            begin = start["group"] if f == first else 0
            stop = end["group"] if f == last else self._count(f[1])
            out += [RowGroup(f[1], g) for g in range(begin, stop)]
        self._planned = max(self._planned or end, end, key=lambda o: (
            o["time"], o["file"], o["group"]))
        return out

    def commit(self, end: dict) -> None:
        self._groups.clear()

    # ---- in tasks
    def read(self, partition: RowGroup):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        file, group = partition.value
        system, root = _filesystem(self.path)
        target = to_arrow_schema(self.schema)
        source = pq.ParquetFile(f"{root.rstrip('/')}/{file}", filesystem=system)
        held = [n for n in target.names if n in source.schema_arrow.names]
        for batch in source.iter_batches(batch_size=10_000, row_groups=[group], columns=held):
            columns = [batch.column(f.name).cast(f.type) if f.name in held  # new columns: null
                       else pa.nulls(batch.num_rows, f.type) for f in target]
            yield pa.RecordBatch.from_arrays(columns, schema=target)


class ChangeFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> ChangeFeedReader:
        return ChangeFeedReader(self.options, schema)


def change_feed(spark: SparkSession, path: str, schema: StructType | None = None,
                checkpoint: str | None = None,
                row_groups_per_trigger: int = ROW_GROUPS_PER_TRIGGER,
                settle_seconds: float = SETTLE_SECONDS, source_index: int = 0) -> DataFrame:
    """The rows appended to the Parquet table at ``path`` as a stream. ``schema``: the table's
    by default. ``checkpoint``: the ``checkpointLocation`` of the query that reads the feed;
    without it a restarted query would be offered old offsets. ``source_index``: the position of the feed among
    the sources of that query."""
    from eventide.session import ship_code

    ship_code(spark)
    spark.dataSource.register(ChangeFeed)
    reader = (spark.readStream.format(NAME).schema(schema or spark.read.parquet(path).schema)
              .option("rowGroupsPerTrigger", row_groups_per_trigger)
              .option("settleSeconds", settle_seconds).option("sourceIndex", source_index))
    if checkpoint:
        reader = reader.option("checkpoint", checkpoint)
    return reader.load(path)
