"""A log in shards, read as a stream with positions of its own.

``append`` writes records, dealt by key, below ``log/at=<ms>/shard=<n>`` and then, as the last step, how many rows each file
has, below ``index/at=<ms>``. What has no index isn't there yet: a reader never sees half of an append.

``read_stream`` gives them as a stream. Its offset holds, per shard, the append it is in and the rows taken of it, so a batch
can end inside an append, a restarted query goes on at the row it had reached, and a repeated batch reads the same rows.
It begins behind what is there (``latest``), with all that is kept (``trim``) or with the appends of the last hours (``hours=24``).
"""

import json
import posixpath
import time
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "shard_log"
SCHEMA = "shard int, at long, value string"
SHARDS = 4
RECORDS = 100  # of one shard in one batch


def append(records: DataFrame, path: str, at: int | None = None, shards: int = SHARDS) -> int:
    """Adds records (``key``, ``value``) under a time in milliseconds that no earlier append has reached.

    Heavy keys don't hold a task: a shard's rows are written by as many as they fill.
    """
    spark = records.sparkSession
    last = _last(spark, path)
    at = max(int(time.time() * 1000), last + 1) if at is None else at
    if at <= last:
        raise ValueError(f"appends go forward in time: {at} is not after {last}")
    dealt = records.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "value")
    folder = f"{path}/log/at={at}"
    dealt.hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(folder)
    written = spark.read.schema("value string, shard int").parquet(folder)
    files = written.groupBy("shard", F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    files.coalesce(1).write.mode("overwrite").json(f"{path}/index/at={at}")
    return at


def _last(spark: SparkSession, path: str) -> int:
    try:
        found = spark.read.schema("shard int, file string, rows long, at long").json(f"{path}/index").agg(F.max("at")).first()[0]
    except AnalysisException:
        return 0
    return found or 0


def read_stream(spark: SparkSession, path: str, start: str = "latest", hours: float | None = None, records: int = RECORDS) -> DataFrame:
    """The log as a stream (``shard``, ``at``, ``value``); ``records`` is the most of one shard in a batch, 0 is no bound.

    ``start`` and ``hours`` count for a new query only; a restarted one goes on where its checkpoint says.
    """
    if start not in ("latest", "trim"):
        raise ValueError(f"unknown start: {start}")
    spark.dataSource.register(ShardLog)
    begin = start if hours is None else str(int((time.time() - hours * 3600) * 1000))
    return spark.readStream.format(NAME).option("path", path).option("begin", begin).option("records", records).load()


class ShardLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> "ShardLogReader":
        return ShardLogReader(self.options["path"], self.options["begin"], int(self.options["records"]))


@dataclass
class Slice(InputPartition):
    """Rows ``first`` to ``end`` of one file."""

    file: str
    shard: int
    at: int
    first: int
    end: int


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(path).path
    return fs.FileSystem.from_uri(path)


class ShardLogReader(DataSourceStreamReader):
    """Offsets are ``{"from": at, "shards": {shard: [at, rows]}}``: all of a shard's appends before ``at`` are taken and so many
    rows of that one; a shard that isn't named begins at ``from``."""

    def __init__(self, path: str, begin: str, records: int):
        self.path, self.begin, self.records = path, begin, records
        self.position: dict | None = None
        self.known: dict[int, dict[int, list]] = {}  # append: shard: files and their rows, in order

    def _appends(self) -> dict[int, dict[int, list]]:
        """The index; each append's entry is read once."""
        store, root = _store(self.path)
        found = store.get_file_info(fs.FileSelector(posixpath.join(root, "index"), allow_not_found=True))
        for at, folder in sorted((int(f.base_name[3:]), f.path) for f in found if f.base_name.startswith("at=")):
            if at not in self.known:
                inside = store.get_file_info(fs.FileSelector(folder))
                if any(f.base_name == "_SUCCESS" for f in inside):
                    self.known[at] = _by_shard(store, [f.path for f in inside if f.base_name.endswith(".json")])
        return self.known

    def initialOffset(self) -> dict:
        if self.begin == "latest":
            return {"from": max(self._appends(), default=-1) + 1, "shards": {}}
        return {"from": 0 if self.begin == "trim" else int(self.begin), "shards": {}}

    def latestOffset(self) -> dict:
        """The end of the next batch: up to ``records`` further rows of each shard."""
        if self.position is None:
            self.position = self.initialOffset()
        appends = self._appends()
        shards = {shard for files in appends.values() for shard in files}
        end = {str(s): self._ahead(s, *_place(self.position, s)) for s in sorted(shards)}
        return {"from": self.position["from"], "shards": {**self.position["shards"], **end}}

    def _ahead(self, shard: int, at: int, taken: int) -> list[int]:
        left = self.records or float("inf")
        for append_at in sorted(a for a in self.known if a >= at and shard in self.known[a]):
            rows = sum(n for _, n in self.known[append_at][shard])
            begin = taken if append_at == at else 0
            step = min(left, rows - begin)
            at, taken, left = append_at, begin + step, left - step
            if not left:
                break
        return [at, taken]

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        """Slices of files between two offsets. Also called with the last offset twice when a query starts anew."""
        self.position = end
        appends = self._appends()
        root = self.path.rstrip("/")
        slices = []
        for name, (last, upto) in end["shards"].items():
            shard = int(name)
            at, taken = _place(start, shard)
            for append_at in sorted(a for a in appends if at <= a <= last and shard in appends[a]):
                begin = taken if append_at == at else 0
                stop = upto if append_at == last else float("inf")
                before = 0
                for file, rows in appends[append_at][shard]:
                    first, until = max(begin - before, 0), min(stop - before, rows)
                    if first < until:
                        slices.append(Slice(f"{root}/log/at={append_at}/shard={shard}/{file}", shard, append_at, first, until))
                    before += rows
        return slices

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        """Row groups ahead of the slice aren't read; the others in batches."""
        store, file = _store(partition.file)
        with store.open_input_file(file) as opened:
            table = pq.ParquetFile(opened)
            before = 0
            for group in range(table.num_row_groups):
                rows = table.metadata.row_group(group).num_rows
                if before + rows > partition.first and before < partition.end:
                    at = before
                    for batch in table.iter_batches(4096, [group], ["value"]):
                        first, end = max(partition.first - at, 0), min(partition.end - at, batch.num_rows)
                        if first < end:
                            yield _rows(batch.slice(first, end - first), partition)
                        at += batch.num_rows
                before += rows


def _place(offset: dict, shard: int) -> tuple[int, int]:
    at, taken = offset["shards"].get(str(shard), (offset["from"], 0))
    return at, taken


def _by_shard(store: fs.FileSystem, files: list[str]) -> dict[int, list]:
    found: dict[int, list] = {}
    for path in files:
        with store.open_input_stream(path) as opened:
            for line in opened.read().splitlines():
                entry = json.loads(line)
                found.setdefault(entry["shard"], []).append((entry["file"], entry["rows"]))
    return {shard: sorted(of_shard) for shard, of_shard in found.items()}


def _rows(batch: pa.RecordBatch, part: Slice) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays(
        [pa.array([part.shard] * n, pa.int32()), pa.array([part.at] * n, pa.int64()), batch.column(0).cast(pa.string())],
        names=["shard", "at", "value"],
    )
