"""Stored changes and facts as a stream in the order of the log.

A plain file stream takes files in the order they were written, so over a backlog the watermark runs ahead of most
tables and their rows come late. This source takes the folder's days in order instead: each micro-batch is the next day,
or the next ``windows`` days, of one table. Several tables read together step through the same days, and time moves with
the slowest of them. A day is whatever span of time the folder is partitioned by.

When a day is done and a later one exists, a tick passes the end of the day: a row that only carries time, so
that a table without rows that day does not hold the others up. The newest day stays open; files that come to it, to a
day already done, or without a day are delivered once, as soon as they are found.

An offset is the last day delivered and the number of the last list of files. Lists and offsets are kept in the
``progress`` folder, so a query that is started again goes on where its checkpoint is. A folder that a stream writes is read by
that stream's own list of committed files.
"""

import json
import posixpath
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timezone
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyarrow import parquet
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_type

from tidemart.constants import WATERMARK
from tidemart.schemas import CHANGE_DDL
from tidemart.sources.bronze import NO_DAY
from tidemart.sources.topics import with_event_time

# Ships the reader itself, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "log_in_order"
COMMITTED = "_spark_metadata"
TASK_BYTES = 32 << 20
DAY_SECONDS = 86_400


def place(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path).rstrip("/"))


def start_of(day: str) -> int:
    return int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp())


def label(path: str, name: str) -> str | None:
    found = re.search(rf"(?:^|/){name}=([^/]*)/", path)
    return unquote(found.group(1)) if found else None


@dataclass
class Piece:
    """Row groups ``part`` modulo ``parts`` of a file."""

    path: str
    table: str | None
    day: str | None
    part: int = 0
    parts: int = 1


class Work(InputPartition):
    """Files of one task, or a tick at some second."""

    def __init__(self, pieces: list[Piece], tick: int | None = None) -> None:
        self.pieces = pieces
        self.tick = tick


class Progress:
    """Numbered JSON files that appear whole or not at all."""

    def __init__(self, folder: str) -> None:
        self.fs, self.folder = place(folder)
        self.fs.create_dir(self.folder, recursive=True)

    def numbers(self, kind: str) -> list[int]:
        names = [info.base_name for info in self.fs.get_file_info(arrow_fs.FileSelector(self.folder))]
        return sorted(int(m.group(1)) for m in (re.fullmatch(rf"{kind}-(\d+)\.json", n) for n in names) if m)

    def read(self, kind: str, number: int):
        with self.fs.open_input_file(f"{self.folder}/{kind}-{number}.json") as file:
            return json.loads(file.read())

    def write(self, kind: str, number: int, value) -> None:
        whole = f"{self.folder}/{kind}-{number}.json"
        with self.fs.open_output_stream(f"{whole}.part") as file:
            file.write(json.dumps(value).encode())
        self.fs.move(f"{whole}.part", whole)

    def drop(self, kind: str, number: int) -> None:
        self.fs.delete_file(f"{self.folder}/{kind}-{number}.json")


class Folder:
    """What a partitioned folder holds."""

    def __init__(self, root: str) -> None:
        self.fs, self.root = place(root)

    def _committed(self) -> list[str] | None:
        """Files in a streaming writer's list, if it keeps one: the last whole list, and what was added since."""
        infos = self.fs.get_file_info(arrow_fs.FileSelector(f"{self.root}/{COMMITTED}", allow_not_found=True))
        logs = {}
        for info in infos:
            if m := re.fullmatch(r"(\d+)(\.compact)?", info.base_name):
                logs[int(m.group(1))] = (info.path, m.group(2) is not None)
        if not logs:
            return None
        first = max((n for n, (_, whole) in logs.items() if whole), default=0)
        found = []
        for n in sorted(n for n in logs if n >= first):
            with self.fs.open_input_file(logs[n][0]) as file:
                entries = [json.loads(line) for line in file.read().decode().splitlines()[1:]]
            found += [place(unquote(e["path"]))[1] for e in entries if e.get("action") == "add"]
        return found

    def files(self, table: str | None) -> tuple[list[list], list[str]]:
        """(day, path, bytes) of a table's files, and the days of all tables."""
        committed = self._committed()
        inside = f"table={table}" if table else ""
        if committed is None:
            selector = arrow_fs.FileSelector(posixpath.join(self.root, inside), allow_not_found=True, recursive=True)
            infos = self.fs.get_file_info(selector)
            paths = [(i.path, i.size) for i in infos if i.is_file and i.base_name.endswith(".parquet") and not i.base_name.startswith(("_", "."))]
            folders = [self.root]
            if table:
                folders = [i.path for i in self.fs.get_file_info(arrow_fs.FileSelector(self.root, allow_not_found=True)) if i.base_name.startswith("table=")]
            inner = [i.path + "/" for f in folders for i in self.fs.get_file_info(arrow_fs.FileSelector(f, allow_not_found=True))]
            days = [label(p, "day") for p in inner]
        else:
            mine = [p for p in committed if not table or label(p, "table") == table]
            paths = [(i.path, i.size) for i in self.fs.get_file_info(mine) if i.is_file]
            days = [label(p, "day") for p in committed]
        found = [[None if label(p, "day") in (None, NO_DAY) else label(p, "day"), p, size] for p, size in paths]
        return sorted(found, key=lambda f: (f[0] or "", f[1])), sorted({d for d in days if d not in (None, NO_DAY)})


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.schema = schema
        self.root = options["path"]
        self.table = options.get("table")
        self.windows = int(options.get("windows", "1"))
        self.flush = int(options["flush"]) if "flush" in options else None
        self.progress_folder = options["progress"]
        self.progress = None

    def _open(self) -> None:
        """Take up the lists and the offset that are kept."""
        if self.progress is None:
            self.progress = Progress(self.progress_folder)
            self.lists = {n: self.progress.read("files", n) for n in self.progress.numbers("files")}
            self.known = {path for files in self.lists.values() for _, path, _ in files}
            self.planned = max(self.progress.numbers("offset"), default=0)
            self.at = self.progress.read("offset", self.planned) if self.planned else self.initialOffset()
            self.days = Folder(self.root).files(self.table)[1]

    def _look(self) -> None:
        """Put files not seen before on a list of their own."""
        files, self.days = Folder(self.root).files(self.table)
        new = [f for f in files if f[1] not in self.known]
        if new:
            number = max(self.lists, default=0) + 1
            self.progress.write("files", number, new)
            self.lists[number] = new
            self.known.update(path for _, path, _ in new)

    def initialOffset(self) -> dict:
        return {"through": "", "seen": 0, "flushed": 0}

    def latestOffset(self) -> dict:
        self._open()
        later = [d for d in self.days if d > self.at["through"]]
        if len(later) <= self.windows or not self.lists:
            self._look()
            later = [d for d in self.days if d > self.at["through"]]
        offset = {**self.at, "seen": max(self.lists, default=0)}
        if later:
            offset["through"] = later[min(self.windows, len(later)) - 1]
        elif offset == self.at and self.flush is not None and offset["through"]:
            offset["flushed"] = 1
        return offset

    def partitions(self, start: dict, end: dict) -> list[Work]:
        self._open()
        if start == end:
            return []
        if end != self.at:
            self.planned += 1
            self.progress.write("offset", self.planned, end)
            self.at = end
        files = []
        for number, some in self.lists.items():
            is_new = start["seen"] < number
            for day, path, size in some if number <= end["seen"] else []:
                if is_new and day is None or day is not None and day <= end["through"] and (is_new or day > start["through"]):
                    files.append((path, day, size))
        return [*self._shared_out(files), *self._ticks(start, end)]

    def _shared_out(self, files: list[tuple]) -> list[Work]:
        """Large files in parts, small ones together."""
        out, some, total = [], [], 0
        for path, day, size in files:
            parts = -(-size // TASK_BYTES) or 1
            if parts > 1:
                out += [Work([Piece(path, self.table, day, i, parts)]) for i in range(parts)]
                continue
            some.append(Piece(path, self.table, day))
            total += size + (1 << 20)  # opening a file costs about as much as reading this
            if total >= TASK_BYTES:
                out.append(Work(some))
                some, total = [], 0
        return [*out, Work(some)] if some else out

    def _ticks(self, start: dict, end: dict) -> list[Work]:
        after = [d for d in self.days if d > end["through"]]
        if end["through"] and after and end["through"] != start["through"]:
            return [Work([], start_of(after[0]) - 1)]
        if end["flushed"] and not start["flushed"]:
            return [Work([], start_of(end["through"]) + self.flush * DAY_SECONDS)]
        return []

    def read(self, partition: Work) -> Iterator[pa.RecordBatch]:
        fields = [(f.name, to_arrow_type(f.dataType)) for f in self.schema.fields]
        if partition.tick is not None:
            given = {"ts": partition.tick, "_tick": True}
            yield pa.RecordBatch.from_arrays([pa.array([given.get(n)], t) for n, t in fields], names=[n for n, _ in fields])
        for piece in partition.pieces:
            files, path = place(piece.path)
            constant = {"table": piece.table, "day": piece.day and date.fromisoformat(piece.day), "_tick": False}
            with files.open_input_file(path) as opened:
                source = parquet.ParquetFile(opened)
                groups = range(piece.part, source.num_row_groups, piece.parts)
                there = [n for n, _ in fields if n in source.schema_arrow.names]
                for batch in source.iter_batches(row_groups=list(groups), columns=there) if groups else []:
                    columns = []
                    for name, kind in fields:
                        if name in there:
                            columns.append(batch.column(name).cast(kind))
                        else:
                            columns.append(pa.repeat(pa.scalar(constant.get(name), kind), batch.num_rows))
                    yield pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])

    def commit(self, end: dict) -> None:
        """All but the last two offsets can go."""
        self._open()
        for number in self.progress.numbers("offset")[:-2]:
            self.progress.drop("offset", number)


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{CHANGE_DDL}, _tick boolean"

    def streamReader(self, schema: T.StructType) -> LogReader:
        return LogReader(dict(self.options), schema)


def in_order(
    spark: SparkSession, path: str, progress: str, ddl: str, delay: str = WATERMARK, table: str | None = None,
    windows: int = 1, flush: int | None = None,
) -> DataFrame:
    """A folder partitioned by day, or by table and day, as a stream in the order of days, with event time.

    ``flush`` days after the start of the last day a tick ends the stream's time, once there is nothing more: for runs
    that work off what is there, so that rows still waiting for a partner come out.
    """
    spark.dataSource.register(LogSource)
    options = {"path": path, "progress": progress, "windows": str(windows)}
    options |= {"table": table} if table else {}
    options |= {"flush": str(flush)} if flush is not None else {}
    rows = with_event_time(spark.readStream.format(FORMAT).schema(f"{ddl}, _tick boolean").options(**options).load(), delay)
    # The explode keeps the filter above the watermark, which ticks must pass.
    kept = rows.select("et", F.explode(F.array(F.struct(*[c for c in rows.columns if c != "et"]))).alias("r"))
    return kept.where("not r._tick").select("r.*", "et").drop("_tick")


@dataclass(frozen=True)
class LogTables:
    """The stored change log by table, each table a stream in order; ``progress`` belongs to one query."""

    spark: SparkSession
    path: str
    progress: str
    delay: str = WATERMARK
    windows: int = 1
    flush: int | None = None

    def __call__(self, table: str) -> DataFrame:
        progress = f"{self.progress}/{table}"
        return in_order(self.spark, self.path, progress, CHANGE_DDL, self.delay, table, self.windows, self.flush)
