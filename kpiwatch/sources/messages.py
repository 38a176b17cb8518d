"""Message sink as a Spark data source: one message a day, all of a write or nothing of it.

``df.write.format("kpi_messages")`` takes (dated, payload).  Each task streams
its rows to a file of its own under the write's run folder; nothing of it is
read until the driver's commit, which checks that no day came twice and adds
one commit record.  A failed write removes its run folder and leaves what was
there; what a task that outlives it still stages is never read.  Appending replaces the days it holds (a NULL payload says that the day
has no message now); overwriting replaces all days.

Reading gives, for each day, the row of the last committed write that holds
it.  Writers of one path take turns, as the scheduled job does.  No network
call is made: delivering the texts is left to the consumer.
"""

from __future__ import annotations

import datetime as dt
import io
import json
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FORMAT = "kpi_messages"
SCHEMA = "dated date, payload string"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Staged(WriterCommitMessage):
    """A task's file and its days; no file where the task had no rows."""

    file: str | None
    days: list[str]


class MessageWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.run = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Staged:
        files, root = _open(self.path)
        folder = f"{root}/runs/{self.run}"
        name, days, out = f"{uuid.uuid4().hex}.jsonl", [], None
        try:
            for row in iterator:
                if row["dated"] is None:
                    raise ValueError("a message without a day")
                if out is None:
                    files.create_dir(folder, recursive=True)
                    out = files.open_output_stream(f"{folder}/{name}")
                days.append(row["dated"].isoformat())
                out.write(json.dumps([days[-1], row["payload"]]).encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        return Staged(name if days else None, days)

    def commit(self, messages: list) -> None:
        files, root = _open(self.path)
        held = [m for m in messages if m is not None and m.file]
        days = sorted(d for m in held for d in m.days)
        twice = sorted({a for a, b in zip(days, days[1:]) if a == b})
        if twice:
            raise ValueError(f"more than one message for {', '.join(twice)}")
        record = {"run": self.run, "all": self.overwrite, "files": {m.file: m.days for m in held}}
        files.create_dir(f"{root}/commits", recursive=True)
        name = f"{time.time_ns():020d}-{self.run}.json"
        # The record gets its name only when it is whole.
        with files.open_output_stream(f"{root}/{self.run}.tmp") as out:
            out.write(json.dumps(record).encode())
        files.move(f"{root}/{self.run}.tmp", f"{root}/commits/{name}")

    def abort(self, messages: list) -> None:
        files, root = _open(self.path)
        folder = f"{root}/runs/{self.run}"
        if files.get_file_info(folder).type == fs.FileType.Directory:
            files.delete_dir(folder)


@dataclass
class Committed(InputPartition):
    """A stored file and those of its days that no later write replaced."""

    file: str
    days: list[str]


class MessageReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Committed]:
        files, root = _open(self.path)
        listed = files.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
        last: dict[str, str] = {}
        for info in sorted(listed, key=lambda i: i.base_name):
            with files.open_input_stream(info.path) as f:
                record = json.loads(f.read())
            if record["all"]:
                last = {}
            last |= {day: f"runs/{record['run']}/{name}" for name, days in record["files"].items() for day in days}
        of: dict[str, list[str]] = {}
        for day, file in last.items():
            of.setdefault(file, []).append(day)
        return [Committed(file, days) for file, days in sorted(of.items())] or [Committed("", [])]

    def read(self, partition: Committed) -> Iterator[tuple]:
        if not partition.file:
            return
        files, root = _open(self.path)
        days = set(partition.days)
        with files.open_input_file(f"{root}/{partition.file}") as f:
            for line in io.BufferedReader(f):
                day, payload = json.loads(line)
                if day in days:
                    yield dt.date.fromisoformat(day), payload


class MessageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> MessageWriter:
        return MessageWriter(self.options["path"], overwrite)

    def reader(self, schema) -> MessageReader:
        return MessageReader(self.options["path"])


# The classes travel with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def store_messages(payloads: DataFrame, path: str, mode: str = "append") -> None:
    """Write (dated, payload): ``append`` replaces the days it holds, ``overwrite`` all days."""
    spark = payloads.sparkSession
    spark.dataSource.register(MessageSource)
    payloads.select("dated", "payload").write.format(FORMAT).mode(mode).save(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """(dated, payload) of every day, as its last committed write left it; empty before the first."""
    spark.dataSource.register(MessageSource)
    return spark.read.format(FORMAT).load(path)
