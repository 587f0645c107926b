"""A queue of messages in a folder, as a sink of batches and a source of streams.

``spark.dataSource.register(JobQueue)``; ``df.write.format("job_queue").mode("append").save(folder)`` puts rows with a column ``body``, and
``spark.readStream.format("job_queue").load(folder)`` gives them in order. A put is one or more files, numbered as they come; a
file's name has its number and how many messages it holds, so that offsets need no reading. Files never change.

An offset is a file and a line. A batch admits ``maxMessages`` at most. What a batch has read is acknowledged for the ``group`` when
Spark has committed it, which is where a reader that starts again goes on from; a batch that was cut short is read again from the offsets in
Spark's checkpoint. One producer puts at a time; any number of groups may read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from vellum.sources.shared import json_content, listed, opened, written

SCHEMA = "file bigint, line bigint, body string"
ENDING = ".messages"


@dataclass
class Stretch(InputPartition):
    """Lines [start, stop) of a file."""

    path: str
    file: int
    start: int
    stop: int


def files(folder: str) -> list[tuple[str, int]]:
    """(path, messages) of the files of a queue; file i has the number i."""
    paths = listed(folder, ENDING)
    names = [p.rpartition("/")[2].removesuffix(ENDING).split("-") for p in paths]
    if [int(number) for number, _ in names] != list(range(len(paths))):
        raise ValueError(f"{folder} is no whole queue: files are missing before {names[-1][0]}")
    return [(path, int(n)) for path, (_, n) in zip(paths, names, strict=True)]


def lines(folder: str, part: Stretch | None) -> Iterator[tuple]:
    if part is None:  # what Spark reads where there are no partitions
        return
    store, _ = opened(folder)
    with store.open_input_stream(part.path, compression=None) as file:
        for i, line in enumerate(file.read().decode().split("\n")[part.start : part.stop], part.start):
            yield part.file, i, json.loads(line)


class StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.group = options["path"].rstrip("/"), options.get("group", "default")
        self.most = int(options.get("maxmessages", options.get("maxMessages", 1000)))
        if self.most < 1:
            raise ValueError("maxMessages has to be 1 at least")
        self.at: tuple[int, int] | None = None

    @property
    def acknowledged(self) -> str:
        return f"{self.folder}/_acknowledged/{self.group}"

    def initialOffset(self) -> dict:
        return {"file": 0, "line": 0}

    def latestOffset(self) -> dict:
        if self.at is None:
            found = json_content(self.acknowledged) or self.initialOffset()
            self.at = found["file"], found["line"]
        file, line = self.at
        left, sizes = self.most, [n for _, n in files(self.folder)]
        while file < len(sizes) and left:
            step = min(left, sizes[file] - line)
            left, line = left - step, line + step
            if line == sizes[file]:
                file, line = file + 1, 0
        return {"file": file, "line": line}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self.at = max(self.at or (0, 0), (end["file"], end["line"]))
        out = []
        for i, (path, n) in enumerate(files(self.folder)):
            a = start["line"] if i == start["file"] else 0
            b = end["line"] if i == end["file"] else n
            if start["file"] <= i <= end["file"] and a < b:
                out.append(Stretch(path, i, a, b))
        return out

    def read(self, partition: Stretch | None) -> Iterator[tuple]:
        return lines(self.folder, partition)

    def commit(self, end: dict) -> None:
        store, path = opened(self.acknowledged)
        if store.get_file_info(path).is_file:
            store.delete_file(path)
        written(self.acknowledged, json.dumps(end).encode())


class BatchReader(DataSourceReader):
    """All messages, whoever has read them."""

    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"].rstrip("/")

    def partitions(self) -> list[Stretch]:
        return [Stretch(path, i, 0, n) for i, (path, n) in enumerate(files(self.folder)) if n]

    def read(self, partition: Stretch | None) -> Iterator[tuple]:
        return lines(self.folder, partition)


@dataclass
class Put(WriterCommitMessage):
    parts: list[tuple[str, int]]


class Writer(DataSourceWriter):
    """Puts the rows of each task, ``perFile`` messages in a file; files are numbered when all tasks are done."""

    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.size, self.run = options["path"].rstrip("/"), int(options.get("perfile", options.get("perFile", 10_000))), uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Put:
        parts, held = [], []

        def flush() -> None:
            if held:
                part = f"{self.folder}/_parts-{self.run}/{uuid.uuid4().hex}"
                written(part, "\n".join(held).encode())
                parts.append((part, len(held)))
                held.clear()

        for row in iterator:
            held.append(json.dumps(row["body"]))  # one line each, whatever the message is
            if len(held) >= self.size:
                flush()
        flush()
        return Put(parts)

    def commit(self, messages: list[Put | None]) -> None:
        first = len(files(self.folder))
        for i, (part, n) in enumerate((p for m in messages if m for p in m.parts), first):
            store, source = opened(part)
            store.move(source, opened(f"{self.folder}/{i:012d}-{n:09d}{ENDING}")[1])
        self.abort(messages)

    def abort(self, messages: list[Put | None]) -> None:
        store, part = opened(f"{self.folder}/_parts-{self.run}")
        if store.get_file_info(part).type.name == "Directory":
            store.delete_dir(part)


class JobQueue(DataSource):
    @classmethod
    def name(cls) -> str:
        return "job_queue"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(dict(self.options))

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("a queue is only appended to")
        return Writer(dict(self.options))
