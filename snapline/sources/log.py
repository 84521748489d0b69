"""A message log in files as a streaming source with offsets.

The log is a folder of segments ``<first>-<last>.jsonl``, one message per line, whose names are the offsets of their first and last message (20 digits). Segments
are added at the end and removed at the beginning as they expire, as a broker does. A stream starts at an offset, its checkpoint holds offsets, and a
range that has been removed before it was read is an error or is skipped, as ``failOnDataLoss`` says. Folders are read through Arrow's file systems,
so any that it knows will do.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Messages of one task at most.
PER_TASK = 100_000


def _folder(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def segments(path: str) -> list[tuple[int, int, str]]:
    """(first, last, file) in order; only names are looked at."""
    from pyarrow import fs

    system, folder = _folder(path)
    found = []
    for info in system.get_file_info(fs.FileSelector(folder)):
        name, dot, kind = info.base_name.rpartition(".")
        if kind == "jsonl" and name.count("-") == 1 and not name.startswith("."):
            first, last = name.split("-")
            found.append((int(first), int(last), info.path))
    return sorted(found)


class Range(InputPartition):
    """Messages ``first`` to ``last`` of a segment that begins at ``base``."""

    def __init__(self, file: str, base: int, first: int, last: int):
        self.file, self.base, self.first, self.last = file, base, first, last


def ranges(path: str, start: int, end: int, fail: bool) -> list[Range]:
    """The parts of [start, end) by segment; missing ones raise or are skipped with a warning."""
    parts, at = [], start
    for base, last, file in segments(path):
        if last < at or base >= end:
            continue
        if base > at:
            _lost(at, base, fail)
        first, stop = max(at, base), min(last + 1, end)
        parts += [Range(file, base, i, min(i + PER_TASK, stop) - 1) for i in range(first, stop, PER_TASK)]
        at = stop
    if at < end:
        _lost(at, end, fail)
    return parts


def _lost(first: int, end: int, fail: bool) -> None:
    text = f"messages {first} to {end - 1} are no longer in the log"
    if fail:
        raise ValueError(f"{text}; set failOnDataLoss to false to go on without them")
    warnings.warn(text, stacklevel=2)


def read_range(path: str, part: Range) -> Iterator[tuple[int, str]]:
    system, _ = _folder(path)
    with system.open_input_stream(part.file) as raw:
        rest, at = b"", part.base
        while at <= part.last:
            block = raw.read(1 << 20)
            lines = (rest + block).split(b"\n")
            rest = lines.pop() if block else b""
            for line in lines:
                if part.first <= at <= part.last:
                    yield at, line.decode("utf-8")
                at += 1
            if not block:
                break


class _Options:
    def __init__(self, options: dict):
        self.path = options["path"]
        self.fail = options.get("failondataloss", options.get("failOnDataLoss", "true")).lower() != "false"
        self.start = options.get("startingoffset", options.get("startingOffset", "earliest"))
        self.most = int(options.get("maxoffsetspertrigger", options.get("maxOffsetsPerTrigger", 0)))

    def first(self) -> int:
        held = segments(self.path)
        return int(self.start) if self.start != "earliest" else (held[0][0] if held else 0)

    def end(self) -> int:
        held = segments(self.path)
        return held[-1][1] + 1 if held else 0


class LogStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.log = _Options(options)
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"offset": self.log.first()}

    def latestOffset(self) -> dict:
        end = self.log.end()
        if self.log.most and self.at is not None:
            end = min(end, self.at + self.log.most)
        elif self.log.most:
            end = min(end, self.log.first() + self.log.most)
        return {"offset": max(end, self.at or 0)}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.at = end["offset"]
        return ranges(self.log.path, start["offset"], end["offset"], self.log.fail)

    def read(self, partition: Range) -> Iterator[tuple[int, str]]:
        return read_range(self.log.path, partition)


class LogTable(DataSourceReader):
    def __init__(self, options: dict):
        self.log = _Options(options)

    def partitions(self) -> list[Range]:
        return ranges(self.log.path, self.log.first(), self.log.end(), self.log.fail)

    def read(self, partition: Range) -> Iterator[tuple[int, str]]:
        return read_range(self.log.path, partition)


class MessageLog(DataSource):
    """``spark.readStream.format("message_log")`` with path, startingOffset and failOnDataLoss."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "offset long, value string"

    def streamReader(self, schema) -> LogStream:
        return LogStream(dict(self.options))

    def reader(self, schema) -> LogTable:
        return LogTable(dict(self.options))


def log_messages(spark: SparkSession, path: str, start: int | None = None, fail_on_data_loss: bool = True, stream: bool = True) -> DataFrame:
    """``offset`` and ``value`` of a log's messages, as a stream or as a table of what is there."""
    # Workers get this module by value, so they need not have the package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(MessageLog)
    reader = (spark.readStream if stream else spark.read).format("message_log").option("failOnDataLoss", str(fail_on_data_loss).lower())
    if start is not None:
        reader = reader.option("startingOffset", str(start))
    return reader.load(path)


def write_segments(messages: DataFrame, path: str, parts: int, column: str = "offset") -> None:
    """Store messages that carry offsets without gaps as about ``parts`` segments, one per range of offsets; more where a segment
    would hold over ``PER_TASK`` messages, since a task sorts those of a segment in memory.

    For tests and for moving a topic into files; the folder must be one that the tasks can write to.
    """

    def write(batches):
        import pyarrow as pa

        rows = []
        for batch in batches:
            rows += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        if rows:
            rows.sort()
            system, folder = _folder(path)
            system.create_dir(folder, recursive=True)
            name = f"{rows[0][0]:020d}-{rows[-1][0]:020d}.jsonl"
            with system.open_output_stream(f"{folder}/.{name}") as out:
                out.write("".join(f"{text}\n" for _, text in rows).encode())
            system.move(f"{folder}/.{name}", f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], ["n"])

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    parts = max(parts, -(-messages.count() // PER_TASK))
    messages.select(F.col(column).cast("long").alias(column), "value").repartitionByRange(parts, column).mapInArrow(write, "n long").collect()
