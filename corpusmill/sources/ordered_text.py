"""One long text in parts, as a data source: lines in order, written by many tasks.

Rows that are sorted over range partitions are written as they lie: each task
writes a part, its commit message tells bytes and lines, and prefix sums over the
messages, in order of partitions, place every part in the text. The index of parts
is written last and at once: parts of lost or repeated attempts are in no index.
Read back, every line has its number and byte offset, and a range of lines reads
its parts only. Neither driver nor task holds the text: the driver sees a message a task.

A null value is an empty line; a value with line breaks is several lines. Lines end
in a line feed, the last one too. An empty text has an index of no parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .stores import place, register

INDEX = "_parts.json"
#: Bytes of lines in one Arrow batch, and of one read.
BATCH_BYTES = 4 << 20


@dataclass
class Wrote(WriterCommitMessage):
    """A task's part: its file, which partition it was, what it holds."""

    partition: int
    file: str
    size: int
    lines: int


@dataclass
class Part(InputPartition):
    """A part in its place: byte offset and number of its first line."""

    file: str
    start: int
    line: int
    size: int
    lines: int


class OrderedText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ordered_text"

    def schema(self) -> str:
        return "line long, start long, value string"

    def reader(self, schema) -> TextReader:
        until = self.options.get("untilLine")
        return TextReader(self.options["path"], int(self.options.get("fromLine", 0)), None if until is None else int(until))

    def writer(self, schema, overwrite: bool) -> TextWriter:
        if overwrite:
            raise ValueError("ordered_text is written once; write to a new folder")
        return TextWriter(self.options["path"])


class TextWriter(DataSourceArrowWriter):
    def __init__(self, root: str) -> None:
        self.root = root

    def write(self, iterator: Iterator) -> Wrote:
        from pyspark import TaskContext

        store, root = place(self.root)
        store.create_dir(root, recursive=True)
        done = Wrote(TaskContext.get().partitionId(), f"part-{uuid.uuid4().hex}", 0, 0)
        with store.open_output_stream(f"{root}/{done.file}") as f:
            for batch in iterator:
                for value in batch.column("value"):
                    data = (value.as_py() or "").encode() + b"\n"
                    f.write(data)
                    done.size += len(data)
                    done.lines += data.count(b"\n")
        return done

    def commit(self, messages: list[Wrote | None]) -> None:
        store, root = place(self.root)
        store.create_dir(root, recursive=True)
        parts, start, line = [], 0, 0
        for m in sorted((m for m in messages if m and m.size), key=lambda m: m.partition):
            parts.append(asdict(Part(m.file, start, line, m.size, m.lines)))
            start, line = start + m.size, line + m.lines
        aside = f"{root}/.{uuid.uuid4().hex}"
        with store.open_output_stream(aside) as f:
            f.write(json.dumps({"bytes": start, "lines": line, "parts": parts}).encode())
        store.move(aside, f"{root}/{INDEX}")

    def abort(self, messages: list[Wrote | None]) -> None:
        store, root = place(self.root)
        for m in messages:
            if m:
                store.delete_file(f"{root}/{m.file}")


class TextReader(DataSourceReader):
    def __init__(self, root: str, first: int = 0, until: int | None = None) -> None:
        self.root, self.first, self.until = root, first, until

    def wanted(self, p: Part) -> bool:
        return p.line + p.lines > self.first and (self.until is None or p.line < self.until)

    def partitions(self) -> list[Part]:
        store, root = place(self.root)
        with store.open_input_stream(f"{root}/{INDEX}") as f:
            parts = [Part(**p) for p in json.loads(f.read())["parts"]]
        return [p for p in parts if self.wanted(p)] or [Part("", 0, 0, 0, 0)]

    def read(self, partition: Part) -> Iterator:
        import pyarrow as pa

        if not partition.size:
            return
        store, root = place(self.root)
        line, start, pending = partition.line, partition.start, []
        with store.open_input_stream(f"{root}/{partition.file}") as f:
            while data := f.read(BATCH_BYTES):
                end = data.rfind(b"\n")
                if end < 0:  # a line longer than a read goes on
                    pending.append(data)
                    continue
                lines = b"".join([*pending, data[:end]]).split(b"\n")
                pending = [data[end + 1:]]
                starts = []
                for value in lines:
                    starts.append(start)
                    start += len(value) + 1
                numbers = pa.array(range(line, line + len(lines)), pa.int64())
                line += len(lines)
                yield pa.RecordBatch.from_arrays([numbers, pa.array(starts, pa.int64()), pa.array([v.decode() for v in lines], pa.string())], ["line", "start", "value"])


def write_text(lines: DataFrame, folder: str, *order: str | Column) -> None:
    """Writes ``value`` in the order of columns that order the rows wholly."""
    rows = lines.orderBy(*order).select("value")
    rows.write.format(register(lines.sparkSession, OrderedText)).mode("append").option("path", folder).save()


def read_text(spark: SparkSession, folder: str, first: int = 0, until: int | None = None) -> DataFrame:
    """``line, start, value`` of a text written by :func:`write_text`, of the lines
    numbered from ``first`` to before ``until``."""
    reader = spark.read.format(register(spark, OrderedText)).option("path", folder).option("fromLine", first)
    lines = (reader if until is None else reader.option("untilLine", until)).load()
    lines = lines.where(F.col("line") >= first) if first else lines
    return lines if until is None else lines.where(F.col("line") < until)


def listed(rows: DataFrame, *order: str, value: str = "value") -> DataFrame:
    """Lines of a JSON array of the rows' JSON texts in ``value``: a comma before all but the first.

    ``order`` orders the rows wholly. The result has ``part`` (0 the bracket, 1 the
    rows, 2 the bracket), the order's columns and ``value``.
    """
    first = rows.select(F.min(F.struct(*order))).scalar()
    row = F.concat(F.when(F.struct(*order) == first, " ").otherwise(","), F.col(value))
    inner = rows.select(F.lit(1).alias("part"), *order, row.alias("value"))
    marks = rows.sparkSession.createDataFrame([(0, "["), (2, "]")], "part int, value string")
    return inner.unionByName(marks, allowMissingColumns=True)
