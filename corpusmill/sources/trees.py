"""A folder of layered text files as a data source: ``root/layer/name.md``.

Read: runs of files of about ``partitionBytes`` are one task each; layers and
beginnings of names that are asked for choose folders and files before any is
opened. They are options of the reading, not ``pushFilters``: Spark keeps what a
Python source pushed with the relation, so a second plan over the same DataFrame
would miss the rows of which the first had no need. The driver holds names and
sizes, as for any file source, never texts. Links that lead out of the root are
left out. Bytes that are not UTF-8 become replacement characters.

Written: one file a row. Each appears whole under its name (written aside, then
moved), so a task that runs again writes the same files again. Layers and names
that are empty, null, climb or hold a slash are refused. A null text is an empty file.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..dialect import SPARK
from ..functions import text as rules
from .stores import place, register

ENDING = ".md"
#: Texts of one Arrow batch, in bytes (a longer text is a batch of its own).
BATCH_BYTES = 4 << 20


@dataclass
class Run(InputPartition):
    """Files that one task reads: ``(layer, name, size)``."""

    files: list[tuple[str, str, int]]


@dataclass
class Wrote(WriterCommitMessage):
    files: int
    size: int


def harmless(part: str | None) -> bool:
    """Whether a text can be the name of one file or folder below a root."""
    return bool(part) and part not in (".", "..") and "/" not in part and "\x00" not in part


class TextTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "text_tree"

    def schema(self) -> str:
        return "layer string, name string, size long, text string"

    def reader(self, schema) -> TreeReader:
        layers = self.options.get("layers")
        return TreeReader(self.options["path"], int(self.options.get("partitionBytes", 32 << 20)), json.loads(layers) if layers else None, self.options.get("namesFrom", ""))

    def writer(self, schema, overwrite: bool) -> TreeWriter:
        if overwrite:
            raise ValueError("text_tree adds files; write to a new folder instead of overwriting one")
        return TreeWriter(self.options["path"])


class TreeReader(DataSourceReader):
    def __init__(self, root: str, partition_bytes: int, layers: list[str] | None = None, beginning: str = "") -> None:
        self.root, self.partition_bytes, self.layers, self.beginning = root, partition_bytes, layers, beginning

    def listed(self) -> Iterator[tuple[str, str, int]]:
        """Files by layer and name; folders that are not asked for are not listed."""
        from pyarrow import fs

        store, root = place(self.root)
        local = store.type_name == "local"
        real = os.path.realpath(root) + "/" if local else ""
        if self.layers is None:
            layers = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory)
        else:
            layers = sorted({x for x in self.layers if harmless(x)})
        for layer in layers:
            if layer.startswith((".", "_")):
                continue
            infos = store.get_file_info(fs.FileSelector(f"{root}/{layer}", allow_not_found=True))
            for i in sorted(infos, key=lambda i: i.base_name):
                name = i.base_name[: -len(ENDING)]
                if i.type != fs.FileType.File or not i.base_name.endswith(ENDING) or i.base_name.startswith((".", "_")) or not name.startswith(self.beginning):
                    continue
                if local and not os.path.realpath(i.path).startswith(real):
                    continue
                yield layer, name, i.size

    def partitions(self) -> list[Run]:
        runs: list[Run] = []
        room = 0
        for layer, name, size in self.listed():
            if not runs or room < size:
                runs.append(Run([]))
                room = self.partition_bytes
            runs[-1].files.append((layer, name, size))
            room -= size
        return runs or [Run([])]

    def read(self, partition: Run) -> Iterator:
        import pyarrow as pa

        store, root = place(self.root)
        types = pa.schema([("layer", pa.string()), ("name", pa.string()), ("size", pa.int64()), ("text", pa.string())])
        rows, held = [], 0
        for layer, name, size in partition.files:
            with store.open_input_stream(f"{root}/{layer}/{name}{ENDING}") as f:
                text = f.read().decode("utf-8", "replace")
            rows.append((layer, name, size, text))
            held += size
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)


class TreeWriter(DataSourceArrowWriter):
    def __init__(self, root: str) -> None:
        self.root = root

    def write(self, iterator: Iterator) -> Wrote:
        store, root = place(self.root)
        done = Wrote(0, 0)
        made: set[str] = set()
        for batch in iterator:
            for layer, name, text in zip(*(batch.column(c).to_pylist() for c in ("layer", "name", "text"))):
                if not harmless(layer) or not harmless(name):
                    raise ValueError(f"not a place inside the folder: {layer!r}/{name!r}")
                if layer not in made:
                    store.create_dir(f"{root}/{layer}", recursive=True)
                    made.add(layer)
                data = (text or "").encode()
                aside = f"{root}/{layer}/.{uuid.uuid4().hex}"
                with store.open_output_stream(aside) as f:
                    f.write(data)
                store.move(aside, f"{root}/{layer}/{name}{ENDING}")
                done.files += 1
                done.size += len(data)
        return done

    def commit(self, messages: list[Wrote | None]) -> None:
        """The mark of a whole tree, with its number of files and bytes."""
        store, root = place(self.root)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_SUCCESS") as f:
            f.write(f"{sum(m.files for m in messages if m)} {sum(m.size for m in messages if m)}\n".encode())

    def abort(self, messages: list[Wrote | None]) -> None:
        """Files stay, the mark is missing; the same rows can be written again."""


def read_tree(spark: SparkSession, folder: str, layers: list[str] | None = None, beginning: str = "", partition_bytes: int = 32 << 20) -> DataFrame:
    """``layer, name, size, text`` of the Markdown files a level below a folder: of all
    layers or of those given, of all names or of those with a beginning."""
    reader = spark.read.format(register(spark, TextTree)).option("path", folder).option("partitionBytes", partition_bytes).option("namesFrom", beginning)
    return (reader if layers is None else reader.option("layers", json.dumps(layers))).load()


def chapters(tree: DataFrame) -> DataFrame:
    """The files that hold anything but white space."""
    return tree.where(F.col("text").rlike(r"(?U)\S"))


def write_tree(harvested: DataFrame, folder: str, key: str | None = None) -> None:
    """A file a row of ``layer, title, text``, named by the title made safe.

    Rows of one layer and name would be one file, whichever came last; a ``key``
    column (of short, unique values) added to the names keeps all.
    """
    name = F.expr(rules.safe_name(SPARK, "title"))
    if key:
        name = F.concat(name, F.lit("-"), F.col(key).cast("string"))
    rows = harvested.select("layer", name.alias("name"), "text")
    rows.write.format(register(harvested.sparkSession, TextTree)).mode("append").option("path", folder).save()
