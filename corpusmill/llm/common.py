"""Shared plumbing of these operators; written tables are those of the library."""

from __future__ import annotations

import math
import tempfile
import zipfile
from pathlib import Path
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..work import forget, work_folder, written  # noqa: F401

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python
    workers import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="corpusmill-")) / "corpusmill_package.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """How many partitions hold ``rows`` at ``per_part`` each."""
    return max(least, math.ceil(max(rows, 1) / per_part))


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the width that its owner has chosen."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of a few short columns that may be broadcast, some 10 MB.
BROADCAST_ROWS = 100_000


def beside(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A table as the smaller side of a join: broadcast where it is counted to be small,
    else both sides are shuffled, whatever its compressed files suggest."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows.hint("merge")


def rows_of(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)
