"""What the Python data sources share: places, registration, bytes."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource

from ..work import ship

_KNOWN: set[tuple[str, str]] = set()


def place(uri: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(uri)
    return store, root.rstrip("/")


def register(spark: SparkSession, source: type[DataSource]) -> str:
    """Makes a data source known to the session, on executors too; its format name."""
    ship(spark)
    key = (spark.sparkContext.applicationId, source.name())
    if key not in _KNOWN:
        spark.dataSource.register(source)
        _KNOWN.add(key)
    return source.name()
