"""Written tables in the shared work folder: where lineage ends."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python
    workers import it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="corpusmill-")) / "corpusmill_package.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def work_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors share.

    Where the session names none, a folder of this machine serves a local session;
    on a cluster that would lose rows, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        base = _OWN[app]
    return f"{base.rstrip('/')}/corpusmill/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, **options) -> DataFrame:
    """The rows as Parquet on storage that outlives executors, read back; ``options`` are the writer's."""
    path = work_folder(df.sparkSession, tag)
    df.write.options(compression="zstd", **options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._corpusmill_path = path
    return out


def written_by(df: DataFrame, by: str, tag: str) -> DataFrame:
    """:func:`written` with a folder for each value of a column of few values, which filters on it skip."""
    path = work_folder(df.sparkSession, tag)
    df.write.partitionBy(by).option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._corpusmill_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a written table that no later plan reads."""
    path = getattr(df, "_corpusmill_path", None)
    if path:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
