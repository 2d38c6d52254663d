"""Reading the given tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcetrail.session import run_folder


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as --py-files would.

    Operators with Python tasks call it first: a task knows the files that were added before it was declared."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), "sourcetrail.zip")
    with open(path, "wb") as out:
        out.write(data.getvalue())
    context.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Exchanges of a finished write are read by nothing; else they stay on disk until the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> None:
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once to the folder the cluster names, read from there: later steps survive lost executors."""
    path = run_folder(df.sparkSession, label)
    _write(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a `written` table that nothing reads any more."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._written_to)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


class Scratch:
    """The intermediate tables of one operator: written as it goes on, removed when its result no longer reads them."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def written(self, df: DataFrame, label: str) -> DataFrame:
        self.tables.append(written(df, label))
        return self.tables[-1]

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            discard(df)
            self.tables.remove(df)

    def clear(self) -> None:
        self.drop(*self.tables)


def crc_mod(column: str, divisor: int) -> "F.Column":
    """crc32 of the id as text, modulo `divisor`."""
    return F.crc32(F.col(column).cast("string")) % divisor


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0
