"""Tables of a review that several queries read, each built once per application and state of its input.

A table lies in a folder of the application below the shared one, named after the input's files, their sizes and their
times: a query after the first finds it there, and changed input gives new tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sourcetrail.session import shared_folder
from sourcetrail.streaming.case_tables import CaseTables

#: The given tables that a review is made from.
INPUTS = ["events", "orders", "documents"]


def _file(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def _state(spark: SparkSession, folder: str) -> str:
    seen = []
    for name in INPUTS:
        files, place = _file(spark, f"{folder}/{name}.parquet")
        if files.exists(place):
            status, size = files.getFileStatus(place), files.getContentSummary(place).getLength()
            seen.append(f"{place} {size} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()[:16]


def root_of(spark: SparkSession, folder: str) -> str:
    return f"{shared_folder(spark)}/review-{spark.sparkContext.applicationId}-{_state(spark, folder)}"


def is_built(spark: SparkSession, path: str) -> bool:
    files, place = _file(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def kept(spark: SparkSession, folder: str, build: Callable[[], dict[str, DataFrame]], *names: str) -> list[DataFrame]:
    """The named tables; ``build`` gives them where one is not there yet."""
    paths = {name: f"{root_of(spark, folder)}/{name}" for name in names}
    if not all(is_built(spark, path) for path in paths.values()):
        built = build()
        for name, path in paths.items():
            built[name].write.mode("overwrite").parquet(path)
    return [spark.read.parquet(path) for path in paths.values()]


def case_tables(spark: SparkSession, folder: str, key: str, build: dict[str, Callable[[], DataFrame]]) -> CaseTables:
    """The named tables, laid out by a key for queries that ask for one value of it."""
    tables = CaseTables(spark, f"{root_of(spark, folder)}/by-{key}", key=key)
    for name, rows in build.items():
        if not is_built(spark, tables.path(name)):
            tables.replace(name, rows())
    return tables
