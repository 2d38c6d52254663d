"""A table that grows by one folder of changed rows per batch and is merged as it grows.

A run ``run=a-b`` holds the rows that changed in the batches a to b, one row per key.  A batch adds the run
``n-n``; merging replaces neighbouring runs by one.  Runs merge when the older is at most twice as large as what
was merged already, so their sizes fall geometrically: their number follows the logarithm of the table's size,
their bytes follow the keys, and a row is rewritten a logarithmic number of times.  A run that a complete larger
one covers is no longer read, and is removed by the next merge, so that readers which have already listed it finish."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from sourcetrail.operators.cdc import latest_by

_RUN = re.compile(r"run=(\d+)-(\d+)$")
Run = tuple[int, int]


class RunFolders:
    def __init__(self, spark: SparkSession, folder: str, schema, keys: list[str], sequence_by: str):
        self.spark, self.folder, self.schema, self.keys, self.sequence_by = spark, folder, schema, keys, sequence_by
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def path(self, run: Run) -> str:
        return f"{self.folder}/run={run[0]}-{run[1]}"

    def complete(self) -> list[Run]:
        """Runs that were written whole."""
        if not self._files.exists(self._path(self.folder)):
            return []
        names = (_RUN.search(s.getPath().toString()) for s in self._files.listStatus(self._path(self.folder)))
        runs = [(int(m[1]), int(m[2])) for m in names if m]
        return sorted(r for r in runs if self._files.exists(self._path(f"{self.path(r)}/_SUCCESS")))

    def current(self) -> list[Run]:
        """Runs that no other covers, oldest first."""
        runs = self.complete()
        return [r for r in runs if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in runs)]

    def bytes_of(self, run: Run) -> int:
        return self._files.getContentSummary(self._path(self.path(run))).getLength()

    def add(self, changed: DataFrame, batch: int) -> None:
        """Rows that a batch changed.  A batch that is run again replaces its own run only."""
        changed.write.mode("overwrite").parquet(self.path((batch, batch)))

    def _rows(self, runs: list[Run]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[self.path(r) for r in runs])

    def read(self) -> DataFrame:
        """The newest row of every key."""
        runs = self.current()
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return latest_by(self._rows(runs), self.keys, self.sequence_by)

    def merge(self, after: int = 8) -> None:
        """Merge the newest runs once there are more than ``after``."""
        complete, current = self.complete(), self.current()
        if len(current) <= after:
            return
        for run in set(complete) - set(current):
            self._files.delete(self._path(self.path(run)), True)
        size, taken = self.bytes_of(current[-1]), [current[-1]]
        for run in reversed(current[:-1]):
            own = self.bytes_of(run)
            if own > 2 * size and len(taken) > 1:
                break
            taken.insert(0, run)
            size += own
        merged = latest_by(self._rows(taken), self.keys, self.sequence_by)
        merged.write.mode("overwrite").parquet(self.path((taken[0][0], taken[-1][1])))
