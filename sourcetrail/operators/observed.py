"""What rules count while data flows by, as rows of a table.

Batch runs observe through an ``Observation``, streams through the progress of their query.  Both end as the same rows:
source, batch, rule, action, n_rows, n_failed."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from sourcetrail.operators.quality import Rules, expect

SCHEMA = "source string, batch long, rule string, action string, n_rows long, n_failed long"


def _rows(source: str, batch: int, action: str, counts: dict) -> list[tuple]:
    n = counts["n_rows"]
    return [(source, batch, rule, action, n, failed) for rule, failed in counts.items() if rule != "n_rows"]


class BatchCounts:
    """Collects the counts of the writes of one run.  Each observed frame is to be written once."""

    def __init__(self, batch: int = 0):
        self.batch = batch
        self._observed: list[tuple[str, str, Observation]] = []

    def observe(self, df: DataFrame, source: str, rules: Rules, action: str = "warn") -> DataFrame:
        """The same rows; ``action`` names what the caller does with those that fail."""
        if not rules:
            return df
        observation = Observation()
        self._observed.append((source, action, observation))
        return expect(df, rules, "warn", observation)

    def rows(self) -> list[tuple]:
        """Counts of what has been written; waits for it."""
        return [row for source, action, seen in self._observed for row in _rows(source, self.batch, action, seen.get)]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), SCHEMA)


def stream_expect(df: DataFrame, source: str, rules: Rules, action: str = "warn") -> DataFrame:
    """Rules on a stream, counted under a name that a ``StreamCounts`` understands."""
    return expect(df, rules, action, f"expect:{action}:{source}") if rules else df


class StreamCounts(StreamingQueryListener):
    """Collects the counts of all streams of a session from their progress.  A batch that is run again counts once."""

    def __init__(self):
        self._seen: dict[tuple, list[tuple]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, counts in progress.observedMetrics.items():
            kind, _, rest = name.partition(":")
            if kind == "expect":
                action, _, source = rest.partition(":")
                self._seen[str(progress.id), progress.batchId, name] = _rows(source, progress.batchId, action, counts.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self) -> list[tuple]:
        return [row for rows in self._seen.values() for row in rows]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), SCHEMA)


def fail_outcome(df: DataFrame, rules: Rules) -> str:
    """What becomes of a run whose rules abort it: "passed", or the message of the first row that breaks one."""
    try:
        expect(df, rules, "fail").write.format("noop").mode("overwrite").save()
    except PySparkException as error:
        broken = re.search(r"expectation failed: \w+(?:, \w+)*", str(error))
        if broken is None:
            raise
        return broken[0]
    return "passed"
