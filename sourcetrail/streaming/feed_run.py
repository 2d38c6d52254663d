"""The event feeds from their landing folders to current state, as one triggered run.

One stream reads the lines of all feeds, so they share a checkpoint.  Every batch goes to several tables of each feed it
touches: ``raw`` has all lines with their types and what was rescued, ``checked`` the normalised rows, those that break a
rule apart from the accepted ones and with the rules' names, and ``counts`` one row per rule.  A batch that is run again
replaces exactly its folders.  The accepted rows of a feed then become the current state of its keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcetrail import contract as K
from sourcetrail.operators import cdc, quality
from sourcetrail.operators.observed import SCHEMA, BatchCounts
from sourcetrail.sources import feeds
from sourcetrail.streaming import latest_state


@dataclass(frozen=True)
class Feed:
    """How the events of one folder become current rows."""

    name: str
    ddl: str
    keys: list[str]
    sequence_by: str
    rules: quality.Rules
    warnings: quality.Rules = field(default_factory=dict)
    normalise: Callable[[DataFrame], DataFrame] = lambda events: events

    def normal(self, raw: DataFrame) -> DataFrame:
        return self.normalise(raw.drop(*cdc.LINEAGE_COLUMNS))


def review_feeds(terms: K.Terms = K.DEFAULT_TERMS) -> dict[str, Feed]:
    """The five feeds of a review, by folder."""
    decisions = f"{terms.prefix}_decisions"
    rules = {
        "cases": (["case_id"], "created_at", quality.case_rules(), quality.case_warnings(), None),
        decisions: (
            ["finding_id"], "decided_at", quality.classifier_rules(), quality.classifier_warnings(),
            lambda events: cdc.normalize_classifier_decisions(events, terms),
        ),
        "review_decisions": (
            ["review_id", "finding_id"], "decided_at", quality.review_decision_rules(), {}, cdc.normalize_review_decisions,
        ),
        "attestations": (["review_id"], "submitted_at", quality.attestation_rules(), {}, None),
        "attestation_verifications": (["review_id"], "verified_at", quality.verification_rules(), {}, None),
    }
    ddl = terms.feeds()
    return {
        name: Feed(name, ddl[name], keys, sequence, own, warnings, normalise or (lambda events: events))
        for name, (keys, sequence, own, warnings, normalise) in rules.items()
    }


def _packed(df: DataFrame) -> DataFrameWriter:
    """Events repeat most of what they hold; their tables are written with a closer compression than usual."""
    return df.write.mode("overwrite").option("compression", "zstd")


class FeedRun:
    """The tables of a run below ``root``."""

    def __init__(self, spark: SparkSession, landing: str, root: str, known: dict[str, Feed] | None = None):
        self.spark, self.landing, self.root = spark, landing, root
        self.feeds = review_feeds() if known is None else known

    def path(self, table: str, feed: str) -> str:
        return f"{self.root}/{table}/{feed}"

    def ingest(self, glob: str = "*.json") -> None:
        """Take in the lines that have arrived since the last run."""
        lines = (
            self.spark.readStream.format("text").option("pathGlobFilter", glob).load(f"{self.landing}/*")
            .select("value", F.col("_metadata.file_path").alias("_source_file"))
            .withColumn("feed", F.regexp_extract("_source_file", "/([^/]+)/[^/]+$", 1))
            .where((F.trim("value") != "") & F.col("feed").isin(list(self.feeds)))
        )
        stream = lines.writeStream.option("checkpointLocation", f"{self.root}/_checkpoints/ingest")
        stream.trigger(availableNow=True).foreachBatch(self._take).start().awaitTermination()

    def _take(self, batch: DataFrame, number: int) -> None:
        folder = f"{self.root}/lines/batch={number}"
        _packed(batch).partitionBy("feed").parquet(folder)  # written once, read by feed
        lines = self.spark.read.schema(batch.schema).parquet(folder)
        counts = BatchCounts(number)
        for name in sorted(r.feed for r in lines.select("feed").distinct().collect()):  # one of a few folders
            feed = self.feeds[name]
            own = lines.where(F.col("feed") == name).drop("feed")
            parsed = feeds.parse_feed(own, feed.ddl).withColumn("_ingested_at", F.current_timestamp())
            raw = self._written(parsed, "raw", name, number)
            normal = counts.observe(feed.normal(raw), name, feed.warnings, "warn")
            normal = counts.observe(normal, name, feed.rules, "drop")
            checked = normal.withColumn("broken_rules", quality.broken_rules(feed.rules))
            checked = checked.withColumn("accepted", F.size("broken_rules") == 0)
            _packed(checked).partitionBy("accepted").parquet(f"{self.path('checked', name)}/batch={number}")
        table = counts.table(self.spark).coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.root}/counts/batch={number}")
        self._remove(folder)

    def _written(self, df: DataFrame, table: str, feed: str, number: int) -> DataFrame:
        path = f"{self.path(table, feed)}/batch={number}"
        _packed(df).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def schema_of(self, feed: Feed):
        return feed.normal(self.spark.createDataFrame([], feed.ddl)).schema

    def _checked(self, name: str, accepted: bool) -> str:
        return f"{self.path('checked', name)}/batch=*/accepted={str(accepted).lower()}"

    def update(self, name: str) -> None:
        """Bring the current state of a feed up to date with its accepted rows."""
        feed = self.feeds[name]
        accepted = self.spark.readStream.schema(self.schema_of(feed)).parquet(self._checked(name, True))
        latest_state.start_latest_state(
            accepted, feed.keys, feed.sequence_by, self.path("current", name), f"{self.root}/_checkpoints/{name}"
        ).awaitTermination()

    def run(self) -> None:
        """All feeds to their current state."""
        self.ingest()
        for name in self.feeds:
            if self._exists(self._checked(name, True)):
                self.update(name)

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), folder

    def _exists(self, glob: str) -> bool:
        files, folder = self._folder(glob)
        return len(files.globStatus(folder) or []) > 0

    def _remove(self, path: str) -> None:
        files, folder = self._folder(path)
        files.delete(folder, True)

    def _read(self, glob: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(glob) if self._exists(glob) else self.spark.createDataFrame([], schema)

    def current(self, name: str) -> DataFrame:
        """The newest accepted event of every key."""
        feed = self.feeds[name]
        return latest_state.read_latest_state(
            self.spark, self.path("current", name), self.schema_of(feed), feed.keys, feed.sequence_by
        )

    def quarantined(self, name: str) -> DataFrame:
        """Rows that were kept out, with the names of the rules they break."""
        fields = self.schema_of(self.feeds[name]).fields
        rules = T.StructField("broken_rules", T.ArrayType(T.StringType()))
        return self._read(self._checked(name, False), T.StructType([*fields, rules]))

    def counts(self) -> DataFrame:
        """Per feed and rule: rows seen and rows that failed, over all batches."""
        rows = self._read(f"{self.root}/counts/batch=*", SCHEMA)
        return rows.groupBy("source", "rule", "action").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_failed").alias("n_failed"))
