"""Tables of rows that belong to cases, and their refresh for the cases that changed.

A table is a folder partitioned by a hash bucket of the case.  Reading one case opens one bucket; reading a set of
cases prunes buckets at run time.  A refresh recomputes the rows of the changed cases only and swaps the buckets they
are in by Spark's dynamic partition overwrite: what a bucket holds of other cases is carried over, all other buckets stay
as they are.  Every bucket written has one marker row, so a bucket whose last case went empty is replaced as well."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BUCKET, LIVE = "case_bucket", "is_row"
#: Computes a table's rows from tables read by name, already cut to the changed cases.
View = Callable[[Callable[[str], DataFrame]], DataFrame]


class CaseTables:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, key: str = "case_id"):
        self.spark, self.root, self.buckets, self.key = spark, root, buckets, key

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def bucket_of(self, case: Column) -> Column:
        return F.pmod(F.xxhash64(case), F.lit(self.buckets)).cast("int")

    def _rows(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name)).where(LIVE)

    def read(self, name: str, case: str | None = None, cases: DataFrame | None = None) -> DataFrame:
        """A table's rows: all, those of one case, or those of a set of cases."""
        rows = self._rows(name)
        if case is not None:
            rows = rows.where((F.col(BUCKET) == self.bucket_of(F.lit(case))) & (F.col(self.key) == case))
        if cases is not None:
            rows = self._among(rows, cases, "left_semi")
        return rows.drop(BUCKET, LIVE)

    def _among(self, rows: DataFrame, cases: DataFrame, how: str) -> DataFrame:
        """Joined by bucket and case, a missing case being a case of its own; the bucket prunes what is read."""
        wanted = cases.select(F.col(self.key).alias("wanted"), self.bucket_of(F.col(self.key)).alias("wanted_bucket")).distinct()
        same = (F.col(BUCKET) == F.col("wanted_bucket")) & F.col(self.key).eqNullSafe(F.col("wanted"))
        return rows.join(wanted, same, how)

    def replace(self, name: str, rows: DataFrame, cases: DataFrame | None = None) -> None:
        """Make ``rows`` the rows of ``cases``; without cases, the whole table.  ``rows`` hold no other cases."""
        rows = rows.withColumns({BUCKET: self.bucket_of(F.col(self.key)), LIVE: F.lit(True)})
        buckets = list(range(self.buckets))
        mode = "static"
        if cases is not None:
            found = cases.select(self.bucket_of(F.col(self.key)).alias("b")).distinct().collect()  # a number per bucket at most
            buckets, mode = sorted(r.b for r in found), "dynamic"
            if not buckets:
                return
            kept = self._among(self._rows(name).where(F.col(BUCKET).isin(buckets)), cases, "left_anti")
            rows = kept.unionByName(rows)
        markers = self.spark.createDataFrame([(b, False) for b in buckets], f"{BUCKET} int, {LIVE} boolean")
        # rebalanced: small buckets share a task, one with a very large case is split
        out = rows.unionByName(markers, allowMissingColumns=True).hint("rebalance", BUCKET)
        out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKET).parquet(self.path(name))

    def refresh(self, views: dict[str, View], cases: DataFrame) -> None:
        """Recompute every view, in the given order, for these cases.  A view may read those before it."""
        for name, view in views.items():
            self.replace(name, view(lambda source: self.read(source, cases=cases)), cases)

    def upsert(self, name: str, rows: DataFrame, ids: list[str], cases: DataFrame) -> None:
        """Add rows of ``cases``; a row with the ids of one that is there replaces it."""
        before = self.read(name, cases=cases).join(rows.select(*ids), ids, "left_anti")
        self.replace(name, before.unionByName(rows), cases)


def start_refresh(
    rows: DataFrame, tables: CaseTables, source: str, ids: list[str], views: dict[str, View], checkpoint: str
) -> StreamingQuery:
    """Take a stream of rows into the table ``source`` and bring the views up to date with every batch, then stop.

    A batch is written once as a table of changes, ``<source>_changes``; its cases are what is recomputed.  A batch that
    is run again replaces the same changes, rows and cases, so the outcome is that of one run.  Rows that repeat ``ids``
    within a batch are one row.  The tables need to exist: ``create`` makes empty ones."""

    def take(batch: DataFrame, number: int) -> None:
        path = f"{tables.path(source)}_changes/batch={number}"
        batch.dropDuplicates(ids).write.mode("overwrite").parquet(path)
        changes = tables.spark.read.schema(batch.schema).parquet(path)
        cases = changes.select(tables.key).distinct()
        tables.upsert(source, changes, ids, cases)
        tables.refresh(views, cases)

    return (
        rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(take).start()
    )


def create(tables: CaseTables, source: str, schema, views: dict[str, View]) -> None:
    """Empty tables with the columns that the source and its views will have."""
    tables.replace(source, tables.spark.createDataFrame([], schema))
    for name, view in views.items():
        tables.replace(name, view(tables.read))
