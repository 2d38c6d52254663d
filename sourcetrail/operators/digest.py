"""SHA-256 over the sorted items of a group, exact for groups of any size.

Most groups are short: their items are sorted and joined inside one aggregate and hashed natively.
A group above ``limit`` is never gathered.  Its items are range-sorted over the whole cluster, every
task turns its stretch into joined chunks, and only those chunks flow, in order, through a running
SHA-256.  Memory stays constant; the only sequential part is the hash itself."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GATHER_LIMIT = 50_000


def _chunker(keys: list[str], separator: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = 0
        for batch in batches:
            for key, part in batch.groupby(keys, sort=False, dropna=False):
                row = dict(zip(keys, key))
                row.update(first_item=part["item"].iloc[0], number=number, text=separator.join(part["item"]))
                number += 1
                yield pd.DataFrame([row])

    return run


def _hasher(keys: list[str], separator: str):
    glue = separator.encode()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, suffix = None, None, b""

        def closed() -> pd.DataFrame:
            state.update(suffix)
            return pd.DataFrame([{**dict(zip(keys, current)), "digest": state.hexdigest()}])

        for batch in batches:
            for row in batch.itertuples(index=False):
                key = tuple(None if pd.isna(getattr(row, k)) else getattr(row, k) for k in keys)
                if key != current:
                    if state is not None:
                        yield closed()
                    current, suffix = key, row.suffix.encode()
                    state = hashlib.sha256(row.prefix.encode())
                else:
                    state.update(glue)
                state.update(row.text.encode())
        if state is not None:
            yield closed()

    return run


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be NULL; the key columns of ``left`` are kept."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def sorted_chunks(items: DataFrame, keys: list[str], separator: str) -> DataFrame:
    """Items sorted over the cluster and joined into chunks that together hold every item in order."""
    key_fields = [items.schema[k] for k in keys]
    schema = T.StructType(
        key_fields
        + [
            T.StructField("first_item", T.StringType()),
            T.StructField("number", T.LongType()),
            T.StructField("text", T.StringType()),
        ]
    )
    return (
        items.repartitionByRange(*keys, "item")
        .sortWithinPartitions(*keys, "item")
        .mapInPandas(_chunker(keys, separator), schema)
    )


def streamed_digest(items: DataFrame, keys: list[str], separator: str, frame: DataFrame) -> DataFrame:
    """The digest for groups of any length.  ``items`` has the keys and ``item``."""
    ordered = (
        _null_safe(sorted_chunks(items, keys, separator), frame.select(*keys, "prefix", "suffix"), keys, "inner")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "first_item", "number")
    )
    schema = T.StructType([items.schema[k] for k in keys] + [T.StructField("digest", T.StringType())])
    return ordered.mapInPandas(_hasher(keys, separator), schema)


def ordered_digest(
    items: DataFrame,
    keys: list[str],
    item: Column,
    separator: str,
    frame: DataFrame,
    limit: int = GATHER_LIMIT,
) -> DataFrame:
    """``sha256(prefix + separator.join(sorted(items)) + suffix)`` for every row of ``frame``.

    ``frame`` has the keys, unique and not NULL, with ``prefix``, ``suffix`` and ``n_items``, the
    number of items of the key; NULL items do not count; a key without items gets the digest of prefix and suffix alone.  Both
    frames are read more than once, so pass written tables where they are costly.  With no large
    group, adaptive execution finds the right side of the joins empty and drops the second branch."""
    items = items.select(*keys, item.alias("item")).where("item is not null")
    large = frame.where(F.col("n_items") > limit)
    texts = (
        items.join(large.select(*keys), keys, "left_anti")
        .groupBy(*keys)
        .agg(F.array_join(F.sort_array(F.collect_list("item")), separator).alias("text"))
    )
    gathered = (
        frame.where(F.col("n_items") <= limit)
        .join(texts, keys, "left")
        .select(*keys, F.sha2(F.concat("prefix", F.coalesce("text", F.lit("")), "suffix"), 256).alias("digest"))
    )
    streamed = streamed_digest(items.join(large.select(*keys), keys, "left_semi"), keys, separator, large)
    return gathered.unionByName(streamed)


def tree_digest(items: DataFrame, keys: list[str], item: Column, digits: int = 4) -> DataFrame:
    """Digest of the items of a group that no task needs to hold, whatever their number: keys, digest, n_items.

    Items are hashed and dealt into leaves by the first hexadecimal ``digits`` of their hash.  A leaf's hash is over the
    sorted hashes in it, the digest over the leaves' prefixes and hashes in order.  A group of any size spreads over
    16 ** digits leaves, and its last step sees one hash for each.  It depends on the items and their repeats alone, not on
    their order or on how they are partitioned; ``digits`` is part of its definition.  NULL items do not count; a group
    without items has no row.  Keys may be NULL."""
    # hashes travel as bytes, half as long as their digits and in the same order, and as plain rows: hardly any leaf would
    # shrink in an aggregate before the exchange
    def digits_of(hashed: Column) -> Column:
        return F.lower(F.hex(hashed))

    hashed = items.select(*keys, F.unhex(F.sha2(item.cast("string"), 256)).alias("h")).where("h is not null")
    dealt = hashed.withColumn("leaf", F.substring(digits_of(F.col("h")), 1, digits)).repartition(*keys, "leaf")
    inside = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list("h")), digits_of), ""), 256)
    leaves = dealt.groupBy(*keys, "leaf").agg(F.unhex(inside).alias("h"), F.count("*").alias("n"))
    placed = leaves.select(*keys, F.concat(F.encode("leaf", "UTF-8"), "h").alias("leaf"), "n").repartition(*keys)

    def written(leaf: Column) -> Column:
        return F.concat(F.decode(F.substring(leaf, 1, digits), "UTF-8"), digits_of(F.substring(leaf, digits + 1, 32)))

    ordered = F.array_join(F.transform(F.sort_array(F.collect_list("leaf")), written), "")
    return placed.groupBy(*keys).agg(F.sha2(ordered, 256).alias("digest"), F.sum("n").alias("n_items"))
