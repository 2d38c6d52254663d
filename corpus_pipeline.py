"""The corpus pipeline: documents through toxicity, near copies, repeated passages, benchmark leaks, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcetrail.llm import toxicity
from sourcetrail.llm.decontamination import leaks
from sourcetrail.llm.packing import pack
from sourcetrail.llm.queries import TOXIC_FROM, TOXICITY_FOLDS, TOXICITY_HELD_OUT
from sourcetrail.llm.repeats import without_repeats
from sourcetrail.llm.set_join import classes_of_rows, text_hashes
from sourcetrail.llm.tables import crc_mod, is_empty, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold; null and empty texts stay."""
    learn = crc_mod("doc_id", TOXICITY_FOLDS) != TOXICITY_HELD_OUT
    model = toxicity.fit(docs.where(learn), table(spark, sf_dir, "labels", "doc_id", "toxic").where(learn))
    scored = toxicity.with_scores(docs.select(*COLUMNS), model, "toxicity_score")
    return scored.where((F.col("toxicity_score") < TOXIC_FROM) | (F.coalesce("text", F.lit("")) == "")).select(*COLUMNS)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: of each class of near copies the row with the smallest id stays.

    Rows are told apart by id and text, so rows that share an id but not their text are as good as any others.  Of rows
    without an id one of each class stays, beside the one with an id.  Documents without words are in no class and stay;
    of rows that share both id and text one stays, without words and id all.
    """
    docs = docs.select(*COLUMNS)
    key = ["doc_id", "text_hash", "second_hash"]
    rows = classes_of_rows(docs, k=5, percent=80).groupBy(*key).agg(F.max("stands").alias("stands"), F.count("*").alias("n"), F.max("n_shingles").alias("n_shingles"))
    rows = written(rows, "near-copies")
    # ids of which nothing stays go by the id alone: a narrow table, which is most of it
    ids = rows.where("doc_id is not null").groupBy("doc_id").agg(F.max("stands").alias("stands"))
    gone = written(ids.where("not stands").select("doc_id"), "near-copy-ids")
    named = docs.withColumn("own_id", F.col("doc_id").cast("long")).join(gone.withColumnRenamed("doc_id", "own_id"), "own_id", "left_anti")
    more_than_one = (F.col("n") > 1) & ((F.col("n_shingles") > 0) | F.col("doc_id").isNotNull())
    rows = written(rows.where(~F.col("stands") | more_than_one).join(gone, "doc_id", "left_anti"), "near-copy-rows")
    if is_empty(rows):
        return named.select(*COLUMNS)
    named = named.select("*", *text_hashes())

    def among(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(*[F.col(c).alias(f"{c}_") for c in key])
        same = F.col("own_id").eqNullSafe(F.col("doc_id_")) & (F.col("text_hash") == F.col("text_hash_")) & (F.col("second_hash") == F.col("second_hash_"))
        return named.join(keys, same, how)

    kept = among(rows, "left_anti").select(*COLUMNS)
    twice = rows.where("stands")
    if is_empty(twice):
        return kept
    once = among(twice, "left_semi").groupBy("own_id", "text_hash", "second_hash").agg(F.min(F.struct(*COLUMNS)).alias("d"))
    return kept.union(once.select("d.*"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 400 bytes that occur again; n_chars follows the text."""
    cut = without_repeats(docs.select(*COLUMNS), min_length=400)
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leak_id"), "text_hash").distinct()
    named = docs.select(*COLUMNS, F.xxhash64("text").alias("own_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("leak_id")) & (F.col("own_hash") == F.col("text_hash"))
    return named.join(found, same, "left_anti").select(*COLUMNS)


def pack_rest(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token sequences of what is left."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_class),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("packing", pack_rest),
]

#: Model fitting, components and packing are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
