"""Folding of all forms of a letter, dictionaries of any size, tables that are built once."""

import os
import shutil
import unicodedata

from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.functions import text as X
from sourcetrail.operators import extract
from sourcetrail.plans import review_tables
from sourcetrail.streaming import ingest


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def test_folding_of_every_form(spark):
    texts = [
        "Ｈｅｍｏｇｌｏｂｉｎａ", "ﬁbrinogênio ﬂ", "①② ½ ㎎", "Ångström Å", "ℌ𝔥 𝐊", "Ǆ ĳ", "é é", "…–“x”", "日本 한국", "ЙЁ ΐ", "", "plain",
        "x" * 5000 + "ﬀ", "ﷺ",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.strip_accents(F.col("t"))).collect()]
    assert got == [plain(t) if "한" not in t else t for t in texts]
    assert got[0] == "Hemoglobina"


def test_every_decomposition_is_used(spark):
    chars = [c for c in X._BASES if not unicodedata.category(c).startswith("M")]
    df = spark.createDataFrame([(c,) for c in chars], "t string").repartition(8)
    wrong = [r for r in df.select("t", X.strip_accents(F.col("t")).alias("p")).collect() if r.p != X._BASES[r.t]]
    # marks without a combining class of their own are dropped from decompositions as well
    assert all(any(unicodedata.category(c).startswith("M") for c in X._BASES[r.t]) for r in wrong) and len(chars) > 5000


SHEET = "Data da coleta: 12/03/2026\nExame 77777: 4,2 mEq/L\nExame 99: 5 g\nSódio: 140 mEq/L\n"


def test_a_dictionary_of_100_000_names_on_batch_and_stream(spark, tmp_path):
    table = spark.range(100_000).select(F.concat(F.lit("Ｅｘáｍｅ "), "id").alias("name"), F.concat(F.lit("X"), "id").alias("test_code"))
    table = table.union(spark.createDataFrame([("EXAME 99", "A99"), ("exame 99", "Z99")], "name string, test_code string")).where("name <> 'Ｅｘáｍｅ 99'")
    pages = spark.createDataFrame(
        [("C", "D", 1, SHEET, True, True)],
        "case_id string, document_id string, page_num int, page_text string, is_textual boolean, synthetic_declared boolean",
    ).withColumn("ingested_at", F.current_timestamp())
    expected = [("A99", True), ("UNK_SODIO", False), ("X77777", True)]
    batch = extract.extract_measurements(pages, table)
    got = sorted((r.test_code, r.test_known) for r in batch.collect())
    assert got == expected
    assert batch.columns == extract.extract_measurements(pages).columns
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    pages.write.parquet(source)
    stream = spark.readStream.schema(pages.schema).parquet(source)
    ingest.append_table(extract.extract_measurements(stream, table), out, check).awaitTermination()
    assert sorted((r.test_code, r.test_known) for r in spark.read.parquet(out).collect()) == expected
    assert sorted(r.test_code for r in extract.extract_measurements(pages, K.TEST_SYNONYMS).collect())[0] == "NA"


def test_tables_are_built_once_and_follow_their_input(spark, tmp_path):
    folder, given = str(tmp_path), "/root/testdata/sf0.001"
    shutil.copy(f"{given}/orders.parquet", f"{folder}/orders.parquet")
    built = []

    def build():
        built.append(1)
        return {"a": spark.range(3), "b": spark.range(len(built))}

    for _ in range(2):
        a, b = review_tables.kept(spark, folder, build, "a", "b")
        assert (a.count(), b.count(), len(built)) == (3, 1, 1)
    os.utime(f"{folder}/orders.parquet", (1, 1))
    assert review_tables.kept(spark, folder, build, "b")[0].count() == 2
