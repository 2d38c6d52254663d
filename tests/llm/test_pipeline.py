import random

import numpy as np

import corpus_pipeline as pipeline
from sourcetrail.llm.packing import Encoder
from tests.llm import helpers
from tests.llm.test_packing import PATH


def test_stages_against_plain_versions(spark, tmp_path):
    r = random.Random(8)
    words = ["".join(r.choice("abdeilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(3000)]

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n))

    texts = [prose(r.randint(30, 120)) for _ in range(300)]
    for i in range(0, 300, 6):
        texts[i] += f" {r.choice(['grolk', 'vexx'])} {prose(5)}"  # toxic
    toxic = {i for i in range(0, 300, 6)}
    item, passage = prose(25), prose(90)
    texts += [texts[1], texts[1] + " more", prose(20) + " " + passage + " " + prose(20), prose(30) + " " + passage, prose(10) + " " + item + " " + prose(20), None, "", "x"]
    lang = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1) for i, t in enumerate(texts)], lang)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    state, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        stage(spark, state, str(tmp_path)).write.parquet(f"{tmp_path}/{name}.parquet")
        state = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        assert tuple(state.columns) == pipeline.COLUMNS
        seen.append({x.doc_id: x.text for x in state.collect()})
    clean, single, cut, rest = seen
    assert set(clean) == set(range(len(texts))) - toxic

    ids = sorted(clean)
    classes = helpers.jaccard_classes([clean[i] for i in ids], 5, 80)
    assert set(single) == {i for at, i in enumerate(ids) if classes[at][1] == at}

    ids = sorted(single)
    want = helpers.without_repeats([single[i] for i in ids], 400)
    assert set(cut) == set(single)
    assert [len((cut[i] or "").encode()) for i in ids] == [n - gone for n, gone, *_ in want]
    assert sum(w[1] for w in want) >= 2 * len(passage)
    assert set(rest) == set(cut) - {304}

    rows = pipeline.run(spark, str(tmp_path)).collect()
    for i, tokens in zip(rest, Encoder(PATH).encode(list(rest.values())), strict=True):
        own = sorted((x for x in rows if x.doc_id == i), key=lambda x: x.start)
        assert np.concatenate([np.frombuffer(bytes(x.ids), "<u4") for x in own]).tolist() == [*tokens.tolist(), 1]
    assert {x.doc_id for x in rows} == set(rest)


def test_repeated_and_null_ids_in_the_near_copy_stage(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "", "", 1), (1, "a b c d e f", "", "", 1), (None, "a b c d e f", "", "", 1), (2, None, "", "", 1), (2, None, "", "", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.keep_one_of_each_class(spark, docs, "").collect()
    assert sorted((x.doc_id or 0) for x in kept) == [0, 1, 2]


def test_texts_of_one_id_are_told_apart_and_null_ids_are_compared(spark):
    copies = [f"{w} b c d e f g h i j k l" for w in ("a", "x")]  # seven of nine shingles: no near copies of each other
    rows = [(1, copies[0]), (1, "m n o p q r s t"), (2, "m n o p q r s t u"), (2, "v w x y z v w x"), (3, "v w x y z v w x")]
    rows += [(None, copies[1]), (None, copies[1]), (None, "only this one has no id"), (None, None), (None, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "", "", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((x.doc_id or 0, x.text or "") for x in pipeline.keep_one_of_each_class(spark, docs, "").collect()))
    want = [(0, ""), (0, ""), (0, "only this one has no id"), (0, copies[1]), (1, copies[0]), (1, "m n o p q r s t"), (2, "v w x y z v w x"), (4, "")]
    assert kept == sorted(want)
