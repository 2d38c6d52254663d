import random

import numpy as np

from sourcetrail.llm import toxicity
from tests.llm import helpers


def corpus(seed, n=600):
    r = random.Random(seed)
    words = ["".join(r.choice("abdeilmnorstu") for _ in range(r.randint(2, 7))) for _ in range(400)]
    texts, toxic = [], []
    for _ in range(n):
        text = [r.choice(words) for _ in range(r.randint(10, 60))]
        bad = r.random() < 0.15
        if bad:
            for _ in range(r.randint(1, 3)):
                text[r.randrange(len(text))] = r.choice(["grolk", "vexx" + r.choice(words), "Grolk!"])
        texts.append(" ".join(text))
        toxic.append(int(bad))
    return texts, toxic


def test_held_out_documents(spark):
    texts, toxic = corpus(1)
    docs = helpers.documents(spark, [*texts, None, "", "grolk " * 20000], [*range(600), 600, 601, 602])
    labels = spark.createDataFrame([(i, t, "x") for i, t in enumerate(toxic[:400])] + [(1, None, "x"), (None, 1, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels)
    scored = {x.doc_id: x.score for x in toxicity.with_scores(docs, model).collect()}
    found = [scored[i] >= 0.3 for i in range(400, 600)]
    truth = [bool(t) for t in toxic[400:]]
    assert sum(f == t for f, t in zip(found, truth, strict=True)) >= 195
    assert scored[600] == scored[601] < 0.3 <= scored[602]
    assert "vexx" in model.voters.beginnings and {"grol", "grolk"} & {*model.voters.beginnings, *model.voters.words}


def test_without_labels_or_rows(spark):
    docs = helpers.documents(spark, ["a", None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(x.score < 1e-6 for x in toxicity.with_scores(docs, toxicity.fit(docs, none)).collect())
    empty = helpers.documents(spark, [])
    assert toxicity.with_scores(empty, toxicity.fit(empty, none)).collect() == []


def test_label_model_shares_weight_of_correlated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    vote = np.where(y, rng.random(4000) < 0.7, rng.random(4000) < 0.02).astype(float)
    other = np.where(y, rng.random(4000) < 0.7, rng.random(4000) < 0.02).astype(float)
    votes = np.stack([vote, vote, vote, other], axis=1)
    posterior, related = toxicity.label_model(votes, 0.2, np.where(votes.any(1), 0.9, 0.05))
    assert related[0, 1] > 0.9 and related[0, 3] < 0.2
    assert np.mean((posterior > 0.5) == y) > 0.9
