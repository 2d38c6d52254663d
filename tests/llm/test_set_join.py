import random

import numpy as np
import pytest

from sourcetrail.llm import set_join
from sourcetrail.llm.components import components
from tests.llm import helpers


@pytest.mark.parametrize("percent", [80, 90])
def test_linking_sets_share_a_signature(percent):
    rng, seen = np.random.default_rng(percent), 0
    for _ in range(4000):
        size = int(rng.integers(4, 70))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.r_[a[int(rng.integers(0, 1 + size // 5)) :], rng.integers(0, 2**63, int(rng.integers(0, 1 + size // 6))).astype(np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
            seen += 1
            assert len(np.intersect1d(set_join.signatures(a, percent), set_join.signatures(b, percent)))
    assert seen > 200


def test_sketches_differ_in_no_more_than_the_sets():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        b = np.unique(np.r_[a[int(rng.integers(0, 99)) :], rng.integers(0, 2**63, 20).astype(np.uint64)])
        bits = int(np.bitwise_count(set_join.sketch(a) ^ set_join.sketch(b)).sum())
        assert bits <= len(np.setxor1d(a, b))


@pytest.mark.parametrize(("k", "percent", "seed"), [(3, 90, 1), (5, 80, 2)])
def test_classes_equal_all_pairs(spark, k, percent, seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[r.choice(vocabulary) for _ in range(r.choice([4, 12, 40, 150]))] for _ in range(12)]
    texts = []
    for _ in range(160):
        words = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        texts.append(" ".join(words))
    common = " ".join(vocabulary[:30])  # a passage that many texts share
    texts += [f"{common} {' '.join(r.choice(vocabulary) for _ in range(60))}" for _ in range(40)]
    texts += [None, "", " \n\t", "One", "one", "ONE two", "É é", texts[0], texts[0].upper(), "x " * 3000, "x " * 2999 + "y"]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in set_join.jaccard_classes(helpers.documents(spark, texts), k, percent).collect()}
    assert [got[i] for i in range(len(texts))] == helpers.jaccard_classes(texts, k, percent)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = set_join.jaccard_classes(helpers.documents(spark, ["a b c d", "a b c d", "a b c d", "e f g h"], [7, 7, None, None])).collect()
    assert sorted((x.doc_id or 0, x.component_id or 0) for x in rows) == [(0, 0), (0, 7), (7, 7), (7, 7)]
    assert set_join.jaccard_classes(helpers.documents(spark, [])).collect() == []


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5), (None, 3)]
    least = {i: i for e in edges if None not in e for i in e}
    for _ in range(len(least)):
        for u, v in edges:
            if u is not None and v is not None:
                least[u] = least[v] = min(least[u], least[v])
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {x.node: x.component for x in got} == least


def test_signatures_are_gone_when_pairs_are_compared(spark, monkeypatch):
    """They are by far the largest table; the pairs' sets need the disk."""
    seen, links = [], set_join._links

    def looked(docs, profiles, lists, k, percent, scratch):
        assert "sigs" not in profiles.columns
        seen.append([t for t in scratch.tables if "sigs" in t.columns])
        return links(docs, profiles, lists, k, percent, scratch)

    monkeypatch.setattr(set_join, "_links", looked)
    rng = random.Random(3)
    text = [f"w{rng.randrange(500)}" for _ in range(300)]
    texts = [" ".join(text), " ".join(text[1:]), " ".join(text), " ".join(reversed(text)), None]
    rows = set_join.jaccard_classes(helpers.documents(spark, texts)).orderBy("doc_id").collect()
    assert seen == [[]]
    ids = [r.doc_id for r in rows]
    assert [r.component_id for r in rows] == [ids[0]] * 3 + ids[3:]


def test_wide_sketches_rule_out_no_link():
    rng, ruled_out = np.random.default_rng(1), 0
    for _ in range(100):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(600, 4000))).astype(np.uint64))
        kept = a[int(rng.integers(0, len(a) // 3)) :]
        b = np.unique(np.r_[kept, rng.integers(0, 2**63, int(rng.integers(0, 1 + len(a) // 4))).astype(np.uint64)])
        left, right = (set_join.sketch(s, set_join.wide_bits(len(s))).tobytes() for s in (a, b))
        both = len(np.intersect1d(a, b))
        links = 100 * both >= 80 * (len(a) + len(b) - both)
        may = set_join.may_link(len(a), len(b), left, right, 80)
        assert may or not links
        ruled_out += not may
    assert ruled_out > 20


def test_whole_sets_are_made_for_pairs_that_can_link_only(spark, monkeypatch):
    """Long texts that share a passage agree in slices, and a sketch of 1,024 bits rules no pair of them out."""
    made, plain = [], set_join.Scratch.written

    def noted(self, df, label):
        out = plain(self, df, label)
        if label == "set-elements":
            made.append(out.count())
        return out

    monkeypatch.setattr(set_join.Scratch, "written", noted)
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    # 65 % of the words are the same
    common = [r.choice(vocabulary) for _ in range(5200)]
    texts = [" ".join(common + [r.choice(vocabulary) for _ in range(2800)]) for _ in range(6)]
    texts += [texts[0] + " more", " ".join(common)]
    got = set_join.jaccard_classes(helpers.documents(spark, texts)).orderBy("doc_id").collect()
    assert [(x.n_shingles, x.component_id) for x in got] == helpers.jaccard_classes(texts, 5, 80)
    assert sum(made) == 2
