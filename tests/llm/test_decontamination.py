import random

import numpy as np
import pyarrow as pa

from sourcetrail.llm import decontamination
from tests.llm import helpers


def test_planted_items(spark):
    r = random.Random(4)
    vocabulary = ["".join(r.choice("aeioulnrst") for _ in range(r.randint(2, 6))) for _ in range(2000)]
    items = [[r.choice(vocabulary) for _ in range(r.choice([6, 15, 30, 60]))] for _ in range(40)]
    texts, truth = [], set()
    for i in range(120):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 200))]
        if i % 3 == 0:
            n = r.randrange(len(items))
            item = list(items[n])
            for at in range(4, len(item) if len(item) > 10 else 0, 9):  # every ninth word is another one
                item[at] = "changed"
            at = r.randint(0, len(words))
            words[at:at] = [w.upper() + "," for w in item]
            truth.add((i, n))
        texts.append(" ".join(words))
    texts += [None, "", "word " * 50_000, texts[0]]
    truth |= {(len(texts) - 1, n) for i, n in truth if i == 0}
    table = spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(items)] + [(90, None, "x"), (91, "two words", "x")], "item_id long, text string, row string")
    found = decontamination.leaks(helpers.documents(spark, texts), table).collect()
    assert {(x.doc_id, x.item_id) for x in found} == truth
    for x in found:
        assert x.agree <= x.length <= len(items[x.item_id]) and x.agree >= decontamination.AGREE * x.length


def test_empty_tables(spark):
    docs, none = helpers.documents(spark, ["a b c d e f g"]), spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(docs, none).collect() == []
    assert decontamination.leaks(helpers.documents(spark, []), none).collect() == []


def test_alignment():
    doc, item = np.arange(100, dtype=np.uint64), np.arange(20, 50, dtype=np.uint64)
    assert decontamination.align(doc, item, 20) == (0, 30, 30)
    changed = item.copy()
    changed[[5, 15]] = 777
    assert decontamination.align(doc, changed, 20) == (0, 30, 28)
    assert decontamination.align(doc, item, 0) is None and decontamination.align(doc, item, 500) is None


def test_changes_near_the_ends_of_short_overlaps():
    for n in range(5, 16):
        item = np.arange(n, dtype=np.uint64)
        for at in range(n):
            doc = np.concatenate([[900, 901], item, [902]]).astype(np.uint64)
            doc[2 + at] = 777
            found = decontamination.align(doc, item, 2)
            assert found and found[1] >= min(decontamination.OVERLAP, n) and found[2] >= decontamination.AGREE * found[1]
    doc = np.arange(40, dtype=np.uint64)
    doc[[9, 19, 29, *range(10), *range(30, 40)]] = 777
    assert decontamination.align(doc, np.arange(40, dtype=np.uint64), 0)[1] >= 19
    doc[15:25:2] = 777
    assert decontamination.align(doc, np.arange(40, dtype=np.uint64), 0) is None


def test_short_items_and_scripts_without_spaces(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    items, texts, truth = [], [], set()
    for n in [1, 2, 3, 4, *range(5, 15)]:
        items.append([words.pop() for _ in range(n)])
        for at in range(n):  # one word is another one; items of fewer than 5 stay as they are
            own = [w if n < 5 or i != at else "changed" for i, w in enumerate(items[-1])]
            truth.add((len(texts), len(items) - 1))
            texts.append(" ".join([*r.sample(words[:2000], 9), *own, *r.sample(words[:2000], 9)]))
    for n in range(1, 4):  # items 1 to 3 have 2 to 4 tokens
        texts.append(" ".join([*items[n][: n // 2], "changed", *items[n][n // 2 + 1 :]]))
    items.append(["\u6771\u4eac\u90fd\u306f\u65e5\u672c\u306e\u9996\u90fd\u3067\u3042\u308b"])
    truth.add((len(texts), len(items) - 1))
    texts.append("\u6628\u65e5" + items[-1][0].replace("\u672c", "\u672b") + "\u304b")
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    found = decontamination.leaks(helpers.documents(spark, texts), table).collect()
    assert {(x.doc_id, x.item_id) for x in found} == truth


def test_documents_are_scanned_in_blocks_and_seeds_stay_within_their_document(monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(6)]
    texts = [" ".join(rng.choice(words, n)) for n in rng.integers(0, 30, 300)] + [None, "", "w1", "w1 w1 w2 w1"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], ["a", "b", "c"])
    masks = tuple(sorted({m for n in (1, 2, 3, 5, 12) for m in decontamination.masks_of(n)}))
    everything = np.full(decontamination.FILTER_BITS // 8, 255, np.uint8)
    own, calls = decontamination.seed_hashes, []
    wanted, cache = [], decontamination.WordHashes()
    for i, text in enumerate(texts):
        pairs, t = [], decontamination.tokens(text, cache)
        for mask in masks:
            seen = set()
            for place, h in enumerate(own(t, mask).view(np.int64).tolist()):
                if len(mask) >= decontamination.LEAST_ITEM - 1 or h not in seen:
                    pairs.append((h, place))
                seen.add(h)
        if pairs:
            wanted.append((i, t.view(np.int64).tolist(), pairs))

    monkeypatch.setattr(decontamination, "seed_hashes", lambda t, mask: calls.append(mask) or own(t, mask))
    for block in (1 << 14, 100, 1):
        monkeypatch.setattr(decontamination, "BLOCK", block, raising=False)
        out = [r for b in decontamination._scan(everything, masks)(iter([batch])) for r in b.to_pylist()]
        assert [(r["doc_id"], r["tokens"], list(zip(r["seeds"], r["places"], strict=True))) for r in out] == wanted
        assert block != 1 << 14 or len(calls) == len(masks)  # once for all documents, not once for each
