import hashlib
import random

import pyarrow as pa
import pytest

from sourcetrail.llm import repeats
from sourcetrail.llm.repeats import merged, without_repeats
from tests.llm import helpers


def cut(spark, texts, length, **more):
    rows = without_repeats(helpers.documents(spark, texts), length, **more).orderBy("doc_id").collect()
    return [
        (len((t or "").encode()), sum(s.end - s.begin for s in x.removed_spans), len(x.removed_spans), hashlib.sha256(bytes(x.kept_bytes)).hexdigest())
        for t, x in zip(texts, rows, strict=True)
    ]


@pytest.mark.parametrize(("length", "alphabet", "seed"), [(24, "ab", 1), (40, "abcé\0", 2)])
def test_equals_counting_all_strings(spark, length, alphabet, seed):
    r = random.Random(seed)
    base = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 300))) for _ in range(12)]
    texts = []
    for _ in range(50):
        t = "".join(r.choice(alphabet + "xyz") for _ in range(r.randint(0, 50)))
        for _ in range(r.randint(0, 3)):
            b = r.choice(base)
            at = r.randint(0, len(b))
            t += b[at : at + r.randint(0, 120)] + "".join(r.choice(alphabet) for _ in range(r.randint(0, 20)))
        texts.append(t)
    texts += [None, "", "a" * 300, "a" * (length - 1), "ab" * 100, "xyzw" * 60, texts[0], texts[0]]
    want = helpers.without_repeats(texts, length)
    assert cut(spark, texts, length) == want
    assert cut(spark, texts, length, bucket_rows=1) == want  # everything by the way for hot buckets


def test_other_columns_long_texts_and_empty_tables(spark):
    r = random.Random(5)
    passage = "".join(r.choice("abcdefgh ") for _ in range(450))
    long = "".join(r.choice("abcdefgh ") for _ in range(200_000))
    df = helpers.documents(spark, [long + passage, passage[:420] + "!", "short"])
    rows = without_repeats(df, 400).orderBy("doc_id").collect()
    assert rows[0].removed_spans == [(200_000, 200_420)] and rows[0].kept_text == long + passage[420:] and rows[0]["row"] == "a"
    assert rows[1].kept_text == "!" and rows[2].kept_text == "short" and rows[2].removed_spans == []
    assert without_repeats(helpers.documents(spark, []), 400).collect() == []


def test_rows_that_share_an_id(spark):
    text = "0123456789" * 3
    rows = without_repeats(helpers.documents(spark, [text, text, "other text with enough letters", None], [1, 1, 1, None]), 30).collect()
    assert sorted(len(x.kept_bytes) for x in rows) == [0, 0, 0, 30]


def test_merged():
    assert merged([(5, 9), (0, 3), (3, 4), (8, 12)]) == [[0, 4], [5, 12]]


def test_a_context_at_the_end_of_a_text_is_compared_like_any_other(spark, monkeypatch):
    """It has a hash in each stretch it has windows in, equal to that of all contexts that share one of them."""
    r, least = random.Random(8), 120
    reach = least - repeats.anchor_length(least)
    text = r.randbytes(reach + least)
    whole, cut_left, cut_right = (reach, text), (reach - 31, text[31:]), (reach, text[:-31])
    rows = [(1, c1, 0, lead, data) for c1, (lead, data) in enumerate((whole, cut_left, cut_right))]
    names = ["bucket", "c1", "c2", "lead", "context"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)
    got = {(x["stretch"], x["c1"]): x["shared"] for b in repeats._shared(least)(iter([batch])) for x in b.to_pylist()}
    stretches = repeats._stretches(least)
    assert {c for _, c in got} == {0, 1, 2} and len(got) > 2 * len(stretches)
    assert all(h is not None and h == got[i, 0] for (i, _), h in got.items())
    texts = [t.hex() for t in (text, text[31:], text[:-31], b"")]
    want = helpers.without_repeats(texts, least)
    assert cut(spark, texts, least, bucket_rows=1) == want
    monkeypatch.setattr(repeats, "SENT_ROWS", 0)
    assert cut(spark, texts, least, bucket_rows=1) == want
