import numpy as np
import public_tokenizers
import pytest

from sourcetrail.llm import packing
from tests.llm import helpers

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "a  b", "a \n b", "x\n\n  y  ", "  lead", "tail   ", "it's  don't\t z", "<|endoftext|> x<|endoftext|>", "é  b", "a b",
    "a \x1c b", "", None, "1 234  5.6,, !! \r\n ok", "\n a", "same text", "same text", "word " * 9000,
]


def test_stretches_have_the_tokenizers_ids():
    encoder = packing.Encoder(PATH)
    for text, ids in zip(TEXTS, encoder.encode(TEXTS), strict=True):
        assert ids.tolist() == (encoder.tokenizer.encode(text, add_special_tokens=False).ids if text else [])


def test_a_word_that_comes_again_is_not_encoded_again():
    encoder, asked = packing.Encoder(PATH), []
    tokenizer = encoder.tokenizer

    class Noted:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, **how)

    encoder.tokenizer = Noted()
    texts = [f"one w{i} w{i % 7}, é\u3000x" + " " * (i % 3) + "tail" * (i % 5 * 9) for i in range(300)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(texts)] == want
    assert sum("w299" in t for t in asked) == 1 and sum(" w0," in t for t in asked) == 1
    # new words are encoded together: firsts and words beyond LONGEST_WORD come again, the 300 others do not come singly
    assert len(asked) < 2 * (300 + 10)
    encoder.forget()
    assert [x.tolist() for x in encoder.encode(texts)] == want


def test_white_space_before_a_space_is_found_as_by_python():
    import pyarrow as pa
    import pyarrow.compute as pc

    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert all(pc.match_substring_regex(pa.array([f"a{c} b" for c in spaces]), packing._SPACES).to_pylist())
    assert not pc.match_substring_regex(pa.array(["a b"]), packing._SPACES)[0].as_py()


@pytest.mark.parametrize("counts", [{}, {1: 3}, {2048: 7}, {1500: 5, 548: 9, 3: 1}, {i: 3000 // i for i in range(1, 2048)}])
def test_plan_places_every_piece_once(counts):
    plan, filled = packing.plan_for(counts, 2048), {}
    for length, n in counts.items():
        for rank in range(n):
            parts = plan.places(length, rank)
            assert [p[0] for p in parts] == list(np.cumsum([0, *[p[1] for p in parts]])[:-1]) and sum(p[1] for p in parts) == length
            for _, size, sequence, offset in parts:
                filled.setdefault(sequence, []).append((offset, size))
    for parts in filled.values():
        parts.sort()
        ends = np.cumsum([size for _, size in parts])
        assert [offset for offset, _ in parts] == [0, *ends[:-1].tolist()]
        assert ends[-1] == 2048 or ends[-1] & (ends[-1] - 1) == 0
    assert sorted(filled) == list(range(len(filled)))


def test_least_squares_meets_a_histogram_that_combinations_can_fill():
    rows, histogram = packing.combinations_of(64), np.zeros(65)
    for a, n in ((10, 40), (54, 40), (32, 30), (20, 12), (44, 12)):
        histogram[a] = n
    rows = rows[np.all((rows == 0) | (histogram[rows] > 0), axis=1)]
    x = packing.least_squares(rows, histogram)
    made = sum(x[i] * np.bincount(r[r > 0], minlength=65) for i, r in enumerate(rows))
    assert (x >= 0).all() and np.abs(made - histogram).max() < 0.5


def test_pieces_of_all_documents(spark):
    rows = packing.pack(helpers.documents(spark, TEXTS), PATH).collect()
    encoder = packing.Encoder(PATH)
    for i, ids in enumerate(encoder.encode(TEXTS)):
        own = sorted((x for x in rows if x.doc_id == i), key=lambda x: x.start)
        assert np.concatenate([np.frombuffer(bytes(x.ids), "<u4") for x in own]).tolist() == [*ids.tolist(), 1]
        assert {x.doc_tokens for x in own} == {len(ids) + 1}
    assert packing.pack(helpers.documents(spark, []), PATH).collect() == []
