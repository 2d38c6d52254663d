"""Pieces of whole texts against the library itself."""

import hashlib

import public_tokenizers
import pyarrow as pa
import pytest

from sourcetrail.llm import piece_codec
from sourcetrail.llm.queries import op13_sentencepiece
from tests.llm.helpers import documents

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b ", "▁a", "a▁b▁", "▁", "\n", "a\tb\r\n  c", "\x00 \x00a", "ﬁ １ é", "日本語 文 ",
    "🙂🙂 \U0001f468‍\U0001f469", "the the the", "x" * 20_000, "wide " * 9000, " " * 700 + "end", "<s> </s> <unk> <0x41>", "a b",
    "the the the", "word\nword word\nword",
]


def same_as_library(rows, texts):
    sp = piece_codec.processor(MODEL)
    expected = sorted((tuple(i), sp.decode(i)) for i in (sp.encode(t or "") for t in texts))
    assert sorted((tuple(r.ids), r.decoded) for r in rows) == expected


@pytest.mark.parametrize("block_chars,buckets", [(16 << 20, 3), (40, 2), (1, 1)])
def test_equals_the_library(spark, block_chars, buckets):
    ids = [None, None, 1, 1, *range(4, len(TEXTS))]
    found = piece_codec.encode(documents(spark, TEXTS, ids).repartition(3), MODEL, block_chars, buckets)
    assert found.columns == ["doc_id", "ids"]
    rows = piece_codec.decode(found, MODEL).collect()
    same_as_library(rows, TEXTS)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in rows) == sorted(-1 if i is None else i for i in ids)


def test_blocks_of_several_rows(monkeypatch):
    monkeypatch.setattr(piece_codec, "ROW_NUMBERS", 7)
    monkeypatch.setattr(piece_codec, "FREQUENT", 3)
    block = piece_codec.Block(5)
    for i, t in enumerate(TEXTS):
        block.add(i, t or "")
    rows = list(block.rows(3))
    words = piece_codec._segmented(MODEL)(piece_codec._batch(r) for r in rows)
    own = [piece_codec._batch(r) for r in rows if r[0] < 0]
    table = piece_codec._joined(pa.Table.from_batches(own), pa.Table.from_batches(words))
    assert table["doc_id"].to_pylist() == list(range(len(TEXTS)))
    found = table["ids"].to_pylist()
    sp = piece_codec.processor(MODEL)
    assert found == [sp.encode(t or "") for t in TEXTS]


def test_models_with_crossing_pieces_take_whole_texts(spark, monkeypatch):
    assert piece_codec.chunks_are_apart(MODEL)
    monkeypatch.setattr(piece_codec, "chunks_are_apart", lambda model: False)
    same_as_library(piece_codec.decode(piece_codec.encode(documents(spark, TEXTS), MODEL, least_buckets=2), MODEL).collect(), TEXTS)


def test_empty_tables_and_missing_ids(spark):
    assert piece_codec.encode(documents(spark, []), MODEL, least_buckets=2).collect() == []
    df = spark.createDataFrame([("x", None), ("y", []), ("z", [264])], "decoded_from string, ids array<int>")
    assert [r.decoded for r in piece_codec.decode(df, MODEL).orderBy("decoded_from").collect()] == [None, "", "a"]


def test_query_gives_digests_of_all_documents(spark):
    folder = "/root/testdata/sf0.001"
    sp = piece_codec.processor(MODEL)
    expected = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = sp.encode(r.text or "")
        hashes = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), sp.decode(ids)))
        expected[r.doc_id] = (len(ids), *hashes)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op13_sentencepiece(spark, folder).collect()} == expected
