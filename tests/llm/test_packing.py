"""Packing: every id in one piece, sequences full, ids those of the library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabwright.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("length", [2048, 64])
def test_round_trip(edge_docs, length):
    library = Tokenizer.from_file(PATH)
    rows = edge_docs.select("doc_id", "text").collect()
    expected = sorted(((r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids) + (1,)) for r in rows), key=repr)
    pieces = packing.pack(edge_docs, PATH, length).collect()
    pieces.sort(key=lambda p: (p.sequence_id, p.offset))
    documents, sequences = [], defaultdict(int)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0 and zlib.crc32(p.ids) == p.ids_crc32
        assert p.offset == sequences[p.sequence_id]
        sequences[p.sequence_id] += p.length
        if p.start == 0:
            documents.append((p.doc_id, []))
        assert documents[-1][0] == p.doc_id and len(documents[-1][1]) == p.start
        documents[-1][1].extend(ids.tolist())
        assert p.start + p.length <= p.doc_tokens
    assert sorted(((i, tuple(x)) for i, x in documents), key=repr) == expected
    full = [sequences[i] for i in range(len(sequences))]
    assert full[:-1] == [length] * (len(full) - 1) and 0 < full[-1] <= length


def test_words_split_as_the_library_splits(spark):
    library = Tokenizer.from_file(PATH)
    texts = ["It's the dogs' é café! naïve", "<|endoftext|> a<|startoftext|>b", "x" * 500, "ǅ İ ß ﬁ ½ ² a_b", "#!?'s 's t's", "ÀÉÞ×÷ß!! É's ÿ... ñandú, Ω; <|ENDOFTEXT|> e\u0301, E\u0301", "日本 語　x y\x85z", "4-5 a1b2 £5"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.pack(docs, PATH, 1 << 20).collect()}
    assert found == {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_words_are_forgotten_and_learnt_again(monkeypatch, spark, prose):
    monkeypatch.setattr(packing, "KEPT_UNITS", 5)
    words = packing.WordTokenizer(PATH)
    library = Tokenizer.from_file(PATH)
    import pyarrow as pa

    from tabwright.llm.blocks import blocks

    for block in blocks(pa.array(prose, pa.string()), 400):
        ids, n = words.ids(block, 1)
        mine = prose[block.first : block.last]
        assert ids.tolist() == [i for t in mine for i in [*library.encode(t or "", add_special_tokens=False).ids, 1]]
        assert n.sum() == len(ids)


def test_no_rows(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


def test_cut_takes_few_rows_at_once():
    """Batches of any size are cut in slices; the pieces are those of the batch as a whole."""
    n = 2 * packing.LEAN_ROWS + 1
    ids = np.arange(3, dtype=np.uint16).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(0, 3 * n, 3)), pa.array([3] * n), pa.array([ids] * n, pa.binary())], names=["doc_id", "begin", "n", "ids"])
    found = list(packing._cut(2, 2, True)(iter([batch])))
    assert len(found) == 3
    pieces = [tuple(r.values()) for out in found for r in out.select(["doc_id", "start", "length", "sequence_id", "offset"]).to_pylist()]
    expected = []
    for d in range(n):
        at = 3 * d
        while at < 3 * d + 3:
            size = min(2 - at % 2, 3 * d + 3 - at)
            expected.append((d, at - 3 * d, size, at // 2, at % 2))
            at += size
    assert pieces == expected
