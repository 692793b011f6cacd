import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from costlens.llm.byte_bpe import ByteBpe
from costlens.llm.packing import cut, pack_documents, sum_of_squares

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, length long, bin string"
ODD = ["", " ", "  a", "a  b", "a\n b ", "a \n\n  b", "x<|endoftext|>y", "it's  o'ü ٣ x²", "  \t a b  \n"]


def test_ids_equal_the_tokenizer():
    bpe, ref = ByteBpe(PATH), Tokenizer.from_file(PATH)
    for text in ODD:
        assert bpe.encode(text) == np.array(ref.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_cut_puts_the_rest_first():
    assert cut(1, 8) == [(0, 1)]
    assert cut(8, 8) == [(0, 8)]
    assert cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_rule_beats_no_open_bin_and_never_overfills():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 64, 3000))[::-1]
    bins, offsets, fills = sum_of_squares(lengths, 64)
    assert fills.max() <= 64 and fills.sum() == lengths.sum()
    assert len(fills) <= 1.02 * -(-lengths.sum() // 64)
    for b in range(len(fills)):
        at = np.flatnonzero(bins == b)
        at = at[np.argsort(offsets[at])]
        assert (offsets[at] == np.r_[0, np.cumsum(lengths[at])[:-1]]).all()


@pytest.fixture(scope="module")
def packed(spark):
    rng = np.random.default_rng(2)
    texts = [None, *ODD, "word " * 5000, "word " * 5000] + ["ab " * int(n) for n in rng.integers(1, 900, 400)]
    rows = [(i if i != 3 else None, t, 7, "x") for i, t in enumerate(texts)] + [(5, "again", 1, "y")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return rows, pack_documents(docs, PATH, shard_pieces=64).collect()


def test_every_document_is_whole(packed):
    rows, got = packed
    ref = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, _, _ in rows:
        ids = np.array([*ref.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for k, (s, n) in enumerate(cut(len(ids), 1024)):
            want.append((-1 if doc_id is None else doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
    have = [(-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]
    assert sorted(have) == sorted(want)


def test_sequences_are_gapless_and_few(packed):
    _, got = packed
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(by) <= 1.1 * -(-sum(r.length for r in got) // 1024)


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0
