import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from costlens.llm import bpe_chunks
from costlens.llm.bpe_chunks import ChunkEncoder, chunk_text, encode_documents, sharing_key

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, key long, salt int"
ODD = [
    "", " ", "  a", "á e ́x", "x" * 5000, "ab " * 3000, "<|endoftext|> a<|startoftext|>b", "ÀÉ İstanbul ΑΣ ς\n\tx  y",
    "é" * 3000, "don't 've 12 ٣²", "a b　c", "e\ń", "\n".join(f"line {i} of text" for i in range(400)),
]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)

    def code(text):
        ids = t.encode(text or "", add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)

    return code


def test_chunks_join_to_the_text_and_are_shared():
    rng = np.random.default_rng(1)
    passage = " ".join(f"w{n}" for n in rng.integers(0, 999, 3000))
    a, b = chunk_text("head one " + passage), chunk_text("another beginning, " + passage + " end")
    assert "".join(a) == "head one " + passage
    assert len(set(a) & set(b)) >= len(a) - 3 > 5


def test_equal_to_the_tokenizer(reference):
    rng = np.random.default_rng(2)
    alphabet = list("abcdé ñ.'1\n ,ßz")
    texts = ODD + ["".join(rng.choice(alphabet, int(n))) for n in rng.integers(1, 6000, 60)]
    encoder = ChunkEncoder(PATH, most_words=500, most_bytes=20_000)  # the memos start anew many times
    got = [x for i in range(0, len(texts), 9) for x in encoder.encode_many(texts[i : i + 9])]
    assert [(i, encoder.decode(i)) for i in got] == [reference(t) for t in texts]


def test_cuts_inside_words_are_repaired(reference, monkeypatch):
    monkeypatch.setattr(bpe_chunks, "CHUNK", 4)  # a cut every few bytes
    texts = [*ODD[:12], "internationalisation of unbelievable things " * 40]
    encoder = ChunkEncoder(PATH)
    assert [(i, encoder.decode(i)) for i in encoder.encode_many(texts)] == [reference(t) for t in texts]


def test_a_chunk_returns_after_the_words_started_anew(reference):
    rng = np.random.default_rng(4)
    long = lambda k: " ".join(f"{k}x{n}" for n in rng.integers(0, 10**9, 300))
    a, b, c = long("a"), long("b"), long("c")
    encoder = ChunkEncoder(PATH, most_words=700)  # the third text starts the words anew, while the chunks of the first are held
    for texts in ([a], [b], [c], [a, c], [b, a]):
        assert list(encoder.encode_many(texts)) == [reference(t)[0] for t in texts]
        assert len(encoder.words) <= 700


def test_each_chunk_is_encoded_once():
    encoder = ChunkEncoder(PATH)
    text = " ".join(f"w{n}" for n in np.random.default_rng(3).integers(0, 999, 4000))
    list(encoder.encode_many([text, text + " more", text]))
    assert encoder.encoded <= encoder.met / 2


def test_round_trip_of_a_table(spark, reference):
    texts = [None, *ODD, *[ODD[-1] + f" end {i}" for i in range(30)], "word " * 200_000]
    rows = [(i if i != 2 else None, t, "x", 1, 2) for i, t in enumerate(texts)] + [(5, "again", "x", 1, 2), (5, "again", "x", 1, 2)]
    got = encode_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH).collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in got), key=key) == sorted(((r[0], *reference(r[1])) for r in rows), key=key)


def test_a_process_loads_one_tokenizer():
    assert ChunkEncoder(PATH).tokenizer is ChunkEncoder(PATH).tokenizer


def test_batches_are_cut_by_bytes(spark, monkeypatch):
    met = []
    monkeypatch.setattr(bpe_chunks, "deal_by_key", lambda docs: met.append(docs.sparkSession.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) or docs)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    encode_documents(spark.createDataFrame([(1, "a", "x", 1, 2)], SCHEMA), PATH)
    assert met == [str(4 << 20)]


def test_empty_table_and_key_of_short_texts(spark):
    assert encode_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    assert sharing_key("abc") == sharing_key("abc") != sharing_key("abd")
