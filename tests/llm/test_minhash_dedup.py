import tracemalloc

import numpy as np
import pytest

from costlens.llm import minhash_dedup as m
from costlens.llm.minhash_dedup import _common_by_bits, _common_by_matches, common_in_band, in_bounded_groups, labelled, near_duplicates, shingles, similar, sketch

SCHEMA = "doc_id long, text string, id long, family string, key int"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_alignment_equals_the_plain_recurrence():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (rng.integers(0, 5, rng.integers(0, 40)).astype(np.uint64) for _ in range(2))
        assert common_in_band(a, b, 100) == lcs(a.tolist(), b.tolist())
        least = 0.8 * (len(a) + len(b))
        assert similar(a, b) == (2 * lcs(a.tolist(), b.tolist()) >= least - 1e-9)


def test_shingles_ignore_white_space_and_see_order():
    assert (shingles(" a\tb  c\nd e f ") == shingles("a b c d e f")).all() and len(shingles("a b c d e f")) == 2
    assert len(shingles("a b")) == 1 and len(shingles(" \n")) == 0 == len(shingles(""))
    assert shingles("a b c d e") != shingles("e d c b a")
    again = shingles("x " * 50)
    assert len(set(again.tolist())) == 1 and len(set(labelled(again).tolist())) == len(again)


def test_sketch_collisions_follow_order():
    words = [f"w{i}" for i in range(400)]
    swapped = words[200:] + words[:200]
    a, b = sketch(shingles(" ".join(words))), sketch(shingles(" ".join(swapped)))
    assert (a[1] == b[1]).sum() >= 12 > 13 - (a[0] == b[0]).sum() - 1
    assert (a[0] == b[0]).sum() < (a[1] == b[1]).sum()


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(0, 5000)}"
    texts = []
    for _ in range(40):
        base = [word() for _ in range(int(rng.integers(30, 300)))]
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(0, 6))):
            copy = list(base)
            for _ in range(int(rng.integers(0, max(1, len(base) // 20)))):
                copy[rng.integers(len(copy))] = word()
            texts.append(" ".join(copy))
    line = " ".join(word() for _ in range(40))
    texts += [line + " " + " ".join(word() for _ in range(60)) for _ in range(50)]  # a shared passage is no near copy
    texts += [None, "", " \n ", "one two", "one  two", "one three", "long text " * 20_000, "long text " * 19_999 + "end"]
    return texts


def brute(texts, ids):
    seqs = [shingles(t or "") for t in texts]
    ties = m.Ties(len(texts))
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            if len(seqs[i]) and len(seqs[j]) and similar(seqs[i], seqs[j]):
                ties.tie(i, j)
    return {ids[i]: ids[ties.find(i)] for i in range(len(texts))}


@pytest.mark.parametrize("split", [False, True])
def test_classes_equal_brute_force(spark, corpus, split, monkeypatch):
    if split:  # every bucket and family of more than a few rows is split into parts
        dealt = in_bounded_groups
        monkeypatch.setattr(m, "in_bounded_groups", lambda rows, key, size, most, groups: dealt(rows, key, size, most / 500, groups))
    ids = list(range(10, 10 + len(corpus)))
    rows = [(i, t, 0, "f", 1) for i, t in zip(ids, corpus)]
    got = near_duplicates(spark.createDataFrame(rows + [rows[3], (None, corpus[0], 0, "f", 1)], SCHEMA).repartition(4)).collect()
    assert len(got) == len(rows) + 2
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == brute(corpus, ids)
    assert [r.class_id for r in got if r.doc_id is None] == [None]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def aligned(a, b, spare):
    """Longest common subsequence in the band, by the plain table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best = max(table[i][j + 1], table[i + 1][j])
            table[i + 1][j + 1] = max(best, table[i][j] + 1) if x == y and abs(i - j) <= spare else best
    return table[-1][-1]


def test_both_alignments_equal_the_plain_table():
    rng = np.random.default_rng(8)
    for _ in range(300):
        kinds = int(rng.integers(1, 40))
        a, b = (rng.integers(0, kinds, rng.integers(1, 45)).astype(np.uint64) for _ in range(2))
        if rng.random() < 0.5:
            b = np.delete(a, rng.integers(0, len(a), 2)) if len(a) > 3 else a
        spare = int(rng.integers(0, 30))
        want = aligned(a.tolist(), b.tolist(), spare)
        assert abs(len(a) - len(b)) > spare or common_in_band(a, b, spare) == want
        if len(b):
            assert _common_by_matches(a, b, spare) == _common_by_bits(a, b, spare) == want


def test_very_long_texts_are_aligned_in_bounded_memory():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 1 << 62, 400_000).astype(np.uint64)  # shingles of a text of about 3 MB
    b = np.delete(a, np.arange(10, len(a) - 10, 9))
    half = np.where(np.arange(60_000) % 2 == 0, np.uint64(5), a[:60_000])
    tracemalloc.start()
    assert common_in_band(a, b, len(a) // 5) == len(b)
    assert common_in_band(half, np.delete(half, np.arange(11, 50_000, 50)), 12_000) == 60_000 - len(np.arange(11, 50_000, 50))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_texts_of_one_id_are_one_document(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(5, a), (5, b), (3, b), (9, a), (4, c), (4, c), (None, a), (None, b)]
    docs = spark.createDataFrame([(i, t, 1, "f", 2) for i, t in rows], SCHEMA)
    got = sorted((str(r.doc_id), r.class_id) for r in near_duplicates(docs).collect())
    assert got == [("3", 3), ("4", 4), ("4", 4), ("5", 3), ("5", 3), ("9", 3), ("None", None), ("None", None)]


def test_each_text_of_an_id_links_it(spark):
    d, e = ([f"{w}{i}" for i in range(300)] for w in "de")
    near = lambda words, i: " ".join([*words[:i], "changed", *words[i + 1 :]])
    rows = [(17, " ".join(d)), (17, " ".join(e)), (18, near(e, 100)), (16, near(d, 200)), (15, "something else altogether, of few words")]
    docs = spark.createDataFrame([(i, t, 1, "f", 2) for i, t in rows], SCHEMA)
    assert {(r.doc_id, r.class_id) for r in near_duplicates(docs).collect()} == {(17, 16), (18, 16), (16, 16), (15, 15)}
