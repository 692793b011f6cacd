import numpy as np
import pytest

from costlens.llm import suffix_dedup as s
from costlens.llm.suffix_dedup import WINDOW, anchors, common_prefixes, remove_repeats, suffix_ranks

SCHEMA = "doc_id long, text string, g long, route long, kept string"


def test_ranks_order_prefixes():
    rng = np.random.default_rng(1)
    for top in (98, 99, 110):
        text = rng.integers(97, top, 300).astype(np.uint8)
        raw = text.tobytes() + b"\0" * WINDOW
        for depth, rank in suffix_ranks(text):
            prefixes = [raw[i : i + depth] for i in range(len(text))]
            place = {p: k for k, p in enumerate(sorted(set(prefixes)))}
            assert (np.unique(rank, return_inverse=True)[1] == [place[p] for p in prefixes]).all()


def test_common_prefixes_count_bytes():
    text = np.frombuffer(b"abracadabra " * 20 + b"a" * 70, np.uint8)
    raw, starts = text.tobytes(), np.arange(len(text) - WINDOW + 1)
    ranks = suffix_ranks(text)
    order = starts[np.argsort(ranks[-1][1][starts], kind="stable")]
    for (a, b), n in zip(zip(order, order[1:]), common_prefixes(order, ranks, text)[1:]):
        want = next((k for k in range(WINDOW) if raw[a + k] != raw[b + k]), WINDOW)
        assert n == want


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 123, 200).astype(np.uint8)
    a = np.r_[rng.integers(97, 123, 77), shared, rng.integers(97, 123, 31)].astype(np.uint8)
    b = np.r_[rng.integers(97, 123, 5), shared].astype(np.uint8)

    def of(x):
        first, last, value = anchors(x)
        return np.repeat(value, last - first + 1)

    assert (of(a)[77 : 77 + 151] == of(b)[5 : 5 + 151]).all()
    assert len(of(a)) == len(a) - WINDOW + 1 and len(of(a[:49])) == 0


def test_chance_repeats_of_grams_are_no_repeats_of_halves():
    rng = np.random.default_rng(5)
    phrases = rng.integers(97, 123, (6, 24)).astype(np.uint8)  # longer than a gram, shorter than a key
    held, known = [], []
    for _ in range(200):
        text = np.concatenate([np.r_[rng.integers(97, 123, 60), p] for p in phrases]).astype(np.uint8)
        first, turn, last, value, left, right = s.halves(text)
        assert (value == anchors(text)[2]).all()
        held.append(np.unique(value))
        known.append(np.unique(np.r_[left[turn > first], right[last >= turn]]))
    most = [np.unique(np.concatenate(x), return_counts=True)[1].max() for x in (held, known)]
    assert most[0] > 50 and most[1] == 1


def test_equal_strings_have_equal_keys():
    rng = np.random.default_rng(6)
    shared = rng.integers(97, 123, 300).astype(np.uint8)

    def keys(x):
        first, turn, last, _, left, right = s.halves(x)
        return np.concatenate([np.r_[np.full(t - f, a), np.full(e - t + 1, b)] for f, t, e, a, b in zip(first, turn, last, left, right)])

    a = np.r_[rng.integers(97, 123, 91), shared, rng.integers(97, 123, 17)].astype(np.uint8)
    b = np.r_[rng.integers(97, 123, 8), shared].astype(np.uint8)
    assert len(keys(a)) == len(a) - WINDOW + 1 and all(len(x) == 0 for x in s.halves(a[:49]))
    assert (keys(a)[91 : 91 + 251] == keys(b)[8 : 8 + 251]).all()


def test_only_the_strings_starts_are_sorted():
    rng = np.random.default_rng(7)
    text = rng.integers(97, 99, 4000).astype(np.uint8)
    text[2000:2300] = text[100:400]
    starts = np.sort(rng.choice(len(text) - WINDOW + 1, 900, replace=False))
    raw = text.tobytes()
    ranks = suffix_ranks(text, starts)
    assert all(len(rank) == len(starts) for _, rank in ranks)
    order = np.argsort(ranks[-1][1])
    strings = [raw[starts[i] : starts[i] + WINDOW] for i in order]
    assert strings == sorted(strings)
    common = common_prefixes(order, ranks, text, starts)[1:]
    assert [next((k for k in range(WINDOW) if x[k] != y[k]), WINDOW) for x, y in zip(strings, strings[1:])] == common.tolist()


def test_a_shard_sends_one_row_to_a_group():
    shared, pieces = bytes(range(65, 65 + 60)), []
    for k in range(40):
        pieces += [(k, k % 4, k % s.PARTS, bytes([97 + k % s.PARTS]) + shared)]
    docs, groups, parts, raws = map(list, zip(*pieces))
    n = len(raws)
    pdf = s._packed(np.zeros(n, np.int64), docs, groups, [0] * n, [0] * n, [61] * n, [0] * n, parts, raws)
    out = s._settle(pdf, shards=3, final=False)
    assert sorted(out["route"]) == [-4, -3, -2, -1]
    assert sum(len(raw) for raw in out["docs"]) == 8 * (n - s.PARTS)


def brute(rows):
    raws = [(t or "").encode() for _, t in rows]
    first = {}
    for (i, _), raw in zip(rows, raws):
        for p in range(len(raw) - WINDOW + 1) if i is not None else ():
            key = raw[p : p + WINDOW]
            first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), raw in zip(rows, raws):
        gone = bytearray(len(raw))
        for p in range(len(raw) - WINDOW + 1) if i is not None else ():
            if first[raw[p : p + WINDOW]] < i:
                gone[p : p + WINDOW] = b"\1" * WINDOW
        spans = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        out.append((str(i), len(raw), spans, bytes(x for x, y in zip(raw, gone) if not y)))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    text = lambda n: "".join(rng.choice(list("abc dé\n"), n))
    line, copy = text(120), text(700)
    out = [(i, text(int(rng.integers(0, 300))) + line + text(int(rng.integers(0, 300)))) for i in range(60)]
    out += [(100 + i, copy) for i in range(40)] + [(200 + i, copy[: int(n)] + text(30)) for i, n in enumerate(rng.integers(40, 600, 30))]
    out += [(300, "x" * 500), (301, "x" * 49), (302, "x" * 50), (303, "xy" * 300), (304, "y" + "xy" * 30)]
    out += [(400, None), (401, ""), (None, copy), (None, copy), (5, out[5][1]), (7, copy), (402, "é" * 40 + line), (403, "é" * 40)]
    out += [(500, text(30_000) + copy + "z" * 1000)]
    return out


@pytest.mark.parametrize("most", [4096, 6])
def test_equal_to_brute_force(spark, rows, most, monkeypatch):
    monkeypatch.setattr(s, "MOST_STRETCHES", most)  # 6: common anchors are split over shards
    docs = spark.createDataFrame([(i, t, 1, 2, "k") for i, t in rows], SCHEMA).repartition(4)
    got = remove_repeats(docs, group_bytes=4000, shard_bytes=3000).collect()
    assert sorted((str(r.doc_id), r.n_bytes, len(r.spans), bytes(r.kept)) for r in got) == brute(rows)
    for r in got:
        assert r.n_bytes - len(r.kept) == sum(x.length for x in r.spans)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
