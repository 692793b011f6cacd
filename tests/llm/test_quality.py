import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.llm.quality import FEATURES, PASSAGE, PassageModel, _byte_classes, judge, passage_slices, passages, train
from costlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score double, label int, weightiest string"


def test_passages_do_not_depend_on_their_neighbours():
    classes = _byte_classes()
    texts = [b"", b"ab. ab. ab. ab. ab.", b"Some words, here.\n" * 100, b"x" * PASSAGE, b"y" * (PASSAGE - 4), b"\0" * 40]
    x, start = passages(texts, classes)
    assert start.tolist() == [0, 1, 2, 6, 7, 8] and len(x) == 9
    for t, s, e in zip(texts, start, [*start[1:], len(x)]):
        alone, _ = passages([t], classes)
        assert (alone == x[s:e]).all()


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    bags = [rng.random((n, FEATURES)).astype(np.float32) for n in (1, 3, 2, 4) * 8]
    y = np.array([0, 1] * 16, np.float32)
    model = train(bags, y, steps=3)
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    x, start = np.concatenate(bags[:4]).astype(np.float64), np.array([0, 1, 4, 6])

    def loss():
        p = model.forward(x, start)[-1]
        return -(y[:4] * np.log(p) + (1 - y[:4]) * np.log(1 - p)).mean()

    grad = model.gradients(x, start, y[:4])
    for name, at in (("out", (3,)), ("w", (2,)), ("V", (4, 1)), ("U", (5, 2)), ("encode", (9, 3)), ("encode_bias", (1,)), ("out_bias", (0,))):
        keep = model.params[name][at]
        model.params[name][at] = keep + 1e-5
        up = loss()
        model.params[name][at] = keep - 1e-5
        down = loss()
        model.params[name][at] = keep
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_held_out_accuracy(spark):
    got = QUERIES["op6_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    held = got.join(labels, "doc_id").where("held_out").groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("ok"))
    right = {r.quality: r.ok for r in held.collect()}
    assert right[0] >= 0.95 and right[1] >= 0.97


def test_odd_rows(spark):
    rows = [(i, f"Some plain words w{i} follow here. And more of them. " * 9, 0.5, 1, "") for i in range(40)]
    rows += [(100 + i, f"BUY!! w{i} NOW!! $$$ ### " * 9, 0.5, 0, "") for i in range(40)]
    odd = [(200, None, 1.0, 1, ""), (201, "", 1.0, 0, ""), (None, rows[0][1], 1.0, 1, ""), (203, "Some plain words follow. " * 30_000, 1.0, None, ""), rows[0]]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    got = judge(docs, docs.select("doc_id", "label"), F.lit(False)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 85 and by[200].score == by[201].score == 0
    assert by[5].predicted == 1 == by[None].predicted and by[105].predicted == 0
    assert all(0 <= r.score <= 1 for r in got)


def test_one_label_only_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", 0.0, 0, "")], SCHEMA)
    assert [r.score for r in judge(docs, docs.select("doc_id", "label"), F.lit(False)).collect()] == [0.0]
    none = docs.limit(0)
    assert judge(none, none.select("doc_id", "label"), F.lit(False)).count() == 0


def small_model(seed=4):
    rng = np.random.default_rng(seed)
    bags = [rng.random((rng.integers(1, 6), FEATURES)).astype(np.float32) for _ in range(40)]
    return train(bags, np.array([k % 2 for k in range(40)], np.float32), steps=5)


def test_slices_of_a_text_have_the_passages_of_the_whole():
    rng = np.random.default_rng(6)
    classes = _byte_classes()
    for n in (0, 1, PASSAGE - 1, PASSAGE, PASSAGE + 1, 5 * PASSAGE - 20, 9 * PASSAGE + 3):
        text = bytes(rng.choice(list(b"ab .\xc3\xa9X1"), n).tolist())
        whole = passages([text], classes)[0]
        for most in (1, 2 * PASSAGE, 100 * PASSAGE):
            assert np.array_equal(np.concatenate(list(passage_slices(text, classes, most))), whole)


def test_forward_pass_equals_plain_loops():
    """Encoding, gated attention and the weighted passage, number by number."""
    model, rng = small_model(), np.random.default_rng(7)
    x = rng.random((5, FEATURES)).astype(np.float32)
    start = np.array([0, 2])
    prob = model.forward(x, start)[-1]
    p = {k: v.tolist() for k, v in model.params.items()}
    for d, (s, e) in enumerate(((0, 2), (2, 5))):
        codes, raws = [], []
        for row in x[s:e]:
            scaled = [(v - m) / c for v, m, c in zip(row.tolist(), model.mean.tolist(), model.scale.tolist())]
            h = [math.tanh(sum(v * p["encode"][i][j] for i, v in enumerate(scaled)) + p["encode_bias"][j]) for j in range(len(p["encode_bias"]))]
            gate = [
                math.tanh(sum(h[i] * p["V"][i][k] for i in range(len(h)))) / (1 + math.exp(-sum(h[i] * p["U"][i][k] for i in range(len(h)))))
                for k in range(len(p["w"]))
            ]
            codes.append(h)
            raws.append(sum(g * w for g, w in zip(gate, p["w"])))
        weights = [math.exp(r) / sum(map(math.exp, raws)) for r in raws]
        z = [sum(a * h[j] for a, h in zip(weights, codes)) for j in range(len(codes[0]))]
        want = 1 / (1 + math.exp(-(sum(v * w for v, w in zip(z, p["out"])) + float(np.ravel(model.params["out_bias"])[0]))))
        assert prob[d] == pytest.approx(want, abs=1e-4)
        assert model.score_long(iter([x[s : s + 1], x[s + 1 : e]])) == (pytest.approx(want, abs=1e-4), int(np.argmax(raws)))


def test_a_very_long_text_takes_bounded_memory():
    model, classes = small_model(), _byte_classes()
    text = b"Some words, and more. " * 900_000
    tracemalloc.start()
    value, _ = model.score_long(passage_slices(text, classes, 1 << 18))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 <= value <= 1 and peak < 100e6
