import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.llm.langid import ByteCnn, classify, identify, train, windows_of
from costlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score double, lang_pred string"


def test_windows_hold_the_whole_text():
    raw = bytes(range(1, 256)) * 5
    w = windows_of(raw)
    assert w.tobytes().rstrip(b"\0") == raw and windows_of(b"").shape == (1, 256)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    model = ByteCnn.initial(["a", "b"], 1)
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    x, y = rng.integers(97, 110, (6, 256)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])
    loss = lambda: -model.log_probabilities(model.pooled(x, model.tables()))[np.arange(6), y].mean()
    grad = model.gradients(x, y)
    for name, at in (("embed", (100, 3)), ("filter3", (1, 2, 5)), ("out", (7, 1)), ("bias", (4,))):
        keep = model.params[name][at]
        model.params[name][at] = keep + 1e-6
        up = loss()
        model.params[name][at] = keep - 1e-6
        down = loss()
        model.params[name][at] = keep
        assert grad[name][at] == pytest.approx((up - down) / 2e-6, abs=1e-4)


def test_held_out_accuracy(spark):
    got = QUERIES["op8_language_id"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.95 * held.count() > 0
    assert got.where("score < 0 or score > 1").isEmpty() and got.count() == 1000


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    odd = [(None, "Is and the of", "en", 1.0, "x"), (1000, None, "en", 1.0, "x"), (1001, "", None, 1.0, "x"), (1002, "12 .,\n%", "fr", 1.0, "x"),
           (1003, "la que " * 100_000, None, 1.0, "x"), (1003, "la que " * 100_000, None, 1.0, "x")]
    rows = docs.select("doc_id", "text", "lang").withColumns({"score": F.lit(0.0), "lang_pred": F.lit("zz")})
    got = identify(rows.unionByName(spark.createDataFrame(odd, SCHEMA)), F.lit(False)).collect()
    assert len(got) == 306
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000].score == 0
    assert by[1003].lang_pred in {"es", "fr"} and by[None].lang_pred == "en"


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some words", None, 0.0, "")], SCHEMA)
    assert [r.lang_pred for r in identify(docs, F.lit(False)).collect()] == ["und"]
    assert identify(docs.limit(0), F.lit(False)).count() == 0
    assert classify(docs.limit(0).drop("score", "lang_pred"), None).count() == 0
