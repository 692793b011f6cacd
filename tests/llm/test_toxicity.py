import numpy as np
import pytest
from pyspark.sql import functions as F

from costlens.llm.queries import QUERIES
from costlens.llm.toxicity import SentenceModel, judge, train

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score double, label int, held_out string"


def test_noisy_or_of_sentences():
    model = SentenceModel({"bad": 8.0}, -4.0)
    score, found = model.score("So good. So bad! A\nb")
    p = 1 / (1 + np.exp([4.0, -4.0, 4.0, 4.0]))
    assert score == pytest.approx(1 - np.prod(1 - p))
    assert [(s, n) for s, n, _ in found] == [(8, 7)]


def test_training_finds_the_word():
    texts = [f"fine w{i}. all w{i + 1} well." for i in range(60)] + [f"fine w{i}. you oaf w{i}! well." for i in range(60)]
    model = train(texts, [0] * 60 + [1] * 60)
    assert model.score("you oaf")[0] > 0.5 > 0.3 > model.score("fine. all well.")[0]
    assert model.score("fine. you oaf.")[1][-1][:2] == (5, 8)


def test_held_out_accuracy(spark):
    got = QUERIES["op2_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    held = got.join(labels, "doc_id").where("held_out").groupBy("toxic").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("ok"))
    right = {r.toxic: r.ok for r in held.collect()}
    assert right[0] >= 0.97 and right[1] >= 0.9


def test_odd_rows(spark):
    rows = [(i, f"fine w{i % 9}. all well", 0.5, 0, "") for i in range(40)] + [(100 + i, "you oaf. well", 0.5, 1, "") for i in range(20)]
    odd = [(200, None, 1.0, 1, ""), (201, "", 1.0, 0, ""), (None, "you oaf", 1.0, 1, ""), (203, "...\n!?", 1.0, 1, ""), (204, "all well. " * 50_000 + "you oaf", 1.0, None, ""), rows[0]]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    got = judge(docs, docs.select("doc_id", "label"), F.lit(False)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 66
    assert [by[i].score for i in (200, 201, 203)] == [0.0, 0.0, pytest.approx(0, abs=1e-6)]
    assert by[None].predicted == 1 == by[204].predicted and by[100].offending[0].start == 0
    assert all(0 <= r.score <= 1 for r in got)


def test_one_label_only_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", 0.0, 0, "")], SCHEMA)
    assert [r.score for r in judge(docs, docs.select("doc_id", "label"), F.lit(False)).collect()] == [0.0]
    none = docs.limit(0)
    assert judge(none, none.select("doc_id", "label"), F.lit(False)).count() == 0
