import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], SF).write.parquet(f"{base}/{k}")
        found.append(spark.read.parquet(f"{base}/{k}"))
    return found


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "near_duplicates", "repeated_passages", "packing"]


def test_filters_drop_toxic_and_keep_clean(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stages[1].join(labels, "doc_id")
    assert kept.where("toxic = 1").count() <= 0.2 * labels.where("toxic = 1").count()
    assert kept.where("toxic = 0").count() >= 0.97 * labels.where("toxic = 0").count()
    assert stages[2].count() >= 0.98 * stages[1].count()


def test_each_class_keeps_its_first(stages):
    from costlens.llm.minhash_dedup import near_duplicates

    classes = near_duplicates(stages[2])
    assert {r.doc_id for r in stages[3].select("doc_id").collect()} == {r.class_id for r in classes.collect()}


def test_no_passage_is_left_twice(stages):
    first: dict[bytes, int] = {}
    before = {r.doc_id: r.text for r in stages[3].collect()}
    after = {r.doc_id: r for r in stages[4].collect()}
    assert set(before) == set(after)
    for i in sorted(before):
        raw = before[i].encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first.setdefault(raw[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(raw, gone) if not y).decode("utf-8", "ignore")
        assert after[i].text == kept and after[i].n_chars == len(kept)


def test_packing_holds_every_document_once(stages):
    pieces = stages[5].groupBy("doc_id").sum("length").count()
    assert pieces == stages[4].count()
    fills = stages[5].groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert fills.max() <= 1024 and len(fills) <= 1.05 * -(-fills.sum() // 1024)


def test_clashing_columns_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, id string, row string, key int"
    rows = [(i, f"Some plain words w{i} and more of them here", "en", "s", 5, 0.5, 1, "i", "r", 3) for i in range(30)]
    rows += [(None, "Some plain words", None, None, None, None, None, None, None, None), (31, None, "en", None, 0, 0.0, 0, "i", "r", 1), rows[0]]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        n = docs.count()
        assert n == (31 if data else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == n


def test_cuts_trim_their_own_characters_only(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    lost, passage = "\ufffd", "w\u00e9 say the same fifty bytes in both of these two texts here"
    # The 1st byte of the snowman and of its like is common, and the last of the pair in front is.
    texts = [f"clean {lost} text {lost}{lost}", f"one {lost} \u00c3{passage}\u2603 end {lost}", f"two {lost} \u0103{passage}\u2605 end {lost}", None]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], schema)
    got = {r.doc_id: r for r in corpus_pipeline.repeated_passage_filter(spark, docs, SF).collect()}
    assert [got[i].text for i in range(4)] == [*texts[:2], f"two {lost}  end {lost}", None]
    assert [got[i].n_chars for i in range(4)] == [None if got[i].text is None else len(got[i].text) for i in range(4)]


def test_filters_take_columns_of_any_name(spark):
    rows = [(i, "Dies ist ein Satz." if i % 2 else "This is a sentence.", "de" if i % 2 else "en", 0.9, "x", i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string, c0 int")
    for stage in (corpus_pipeline.toxicity_filter, corpus_pipeline.language_filter):
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns and set(map(tuple, kept.collect())) <= set(rows)


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from costlens.llm.common import slices

    texts = ["x" * n for n in (10, 0, 3_000_000, 5, 500_000, 500_000, 500_000)] + [None] * 3 + ["y"] * 100_000
    batch = pa.RecordBatch.from_pydict({"i": list(range(len(texts))), "t": texts})
    parts = list(slices(batch, 1))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(sum(len(t or "") for t in p.column(1).to_pylist()[1:]) <= 1 << 20 for p in parts) and len(parts) >= 4
    assert list(slices(batch.slice(0, 0), 1)) == []
