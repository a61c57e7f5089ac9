import pytest

import corpus_pipeline
from rxlens.llm import decontam, repeats, simhash, toxicity


@pytest.fixture(scope="module")
def staged(spark, sf_dir, tmp_path_factory):
    """Each stage's rows, written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_take_effect(spark, sf_dir, staged):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    raw, clean, single = staged[""], staged["toxicity"], staged["near_duplicates"]
    cut, last = staged["repeated_passages"], staged["benchmark_decontamination"]
    report = toxicity.toxicity_report(raw, labels)
    assert ids(clean) == ids(report.filter("predicted = 0"))
    near = simhash.near_duplicate_report(clean)
    assert ids(single) == ids(near.filter("doc_id = component_id"))
    removed = {r["doc_id"]: r["n_removed"] for r in repeats.repeat_report(single).collect()}
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in cut.collect():
        gone = len(before[r["doc_id"]].encode()) - len(r["text"].encode())
        # A cut through a character drops its other bytes too.
        assert removed[r["doc_id"]] <= gone <= removed[r["doc_id"]] * 1.05 + 6
        assert r["n_chars"] == len(r["text"])
    judged = decontam.contamination(cut, items)
    assert ids(last) == ids(judged.filter("not contaminated"))
    assert ids(staged["byte_bpe"]) == ids(last)


def test_columns_stay(staged):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert staged[name].columns == staged[""].columns


def test_run_is_all_stages(spark, sf_dir, staged):
    whole = corpus_pipeline.run(spark, sf_dir)
    got = {(r["doc_id"], r["text_sha256"]) for r in whole.collect()}
    assert got == {(r["doc_id"], r["text_sha256"]) for r in staged["byte_bpe"].collect()}


def test_hard_rows(spark, sf_dir):
    odd = [(1, None, None), (None, "", 3), (2, "A b c d", 3), (2, "A b c d", 3)]
    df = spark.createDataFrame(
        [(i, t, "en", "s", n, "z") for i, t, n in odd],
        "doc_id long, text string, lang string, source string, n_chars long, fp string",
    )
    for docs, left in ((df, 2), (df.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
            assert name == "byte_bpe" or docs.columns == df.columns
        assert docs.count() == left
