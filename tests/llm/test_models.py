"""Toxicity, language and quality: held-out accuracy, brute force for what is exact, hard rows."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from rxlens.llm import language, quality, toxicity
from rxlens.llm.queries import LLM_QUERIES
from tests.conftest import rows

SF = "/root/testdata/sf0.1"


def subsequence_kernel(a, b):
    def profile(word):
        code, out = [62, *map(toxicity._symbol, word), 63], Counter()
        for at in combinations(range(len(code)), toxicity.ORDER):
            out[tuple(code[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    x, y = profile(a), profile(b)

    def dot(p, q):
        return sum(v * q.get(k, 0) for k, v in p.items())

    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_by_enumeration():
    words = ["idiot", "idi0t", "i.d.i.o.t", "iidiiot", "aaaaa", "a", "zebra", "dioti"]
    got = toxicity.kernel(words, words)
    assert np.abs(got - [[subsequence_kernel(a, b) for b in words] for a in words]).max() < 1e-6
    assert got[0, 3] > got[0, 7] > got[0, 6]


def test_units_read_spelled_and_long_words():
    found = toxicity.units("You I d-i o t! st.upid " + "x" * 90)
    assert {"idiot", "stupid", "st.upid"} <= found
    assert max(map(len, found)) <= toxicity.LONGEST


def sentence(word, i):
    rnd = random.Random(i)
    filler = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(6)]
    return " ".join(filler[:3] + [word] + filler[3:]) + "."


def labelled(spark, n=600):
    insults = ["numbskull", "dimwit", "blockhead"]
    rows_ = []
    for i in range(n):
        toxic = i % 3 == 0
        rows_.append((i, sentence(insults[i % 9 // 3] if toxic else f"word{i % 17}", i), int(toxic)))
    df = spark.createDataFrame(rows_, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_insults_are_caught_with_gaps_and_insertions(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    new = ["you numbskull", "a num-bskull", "numbbskull", "d i m w i t", "a fine word3", "beta1", ""]
    df = spark.createDataFrame(list(enumerate(new)), "doc_id long, text string")
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(df, model).collect()}
    assert [scored[i] for i in range(len(new))] == [1, 1, 1, 1, 0, 0, 0]


def test_labels_of_held_out_documents_are_not_learned(spark):
    docs, labels = labelled(spark)
    held = labels.filter(toxicity.held_out(labels["doc_id"]))
    assert toxicity.train(docs, held).table is None


def test_toxicity_on_held_out_documents(spark):
    scored = LLM_QUERIES["op2_toxicity"](spark, SF).filter("held_out")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    pairs = scored.join(labels, "doc_id").select("predicted", "toxic").collect()
    right = sum(r["predicted"] == r["toxic"] for r in pairs) / len(pairs)
    flagged = [r["toxic"] for r in pairs if r["predicted"]]
    assert right > 0.95 and sum(flagged) / len(flagged) > 0.9


def test_toxicity_hard_rows(spark):
    docs, labels = labelled(spark)
    odd = [(1000, None, "a"), (None, "", "a"), (1001, "?!", "a"), (1001, "dimwit " * 9000, "b")]
    df = spark.createDataFrame(odd, "doc_id long, text string, top string")
    kept = toxicity.drop_toxic(df.unionByName(docs.limit(0), allowMissingColumns=True), labels)
    assert kept.columns == df.columns  # no model: nothing to learn from
    assert kept.count() == 4
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(df.limit(3), model).collect()}
    assert got == {1000: 0, None: 0, 1001: 0}
    assert toxicity.score(df.limit(0), model).collect() == []


@pytest.mark.parametrize("n", [2, 3, 5, 8, 20])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert (np.abs(code.sum(axis=0)) < n).all()
    apart = min((code[i] != code[j]).sum() for i, j in combinations(range(n), 2))
    assert apart >= (1 if n == 2 else 2)


def test_long_texts_count_every_ngram(monkeypatch):
    text = "".join(map(chr, np.random.default_rng(0).integers(97, 123, 10_001)))
    whole = language.features(text)
    monkeypatch.setattr(language, "_STEP", 64)
    assert np.allclose(whole, language.features(text))


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    told = LLM_QUERIES["op6_language_id"](spark, SF).filter("held_out").join(docs, "doc_id")
    assert told.filter("lang = lang_pred").count() / told.count() > 0.98


def test_language_hard_rows(spark):
    odd = [(1, None, "en"), (2, "", "en"), (3, "123 !", "fr"), (None, "le la", "fr"), (4, "of", None)]
    df = spark.createDataFrame(odd, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.language_report(df).collect()} == {"und"}
    more = df.unionByName(spark.createDataFrame([(4, "ü" * 99_999, "de")], df.schema))
    told = language.predict(more, language.train(more)).collect()
    got = {(r["doc_id"], r["lang_pred"]) for r in told}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (None, "de"), (4, "de")}
    assert language.language_report(df.limit(0)).collect() == []


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, hit, seen, repeats = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            hit |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeats, len(hit)


def test_quality_counts_of_the_whole_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in LLM_QUERIES["op7_quality_rules"](spark, sf_dir).collect():
        want = brute_counts(texts[r["doc_id"]])
        assert tuple(r)[1:6] == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_forest_is_monotone_where_asked():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = (x[:, 0] - x[:, 1] + 0.5 * rng.normal(size=2000) > 0).astype(float)
    forest = quality.fit(x, y, np.array([0, -1, 0]))
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.85
    for _ in range(30):
        line = np.repeat(rng.normal(size=(1, 3)), 200, axis=0)
        line[:, 1] = np.linspace(-3, 3, 200)
        assert (np.diff(forest.probability(line)) <= 1e-12).all()


def test_quality_on_documents_not_learned_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.judge(docs, quality.train(docs, labels.filter("doc_id % 4 <> 0")))
    truth = labels.filter("doc_id % 4 = 0").select("doc_id", (labels["quality"] > 0).alias("good"))
    pairs = judged.filter("not base_failed").join(truth, "doc_id")
    right = pairs.filter("kept = good").count()
    assert right / pairs.count() > 0.97


def test_quality_hard_rows(spark):
    odd = [(1, None), (2, ""), (3, "a b c a b c " * 40), (None, "x y #"), (3, "é" * 99_999)]
    df = spark.createDataFrame([(i, t, "q") for i, t in odd], "doc_id long, text string, quality string")
    got = rows(quality.judge(df, None).select("doc_id", "n_words", "word_chars", "n_repeat_words", "kept"))
    want = [(1, 0, 0, 0, False), (2, 0, 0, 0, False), (3, 240, 240, 240, False)]
    assert got == sorted(want + [(None, 3, 3, 0, False), (3, 1, 99_999, 0, False)], key=repr)
    labels = spark.createDataFrame([(3, 1)], "doc_id long, quality int")
    assert quality.quality_report(df.limit(0), labels).collect() == []
