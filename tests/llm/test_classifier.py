"""Subword classifier: features against brute force, held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricefold.llm import classifier as C
from pricefold.llm.tokens import chunks


def one(text):
    (c,) = chunks(pa.array([text], pa.string()))
    found, _ = C.buckets(c)
    return found


def test_features_are_words_and_character_ngrams():
    text = "Über  日本 a\nb🙂"
    found = one(text)
    assert [len(f) for f in found] == [4, len(text) - 1, len(text) - 2, len(text) - 3]
    for k, n in enumerate(C.GRAMS):
        grams = [text[i:i + n] for i in range(len(text) - n + 1)]
        alone = [one(g)[1 + k][0] for g in grams]
        assert alone == found[1 + k].tolist()
    words = [one(w)[0][0] for w in text.split()]
    assert words == found[0].tolist()


def test_texts_of_a_chunk_do_not_mix():
    texts = ["", "a", "ab", None, "abc def", "日", "x" * 50, ""]
    (c,) = chunks(pa.array(texts, pa.string()))
    for f, a, k in zip(*C.buckets(c), range(4)):
        for i, t in enumerate(texts):
            assert f[a[i]:a[i + 1]].tolist() == one(t or "")[k].tolist()


def corpus(seed, n=300):
    rnd = random.Random(seed)
    good = ["river", "mountain", "öffnen", "window", "table", "garden"]
    bad = ["BUY!!", "$$$", "###", "CLICK!!", "&&&", "WIN!!"]
    rows = [(i, " ".join(rnd.choices(good if i % 3 else bad, k=rnd.randint(1, 40)))) for i in range(n)]
    return rows, [(i, int(bool(i % 3))) for i in range(n)]


def test_learns_and_separates(spark):
    rows, marks = corpus(1)
    rows += [(None, "river"), (9001, None), (9002, ""), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(3)
    labels = spark.createDataFrame(marks[:150] + [(None, 1), (5, None), (77777, 0)], "doc_id long, quality int")
    model = C.fit(docs, labels)
    got = [(r.doc_id, r.score) for r in C.score(docs, model).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    by = dict(got)
    truth = dict(marks)
    assert np.mean([(by[i] >= 0.5) == truth[i] for i in range(150, 300)]) > 0.97
    assert by[9001] == by[9002]
    kept = C.accept(docs, model, 0.3)
    assert kept.columns == docs.columns
    assert kept.count() == sum(s >= 0.3 for _, s in got)


def test_fit_is_reproducible_whatever_the_partitions(spark):
    rows, marks = corpus(2, 60)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = C.fit(docs.repartition(1), labels), C.fit(docs.repartition(5), labels.repartition(4))
    assert a.bias == b.bias and (a.weight == b.weight).all()


def sampled(spark, monkeypatch, rows, marks):
    """Number of features and label of each row the model is fitted on."""
    seen = []
    monkeypatch.setattr(C, "MAX_BYTES", 40_000)
    monkeypatch.setattr(C, "LONG", 4_000)
    monkeypatch.setattr(C.SubwordModel, "fit", staticmethod(lambda r: seen.extend((len(x[1]), x[0]) for x in r)))
    C.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int"))
    return seen


@pytest.mark.parametrize("rank", [0, 1, 30, 59])
def test_one_giant_text_at_any_rank_leaves_the_sample_whole(spark, monkeypatch, rank):
    rows, marks = corpus(3, 60)
    df = spark.createDataFrame(marks, "id long, label int")
    ids = [r.id for r in df.orderBy(F.xxhash64("id", "label")).collect()]
    giant = [(i, t if i != ids[rank] else "x" * 50_000) for i, t in rows]
    assert len(sampled(spark, monkeypatch, giant, marks)) == 59


def test_long_texts_and_short_ones_are_both_learned_from(spark, monkeypatch):
    rows, marks = corpus(4, 60)
    rows = [(i, t if i % 3 else f"{t} {'# $ ' * 1500}") for i, t in rows]  # label 0: 20 texts of 6,000 bytes
    seen = sampled(spark, monkeypatch, rows, marks)
    assert sum(label for _, label in seen) == 40 and sum(not label for _, label in seen) >= 3


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = C.fit(docs, labels)
    assert [r.score for r in C.score(docs, model).collect()] == pytest.approx([0.5, 0.5])
    assert C.score(docs.limit(0), model).count() == 0


def test_query_on_held_out_rows(spark):
    from pricefold.llm.queries import QUERIES
    rows = {r.doc_id: r for r in QUERIES["op7_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == 1000
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3)
    held = [(rows[m.doc_id].predicted, m.quality) for m in marks if rows[m.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) > 0.9
    assert np.mean([p for p, q in held if q == 1]) > 0.95
