"""The corpus pipeline, each stage against a brute-force version of it."""

import re

import pytest
from test_jaccard import brute as groups_of
from test_secrets import brute as spans_of
from test_suffix import brute as hits_of

import corpus_pipeline
from pricefold.llm import classifier, sample
from pricefold.llm.secrets import RULES
from pricefold.llm.shared import public_model

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows that go into each stage, and those that come out of the last."""
    folder = tmp_path_factory.mktemp("stages")
    docs, rows = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        rows.append((docs.columns, docs.collect()))
        f(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return [*rows, (docs.columns, docs.collect())]


def texts(rows):
    return {r.doc_id: r.text for r in rows[1]}


def test_columns_of_documents_are_kept(spark, stages):
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(stages[k][0] == names for k in range(5))
    assert 0 < len(stages[5][1]) < len(stages[0][1])


def test_classifier_stage(spark, stages):
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in stages[0][1]], "doc_id long, text string")
    from pyspark.sql import functions as F
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    scores = {r.doc_id: r.score for r in classifier.score(docs, classifier.fit(docs, labels)).collect()}
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if scores[i] >= 0.3}


def test_duplicate_stage(stages):
    rows = list(texts(stages[1]).items())
    keep = {i for i, _, c in groups_of(rows, 8, 10, 5) if i == c}
    assert texts(stages[2]) == {i: t for i, t in rows if i in keep} and len(keep) < len(rows)


def test_benchmark_stage(spark, stages):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = list(texts(stages[2]).items())
    bad = {d for d, _, n, *_ in hits_of(rows, bench, 10, longest=False) if n}
    assert texts(stages[3]) == {i: t for i, t in rows if i not in bad}


def test_secret_stage(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    for i, t in before.items():
        want = t
        for r in RULES:
            want = re.sub(r.strict or r.pattern, "[SECRET]", want)
        assert after[i] == want and (bool(spans_of(t)) <= (want != t)) and spans_of(want) == ""


def test_last_stage_is_lossless_and_run_gives_the_same(spark, stages):
    from pricefold.llm.shared import read_model
    from pricefold.llm.lattice import Pieces
    vocab = Pieces(read_model(public_model()))
    want = texts(stages[4])
    for r in stages[5][1]:
        t = b"".join(vocab.bytes[i] for i in r.ids).decode()
        assert t[1:] == want[r.doc_id] and r.n_pieces == len(r.ids)
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[5][1]))
    assert sample.ALPHA == 1.0
