"""Kneser-Ney scores against a plain dictionary implementation."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricefold.llm import ngram


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


class Brute:
    def __init__(self, texts, order):
        self.order = order
        self.uni = Counter()
        raw = Counter()
        for t in texts:
            w = words(t) + [None]  # None ends a text, 0 starts it
            self.uni.update(w)
            seq = [0] * (order - 1) + w
            for i in range(order - 1, len(seq)):
                raw[tuple(seq[i - order + 1:i + 1])] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.a = {order: dict(raw)}
        for k in range(order - 1, 0, -1):
            low = Counter()
            for g, c in self.a[k + 1].items():
                low[g[1:]] += c if g[1] == 0 else 1
            self.a[k] = dict(low)
        self.d, self.ctx = {}, {}
        for k, grams in self.a.items():
            n = np.array([sum(1 for c in grams.values() if c == j) for j in (1, 2, 3, 4)], float)
            self.d[k] = ngram.discounts(n)
            s = defaultdict(lambda: [0, 0, 0, 0])
            for g, c in grams.items():
                s[g[:-1]][0] += c
                s[g[:-1]][min(c, 3)] += 1
            self.ctx[k] = s

    def p(self, gram):
        if not gram:
            return 1 / (self.v + 1)
        k = len(gram)
        low = self.p(gram[1:])
        s = self.ctx[k].get(gram[:-1])
        if s is None:
            return low
        a, d = self.a[k].get(gram, 0), self.d[k]
        return (max(a - (d[min(a, 3) - 1] if a else 0), 0) + (d @ np.array(s[1:])) * low) / s[0]

    def score(self, text):
        w = words(text) + [None]
        seq = [0] * (self.order - 1) + w
        got = sum(math.log10(self.p(tuple(seq[i - self.order + 1:i + 1]))) for i in range(self.order - 1, len(seq)))
        base = sum(math.log10((self.uni[x] + 1) / (self.n + self.v + 1)) for x in w)
        return len(w), sum(1 for x in w if self.uni[x]), self.n, base, got


def corpus(seed, n=120):
    rnd = random.Random(seed)
    vocab = ["The", "of", "ÉA", "a b"] + [f"w{i}" for i in range(30)]
    rows = [(i, rnd.choice([" ", "\n", "  "]).join(rnd.choices(vocab, weights=[9, 7, 4, 3] + [1] * 30, k=rnd.randint(0, 40))))
            for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (None, "The of the"), (3, rows[3][1])]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_brute_force(spark, order):
    rows = corpus(order)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(3)
    train = [t for i, t in rows if i is None or i % 4]
    model = ngram.train(df.where("doc_id is null or doc_id % 4 <> 0"), order)
    b = Brute(train, order)
    assert model.tokens == b.n
    got = {r.doc_id: tuple(r)[1:] for r in ngram.score(df, model).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(b.score(t), rel=1e-9), (i, t)


def test_probabilities_sum_to_one():
    b = Brute([t for _, t in corpus(5)], 3)
    for ctx in [(0, 0), (0, "the"), ("the", "of"), ("nix", "nada")]:
        total = sum(b.p((*ctx, w)) for w in [*b.uni, "never seen"])
        assert total == pytest.approx(1)


def test_shards_and_flushes_change_nothing(spark, monkeypatch):
    rows = corpus(8, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain = ngram.score(df, ngram.train(df, 2)).collect()
    monkeypatch.setattr(ngram, "SHARD_BYTES", 500)
    assert ngram._bits(20_000) > 4
    split = ngram.score(df, ngram.train(df, 2)).collect()
    key = lambda r: (repr(r.doc_id), r.n_tokens, r.score)
    for x, y in zip(sorted(plain, key=key), sorted(split, key=key)):
        assert tuple(x) == pytest.approx(tuple(y))


def test_many_shards_share_files_that_stay_open(spark, monkeypatch):
    rows = corpus(9, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain = ngram.score(df, ngram.train(df, 3)).collect()
    monkeypatch.setattr(ngram, "SHARD_BYTES", 20)
    model = ngram.train(df, 3)
    assert model.bits >= 10
    kept = [[os.path.basename(f) for f in os.listdir(f"{model.folder}/order{n}")] for n in (1, 2, 3)]
    assert max(map(len, kept)) <= 2 ** ((model.bits + 7) // 2)
    key = lambda r: (repr(r.doc_id), r.n_tokens, r.score)
    for x, y in zip(sorted(plain, key=key), sorted(ngram.score(df, model).collect(), key=key), strict=True):
        assert tuple(x) == pytest.approx(tuple(y))
    texts = [t for _, t in rows if t]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    run = ngram._score(model.folder, "text")
    list(run(iter([batch])))
    files = [e.files.open for e in ngram._opened(model.folder)[2]]
    before = [dict(f) for f in files]
    list(run(iter([batch])))
    for was, now in zip(before, files):
        assert len(was) > 30 and all(now[k] is v for k, v in was.items())


def test_tokens_looked_up_together_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame(corpus(10), "doc_id long, text string").coalesce(1)
    model = ngram.train(df, 3)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": ["the of", None, "", "w1 w2 of", "a", "of the"] })
    alike = pa.RecordBatch.from_pydict({"doc_id": [], "text": []}, schema=batch.schema)
    for most in (0, 3, 1 << 19):
        monkeypatch.setattr(ngram, "LOOKUP", most)
        got = pa.Table.from_batches(ngram._score(model.folder, "text")(iter([batch, alike, batch]))).to_pylist()
        if not most:
            want = got
        assert [r["doc_id"] for r in got] == [*range(6)] * 2
        assert got == want


@pytest.mark.parametrize("words, columns", [(9, 3), (1 << 21, 3), (1 << 26, 3), (1 << 26, 2), ((1 << 32) - 1, 3), (1 << 25, 4)])
def test_equal_grams_come_together_whatever_the_vocabulary(words, columns):
    rnd = np.random.default_rng(words % 1000)
    some = np.append(rnd.integers(0, words, 60), words)
    grams = np.stack([rnd.choice(some[: 7 + 18 * k], 5000) for k in range(columns)]).T.astype(np.uint32)
    grams[:, -1] ^= rnd.integers(0, 4, 5000).astype(np.uint32)  # words that differ in their last bits alone
    counts = Counter(map(tuple, grams.tolist()))
    vals = rnd.integers(0, 9, (5000, 2))
    sums = defaultdict(lambda: [0, 0])
    for g, v in zip(grams.tolist(), vals.tolist()):
        sums[tuple(g)] = [a + b for a, b in zip(sums[tuple(g)], v)]
    for got, value, want in [(*ngram._counted(grams), {k: [v] for k, v in counts.items()}), (*ngram._grouped(grams, vals), dict(sums))]:
        assert dict(zip(map(tuple, got.tolist()), value.tolist())) == want and len(got) == len(want)
        heads = [tuple(g[:-1]) for g in got.tolist()]
        assert heads == sorted(heads)


def test_large_and_small_numbers_are_coded():
    rnd = np.random.default_rng(4)
    values = np.concatenate([rnd.integers(0, 5, (3000, 5)), rnd.integers(0, 1 << 40, (50, 5)), rnd.integers(0, 3000, (500, 5))])
    for part in (values, values[:3000], values[3050:], values[3000:3050], values[:, :1], values[:0]):
        table, code = ngram._coded(part)
        assert (table[code] == part).all() and len(np.unique(table, axis=0)) == len(table)


def test_empty_training_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = ngram.train(df.limit(0), 2)
    assert sorted(map(tuple, ngram.score(df, model).collect())) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert ngram.score(df.limit(0), model).count() == 0


def test_query_contract_and_better_than_base(spark):
    from pricefold.llm.queries import QUERIES
    rows = QUERIES["op1_kneser_ney"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_query_looks_at_two_words_of_context(spark):
    from pricefold.llm.queries import QUERIES
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.score, r.held_out) for r in QUERIES["op1_kneser_ney"](spark, "/root/testdata/sf0.001").collect()}
    held = spark.createDataFrame([(i, h) for i, (_, h) in got.items()], "doc_id long, held_out boolean")
    model = ngram.train(docs.join(held.where("not held_out"), "doc_id", "left_semi"), 3)
    want = {r.doc_id: r.score for r in ngram.score(docs, model).collect()}
    assert {i: s for i, (s, _) in got.items()} == pytest.approx(want)
