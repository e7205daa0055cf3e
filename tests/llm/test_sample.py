"""Sampled segmentations: lossless round trips, and the exact distribution."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricefold.llm.lattice import Pieces
from pricefold.llm.sample import Sampler, decode, encode
from pricefold.llm.shared import public_model, read_model
from pricefold.llm.tokens import chunks, mix

MODEL = read_model(public_model())
VOCAB = Pieces(MODEL)


def segmentations(text):
    """All piece sequences of a text (with its opening space) and weights."""
    names = {p.replace("▁", " "): i for i, p in enumerate(VOCAB.names) if VOCAB.plain[i]}

    def go(rest):
        if not rest:
            yield (), 0.0
            return
        single = False
        for n in range(1, len(rest) + 1):
            i = names.get(rest[:n])
            if i is not None:
                single |= n == 1
                for ids, w in go(rest[n:]):
                    yield (i, *ids), VOCAB.weight[i] + w
        if not single:
            spelled = tuple(int(VOCAB.byte_id[b]) for b in rest[0].encode())
            for ids, w in go(rest[1:]):
                yield (*spelled, *ids), VOCAB.unknown + w

    return list(go(" " + text))


@pytest.mark.parametrize("text,alpha", [("then", 1.0), ("a in", 0.5), ("x  y", 0.2), ("é\U0001f642o", 0.1)])
def test_draws_follow_the_lattice(text, alpha):
    n = 20000
    (c,) = chunks(pa.array([text] * n))
    ids, bound = Sampler(VOCAB, alpha).encode(c, mix(np.arange(n, dtype=np.uint64)))
    got = Counter(tuple(ids[a:b].tolist()) for a, b in zip(bound[:-1], bound[1:]))
    all_ = segmentations(text)
    z = sum(math.exp(alpha * w) for _, w in all_)
    want = {s: math.exp(alpha * w) / z for s, w in all_}
    assert set(got) <= set(want)
    assert sum(abs(got[s] / n - p) for s, p in want.items()) < 0.06


def texts(seed, n=150):
    rnd = random.Random(seed)
    bits = ["the", " end", "  ", "   ", "\n", "\t", "Übung", "日本語", "🙂", "▁", "▁▁", "<0x0A>", "<s>", "́", "\x00", "internationalisation", "1234"]
    return ["".join(rnd.choices(bits, k=rnd.randint(0, 30))) for _ in range(n)] + ["", " ", "  a", "a  ", "x" * 2000, "\n"]


def test_round_trip_is_lossless_and_reproducible(spark):
    rows = [(i, t) for i, t in enumerate(texts(1))] + [(None, None), (None, "null key"), (3, "again"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_key", F.lit("x"))
    one = encode(df.repartition(1), public_model())
    told = encode(df, public_model(), lossless="same")
    assert told.columns == [*df.columns, "ids", "same"] and all(r.same for r in told.collect())
    got = decode(one, public_model())
    assert got.columns == [*df.columns, "ids", "decoded"]
    for r in got.collect():
        assert r.decoded == r.text and (r.ids is None) == (r.text is None)
    key = lambda r: (repr(r.doc_id), repr(r.text))
    many = encode(df.repartition(7), public_model())
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)
    other = {key(r): r.ids for r in encode(df, public_model(), seed=1).collect()}
    assert any(other[key(r)] != r.ids for r in one.collect())
    assert decode(encode(df.limit(0), public_model()), public_model()).count() == 0


def test_high_alpha_finds_the_best_path():
    text = "then internationalisation of windows"
    (c,) = chunks(pa.array([text]))
    ids, _ = Sampler(VOCAB, 500.0).encode(c, mix(np.arange(1, dtype=np.uint64)))
    best = []
    for w in text.split():
        best += max(segmentations(w), key=lambda x: x[1])[0] if len(w) < 12 else []
    assert [i for i in ids.tolist() if i in best][:len(best)] == [i for i in best]
