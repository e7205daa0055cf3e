"""Count-only Viterbi against the tokenizers library's unigram model."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from pricefold.llm.lattice import Pieces
from pricefold.llm.shared import public_model, read_model
from pricefold.llm.viterbi import Counter, token_counts

MODEL = read_model(public_model())


def reference(vocab):
    t = Tokenizer(models.Unigram(list(zip(vocab.names, map(float, vocab.weight))), unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    return t


def texts(seed, n=200):
    rnd = random.Random(seed)
    vocab = Pieces(MODEL)
    bits = [vocab.names[rnd.randrange(259, 32000)].replace("▁", " ") for _ in range(400)]
    bits += [" ", "  ", "   ", " " * 16, " " * 21, "\n", "\t", "é", "日本", "🙂", "▁", "internationalisation", "aaaaaaaa", "<s>", "<0x41>", "́", "0123"]
    return ["".join(rnd.choices(bits, k=rnd.randint(0, 25))) for _ in range(n)] + ["", " ", "   ", "a", "🙂🙂", "▁▁x", "x" * 3000]


@pytest.mark.parametrize("scores", ["zipf", "ranks", "ties", "random"])
def test_counts_equal_the_library(scores):
    import pyarrow as pa
    import pyarrow.compute as pc

    from pricefold.llm.tokens import chunks
    n = 32000
    rng = np.random.default_rng(2)
    given = {"zipf": None, "ranks": [-float(max(i - 259, 0)) for i in range(n)], "ties": [-float(i % 3) for i in range(n)],
             "random": (-rng.random(n) * 9).tolist()}[scores]
    vocab = Pieces(MODEL, given)
    lib, counter = reference(vocab), Counter(vocab)
    rows = texts(3)
    got = []
    for c in chunks(pc.replace_substring(pa.array(rows), "▁", " "), limit=300):
        got += counter.count(c)[0].tolist()
    want = [len(lib.encode(t, add_special_tokens=False).ids) for t in rows]
    assert [(t, g) for t, g in zip(rows, got)] == [(t, w) for t, w in zip(rows, want)]


def test_cache_limits_change_nothing(monkeypatch):
    import pyarrow as pa

    from pricefold.llm import viterbi
    from pricefold.llm.tokens import chunks
    rows = [t.replace("▁", " ") for t in texts(4)]
    run = lambda: [x for c in chunks(pa.array(rows), limit=500) for x in counter.count(c)[0].tolist()]
    counter = Counter(Pieces(MODEL))
    whole = run()
    monkeypatch.setattr(viterbi, "CACHE", 20)
    counter = Counter(Pieces(MODEL))
    assert run() == whole


def test_rows_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "the  end", 5), (None, None, 6), (1, "", 7), (1, "the  end", 5)],
                               "doc_id long, text string, n_tokens_ int").withColumn("best_score", F.lit("x")).repartition(2)
    got = sorted(((r.doc_id, r.n_tokens) for r in token_counts(df, public_model()).collect()), key=repr)
    n = len(reference(Pieces(MODEL)).encode("the  end").ids)
    assert got == sorted([(1, n), (None, 0), (1, 0), (1, n)], key=repr)
    assert token_counts(df.limit(0), public_model()).count() == 0


def test_runs_of_spaces_take_their_pieces():
    """Indented text: pieces of several spaces count as one."""
    import pyarrow as pa

    from pricefold.llm.tokens import chunks
    vocab = Pieces(MODEL, [-1.0] * 32000)
    rows = ["def f():" + "\n" + " " * n + "return 1" for n in range(40)] + [" " * 16, "a" + " " * 16]
    counter = Counter(vocab)
    got = [x for c in chunks(pa.array(rows)) for x in counter.count(c)[0].tolist()]
    assert got == [len(reference(vocab).encode(t, add_special_tokens=False).ids) for t in rows]
    assert got[-2] == 1


def test_pieces_across_words_are_found():
    """A vocabulary with a space inside a piece: texts are one unit each."""
    import pyarrow as pa

    from pricefold.llm.tokens import chunks
    vocab = Pieces(MODEL, [-1.0] * 32000)
    vocab.names[500] = "of▁the"
    vocab.bytes[500] = b"of the"
    counter = Counter(vocab)
    rows = ["one of the two", "of the", "  of  the"]
    got = [x for c in chunks(pa.array(rows)) for x in counter.count(c)[0].tolist()]
    assert got == [len(reference(vocab).encode(t, add_special_tokens=False).ids) for t in rows]


def test_a_text_longer_than_a_chunk():
    import pyarrow as pa

    from pricefold.llm.tokens import CHUNK, chunks
    vocab = Pieces(MODEL)
    text = "the quick  brown fox " * (CHUNK // 15)
    counter = Counter(vocab)
    got = [x for c in chunks(pa.array(["a", text, "b"])) for x in counter.count(c)[0].tolist()]
    part = len(reference(vocab).encode("the quick  brown fox").ids)
    assert len(text) > CHUNK and got[1] >= part * (CHUNK // 15) and got[0] == got[2] == 1
