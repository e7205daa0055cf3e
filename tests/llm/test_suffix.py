"""Suffix-array decontamination against brute force over all windows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricefold.llm import suffix


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, bench, width, longest=True):
    wins = {}
    for i, t in bench:
        w = words(t)
        n = min(width, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[a:a + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, items, best = words(t), set(), set(), (0,)
        for n in {len(x) for x in wins}:
            for a in range(len(w) - n + 1):
                got = wins.get(tuple(w[a:a + n]))
                if got:
                    hit |= set(range(a, a + n))
                    items |= {str(x) for x in got if x is not None}
        for i, x in bench if longest else ():  # every maximal match of a window or more
            x = words(x)
            n = min(width, len(x))
            for a in range(len(x)):
                for k in range(len(w)):
                    size = 0
                    while a + size < len(x) and k + size < len(w) and x[a + size] == w[k + size]:
                        size += 1
                    if n and size >= n:
                        best = min(best, (-size, i is None, "" if i is None else str(i), a, k))
        found = (0, None, None, None) if best == (0,) else (-best[0], None if best[1] else best[2], *best[3:])
        out.append((d, len(w), len(hit), sorted(items), *found))
    return sorted(out, key=repr)


def tables(seed):
    rnd = random.Random(seed)
    vocab = ["the", "of", "Über", "x1", "a", "b"] + [f"v{i}" for i in range(12)]
    bench = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 4, 7, 10, 13, 25])))) for i in range(15)]
    bench += [(3, bench[3][1]), (77, bench[5][1].upper()), (78, ""), (79, None), (None, "the of the of x1 x1 a b v3")]
    docs = []
    for d in range(80):
        t = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        if rnd.random() < 0.6:
            w = (rnd.choice(bench)[1] or "").split()
            a = rnd.randint(0, max(0, len(w) - 4))
            at = rnd.randint(0, len(t))
            t[at:at] = w[a:a + rnd.randint(3, 30)]
        docs.append((d, rnd.choice([" ", "! ", "\n"]).join(t)))
    return docs + [(5, None), (None, "the of the of x1 x1 a b v3 end"), (5, docs[5][1])], bench


@pytest.mark.parametrize("seed,width,shard", [(1, 10, 1 << 20), (3, 4, 100), (5, 12, 50)])
def test_hits_equal_brute_force(spark, monkeypatch, seed, width, shard):
    monkeypatch.setattr(suffix, "SHARD", shard)
    docs, bench = tables(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit(0)).repartition(3)
    b = spark.createDataFrame(bench, "item_id long, text string").withColumn("n_words", F.lit("x"))
    got = sorted(map(lambda r: tuple(r)[:3] + (list(r[3]),) + tuple(r)[4:], suffix.contamination(df, b, width).collect()), key=repr)
    assert got == brute(docs, bench, width)
    kept = suffix.decontaminate(df, b, width)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.where("doc_id is not null").collect()) == sorted(
        (d, t or "") for (d, t) in docs if d is not None and not brute([(d, t)], bench, width)[0][2])


@pytest.mark.parametrize("shard,pairs", [(7, 1 << 22), (33, 5), (1000, 40)])
def test_small_shards_find_every_occurrence(monkeypatch, shard, pairs):
    """The search itself, in process, so that the sizes count."""
    import pyarrow as pa
    monkeypatch.setattr(suffix, "SHARD", shard)
    monkeypatch.setattr(suffix, "PAIRS", pairs)
    docs, _ = tables(9)
    from pricefold.llm.tokens import chunks
    text = pa.array([t for _, t in docs], pa.string())
    item = words("the of the of x1 the of the of the of")
    (c,) = chunks(pa.array([" ".join(item)]), fold=True)
    s, e, _ = c.spans(suffix.ALNUM)
    block = suffix.Block.__new__(suffix.Block)
    block.names, block.size = ["i"], np.array([len(item)])
    block.fill(c.hashes(s, e))
    monkeypatch.setattr(suffix, "_load", lambda path: block)
    found, runs = set(), set()
    for c in chunks(text, fold=True):
        first, by, search = suffix._found(c, ["x"], 4)
        for _, _, _, off, at in search:
            found |= {(int(by[p]) + c.start, int(p - first[by[p]]), int(o)) for p, o in zip(at, off)}
        _, _, matches = suffix._matched(c, ["x"], 4)
        for _, _, off, at, n in matches:
            runs |= {(int(by[p]) + c.start, int(p - first[by[p]]), int(o), int(k)) for p, o, k in zip(at, off, n)}
    every = [words(t) for _, t in docs]
    want = {(d, i, a) for d, w in enumerate(every) for i in range(len(w) - 3) for a in range(len(item) - 3) if w[i:i + 4] == item[a:a + 4]}
    assert found == want
    maximal = set()
    for d, i, a in want:
        if (d, i - 1, a - 1) not in want:
            n = 0
            while (d, i + n, a + n) in want:
                n += 1
            maximal.add((d, i, a, n + 3))
    assert runs == maximal


def test_every_suffix_has_its_longest_match():
    rnd = random.Random(4)
    flat = np.array([rnd.choice([0, 1, 2, 3]) for _ in range(400)], np.uint64) << np.uint64(60)
    block = suffix.Block.__new__(suffix.Block)
    block.names, block.size = ["a", "b"], np.array([30, 12])
    block.fill(np.array([rnd.choice([1, 2, 3]) for _ in range(42)], np.uint64) << np.uint64(60))
    got = suffix.Shard(flat, 30).longest(block)
    for j in range(len(block.words)):
        best = 0
        for i in range(len(flat)):
            n = 0
            while i + n < len(flat) and block.words[j + n] and flat[i + n] == block.words[j + n]:
                n += 1
            best = max(best, n)
        assert got[j] == best


def test_longest_matches(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h"), (2, "z z z"), (3, "q")], "item_id long, text string")
    docs = spark.createDataFrame([(10, "x A b, c d e y b c d"), (11, "z z z z q"), (12, None)], "doc_id long, text string")
    got = sorted(map(tuple, suffix.longest_matches(docs, bench, width=3).collect()))
    assert got == [("1", 0, 10, 1, 5), ("1", 1, 10, 7, 3), ("2", 0, 11, 0, 3), ("2", 0, 11, 1, 3), ("3", 0, 11, 4, 1)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert [tuple(r) for r in suffix.contamination(docs, bench.limit(0)).collect()] == [(1, 3, 0, [], 0, None, None, None)]
    assert suffix.contamination(docs.limit(0), bench).count() == 0
    assert suffix.decontaminate(docs.limit(0), bench.limit(0)).count() == 0


def test_empty_ids_and_many_blocks(spark, monkeypatch):
    """An empty id is an id; more blocks than a worker keeps change nothing."""
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "x y z")], "doc_id long, text string")
    bench = spark.createDataFrame([("", "b c d"), ("i1", "x y z"), (None, "a b")], "item_id string, text string")
    got = {r.doc_id: tuple(r)[2:] for r in suffix.contamination(docs, bench, 3).collect()}
    assert got == {1: (4, [""], 3, "", 0, 1), 2: (3, ["i1"], 3, "i1", 0, 0)}
    monkeypatch.setattr(suffix, "BLOCKS", 2)
    suffix._blocks.clear()
    made = []
    monkeypatch.setattr(suffix, "Block", lambda path: made.append(path) or path)
    for path in ["a", "b", "a", "c", "a", "b"]:
        assert suffix._load(path) == path
    assert made == ["a", "b", "c", "b"]
    suffix._blocks.clear()


def test_a_match_across_shards_of_a_long_text(spark):
    """A text of more than a shard's words, one match over the edge."""
    n = suffix.SHARD
    filler = " ".join(f"f{i % 997}" for i in range(n - 20))
    item = " ".join(f"q{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"{filler} {item} {filler[:1000]}")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "zz " + item)], "item_id long, text string")
    r = suffix.contamination(docs, bench).first()
    assert (r.n_hit, r.longest_words, r.longest_item, r.longest_item_word, r.longest_doc_word) == (40, 40, "5", 1, n - 20)
