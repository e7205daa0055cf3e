"""Jaccard join against brute force over all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pricefold.llm.components import connected_components
from pricefold.llm.jaccard import keep_one, shingle_components


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def brute(rows, num, den, width):
    sets = [shingles(t, width) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), least.get(find(i), None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(seed, words=40):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["of", "the", "and", "Ünï", "TO"]
    rows = []
    for g in range(12):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(3, words))]
        for _ in range(rnd.choice([1, 2, 6, 15])):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            if rnd.random() < 0.2:
                t = t + [rnd.choice(vocab)]
            rows.append(rnd.choice([" ", "  ", "\n", "\t "]).join(t))
    rows += ["", "   ", "one", "ONE", "two words", "Two  words", None, "of the and of the and"]
    rnd.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,num,den,width", [(1, 90, 100, 3), (2, 8, 10, 5), (3, 1, 2, 2)])
def test_components_equal_brute_force(spark, seed, num, den, width):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, shingle_components(df, num, den, width).collect()), key=repr)
    assert got == brute(rows, num, den, width)


def test_ties_nulls_repeats_and_clashing_columns(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "A B C D E F"), (None, "a b c d e f"), (7, None), (None, None),
            (8, ""), (9, "x"), (9, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("n", F.lit("q"))
    got = sorted(map(tuple, shingle_components(df).collect()), key=repr)
    assert got == sorted([(5, 2, 2), (5, 2, 2), (2, 2, 2), (None, 2, 2), (7, 0, 7), (None, 0, None), (8, 0, 8), (9, 1, 9),
                          (9, 1, 9)], key=repr)
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(2, "A B C D E F"), (7, None), (None, None), (8, ""), (9, "x"), (9, "y")], key=repr)


def test_repeats_of_the_row_that_stays_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", 1), (1, "a b c d e f g", 2), (3, "a b c d e f g", 3)],
                               "doc_id long, text string, x int")
    assert [r.doc_id for r in keep_one(df).collect()] == [1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert shingle_components(df).count() == 0
    assert keep_one(df).count() == 0


def test_long_chain_and_hub_components(spark, tmp):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (7, None)]
    roots = connected_components(spark.createDataFrame(chain, "a long, b long"), f"{tmp}/cc").collect()
    groups = {}
    for node, root in roots:
        groups.setdefault(root, set()).add(node)
    assert sorted(map(len, groups.values())) == [200, 301]


def test_text_ids(spark):
    rows = [("b", "one two three four five six"), ("a", "one two three four five six"), ("10", "nothing like the others at all here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id string, text string").withColumn("g", F.lit(1)).withColumn("stays", F.lit(2))
    from pricefold.llm.jaccard import keep_one, shingle_components
    got = {r.doc_id: r.component_id for r in shingle_components(df).collect()}
    assert got == {"a": "a", "b": "a", "10": "10", None: None}
    kept = keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {"a", "10", None}
    assert keep_one(df.where("false")).count() == 0
