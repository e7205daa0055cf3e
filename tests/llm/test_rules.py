"""Rule statistics against brute force; the forest against recursive trees."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricefold.llm import rules


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup, lines = set(), 0, 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            dup += line in seen
            seen.add(line)
    where = {}
    for i in range(len(w) - 2):
        where.setdefault(tuple(w[i:i + 3]), []).append(i)
    rep = {j for at in where.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep), lines,
            len(re.findall("[A-Z]", t)), len(set(w)))


def texts(seed, n=60):
    rnd = random.Random(seed)
    vocab = ["a", "B#", "Ünï", "日本", "x|", "<p>", "the", "THE"] + [f"w{i}" for i in range(8)]
    out = [rnd.choice(["", " ", "\n"]).join(
        rnd.choice(vocab) + rnd.choice([" ", "\n", "\n\n", "\t", "  \n", "\r\n", " "]) for _ in range(rnd.randint(0, 50)))
        for _ in range(n)]
    return out + ["", None, "\n\n", "a b c a b c", "a\na\na", "a a a a", "one"]


@pytest.mark.parametrize("seed", [1, 2])
def test_statistics_equal_brute_force(spark, seed):
    rows = [(i if i != 4 else None, t) for i, t in enumerate(texts(seed))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("x")).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in rules.rule_statistics(df).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_forest_walk_equals_recursion_and_finds_outliers():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (500, 3)), [[9, 9, 9], [-8, 7, 0]]])
    forest = rules.IsolationForest(x, trees=20)
    got = forest.score(x)
    assert set(np.argsort(got)[-2:]) == {500, 501} and (got > 0).all() and (got < 1).all()

    def depth(tree, node, p):
        feature, value, left, path = tree
        return path[node] if feature[node] < 0 else depth(tree, left[node] + (p[feature[node]] > value[node]), p)

    mean = [np.mean([depth(t, 0, p) for t in forest.trees]) for p in x[:50]]
    assert got[:50] == pytest.approx(np.exp2(-np.array(mean) / rules._usual_path(256)))


def test_threshold_bounds_the_loss():
    assert rules.threshold([{900: 5}, {100: 99, 950: 1}]) <= 0.9
    assert rules.threshold([{500: 5}, {500: 50, 100: 50}]) == 2.0
    assert rules.threshold([{}, {5: 1}]) == 2.0 == rules.threshold([{5: 1}, {}])


def test_verdicts(spark):
    good = [(i, " ".join(f"w{(i * 7 + j * j) % 97}x{j}" for j in range(60 + i % 30))) for i in range(120)]
    junk = [(1000 + i, " ".join(f"##{j}$$%%&&|{i}" for j in range(80))) for i in range(6)]
    rest = [(2000, "a b c " * 40), (2001, None), (2002, "short"), (None, good[0][1]), (3, good[3][1])]
    df = spark.createDataFrame(good + junk + rest, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:80]] + [(i, 0) for i, _ in junk[:3]] + [(None, 0)],
                                   "doc_id long, quality int")
    got = {r.doc_id: r for r in rules.quality_verdicts(df, labels).collect()}
    assert all(got[i].kept for i, _ in good) and got[None].kept
    assert not any(got[i].kept for i, _ in junk)
    assert [got[i].base_failed for i in (2000, 2001, 2002)] == [True] * 3
    assert all(r.kept != r.base_failed for r in rules.quality_verdicts(df, labels.limit(0)).collect())
    assert rules.quality_verdicts(df.limit(0), labels).count() == 0


def test_query_keeps_good_and_rejects_bad(spark):
    from pricefold.llm.queries import QUERIES
    rows = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.01").collect()}
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    kept = {q: np.mean([rows[m.doc_id].kept for m in marks if m.quality == q and not rows[m.doc_id].base_failed]) for q in (0, 1)}
    assert kept[1] > 0.97 and kept[0] < 0.3
