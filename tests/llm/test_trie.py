"""The conversation trie against a plain one built turn by turn."""

import hashlib
import random
import zlib

import pytest

from pricefold.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, cell int, path string"


def plain(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: y[0])] for c, v in own.items()}
    members, ends = {(): []}, {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        lead = c - (c % 100 if c >= 0 else -(-c % 100))
        path = own.get(lead, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def total(p, leaf):
        if leaf:
            mine = int(p not in kids)
        else:
            mine = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        return mine + sum(total(q, leaf) for q in kids.get(p, []))

    return sorted(
        (members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), len(kids.get(p, [])), total(p, True),
         total(p, False), hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest())
        for p in members) if own else []


def found(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == cols
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, df.collect()))


def make(seed, convs):
    """Shared openings, equal conversations, absent leaders, null and empty cells."""
    rnd = random.Random(seed)
    texts = ["hi", "Grüße 🎈", "", None, "ok then", "a\0b"]
    rows = []
    hot = [("user", "hi"), ("bot", "ok then"), ("user", None)]
    for c in rnd.sample(range(-150, 900), convs):
        if rnd.random() < 0.35:
            turns = hot + hot * rnd.randint(0, 1)
        else:
            turns = [(rnd.choice(["user", "bot", None]), rnd.choice(texts)) for _ in range(rnd.randint(1, 9))]
        at = sorted(rnd.sample(range(40), len(turns)))
        rows += [(c, None if i == 0 and rnd.random() < 0.3 else a, r, x) for i, (a, (r, x)) in enumerate(zip(at, turns))]
    rows += [(None, 1, "user", "of nobody"), (None, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,convs,shard", [(1, 60, 100), (2, 250, 400), (3, 250, 1 << 20)])
def test_nodes_equal_plain_trie(spark, monkeypatch, seed, convs, shard):
    """Many small shards: nearly every node lies on a boundary."""
    monkeypatch.setattr(trie, "SHARD_BYTES", shard)
    rows = make(seed, convs)
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(5)
    assert found(trie.conversation_trie(df)) == plain(rows)


def test_one_conversation_many_times(spark, monkeypatch):
    """Equal paths straddle shards; the ids that end there are hashed in order."""
    monkeypatch.setattr(trie, "SHARD_BYTES", 60)
    monkeypatch.setattr(trie, "IDS", 3)
    rows = [(c, t, "user", f"turn {t}") for c in range(1, 120) for t in range(3)]
    assert found(trie.conversation_trie(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA))) == plain(rows)


def test_turnless_repeated_and_empty(spark):
    short = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(short, 0, "user", "x"), (short, 0, "user", "x")]  # leader absent: turnless
    rows += [(700, 1, "a", "same"), (700, 1, "a", "same")]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)
    assert found(trie.conversation_trie(df)) == plain(rows)
    assert found(trie.conversation_trie(df.where("false"))) == []


def test_long_conversation(spark):
    rows = [(100, t, "user", "x" * (t % 7)) for t in range(3000)] + [(100 + k, t, "user", "x" * (t % 7)) for k in (1, 2) for t in range(2990)]
    got = found(trie.conversation_trie(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)))
    assert len(got) >= 3001 and max(r[1] for r in got) == 3000
    root = next(r for r in got if r[1] == 0)
    assert root[3] == 3


def test_long_text_counts_code_points(spark):
    rows = [(0, 0, "user", "é" * 2_000_000), (1, 0, "user", "é" * 2_000_000)]
    assert found(trie.conversation_trie(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA))) == plain(rows)


def test_medians_are_a_permutation():
    for n in range(20):
        assert sorted(trie.medians(n)) == list(range(n))
