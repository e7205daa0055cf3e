"""Fingerprints: sets, densification and packing against plain versions; likeness against true Jaccard."""

import hashlib
import random

import numpy as np
import pytest

from pricefold.llm import fingerprints as fp

WORDS = [f"w{i}" for i in range(2000)] + ["Über", "日本", "x"]


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split(" ")
    w = [x for x in " ".join(w).replace("\n", " ").replace("\t", " ").split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def some(seed, n, sizes=(0, 1, 3, 5, 9, 40, 300)):
    rnd = random.Random(seed)
    return [rnd.choice([" ", "\n", " \t "]).join(rnd.choice(WORDS) for _ in range(rnd.choice(sizes))) for _ in range(n)]


def test_likeness_estimates_jaccard():
    rnd, a, b, true = random.Random(3), [], [], []
    for _ in range(300):
        w = [rnd.choice(WORDS) for _ in range(rnd.choice([1, 2, 5, 7, 20, 80, 400]))]
        k = rnd.randint(0, len(w))
        v = w[:k] + [rnd.choice(WORDS) for _ in w[k:]]
        a.append(" ".join(w)), b.append("\n".join(v).upper().replace("Ü", "Ü"))
        x, y = shingles(a[-1]), shingles(b[-1])
        true.append(len(x & y) / len(x | y))
    gap = fp.likeness(fp.sketches(a), fp.sketches(b)) - np.array(true)
    assert abs(gap.mean()) < 0.01 and gap.std() < 0.03 and np.abs(gap).max() < 0.13


def test_unlike_texts_are_not_alike():
    texts = [f"only{i}" for i in range(300)]
    got = fp.likeness(fp.sketches(texts), fp.sketches(texts[::-1]))
    assert got.mean() < 0.02 and got.max() < 0.08


def test_equal_sets_equal_fingerprints_and_empty():
    a, b, c, d, e = fp.sketches(["A b\tc", "a  B c", "", " \n", "a b"])
    assert a == b and c == d == b"" and e not in (a, b"")
    assert fp.likeness([a, c, c, a], [b, d, a, c]).tolist() == [1.0, 1.0, 0.0, 0.0]


@pytest.mark.parametrize("bins", [8, 64])
def test_densification_equals_plain(bins):
    rnd = np.random.default_rng(5)
    least = rnd.integers(0, 1 << 50, (60, bins)).astype(np.uint64)
    for r in range(60):
        least[r, rnd.permutation(bins)[: rnd.integers(0, bins + 1)]] = fp._NONE
    got = fp.densify(least)
    n = fp._ATTEMPTS * bins
    asks = fp.mix(np.arange(n * bins, dtype=np.uint64) + np.uint64(1)).reshape(n, bins) % np.uint64(bins)
    salt = fp.mix(np.arange(1, bins + 1, dtype=np.uint64))
    for r in range(60):
        full = least[r] != fp._NONE
        for j in range(bins):
            if full[j] or not full.any():
                assert got[r, j] == least[r, j]
            else:
                k = next(int(asks[t, j]) for t in range(n) if full[int(asks[t, j])])
                assert got[r, j] == fp.mix(least[r, k:k + 1] ^ salt[j:j + 1])[0]


def test_packing_round_trip():
    values = np.random.default_rng(2).integers(0, 1 << 60, (7, 32)).astype(np.uint64)
    for bits in (1, 2, 4, 5):
        back = fp._unpacked(fp.pack(values, bits), 32, bits)
        assert ((back * (1 << np.arange(bits))).sum(axis=2) == (values & np.uint64((1 << bits) - 1))).all()


def test_long_texts_are_read_in_pieces(monkeypatch):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(400_000)), "y" * 1_500_000, "z" * 1_200_000 + " a " + "é" * 700_000,
             " ".join(["u" * 400_000] * 6), " " * 2_000_000 + "a b c d e f"]
    whole_at = fp.PIECE
    pieces = fp.sketches(texts)
    monkeypatch.setattr(fp, "PIECE", 1 << 30)
    assert len(texts[0]) > 2 * whole_at and pieces == fp.sketches(texts)


def plain_neighbours(rows):
    order = sorted(((i is not None, i or 0), t or "") for i, t in rows)[::-1]
    texts = [t for _, t in order]
    follow = texts[1:] + texts[:1]
    changed = [t[: len(t) - len(t) // 3] + f[: len(t) // 3] for t, f in zip(texts, follow)]
    own, other, after = fp.sketches(texts), fp.sketches(changed), fp.sketches(follow)
    return sorted(((k[1] if k[0] else -1), len(t), hashlib.sha256(c.encode()).hexdigest(), a, b, x, y) for (k, t), c, a, b, x, y in
                  zip(order, changed, own, other, fp.likeness(own, other), fp.likeness(own, after)))


def found(df):
    assert df.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((-1 if r[0] is None else r[0], r[1], r[2], bytes(r[3]), bytes(r[4]), r[5], r[6]) for r in df.collect())


@pytest.mark.parametrize("n,size", [(1, 1 << 20), (2, 10), (90, 500), (90, 1 << 30)])
def test_neighbours_equal_plain(spark, monkeypatch, n, size):
    """From one row a range to few ranges; the last document is followed by the first."""
    monkeypatch.setattr(fp, "RANGE_BYTES", size)
    texts = some(n, n)
    rows = list(zip(random.Random(n).sample(range(1000), n), texts))
    if n > 2:
        rows += [(None, "after all the numbered ones of this table"), (5000, None)]
    df = spark.createDataFrame([(i, t, "r", 1, "f") for i, t in rows], "doc_id long, text string, range string, tie int, first string")
    assert found(fp.neighbours(df.repartition(3))) == plain_neighbours(rows)


def test_repeated_ids_and_rows(spark):
    """A third of the rows hold one id: every row is followed by one of them or the next id."""
    rows = [(7, "same text of five words and more")] * 12 + [(7, "another")] + [(i, f"text number {i}") for i in range(8, 30)]
    got = found(fp.neighbours(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert len(got) == len(rows) and [r[0] for r in got].count(7) == 13
    assert sum(r[0] == 7 and r[6] == 1.0 for r in got) >= 11


def test_fingerprints_keep_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "x y z", "b"), (1, "x y z", "b")], "doc_id long, text string, fingerprint string")
    got = fp.fingerprints(df).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "fingerprint", "fingerprint_"}
    assert sorted(bytes(r.fingerprint_) for r in got) == sorted([b"", *fp.sketches(["x y z"]) * 2])
    assert fp.fingerprints(df.where("false")).count() == 0 and fp.neighbours(df.where("false")).count() == 0
