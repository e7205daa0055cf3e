"""Operator 6: Jaccard join of word shingles by adaptive multi-match prefixes.

Two texts link when ``den * |A & B| >= num * |A | B|`` for their sets A, B of
word shingles.  The result is each document's component, so no pair table of
copies is ever made:

1. Texts with equal sets form one class.  Only classes are compared.
2. A fixed-size table of counters over hashed shingles estimates how many
   texts hold each shingle; it orders each set from rare to frequent.
3. If two sets link, their overlap is at least ``o``, and then for every l the
   first ``|A| - o + l`` and ``|B| - o + l`` shingles share at least l of them.
   Each class picks its own l: a longer prefix costs postings, but asks for l
   shared shingles before a pair is verified.  The estimated document
   frequencies price both.  A pair uses the smaller l of its two classes; it is
   proposed by a shingle of both prefixes for l = 1, then its shared shingles
   are counted in the prefixes for its own l.
4. Round one compares every class only with the anchor of each posting list
   (the class in whose order the shingle comes first), which is linear in the
   postings and collapses large groups of near copies.  Round two compares
   what still lies in different components: all pairs of a posting list
   except those within its largest component, so no link is lost.
5. Pairs are verified exactly on their sets; verified links are contracted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricefold.llm.components import connected_components
from pricefold.llm.shared import scratch, stage, tidy
from pricefold.llm.tokens import NON_SPACE, Chunk, chunks, combine, lists, windows

#: Counters of the frequency estimate: 2**22, in blocks of 2**16 (fixed size: 4 MB once they are classes).
SKETCH_BITS, BLOCK_BITS = 22, 16
#: Candidate prefix extensions, and the cost of reading a posting and of verifying one shingle of a pair.
EXTENSIONS = np.array([1, 2, 3, 4, 6, 8])
POSTING_COST, VERIFY_COST = 1.0, 0.05
FILTER_BITS = 24
#: A class in postings and pairs: 56 bits of its 128-bit key.  Links are made between whole keys.
ID = "cast(conv(hex(substring(key, 1, 7)), 16, 10) as bigint)"


def _sets(chunk: Chunk, width: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingles."""
    s, e, first = chunk.spans(NON_SPACE)
    words = chunk.hashes(s, e)
    shingles, at = windows(words, first, width)
    bound = np.searchsorted(at, first)
    for i in range(len(chunk)):
        n = first[i + 1] - first[i]
        if n >= width:
            yield np.unique(shingles[bound[i] : bound[i + 1]])
        elif n:
            h = words[first[i] : first[i] + 1]
            for k in range(1, n):
                h = combine(h, words[first[i] + k : first[i] + k + 1])
            yield h
        else:
            yield words[:0]


def _key(u: np.ndarray) -> bytes | None:
    return hashlib.blake2b(u.tobytes(), digest_size=16).digest() if len(u) else None


PROFILE = "n int, key binary, text_hash long, block int, counts binary"


def _profile(width: int):
    def run(batches):
        counts, id_type = np.zeros(1 << SKETCH_BITS, np.uint32), None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for c in chunks(batch.column("text"), fold=True):
                n, key, seen = [], [], []
                for u in _sets(c, width):
                    n.append(len(u))
                    key.append(_key(u))
                    seen.append(u)
                all_seen = np.concatenate(seen) >> np.uint64(64 - SKETCH_BITS)
                np.add.at(counts, all_seen.astype(np.int64), 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(c.start, len(c)), pa.array(n, pa.int32()), pa.array(key, pa.binary()),
                     batch.column("text_hash").slice(c.start, len(c)), pa.nulls(len(c), pa.int32()),
                     pa.nulls(len(c), pa.binary())], ["doc_id", "n", "key", "text_hash", "block", "counts"])
        blocks = counts.reshape(-1, 1 << BLOCK_BITS)
        for b in range(len(blocks)):
            if blocks[b].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, id_type), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
                     pa.array([b], pa.int32()), pa.array([blocks[b].tobytes()], pa.binary())],
                    ["doc_id", "n", "key", "text_hash", "block", "counts"])

    return tidy(run)


@tidy
def _add_blocks(batches):
    """Counters of one block per row -> their sums, one row per block seen."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, raw in zip(batch.column("block").to_pylist(), batch.column("counts")):
            counts = np.frombuffer(raw.as_buffer(), np.uint32).astype(np.uint64)
            total[b] = total[b] + counts if b in total else counts
    if total:
        classes = [np.round(4 * np.log2(1 + v.astype(np.float64))).astype(np.uint8).tobytes() for v in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(classes, pa.binary()),
                                          pa.array([int(v.sum()) for v in total.values()], pa.int64())],
                                         ["block", "classes", "total"])


def _frequency_classes(profile: DataFrame) -> tuple[np.ndarray, float]:
    """Class of each counter (4 * log2(1 + count)) and the mean count.  Fixed
    size whatever the corpus, so the driver may hold it."""
    blocks = 1 << (SKETCH_BITS - BLOCK_BITS)
    rows = (profile.where("block is not null").select("block", "counts").repartition(blocks, "block")
            .mapInArrow(_add_blocks, "block int, classes binary, total long").collect())
    classes = np.zeros((blocks, 1 << BLOCK_BITS), np.uint8)
    for r in rows:
        classes[r["block"]] = np.frombuffer(r["classes"], np.uint8)
    return classes.reshape(-1), sum(r["total"] for r in rows) / classes.size


def prefix(u: np.ndarray, classes: np.ndarray, mean: float, num: int, den: int) -> tuple[int, np.ndarray]:
    """A set's chosen extension l and its prefix in the global order."""
    n = len(u)
    least = -(-num * n // den)  # overlap that any partner shares at least
    cls = classes[u >> np.uint64(64 - SKETCH_BITS)]
    order = np.argsort(cls, kind="stable")  # ties by hash: u is sorted
    ext = EXTENSIONS[EXTENSIONS <= max(least, 1)]
    longest = n - least + int(ext[-1])
    order = order[:longest]
    # what a list holds beyond the counter's usual load
    load = np.maximum(np.exp2(cls[order] / 4.0) - 1 - 1.5 * mean, 0.0)
    run = np.cumsum(load)
    size = np.minimum(n - least + ext, n)
    postings = run[size - 1]
    cost = size + POSTING_COST * postings + VERIFY_COST * n * postings / ext
    pick = int(np.argmin(cost))
    return int(ext[pick]), u[order[: size[pick]]]


def _prefixes(width: int, num: int, den: int, classes, mean: float):
    def run(batches):
        table = classes.value
        for batch in batches:
            for c in chunks(batch.column("text"), fold=True):
                key, n, ell, toks = [], [], [], []
                for u in _sets(c, width):
                    if len(u):
                        pick, p = prefix(u, table, mean, num, den)
                        key.append(_key(u))
                        n.append(len(u))
                        ell.append(pick)
                        toks.append(p)
                if key:
                    first = np.cumsum([0, *map(len, toks)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, pa.binary()), pa.array(n, pa.int32()), pa.array(ell, pa.int32()),
                         lists(np.concatenate(toks).view(np.int64), first, pa.int64())], ["key", "n", "ell", "tokens"])

    return tidy(run)


def _wanted(ids: DataFrame) -> np.ndarray:
    """Fixed-size bit filter over the leading bits of class ids (2 MB)."""
    lead = F.shiftright("id", 56 - FILTER_BITS).cast("int")
    rows = (ids.select(F.shiftright(lead, 6).alias("w"), lead.alias("lead")).groupBy("w")
            .agg(F.bit_or(F.expr("shiftleft(1L, lead & 63)")).alias("bits")).collect())
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in rows:
        bits[r["w"]] = r["bits"]
    return bits.view(np.uint64)


def _full_sets(width: int, bits):
    def run(batches):
        table = bits.value
        for batch in batches:
            for c in chunks(batch.column("text"), fold=True):
                ids, key, sets = [], [], []
                for u in _sets(c, width):
                    k = _key(u)
                    if k is not None:
                        lead = int.from_bytes(k[:3], "big")
                        if int(table[lead >> 6]) >> (lead & 63) & 1:
                            ids.append(int.from_bytes(k[:7], "big"))
                            key.append(k)
                            sets.append(u)
                if key:
                    first = np.cumsum([0, *map(len, sets)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(key, pa.binary()),
                         lists(np.concatenate(sets).view(np.int64), first, pa.int64())], ["id", "key", "tokens"])

    return tidy(run)


class ShingleJoin:
    """The join over one table; see ``shingle_components``."""

    def __init__(self, docs: DataFrame, num: int, den: int, width: int, text: str, doc_id: str):
        self.spark, self.num, self.den, self.width = docs.sparkSession, num, den, width
        self.folder = scratch(self.spark, "jaccard")
        self.texts = docs.select(F.col(text).cast("string").alias("text"))
        self.rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
                                F.xxhash64(F.col(text).cast("string")).alias("text_hash"))

    def _fits(self, a: str, b: str, ell: str = "1") -> str:
        """Sizes and positions under which a shared shingle counts for a pair."""
        num, den = self.num, self.den
        need = f"(({num}L * ({a}.n + {b}.n) + {num + den - 1}) div {num + den})"
        return (f"{den}L * least({a}.n, {b}.n) >= {num}L * greatest({a}.n, {b}.n) "
                f"and {a}.pos < {a}.n - {need} + {ell} and {b}.pos < {b}.n - {need} + {ell}")

    def _proposed(self, joined: DataFrame, post: DataFrame, name: str) -> DataFrame:
        """Distinct pairs (a, b) of a join of postings x and y that share as
        many prefix shingles as the smaller l of the two asks for."""
        pairs = stage(joined.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"),
                                    F.least("x.ell", "y.ell").alias("l")).distinct(), self.folder, f"proposed_{name}")
        more = (pairs.where("l > 1").alias("p").join(post.alias("x"), F.expr("p.a = x.id"))
                .join(post.alias("y"), F.expr("p.b = y.id and x.token = y.token"))
                .where(self._fits("x", "y", "p.l")).groupBy("a", "b", "l").agg(F.count(F.lit(1)).alias("c")).where("c >= l"))
        return pairs.where("l = 1").select("a", "b").union(more.select("a", "b"))

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b) with their keys and whether they link, decided on their
        whole sets."""
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        bits = self.spark.sparkContext.broadcast(_wanted(ids))
        sets = (self.texts.mapInArrow(_full_sets(self.width, bits), "id long, key binary, tokens array<bigint>")
                .join(ids, "id", "left_semi").groupBy("id", "key").agg(F.first("tokens").alias("tokens")))
        a = sets.select(F.col("id").alias("a"), F.col("key").alias("ka"), F.col("tokens").alias("ta"))
        b = sets.select(F.col("id").alias("b"), F.col("key").alias("kb"), F.col("tokens").alias("tb"))
        both = F.size(F.array_intersect("ta", "tb"))
        either = F.size("ta") + F.size("tb") - both
        return stage(pairs.select("a", "b").join(a, "a").join(b, "b")
                     .select("a", "b", "ka", "kb", (self.den * both.cast("long") >= self.num * either.cast("long")).alias("linked")),
                     self.folder, f"verified_{name}")

    def _postings(self, profile: DataFrame) -> DataFrame:
        """Prefix shingles that several classes have: (id, n, ell, pos, token)."""
        classes, mean = _frequency_classes(profile)
        held = self.spark.sparkContext.broadcast(classes)
        heads = self.texts.mapInArrow(_prefixes(self.width, self.num, self.den, held, mean),
                                      "key binary, n int, ell int, tokens array<bigint>").dropDuplicates(["key"])
        post = heads.select(F.expr(ID).alias("id"), "n", "ell", F.posexplode("tokens").alias("pos", "token"))
        shared = F.count(F.lit(1)).over(W.partitionBy("token"))
        return stage(post.withColumn("df", shared).where("df > 1").drop("df"), self.folder, "postings")

    def components(self) -> tuple[DataFrame, DataFrame]:
        """Rows (doc_id, n, key, text_hash) and the root of each linked class."""
        kind = self.rows.schema["doc_id"].dataType.simpleString()
        profile = stage(self.rows.mapInArrow(_profile(self.width), f"doc_id {kind}, {PROFILE}"), self.folder, "profile")
        rows = profile.where("block is null").select("doc_id", "n", "key", "text_hash")
        post = self._postings(profile)

        anchor = post.groupBy("token").agg(F.min(F.struct("pos", "n", "id", "ell")).alias("t")).select("token", "t.*")
        star = stage(self._proposed(post.alias("x").join(anchor.alias("y"), "token").where("x.id <> y.id and " + self._fits("x", "y")),
                                    post, "star"), self.folder, "star")
        if star.isEmpty():
            return rows, None
        tried = self._verified(star, "star")
        links = tried.where("linked").select(F.col("ka").alias("a"), F.col("kb").alias("b"))
        roots = connected_components(links, f"{self.folder}/round1")

        of = roots.select(F.expr(ID.replace("key", "node")).alias("id"), F.expr(ID.replace("key", "root")).alias("comp"))
        comp = post.join(of, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        parts = comp.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
        main = (parts.groupBy("token").agg(F.max(F.struct("c", "comp")).alias("m"), F.count(F.lit(1)).alias("k"))
                .where("k > 1").select("token", F.col("m.comp").alias("main")))
        open_lists = stage(comp.join(main, "token"), self.folder, "open")
        rest = (open_lists.where("comp <> main").alias("x").join(open_lists.alias("y"), "token")
                .where("x.comp <> y.comp and (y.comp = y.main or x.id < y.id) and " + self._fits("x", "y")))
        rest = stage(self._proposed(rest, post, "rest").join(tried, ["a", "b"], "left_anti"), self.folder, "rest")
        if not rest.isEmpty():
            late = self._verified(rest, "rest").where("linked").select(F.col("ka").alias("a"), F.col("kb").alias("b"))
            for c in ("a", "b"):  # links between the components of round one
                late = (late.join(roots.select(F.col("node").alias(c), "root"), c, "left")
                        .withColumn(c, F.coalesce("root", c)).drop("root"))
            joined = connected_components(late, f"{self.folder}/round2").withColumnRenamed("root", "top")
            old = roots.join(joined.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
            new = joined.join(roots, "node", "left_anti").select("node", F.col("top").alias("root"))
            roots = stage(old.union(new), self.folder, "roots")
        return rows, roots


def _components(docs, num, den, width, text, doc_id):
    """Rows with their class key and root; ``classes`` has one row per class."""
    job = ShingleJoin(docs, num, den, width, text, doc_id)
    rows, roots = job.components()
    classes = rows.where("key is not null").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
    if roots is None:
        classes = classes.withColumn("root", F.col("key"))
    else:
        classes = (classes.join(roots.withColumnRenamed("node", "key"), "key", "left")
                   .withColumn("root", F.coalesce("root", "key")))
    classes = stage(classes, job.folder, "classes")
    top = classes.groupBy("root").agg(F.min("first").alias("top"))
    return job, rows, stage(classes.join(top, "root").select("key", "root", "top"), job.folder, "tops")


def shingle_components(docs: DataFrame, num: int = 8, den: int = 10, width: int = 5, text: str = "text",
                       doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``.

    Texts (A-Z lower-cased, words split at ASCII white space) link when their
    sets of distinct ``width``-word shingles have a Jaccard similarity of at
    least ``num/den``.  A text of fewer words is one shingle of them all.
    ``component_id`` is the smallest doc_id reachable by links (ids of any
    ordered type).

    - null or wordless text: 0 shingles, its own component;
    - null doc_id: the row still links its neighbours; its component_id is the
      smallest non-null one, else null;
    - repeated rows and rows that repeat a doc_id are rows of their own;
    - empty table: empty result;  other columns of ``docs`` are not looked at.
    """
    _, rows, tops = _components(docs, num, den, width, text, doc_id)
    return (rows.join(tops.select("key", F.col("top.doc_id").alias("component_id")), "key", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, num: int = 8, den: int = 10, width: int = 5, text: str = "text",
             doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id
    (null last; ids of any ordered type).  Wordless rows all stay.  Rows that
    repeat both doc_id and text of the row that stays are dropped but one.  Other
    columns may have any name; an empty table gives no rows."""
    job, rows, tops = _components(docs, num, den, width, text, doc_id)
    gone = (rows.where("key is not null").join(tops.select("key", "top"), "key")
            .groupBy("doc_id", "text_hash").agg(
                F.max((F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("text_hash") == F.col("top.text_hash")))
                      .cast("int")).alias("stays"), F.count(F.lit(1)).alias("copies"))
            .where("stays = 0 or copies > 1"))
    gone = stage(gone, job.folder, "gone").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__th"),
                                                  "stays", "copies").alias("g")
    cols = [F.col(f"d.`{c}`") for c in docs.columns]
    marked = docs.alias("d").join(gone, F.col(f"d.`{doc_id}`").eqNullSafe(F.col("g.__id"))
                                  & (F.xxhash64(F.col(f"d.`{text}`").cast("string")) == F.col("g.__th")), "left")
    out = marked.where("g.stays is null").select(*cols)
    if gone.where("stays = 1").isEmpty():
        return out
    again = marked.where("g.stays = 1").select(*cols)
    return out.unionByName(again.dropDuplicates([doc_id, text]))
