"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op6_jaccard_join")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm.jaccard import shingle_components
    return shingle_components(table(spark, sf, "documents"), num=90, den=100, width=3)


_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@register("op3_decontamination", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS.format(_LOW.format("coalesce(text, '')"))} AS w FROM documents),
b AS (SELECT row_number() OVER () AS b, CAST(item_id AS VARCHAR) AS item_id, {_ITEM_WORDS.format(_LOW.format("coalesce(text, '')"))} AS w
      FROM benchmark),
win AS (SELECT b, item_id, n, i AS a, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT b, item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS MATERIALIZED (SELECT r, i, n, b, a, item_id FROM dw JOIN win USING (n, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM occ)) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
       FROM (SELECT DISTINCT r, item_id AS x FROM occ WHERE item_id IS NOT NULL) GROUP BY r),
run AS (SELECT r, any_value(item_id) AS item_id, min(a) - 1 AS iw, min(i) - 1 AS dw, count(*) + any_value(n) - 1 AS len
        FROM (SELECT *, i - row_number() OVER (PARTITION BY r, b, i - a ORDER BY i) AS island FROM occ) GROUP BY r, b, i - a, island),
top AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY len DESC, item_id NULLS LAST, iw, dw) = 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(top.len, 0) AS longest_words,
       top.item_id AS longest_item, top.iw AS longest_item_word, top.dw AS longest_doc_word
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r) LEFT JOIN top USING (r)""")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm.suffix import contamination
    found = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), width=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                        "longest_words", "longest_item", "longest_item_word", "longest_doc_word")


def _remainder(column: str, divisor: int):
    """crc32 of an id as text, modulo ``divisor`` (a null id: as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


@register("op1_kneser_ney")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm import ngram
    docs = table(spark, sf, "documents").withColumn("held_out", _remainder("doc_id", 7) == 2)
    model = ngram.train(docs.where(~F.col("held_out")), order=3)
    return ngram.score(docs, model, keep=["doc_id", "held_out"])


@register("op8_quality_rules")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm.rules import quality_verdicts
    found = quality_verdicts(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _secret_oracle() -> str:
    from pricefold.llm.secrets import RULES
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    parts = " UNION ALL ".join(
        f"SELECT r, {i} AS k, {quoted(x.kind)} AS kind, {x.least} AS least, string_split_regex(t, {quoted(x.portable)}) AS p, "
        f"regexp_extract_all(t, {quoted(x.portable)}, 0) AS m, regexp_extract_all(t, {quoted(x.portable)}, {x.group}) AS g "
        f"FROM d WHERE regexp_matches(t, {quoted(x.portable)})" for i, x in enumerate(RULES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({parts}),
e AS (SELECT r, k, kind, least, p, m, g, unnest(range(1, len(m) + 1)) AS i FROM m),
s AS (SELECT r, k, kind, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a,
             length(m[i]) AS n FROM e WHERE length(g[i]) >= least),
t AS (SELECT r, k, kind, concat(kind, ':', CAST(a AS BIGINT), ':', CAST(a + n AS BIGINT)) AS span, CAST(a AS BIGINT) AS a FROM s),
f AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY a, k) FILTER (k < 3) AS base,
             string_agg(span, ',' ORDER BY a, k) AS spans FROM t GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN f USING (r)"""


@register("op9_secret_scan", _secret_oracle())
def op9(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm.secrets import find_secrets, span_list
    found = find_secrets(table(spark, sf, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = ["assign", "access", "hex"]
    return found.select("doc_id", *map(of, base), F.sha2(span_list(F.col("spans"), base), 256).alias("base_sha256"),
                        span_list(F.col("spans")).alias("spans"))


@register("op7_quality_classifier")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm import classifier
    docs = table(spark, sf, "documents").withColumn("held_out", _remainder("doc_id", 5) == 0)
    labels = table(spark, sf, "labels").where(_remainder("doc_id", 5) != 0)
    model = classifier.fit(docs.where(~F.col("held_out")), labels)
    return (classifier.score(docs, model, keep=["doc_id", "held_out"])
            .withColumn("predicted", (F.col("score") >= classifier.THRESHOLD).cast("int")))


_BASE32 = "||".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {i}, 5))::INTEGER >> {s}) & 31) + 1, 1)"
                    for i in range(1, 41, 5) for s in (15, 10, 5, 0))


@register("op2_warc_captures", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS m FROM p)
SELECT page_id, CAST(strlen(x) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = m THEN NULL ELSE m END AS refers_to FROM q""")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm import warc
    files = warc.write_warc(table(spark, sf, "pages"), min_bytes=0)
    found = warc.captures(warc.read_warc(files, payloads=False))
    return found.select(warc.metadata_field("page-id").alias("page_id"), F.col("response.payload_bytes"),
                        F.col("response.payload_digest"), F.col("response.warc_type").alias("record_type"),
                        warc.metadata_field("refers-to-page").alias("refers_to"))


@register("op10_token_counts")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm.shared import public_model
    from pricefold.llm.viterbi import token_counts
    return token_counts(table(spark, sf, "documents"), public_model())


@register("op4_piece_sampling")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm import sample
    from pricefold.llm.shared import public_model
    rows = sample.encode(table(spark, sf, "documents").select("doc_id", "text"), public_model(), lossless="lossless")
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "lossless")


def _license_oracle() -> str:
    from pricefold.llm.licenses import _LOWER, _OTHER, _UPPER, TEMPLATES, THRESHOLD, bigrams, cuts
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    # translate() maps each character; other ASCII characters become spaces
    low = f"translate(coalesce(text, ''), {quoted(_UPPER + _OTHER)}, {quoted(_LOWER + ' ' * len(_OTHER))})"
    held = ", ".join(f"({quoted(n)}, [{', '.join(map(quoted, bigrams(b)))}])" for n, b in TEMPLATES)
    placed = ", ".join(f"({quoted(w)}, {o}, {n})" for w, o, n in cuts(TEMPLATES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {low} AS x FROM documents),
u AS (SELECT r, unnest(string_split(x, chr(10))) AS u FROM d UNION SELECT r, unnest(string_split_regex(x, '\\n *\\n')) FROM d
      UNION SELECT r, x FROM d),
a AS (SELECT * FROM (VALUES {placed}) AS t(word, before, size)),
f0 AS MATERIALIZED (SELECT r, list_filter(string_split(replace(x, chr(10), ' '), ' '), lambda y: y <> '') AS w FROM d),
p AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM f0),
s AS (SELECT r, i, greatest(i - 1 - before, 0) + 1 AS a, size FROM p JOIN a USING (word)),
w AS (SELECT r, -row_number() OVER () AS k, list_filter(string_split(replace(u, chr(10), ' '), ' '), lambda y: y <> '') AS w FROM u
      UNION ALL SELECT r, i, w[s.a:s.a + size - 1] FROM s JOIN f0 USING (r)),
b AS (SELECT r, k, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM w WHERE len(w) > 1),
t AS (SELECT * FROM (VALUES {held}) AS t(name, g)),
m AS (SELECT k, r, name, len(g) AS n, 2.0::DOUBLE * len(list_intersect(b, g)) / (len(b) + len(g)) AS dice FROM b, t
      WHERE len(b) BETWEEN 0.5 * len(g) AND 2 * len(g) AND list_has_any(b, g)),
o AS (SELECT * FROM m WHERE dice >= {THRESHOLD} QUALIFY dice = max(dice) OVER (PARTITION BY r, k)),
f AS (SELECT r, max(dice) AS dice, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM o GROUP BY r),
n AS (SELECT r, name AS license FROM o JOIN f USING (r, dice) QUALIFY row_number() OVER (PARTITION BY r ORDER BY n DESC, name) = 1)
SELECT doc_id, license, dice, coalesce(licenses, '') AS licenses FROM d LEFT JOIN f USING (r) LEFT JOIN n USING (r)"""


@register("op5_license_scan", _license_oracle())
def op5(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm.licenses import find_licenses
    return find_licenses(table(spark, sf, "documents"))


@register("op11_fingerprints")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm import fingerprints as fp
    found = fp.neighbours(table(spark, sf, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", fp.as_text("fingerprint").alias("fingerprint"),
                        fp.as_text("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next")


# unsigned crc32 of a decimal number's digits, bit by bit
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
          "lambda a, x: list_reduce(list_prepend(xor(a, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
          "lambda b, z: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384::BIGINT) ELSE b >> 1 END)), 4294967295::BIGINT)")


@register("op12_conversation_trie", f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
             coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 100 AS b, {_CRC32.format('CAST(c AS VARCHAR)')} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
s AS (SELECT t.c, p, r, x FROM t JOIN h USING (c) WHERE p > h UNION ALL SELECT h.c, p, r, x FROM h JOIN t ON t.c = h.b AND p <= h),
k AS (SELECT c, row_number() OVER w AS d, length(x) AS n,
             string_agg(sha256(concat(length(r), ':', r, x)), '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g
      FROM s WINDOW w AS (PARTITION BY c ORDER BY p)),
e AS MATERIALIZED (SELECT c, d, n, sha256(g) AS g FROM k UNION ALL SELECT c, 0, 0, '' FROM h),
m AS (SELECT c, max(d) AS d FROM e GROUP BY c),
v AS (SELECT g, min(c) AS c, min(d) AS d, count(*) AS n_convs, min(n) AS n FROM e GROUP BY g),
q AS (SELECT v.g, e.g AS pg FROM v JOIN e ON e.c = v.c AND e.d = v.d - 1),
kid AS (SELECT pg AS g, count(*) AS n_children FROM q GROUP BY pg),
sub AS (SELECT a.g, count(*) FILTER (kid.g IS NULL) AS n_leaves, sum((v.n_convs - 1) * v.n) AS saved
        FROM v LEFT JOIN kid USING (g) JOIN e a ON a.c = v.c AND a.d <= v.d GROUP BY a.g),
fin AS (SELECT g, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends FROM e JOIN m USING (c, d) GROUP BY g)
SELECT v.c AS conv_id, v.d AS depth, pv.c AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM v JOIN sub USING (g) LEFT JOIN kid USING (g) LEFT JOIN fin USING (g) LEFT JOIN q USING (g) LEFT JOIN v pv ON pv.g = q.pg""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm.trie import conversation_trie
    return conversation_trie(table(spark, sf, "conversations"))


def _cluster_oracle(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Every round spelt out: squared distances, floored means, empty centroids kept."""
    x = "CAST(x AS DOUBLE)"
    parts = [f"""
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * {x}) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite({x}))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS j, v AS c FROM v ORDER BY j LIMIT {k})"""]
    near = """SELECT r, j, f FROM (SELECT r, j, list_sum(list_transform(range(1, {0} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS f
  FROM v, c{1}) QUALIFY row_number() OVER (PARTITION BY r ORDER BY f, j) = 1"""
    for n in range(rounds):
        parts.append(f"""
a{n} AS MATERIALIZED ({near.format(dims, n)}),
c{n + 1} AS MATERIALIZED (SELECT j, coalesce(m, c) AS c FROM c{n} LEFT JOIN (
  SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM (
    SELECT j, i, sum(v[i]) AS s, count(*) AS n FROM (SELECT j, v, unnest(range(1, {dims + 1})) AS i FROM a{n} JOIN v USING (r)) GROUP BY j, i)
  GROUP BY j) USING (j))""")
    return "WITH" + ",".join(parts) + f""",
f AS MATERIALIZED ({near.format(dims, rounds)})
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(f AS BIGINT) AS distance, CAST(sum(f) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
       CAST(sum(f) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM f JOIN v USING (r) JOIN c{rounds} USING (j)"""


@register("op13_centroid_clustering", _cluster_oracle())
def op13(spark: SparkSession, sf: str) -> DataFrame:
    from pricefold.llm import centroids
    found = centroids.cluster(table(spark, sf, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        centroids.centroid_hash().alias("centroid_sha256"))
