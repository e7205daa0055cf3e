"""Operator 9: secret scans through a trigram inverted index (native).

Every rule is a regular expression.  The driver derives from it the trigrams
that a match must hold (``trigrams``).  Spark then

1. indexes the texts: one posting (trigram, doc_id) for each trigram of any
   rule that occurs in a lower-cased text;
2. intersects the postings of each doc_id by the rules' Boolean queries, which
   leaves a few candidates per rule;
3. runs a rule on its candidates only; rules without mandatory trigrams run
   on every text;
4. places the matches: what a pattern splits a text into and what it matches
   alternate, so running sums of their lengths are the spans.

All of it is DataFrame functions; there is no Python on the executors.  Spans
are code points, end exclusive.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricefold.llm.shared import fresh, scratch, stage
from pricefold.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters; others
    are dropped after matching.  ``strict`` is the pattern with that length in
    it, where the two differ.  ``early``: replaced before the other rules, which
    could otherwise replace a part of a match and hide the rest."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    strict: str | None = None
    early: bool = False


    @property
    def portable(self) -> str:
        """The pattern without possessive marks, for engines that have none: a
        loop marked so stops where nothing of it could be given back."""
        return re.sub(r"\)([*+])\+", r")\1", self.pattern)


_B64 = "A-Za-z0-9+/="
_KEY = r"[A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
# From BEGIN through END, whatever lies between but another such line; without
# END through the armor headers and the base64 lines that follow, indented ones
# too, or with written-out line ends.  Loops over groups are possessive: Java
# runs those without recursion, however long the key is.
_PRIVATE_KEY = (
    rf"-----BEGIN {_KEY}(?:[^-]*(?:-{{1,4}}[^-]+)*+-----END {_KEY}"
    rf"|(?:[ \t]*\r?\n[ \t]*[A-Za-z][A-Za-z0-9-]*:[^\r\n]*)*+[ \t\r\n]+[{_B64}]{{16,}}"
    rf"(?:[{_B64}\r\n]*[{_B64}](?:\r?\n|$)|(?:[ \t]*\r?\n[ \t]+[{_B64}]+)++)?"
    rf"|(?:\\[rn])+[{_B64}\\]*)?")

# The base rules in their listed order, then further secret
# formats.  A run such as [0-9a-f]+ of 32 or more is written [0-9a-f]{32,}:
# runs are maximal, so the matches that count are the same.
RULES = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
         r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{8,})"""),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abps]-[A-Za-z0-9-]{15,}"),
    Rule("payment", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("private_key", _PRIVATE_KEY, early=True),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{16,}"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class _Scan:
    """One scan of a table by a list of rules."""

    def __init__(self, docs: DataFrame, rules: list[Rule], text: str, doc_id: str):
        self.rules, self.queries = rules, [trigram_query(r.pattern) for r in rules]
        self.folder = scratch(docs.sparkSession, "secrets")
        self.docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        self.trigrams = sorted({t for q in self.queries for clause in q for alt in clause for t in alt})

    def postings(self) -> DataFrame:
        """The index: (trigram number, doc_id), once per text that holds it."""
        low = F.translate("text", _UPPER, _LOWER)
        found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(self.trigrams))))
        return self.docs.select("doc_id", low.alias("low")).select("doc_id", F.explode(found).alias("trigram"))

    def candidates(self) -> DataFrame:
        """(doc_id, rules): the rules whose queries a doc_id's postings meet."""
        number = {t: i for i, t in enumerate(self.trigrams)}
        has = lambda t: F.array_contains("got", number[t])
        every = lambda parts: reduce(lambda a, b: a & b, parts)
        some = lambda parts: reduce(lambda a, b: a | b, parts)
        meets = [F.when(every(some(every(map(has, sorted(alt))) for alt in clause) for clause in q), F.lit(i))
                 for i, q in enumerate(self.queries) if q]
        lists = self.postings().groupBy("doc_id").agg(F.collect_set("trigram").alias("got"))  # at most all trigrams
        return (lists.select("doc_id", F.array_compact(F.array(*meets)).alias("rules")).where(F.size("rules") > 0))

    def chosen(self, docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
        """``docs`` as d, each row with its candidate rules as c.rules."""
        c = stage(self.candidates(), self.folder, "candidates").alias("c")
        return docs.alias("d").join(c, F.col(f"d.`{doc_id}`").eqNullSafe(F.col("c.doc_id")), "left")

    def runs(self, i: int) -> Column:
        """Whether rule i is to be run on a row of ``chosen``."""
        if not self.queries[i]:
            return F.lit(True)
        return F.coalesce(F.array_contains("c.rules", i), F.lit(False))

    def spans(self) -> DataFrame:
        """(doc_id, text_hash, rank, kind, start, end) of all matches that count."""
        def tried(i: int, r: Rule) -> Column:
            text = F.col("d.text")
            pattern = F.lit(r.pattern)
            return F.when(self.runs(i) & text.rlike(r.strict or r.pattern), F.struct(
                F.lit(i).alias("rank"), F.split(text, r.pattern, -1).alias("between"),
                F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
                F.regexp_extract_all(text, pattern, F.lit(r.group)).alias("part")))

        found = (self.chosen(self.docs).select("d.doc_id", F.xxhash64("d.text").alias("text_hash"), F.explode(
            F.array_compact(F.array(*(tried(i, r) for i, r in enumerate(self.rules))))).alias("m"))
            .select("doc_id", "text_hash", "m.*"))
        # repeated rows hold the same matches
        once = found.dropDuplicates(["doc_id", "text_hash", "rank"])
        each = once.select("doc_id", "text_hash", "rank", F.posexplode(F.arrays_zip(
            F.transform("between", F.length).alias("gap"), F.transform("whole", F.length).alias("length"),
            F.transform("part", F.length).alias("size"))).alias("k", "x")).select("doc_id", "text_hash", "rank", "k", "x.*")
        run = W.partitionBy("doc_id", "text_hash", "rank").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
        end = F.sum("gap").over(run) + F.sum(F.coalesce("length", F.lit(0))).over(run)
        kinds = F.array(*(F.lit(r.kind) for r in self.rules))
        least = F.array(*(F.lit(r.least) for r in self.rules))
        return (each.withColumn("end", end).where("length is not null")
                .where(F.col("size") >= F.element_at(least, F.col("rank") + 1))
                .select("doc_id", "text_hash", "rank", F.element_at(kinds, F.col("rank") + 1).alias("kind"),
                        (F.col("end") - F.col("length")).alias("start"), "end"))


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, spans)`` for every row: an array of (start, rank, kind, end)
    by start, then by the rules' order; empty without matches.

    Matches are leftmost and non-overlapping per kind; kinds may overlap.  Null
    texts are empty.  Rows that share a doc_id share its postings, but are
    matched each on its own text; null doc_ids are handled as one id; empty
    tables give no rows; other columns are not looked at.
    """
    scan = _Scan(docs, rules, text, doc_id)
    per_text = stage(scan.spans(), scan.folder, "spans").groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))  # one text's matches
    rows = scan.docs.select("doc_id", F.xxhash64("text").alias("text_hash")).alias("d")
    both = rows.join(per_text.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
                     & (F.col("d.text_hash") == F.col("s.text_hash")), "left")
    kind = per_text.schema["spans"].dataType.simpleString()
    return both.select("d.doc_id", F.coalesce("s.spans", F.array().cast(kind)).alias("spans"))


def redact(docs: DataFrame, rules: list[Rule] = RULES, mark: str = "[SECRET]", text: str = "text", doc_id: str = "doc_id",
           n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``, all columns as they are;
    ``n_chars``, where there is such a column, follows a changed text.  Rules
    are applied in order, early ones first, each only to its candidates.

    Null and empty texts stay as they are, null doc_ids count as one id,
    repeated rows are changed alike, other columns may have any name, an empty
    table gives no rows, and texts are taken whole, however long."""
    scan = _Scan(docs, rules, text, doc_id)
    chosen = scan.chosen(docs, doc_id)
    new = F.col(f"d.`{text}`")
    for i, r in sorted(enumerate(rules), key=lambda x: not x[1].early):
        new = F.when(scan.runs(i), F.regexp_replace(new, r.strict or r.pattern, mark)).otherwise(new)
    names = docs.columns
    changed = fresh(names, "new")
    rows = chosen.select(*(F.col(f"d.`{c}`") for c in names), new.alias(changed))
    out = []
    for c in names:
        if c == text:
            out.append(F.col(changed).alias(c))
        elif c == n_chars:
            differs = ~F.col(changed).eqNullSafe(F.col(f"`{text}`"))
            out.append(F.when(differs, F.length(changed).cast(docs.schema[c].dataType)).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return rows.select(*out)


def span_list(spans: Column, kinds: list[str] | None = None) -> Column:
    """``kind:start:end`` comma-joined, of all spans or of some kinds."""
    kept = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
