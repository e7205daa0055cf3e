"""Boolean trigram queries of regular expressions.

``trigram_query`` names trigrams that any match of a pattern must hold.  It is
a list of clauses that all must hold; a clause is a list of alternatives, of
which one must; an alternative is a set of trigrams that all must occur in the
lower-cased text.  An empty list means that nothing is mandatory and the
pattern has to be run on every text.
"""

from __future__ import annotations

from re import _constants as C
from re import _parser as P

MOST = 64  # strings followed exactly before their trigrams are taken


def _chars(items) -> list[str] | None:
    """Characters of a class, lower-cased; None for many or a negated one."""
    out: set[str] = set()
    for op, v in items:
        if op is C.LITERAL:
            out.add(chr(v).lower())
        elif op is C.RANGE and v[1] - v[0] < 4:
            out.update(chr(x).lower() for x in range(v[0], v[1] + 1))
        else:
            return None
    return sorted(out)


def _exact(op, v) -> list[str] | None:
    """All strings that a node can match, or None."""
    if op is C.LITERAL:
        return [chr(v).lower()]
    if op is C.IN:
        return _chars(v)
    if op is C.SUBPATTERN:
        return _sequence_exact(v[-1])
    if op is C.BRANCH:
        parts = [_sequence_exact(x) for x in v[1]]
        return None if None in parts else sorted({s for p in parts for s in p})
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and v[1] <= 2:
        one = _sequence_exact(v[2])
        if one is None:
            return None
        out, run = set() if v[0] else {""}, [""]
        for k in range(1, v[1] + 1):
            run = [a + b for a in run for b in one]
            if k >= v[0]:
                out.update(run)
        return sorted(out)
    if op is C.AT:
        return [""]
    return None


def _sequence_exact(seq) -> list[str] | None:
    run = [""]
    for op, v in seq:
        part = _exact(op, v)
        if part is None or len(run) * len(part) > MOST:
            return None
        run = [a + b for a in run for b in part]
    return run


def _clause(strings: list[str]) -> list[frozenset]:
    """One alternative per string; none if a string has no trigram."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return []
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)


def _clauses(seq) -> list[list[frozenset]]:
    found, run = [], [""]

    def close():
        if any(run) and (c := _clause(run)):
            found.append(c)

    for op, v in seq:
        part = _exact(op, v)
        if part is not None and len(run) * len(part) <= MOST:
            run = [a + b for a in run for b in part]
            continue
        close()
        run = part if part is not None and len(part) <= MOST else [""]
        if part is None:
            if op is C.SUBPATTERN:
                found += _clauses(v[-1])
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and v[0] > 0:
                found += _clauses(v[2])
    close()
    return found


def trigram_query(pattern: str) -> list[list[frozenset]]:
    return _clauses(P.parse(pattern))


def holds(query: list[list[frozenset]], text: str) -> bool:
    """Whether a lower-cased text satisfies a query."""
    return all(any(all(t in text for t in alt) for alt in clause) for clause in query)
