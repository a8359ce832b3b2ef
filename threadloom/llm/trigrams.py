"""Which trigrams a text must hold for a regular expression to match in it."""

from __future__ import annotations

import itertools
from re import _constants as kinds
from re import _parser

#: Sets of strings beyond this size are not followed further; the query then asks for less.
MOST_STRINGS = 48
MOST_CLASS = 4

Query = list[frozenset[str]] | None


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _class(items) -> set[str] | None:
    chars: set[str] = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            chars.add(chr(value).lower())
        elif kind is kinds.RANGE and value[1] - value[0] < 2 * MOST_CLASS:
            chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return chars if len(chars) <= MOST_CLASS else None


def _item(kind, value) -> tuple[set[str] | None, list[set[str]]]:
    """All strings an item can match, if few, and else clauses: of each, one string must occur."""
    if kind is kinds.LITERAL:
        return {chr(value).lower()}, []
    if kind is kinds.IN:
        return _class(value), []
    if kind is kinds.SUBPATTERN:
        return _sequence(value[-1])
    if kind is kinds.BRANCH:
        found = [_sequence(x)[0] for x in value[1]]
        return (None if None in found else set().union(*found)), []
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        least, most, inner = value
        strings, clauses = _sequence(inner)
        if strings is not None and most == 1:
            return strings | ({""} if least == 0 else set()), []
        if strings is not None and least:
            clauses = [*clauses, strings]
        return None, clauses if least else []
    return (({""}, []) if kind is kinds.AT else (None, []))


def _sequence(items) -> tuple[set[str] | None, list[set[str]]]:
    now, clauses, whole = {""}, [], True
    for kind, value in items:
        strings, inner = _item(kind, value)
        if strings is not None and len(now) * len(strings) <= MOST_STRINGS:
            now = {a + b for a in now for b in strings}
            continue
        whole = False
        clauses += [now, *inner]
        now = strings if strings is not None and len(strings) <= MOST_STRINGS else {""}
    return (now, []) if whole else (None, [*clauses, now])


def trigram_query(pattern: str) -> Query:
    """The pattern's Boolean query over lower-cased text: a list of sets, one of which must occur
    in full. None where no trigram is mandatory, so that every text must be scanned."""
    strings, clauses = _sequence(_parser.parse(pattern))
    query: list[frozenset[str]] = [frozenset()]
    for clause in clauses if strings is None else [strings]:
        if min(map(len, clause)) < 3 or len(query) * len(clause) > MOST_STRINGS:
            continue
        query = [a | b for a, b in itertools.product(query, map(trigrams, clause))]
        query = [a for a in set(query) if not any(b < a for b in query)]
    return None if query == [frozenset()] else sorted(query, key=sorted)
