"""Which trigrams a text must hold to match a pattern."""

from __future__ import annotations

from re import _constants as kinds
from re import _parser

# Strings that one pattern may expand to, and characters of a class that are listed one by one.
_MOST, _CLASS = 64, 8
_GAP = "\0"  # anything may stand here


def _joined(left: set[str], right: set[str]) -> set[str]:
    if len(left) * len(right) > _MOST:
        return {x + _GAP for x in left}
    return {x + y for x in left for y in right}


def _class(items) -> set[str]:
    found: set[str] = set()
    for kind, value in items:
        if kind == kinds.LITERAL:
            found.add(chr(value).lower())
        elif kind == kinds.RANGE and value[1] - value[0] < _CLASS:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return {_GAP}
    return found if len(found) <= _CLASS else {_GAP}


def _strings(pattern) -> set[str]:
    """Lower-case strings with gaps of which every match holds one."""
    result = {""}
    for kind, value in pattern:
        if kind == kinds.LITERAL:
            part = {chr(value).lower()}
        elif kind == kinds.IN:
            part = _class(value)
        elif kind == kinds.SUBPATTERN:
            part = _strings(value[3])
        elif kind == kinds.BRANCH:
            part = set().union(*(_strings(p) for p in value[1]))
        elif kind == kinds.MAX_REPEAT:
            least, most, inner = value
            once = _strings(inner)
            if (least, most) == (0, 1):
                part = once | {""}
            else:
                part = {_GAP} if least == 0 else _joined(once, {_GAP} if most > 1 else {""})
        elif kind == kinds.AT:
            part = {""}
        else:
            part = {_GAP}
        result = _joined(result, part)
        if len(result) > _MOST:
            result = {_GAP}
    return result


def needed(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams: a text that matches holds all of at least one set. Empty if none is mandatory."""
    sets = set()
    for string in _strings(_parser.parse(pattern)):
        parts = string.split(_GAP)
        sets.add(frozenset(p[i : i + 3] for p in parts for i in range(len(p) - 2)))
    if frozenset() in sets:
        return []
    return sorted((s for s in sets if not any(other < s for other in sets)), key=sorted)
