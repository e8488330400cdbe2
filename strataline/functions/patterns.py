"""Regular expressions that mean the same here and in other engines.

Patterns are written with \\b and \\w in their Unicode sense. ``java`` turns them into look-arounds over letters,
digits and the underscore; ``re2`` into groups that consume the neighbour, for engines without look-arounds.
"""

from __future__ import annotations

import re
from functools import lru_cache
from re import _constants as op
from re import _parser

_LETTER = r"[\p{L}\p{N}_]"
_LOOK = rf"(?:(?<!{_LETTER})(?={_LETTER})|(?<={_LETTER})(?!{_LETTER}))"


def java(pattern: str) -> str:
    """A leading \\b stands before a letter or digit in all patterns here, so it only looks back."""
    if pattern.startswith(r"\b"):
        return rf"(?<!{_LETTER})" + java(pattern[2:])
    return pattern.replace(r"\b", _LOOK).replace(r"\w", _LETTER)


#: Where \\b follows something that may be no letter, it asks for a letter next.
_RE2 = {
    r"\b\d+(?:\.\d+)?\s*(?:%|percent)\b": r"\b\d+(?:\.\d+)?\s*(?:%\w|percent\b)",
    r"\b(?:correlation|r\s*=|R²\s*=)\b": r"\b(?:correlation\b|r\s*=\w|R²\s*=\w)",
    r"\bimportant:\b": r"\bimportant:\w",
    r"^(?:For example|For instance|e\.g\.|eg\.?)\b": r"^(?:(?:For example|For instance|eg)\b|e\.g\.\w|eg\.\w)",
    r"\b(?:https?://|www\.|mhhe\.com)\b": r"\b(?:https?://\w|www\.\w|mhhe\.com\b)",
}


def re2(pattern: str) -> str:
    p = _RE2.get(pattern, pattern).replace(r"(?!to\b)", "")
    p = re.sub(r"^\\b", rf"(?:^|[^\\p{{L}}\\p{{N}}_])", p)
    p = p.replace(r"\b", r"(?:$|[^\p{L}\p{N}_])")
    return p.replace(r"\w", _LETTER)


def any_java(patterns: list[str], flags: str = "iud") -> str:
    """One alternation; flags i: case, u: Unicode case, d: only \\n ends a line, m: ^ and $ at lines.

    Patterns that begin with \\b and a letter or digit share one test of the neighbour before, so that they are tried
    at the starts of words alone.
    """
    inner = [java(p[2:]) for p in patterns if p.startswith(r"\b")]
    rest = [f"(?:{java(p)})" for p in patterns if not p.startswith(r"\b")]
    if inner:
        rest.insert(0, rf"(?:(?<!{_LETTER})(?:{'|'.join(inner)}))")
    return f"(?{flags})" + "|".join(rest)


def any_re2(patterns: list[str], flags: str = "i") -> str:
    return f"(?{flags})" + "|".join(f"(?:{re2(p)})" for p in patterns)


def sql(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


@lru_cache(maxsize=None)
def needed(pattern: str) -> frozenset[str] | None:
    """Small-letter strings of which a text that the pattern matches, in any case, has one at least; None where there is no
    such set of some use. A text that holds none of them needs no look at the pattern."""
    found = _needed(list(_parser.parse(pattern.replace(r"\p{L}", "x"))))
    return found if found and all(len(x) > 1 for x in found) and len(found) <= 24 else None


def _needed(nodes: list, run: str = "") -> frozenset[str] | None:
    """The best set of one sequence, that ``run`` stands before: of its literal runs and of what its groups need."""
    best = None

    def better(found: frozenset[str] | None) -> None:
        nonlocal best
        if found and (best is None or min(map(len, found)) > min(map(len, best))):
            best = found

    for kind, arg in [*nodes, (None, None)]:
        if kind is op.LITERAL and chr(arg).isascii():
            run += chr(arg).lower()
            continue
        if kind is op.SUBPATTERN:
            better(_needed(list(arg[3]), run))
        elif kind is op.BRANCH:
            each = [_needed(list(x), run) for x in arg[1]]
            if all(each):
                better(frozenset().union(*each))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT) and arg[0] > 0:
            better(_needed(list(arg[2])))
        if run:
            better(frozenset([run]))
        run = ""
    return best
