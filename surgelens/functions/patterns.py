"""Which of many patterns can match a text at all, from the literals they require.

A pattern that must contain ``/etc/passwd`` can't match a text without it. The
longest literal that every match has to contain, or the literals of which it has to
contain one, are read off the parsed pattern; each is listed under one of its
three-letter pieces, the one that fewest other literals share. A text's own pieces then name the few patterns worth trying, so
the work for a text grows with its length, not with the number of patterns.
"""

from __future__ import annotations

import re
import re._constants as kinds
import re._parser as parser
from collections import Counter, defaultdict
from collections.abc import Iterable, Sequence

PIECE = 3


def folded(text: str) -> str:
    """Text in which letters that match regardless of case are spelled alike.

    ASCII letters and all letters that fold onto one of them become a-z.
    """
    return text.upper().lower().replace("̇", "")


def _required(parsed: Iterable) -> list[str]:
    """Literals of which every match contains at least one; the longest such choice,
    by its shortest member. Empty if the pattern requires none."""
    choices: list[list[str]] = []
    run = ""
    for kind, value in parsed:
        if kind is kinds.LITERAL and value < 128:
            run += chr(value)
            continue
        if kind is kinds.AT:
            # An anchor or a word boundary stands between letters without parting them.
            continue
        choices.append([run])
        run = ""
        if kind is kinds.SUBPATTERN:
            choices.append(_required(value[-1]))
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT) and value[0] >= 1:
            choices.append(_required(value[2]))
        elif kind is kinds.ATOMIC_GROUP:
            choices.append(_required(value))
        elif kind is kinds.BRANCH:
            branches = [_required(b) for b in value[1]]
            choices.append([x for b in branches for x in b] if all(branches) else [])
    choices.append([run])
    return max((c for c in choices if c and all(c)), key=lambda c: min(map(len, c)), default=[])


def required_literals(pattern: str) -> list[str]:
    """Folded literals of which every match contains at least one; empty if unknown."""
    try:
        parsed = parser.parse(pattern)
    except re.error:
        return []
    if parsed.state.flags & re.VERBOSE:
        return []
    return list(dict.fromkeys(folded(x) for x in _required(parsed)))


class PatternIndex:
    """Patterns in order, listed by a piece of each literal they may be known by."""

    def __init__(self, patterns: Sequence[str]):
        self.patterns = list(patterns)
        literals = [required_literals(p) for p in self.patterns]
        # Patterns without literals of a piece's length are tried on every text.
        known = [bool(own) and min(map(len, own)) >= PIECE for own in literals]
        self.always = [i for i, k in enumerate(known) if not k]
        shared = Counter(piece for own, k in zip(literals, known) if k for x in own for piece in self._pieces(x))
        self.listed: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for i, (own, k) in enumerate(zip(literals, known)):
            for x in own if k else ():
                self.listed[min(self._pieces(x), key=lambda p: (shared[p], p))].append((x, i))

    @staticmethod
    def _pieces(text: str) -> set[str]:
        return {text[i : i + PIECE] for i in range(len(text) - PIECE + 1)}

    def candidates(self, text: str) -> list[str]:
        """The patterns that may match, in order."""
        body = folded(text)
        found = set(self.always)
        for piece in self._pieces(body) & self.listed.keys():
            found.update(i for x, i in self.listed[piece] if x in body)
        return [self.patterns[i] for i in sorted(found)]
