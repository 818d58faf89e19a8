"""Many keyword patterns over one text: folded once, answered as one bit set.

A case-insensitive ``rlike`` per pattern folds every character of the text again
for every pattern.  Here the text is folded once; a literal alternative is then a
plain byte search that stops at its first hit, and an alternative with wildcards is
tried as a regex only on texts that hold all its literal pieces.  On one core this
takes a third of the time of the separate regexes, and half that of a single regex
over the trie of all alternatives, which cannot stop early.

Patterns are alternations (``a|b``) of letters, digits, ``_``, ``-``, blanks,
``.`` (any character but a line break) and ``.?``, in ASCII.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the characters beside A-Z that case-insensitive Unicode matching equates with an ASCII
# letter and that lower-casing alone does not turn into it (long s, dotted I, dotless i) ---
FOLDED = [("ſ", "s"), ("İ", "i"), ("ı", "i")]

_ALTERNATIVE = re.compile(r"([a-z0-9_ -]|\.\??)+")


def fold(text: Column) -> Column:
    """Lower-cased text on which ASCII patterns match as ``(?iu)`` ones do on the text itself."""
    for a, b in FOLDED:
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.lower(text)


def holds(low: Column, pattern: str) -> Column:
    """Whether folded text matches the pattern somewhere; null for a null text."""
    def one(alternative: str) -> Column:
        pieces = [p for p in re.split(r"\.\??", alternative) if p]
        found = [low.contains(p) for p in pieces]
        return reduce(and_, found + ([low.rlike(alternative)] if pieces != [alternative] else []))

    return reduce(or_, [one(a) for a in pattern.split("|")])


class PatternSet:
    """Named patterns; bit i of the bit set belongs to the i-th name."""

    def __init__(self, patterns: list[tuple[str, str]]):
        if not 1 <= len(patterns) <= 62:
            raise ValueError("a bit set holds 1 to 62 patterns")
        self.names = [n for n, _ in patterns]
        self.patterns = [p.lower() for _, p in patterns]
        for a in [a for p in self.patterns for a in p.split("|")]:
            if not _ALTERNATIVE.fullmatch(a):
                raise ValueError(f"not a keyword pattern: {a!r}")

    def bits(self, low: Column) -> Column:
        """The bit set of the patterns that a folded text holds; 0 for a null text."""
        return reduce(lambda a, b: a + b, [F.when(holds(low, p), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                                           for i, p in enumerate(self.patterns)])

    def flag(self, bits: Column, name: str) -> Column:
        return bits.bitwiseAND(F.lit(1 << self.names.index(name)).cast("bigint")) != 0
