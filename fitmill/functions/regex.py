"""Regular expressions with the same meaning on every engine and for every script.

Patterns are written with the usual ``\\w \\W \\s \\S \\d \\b`` and expanded here to
explicit Unicode classes: a word character is a letter, a number or an underscore.
Java's own ``\\b`` and ``\\s`` are partly ASCII and have changed between versions.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from re import _constants as kind
from re import _parser as regex_parser

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
# Single characters are looked up in one table; the others in a nested class behind one range that
# most text fails. As a plain list each would be a test of its own for every character.
SPACE = (r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x20\x{85}\x{A0}"
         r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]")
DIGIT = r"\p{Nd}"

EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
WORD_START = rf"(?<![{WORD}])"

# Literals that are told apart, at most, where alternatives follow each other.
MOST_RUNS = 64

# A private-use character: neither word, space nor punctuation to any pattern.
MARK = ""

_OUTSIDE = {"w": f"[{WORD}]", "W": f"[^{WORD}]", "s": f"[{SPACE}]", "S": f"[^{SPACE}]",
            "d": DIGIT, "b": EDGE}
_INSIDE = {"w": WORD, "s": SPACE, "d": DIGIT}
_IN_CLASS = {
    (kind.CATEGORY, kind.CATEGORY_WORD): (WORD, True),
    (kind.CATEGORY, kind.CATEGORY_DIGIT): (DIGIT, True),
    (kind.CATEGORY, kind.CATEGORY_SPACE): (SPACE, False),
}


def expand(pattern: str, flags: str = "") -> str:
    """Expand the short classes of ``pattern``; ``flags`` such as ``"i"`` go in front."""
    out, in_class, i = [], False, 0
    opening = _opening(regex_parser.parse(pattern[2:])) if pattern.startswith(r"\b") else None
    if opening:
        # Same meaning as a boundary, but most positions fail at the first look.
        chars, starts_word = opening
        out, i = [f"(?=[{chars}])", WORD_START if starts_word else EDGE], 2
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            nxt = pattern[i + 1]
            out.append((_INSIDE if in_class else _OUTSIDE).get(nxt, ch + nxt))
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
        i += 1
    # "u": fold case by Unicode rules; "d": only \n ends a line.
    head = f"(?{flags}{'u' if 'i' in flags else ''}d)"
    return head + "".join(out)


def _opening(items) -> tuple[str, bool] | None:
    """Class of the characters a match can begin with, and whether all are word characters."""
    chars, all_word = "", True
    for op, arg in items:
        optional = op is kind.MAX_REPEAT and arg[0] == 0
        if op is kind.LITERAL:
            found = [(re.escape(chr(arg)), chr(arg).isalnum())]
        elif op is kind.IN:
            found = [_IN_CLASS.get(member) for member in arg]
        elif op is kind.SUBPATTERN:
            found = [_opening(arg[-1])]
        elif op is kind.BRANCH:
            found = [_opening(branch) for branch in arg[1]]
        elif op is kind.MAX_REPEAT:
            found = [_opening(arg[2])]
        else:
            found = [None]
        if None in found:
            return None
        chars += "".join(c for c, _ in found)
        all_word = all_word and all(w for _, w in found)
        if not optional:
            return chars, all_word
    return None


def _walk(items, runs: set[str]) -> tuple[list[set[str]], set[str]]:
    """Sets of literals, of each of which every match holds one; and what may stand just before the items' end.

    ``runs`` is what may stand just before their beginning.
    """
    choices = []
    for op, arg in items:
        if op is kind.LITERAL:
            runs = {r + chr(arg) for r in runs}
        elif op is kind.IN and len(arg) < 5 and all(k is kind.LITERAL for k, _ in arg):
            runs = {r + chr(c) for r in runs for _, c in arg}
        elif op is kind.MAX_REPEAT and tuple(arg[:2]) == (0, 1) and all(k is kind.LITERAL for k, _ in arg[2]):
            runs = runs | {r + "".join(chr(c) for _, c in arg[2]) for r in runs}
        elif op in (kind.SUBPATTERN, kind.BRANCH) or op is kind.MAX_REPEAT and arg[0] > 0:
            choices.append(runs)
            parts = arg[1] if op is kind.BRANCH else [arg[-1]]
            found = [_walk(part, runs) for part in parts]
            best = [_best([*inner, after]) for inner, after in found]
            choices.append(set().union(*best) if all(best) else set())
            runs = {""} if op is kind.MAX_REPEAT else set().union(*(after for _, after in found))
        elif op is not kind.AT:
            choices.append(runs)
            runs = {""}
        if len(runs) > MOST_RUNS:
            choices.append(runs)
            runs = {""}
    return choices, runs


def _ranked(choices: list[set[str]]) -> list[set[str]]:
    """The choices without literals that hold others, the most telling first; those of any text are left out."""
    least = {frozenset(c for c in some if not any(o in c for o in some if o != c)) for some in choices if some and "" not in some}
    return sorted(map(set, sorted(least, key=sorted)), key=lambda c: (min(map(len, c)), -len(c)), reverse=True)


def _best(choices: list[set[str]]) -> set[str]:
    return next(iter(_ranked(choices)), set())


def cues(items) -> set[str]:
    """Literals of which every match holds at least one; empty when there are none."""
    choices, runs = _walk(items, {""})
    return _best([*choices, runs])


def fold(text: Column) -> Column:
    """Lower case with unchanged length, so offsets hold, and without marks.

    The three letters count as i and s when case is ignored; the first would grow.
    """
    return F.lower(F.translate(text, "\u0130\u0131\u017F" + MARK, "iis "))


def may_match(folded: Column, pattern: str) -> Column:
    """A cheap test that no match of ``pattern`` fails: plain substring search for its cues."""
    choices, runs = _walk(regex_parser.parse(pattern.lower()), {""})
    result = F.lit(True)
    for choice in _ranked([*choices, runs])[:2]:
        result = result & reduce(or_, [folded.contains(cue) for cue in sorted(choice)])
    return result


def replace(text: Column, pattern: str, replacement: str, flags: str = "") -> Column:
    return F.regexp_replace(text, F.lit(expand(pattern, flags)), F.lit(replacement))


def matches(text: Column, pattern: str, flags: str = "") -> Column:
    return text.rlike(expand(pattern, flags))


def strip(text: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.regexp_replace(text, F.lit(rf"^[{SPACE}]++|(?<![{SPACE}])[{SPACE}]++\z"), F.lit(""))


def squeeze(text: Column) -> Column:
    """Collapse every run of white space to one space and strip."""
    return F.trim(replace(text, r"\s+", " "))


def words(text: Column) -> Column:
    """Tokens between white space."""
    return F.regexp_extract_all(text, F.lit(expand(r"\S+")), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(expand(r"\S+"))).cast("int")


def before_first(text: Column, pattern: str, flags: str = "") -> Column:
    """Characters in front of the first match; null when there is none.

    Counted in code points, unlike ``regexp_instr``, which counts UTF-16 units.
    """
    parts = F.split(text, expand(pattern, flags), 2)
    return F.when(F.size(parts) == 2, F.char_length(parts[0]))


def cut_at_matches(text: Column, pattern: str, lead: bool = False) -> Column:
    """Cut the text at every match: even pieces lie between matches, odd ones are matches.

    No character is lost, so piece lengths give offsets (see ``operators.offsets``). The
    text must hold no mark; ``fold`` sees to that. With
    ``lead`` the pattern's first group is text in front of the match proper, which is its
    second group.
    """
    whole = f"$1{MARK}$2{MARK}" if lead else f"{MARK}$0{MARK}"
    return F.split(F.regexp_replace(text, F.lit(expand(pattern)), F.lit(whole)), MARK)
