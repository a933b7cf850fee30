"""Sentence spans of normalised text, without Spark.

A sentence ends at a run of . ? ! outside balanced brackets if, past closing marks and
glued citations, a blank and a character follow that can begin a sentence; a single
period must also not close an abbreviation or an initial. List items always begin one.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable

from leafwright.functions.vocabulary import ABBREVIATIONS, STARTERS

_END = re.compile(r"[.?!]+")
_CLOSERS = "\"'’”)]}»"
_OPENERS = "([\"“'"
_LEADING = "([{\"'“"
_TRAILING = ")]}\"'”,;:."
_BRACKETS = re.compile(r"[()\[\]{}]")
_PAIRS = {")": "(", "]": "[", "}": "{"}


def can_begin(ch: str) -> bool:
    return ch in _OPENERS or ch in "0123456789" or unicodedata.category(ch) in ("Lu", "Lt")


def outer_brackets(text: str) -> list[tuple[int, int]]:
    """Outermost balanced brackets; unmatched ones count for nothing."""
    open_marks: list[tuple[str, int]] = []
    found: list[tuple[int, int]] = []
    for m in _BRACKETS.finditer(text):
        mark, at = m[0], m.start()
        if mark not in _PAIRS:
            open_marks.append((mark, at))
            continue
        depth = next((k for k in range(len(open_marks) - 1, -1, -1) if open_marks[k][0] == _PAIRS[mark]), None)
        if depth is not None:
            begin = open_marks[depth][1]
            del open_marks[depth:]
            while found and found[-1][0] > begin:
                found.pop()
            found.append((begin, at))
    return found


def _past_citations(text: str, at: int, ends: dict[int, int]) -> int:
    now = at
    while True:
        if ends.get(now, now) > now:
            now = ends[now]
        elif now > at and now + 1 < len(text) and text[now] in ",–-" and now + 1 in ends:
            now += 1
        else:
            return now


def _period_ends(text: str, dot: int, following: int) -> bool:
    begin = text.rfind(" ", 0, dot) + 1
    word = text[begin:dot].lstrip(_LEADING)
    if (word + ".").lower() in ABBREVIATIONS:
        return False
    if len(word) == 1 and unicodedata.category(word) == "Lu":
        before = text[: max(0, begin - 1)]
        if before[before.rfind(" ") + 1 :][-1:] in tuple("0123456789"):
            return True
        stop = text.find(" ", following)
        after = text[following : stop if stop >= 0 else len(text)].lstrip(_LEADING).rstrip(_TRAILING)
        return after.lower() in STARTERS
    return True


def sentence_spans(text: str | None, breaks: Iterable[int] = (), citations: Iterable[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Half-open spans of code points; empty or null text has none."""
    if not text:
        return []
    cuts = {b for b in breaks if 0 < b < len(text) and text[b] != " "}
    brackets = outer_brackets(text)
    begins = [b for b, _ in brackets]
    ends = {a: b for a, b in citations if b > a}
    for m in _END.finditer(text):
        first = m.start()
        near = bisect_right(begins, first) - 1
        if near >= 0 and begins[near] < first < brackets[near][1]:
            continue
        at = m.end()
        while at < len(text) and text[at] in _CLOSERS:
            at += 1
        if at < len(text) and text[at] != " ":
            at = _past_citations(text, at, ends)
        following = at + 1
        if following < len(text) and text[at] == " " and can_begin(text[following]):
            if text[first] != "." or _period_ends(text, first, following):
                cuts.add(following)
    out = []
    edges = [0, *sorted(cuts), len(text)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        while lo < hi and text[lo] == " ":
            lo += 1
        while hi > lo and text[hi - 1] == " ":
            hi -= 1
        if hi > lo:
            out.append((lo, hi))
    return out
