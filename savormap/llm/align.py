"""Banded alignment of word sequences."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence


def most_edits(one: int, other: int, share: float) -> int:
    """Edits that sequences of these lengths may have at a similarity of ``share``."""
    return int((1.0 - share) * max(one, other) + 1e-9)


def similar(one: str, other: str, share: float) -> bool:
    """Whether 1 - edits / words of the longer text is at least ``share``; words are split at white space."""
    left, right = one.split(), other.split()
    limit = most_edits(len(left), len(right), share)
    if abs(len(left) - len(right)) > limit:
        return False
    common = sum((Counter(left) & Counter(right)).values())
    if max(len(left), len(right)) - common > limit:
        return False  # words that the other text lacks cost an edit each
    return banded_distance(left, right, limit) <= limit


def banded_distance(one: Sequence, other: Sequence, limit: int) -> int:
    """The edit distance where it is at most ``limit``; something larger elsewhere.

    Only cells within ``limit`` of the diagonal are looked at. A column of the band
    is a few bit vectors, one bit a cell, which say whether the distance rises or
    falls from cell to cell (Hyyrö, 2003).
    """
    rows, columns = len(one), len(other)
    if abs(rows - columns) > limit:
        return limit + 1
    places: dict[object, int] = {}
    for n, word in enumerate(one):
        places[word] = places.get(word, 0) | 1 << n
    mask = (1 << (2 * limit + 1)) - 1
    rises, falls = mask >> limit << limit, 0
    distance, last = (limit, rows - limit) if rows > limit else (rows, 0)
    bottom = 1 << (2 * limit)
    for column, word in enumerate(other, 1):
        shift = column - limit - 1
        found = places.get(word, 0)
        found = (found >> shift if shift >= 0 else found << -shift) & mask
        level = ((((found & rises) + rises) ^ rises) | found | falls) & mask
        right_rises = falls | ~(level | rises) & mask
        right_falls = level & rises
        if column <= last:
            distance += not level & bottom
        else:
            cell = 1 << (rows - column + limit)
            distance += bool(right_rises & cell) - bool(right_falls & cell)
        below = level >> 1
        rises = right_falls | ~(below | right_rises) & mask
        falls = below & right_rises
    return distance
