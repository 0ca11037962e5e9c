"""Characters newer than the tables at hand.

Letter classes and case of a character that Python's tables don't know yet differ from one
library to the next. Texts with such characters are split by the tokenizer's own
library; all others by our patterns, which agree with it there.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

_seen: set[str] = set()  # characters that are known here


def has_newer(text: str) -> bool:
    """Whether a text has characters that are unknown here."""
    if text.isascii() or _seen.issuperset(text):
        return False
    new = set(text) - _seen
    unknown = any(unicodedata.category(c) == "Cn" for c in new)
    if not unknown:
        _seen.update(new)
    return unknown


@lru_cache(maxsize=4)
def _library(vocabulary: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def words(text: str, vocabulary: str) -> list[str]:
    """The words of a text before merging, by the library itself."""
    known = _library(vocabulary)
    if known.normalizer:
        text = known.normalizer.normalize_str(text)
    return [text[a:b] for _, (a, b) in known.pre_tokenizer.pre_tokenize_str(text)]
