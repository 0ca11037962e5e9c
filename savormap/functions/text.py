"""Review-text normalisation as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ten contraction rewrites, applied in this order.
CONTRACTIONS = (
    ("won't", "will not"),
    ("can't", "can not"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'t", " not"),
    ("'ve", " have"),
    ("'m", " am"),
)

# Two-character escape sequences that stand for a blank.
ESCAPES = ("\\r", "\\n", '\\"')

# The English stop words.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of at
    by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both
    each few more most other some such only own same so than too very s t can will just don don't
    should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't
    hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
    shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# Fixed value: the path whose substrings the notebook's stop-word test drops.
STOP_PATH = "root/nltk_data/corpora/stop_words"

_STOP_RULES = ("list", "path")


def expand_contractions(text: Column) -> Column:
    """The ten ordered, case-sensitive rewrites."""
    return reduce(
        lambda col, rule: F.replace(col, F.lit(rule[0]), F.lit(rule[1])), CONTRACTIONS, text
    )


def blank_escapes(text: Column) -> Column:
    """Literal two-character escapes become blanks."""
    return reduce(lambda col, seq: F.replace(col, F.lit(seq), F.lit(" ")), ESCAPES, text)


_OTHER = "[^A-Za-z]+"
# One or two distinct characters from end to end; possessive, so it never backtracks.
_MONOTONE = r"^(?:(.)\1*+(?:(.)(?:\1|\2)*+)?)?$"


def letters_only(text: Column) -> Column:
    """Every run of other characters becomes one blank."""
    return F.regexp_replace(text, _OTHER, " ")


def varied_words(tokens: Column) -> Column:
    """Tokens with more than two distinct characters."""
    return F.filter(tokens, lambda w: ~w.rlike(_MONOTONE))


def without_stop_words(tokens: Column, rule: str = "list") -> Column:
    """Drop lower-case stop words: list members, or (``path``) anything the fixed path contains."""
    if rule not in _STOP_RULES:
        raise ValueError(f"unknown stop-word rule {rule!r}; use one of {_STOP_RULES}")
    if rule == "list":
        return F.filter(tokens, lambda w: ~w.isin(*STOP_WORDS))
    return F.filter(tokens, lambda w: ~F.contains(F.lit(STOP_PATH), w))


def normal_tokens(text: Column, rule: str = "list") -> Column:
    """Tokens of the normalised text, lower case.

    Case is folded before the distinct-letter test, because stemming single
    characters has that one effect. Splitting at the non-letters replaces them
    and tokenises in one pass over the text.
    """
    letters = F.split(blank_escapes(expand_contractions(text)), _OTHER)
    folded = F.transform(letters, lambda w: F.lower(w))
    return without_stop_words(varied_words(folded), rule)


def normal_text(text: Column, rule: str = "list") -> Column:
    """The whole normalisation: one lower-case, blank-separated string."""
    return F.array_join(normal_tokens(text, rule), " ")
