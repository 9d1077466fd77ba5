"""Review text: cleaning, sentence chunking and lexicon scoring."""

from __future__ import annotations

import re
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthlake import params

# Characters kept by the cleaner: lower-case ASCII letters, digits, whitespace
# and sentence punctuation; every other character becomes one space.
_NOT_KEPT = r"[^a-z0-9\s\.!?]"
_SENTENCE_END = r"[\.!?]+"
# The original chunker's split pattern after SQL literal unescaping; its last
# alternative is empty, so it cuts between every character.
_LITERAL_SPLIT = r"\\|\\|"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_review_text(c) -> Column:
    return F.regexp_replace(F.lower(_col(c)), _NOT_KEPT, " ")


def chunk_sentences(clean, literal: bool = False) -> Column:
    """Split cleaned text into trimmed, non-empty sentence chunks.

    ``literal=True`` reproduces the original definition character for
    character (the punctuation is first rewritten to '||' and the split
    pattern then matches the empty string, giving one-character chunks).
    """
    text = _col(clean)
    if literal:
        pieces = F.split(F.regexp_replace(text, _SENTENCE_END, "||"), _LITERAL_SPLIT)
    else:
        pieces = F.split(text, _SENTENCE_END)
    return F.filter(F.transform(pieces, lambda x: F.trim(x)), lambda x: F.length(x) > 0)


_PLAIN_WORD = re.compile(r"^[A-Za-z0-9 ]+$")


def contains_any(c: Column, words) -> Column:
    """TRUE when ``c`` contains any of ``words`` as a substring.

    Plain words are tested with ``contains`` (a byte search on Spark's
    UTF-8 strings, no regex engine); a word list with regex syntax falls
    back to one unanchored ``rlike`` alternation, which means the same.
    """
    words = list(words)
    if all(_PLAIN_WORD.match(w) for w in words):
        return reduce(lambda a, b: a | b, [c.contains(w) for w in words])
    return c.rlike("(" + "|".join(words) + ")")


def lexicon_score(chunk, positive=params.POSITIVE_WORDS, negative=params.NEGATIVE_WORDS) -> Column:
    """+1.0 if any positive word occurs, else -1.0 if any negative word, else 0.0.

    The result is DECIMAL(2,1), like the literals of the original rule, so the
    weekly average keeps its decimal typing.
    """
    c = _col(chunk)
    return (F.when(contains_any(c, positive), F.lit(Decimal("1.0")))
            .when(contains_any(c, negative), F.lit(Decimal("-1.0")))
            .otherwise(F.lit(Decimal("0.0"))))
