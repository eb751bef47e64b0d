"""Tokenizers as native Spark column expressions (no Python UDF).

Three tokenizers are supported, named after what they do:

``word_lower``
    lower-case the text, then take every run of word characters (``\\w+``,
    ASCII letters, digits and ``_``).  Same output as Spark ML's
    ``RegexTokenizer(pattern='\\w+', gaps=False)`` with its default
    lower-casing.
``nonword_split``
    split at every single non-word character with Java ``String.split``
    semantics: case kept, leading and inner empty strings kept, trailing empty
    strings dropped, ``''`` gives ``['']`` and an all-separator text gives
    ``[]``.
``alpha``
    every run of ASCII letters ``[a-zA-Z]+``, case kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three tokenizer names and their patterns.
WORD_LOWER = "word_lower"
NONWORD_SPLIT = "nonword_split"
ALPHA = "alpha"
MODES = (WORD_LOWER, NONWORD_SPLIT, ALPHA)

WORD_PATTERN = r"\w+"
NONWORD_PATTERN = r"\W"
TRAILING_NONWORD_PATTERN = r"\W+\z"
ALL_NONWORD_PATTERN = r"^\W+\z"
ALPHA_PATTERN = r"[a-zA-Z]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text, mode: str = WORD_LOWER) -> Column:
    """``array<string>`` of the tokens of ``text`` under ``mode``.

    A null text is treated as ``''`` (the corpus loaders fill nulls already).
    """
    t = F.coalesce(_col(text), F.lit(""))
    if mode == WORD_LOWER:
        return F.regexp_extract_all(F.lower(t), F.lit(WORD_PATTERN), F.lit(0))
    if mode == ALPHA:
        return F.regexp_extract_all(t, F.lit(ALPHA_PATTERN), F.lit(0))
    if mode == NONWORD_SPLIT:
        # Java split drops trailing empty strings: strip the trailing
        # separators first.  Two cases differ from that rule: an empty text
        # yields one empty token, a text of separators only yields none.
        return (F.when(t == "", F.array(F.lit("")))
                .when(t.rlike(ALL_NONWORD_PATTERN), F.array().cast("array<string>"))
                .otherwise(F.split(F.regexp_replace(t, TRAILING_NONWORD_PATTERN, ""),
                                   NONWORD_PATTERN)))
    raise ValueError(f"unknown tokenizer mode {mode!r}; use one of {MODES}")


def query_tokens(query, mode: str = WORD_LOWER) -> Column:
    """Tokens of a query column (name or Column; ``F.lit`` for a literal):
    split on single spaces (as typed), drop empty terms, then pass every term through the index's own tokenizer so that a query
    matches the index vocabulary (``The`` finds ``the`` under ``word_lower``)."""
    q = _col(query)
    parts = F.split(F.coalesce(q, F.lit("")), " ")
    per_term = F.transform(parts, lambda p: tokens(p, mode))
    return F.filter(F.flatten(per_term), lambda w: w != "")
