"""Text columns: cleaning, tokens, lengths and topic flags.

All are built-in expressions evaluated inside the row, so a corpus is cleaned
without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.stem import stem_tokens
from threadlens.functions.words import STOP_WORDS, TOPIC_TERMS


def strip_thread_prefix(link_id: Column, anywhere: bool = False) -> Column:
    """``t3_abc`` -> ``abc``; ``anywhere`` also removes an inner ``t3_``."""
    return F.regexp_replace(link_id, "t3_" if anywhere else "^t3_", "")


def lower_trim(text: Column) -> Column:
    return F.trim(F.lower(text))


def squeeze_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " +", " ")


def letters_only(text: Column) -> Column:
    """Every character but a-z and A-Z becomes a space, so accents split words."""
    return F.regexp_replace(text, "[^a-zA-Z]", " ")


def _listed(words: Iterable[str]) -> str:
    return ", ".join(f"'{word}'" for word in words)


def letter_tokens_sql(text: str) -> str:
    """Lower, trim, squeeze, letters only, split: one regex pass for the lot."""
    return f"filter(split(regexp_replace(lower({text}), '[^a-z]+', ' '), ' '), w -> w != '')"


def kept_tokens_sql(text: str, stop_words: Iterable[str] = STOP_WORDS) -> str:
    return f"filter({letter_tokens_sql(text)}, w -> w not in ({_listed(stop_words)}))"


def letter_tokens(text: str) -> Column:
    """Words of a text column: runs of letters, lower case."""
    return F.expr(letter_tokens_sql(text))


def kept_tokens(text: str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """The same without stop words."""
    return F.expr(kept_tokens_sql(text, stop_words))


def clean_tokens(text: str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """The stems of the kept words."""
    return stem_tokens(kept_tokens_sql(text, stop_words))


def clean_text(text: str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    return F.array_join(clean_tokens(text, stop_words), " ")


def char_length(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    """Runs of characters that are not white space."""
    return F.regexp_count(text, F.lit(r"[^ \t\n\r\f]+"))


def sentence_count(text: Column) -> Column:
    """Runs of ``.``, ``!`` and ``?``; a text without any counts as one sentence."""
    marks = F.regexp_count(text, F.lit("[.!?]+"))
    return F.when(F.length(text) > 0, F.greatest(marks, F.lit(1))).otherwise(
        F.when(text.isNotNull(), F.lit(0))
    )


def mentions_any(text: Column, terms: Iterable[str]) -> Column:
    """Case-sensitive substring test for any term; NULL text gives NULL."""
    return reduce(lambda a, b: a | b, [text.contains(term) for term in terms])


def topic_flags(
    text: Column, topics: Mapping[str, Iterable[str]] = TOPIC_TERMS
) -> dict[str, Column]:
    """``dummy_<topic>`` columns, for ``DataFrame.withColumns``."""
    return {f"dummy_{name}": mentions_any(text, terms) for name, terms in topics.items()}


def topic_name(flag_name: Column) -> Column:
    """``dummy_police`` -> ``police``."""
    return F.right(flag_name, F.length(flag_name) - len("dummy_"))
