"""Markup cleaning and tokenizing as column expressions.

Character classes are written out because the engine's shorthand classes are
ASCII-only while the text is not: letters and numbers of any script plus ``_``
form words, and every Unicode blank counts as space.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from wordloom import constants as K

WORD = r"\p{L}\p{N}_"
BLANK = r"\x09-\x0D\x1C-\x20\x85\p{Z}"

ENGLISH_WORD = rf"(?<![{WORD}])[a-z]{{2,}}+(?![{WORD}])"
SENTENCE_TOKEN = rf"[{WORD}]+|[^{WORD}{BLANK}]"


def present(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def drop_templates(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\{\{.*?\}\}", "")


def unwrap_piped_links(text: Column) -> Column:
    return F.regexp_replace(text, r"(?d)\[\[.*?\|(.+?)\]\]", "$1")


def unwrap_plain_links(text: Column) -> Column:
    return F.regexp_replace(text, r"(?d)\[\[(.+?)\]\]", "$1")


def drop_headings(text: Column) -> Column:
    return F.regexp_replace(text, r"(?d)==+.*?==+", " ")


def drop_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]+>", " ")


def drop_urls(text: Column) -> Column:
    return F.regexp_replace(text, rf"http[^{BLANK}]+", " ")


def keep_charset(text: Column) -> Column:
    return F.regexp_replace(text, rf"[^{WORD}{BLANK}.,!?;:'-]", " ")


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{BLANK}]+", " "))


CLEANING_STEPS = (
    present, drop_templates, unwrap_piped_links, unwrap_plain_links, drop_headings,
    drop_tags, drop_urls, keep_charset, collapse_space,
)


# The steps on markup, and what a text that any of them changes must hold.
_MARKUP_STEPS = CLEANING_STEPS[1:-2]
_MARKS = ("{{", "[[", "==", "<", "http")


def clean_text(text: Column) -> Column:
    """All of ``CLEANING_STEPS`` in order, with fewer passes over the text.

    A text without any mark is not sent through the steps on markup, which would leave it as it is. The last two
    steps are one: characters outside the charset become blanks, and any run of blanks becomes one.
    """
    text = present(text)
    marked = reduce(or_, [F.contains(text, F.lit(m)) for m in _MARKS])
    plain = F.when(marked, reduce(lambda t, step: step(t), _MARKUP_STEPS, text)).otherwise(text)
    return F.trim(F.regexp_replace(plain, rf"[^{WORD}.,!?;:'-]+", " "))


def english_words(text: Column) -> Column:
    """Lowercase ASCII-letter words of two letters or more, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(ENGLISH_WORD), F.lit(0))


def sentence_tokens(text: Column, preserve_apostrophe: bool = False) -> Column:
    pattern = SENTENCE_TOKEN
    if preserve_apostrophe:
        pattern = rf"[{WORD}]+(?:'[{WORD}]+)*|[^{WORD}{BLANK}]"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{BLANK}]+|[{BLANK}]+\z", "")


def is_checkable(token: Column) -> Column:
    """Tokens a checker looks at: letters only, and not the one-letter words a and i."""
    return token.rlike(r"^\p{L}+\z") & ~token.isin("a", "i", "A", "I")


def is_article(title: Column, text: Column) -> Column:
    named = F.coalesce(title, F.lit("")) != ""
    filled = F.coalesce(text, F.lit("")) != ""
    return named & filled


def is_redirect(text: Column) -> Column:
    """False for a missing text."""
    return F.coalesce(text.startswith(K.REDIRECT_PREFIX), F.lit(False))


def in_skipped_namespace(title: Column) -> Column:
    return title.rlike("^(?:" + "|".join(K.NAMESPACE_PREFIXES) + ")")


def rejoin(tokens: Column) -> Column:
    """Tokens joined by blanks, closing punctuation pulled to the left."""
    return F.regexp_replace(F.array_join(tokens, " "), rf"[{BLANK}]+([.,!?;:])", "$1")
