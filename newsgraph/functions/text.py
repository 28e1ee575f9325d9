"""Column functions for cleaning, tokenising and segmenting text. All are built-in expressions, row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsgraph import lexicon as lx


def filled(text: Column) -> Column:
    """Null text becomes the empty string."""
    return F.coalesce(text, F.lit(""))


def sentence_of(entity1: Column, predicate: Column, entity2: Column) -> Column:
    """Blank-joined triple; a null part makes the sentence null."""
    return F.concat(entity1, F.lit(" "), predicate, F.lit(" "), entity2)


def strip_urls(text: Column) -> Column:
    # Most texts hold no link: two substring tests are far cheaper than the pattern.
    has_link = text.contains("http") | text.contains("www")
    return F.when(has_link, F.regexp_replace(text, lx.URL, " ")).otherwise(text)


def strip_special(text: Column) -> Column:
    return F.regexp_replace(text, rf"[^{lx.WORD}{lx.SPACE}]", " ")


def strip_hyphens(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<=[{lx.WORD}])-(?=[{lx.WORD}])", " ")


def strip_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Nd}+", " ")


def split_blank(text: Column) -> Column:
    """Tokens between runs of white space; no empty tokens."""
    return F.filter(F.split(text, rf"[{lx.SPACE}]+"), lambda t: t != "")


def is_stop_word(word: Column) -> Column:
    return word.isin(lx.STOP_WORDS)


def without_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~is_stop_word(t))


def collapse_spaces(text: Column) -> Column:
    return F.array_join(split_blank(text), " ")


def clean_tokens(text: Column) -> Column:
    """Tokens of the cleaned text.

    Links, special characters, hyphens and digits all turn into blanks and the text is then split on blanks, so the
    tokens are the runs of word characters other than digits: one extraction instead of four replacements.
    """
    runs = F.regexp_extract_all(strip_urls(filled(text)), F.lit(r"[\p{L}\p{Nl}\p{No}_]+"), F.lit(0))
    lowered = F.split(F.lower(F.array_join(runs, " ")), " ")
    return F.filter(lowered, lambda t: (t != "") & ~is_stop_word(t))


def clean(text: Column) -> Column:
    """Cleaned text: no links, special characters, digits or stop words; lower case; single blanks."""
    return F.array_join(clean_tokens(text), " ")


def word_tokens(text: Column) -> Column:
    """Words and punctuation marks, in order."""
    return F.regexp_extract_all(text, F.lit(lx.TOKEN), F.lit(0))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def sentences(text: Column) -> Column:
    """Sentences in order; blank ones are dropped and blanks around a sentence trimmed."""
    found = F.regexp_extract_all(text, F.lit(lx.SENTENCE), F.lit(0))
    # a second pattern would look at every blank of the text; only the ends matter
    trimmed = F.transform(found, lambda s: F.btrim(s, F.lit(lx.SPACES)))
    return F.filter(trimmed, lambda s: s != "")


def capped_tokens(text: Column, limit: int = lx.MAX_CLASSIFIER_TOKENS) -> Column:
    """Classifier input: any value as string, cut after `limit` tokens."""
    return F.slice(split_blank(filled(text.cast("string"))), 1, limit)


def comma_list(values: Column) -> Column:
    return F.array_join(values, ",")


def terms(text: Column) -> Column:
    """Vectoriser terms: lower-case runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(filled(text)), F.lit(lx.TERM), F.lit(0))
