"""Rule annotation of tokens: part of speech, lemma, anchor verb and its neighbours.

Sentence-level facts are kept as strings with one letter per token, so finding "the nearest content word to the left
of the anchor" is a substring search inside the row and needs neither a window nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions.text import is_stop_word

ANCHOR, CONTENT, STOP, PUNCT = "r", "c", "s", "p"


def is_punct(token: Column) -> Column:
    # A token is either a run of word characters or one other character.
    return (F.char_length(token) == 1) & ~token.rlike(rf"^[{lx.WORD}]")


def _tagged(word: Column, names: dict[str, str]) -> Column:
    # comparing a word's first byte is far cheaper than a pattern, and most words begin with a to z
    may_be_number = (word < "a") | (word >= "{")
    tag = F.when(is_punct(word), names["PUNCT"]).when(may_be_number & word.rlike(r"^\p{Nd}+$"), names["NUM"])
    for name, words in lx.CLOSED_CLASSES.items():
        tag = tag.when(word.isin(words), names[name])
    for suffix, name in lx.SUFFIXES:
        tag = tag.when(word.endswith(suffix) & (F.char_length(word) >= len(suffix) + 2), names[name])
    return tag.otherwise(names["NOUN"])


def pos_tag(word: Column) -> Column:
    """Part of speech of one lower-case token, from the closed-class lists and the suffix rules."""
    return _tagged(word, {name: name for name in lx.POS_CODES})


def pos_code(word: Column) -> Column:
    """Part of speech of one lower-case token as one letter."""
    return _tagged(word, lx.POS_CODES)


def lemma(word: Column) -> Column:
    """Lemma of an anchor verb; any other lower-case token is its own lemma."""
    pairs = [F.lit(x) for pair in lx.ANCHORS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), word), word)


def role_letter(word: Column) -> Column:
    """Anchor verb, punctuation, stop word or content word, for a lower-case token."""
    return (
        F.when(is_punct(word), PUNCT)
        .when(word.isin(list(lx.ANCHORS)), ANCHOR)
        .when(is_stop_word(word), STOP)
        .otherwise(CONTENT)
    )


def lowered(tokens: Column) -> Column:
    """All tokens in lower case, through one call on the joined tokens; no token holds a blank."""
    return F.when(F.size(tokens) == 0, tokens).otherwise(F.split(F.lower(F.array_join(tokens, " ")), " "))


def roles(words: Column) -> Column:
    """One role letter per lower-case token."""
    return F.array_join(F.transform(words, role_letter), "")


def pos_string(words: Column) -> Column:
    """One part-of-speech letter per lower-case token."""
    return F.array_join(F.transform(words, pos_code), "")


def anchor_at(role_string: Column) -> Column:
    """1-based position of the first anchor verb, 0 if none."""
    return F.locate(ANCHOR, role_string)


def subject_at(role_string: Column, anchor: Column) -> Column:
    """1-based position of the nearest content word left of the anchor, 0 if none."""
    before = F.reverse(F.substring(role_string, F.lit(1), anchor - 1))
    steps = F.locate(CONTENT, before)
    return F.when((anchor > 0) & (steps > 0), anchor - steps).otherwise(0)


def object_at(role_string: Column, anchor: Column) -> Column:
    """1-based position of the nearest content word right of the anchor, 0 if none."""
    after = F.substring(role_string, anchor + 1, F.char_length(role_string))
    steps = F.locate(CONTENT, after)
    return F.when((anchor > 0) & (steps > 0), anchor + steps).otherwise(0)


def relation_confidence(distance: Column, verb_lemma: Column) -> Column:
    """Confidence of a triple whose subject and object dependency are both present.

    Double arithmetic in a fixed order: base + dependency bonuses + lemma bonus - distance penalty, then clamped.
    """
    both = lx.DEPENDENCY_BONUS + lx.DEPENDENCY_BONUS
    bonus = F.when(verb_lemma.isin(lx.BONUS_LEMMAS), F.lit(lx.LEMMA_BONUS)).otherwise(F.lit(0.0))
    penalty = F.least(F.lit(lx.DISTANCE_CAP), F.lit(lx.DISTANCE_STEP) * distance)
    raw = F.lit(lx.BASE_SCORE) + F.lit(both) + bonus - penalty
    return F.greatest(F.lit(lx.CONFIDENCE_FLOOR), F.least(F.lit(lx.CONFIDENCE_CEILING), raw))
