"""Fixed word lists, patterns and constants.

The stop list, the type taxonomy and the scoring constants are fixed values: results depend on them literally.
"""

from __future__ import annotations

# --- fixed values: English stop words ---------------------------------------------------------------------
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had having "
    "do does did doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most other some such no nor not only "
    "own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren "
    "aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won "
    "won't wouldn wouldn't"
).split()

# --- fixed values: type taxonomy --------------------------------------------------------------------------
ENTITY_TYPES = [
    "PERSON", "NORP", "FAC", "ORG", "GPE", "LOC", "PRODUCT", "EVENT", "WORK_OF_ART", "LAW", "LANGUAGE",
]
ATTRIBUTE_TYPES = [
    "DATE", "TIME", "PERCENT", "MONEY", "QUANTITY", "ORDINAL", "CARDINAL", "DURATION", "AGE", "FREQUENCY",
    "SCORE", "STAT", "RATING", "DIMENSION",
]

# --- fixed values: relation confidence and thresholds -----------------------------------------------------
BASE_SCORE = 0.3
DEPENDENCY_BONUS = 0.2
LEMMA_BONUS = 0.1
BONUS_LEMMAS = ["be", "have", "own", "create", "lead"]
DISTANCE_STEP = 0.05
DISTANCE_CAP = 0.3
CONFIDENCE_FLOOR = 0.1
CONFIDENCE_CEILING = 1.0
SUBJECT_DEPS = ["nsubj", "nsubjpass"]
OBJECT_DEPS = ["dobj", "pobj"]
ENTITY_THRESHOLD = 0.5
RELATION_THRESHOLD = 0.4
DEFAULT_CONFIDENCE = 0.5
MALFORMED_CONFIDENCE = 0.1
TOP_CANDIDATES = 5
MAX_CLASSIFIER_TOKENS = 128
SVD_COMPONENTS = 100
SEED = 42

# --- anchor verbs: surface form -> lemma ------------------------------------------------------------------
# The last three lines lie outside BONUS_LEMMAS, so that both sides of the lemma bonus occur.
ANCHORS = {
    "am": "be", "is": "be", "are": "be", "was": "be", "were": "be", "be": "be", "been": "be",
    "have": "have", "has": "have", "had": "have",
    "own": "own", "owns": "own", "owned": "own",
    "create": "create", "creates": "create", "created": "create",
    "lead": "lead", "leads": "lead", "led": "lead",
    "buy": "buy", "buys": "buy", "bought": "buy", "make": "make", "makes": "make", "made": "make",
    "say": "say", "says": "say", "said": "say", "acquire": "acquire", "acquires": "acquire", "acquired": "acquire",
    "est": "être", "sont": "être", "ist": "sein", "sind": "sein", "es": "ser", "son": "ser",
}

# --- parts of speech: closed classes by list, open classes by suffix ---------------------------------------
# One letter per part of speech keeps a sentence's tags in one short string.
POS_CODES = {
    "PUNCT": "U", "NUM": "M", "AUX": "X", "VERB": "V", "DET": "D", "ADP": "P", "PRON": "O", "CCONJ": "C",
    "ADV": "R", "ADJ": "A", "NOUN": "N",
}
CLOSED_CLASSES = {
    "AUX": [w for w, lemma in ANCHORS.items() if lemma in ("be", "have", "être", "sein", "ser")],
    "VERB": [w for w, lemma in ANCHORS.items() if lemma not in ("be", "have", "être", "sein", "ser")],
    "DET": ["the", "a", "an", "this", "that", "these", "those"],
    "ADP": ["of", "in", "to", "for", "on", "with", "by", "at", "from", "as", "into", "over", "under"],
    "PRON": ["i", "you", "he", "she", "it", "we", "they", "him", "her", "them", "us"],
    "CCONJ": ["and", "or", "but", "nor"],
    "ADV": ["not", "also", "very", "now", "then", "here", "there"],
}
# (suffix, part of speech); a word needs at least two more letters than its suffix. First match wins.
SUFFIXES = [
    ("ly", "ADV"), ("ing", "VERB"), ("ed", "VERB"),
    ("ble", "ADJ"), ("less", "ADJ"), ("ful", "ADJ"), ("ous", "ADJ"), ("ive", "ADJ"), ("est", "ADJ"),
]

# --- character classes that mean the same in Java and RE2 regular expressions ------------------------------
SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
# the same characters one by one, for what trims them
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"\p{L}\p{N}_"
SENTENCE = r"[^.!?\n]+[.!?]*"
TOKEN = rf"[{WORD}]+|[^{WORD}{SPACE}]"
TERM = rf"[{WORD}]{{2,}}"
URL = rf"http[^{SPACE}]+|www[^{SPACE}]+|https[^{SPACE}]+"
# words of the summariser: a letter, then letters, apostrophes and hyphens
SUMMARY_WORD = r"\p{L}[\p{L}'-]*"

# --- attribute mentions: a scanner that cuts a text into pieces, and one full-piece pattern per type -------
NUMBER = r"\p{Nd}+(?:[.,]\p{Nd}+)*"
MONTH = (
    r"(?:January|February|March|April|May|June|July|August|September|October|November|December|"
    r"Jan\.?|Feb\.?|Mar\.?|Apr\.?|Jun\.?|Jul\.?|Aug\.?|Sept?\.?|Oct\.?|Nov\.?|Dec\.?)"
)
UNIT = (
    r"(?:kilometers|kilometres|kilograms|kilometer|kilometre|kilogram|meters|metres|miles|tonnes|tons|liters|"
    r"litres|acres|degrees|pounds|feet|inches|km|kg|mph)"
)
MONEY_PATTERN = (
    rf"[$€£¥] ?{NUMBER}(?: (?:thousand|million|billion|trillion))?|"
    rf"{NUMBER} (?:dollars|euros|cents|USD|EUR|GBP)"
)
PERCENT_PATTERN = rf"{NUMBER} ?%|{NUMBER} percent"
DATE_PATTERN = (
    r"\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}|\p{Nd}{1,2}/\p{Nd}{1,2}/\p{Nd}{2,4}|"
    rf"{MONTH} \p{{Nd}}{{1,2}}, \p{{Nd}}{{4}}|{MONTH} \p{{Nd}}{{1,4}}|"
    r"Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|"
    r"January|February|April|June|July|August|September|October|November|December"
)
TIME_PATTERN = r"\p{Nd}{1,2}:\p{Nd}{2}(?::\p{Nd}{2})?(?: ?[AaPp][Mm])?|\p{Nd}{1,2} ?[AaPp][Mm]"
QUANTITY_PATTERN = rf"{NUMBER} ?{UNIT}"
ORDINAL_WORDS = "first second third fourth fifth sixth seventh eighth ninth tenth".split()
CARDINAL_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve hundred thousand million billion"
).split()
NUMBER_WORDS = ORDINAL_WORDS + CARDINAL_WORDS
ORDINAL_PATTERN = rf"\p{{Nd}}+(?:st|nd|rd|th)|(?i:{'|'.join(ORDINAL_WORDS)})"
CARDINAL_PATTERN = rf"{NUMBER}|(?i:{'|'.join(CARDINAL_WORDS)})"
# priority order; a piece takes the first type whose pattern matches the whole piece
ATTRIBUTE_PATTERNS = [
    ("MONEY", MONEY_PATTERN),
    ("PERCENT", PERCENT_PATTERN),
    ("DATE", DATE_PATTERN),
    ("TIME", TIME_PATTERN),
    ("QUANTITY", QUANTITY_PATTERN),
    ("ORDINAL", ORDINAL_PATTERN),
    ("CARDINAL", CARDINAL_PATTERN),
]
# Pieces that end in a letter or digit run on to the end of the word, so that a pattern never cuts a word in two.
_REST = rf"[{WORD}]*"
# No attribute starts with one of these, so the first alternative takes most words at once.
_PLAIN_START = r"[\p{Ll}\p{Lm}\p{Lo}_BCEGHIKLPQRUVXYZ]"
PIECE = "|".join(
    [rf"{_PLAIN_START}{_REST}", rf"(?:{MONEY_PATTERN}){_REST}", rf"(?:{PERCENT_PATTERN}){_REST}", rf"(?:{DATE_PATTERN}){_REST}",
     rf"(?:{TIME_PATTERN}){_REST}", rf"(?:{QUANTITY_PATTERN}){_REST}", rf"\p{{Nd}}+[\p{{L}}_]{_REST}",
     NUMBER, rf"[{WORD}]+", rf"[^{WORD}{SPACE}]"]
)
