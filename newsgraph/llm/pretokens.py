"""Split text into pre-tokens exactly as a tokenizer library does, also where its Unicode tables differ from ours.

The pattern is the same everywhere, but each library brings its own version of the Unicode tables, so a character that
became a letter lately is a letter for one and not for the other. `disputed` asks the library about every character
whose class has changed since Unicode 3.2; the answer is a short list of ranges that tasks get with the pattern.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import regex

# Pre-tokens of one very long text are handed on in lists of so many.
LIST_ROWS = 200_000


@lru_cache(maxsize=1)
def _questions() -> tuple[int, ...]:
    """Characters whose class (letter, number, other) is not the same in Unicode 3.2 and in this regex module."""
    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    old = unicodedata.ucd_3_2_0.category
    found = []
    for code in range(0x100, sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        now = "L" if letter.match(char) else "N" if number.match(char) else "O"
        before = old(char)[0]
        if now != (before if before in "LN" else "O"):
            found.append(code)
    return tuple(found)


def _ranges(codes: list[int]) -> str:
    parts, start = [], None
    for i, code in enumerate(codes):
        if start is None:
            start = code
        if i + 1 == len(codes) or codes[i + 1] != code + 1:
            parts.append(rf"\U{start:08x}-\U{code:08x}")
            start = None
    return "".join(parts)


def disputed(pieces_by_line: Callable[[list[str]], list[int]]) -> tuple[str, str, str]:
    """(all disputed characters, the library's letters among them, its numbers among them), as ranges of a class.

    `pieces_by_line` gives the number of pieces into which the library's pre-tokenizer cuts each string.
    """
    codes = list(_questions())
    pieces = pieces_by_line([f"{first}{chr(c)}" for first in "a1" for c in codes])
    letters, numbers = ([n == 1 for n in part] for part in (pieces[: len(codes)], pieces[len(codes) :]))
    differ, as_letter, as_number = [], [], []
    for code, is_letter, is_number in zip(codes, letters, numbers, strict=True):
        theirs = "L" if is_letter else "N" if is_number else "O"
        char = chr(code)
        ours = "L" if regex.match(r"\p{L}", char) else "N" if regex.match(r"\p{N}", char) else "O"
        if theirs != ours:
            differ.append(code)
            if theirs == "L":
                as_letter.append(code)
            elif theirs == "N":
                as_number.append(code)
    return _ranges(differ), _ranges(as_letter), _ranges(as_number)


@lru_cache(maxsize=8)
def _compiled(pattern: str, differ: str, letters: str, numbers: str):
    plain = regex.compile(pattern)
    if not differ:
        return plain, None, None
    own = pattern
    for name, added in ((r"\p{L}", letters), (r"\p{N}", numbers)):
        inner = rf"[\p{{{name[3]}}}--[{differ}]]" + (f"||[{added}]" if added else "")
        # inside a negated class the set operations nest; outside they form a class of their own
        own = own.replace(rf"[^\s\p{{L}}{name}]", r"[^\s\p{L}\p{N}]")
        own = own.replace(name, f"[{inner}]")
    return plain, re.compile(f"[{differ}]"), regex.compile(own, regex.V1)


def _in_latin_1(text: str) -> bool:
    """Characters up to U+00FF are in no dispute, and this is the fastest look at all of them."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def pretoken_lists(text: str, spec: tuple[str, str, str, str]) -> Iterator[list[str]]:
    """The pre-tokens of a text in order, in lists of bounded length."""
    plain, odd, own = _compiled(*spec)
    pattern = own if odd is not None and not _in_latin_1(text) and odd.search(text) else plain
    if len(text) <= LIST_ROWS * 4:
        yield pattern.findall(text)
        return
    matches = (m.group() for m in pattern.finditer(text))
    while part := list(islice(matches, LIST_ROWS)):
        yield part
