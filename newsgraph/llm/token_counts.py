"""Token counts by a map-side two-tier lookup of pre-token lengths.

First tier: a compact hash table with the lengths of frequent pre-tokens, broadcast. Second tier: a bounded cache in each
Python worker, filled by the tokenizer itself. No pre-token is ever shuffled, and what is in either tier changes only the
speed: a length is the tokenizer's own, whoever looks it up.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm import pretokens
from newsgraph.llm.batches import map_texts

# The first tier is learnt from so many rows and holds at most so many pre-tokens of at most so many characters, so the
# broadcast stays under 5 MB whatever the corpus. Neither bound touches a count.
SAMPLE_ROWS = 1_000
TABLE_ROWS = 50_000
CACHE_ROWS = 500_000
CACHED_CHARS = 64


class Tokenizer:
    """What a task needs of a byte-level BPE tokenizer file: plain strings, so that it travels as it is."""

    def __init__(self, definition: str, pattern: str):
        self.definition = definition
        parts = json.loads(definition)
        first = parts["pre_tokenizer"] or {}
        if first.get("type") != "ByteLevel" or first.get("add_prefix_space") or not first.get("use_regex"):
            raise ValueError("only byte-level BPE without a prefix space can be counted pre-token by pre-token")
        if parts["normalizer"] or parts["truncation"] or parts["padding"] or parts["model"].get("dropout"):
            raise ValueError("normalisation, truncation, padding and dropout are not expected here")
        added = parts["added_tokens"]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added):
            raise ValueError("only plain special strings are expected")
        # the library cuts these strings out of a text first, the longest at each place
        self.special = tuple(sorted((a["content"] for a in added), key=len, reverse=True))
        splitter = _library(definition).pre_tokenizer

        def pieces_by_line(strings: list[str]) -> list[int]:
            ends, position = [], 0
            for s in strings:
                position += len(s) + 1
                ends.append(position)
            counts, line = [0] * len(strings), 0
            for _, (start, end) in splitter.pre_tokenize_str("\n".join(strings) + "\n"):
                while start >= ends[line]:
                    line += 1
                counts[line] += end != ends[line]
            return counts

        self.spec = (pattern, *pretokens.disputed(pieces_by_line))


@lru_cache(maxsize=2)
def _library(definition: str):
    import tokenizers

    return tokenizers.Tokenizer.from_str(definition)


def _alphabet() -> dict[int, int]:
    """How byte-level vocabularies spell bytes: printable Latin-1 as itself, the rest in order from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: 0x100 + i for i, b in enumerate(rest)}


_ALPHABET = _alphabet()


def _spelt(pretoken: str) -> str:
    return pretoken.encode().decode("latin-1").translate(_ALPHABET)


@lru_cache(maxsize=4)
def _specials(strings: tuple[str, ...]):
    return regex.compile("|".join(regex.escape(s) for s in strings)) if strings else None


class _Lengths(dict):
    """Pre-token to number of tokens: the broadcast tier, then the worker's own cache, then the tokenizer."""

    def __init__(self, frequent: dict[str, int], definition: str):
        super().__init__(frequent)
        self.frequent = frequent
        self.tokenize = _library(definition).model.tokenize

    def __missing__(self, pretoken: str) -> int:
        length = len(self.tokenize(_spelt(pretoken)))
        if len(pretoken) <= CACHED_CHARS:
            self[pretoken] = length
        return length

    def count(self, text: str, special: tuple[str, ...], spec: tuple[str, str, str, str]) -> int:
        if len(self) > len(self.frequent) + CACHE_ROWS:
            self.clear()
            self.update(self.frequent)
        total, parts = 0, [text]
        cut = _specials(special)
        if cut is not None and cut.search(text):
            parts = cut.split(text)
            total = len(parts) - 1
        look = self.__getitem__
        return total + sum(sum(map(look, listed)) for part in parts for listed in pretokens.pretoken_lists(part, spec))


@lru_cache(maxsize=2)
def _worker_lengths(key: int, definition: str, frequent: tuple) -> _Lengths:
    return _Lengths(dict(frequent), definition)


def frequent_lengths(
    df: DataFrame, tokenizer: Tokenizer, text: str = "text", sample_rows: int = SAMPLE_ROWS, table_rows: int = TABLE_ROWS
) -> list[tuple[str, int]]:
    """The most frequent pre-tokens of the first `sample_rows` rows with their lengths, at most `table_rows` of them.

    Taking a few rows reads a few partitions and shuffles nothing. An empty table gives an empty list.
    """
    seen: Counter[str] = Counter()
    for row in df.select(text).limit(sample_rows).collect():
        for listed in pretokens.pretoken_lists(row[0] or "", tokenizer.spec):
            seen.update(p for p in listed if len(p) <= CACHED_CHARS)
    kept = sorted(seen, key=lambda p: (-seen[p], p))[:table_rows]
    tokenize = _library(tokenizer.definition).model.tokenize
    return [(p, len(tokenize(_spelt(p)))) for p in kept]


def count_tokens(
    df: DataFrame, tokenizer: Tokenizer, text: str = "text", output: str = "n_tokens", frequent: list[tuple[str, int]] | None = None
) -> DataFrame:
    """Add `output`: the number of tokens of the whole text; null and empty texts have none.

    Special strings inside a text count as one token each, as the library does by default. Rows are independent: repeated
    rows give repeated counts, an empty table an empty one, other columns pass through. A very long text is counted list
    by list, and a pre-token over 64 characters is encoded without entering the cache.
    """
    table = frequent_lengths(df, tokenizer, text) if frequent is None else frequent
    shared = df.sparkSession.sparkContext.broadcast((tokenizer.definition, tokenizer.special, tokenizer.spec, tuple(table)))

    def apply(texts: list) -> list[list[int]]:
        definition, special, spec, first_tier = shared.value
        lengths = _worker_lengths(id(first_tier), definition, first_tier)
        return [[lengths.count(t, special, spec) if t else 0 for t in texts]]

    return map_texts(df, text, [(output, T.LongType(), pa.int64())], apply)


def budget(docs: DataFrame, tokenizer: Tokenizer, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the text has more than `limit` tokens."""
    counted = count_tokens(docs.select("doc_id", "text"), tokenizer)
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
