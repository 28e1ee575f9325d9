"""String similarity for candidate pairs, in built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# From this length of the second string on, characters that make up more than one in a hundred begin no block.
_POPULAR_FROM = 200


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _int(value: int) -> Column:
    return F.lit(value).cast("int")


def _run(a: Column, b: Column, i: Column, j: Column, step: int, most: Column) -> Column:
    """How many elements in a row are equal from a[i] and b[j] on, going by `step`, at most `most`."""
    start = F.struct(_int(0).alias("n"), F.lit(True).alias("open"))

    def on(s: Column, k: Column) -> Column:
        same = s["open"] & (F.get(a, i + step * k) == F.get(b, j + step * k))
        return F.struct(F.when(same, s["n"] + 1).otherwise(s["n"]).alias("n"), same.alias("open"))

    return F.when(most > 0, F.aggregate(F.sequence(_int(0), most - 1), start, on)["n"]).otherwise(0)


def _longest_block(a: Column, b: Column, starts: Column, r: Column) -> Column:
    """(i, j, k): the longest common block of a[alo:ahi] and b[blo:bhi], the first in `a`, then in `b`, among the longest.

    One row of lengths of common suffixes after the other; only positions of `b` that `starts` allows count. The block then
    grows over equal neighbours of any kind.
    """
    row_start = F.struct(
        F.array_repeat(_int(0), r["bhi"] - r["blo"]).alias("row"), _int(0).alias("k"), r["alo"].alias("i"), r["blo"].alias("j")
    )

    def next_row(s: Column, i: Column) -> Column:
        def length(j: Column) -> Column:
            hit = (F.get(a, i) == F.get(b, j)) & F.get(starts, j)
            return F.when(hit, F.coalesce(F.get(s["row"], j - r["blo"] - 1), _int(0)) + 1).otherwise(_int(0))

        def with_best(row: Column) -> Column:
            def chosen(most: Column) -> Column:
                better = most > s["k"]
                end = r["blo"] + F.array_position(row, most).cast("int")
                return F.struct(
                    row.alias("row"), F.when(better, most).otherwise(s["k"]).alias("k"),
                    F.when(better, i - most + 1).otherwise(s["i"]).alias("i"), F.when(better, end - most).otherwise(s["j"]).alias("j"),
                )

            return _let(F.array_max(row), chosen)

        return _let(F.transform(F.sequence(r["blo"], r["bhi"] - 1), length), with_best)

    def grown(s: Column) -> Column:
        left = _run(a, b, s["i"] - 1, s["j"] - 1, -1, F.least(s["i"] - r["alo"], s["j"] - r["blo"]))
        end_a, end_b = s["i"] + s["k"], s["j"] + s["k"]
        right = _run(a, b, end_a, end_b, 1, F.least(r["ahi"] - end_a, r["bhi"] - end_b))
        left = F.when(F.size(b) >= _POPULAR_FROM, F.when(s["k"] > 0, left).otherwise(0)).otherwise(0)
        right = F.when(F.size(b) >= _POPULAR_FROM, right).otherwise(0)
        return F.struct((s["i"] - left).alias("i"), (s["j"] - left).alias("j"), (s["k"] + left + right).alias("k"))

    return _let(F.aggregate(F.sequence(r["alo"], r["ahi"] - 1), row_start, next_row), grown)


def _matched(a: Column, b: Column) -> Column:
    """Elements in common blocks: the longest one, then those on either side of it, by a stack of ranges."""
    counts = F.transform(b, lambda x: F.size(F.filter(b, lambda y: y == x)))
    starts = F.when(F.size(b) < _POPULAR_FROM, F.transform(b, lambda x: F.lit(True))).otherwise(
        F.transform(counts, lambda n: n <= F.floor(F.size(b) / 100) + 1)
    )
    range_of = lambda alo, ahi, blo, bhi: F.struct(alo.alias("alo"), ahi.alias("ahi"), blo.alias("blo"), bhi.alias("bhi"))
    some = lambda r: (r["alo"] < r["ahi"]) & (r["blo"] < r["bhi"])
    whole = F.array(range_of(_int(0), F.size(a), _int(0), F.size(b)))

    def folded(allowed: Column) -> Column:
        def step(s: Column, _: Column) -> Column:
            top, rest = F.element_at(s["stack"], -1), F.slice(s["stack"], 1, F.size(s["stack"]) - 1)

            def split(block: Column) -> Column:
                sides = F.array(
                    range_of(top["alo"], block["i"], top["blo"], block["j"]),
                    range_of(block["i"] + block["k"], top["ahi"], block["j"] + block["k"], top["bhi"]),
                )
                more = F.when(block["k"] > 0, F.concat(rest, F.filter(sides, some))).otherwise(rest)
                return F.struct(more.alias("stack"), (s["total"] + block["k"]).alias("total"))

            return F.when(F.size(s["stack"]) == 0, s).otherwise(_let(_longest_block(a, b, allowed, top), split))

        turns = F.sequence(_int(1), 2 * F.least(F.size(a), F.size(b)) + 1)
        return F.aggregate(turns, F.struct(whole.alias("stack"), _int(0).alias("total")), step)["total"]

    return _let(starts, folded)


def _letters(text: Column) -> Column:
    return F.transform(F.sequence(_int(1), F.char_length(text)), lambda i: F.substring(text, i, F.lit(1)))


def matching_ratio(left: Column, right: Column) -> Column:
    """Ratcliff-Obershelp ratio of the lower-case strings: twice the matched characters over all characters.

    Two empty strings give 1. A string inside the other one matches whole, so only others are searched block by block.
    """
    a, b = F.lower(left), F.lower(right)
    shorter, both = F.least(F.char_length(a), F.char_length(b)), F.char_length(a) + F.char_length(b)
    inside = (F.char_length(b) < _POPULAR_FROM) & (F.contains(a, b) | F.contains(b, a))
    searched = _let(_letters(a), lambda x: _let(_letters(b), lambda y: _matched(x, y)))
    matched = F.when((shorter == 0) | inside, shorter).otherwise(searched)
    return F.when(left.isNotNull() & right.isNotNull(), F.when(both == 0, F.lit(1.0)).otherwise(2.0 * matched / both))


def levenshtein_ratio(left: Column, right: Column) -> Column:
    """Built-in alternative: 1 - edit distance / longer length, on lower-case strings; two empty strings give 1."""
    longest = F.greatest(F.char_length(left), F.char_length(right))
    distance = F.levenshtein(F.lower(left), F.lower(right))
    return F.when(longest == 0, F.lit(1.0)).otherwise(F.lit(1.0) - distance / longest)


def trigrams(text: Column) -> Column:
    """Distinct 3-character pieces of the lower-case text, padded by two blanks before and one after."""
    padded = F.concat(F.lit("  "), F.lower(text), F.lit(" "))
    starts = F.sequence(F.lit(1), F.char_length(text) + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(3))))


def trigram_codes(text: Column) -> Column:
    """The trigrams as numbers, 21 bits a character."""
    code = lambda g, i: F.ascii(F.substring(g, i, 1)).cast("long")
    return F.transform(
        trigrams(text), lambda g: F.shiftleft(code(g, 1), 42).bitwiseOR(F.shiftleft(code(g, 2), 21)).bitwiseOR(code(g, 3))
    )
