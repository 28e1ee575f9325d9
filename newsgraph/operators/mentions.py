"""Typed mentions: attribute types by pattern, entity types by dictionary.

A text is cut into pieces by one left-to-right scan (`lexicon.PIECE`); `pos` is the index of a mention's first piece.
Attribute mentions are single pieces, so finding them is a projection. Entity mentions are runs of word pieces found in a
dictionary `gazetteer(term, label)` of lower-case terms; the lengths to look for are those of its terms.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsgraph import lexicon as lx
from newsgraph.functions import text as tx
from newsgraph.operators.scale import broadcast_if_small

# Hits of an island up to which each one is compared with all that are taken; in larger ones places are marked instead.
SMALL_ISLAND = 24
# Places, and taken hits, of one piece of the arrays that a large island builds up.
_PIECE = 256
# Lengths to look for where no dictionary says.
WORD_LENGTHS = (1, 2, 3)


def term_lengths(gazetteer: DataFrame) -> tuple[int, ...]:
    """Numbers of words that terms of the dictionary have, in order; a handful of numbers, combined before the shuffle."""
    words = F.size(F.split(F.col("term"), " "))
    return tuple(sorted(r["n"] for r in gazetteer.where("term is not null").select(words.alias("n")).distinct().collect()))


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(tx.filled(text), F.lit(lx.PIECE), F.lit(0))


def attribute_label(piece: Column) -> Column:
    """First attribute type whose pattern matches the whole piece, else null."""
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, pattern in lx.ATTRIBUTE_PATTERNS:
        label = label.when(piece.rlike(rf"^(?:{pattern})$"), name)
    return label


# One test for "is any attribute type" keeps the seven patterns away from ordinary words.
_ANY_ATTRIBUTE = "^(?:" + "|".join(pattern for _, pattern in lx.ATTRIBUTE_PATTERNS) + ")$"


def _may_be_attribute(piece: Column) -> Column:
    """Cheap necessary condition: a digit, currency sign or capital at the start, or a number word."""
    return piece.rlike(r"^[\p{Nd}$€£¥\p{Lu}]") | F.lower(piece).isin(lx.NUMBER_WORDS)


def _may_start(piece: Column, capitalised: bool) -> Column:
    """Whether a piece begins a run of words or may be an attribute. Most begin with a to z, and need no pattern."""
    begins = F.lit(not capitalised) | F.lower(piece).isin(lx.NUMBER_WORDS)
    return F.when((piece >= "a") & (piece < "{"), begins).otherwise(piece.rlike(_first_letter(capitalised)) | _may_be_attribute(piece))


def attribute_mentions(articles: DataFrame, text: str = "text") -> DataFrame:
    """(article_id, pos, words, text, label) of the attribute types, in text order. No shuffle."""
    found = articles.select("article_id", F.posexplode(pieces(F.col(text))).alias("pos", "text"))
    return (
        found.where(_may_be_attribute(F.col("text")) & F.col("text").rlike(_ANY_ATTRIBUTE))
        .select("article_id", "pos", F.lit(1).alias("words"), "text", attribute_label(F.col("text")).alias("label"))
    )


def _word_run(run: Column) -> Column:
    """The leading pieces of a run that are words."""
    stop = F.array_position(F.transform(run, lambda p: ~p.rlike(rf"^[{lx.WORD}]+$")), True).cast("int")
    return F.when(stop == 0, run).otherwise(F.slice(run, F.lit(1), stop - 1))


def _starts(articles: DataFrame, text: str, begins: Callable[[Column], Column], reach: int) -> DataFrame:
    """(article_id, pos, run): every piece that `begins`, with the pieces after it up to `reach` in all. One scan of the text."""
    cut = articles.select("article_id", pieces(F.col(text)).alias("_pieces"))
    places = F.filter(F.sequence(F.lit(0), F.size("_pieces") - 1), lambda i: begins(F.get("_pieces", i)))
    wanted = cut.select("article_id", "_pieces", F.when(F.size("_pieces") > 0, places).alias("_places"))
    # Runs are cut before the array is exploded: a row must not carry the pieces of its whole article.
    runs = F.transform("_places", lambda i: F.struct(i.alias("pos"), F.slice("_pieces", i + 1, reach).alias("run")))
    return wanted.select("article_id", F.explode(runs).alias("s")).select("article_id", "s.pos", "s.run")


def _grams(run: Column, lengths: Sequence[int]) -> Column:
    """The leading parts of a run of words that have one of the lengths, as struct<words, text, term, label>."""
    def gram(n: Column) -> Column:
        text = F.array_join(F.slice(run, F.lit(1), n), " ")
        return F.struct(n.alias("words"), text.alias("text"), F.lower(text).alias("term"), F.lit(None).cast("string").alias("label"))

    return F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.size(run)), gram)


def _first_letter(capitalised: bool) -> str:
    return r"^\p{Lu}" if capitalised else rf"^[{lx.WORD}]"


def ngrams(articles: DataFrame, text: str = "text", capitalised: bool = True, lengths: Sequence[int] = WORD_LENGTHS) -> DataFrame:
    """(article_id, pos, words, text, term) for every run of word pieces with one of the lengths. No shuffle.

    With `capitalised` a run must start with an upper-case letter, as names do.
    """
    starts = _starts(articles, text, lambda p: p.rlike(_first_letter(capitalised)), max(lengths)).withColumn("run", _word_run(F.col("run")))
    starts = starts.where(F.size("run") > 0)
    return starts.select("article_id", "pos", F.explode(_grams(F.col("run"), lengths)).alias("g")).select(
        "article_id", "pos", "g.words", "g.text", "g.term"
    )


def dictionary_hits(articles: DataFrame, gazetteer: DataFrame, text: str = "text", capitalised: bool = True) -> DataFrame:
    """Every dictionary term found, overlapping ones included."""
    entries = gazetteer.select("term", "label")
    grams = ngrams(articles, text, capitalised, term_lengths(gazetteer) or WORD_LENGTHS)
    return grams.join(broadcast_if_small(entries), "term").select("article_id", "pos", "words", "text", "label")


def all_hits(articles: DataFrame, gazetteer: DataFrame, text: str = "text", capitalised: bool = True) -> DataFrame:
    """Dictionary terms and attribute mentions together, overlapping ones included, from one scan of the text."""
    lengths = term_lengths(gazetteer) or WORD_LENGTHS
    starts = _starts(articles, text, lambda p: _may_start(p, capitalised), max(lengths))
    starts = starts.withColumn("first", F.get("run", F.lit(0)))
    is_start = F.col("first").rlike(_first_letter(capitalised))
    starts = starts.select(
        "article_id", "pos", F.when(F.col("first").rlike(_ANY_ATTRIBUTE), F.col("first")).alias("attribute"),
        F.when(is_start, _word_run(F.col("run"))).otherwise(F.slice("run", 1, 0)).alias("run"),
    )
    # The term of an attribute cannot be in a dictionary; it differs by text so that a shuffle join spreads such rows.
    attribute = F.struct(
        F.lit(1).alias("words"), F.col("attribute").alias("text"), F.concat(F.lit("\u0000"), "attribute").alias("term"),
        attribute_label(F.col("attribute")).alias("label"),
    )
    none = F.array().cast("array<struct<words:int,text:string,term:string,label:string>>")
    candidates = F.concat(
        F.when(F.col("attribute").isNotNull(), F.array(attribute)).otherwise(none),
        F.when(F.size("run") > 0, _grams(F.col("run"), lengths)).otherwise(none),
    )
    rows = starts.select("article_id", "pos", F.explode(candidates).alias("c")).select("article_id", "pos", "c.*")
    entries = gazetteer.select("term", F.col("label").alias("_entry"))
    joined = rows.join(broadcast_if_small(entries), "term", "left")
    return joined.select("article_id", "pos", "words", "text", F.coalesce("label", "_entry").alias("label")).where("label is not null")


def _taken(hits: Column) -> Column:
    """Hits in order, but for those that overlap one taken before: each is compared with all that are."""
    def take(taken: Column, h: Column) -> Column:
        clash = F.exists(taken, lambda t: (t["pos"] < h["pos"] + h["words"]) & (h["pos"] < t["pos"] + t["words"]))
        return F.when(clash, taken).otherwise(F.array_append(taken, h))

    return F.aggregate(hits, F.slice(hits, 1, 0), take)


def _taken_by_place(hits: Column) -> Column:
    """The same, in time that grows with the number of hits, not with its square.

    Hits come from the longest to the shortest, so one that overlaps a taken hit has its first or its last place in it:
    two looks at the places that are marked. Marks and taken hits are kept in pieces, so that a step copies a piece of
    either and not the whole.
    """
    base = F.array_min(F.transform(hits, lambda h: h["pos"]))
    last = F.array_max(F.transform(hits, lambda h: h["pos"] + h["words"])) - 1
    rows = F.sequence(F.lit(0), F.floor((last - base) / _PIECE).cast("int"))
    none = F.slice(hits, 1, 0)
    start = F.struct(
        F.transform(rows, lambda _: F.array_repeat(F.lit(False), _PIECE)).alias("marks"), F.slice(F.array(none), 1, 0).alias("full"), none.alias("part"),
        base.cast("int").alias("base"),
    )

    def marked(s: Column, place: Column) -> Column:
        return F.get(F.get(s["marks"], F.floor(place / _PIECE).cast("int")), place % _PIECE)

    def take(s: Column, h: Column) -> Column:
        first = h["pos"] - s["base"]
        end = first + h["words"] - 1

        def with_marks(piece: Column, row: Column) -> Column:
            at = row * _PIECE
            touched = (at <= end) & (first < at + _PIECE)
            return F.when(touched, F.transform(piece, lambda m, i: m | (at + i).between(first, end))).otherwise(piece)

        full = F.size(s["part"]) >= _PIECE
        more = F.struct(
            F.transform(s["marks"], with_marks).alias("marks"), F.when(full, F.array_append(s["full"], s["part"])).otherwise(s["full"]).alias("full"),
            F.when(full, F.array(h)).otherwise(F.array_append(s["part"], h)).alias("part"), s["base"].alias("base"),
        )
        return F.when(marked(s, first) | marked(s, end), s).otherwise(more)

    return F.aggregate(hits, start, take, lambda s: F.flatten(F.array_append(s["full"], s["part"])))


def without_overlaps(hits: DataFrame) -> DataFrame:
    """Take hits from the longest to the shortest, equally long ones from left to right, unless they overlap one taken.

    Of several labels at the same place and length the first in the taxonomy's order stays. Hits that overlap, directly
    or through others, form an island; one window per article finds where an island ends, and each is settled on its own.
    """
    labels = lx.ENTITY_TYPES + lx.ATTRIBUTE_TYPES
    position = F.array_position(F.array(*[F.lit(name) for name in labels]), F.col("label"))
    priority = F.when(position == 0, len(labels) + 1).otherwise(position)
    before = Window.partitionBy("article_id").orderBy("pos", "words", "label").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("article_id").orderBy("pos", "words", "label").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.max(F.col("pos") + F.col("words")).over(before) <= F.col("pos"), F.lit(True))
    islands = hits.withColumn("_opens", opens.cast("int")).withColumn("_island", F.sum("_opens").over(so_far))
    hit = F.struct((-F.col("words")).alias("shorter"), "pos", priority.alias("priority"), "label", "words", "text")
    listed = islands.groupBy("article_id", "_island").agg(F.sort_array(F.collect_list(hit)).alias("_hits"))

    # a list of one needs no folding, and most lists are of one
    size = F.size("_hits")
    kept = F.when(size == 1, F.col("_hits")).when(size <= SMALL_ISLAND, _taken(F.col("_hits"))).otherwise(_taken_by_place(F.col("_hits")))
    return listed.select("article_id", F.explode(kept).alias("h")).select("article_id", "h.pos", "h.words", "h.text", "h.label")


def entity_mentions(articles: DataFrame, gazetteer: DataFrame, text: str = "text", capitalised: bool = True) -> DataFrame:
    """(article_id, pos, words, text, label) of the entity types."""
    return without_overlaps(dictionary_hits(articles, gazetteer, text, capitalised))


def all_mentions(articles: DataFrame, gazetteer: DataFrame | None = None, text: str = "text", capitalised: bool = True) -> DataFrame:
    """(article_id, pos, text, label), both kinds. A piece with an attribute label at an entity's place gives way."""
    if gazetteer is None:
        return attribute_mentions(articles, text).select("article_id", "pos", "text", "label")
    return without_overlaps(all_hits(articles, gazetteer, text, capitalised)).select("article_id", "pos", "text", "label")


def mention_lists(articles: DataFrame, mentions: DataFrame) -> DataFrame:
    """(article_id, mentions ARRAY<STRUCT<pos,text,label>>) in text order; an article without mentions has an empty one.

    A list never outgrows the article it comes from.
    """
    lists = mentions.groupBy("article_id").agg(F.sort_array(F.collect_list(F.struct("pos", "text", "label"))).alias("mentions"))
    empty = F.array().cast("array<struct<pos:int,text:string,label:string>>")
    return articles.select("article_id").join(lists, "article_id", "left").withColumn("mentions", F.coalesce("mentions", empty))


def explode_mentions(lists: DataFrame) -> DataFrame:
    """Inverse of `mention_lists`."""
    return lists.select("article_id", F.explode("mentions").alias("m")).select("article_id", "m.pos", "m.text", "m.label")


def mentions_by_label(mentions: DataFrame) -> DataFrame:
    """(article_id, groups MAP<label, ARRAY<text>>), texts in order of appearance."""
    per_label = mentions.groupBy("article_id", "label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda m: m["text"]).alias("texts")
    )
    return per_label.groupBy("article_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "texts")))).alias("groups")
    )
