"""Exact removal of repeated word windows, by super-k-mers.

A window is 13 consecutive words. Its minimiser is the 4-word gram in it whose hash is least, so equal windows have equal
minimisers, and consecutive windows that share one form a super-k-mer: a run of words that travels as one packed string
to the bucket of its minimiser. Minimisers that only one document has are found first, from hashes alone; their runs
never travel. In a bucket the runs are sorted by document, so whoever brings a window first has the smallest id.
Buckets above a size are not gathered: their windows are spread by digest and settled by a grouping and a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm.batches import fresh_name, slices

# Fixed by the contract.
WINDOW = 13
GRAM = 4
# A bucket that more documents reach than this is settled by classes of equal runs instead of in one task.
BUCKET_ROWS = 4_096
# Buckets are named by so many bits of the hash: enough for the largest corpus, and fewer bytes to shuffle.
MINI_MASK = np.int64((1 << 48) - 1)
# Words are hashed in segments of about so many bytes; a longer single word is hashed on its own.
SEGMENT = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_tables: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for one segment."""
    if not _tables:
        for base in (_BASE, _INVERSE):
            factors = np.full(SEGMENT + 1, base, dtype=np.uint64)
            factors[0] = 1
            _tables.append(np.multiply.accumulate(factors))
    return _tables[0], _tables[1]


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word of `data`. Equal words have equal hashes wherever they stand."""
    power, inverse = _powers()
    hashes, firsts, at = [], [], 0
    whole = np.frombuffer(data, dtype=np.uint8)
    while at < len(data):
        part = whole[at : at + SEGMENT]
        blank = _BLANK[part]
        if len(part) == SEGMENT:
            places = np.flatnonzero(blank)
            if not len(places):  # a word of a segment or more, at the end of the data or not
                end = at + SEGMENT
                while end < len(data) and not _BLANK[whole[end]]:
                    ahead = np.flatnonzero(_BLANK[whole[end : end + SEGMENT]])
                    end = end + int(ahead[0]) if len(ahead) else min(end + SEGMENT, len(data))
                hashes.append(np.array([xxhash.xxh64_intdigest(data[at:end])], dtype=np.uint64))
                firsts.append(np.array([at]))
                at = end
                continue
            part, blank = part[: places[-1] + 1], blank[: places[-1] + 1]
        edges = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        begin, end = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], dtype=np.uint64)])
        hashes.append(_mixed((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64)))
        firsts.append(begin + at)
        at += len(part)
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *hashes]), np.concatenate([none.astype(np.int64), *firsts])


def super_kmers(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first word in the text, number of windows, minimiser) of every maximal run of windows."""
    encoded = [t.encode() for t in texts]
    starts = np.cumsum([0, *[len(e) + 1 for e in encoded]])[:-1] if encoded else np.empty(0, dtype=np.int64)
    hashes, firsts = word_hashes(b"\n".join(encoded))
    none = np.empty(0, dtype=np.int64)
    if len(hashes) < WINDOW:
        return none, none, none, none
    owner = np.searchsorted(starts, firsts, side="right") - 1
    grams = hashes[: len(hashes) - GRAM + 1].copy()
    for k in range(1, GRAM):
        grams = _mixed(grams + _BASE) + hashes[k : len(hashes) - GRAM + 1 + k]
    grams = _mixed(grams)
    count = len(hashes) - WINDOW + 1
    least, offset = grams[:count].copy(), np.zeros(count, dtype=np.int64)
    for k in range(1, WINDOW - GRAM + 1):
        lower = grams[k : k + count] < least
        least[lower] = grams[k : k + count][lower]
        offset[lower] = k
    anchor = np.arange(count) + offset
    inside = owner[:count] == owner[WINDOW - 1 :]
    breaks = np.ones(count, dtype=bool)
    breaks[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1] | ~inside[1:]
    first = np.flatnonzero(breaks)
    length = np.diff(np.append(first, count))
    real = inside[first]
    first, length = first[real], length[real]
    word_base = np.searchsorted(owner, np.arange(len(texts)), side="left")
    return owner[first], first - word_base[owner[first]], length, least[first].view(np.int64) & MINI_MASK


def _minimisers(docs: DataFrame) -> DataFrame:
    """mini, doc_id, tag: the distinct minimisers of every row; rows with a null text have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, _, _, mini = super_kmers([t or "" for t in part.column(2).to_pylist()])
                order = np.lexsort((mini, owner))
                owner, mini = owner[order], mini[order]
                new = np.ones(len(mini), dtype=bool)
                new[1:] = (owner[1:] != owner[:-1]) | (mini[1:] != mini[:-1])
                taken = pa.array(owner[new])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mini[new]), part.column(0).take(taken), part.column(1).take(taken)], names=["mini", "doc_id", "tag"]
                )

    rest = [c for c in docs.columns if c not in ("doc_id", "tag", "text")]
    schema = T.StructType([T.StructField("mini", T.LongType()), docs.schema["doc_id"], T.StructField("tag", T.IntegerType())])
    return docs.select("doc_id", "tag", "text", *rest).mapInArrow(run, schema)


def _packed(joined: DataFrame) -> DataFrame:
    """mini, doc_id, tag, starts, words: every distinct run of a row with a listed minimiser, packed, and where it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, minis, starts, packed = [], [], [], []
                texts = [t or "" for t in part.column(2).to_pylist()]
                listed = part.column(3)
                owner, first, length, mini = super_kmers(texts)
                ends = np.searchsorted(owner, np.arange(len(texts) + 1))
                for row, text in enumerate(texts):
                    if not text or not listed[row].is_valid:
                        continue
                    own = slice(ends[row], ends[row + 1])
                    chosen = np.flatnonzero(np.isin(mini[own], listed[row].values.to_numpy()))
                    tokens, places = text.encode().split(), {}
                    for run_mini, at, windows in zip(*[column[own][chosen].tolist() for column in (mini, first, length)], strict=True):
                        places.setdefault((run_mini, b" ".join(tokens[at : at + windows + WINDOW - 1])), []).append(at)
                    for (run_mini, words), at in places.items():
                        rows.append(row)
                        minis.append(run_mini)
                        starts.append(at)
                        packed.append(words)
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(minis, pa.int64()), part.column(0).take(taken), part.column(1).take(taken),
                     pa.array(starts, pa.list_(pa.int32())), pa.array(packed, pa.binary())],
                    names=["mini", "doc_id", "tag", "starts", "words"],
                )

    schema = T.StructType([
        T.StructField("mini", T.LongType()), joined.schema["doc_id"], T.StructField("tag", T.IntegerType()),
        T.StructField("starts", T.ArrayType(T.IntegerType())), T.StructField("words", T.BinaryType()),
    ])
    rest = [c for c in joined.columns if c not in ("doc_id", "tag", "text", "minis")]
    return joined.select("doc_id", "tag", "text", "minis", *rest).mapInArrow(run, schema)


def _window_bytes(words: bytes) -> Iterator[bytes]:
    """The windows of a packed run in order."""
    tokens = words.split(b" ")
    offsets = [0, *accumulate(len(t) + 1 for t in tokens)]
    return (words[offsets[i] : offsets[i + WINDOW] - 1] for i in range(len(tokens) - WINDOW + 1))


def _intervals(places: list[int]) -> list[tuple[int, int]]:
    """Windows at increasing places as intervals of words."""
    out: list[list[int]] = []
    for place in places:
        if out and place <= out[-1][1]:
            out[-1][1] = place + WINDOW
        else:
            out.append([place, place + WINDOW])
    return [(a, b) for a, b in out]


def _settled_in_buckets(packed: DataFrame) -> DataFrame:
    """doc_id, tag, begin, end of words that an earlier document has too, bucket by bucket.

    Rows come sorted by minimiser and document, so the first to bring a window is its smallest document. What a task holds
    are the windows of one bucket, from at most BUCKET_ROWS documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, first_doc = None, {}
        for batch in batches:
            ids = batch.column(1).to_pylist()
            rows, begins, ends = [], [], []
            for row, (mini, starts, words) in enumerate(
                zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            ):
                if mini != bucket:
                    bucket, first_doc = mini, {}
                doc = ids[row]
                later = [i for i, w in enumerate(_window_bytes(words)) if first_doc.setdefault(w, doc) < doc]
                for begin, end in _intervals(later):
                    rows += [row] * len(starts)
                    begins += [start + begin for start in starts]
                    ends += [start + end for start in starts]
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(taken), batch.column(2).take(taken), pa.array(begins, pa.int32()), pa.array(ends, pa.int32())],
                names=["doc_id", "tag", "begin", "end"],
            )

    schema = T.StructType([
        packed.schema["doc_id"], T.StructField("tag", T.IntegerType()), T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ])
    ordered = packed.repartition("mini").sortWithinPartitions("mini", "doc_id")
    return ordered.mapInArrow(run, schema)


def _settled_by_window(packed: DataFrame) -> DataFrame:
    """doc_id, tag, spans: the same for buckets too large to gather.

    Equal runs are one class, reduced before the shuffle to their smallest document. The windows of the classes are
    grouped by digest, and each class gets the smallest document of each of its windows; every run looks its class up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, digests, places = [], [], []
            for row, words in enumerate(batch.column(2).to_pylist()):
                for i, window in enumerate(_window_bytes(words)):
                    rows.append(row)
                    digests.append(hashlib.blake2b(window, digest_size=16).digest())
                    places.append(i)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(digests, pa.binary()), pa.array(places, pa.int32())],
                names=["class", "low", "window", "place"],
            )

    ids = packed.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("class", T.BinaryType()), T.StructField("low", ids), T.StructField("window", T.BinaryType()), T.StructField("place", T.IntegerType()),
    ])
    runs = packed.withColumn("class", F.unhex(F.md5("words")))
    classes = runs.groupBy("class").agg(F.min("doc_id").alias("low"), F.max("words").alias("words"))
    windows = classes.mapInArrow(run, schema)
    lowest = windows.groupBy("window").agg(F.min("low").alias("lowest"))
    listed = windows.join(lowest, "window").groupBy("class").agg(F.collect_list(F.struct("place", "lowest")).alias("windows"))
    met = _split_join(runs.select("class", "doc_id", "tag", "starts"), listed, "class")
    later = F.filter("windows", lambda w: w["lowest"] < F.col("doc_id"))
    span = lambda start, w: F.struct((start + w["place"]).alias("begin"), (start + w["place"] + WINDOW).alias("end"))
    spans = F.flatten(F.transform("starts", lambda start: F.transform(later, lambda w: span(start, w))))
    return met.select("doc_id", "tag", spans.alias("spans")).where(F.size("spans") > 0)


def _split_join(many: DataFrame, grouped: DataFrame, key: str) -> DataFrame:
    """Join rows to a table grouped by `key` so that a key with very many rows can be split.

    The grouped side is dealt out by `key` already, and joined as it is it would tie each key to one task. Under another
    name of the key both sides are shuffled for the join, and the optimiser may divide a large partition of the first.
    """
    renamed = (lambda c: F.bitwise_not(c)) if isinstance(many.schema[key].dataType, T.LongType) else F.hex
    left = many.withColumn("_key", renamed(F.col(key)))
    right = grouped.withColumn("_key", renamed(F.col(key))).drop(key)
    return left.join(right, "_key").drop("_key")


def later_copies(docs: DataFrame) -> DataFrame:
    """doc_id, tag of rows whose whole text a smaller doc_id has too: known by digests alone, combined before the shuffle."""
    marked = docs.where("doc_id IS NOT NULL").select("doc_id", "tag", F.unhex(F.md5(F.col("text"))).alias("digest"))
    first = marked.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    return marked.join(first.select("digest", "low"), "digest").where("doc_id > low").select("doc_id", "tag").distinct()


def repeated_words(dealt: DataFrame, copies: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, tag, spans (array of begin, end) of the words of `dealt` that windows of earlier documents cover.

    `dealt` (doc_id, text, tag, ...) is dealt out by doc_id and tag. It is joined from the left and with all its columns,
    here and by the caller, so that Spark finds the same exchange each time and texts are shuffled once. Later copies of
    a whole text bring no windows that the first one does not bring; their only span is (-1, -1), which means all.
    """
    rest = [c for c in dealt.columns if c not in ("doc_id", "tag", "text")]
    marked = dealt.join(copies.withColumn("copied", F.lit(True)).hint("shuffle_hash"), ["doc_id", "tag"], "left")
    wanted = F.when(F.col("copied").isNull() & F.col("doc_id").isNotNull(), F.col("text")).alias("text")
    firsts = marked.select("doc_id", "tag", wanted, *rest)
    minis = _minimisers(firsts)
    shared = (
        minis.groupBy("mini")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("size"))
        .where("low < high")
        .select("mini", "size")
    )
    candidates = _split_join(minis, shared, "mini")

    def packed(chosen: DataFrame) -> DataFrame:
        listed = chosen.groupBy("doc_id", "tag").agg(F.collect_list("mini").alias("minis"))
        joined = dealt.join(listed, ["doc_id", "tag"], "left")
        return _packed(joined.withColumn("text", F.when(F.col("minis").isNotNull(), F.col("text"))))

    one = F.array(F.struct("begin", "end")).alias("spans")
    found = _settled_in_buckets(packed(candidates.where(F.col("size") <= bucket_rows))).select("doc_id", "tag", one)
    crowded = _settled_by_window(packed(candidates.where(F.col("size") > bucket_rows)))
    whole = copies.select("doc_id", "tag", F.lit(-1).alias("begin"), F.lit(-1).alias("end")).select("doc_id", "tag", one)
    every = found.unionByName(crowded).unionByName(whole)
    return every.groupBy("doc_id", "tag").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def without_repeats(docs: DataFrame, text: str = "text", bucket_rows: int = BUCKET_ROWS, keep_untouched: bool = False) -> DataFrame:
    """`docs` with `text` cut to the words that stay (joined by one space), and `n_words`, `n_removed` added.

    A word goes if a window that covers it also starts in a document with a smaller doc_id; windows are judged on the
    input. With `keep_untouched` a text that loses nothing stays as it is, blanks included, and a null stays null.
    Rows that share a doc_id are told apart by a hash of their text and never remove from each other; rows without an id
    neither remove nor lose anything. Null and empty texts have no words. An empty table gives an empty one. Other columns
    pass through; if one is called like a new one, the new one gets underscores in front.
    """
    n_words, n_removed = fresh_name(docs, "n_words"), fresh_name(docs, "n_removed")
    others = [c for c in docs.columns if c not in ("doc_id", text)]
    given, tag = F.coalesce(F.col(text), F.lit("")), F.pmod(F.xxhash64(text), F.lit(1 << 16)).cast("int").alias("tag")
    row = F.struct(F.col(text).isNull().alias("was_null"), *[F.col(f"`{c}`") for c in others]).alias("row")
    whole = docs.select("doc_id", given.alias("text"), tag, *([row] if others or keep_untouched else []))
    dealt = whole.repartition("doc_id", "tag")
    joined = dealt.join(repeated_words(dealt, later_copies(whole), bucket_rows), ["doc_id", "tag"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                kept, counts, removed = [], [], []
                for value, listed in zip(part.column(part.schema.get_field_index("text")).to_pylist(),
                                         part.column(part.schema.get_field_index("spans")).to_pylist(), strict=True):
                    words = value.encode().split()
                    counts.append(len(words))
                    if not listed:
                        removed.append(0)
                        kept.append(value if keep_untouched else b" ".join(words).decode())
                        continue
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    for s in listed:
                        if s["begin"] < 0:  # a later copy of a whole text
                            gone[0] += len(words) >= WINDOW
                            continue
                        gone[s["begin"]] += 1
                        gone[s["end"]] -= 1
                    stays = np.cumsum(gone[:-1]) == 0
                    removed.append(int(len(words) - stays.sum()))
                    kept.append(b" ".join([words[i] for i in np.flatnonzero(stays)]).decode())
                columns = [part.column(part.schema.get_field_index(c)) for c in carried]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                    names=[*carried, "_kept", "_words", "_removed"],
                )

    carried = [c for c in ("doc_id", "row") if c in joined.columns]
    added = [T.StructField("_kept", T.StringType()), T.StructField("_words", T.LongType()), T.StructField("_removed", T.LongType())]
    done = joined.select(*carried, "text", "spans").mapInArrow(cut, T.StructType([*[joined.schema[c] for c in carried], *added]))
    kept = F.when(~F.col("row.was_null"), F.col("_kept")) if keep_untouched else F.col("_kept")
    columns = {"doc_id": F.col("doc_id"), text: kept} | {c: F.col("row")[c] for c in others}
    return done.select(*[columns[c].alias(c) for c in docs.columns], F.col("_words").alias(n_words), F.col("_removed").alias(n_removed))


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    cut = without_repeats(docs.select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
