"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters are dealt to groups; the counts of the groups, one after the other, are a word's path in the trie. One edit adds
one to a group, takes one from a group, or both, so a depth-first search carries a budget of one surplus and one deficit
and leaves a branch that overdraws either. Words at the leaves are verified letter by letter.

The top of the trie is built from counts that Spark gathers level by level, until no branch has more than BRANCH_WORDS
words. Every word is dealt to its branch as an entry and, as a query, to all branches that its budget reaches; a branch
with many queries is copied to several tasks. The rest of the trie lives inside the tasks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.llm.batches import slices
from newsgraph.scratch import materialise

_RUNS = re.compile("[a-zÀ-ÿ]+")
LEAST_LETTERS, LEAST_COUNT = 5, 3
# One of so many (document, run) pairs loses a letter.
DAMAGE = 97
GROUPS = 16
# Words of a branch that a task holds, and queries that one copy of a branch answers.
BRANCH_WORDS, BRANCH_QUERIES = 20_000, 200_000
# Words up to this length are verified as rows of a matrix, longer ones one by one.
MATRIX_LETTERS = 40
# Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 400_000
# Below so many comparisons a branch is not divided any further; pairs verified at once; beyond so many, by deletions.
LEAF_PAIRS, VERIFY_PAIRS, LARGE_LEAF = 8_192, 200_000, 4_000_000


def damaged(run: str, prefix: int) -> str:
    """The run, or the run without one letter; `prefix` is the crc32 of what stands before it."""
    h = zlib.crc32(run.encode(), prefix)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """word, n of all words with enough letters and occurrences; a null key counts as an empty one, a null text as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for part in slices(batch, text):
                column = part.column(1)
                for row, name in enumerate(part.column(0).to_pylist()):
                    if not column[row].is_valid:
                        continue
                    found = Counter(_RUNS.findall(column[row].as_buffer().to_pybytes().lower().decode("utf-8", "replace")))
                    prefix = zlib.crc32(f"{name or ''}:".encode())
                    for word, n in found.items():
                        word = damaged(word, prefix)
                        if len(word) >= LEAST_LETTERS:
                            held[word] += n
                    if len(held) > COUNTED_WORDS:
                        yield out()
        yield out()

    parts = docs.select(F.col(key).cast("string").alias(key), text).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words in a row, and their lengths; every letter has one byte in Latin-1."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8), np.array([len(w) for w in words], dtype=np.int64)


def _vectors(words: list[str], group: np.ndarray) -> np.ndarray:
    """Counts of the letter groups of every word."""
    letters, sizes = _flat(words)
    rows = np.repeat(np.arange(len(words)), sizes)
    return np.bincount(rows * GROUPS + group[letters], minlength=len(words) * GROUPS).reshape(-1, GROUPS).astype(np.int32)


def letter_groups(totals: dict[int, int]) -> np.ndarray:
    """Group of each letter: by falling frequency, each goes to the group that has least so far; groups by falling size."""
    sums, members = [0] * GROUPS, [[] for _ in range(GROUPS)]
    for letter in sorted(totals, key=lambda c: (-totals[c], c)):
        least = sums.index(min(sums))
        sums[least] += totals[letter]
        members[least].append(letter)
    out = np.full(256, GROUPS - 1, dtype=np.int64)
    for place, g in enumerate(sorted(range(GROUPS), key=lambda g: (-sums[g], g))):
        out[members[g]] = place
    return out


@dataclass
class Branch:
    """A node of the top of the trie: children by the count of the group at this level, or the number of a branch."""

    children: dict[int, Branch] = field(default_factory=dict)
    number: int = -1


def top_of_trie(words: DataFrame, most: int) -> tuple[Branch, int]:
    """Root and number of branches; `words` has `vector`. Each level counts only below nodes that are still too large."""
    root, numbers = Branch(), 0
    open_nodes: dict[tuple[int, ...], Branch] = {}
    if words.count() > most:
        open_nodes[()] = root
    else:
        root.number, numbers = 0, 1
    for level in range(1, GROUPS + 1):
        if not open_nodes:
            break
        rows = words.select(F.slice("vector", 1, level).alias("path"))
        if level > 1:  # one node for each `most` words at the most
            large = words.sparkSession.createDataFrame([(list(p),) for p in open_nodes], "head array<int>")
            rows = rows.join(F.broadcast(large), F.slice("path", 1, level - 1) == F.col("head"), "left_semi")
        deeper: dict[tuple[int, ...], Branch] = {}
        for r in sorted(rows.groupBy("path").count().collect()):
            path, node = tuple(r["path"]), Branch()
            open_nodes[path[:-1]].children[path[-1]] = node
            if r["count"] > most and level < GROUPS:
                deeper[path] = node
            else:
                node.number, numbers = numbers, numbers + 1
        open_nodes = deeper
    return root, numbers


def _reached(node: Branch, level: int, vectors: np.ndarray, rows: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Branches that are within the budget of one surplus and one deficit, with the rows that reach them."""
    if node.number >= 0:
        yield node.number, rows
        return
    own = vectors[rows, level]
    for count, child in node.children.items():
        change = count - own
        up, down = surplus + np.maximum(change, 0), deficit + np.maximum(-change, 0)
        alive = (up <= 1) & (down <= 1)
        if alive.any():
            yield from _reached(child, level + 1, vectors, rows[alive], up[alive], down[alive])


def one_edit(a: str, b: str) -> bool:
    """Whether two different words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at:] == b[at + 1 :] if len(a) < len(b) else a[at + 1 :] == b[at + 1 :]


class Entries:
    """The words of one branch, as a trie over what is left of their vectors."""

    def __init__(self, numbers: np.ndarray, words: list[str], counts: np.ndarray, group: np.ndarray):
        vectors = _vectors(words, group)
        order = np.lexsort(vectors.T[::-1])
        self.vectors, self.words, self.counts, self.numbers = vectors[order], [words[i] for i in order], counts[order], numbers[order]
        self.matrix, self.sizes = _matrix(self.words)
        self.group = group

    def near(self, words: list[str], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, entry) rows of all pairs one edit apart whose entry is longer, or as long with a greater number."""
        vectors = _vectors(words, self.group)
        matrix, sizes = _matrix(words)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def verify() -> None:
            if held:
                q, w = (np.concatenate([h[i] for h in held]) for i in (0, 1))
                held.clear()
                longer = self.sizes[w] - sizes[q]
                fits = (longer == 1) | (longer == 0) & (self.numbers[w] > numbers[q])
                q, w, longer = q[fits], w[fits], longer[fits]
                for at in range(0, len(q), VERIFY_PAIRS):
                    part = slice(at, at + VERIFY_PAIRS)
                    same = _same(matrix[q[part]], self.matrix[w[part]], longer[part])
                    for i in np.flatnonzero(self.sizes[w[part]] > MATRIX_LETTERS):
                        same[i] = one_edit(words[q[part][i]], self.words[w[part][i]])
                    found.append((q[part][same], w[part][same]))

        def leaf(low: int, high: int, level: int, rows: np.ndarray, up: np.ndarray, down: np.ndarray) -> None:
            if len(rows) * (high - low) > LARGE_LEAF:
                found.extend(self._by_deletions(words, numbers, rows, low, high))
                return
            step = max(1, VERIFY_PAIRS // (high - low))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                change = self.vectors[None, low:high, level:] - vectors[part, None, level:]
                above = np.maximum(change, 0).sum(axis=2) + up[at : at + step, None]
                below = np.maximum(-change, 0).sum(axis=2) + down[at : at + step, None]
                q, w = np.nonzero((above <= 1) & (below <= above))  # an entry is as long as the query or one longer
                if len(q):
                    held.append((part[q], low + w))
            if sum(len(h[0]) for h in held) > VERIFY_PAIRS:
                verify()

        def search(low: int, high: int, level: int, rows: np.ndarray, up: np.ndarray, down: np.ndarray) -> None:
            if level == GROUPS or len(rows) * (high - low) <= LEAF_PAIRS or high - low <= 8:
                leaf(low, high, level, rows, up, down)
                return
            column = self.vectors[low:high, level]
            begins = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            ends = np.append(begins[1:], high - low)
            own = vectors[rows, level]
            for begin, end in zip(begins, ends, strict=True):
                change = column[begin] - own
                surplus, deficit = up + np.maximum(change, 0), down + np.maximum(-change, 0)
                alive = (surplus <= 1) & (deficit <= 1)
                if alive.any():
                    search(low + begin, low + end, level + 1, rows[alive], surplus[alive], deficit[alive])

        if words and self.words:
            none = np.zeros(len(words), dtype=np.int32)
            search(0, len(self.words), 0, np.arange(len(words)), none, none)
        verify()
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _by_deletions(self, words: list[str], numbers: np.ndarray, rows: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same pairs for a leaf with very many words and queries: by what is left when a letter is taken out."""
        whole: dict[str, list[int]] = {}
        for q in rows:
            whole.setdefault(words[q], []).append(int(q))
        holes: dict[tuple[int, str], list[int]] = {}
        for q in rows:
            for i in range(len(words[q])):
                holes.setdefault((i, words[q][:i] + words[q][i + 1 :]), []).append(int(q))
        for w in range(low, high):
            word, partners = self.words[w], set()
            for i in range(len(word)):
                rest = word[:i] + word[i + 1 :]
                partners.update(whole.get(rest, ()))
                partners.update(q for q in holes.get((i, rest), ()) if numbers[q] < self.numbers[w] and words[q] != word)
            if partners:
                yield np.array(sorted(partners), dtype=np.int64), np.full(len(partners), w, dtype=np.int64)


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The first letters of all words as rows, zeros behind them, and the lengths."""
    letters, sizes = _flat(words)
    out = np.zeros((len(words), MATRIX_LETTERS), dtype=np.uint8)
    rows = np.repeat(np.arange(len(words)), sizes)
    columns = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fits = columns < MATRIX_LETTERS
    out[rows[fits], columns[fits]] = letters[fits]
    return out, sizes


def _same(a: np.ndarray, b: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether rows of `a` become those of `b` by one replaced letter (longer = 0) or one inserted (longer = 1)."""
    differ = a != b
    replaced = differ.sum(axis=1) == 1
    first = differ.argmax(axis=1)
    shifted = a[:, :-1] != b[:, 1:]
    inserted = ~(shifted & (np.arange(a.shape[1] - 1) >= first[:, None])).any(axis=1)
    return np.where(longer == 0, replaced, inserted)


def _searched(dealt: DataFrame, group: np.ndarray) -> DataFrame:
    """number, links, best (n negated, word) of every word that has near ones, by branch and copy."""

    def answer(entries: Entries, numbers: np.ndarray, words: list[str], counts: np.ndarray) -> pa.RecordBatch | None:
        q, w = entries.near(words, numbers)
        if not len(q):
            return None
        names = sorted({words[i] for i in np.unique(q)} | {entries.words[i] for i in np.unique(w)})
        place = {name: i for i, name in enumerate(names)}
        own = np.concatenate([numbers[q], entries.numbers[w]])
        other_n = np.concatenate([entries.counts[w], counts[q]])
        other = np.array([place[entries.words[i]] for i in w] + [place[words[i]] for i in q], dtype=np.int64)
        order = np.lexsort((other, -other_n, own))
        own, other_n, other = own[order], other_n[order], other[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        links = np.diff(np.append(first, len(own)))
        best = pa.StructArray.from_arrays([pa.array(-other_n[first]), pa.array([names[i] for i in other[first]], pa.string())], names=["n", "word"])
        return pa.RecordBatch.from_arrays([pa.array(own[first]), pa.array(links.astype(np.int64)), best], names=["number", "links", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, entries, parts = None, None, []
        for batch in batches:
            places = list(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True))
            begin = 0
            while begin < len(places):
                end = begin
                while end < len(places) and places[end] == places[begin]:
                    end += 1
                piece, (branch, copy, is_query) = batch.slice(begin, end - begin), places[begin]
                numbers, counts = (piece.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
                words = piece.column(4).to_pylist()
                if (branch, copy) != at:
                    at, entries, parts = (branch, copy), None, []
                if not is_query:
                    parts.append((numbers, words, counts))
                else:
                    if entries is None:
                        entries = Entries(np.concatenate([p[0] for p in parts]), [w for p in parts for w in p[1]], np.concatenate([p[2] for p in parts]), group)
                    found = answer(entries, numbers, words, counts)
                    if found is not None:
                        yield found
                begin = end

    found = dealt.mapInArrow(run, "number long, links long, best struct<n:long,word:string>")
    return found.groupBy("number").agg(F.sum("links").alias("links"), F.min("best").alias("best"))


def near_words(words: DataFrame, most: int = BRANCH_WORDS, queries: int = BRANCH_QUERIES) -> DataFrame:
    """word, n, n_near, form, form_n of every row of `words` (word, n; words distinct, of letters up to U+00FF)."""
    spark = words.sparkSession
    words = materialise(words.withColumn("number", F.monotonically_increasing_id()), "words")

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(256, dtype=np.int64)
        for batch in batches:
            totals += np.bincount(_flat(batch.column(0).to_pylist())[0], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int32)), pa.array(totals)], names=["letter", "n"])

    totals = words.select("word").mapInArrow(letters, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    group = letter_groups({r["letter"]: r["n"] for r in totals.collect() if r["n"]})  # 256 rows

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _vectors(batch.column(1).to_pylist(), group)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), GROUPS).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["number", "word", "n", "vector"])

    placed = materialise(words.select("number", "word", "n").mapInArrow(vectors, "number long, word string, n long, vector array<int>"), "vectors")
    root, branches = top_of_trie(placed.select("vector"), most)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, GROUPS)
            none, rows = np.zeros(len(own), dtype=np.int32), np.arange(len(own))
            home = np.full(len(own), -1, dtype=np.int32)
            for number, reached in _reached(root, 0, own, rows, none + 1, none + 1):
                home[reached] = number
            for number, reached in _reached(root, 0, own, rows, none, none):
                part = batch.take(pa.array(reached))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(reached), number, dtype=np.int32)), pa.array(home[reached] == number), *part.columns[:3]],
                    names=["branch", "home", "number", "word", "n"],
                )

    routed = materialise(placed.mapInArrow(route, "branch int, home boolean, number long, word string, n long"), "routed")
    copies = routed.groupBy("branch").agg(F.ceil(F.count(F.lit(1)) / queries).cast("int").alias("copies"))
    copies = materialise(copies, "copies")
    tasks = copies.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    known = routed.join(F.broadcast(copies), "branch")  # a row for each branch, of which there is one for many words
    asked = known.withColumn("copy", F.pmod(F.xxhash64("number"), F.col("copies")).cast("int"))
    held = known.where("home").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    columns = ["branch", "copy", "is_query", "number", "word", "n"]
    dealt = asked.withColumn("is_query", F.lit(True)).select(columns).unionByName(held.withColumn("is_query", F.lit(False)).select(columns))
    dealt = dealt.repartition(max(1, min(tasks, 20_000)), "branch", "copy").sortWithinPartitions("branch", "copy", "is_query")
    found = _searched(dealt, group)
    return words.join(found, "number", "left").select(
        "word", "n", F.coalesce("links", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(-F.col("best.n") >= 2 * F.col("n"), c).alias(name) for c, name in ((F.col("best.word"), "form"), (-F.col("best.n"), "form_n"))],
    )


def _with_roots(words: DataFrame) -> DataFrame:
    """`root` beside every row. Counts at least double from a word to its form, so a few doublings of the steps suffice."""
    ways = materialise(words.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        ways = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            break
    return words.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of five letters or more that occurs three times or more.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case; one of 97 (document, run) pairs loses a letter
    first. Words are near if one letter is inserted, deleted or replaced; a word's form is its near word with the largest
    n, ties to the smallest in code-point order, if that n is at least twice its own. Null texts have no words, a null key
    counts as an empty one, repeated rows count again. Texts and words may be of any length. An empty table gives no rows.
    """
    found = materialise(near_words(word_counts(docs, key, text)), "near-words")
    return _with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
