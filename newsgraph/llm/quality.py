"""Quality rules learned as a decision list, on built-in functions only.

Text features are projections of the row. Sequential covering learns when to reject: grow a conjunction of thresholds by
information gain on two thirds of the labelled rows, prune it on the last third, keep it if it is right often enough,
drop what it covers, start again. Each step needs one small table of counts, which Spark sums over all labelled rows;
the rules become one ordered conditional expression.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgraph.scratch import materialise

# Fixed by the contract: what separates words, and which characters are symbols.
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper", "n_marks"]
# Half octaves from 2^-10 to 1 for shares, whole and half steps for lengths.
SHARE_STEPS = tuple(2.0 ** (-k / 2) for k in range(20, -1, -1))
FEATURES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbol_share": ("n_symbols / word_chars", SHARE_STEPS),
    "upper_share": ("n_upper / word_chars", SHARE_STEPS),
    "mark_share": ("n_marks / n_words", SHARE_STEPS),
    "dup_line_share": ("n_dup_lines / n_lines", SHARE_STEPS),
    "repeat_share": ("n_repeat_words / n_words", SHARE_STEPS),
    "word_length": ("word_chars / n_words", tuple(k / 2 for k in range(2, 31))),
    "line_words": ("n_words / n_lines", tuple(float(2**k) for k in range(1, 12))),
    "words": ("n_words", tuple(float(2 ** (k / 2)) for k in range(10, 30))),
}


@dataclass(frozen=True)
class Condition:
    """`feature` at least (or below) a threshold."""

    feature: str
    at_least: bool
    threshold: float

    def sql(self) -> str:
        return f"{FEATURES[self.feature][0]} {'>=' if self.at_least else '<'} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def _defined(expression: str) -> str:
    """The expression with shares that are null, so that no condition holds, where a text has no words to divide by."""
    return re.sub(r"(\w+) / (\w+)", r"try_divide(\1, \2)", expression)


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of `BASE` and `EXTRA`, all long; a null text counts as empty.

    Repeated three-word windows are found inside the row: the hash of each window, with its place in the low bits, is
    sorted, and neighbours with equal hash whose words are equal too mark their places. The cost is n log n in the words
    of a text, also if all of them repeat.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(given, BLANKS), lambda w: w != "")
    lines = F.filter(F.split(given, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    staged = df.withColumn("_w", words).withColumn("_l", lines)
    bits = F.expr("cast(ceil(log2(size(_w) + 2)) as int)")
    packed = F.expr(
        """CASE WHEN size(_w) >= 6 THEN sort_array(transform(sequence(0, size(_w) - 3), i ->
             shiftleft(xxhash64(_w[i], _w[i + 1], _w[i + 2]), _b) | cast(i as bigint)))
           ELSE cast(array() as array<bigint>) END"""
    )
    # places of windows that equal the one before or after them in this order
    place = "cast({} & (shiftleft(1L, _b) - 1) as int)"
    equal = lambda a, b: (
        f"(shiftright({a}, _b) = shiftright({b}, _b) AND _w[{place.format(a)}] = _w[{place.format(b)}]"
        f" AND _w[{place.format(a)} + 1] = _w[{place.format(b)} + 1] AND _w[{place.format(a)} + 2] = _w[{place.format(b)} + 2])"
    )
    repeated = F.expr(
        f"""sort_array(transform(filter(_p, (x, i) -> (i > 0 AND {equal('x', '_p[i - 1]')})
              OR (i + 1 < size(_p) AND {equal('x', '_p[i + 1]')})), x -> {place.format('x')}))"""
    )
    covered = F.expr("aggregate(transform(_r, (x, i) -> least(3, coalesce(get(_r, i + 1) - x, 3))), 0L, (a, x) -> a + x)")
    out = staged.withColumn("_b", bits).withColumn("_p", packed).withColumn("_r", repeated)
    removed = lambda chars: (F.length(given) - F.length(F.translate(given, chars, ""))).cast("long")
    return out.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": removed(SYMBOLS),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": covered.cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_upper": (F.length(given) - F.length(F.regexp_replace(given, r"\p{Lu}", ""))).cast("long"),
        "n_marks": removed("!?"),
    }).drop("_w", "_l", "_b", "_p", "_r")


def base_failed() -> Column:
    """Too short, or more than half of its words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _binned(labelled: DataFrame) -> DataFrame:
    """Counts of good and bad rows by the bins of all features, for growing and for pruning."""
    bins = []
    for name, (value, steps) in FEATURES.items():
        bins.append(F.expr(f"size(filter(array({', '.join(f'{s!r}D' for s in steps)}), t -> {_defined(value)} >= t))").alias(name))
    part = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("for_pruning")
    return (
        labelled.where("n_words > 0 AND quality IS NOT NULL")
        .select(part, (F.col("quality") == 0).alias("bad"), *bins)
        .groupBy("for_pruning", "bad", *FEATURES)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _on_bins(condition: Condition) -> Column:
    at = FEATURES[condition.feature][1].index(condition.threshold) + 1
    return F.col(condition.feature) >= at if condition.at_least else F.col(condition.feature) < at


def _all(conditions: Sequence[Condition]) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & _on_bins(condition)
    return out


def _histogram(rows: DataFrame) -> dict[tuple[str, int, bool], int]:
    """Rows by feature, bin and badness: at most (features x bins x 2) numbers reach the driver."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES]))
    counted = rows.select("bad", "n", pairs.alias("x")).groupBy("x.feature", "x.bin", "bad").agg(F.sum("n").alias("n"))
    return {(r["feature"], r["bin"], r["bad"]): r["n"] for r in counted.collect()}


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(
    labelled: DataFrame, max_rules: int = 12, max_conditions: int = 3, min_precision: float = 0.9, min_share: float = 0.002
) -> list[Rule]:
    """Ordered rules that reject, from the counts and `quality` (0 bad, 1 good) of all labelled rows.

    Learning ends when the next rule is right for less than `min_precision` of what it covers or covers less than
    `min_share` of the bad rows, measured on the rows kept for pruning. Without bad rows there are no rules. Ties go to
    the feature that comes first, then to the lower threshold. At most max_rules x (max_conditions + 1) small jobs run.
    """
    table = materialise(_binned(labelled), "quality-bins")
    rules: list[Rule] = []
    left, bad_rows = table, None
    while len(rules) < max_rules:
        grown: list[Condition] = []
        while len(grown) < max_conditions:
            counts = _histogram(left.where(~F.col("for_pruning") & _all(grown)))
            first = next(iter(FEATURES))
            p0 = sum(n for (f, _, bad), n in counts.items() if f == first and bad)
            n0 = sum(n for (f, _, bad), n in counts.items() if f == first and not bad)
            bad_rows = p0 if bad_rows is None else bad_rows
            if not p0 or not n0:
                break
            best: tuple[float, Condition] | None = None
            for name, (_, steps) in FEATURES.items():
                p = sum(counts.get((name, b, True), 0) for b in range(len(steps) + 1))
                n = sum(counts.get((name, b, False), 0) for b in range(len(steps) + 1))
                for at, threshold in enumerate(steps):
                    p -= counts.get((name, at, True), 0)
                    n -= counts.get((name, at, False), 0)
                    for gain, condition in (
                        (_gain(p0, n0, p, n), Condition(name, True, threshold)),
                        (_gain(p0, n0, p0 - p, n0 - n), Condition(name, False, threshold)),
                    ):
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, condition)
            if best is None:
                break
            grown.append(best[1])
        if not grown:
            break
        kept, p, n = _pruned(left, grown)
        if not kept or p < max(1.0, min_share * (bad_rows or 0)) or p < min_precision * (p + n):
            break
        rules.append(kept)
        left = left.where(~_all(kept))
    return rules


def _pruned(left: DataFrame, grown: Sequence[Condition]) -> tuple[Rule, int, int]:
    """The first conditions that do best on the pruning rows, with the bad and good rows they cover there."""
    sums = []
    for k in range(1, len(grown) + 1):
        for bad in (True, False):
            hit = _all(grown[:k]) & (F.col("bad") == F.lit(bad))
            sums.append(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(f"{'p' if bad else 'n'}{k}"))
    row = left.where("for_pruning").agg(*sums).first()
    best, best_value = 0, -math.inf
    for k in range(1, len(grown) + 1):
        p, n = row[f"p{k}"], row[f"n{k}"]
        value = (p - n) / (p + n) if p + n else -math.inf
        if value > best_value + 1e-12:
            best, best_value = k, value
    if not best:
        return (), 0, 0
    return tuple(grown[:best]), row[f"p{best}"], row[f"n{best}"]


def rule_number(rules: Sequence[Rule]) -> Column:
    """Number of the first rule that fires, from 1 on; 0 if none does."""
    out = F.lit(0)
    for number in range(len(rules), 0, -1):
        out = F.when(F.expr(" AND ".join(_defined(c.sql()) for c in rules[number - 1])), F.lit(number)).otherwise(out)
    return out


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, rule (the one that rejects, else 0) and kept of every document.

    Null texts count as empty and fail the base; null ids are judged but never labelled; a document with several labels
    counts once for each; repeated rows get repeated verdicts; empty tables give no rows and no rules.
    """
    counted = materialise(with_counts(docs.select("doc_id", "text")).drop("text"), "quality-counts")
    rules = learn(counted.join(labels.select("doc_id", "quality"), "doc_id"))
    judged = counted.withColumns({"base_failed": base_failed(), "rule": rule_number(rules)})
    return judged.select("doc_id", *BASE, "base_failed", "rule", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they are.

    The rules are learned from the counts of all documents, then each row is judged where it is read: texts are not
    shuffled, and no document meets its verdict through an id.
    """
    counted = materialise(with_counts(docs.select("doc_id", "text")).drop("text"), "quality-counts")
    rules = learn(counted.join(labels.select("doc_id", "quality"), "doc_id"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    passed = ~base_failed() & (rule_number(rules) == 0)
    # a filter would be pushed below the counts and compute them once more for every mention of them
    return with_counts(rows).select(F.inline(F.when(passed, F.array("_row"))))
