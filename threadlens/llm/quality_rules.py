"""Quality rules learned as decision lists over text statistics.

Statistics of a text are column expressions.  Labelled documents are summarised as one
table of counts over binned statistics, at most ``bins`` to the power of the number of
measures rows, whatever the number of labels.  Sequential covering on that table grows a
conjunction of thresholds that marks bad documents, prunes it on documents that growing
has not seen, removes what it covers, and goes on.  The list becomes one CASE expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import once
from threadlens.llm.common import BLANK, WORD, text_of, words_of
from threadlens.sources.tables import materialize

SYMBOLS = "#*$%&|<>"
#: A word window that counts as repeated when it is there twice.
WINDOW = 3

#: Measures that rules may test; each is a ratio, so long and short texts are alike.
MEASURES = {
    "symbols_per_word": "n_symbols / n_words",
    "repeated_share": "n_repeat_words / n_words",
    "capital_share": "n_capitals / word_chars",
    "duplicate_lines": "n_dup_lines / n_lines",
    "mean_word_chars": "word_chars / n_words",
}


def measure(name: str) -> Column:
    """Value of a measure; null for a text without words."""
    return F.when(F.col("n_words") > 0, F.expr(MEASURES[name]))



def _removed(text: Column, characters: str) -> Column:
    """Number of the given characters in a text."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def text_statistics(docs: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """doc_id and the counts behind rules and base filter, one row per row of ``docs``.

    ``carried`` names further columns to keep.

    Words are maximal runs without the six ASCII blanks; a null text has none.  A word
    belongs to ``n_repeat_words`` if a window of three words that covers it occurs twice
    or more in the text.  Each text is read where it is; nothing is shuffled.
    """
    text = F.col("_text")
    rows = docs.select("doc_id", *carried, text_of().alias("_text")).select(
        "doc_id",
        *carried,
        words_of(text).alias("_words"),
        F.length(F.regexp_replace(text, BLANK + "+", "")).cast("bigint").alias("word_chars"),
        _removed(text, SYMBOLS).cast("bigint").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("_lines"),
    )
    at = F.sequence(F.lit(0), F.size("_words") - WINDOW)
    window = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)])
    hashes = F.transform(at, lambda i: F.struct(window(i).alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = rows.withColumn(
        "_sorted", F.sort_array(F.when(F.size("_words") >= WINDOW, hashes).otherwise(none))
    )
    same = lambda x, j: F.coalesce(F.get("_sorted", j)["h"] == x["h"], F.lit(False))
    starts = F.filter("_sorted", lambda x, j: same(x, j - 1) | same(x, j + 1))
    rows = rows.withColumn("_starts", F.sort_array(F.transform(starts, lambda x: x["i"])))
    # a window adds the words up to the start of the next repeated one
    gain = lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", j + 1) - p, F.lit(WINDOW)))
    covered = F.aggregate(F.transform("_starts", gain), F.lit(0), lambda a, x: a + x)
    n_lines = F.size("_lines").cast("bigint")
    return rows.select(
        "doc_id",
        *carried,
        F.size("_words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (n_lines - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.when(F.size("_starts") > 0, covered).otherwise(0).cast("bigint").alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        "n_capitals",
    )


def base_failed(min_words: int = 50, max_repeated: int = 50) -> Column:
    """Too few words, or over ``max_repeated`` percent of them in repeated windows."""
    return (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeated * F.col("n_words")
    )


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    cut: float

    def expression(self) -> Column:
        value = measure(self.measure)
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.measure} {'>' if self.above else '<='} {self.cut:.4g}"


@dataclass
class DecisionList:
    """Ordered rules; a document that meets every condition of one is rejected."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def keeps(self) -> Column:
        """CASE expression in the order of the rules; texts without words meet none."""
        verdict = None
        for rule in self.rules:
            test = rule[0].expression()
            for condition in rule[1:]:
                test = test & condition.expression()
            verdict = (F if verdict is None else verdict).when(F.coalesce(test, F.lit(False)), False)
        return F.lit(True) if verdict is None else verdict.otherwise(True)


def _cuts(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """Thresholds of every measure: percentiles of the good rows and of the bad ones."""
    half = (bins - 1) // 2
    good = [1 - 0.5 ** (4 + i) for i in range(bins - 1 - half)]
    bad = [(i + 1) / (half + 1) for i in range(half)]
    parts = [
        F.percentile_approx(F.when(F.col("quality") == q, measure(m)), shares, 10_000).alias(
            f"{m}_{q}"
        )
        for m in MEASURES
        for q, shares in ((1, good), (0, bad))
    ]
    found = rows.agg(*parts).first()
    return {
        m: sorted({x for q in (0, 1) for x in (found[f"{m}_{q}"] or ()) if x is not None})
        for m in MEASURES
    }


def _binned(name: str, cuts: Sequence[float]) -> Column:
    """Number of thresholds below the value."""
    value = measure(name)
    return sum((F.when(value > c, 1).otherwise(0) for c in cuts), F.lit(0))


def learn_rules(
    statistics: DataFrame,
    labels: DataFrame,
    bins: int = 8,
    min_precision: float = 0.9,
    min_covered: int = 5,
    max_conditions: int = 3,
    max_rules: int = 16,
) -> DecisionList:
    """Learn from all labelled rows (labels: doc_id, quality 0 or 1; others are ignored).

    Two of three documents grow rules, the third prunes them and decides whether a rule
    is precise enough (``min_precision``).  Without labels the list is empty.
    """
    marked = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct()
    rows = statistics.filter("n_words > 0").join(marked, "doc_id")
    rows = materialize(
        rows.withColumn("prune", F.crc32(F.col("doc_id").cast("string")) % 3 == 0),
        "rules-labelled",
    )
    cuts = {m: c for m, c in _cuts(rows, bins).items() if c}
    names = list(cuts)
    if not names:
        return DecisionList()
    counted = rows.groupBy(*[_binned(m, cuts[m]).alias(m) for m in names], "prune").agg(
        F.count_if(F.col("quality") == 0).alias("bad"), F.count_if(F.col("quality") == 1).alias("good")
    )
    # at most bins ** measures * 2 rows of counts
    cells = [
        (tuple(r[m] for m in names), r["prune"], r["bad"], r["good"]) for r in counted.collect()
    ]
    rules = []
    while len(rules) < max_rules:
        rule = _grow([c for c in cells if not c[1]], names, cuts, max_conditions)
        rule = _prune(rule, [c for c in cells if c[1]])
        bad, good = _covered(rule, cells)
        bad_p, good_p = _covered(rule, [c for c in cells if c[1]])
        if (
            not rule
            or bad < min_covered
            or bad < min_precision * (bad + good)
            or bad_p < min_precision * (bad_p + good_p)
        ):
            break
        rules.append(rule)
        cells = [c for c in cells if not _meets(rule, c)]
    return DecisionList(
        [tuple(Condition(names[k], above, cuts[names[k]][i]) for k, above, i in r) for r in rules]
    )


def _meets(rule, cell) -> bool:
    return all((cell[0][k] > i) == above for k, above, i in rule)


def _covered(rule, cells) -> tuple[int, int]:
    met = [c for c in cells if _meets(rule, c)]
    return sum(c[2] for c in met), sum(c[3] for c in met)


def _grow(cells, names, cuts, max_conditions):
    """Add the condition with the largest information gain while good documents remain."""
    rule = ()
    bad, good = _covered(rule, cells)
    while good and bad and len(rule) < max_conditions:
        before, best = math.log2(bad / (bad + good)), None
        for k, name in enumerate(names):
            for i in range(len(cuts[name])):
                for above in (True, False):
                    p, n = _covered((*rule, (k, above, i)), cells)
                    if p:
                        gain = p * (math.log2(p / (p + n)) - before)
                        if best is None or gain > best[0] + 1e-9:
                            best = gain, (k, above, i), p, n
        if best is None or best[0] <= 1e-9:
            break
        rule, bad, good = (*rule, best[1]), best[2], best[3]
        cells = [c for c in cells if _meets(rule, c)]
    return rule


def _prune(rule, cells):
    """Drop last conditions where that separates the unseen documents better."""

    def worth(r):
        p, n = _covered(r, cells)
        return (p - n) / (p + n) if p + n else -1.0

    if not rule:
        return rule
    return max((rule[: i + 1] for i in range(len(rule))), key=lambda r: (worth(r), len(r)))


def quality_verdicts(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Statistics, base_failed and kept for every row of ``docs`` (doc_id, text).

    Null texts have no words and fail the base filter; rows that repeat are judged alike;
    labels without a matching document, or other than 0 and 1, are ignored; documents
    without a doc_id are judged but teach nothing.  Other columns are not read.
    """
    statistics = materialize(text_statistics(docs), "rules-statistics")
    rules = learn_rules(statistics, labels, **settings)
    failed = base_failed()
    return statistics.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & rules.keeps()
    )


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that base filter and learned rules keep, each judged by its text.

    The texts are read twice, to learn and to judge, and never move.
    """
    rules = learn_rules(materialize(text_statistics(docs), "rules-statistics"), labels, **settings)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "doc_id", "text")
    verdict = ~base_failed() & rules.keeps()
    # generated once per row: a filter on the expression would repeat it for every use
    judged = text_statistics(rows, ["_row"]).select("_row", once(verdict).alias("_keep"))
    return judged.filter("_keep").select("_row.*")
