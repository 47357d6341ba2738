"""Spelling variants: words one edit apart, found by walking a trie level by level.

The vocabulary is a trie whose edges are rows (node, first character, label, child): a node
is the prefix itself, and a chain of nodes without a branch is one edge.  Every level is one
grouping of the words that reach it.  States (word, position, node, edits) go down with the
levels by joins: without an edit along the word's own path, and from a node on, through the
other edges, with one: the edge's first character replaces the word's or stands before it.
Of two words that are one edit apart this finds each from the other or from the shorter one,
at the node where they part.  A state with an edit must follow the rest of its word exactly;
where that rest ends at a word of the trie, the two are neighbours.

Near the root every word passes every node, so edits there would multiply the rows by the
alphabet.  Of two such words the same letters make up one half, so a second trie holds the
words spelt backwards, and edits start in the further half of a word only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import text_of
from threadlens.sources.tables import materialize

#: Characters of one edge; a longer chain is several edges.
LABEL_CHARS = 1_000
#: Edges of the first levels are broadcast if they are so few.
BROADCAST_LEVELS, BROADCAST_EDGES = 2, 10_000
#: Letters A to Z, and other runs of letters that count as words.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = "[A-Za-zÀ-ÿ]+"


def letter_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run) of all maximal runs of Latin letters, A to Z in lower case; null texts have none."""
    lowered = F.translate(text_of(), UPPER, UPPER.lower())
    return docs.select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"))


def frequent_words(words: DataFrame, min_chars: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of the words (word) with enough characters and occurrences."""
    counted = words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _char(text: Column, after: Column) -> Column:
    """The character behind the first ``after`` ones, empty at the end."""
    return F.substring(text, after + 1, F.lit(1))


def _rest(text: Column, after: Column) -> Column:
    return F.substring(text, after + 1, F.lit((1 << 31) - 1))


def _edges(at: DataFrame) -> DataFrame:
    """Edges below the nodes that the words ``at`` (back, word, depth) have reached.

    (back, node, first, label, child, ends, shortest, longest): ``ends`` if the child is a
    word itself, then the range of lengths of the words under it.
    """
    grouped = at.filter("depth < length(word)").groupBy(
        "back",
        F.substring("word", F.lit(1), F.col("depth")).alias("node"),
        _char(F.col("word"), F.col("depth")).alias("first"),
    )
    ranges = grouped.agg(
        F.min("word").alias("low"),
        F.max("word").alias("high"),
        F.first("depth").alias("depth"),
        F.min(F.length("word")).alias("shortest"),
        F.max(F.length("word")).alias("longest"),
    )
    # what the first and the last word of a group share, all between them share as well
    differs = F.expr(
        f"""array_min(filter(
            sequence(depth + 2, least(depth + {LABEL_CHARS}, length(low), length(high)) + 1),
            i -> substring(low, i, 1) <> substring(high, i, 1) OR i > depth + {LABEL_CHARS} OR i > length(low)))"""
    )
    whole = F.least(F.length("low"), F.col("depth") + LABEL_CHARS)
    upto = F.when(F.col("low") == F.col("high"), whole).otherwise(differs - 1)
    child = F.substring("low", F.lit(1), F.col("upto"))
    return ranges.withColumn("upto", upto).select(
        "back",
        "node",
        "first",
        _rest(child, F.col("depth")).alias("label"),
        child.alias("child"),
        (F.col("low") == child).alias("ends"),
        "shortest",
        "longest",
    )


def _arrived(rows: DataFrame, passed: Column) -> DataFrame:
    """Rows whose word is used up at a word, or goes on with a character the child has."""
    done = F.col("pos") == F.length("word")
    goes_on = F.contains(F.col("nexts"), _char(F.col("word"), F.col("pos")))
    return rows.withColumn("pos", passed).filter(F.when(done, F.col("ends")).otherwise(goes_on))


def _first_edits(at: DataFrame, edges: DataFrame, narrow) -> DataFrame:
    """States with one edit, made at the nodes that the words themselves have reached."""
    here = at.filter("depth >= length(word) DIV 2").select(
        "back", F.substring("word", F.lit(1), F.col("depth")).alias("node"), "word", "depth"
    )
    met = here.join(narrow(edges), ["back", "node"])
    own = _char(F.col("word"), F.col("depth"))
    met = met.filter(F.col("first") != own)
    beyond = _rest(F.col("label"), F.lit(1))

    def changed(skipped: int, which: Column) -> DataFrame:
        target = F.length("word") + (1 - skipped)
        follows = F.startswith(_rest(F.col("word"), F.col("depth") + skipped), beyond)
        fits = target.between(F.col("shortest"), F.col("longest"))
        passed = F.col("depth") + skipped + F.length("label") - 1
        return _arrived(met.filter(which & fits & follows), passed).withColumn("target", target)

    replaced = changed(1, (own != "") & (F.col("first") > own))
    return replaced.unionByName(changed(0, F.lit(True))).select("back", "word", "child", "pos", "target")


def _walked(states: DataFrame, edges: DataFrame, narrow) -> DataFrame:
    """States that follow an edge along the rest of their word."""
    states = states.select(
        "back",
        F.col("child").alias("node"),
        _char(F.col("word"), F.col("pos")).alias("first"),
        "word",
        "pos",
        "target",
    )
    met = states.join(narrow(edges), ["back", "node", "first"])
    follows = F.startswith(_rest(F.col("word"), F.col("pos")), F.col("label"))
    fits = F.col("target").between(F.col("shortest"), F.col("longest"))
    moved = _arrived(met.filter(follows & fits), F.col("pos") + F.length("label"))
    return moved.select("back", "word", "child", "pos", "target")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b) of all pairs of different words (word, distinct, not empty) that are one inserted,
    deleted or replaced code point apart; every pair once."""
    both = words.select(F.lit(False).alias("back"), "word").unionByName(
        words.select(F.lit(True).alias("back"), F.reverse("word").alias("word"))
    )
    at = materialize(both.withColumn("depth", F.lit(0)), "spelling-at")
    edges = materialize(_edges(at), "spelling-edges")
    states, found, level = None, [], 1
    while edges.take(1):
        # with Latin letters the first levels have some thousands of edges, which all words pass
        few = level <= BROADCAST_LEVELS and edges.count() <= BROADCAST_EDGES
        narrow = F.broadcast if few else (lambda df: df)
        placed = at.filter("depth < length(word)").select(
            "back",
            F.substring("word", F.lit(1), F.col("depth")).alias("node"),
            _char(F.col("word"), F.col("depth")).alias("first"),
            "word",
        )
        own = edges.select("back", "node", "first", F.length("child").alias("depth"))
        down = placed.join(narrow(own), ["back", "node", "first"])
        next_at = materialize(down.select("back", "word", "depth"), "spelling-at")
        next_edges = materialize(_edges(next_at), "spelling-edges")
        nexts = next_edges.groupBy("back", F.col("node").alias("child")).agg(
            F.array_join(F.collect_set("first"), "").alias("nexts")
        )
        edges = edges.join(nexts, ["back", "child"], "left").fillna("", ["nexts"])
        edges = materialize(edges, "spelling-edges-ahead")
        moved = _first_edits(at, edges, narrow)
        if states is not None:
            moved = moved.unionByName(_walked(states, edges, narrow))
        moved = materialize(moved, "spelling-states")
        found.append(moved.filter("pos = length(word)").select("back", "word", "child"))
        states = moved.filter("pos < length(word)")
        at, edges, level = next_at, next_edges, level + 1
    if not found:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    spelt = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
    pairs = reduce(DataFrame.unionByName, found).select(spelt("word").alias("x"), spelt("child").alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word reached by following (word, form).

    Counts at least double with every step, so a chain is short and halves every round.
    """
    roots = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        met = roots.join(onward, "root", "left")
        new = materialize(
            met.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots",
        )
        if not new.filter("moved").take(1):
            return new.select("word", "root")
        roots = new.drop("moved")


def spelling_variants(words: DataFrame, dominance: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n).

    Two words are near if they differ by one inserted, deleted or replaced code point.  A
    word's ``form`` is its most frequent near word (of equally frequent ones the first in
    code-point order) if that is at least ``dominance`` (two or more) times as frequent, else
    null; ``root`` follows forms to the last.  Rows with a null or empty word are left out;
    a word listed more than once counts as often as its rows say together.  Other columns
    are not read; an empty table gives no row.
    """
    if dominance < 2:
        raise ValueError("forms have to be at least twice as frequent")
    own = words.filter("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))
    own = materialize(own.select("word", F.col("n").cast("bigint").alias("n")), "spelling-words")
    pairs = materialize(near_words(own.select("word")), "spelling-pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"))
    )
    counts = own.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    best = sides.join(counts, "near").groupBy("word").agg(F.count("*").alias("n_near"), first.alias("best"))
    met = own.join(best, "word", "left")
    form_n = -F.col("best.less")
    takes = form_n >= dominance * F.col("n")
    judged = materialize(
        met.select(
            "word",
            F.when(takes, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(takes, form_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
