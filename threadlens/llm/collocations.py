"""Phrase collocations: an FM-index of word numbers per shard, counts summed across shards.

Tasks cut texts into pieces and words and number the words of a shard of some million words.
Words are counted over all shards first; in the shards all but the frequent ones turn into
breaks, since a frequent phrase has frequent words only.  Every shard is then indexed in both
directions: its suffixes sorted as deep as phrases are long, the word before each, and where
that longer suffix stands.  A phrase is an interval of each order.  Reading the words before
an interval extends all its phrases to the left at once, and the other order's interval
follows along; extending to the right is the same with the orders swapped.  The counts of the
extended phrases are summed across shards, longer phrases being looked for only around those
that are frequent overall.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadlens.llm.common import bitmaps, filter_bits, text_of
from threadlens.sources.tables import materialize

#: Signs that end a piece; words of a piece are parted by spaces and tabs.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
#: A byte that no UTF-8 text has, for breaks between pieces, and the number of a break.
BREAK, NO_WORD = b"\xff", 0
NO_LANG = "und"
#: Bytes of text cut into words together, and word numbers in one row of a shard.
SLICE_BYTES, ROW_NUMBERS = 1 << 20, 1 << 20
#: Rows that a task sends together, and so many it gathers from shards with few phrases.
SENT_ROWS, GATHERED_ROWS = 1 << 18, 1 << 20
#: Factors of the filter's hashes of up to four word numbers, and number of hashes.
FACTORS, HASHES = (1_000_003, 754_974_721, 179_424_673, 433_494_437), 3

_TABLE = bytes(0xFF if b in PIECE_ENDS else b for b in range(256))


class _Numbers(dict):
    """Numbers of words in the order in which they come."""

    def __init__(self, taken: list):
        super().__init__({BREAK: NO_WORD})
        self.taken = taken

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.taken)
        self.taken.append(word)
        return number


class _Shard:
    """Texts of several languages as word numbers; the same word has a number per language."""

    def __init__(self):
        self.words: list = [None]
        self.langs: list = [None]
        self.by_lang: dict[str, _Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, piece: bytes) -> None:
        """Texts in lower case with breaks between their pieces; ends with a break."""
        words = piece.replace(BREAK, b" " + BREAK + b" ").split()
        numbers = self.by_lang.setdefault(lang, _Numbers(self.words))
        found = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        self.langs.extend([lang] * (len(self.words) - len(self.langs)))
        again = np.zeros(len(found), bool)
        again[1:] = (found[1:] == NO_WORD) & (found[:-1] == NO_WORD)
        self.parts += [found[~again], np.zeros(1, np.int32)]
        self.size += len(found)

    def rows(self, shard: int) -> Iterator[dict]:
        """The vocabulary with counts, and the numbers in rows of bounded size."""
        numbers = np.concatenate(self.parts)
        counts = np.bincount(numbers, minlength=len(self.words))
        n = len(self.words) - 1
        yield {
            "shard": pa.array(np.full(n, shard)),
            "lang": pa.array(self.langs[1:], pa.string()),
            "word": pa.array(self.words[1:], pa.binary()).cast(pa.string()),
            "number": pa.array(np.arange(1, n + 1, dtype=np.int32)),
            "n": pa.array(counts[1:].astype(np.int64)),
            "numbers": pa.nulls(n, pa.binary()),
        }
        for row, at in enumerate(range(0, len(numbers), ROW_NUMBERS)):
            yield {
                "shard": pa.array([shard]),
                "lang": pa.nulls(1, pa.string()),
                "word": pa.nulls(1, pa.string()),
                "number": pa.array([row], pa.int32()),
                "n": pa.nulls(1, pa.int64()),
                "numbers": pa.array([numbers[at : at + ROW_NUMBERS].tobytes()], pa.binary()),
            }


def _slices(text: bytes) -> Iterator[bytes]:
    """Parts of about SLICE_BYTES that end at a break."""
    at = 0
    while len(text) - at > SLICE_BYTES:
        cut = text.find(BREAK, at + SLICE_BYTES)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def word_shards(docs: DataFrame, shard_words: int = 1 << 20) -> DataFrame:
    """(shard, lang, word, number, n, numbers): vocabularies, and rows of word numbers (no word).

    A shard closes at the first break after ``shard_words`` words.
    """
    schema = "shard bigint, lang string, word string, number int, n bigint, numbers binary"
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
    rows = docs.select(lang.alias("lang"), text_of().cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        out = lambda rows: (pa.RecordBatch.from_pydict(r) for r in rows)
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(own, []).append(text)
            for own, texts in by_lang.items():
                # bytes: only A to Z change case
                for part in _slices(BREAK.join(texts).lower().translate(_TABLE)):
                    shard.add(own, part)
                    if shard.size >= shard_words:
                        yield from out(shard.rows(number))
                        number, shard = number + 1, _Shard()
        if shard.size:
            yield from out(shard.rows(number))

    return rows.mapInArrow(run, schema)


class PhraseIndex:
    """Orders of the suffixes of a sequence and of its reverse, ``depth`` symbols deep.

    Symbol 0 is a break, which no phrase has.  A phrase is a row of intervals (lo, hi): in the
    order of suffixes, then in that of the reversed sequence.
    """

    def __init__(self, numbers: np.ndarray, n_symbols: int, depth: int):
        self.n_symbols = n_symbols
        counts = np.bincount(numbers, minlength=n_symbols + 1)[1:]
        ends = np.cumsum(counts)
        self.words = np.flatnonzero(counts) + 1
        low, high = (ends - counts)[self.words - 1], ends[self.words - 1]
        self.word_intervals = np.stack([low, high, low, high], 1)
        self.numbers, self.depth = numbers, depth
        self.sides: dict[bool, tuple[np.ndarray, np.ndarray]] = {}

    def _side(self, left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(symbol before, place of the longer suffix) of every suffix, in their order."""
        if left in self.sides:
            return self.sides[left]
        numbers = self.numbers if left else self.numbers[::-1]
        starts = np.flatnonzero(numbers).astype(np.int32)
        # beyond the end there are breaks
        at = lambda i: np.append(numbers[i:], np.zeros(i, numbers.dtype))[starts]
        width = int(self.n_symbols).bit_length()
        if width * self.depth < 64:
            packed = at(0).astype(np.int64)
            for i in range(1, self.depth):
                packed = packed << width | at(i)
            order = np.argsort(packed, kind="stable")
            del packed
        else:
            order = np.lexsort([at(i) for i in reversed(range(self.depth))])
        suffixes = starts[order]
        del order, starts
        place = np.zeros(len(numbers) + 1, np.int32)
        place[suffixes] = np.arange(len(suffixes), dtype=np.int32)
        before = np.where(suffixes > 0, numbers[suffixes - 1], 0)
        self.sides[left] = before, place[suffixes - 1]
        return self.sides[left]

    def _grouped(self, intervals: np.ndarray, left: bool) -> tuple[np.ndarray, ...]:
        """(phrase and symbol before as one key, place, first place of each phrase) of all places."""
        before, _ = self._side(left)
        low, high = (intervals[:, c] for c in ((0, 1) if left else (2, 3)))
        sizes = high - low
        first = np.cumsum(sizes) - sizes
        at = np.repeat(low - first, sizes).astype(np.int32)
        at += np.arange(len(at), dtype=np.int32)
        key = np.repeat(np.arange(len(intervals)) * (self.n_symbols + 1), sizes)
        key += before[at]
        return key, at, first

    def counts(self, intervals: np.ndarray, left: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, symbol, count) of all phrases with one symbol more to the left or right.

        ``phrase`` is the row of the shorter phrase.
        """
        key = self._grouped(intervals, left)[0]
        key.sort()
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.diff(begins, append=len(key))
        phrase, symbol = key[begins] // (self.n_symbols + 1), key[begins] % (self.n_symbols + 1)
        real = symbol > 0
        return phrase[real], symbol[real], n[real]

    def extend(self, intervals: np.ndarray, left: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, symbol, intervals) of the same phrases."""
        key, at, first = self._grouped(intervals, left)
        _, place = self._side(left)
        own, other = ((0, 1), (2, 3)) if left else ((2, 3), (0, 1))
        order = np.argsort(key, kind="stable")
        key = key[order]
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        if not len(begins):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 4), np.int64)
        n = np.diff(begins, append=len(key))
        phrase, symbol = key[begins] // (self.n_symbols + 1), key[begins] % (self.n_symbols + 1)
        new = np.empty((len(begins), 4), np.int64)
        # the longer suffixes stand together, in the other order sorted by the new symbol
        new[:, own[0]] = np.minimum.reduceat(place[at[order]], begins)
        new[:, other[0]] = intervals[phrase, other[0]] + begins - first[phrase]
        new[:, own[1]], new[:, other[1]] = new[:, own[0]] + n, new[:, other[0]] + n
        real = symbol > 0
        return phrase[real], symbol[real], new[real]


def _factors(size: int) -> list[list[int]]:
    """Factors of the word numbers, for every hash."""
    return [[FACTORS[(i + h) % len(FACTORS)] for i in range(size)] for h in range(HASHES)]


class _Filter:
    """A set of phrases as bits; may hold phrases that were not put in, never lacks one."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.size = bits, size

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        held = np.ones(len(ids), bool)
        for factors in _factors(ids.shape[1]):
            cell = sum(f * (ids[:, i] % self.size) for i, f in enumerate(factors)) % self.size
            held &= (self.bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return held


def _prime_below(n: int) -> int:
    return next(p for p in range(n, 1, -1) if all(p % d for d in range(2, math.isqrt(p) + 1)))


def _filter_of(grams: DataFrame, size: int) -> _Filter:
    """The phrases of a written table as a filter of at most 2^27 bits, 16 MB to broadcast.

    Beyond some four million phrases it lets more through, which costs time and changes nothing.
    """
    cells = _prime_below(filter_bits(grams.count(), 32, 1 << 27))
    hashes = [
        reduce(Column.__add__, [F.col(f"w{i}") % cells * F.lit(f) for i, f in enumerate(factors)]) % cells + 1
        for factors in _factors(size)
    ]
    bits = np.zeros(((cells >> 15) + 1) << 12, np.uint8)
    for r in bitmaps(grams.select(F.explode(F.array(*hashes)).alias("cell"))).toLocalIterator():
        at = (r.bucket - 1) << 12
        bits[at : at + len(r.bitmap)] = np.frombuffer(r.bitmap, np.uint8)
    return _Filter(bits, cells)


def _phrases(index: PhraseIndex, ids: np.ndarray, size: int, filters: dict) -> tuple[np.ndarray, np.ndarray]:
    """(words of the shard, counts) of all phrases of ``size`` words around frequent shorter ones."""
    words, intervals = index.words[:, None], index.word_intervals
    for n in range(2, size + 1):
        left = n % 2 == 0
        step = index.counts if n == size else index.extend
        phrase, symbol, intervals = step(intervals, left)
        shorter = words[phrase]
        words = np.concatenate([symbol[:, None], shorter] if left else [shorter, symbol[:, None]], 1)
        if n > 2:
            # the other part that is one word shorter
            part = words[:, :-1] if left else words[:, 1:]
            kept = filters[n - 1](ids[part])
            words, intervals = words[kept], intervals[kept]
        if n in filters:
            kept = filters[n](ids[words])
            words, intervals = words[kept], intervals[kept]
    return words, intervals


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of several shards, each once, with their counts together."""
    rows, counts = (np.concatenate(x) for x in zip(*parts))
    if not len(rows):
        return rows, counts
    order = np.lexsort(rows.T)
    rows, counts = rows[order], counts[order]
    begins = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[begins], np.add.reduceat(counts, begins)


def _indexed_counts(shards: DataFrame, size: int, filters: dict, depth: int) -> DataFrame:
    """(w0, w1, ..., n) of the phrases of every shard (ids, numbers)."""
    columns = [f"w{i}" for i in range(size)]
    shared = shards.sparkSession.sparkContext.broadcast(filters)

    def sent(rows: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(counts), SENT_ROWS):
            part = rows[at : at + SENT_ROWS]
            arrays = [pa.array(part[:, i]) for i in range(size)]
            arrays.append(pa.array(counts[at : at + SENT_ROWS]))
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for ids, numbers in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(ids.as_py(), np.int64)
                index = PhraseIndex(np.frombuffer(numbers.as_py(), np.int32), len(ids) - 1, depth)
                words, counts = _phrases(index, ids, size, shared.value)
                del index
                if len(counts) > GATHERED_ROWS // 4:
                    for at in range(0, len(counts), SENT_ROWS):
                        yield from sent(ids[words[at : at + SENT_ROWS]], counts[at : at + SENT_ROWS])
                    continue
                held.append((ids[words], counts))
                if sum(len(c) for _, c in held) > GATHERED_ROWS:
                    held = [_summed(held)]
                    if len(held[0][1]) > GATHERED_ROWS // 2:
                        yield from sent(*held.pop())
                pa.default_memory_pool().release_unused()
        if held:
            yield from sent(*_summed(held))

    schema = ", ".join(f"{c} bigint" for c in [*columns, "n"])
    return shards.select("ids", "numbers").mapInArrow(run, schema)


def _renumbered(parts: pa.Table, known: pa.Table) -> pa.Table:
    """One shard with its frequent words numbered from 1 on, all others as breaks."""
    rows = sorted(zip(parts.column("number").to_pylist(), parts.column("numbers")))
    numbers = np.concatenate([np.frombuffer(r.as_py(), np.int32) for _, r in rows])
    local, ids = known.column("local").to_numpy(), known.column("id").to_numpy()
    new = np.zeros(int(max(numbers.max(initial=0), local.max(initial=0))) + 1, np.int32)
    new[local] = np.arange(1, len(local) + 1)
    numbers = new[numbers]
    again = np.zeros(len(numbers), bool)
    again[1:] = (numbers[1:] == NO_WORD) & (numbers[:-1] == NO_WORD)
    ids = np.concatenate([[-1], ids]).astype(np.int64)
    return pa.table({"ids": [ids.tobytes()], "numbers": [numbers[~again].tobytes()]})


def phrase_counts(
    docs: DataFrame, max_words: int = 4, min_count: int = 30, shard_words: int = 1 << 20
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """All words, and all phrases of 1 to ``max_words`` (up to 4) words found ``min_count`` times.

    Words are (lang, word, n).  Phrases of k words are (w0, ..., n) by the ids of their words;
    those of one word are (w0, lang, word, n).  Counts are per language, a null language is
    ``und``; occurrences may overlap but not cross the end of a piece or text.
    """
    written = materialize(word_shards(docs, shard_words), "phrase-shards")
    words = written.filter("numbers IS NULL")
    totals = materialize(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
    frequent = totals.filter(F.col("n") >= min_count)
    # written, so that an id stays with its word
    grams = {1: materialize(frequent.withColumn("w0", F.monotonically_increasing_id()), "phrase-frequent")}
    own = words.select("shard", "lang", "word", "number").join(
        grams[1].select("lang", "word", F.col("w0").alias("id")), ["lang", "word"]
    )
    parts = written.filter("numbers IS NOT NULL").select("shard", "number", "numbers")
    known = own.select(F.col("shard").alias("of"), F.col("number").alias("local"), "id")
    shards = parts.groupBy("shard").cogroup(known.groupBy("of"))
    renumbered = shards.applyInArrow(_shard_of, "ids binary, numbers binary")
    shards, filters = materialize(renumbered, "phrase-index"), {}
    for size in range(2, max_words + 1):
        counted = _indexed_counts(shards, size, filters, max(1, size - 1))
        keys = [f"w{i}" for i in range(size)]
        summed = counted.groupBy(*keys).agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
        grams[size] = materialize(summed, f"phrase-grams-{size}")
        filters[size] = _filter_of(grams[size], size)
    return totals, grams


def _shard_of(parts: pa.Table, known: pa.Table) -> pa.Table:
    if not parts.num_rows:
        return pa.table({"ids": pa.array([], pa.binary()), "numbers": pa.array([], pa.binary())})
    return _renumbered(parts, known)


def phrase_extensions(grams: dict[int, DataFrame], size: int) -> DataFrame:
    """(w0, ..., side, word_id, n): frequent phrases of ``size`` words with the words that
    frequently stand left or right of them."""
    longer, shorter = grams[size + 1], [f"w{i}" for i in range(size)]
    left = [F.col(f"w{i + 1}").alias(c) for i, c in enumerate(shorter)]
    sides = [
        longer.select(*left, F.lit("left").alias("side"), F.col("w0").alias("word_id"), "n"),
        longer.select(*shorter, F.lit("right").alias("side"), F.col(f"w{size}").alias("word_id"), "n"),
    ]
    return sides[0].unionByName(sides[1])


def _cut_scores(grams: dict[int, DataFrame], size: int) -> DataFrame:
    """(w0, ..., a, score, l, r) with the lowest-scoring cut of every phrase of ``size`` words."""
    keys = [f"w{i}" for i in range(size)]
    rows = grams[size].withColumnRenamed("n", "a")
    for k in range(1, size):
        # both parts of a frequent phrase are frequent, so no row is lost
        head = grams[k].select(*keys[:k], F.col("n").alias(f"l{k}"))
        tail = grams[size - k].select(
            *[F.col(f"w{i}").alias(f"w{i + k}") for i in range(size - k)], F.col("n").alias(f"r{k}")
        )
        rows = rows.join(head, keys[:k]).join(tail, keys[k:])

    def score(k: int) -> Column:
        whole = "CAST({} AS DECIMAL(20, 0))"
        both = f"{whole.format(f'l{k}')} + {whole.format(f'r{k}')}"
        return F.expr(f"CAST(2000000 AS DECIMAL(7, 0)) * {whole.format('a')} DIV ({both})")

    cuts = [
        F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        for k in range(1, size)
    ]
    lowest = F.array_min(F.array(*cuts))
    return rows.withColumn("cut", lowest).select(*keys, "a", "cut.score", "cut.l", "cut.r")


def _not_covered(rows: DataFrame, longer: DataFrame | None, size: int) -> DataFrame:
    """Phrases that no longer one holds at least four fifths as often.

    A phrase two words longer is not more frequent than the one between, which holds this
    phrase as well, so phrases that are one word longer decide.
    """
    if longer is None:
        return rows
    keys = [f"w{i}" for i in range(size)]
    shifted = [F.col(f"w{i + 1}").alias(c) for i, c in enumerate(keys)]
    parts = longer.select(*keys, "n").unionByName(longer.select(*shifted, "n"))
    most = parts.groupBy(*keys).agg(F.max("n").alias("longest"))
    met = rows.join(most, keys, "left")
    covered = F.expr("100 * CAST(longest AS DECIMAL(20, 0)) >= 80 * CAST(a AS DECIMAL(20, 0))")
    return met.filter(~F.coalesce(covered, F.lit(False))).drop("longest")


def collocations(
    docs: DataFrame,
    top: int = 2_000,
    max_words: int = 4,
    min_count: int = 30,
    shard_words: int = 1 << 20,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` best phrases of every language.

    Texts of ``docs`` (text, lang) are cut at ``PIECE_ENDS`` into pieces, A to Z are lower-cased,
    words are parted by spaces and tabs.  ``a``, ``l`` and ``r`` count a phrase and the two parts
    of its lowest-scoring cut, ``n`` all words of the language; the score is
    floor(2000000 a / (l + r)).  Equal scores go by ``a``, then by the phrase's bytes.  A null
    text has no word, a null language is ``und``; rows that repeat count as often as they are
    there; an empty table gives no row.  Other columns are not read.
    """
    totals, grams = phrase_counts(docs, max_words, min_count, shard_words)
    names = grams[1].select("w0", "lang", "word")
    listed = []
    for size in range(2, max_words + 1):
        rows = _not_covered(_cut_scores(grams, size), grams.get(size + 1), size)
        keys = F.array(*[F.col(f"w{i}") for i in range(size)])
        rows = rows.join(names.select("w0", "lang"), "w0")
        listed.append(rows.select("lang", keys.alias("ids"), "a", "l", "r", "score"))
    scored = reduce(DataFrame.unionByName, listed)
    by_score = [F.col("score").desc(), F.col("a").desc()]
    # words are looked up for the best alone, with all that tie with the last of them
    best = scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*by_score)))
    best = materialize(best.filter(F.col("place") <= top).drop("place"), "phrase-best")
    spelt = best.select("lang", "ids", F.posexplode("ids").alias("at", "w0"))
    spelt = spelt.join(names.select("w0", "word"), "w0").groupBy("lang", "ids")
    parts = F.sort_array(F.collect_list(F.struct("at", "word")))
    phrases = spelt.agg(F.array_join(parts["word"], " ").alias("phrase"))
    ranked = best.join(phrases, ["lang", "ids"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by_score, "phrase")).cast("bigint")
    )
    sizes = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    return (
        ranked.filter(F.col("rank") <= top)
        .join(F.broadcast(materialize(sizes, "phrase-langs")), "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
