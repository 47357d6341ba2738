"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

A prefix's last token decides its count: one more than that of the prefix before the token.
Of the vocabulary's strings that end a prefix exactly one follows the last token of the
shorter prefix in a way that merging leaves as it is, so a text is read once, from left to
right, and the counts of all its prefixes come with it.  They are stored as one signed byte
a character, with running counts at regular marks; how many tokens a cut text has, or how
much of it fits a budget, is then read off without encoding anything again.

Tokens never reach over characters that are neighbours in no string of the vocabulary, so a
text falls into short units, whose counts a worker keeps.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from threadlens.llm.common import text_of

TOKENIZER = "piece_bpe_32k.model"
#: The vocabulary's sign for a space; one is also put before every text that is not empty.
SPACE = "▁"
#: Characters between two stored running counts.
MARK_CHARS = 1_024
#: Units a worker keeps, their greatest length, and text of one output batch.
KEPT_UNITS, KEPT_CHARS, BATCH_CHARS = 1_000_000, 64, 1 << 22


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class PrefixCounter:
    """Changes of the token count from each character of a unit to the next."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_proto=model)
        numbers = range(library.get_piece_size())
        plain = [
            i
            for i in numbers
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))
        ]
        self.score = {library.id_to_piece(i): library.get_score(i) for i in plain}
        self.longest = max(map(len, self.score))
        self.follows: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.units = re.compile(self._unit_pattern(), re.DOTALL).findall

    def _unit_pattern(self) -> str:
        """Signs for spaces with what may share a token with them, then other characters.

        Characters that are neighbours in a string of the vocabulary are of one kind; a
        unit has characters of one kind, since no token has two kinds.
        """
        kind: dict[str, str] = {}

        def root(c: str) -> str:
            while kind.setdefault(c, c) != c:
                kind[c] = kind[kind[c]]
                c = kind[c]
            return c

        for piece in self.score:
            inner = piece.lstrip(SPACE)
            if SPACE in inner:
                raise ValueError(f"a string of the vocabulary goes on after a space: {piece!r}")
            for a, b in zip(inner, inner[1:]):
                kind[root(a)] = root(b)
        members: dict[str, list[str]] = {}
        for c in kind:
            members.setdefault(root(c), []).append(c)
        classes = ["[" + "".join(map(re.escape, sorted(m))) + "]" for m in members.values() if len(m) > 1]
        classes.sort(key=len, reverse=True)
        return f"{SPACE}*(?:{'|'.join(f'{c}+' for c in classes)}|[^{SPACE}])|{SPACE}+"

    def merged(self, text: str) -> list[str]:
        """Tokens of a short string: the best-scored neighbours merge first, the leftmost of equals."""
        parts = list(text)
        while True:
            found = [
                (-self.score[a + b], i)
                for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in self.score
            ]
            if not found:
                return parts
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _may_follow(self, before: str, token: str) -> bool:
        key = (before, token)
        if key not in self.follows:
            if len(self.follows) > KEPT_UNITS:
                self.follows.clear()
            # nothing before: the token has to be what its own characters merge to
            wanted = [before, token] if before else [token]
            self.follows[key] = self.merged(before + token) == wanted
        return self.follows[key]

    def _learn(self, units: list[str]) -> None:
        """Find the changes of new units; those that begin alike share the work on what they share."""
        score, longest, may_follow = self.score, self.longest, self._may_follow
        last, count, before = [""], [0], ""
        for unit in sorted(units):
            same = 0
            for a, b in zip(before, unit):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :]
            for end in range(same + 1, len(unit) + 1):
                for start in range(max(0, end - longest), end - 1):
                    token = unit[start:end]
                    if token in score and may_follow(last[start], token):
                        last.append(token)
                        count.append(count[start] + 1)
                        break
                else:
                    c = unit[end - 1]
                    last.append(c)
                    # characters without an own token are written as their bytes
                    count.append(count[end - 1] + (1 if c in score else len(c.encode())))
            self.known[unit] = bytes([(b - a) & 255 for a, b in zip(count, count[1:])])
            before = unit

    def changes(self, texts: list[str]) -> Iterator[bytes]:
        """One signed byte per character of every text; the first includes the sign put before it."""
        listed = [self.units(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > KEPT_UNITS:
            self.known.clear()
        new = set().union(*listed).difference(self.known)
        self._learn(list(new))
        look = self.known.__getitem__
        for units in listed:
            joined = b"".join(map(look, units))
            first = int.from_bytes(joined[:1], signed=True) + int.from_bytes(joined[1:2], signed=True)
            yield first.to_bytes(1, signed=True) + joined[2:] if joined else b""
        for unit in new:
            if len(unit) > KEPT_CHARS:
                del self.known[unit]


#: Counters of this worker process: its tasks share units.
_COUNTERS: dict[int, PrefixCounter] = {}


def _counter(model: bytes) -> PrefixCounter:
    key = zlib.crc32(model)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PrefixCounter(model)
    return _COUNTERS[key]


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of about ``BATCH_CHARS`` characters."""
    begin = size = 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= BATCH_CHARS or i == len(texts):
            yield begin, i
            begin, size = i, 0


def prefix_counts(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_chars, n_tokens, marks, changes) of every row of ``docs``.

    ``changes`` has one signed byte per character (code point): the token count of the
    text cut after it less that of the text cut before it.  ``marks`` has the counts
    after every ``MARK_CHARS`` characters.  The vocabulary is a sentencepiece BPE model
    with byte fallback, without normalisation; tokens for begin and end are not counted
    and their strings are ordinary text.  Null texts count as empty and have no token;
    rows that repeat come back as often as they are there, a null doc_id stays null, an
    empty table gives no row.  Other columns are not read.
    """
    with open(tokenizer_path or default_tokenizer_path(), "rb") as file:
        # one vocabulary file, half a megabyte whatever the input
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    text = text_of()
    rows = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    schema = StructType([*rows.drop("text").schema.fields])
    schema = schema.add("n_chars", "long").add("n_tokens", "long")
    schema = schema.add("marks", ArrayType(LongType())).add("changes", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in _runs(texts):
                found = []
                for own, changes in zip(texts[lo:hi], counter.changes(texts[lo:hi])):
                    counts = np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)
                    total = int(counts[-1]) if len(counts) else 0
                    found.append((len(own), total, counts[MARK_CHARS - 1 :: MARK_CHARS].tolist(), changes))
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                arrays = [batch.column(c).slice(lo, hi - lo) for c in (0, 1)]
                arrays += [pa.array(v, k) for v, k in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


def _counts(changes: bytes) -> np.ndarray:
    """Token counts after 0, 1, 2, ... characters."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)])


def tokens_at(index: DataFrame, position: str) -> DataFrame:
    """Rows of ``prefix_counts`` with ``tokens``: those of the text cut after ``position``
    characters.  A position that is null, negative or beyond the end has none (null).

    Reads the mark before the position and fewer than ``MARK_CHARS`` changes after it.
    """
    part = F.floor(F.col(position) / MARK_CHARS).cast("int")
    mark = F.when(part > 0, F.get(F.col("marks"), part - 1)).otherwise(F.lit(0))
    tail = F.expr(
        f"substring(changes, CAST(FLOOR({position} / {MARK_CHARS}) * {MARK_CHARS} + 1 AS INT),"
        f" CAST({position} % {MARK_CHARS} AS INT))"
    )
    digits = F.hex(tail)
    # two hexadecimal digits are one signed byte
    values = F.transform(
        F.when(F.length(digits) > 0, F.sequence(F.lit(1), F.length(digits) - 1, F.lit(2))),
        lambda i: F.conv(F.substring(digits, i, F.lit(2)), 16, 10).cast("bigint"),
    )
    signed = F.transform(values, lambda v: F.when(v > 127, v - 256).otherwise(v))
    added = F.aggregate(F.coalesce(signed, F.array().cast("array<bigint>")), F.lit(0).cast("bigint"), lambda a, v: a + v)
    inside = F.col(position).between(0, F.col("n_chars"))
    return index.withColumn("tokens", F.when(inside, mark + added))


def longest_prefixes(index: DataFrame, budgets: list[int]) -> DataFrame:
    """(doc_id, budget, kept_chars, kept_tokens): one row per row of ``prefix_counts`` and budget.

    ``kept_chars`` is the length of the longest prefix of at most ``budget`` tokens.
    """
    wanted = sorted(set(budgets))
    schema = StructType([index.schema["doc_id"]])
    for name in ("budget", "kept_chars", "kept_tokens"):
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, found = [], []
            for i, changes in enumerate(batch.column(1).to_pylist()):
                counts = _counts(changes)
                # the least count from here to the end decides whether a longer prefix fits
                least = np.minimum.accumulate(counts[::-1])[::-1]
                for budget in wanted:
                    kept = int(np.searchsorted(least, budget, "right")) - 1
                    owner.append(i)
                    found.append((budget, kept, int(counts[kept]) if kept >= 0 else None))
            columns = list(zip(*found)) or [(), (), ()]
            arrays = [batch.column(0).take(pa.array(owner, pa.int64()))]
            arrays += [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return index.select("doc_id", "changes").mapInArrow(run, schema)


def token_counts(docs: DataFrame, max_tokens: int = 4_096, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): the count at the last prefix of every text."""
    counted = prefix_counts(docs, tokenizer_path)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit")
    )
