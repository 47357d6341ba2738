"""Best-fit packing of tokenised documents into sequences of a fixed length.

Tasks tokenise texts into pieces of at most ``max_tokens`` tokens.  The narrow table of
pieces is dealt out by a hash, and each task packs its share in one pass over a stream:
a fixed number of open bins, found through a bitset with one bit per free space.  A piece
goes to the open bin with the least room that is enough for it; when one bin too many is
open, the fullest closes.  Memory is the open bins, whatever the share.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TOKENIZER = "word_bpe_49k.json"
END_OF_DOCUMENT = 1
#: A special token of the vocabulary, put between words that are encoded together.
MARK = "<|startoftext|>"
MARKED_WORDS = 4_096
ID_BYTES = 4
#: Bytes of texts tokenised together, and cached words before the cache starts anew.
BATCH_BYTES, CACHE_WORDS = 1 << 22, 600_000


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _words(text: bytes) -> list[bytes]:
    """Parts of a text that the vocabulary encodes independently.

    Its pre-tokeniser drops blanks, ignores case and cuts between a letter and an ASCII
    sign; cutting here as well leaves fewer different parts.  Special tokens are found
    before that, as they stand, so a text that may have one is cut at blanks alone.
    """
    if b"<|" in text:
        return text.split()  # bytes: the six ASCII blanks
    return _EDGE.sub(b" ", text.lower()).split()


_EDGE = re.compile(rb"(?<=[a-z])(?=[!-/:-@\[-`{-~])")


class WordEncoder:
    """Token ids, as little-endian bytes, of texts.

    The ids of a text are the ids of its parts in a row.  A part is encoded once per
    worker; new ones together in one text, between marks that become one known id each.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(definition)
        self.mark_id = self.tokenizer.token_to_id(MARK)
        self.known: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, "<u4")

    def _learn(self, words: list[bytes]) -> None:
        mark = MARK.encode()
        plain = [w for w in words if mark not in w]
        for at in range(0, len(plain), MARKED_WORDS):
            part = plain[at : at + MARKED_WORDS]
            ids = self._ids(mark.join(part).decode())
            ends = np.flatnonzero(ids == self.mark_id)
            starts = [0, *((ends + 1) * ID_BYTES).tolist()]
            stops = [*(ends * ID_BYTES).tolist(), len(ids) * ID_BYTES]
            raw = ids.tobytes()
            for word, lo, hi in zip(part, starts, stops, strict=True):
                self.known[word] = raw[lo:hi]
        if len(plain) < len(words):
            for word in set(words).difference(plain):
                self.known[word] = self._ids(word.decode()).tobytes()

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        words = [_words(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        self._learn(list(set().union(*words).difference(self.known)) if words else [])
        look = self.known.__getitem__
        for own in words:
            yield b"".join(map(look, own))


#: Encoders of this worker process: its tasks share words.
_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(definition: str) -> WordEncoder:
    key = zlib.crc32(definition.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(definition)
    return _ENCODERS[key]


def _runs(texts: list[bytes]) -> Iterator[list[int]]:
    """Indexes in runs of about BATCH_BYTES."""
    run, size = [], 0
    for i, t in enumerate(texts):
        run.append(i)
        size += len(t)
        if size >= BATCH_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def token_pieces(
    docs: DataFrame, tokenizer_path: str, max_tokens: int = 4096, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row of ``docs``.

    A document's tokens are the ids of its text (null: none) and the end-of-document id;
    only a document of more than ``max_tokens`` is cut.  ``ids`` are little-endian
    unsigned 32-bit numbers.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        # one vocabulary file, a few megabytes whatever the input
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    schema = docs.select("doc_id").schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        schema = schema.add(name, kind)
    if with_ids:
        schema = schema.add("ids", "binary")
    end = END_OF_DOCUMENT.to_bytes(ID_BYTES, "little")
    step = max_tokens * ID_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for indexes in _runs(texts):
                owner, columns = [], [[], [], [], [], []]
                for i, ids in zip(indexes, encoder([texts[i] for i in indexes])):
                    ids += end
                    for number, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        owner.append(i)
                        values = (number, at // ID_BYTES, len(part) // ID_BYTES, zlib.crc32(part), part)
                        for column, value in zip(columns, values):
                            column.append(value)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [batch.column(0).take(pa.array(owner, pa.int64()))]
                arrays += [pa.array(c, k) for c, k in zip(columns, kinds)][: len(schema) - 1]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


class BestFit:
    """Bounded-space online best fit; ``add`` places a length and may close a bin."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0  # bit f: some open bin has f tokens free
        self.n_open = self.n_bins = 0

    def add(self, length: int) -> tuple[int, int]:
        """Number of the bin and the offset in it."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            number, free = self.n_bins, self.capacity
            self.n_bins += 1
            self.n_open += 1
        rest = free - length
        if rest:
            self.by_free[rest].append(number)
            self.bits |= 1 << rest
            if self.n_open > self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.n_open -= 1
        else:
            self.n_open -= 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        return number


def pack(
    pieces: DataFrame, max_tokens: int = 4096, open_bins: int = 8192
) -> DataFrame:
    """Add (sequence_id, offset) to rows with a ``length`` of at most ``max_tokens``.

    Offsets in a sequence are gapless from 0.  Rows are dealt out by a hash of all their
    columns and sorted by it, so the result depends on the rows and the number of
    shares alone and a lost task makes the same sequences again.  Adaptive execution
    sets the shares by their bytes; every share may leave up to ``open_bins`` sequences
    with room.  Fields that are not packed (ids, say) travel along.
    """
    schema = StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")
    at, width = pieces.columns.index("length"), len(pieces.columns)
    order = F.xxhash64(*[F.col(c) for c in pieces.columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(max_tokens, open_bins)
        share = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.add(n) for n in batch.column(at).to_pylist()]
            arrays = batch.columns[:width] + [
                pa.array([share + n for n, _ in placed], pa.int64()),
                pa.array([o for _, o in placed], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    dealt = pieces.withColumn("_order", order).repartition("_order").sortWithinPartitions("_order")
    return dealt.drop("_order").mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    max_tokens: int = 4096,
    open_bins: int = 8192,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their place: one row per piece.

    A null or empty text is a document of the end id alone.  Rows that repeat are packed
    as often as they are there; a null doc_id stays null.  Other columns are not read.
    """
    path = tokenizer_path or default_tokenizer_path()
    return pack(token_pieces(docs, path, max_tokens, with_ids), max_tokens, open_bins)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) from packed rows with ids; a group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
    )
