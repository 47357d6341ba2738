"""Removal of byte strings that occur earlier in the corpus, with suffix arrays.

A byte goes if a string of ``min_bytes`` bytes that covers it also starts earlier: in a
document with a smaller id, or earlier in the same document.

*Cutting work.*  Every window of ``min_bytes`` bytes belongs to one anchor, the gram of
``GRAM`` bytes with the smallest hash inside it (the leftmost of equals).  Equal windows
have equal anchors at the same place, so a window can only be found again under its own
anchor.  The windows of one occurrence of an anchor are neighbours; the bytes they cover
are its passage.  Anchors that occur once in the corpus are passed over with a filter of
bounded size.

*Sorting.*  The passages of one anchor meet in one place, in corpus order.  A passage that
is there already is covered whole.  The different passages of many anchors are put in a
row and sorted by one suffix array over their words (``suffix_sort``).  Words end with a
blank, so none is a prefix of another and word order is byte order; with the common
prefixes of neighbours, counted in bytes, the array tells which windows are equal from
their first word boundary on, and the bytes before it are compared by hash.

An anchor with more different passages than ``max_passages`` is never gathered in a task:
its windows are listed one by one and their first places found by an aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import bitmaps, filter_bits, with_bit
from threadlens.llm.suffix_sort import suffix_array
from threadlens.sources.tables import materialize

GRAM = 36
#: Bytes handled at once; a longer document is cut into overlapping parts of PART bytes.
CHUNK, PART = 1 << 16, 1 << 23
#: Bytes of passages sorted by one suffix array.
SORT_BYTES = 1 << 18
#: Anchor positions take these low bits of the sort key of a gram.
POSITION_BITS = 24
BITMAP_BITS = 32_768
#: Documents without an id come after all others.
NO_ID = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTERS_2 = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & ((1 << 64) - 1)))
    out[0] = 1
    return np.multiply.accumulate(out)


class RollingHash:
    """64-bit hashes of any part of a byte array, equal for equal parts."""

    def __init__(self, data: np.ndarray, letters: np.ndarray = _LETTERS):
        n = len(data)
        self.up = _powers(_BASE, n + 1)
        down = _powers(pow(_BASE, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(letters[data] * down[:n], out=self.sums[1:])

    def __call__(self, lo, hi) -> np.ndarray:
        h = (self.sums[hi] - self.sums[lo]) * self.up[lo]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, out = 1, values
    while 2 * n <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    if n < width:
        out = np.minimum(out[: len(out) - (width - n)], out[width - n :])
    return out


def anchored(data: np.ndarray, owner: np.ndarray, min_bytes: int):
    """(anchor, passage, first window, last window) of all passages; windows do not cross owners.

    ``anchor`` and ``passage`` are hashes; windows are counted by their first byte.
    """
    none = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    if len(data) < min_bytes:
        return none
    hashes = RollingHash(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = hashes(slice(0, len(at)), slice(GRAM, None))
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = _sliding_min((grams & ~low) | at.astype(np.uint64), min_bytes - GRAM + 1)
    inside = owner[: len(least)] == owner[min_bytes - 1 :]
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(least)) - 1
    keep = inside[first]
    first, last = first[keep], last[keep]
    place = (least[first] & low).astype(np.int64)
    shape = ((place - first) * 256 + (last - first)).astype(np.uint64)
    passage = hashes(first, last + min_bytes) ^ (shape * np.uint64(0xD6E8FEB86659FD93))
    return grams[place], passage, first, last


def _chunks(texts: list[bytes], min_bytes: int):
    """(document index, data, owner, start of every row of data in its document)."""
    run, size = [], 0
    for i, text in enumerate(texts):
        if len(text) < min_bytes:
            continue
        if len(text) > PART:
            # parts overlap by what one window needs, and each window is in one part
            step = PART - min_bytes + 1
            for at in range(0, len(text) - min_bytes + 1, step):
                yield [(i, at, text[at : at + PART])]
            continue
        run.append((i, 0, text))
        size += len(text)
        if size >= CHUNK:
            yield run
            run, size = [], 0
    if run:
        yield run


def _passages(texts: list[bytes], min_bytes: int):
    """Per chunk: its bytes and (document, anchor, passage, first window in it, in the chunk, count)."""
    for run in _chunks(texts, min_bytes):
        data = b"".join(t for _, _, t in run)
        sizes = np.array([len(t) for _, _, t in run])
        owner = np.repeat(np.arange(len(run), dtype=np.int32), sizes)
        anchor, passage, first, last = anchored(np.frombuffer(data, np.uint8), owner, min_bytes)
        own = owner[first]
        begin = np.cumsum(sizes) - sizes - np.array([at for _, at, _ in run])
        document = np.array([i for i, _, _ in run])[own]
        yield data, document, anchor, passage, first - begin[own], first, last - first + 1


def _anchors(rows: DataFrame, min_bytes: int) -> DataFrame:
    """One row per passage with its ``anchor``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, anchor, *_ in _passages(batch.column(0).to_pylist(), min_bytes):
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64))], names=["anchor"])

    return rows.select("text").mapInArrow(run, "anchor bigint")


def _bitmap(cells: DataFrame, bits: int) -> np.ndarray:
    """Filter with the bits ``cell`` (from 1) set; bits / 8 bytes whatever the input."""
    out = np.zeros(bits // 8 + BITMAP_BITS // 8, np.uint8)
    for bucket, bitmap in bitmaps(cells).toLocalIterator():
        at = (bucket - 1) * BITMAP_BITS // 8
        out[at : at + len(bitmap)] = np.frombuffer(bytes(bitmap), np.uint8)
    return out


def repeated_anchors(rows: DataFrame, min_bytes: int, bits_per_anchor: int, max_bits: int):
    """(bitmap, bits) with the cells of all anchors that occur twice or more."""
    counts = _anchors(rows, min_bytes).groupBy("anchor").count().filter("count > 1")
    twice = materialize(counts.select("anchor"), "suffix-anchors")
    bits = filter_bits(twice.count(), bits_per_anchor, max_bits)
    cell = F.col("anchor").bitwiseAND(F.lit(bits - 1)) + 1
    return _bitmap(twice.select(cell.alias("cell")), bits), bits


def _occurrences(rows: DataFrame, bitmap, bits: int, min_bytes: int) -> DataFrame:
    """Passages whose anchor may occur again: (anchor, passage, doc, tie, first, windows, bytes).

    ``bytes`` are there for the first of equal passages that a task sees at once.
    """
    schema = (
        "anchor bigint, passage bigint, doc bigint, tie bigint, first bigint, windows int, bytes binary"
    )
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    mask = np.uint64(bits - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            doc, tie = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for data, index, anchor, passage, first, start, n in _passages(
                batch.column(0).to_pylist(), min_bytes
            ):
                cell = (anchor & mask).astype(np.int64)
                found = (cells[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1
                keep = np.flatnonzero(found)
                if not len(keep):
                    continue
                index, anchor, passage = index[keep], anchor[keep], passage[keep]
                first, start, n = first[keep], start[keep], n[keep]
                new = np.zeros(len(keep), bool)
                new[np.unique(anchor ^ (passage * np.uint64(3)), return_index=True)[1]] = True
                parts = [
                    data[s : s + k + min_bytes - 1] if fresh else None
                    for s, k, fresh in zip(start.tolist(), n.tolist(), new.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(passage.view(np.int64)),
                        pa.array(doc[index]),
                        pa.array(tie[index]),
                        pa.array(first),
                        pa.array(n.astype(np.int32)),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["anchor", "passage", "doc", "tie", "first", "windows", "bytes"],
                )

    return rows.select("text", "doc", "tie").mapInArrow(run, schema)


def _words(data: bytes) -> list[bytes]:
    """Words with the blank that ends each; what follows the last blank is the last word."""
    words, at = [], 0
    blanks = np.flatnonzero(_IS_BLANK[np.frombuffer(data, np.uint8)]) + 1
    for end in blanks.tolist():
        words.append(data[at:end])
        at = end
    if at < len(data):
        words.append(data[at:])
    return words


_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True


def repeated_windows(passages: list[tuple], min_bytes: int) -> list[np.ndarray]:
    """For each passage (doc, tie, first, windows, bytes): which windows occur before.

    Before means at a smaller (doc, tie, first byte); the passages are in that order.
    """
    words = [_words(p[4]) for p in passages]
    names = {w: i + 1 for i, w in enumerate(sorted(set().union(*words)))}
    text, starts, rest, offset = [], [], [], 0
    for own in words:
        at, size = offset, sum(map(len, own))
        for w in own:
            text.append(names[w])
            starts.append(at)
            at += len(w)
            rest.append(offset + size - starts[-1])
        text.append(0)  # ends the passage; its own start is never asked for
        starts.append(-1)
        rest.append(0)
        offset += size
    data = np.frombuffer(b"".join(p[4] for p in passages) + bytes(min_bytes), np.uint8)
    starts, rest = np.array(starts), np.array(rest)
    order = np.array(suffix_array(text))
    order = order[starts[order] >= 0]
    where, left = starts[order], np.minimum(rest[order], min_bytes)
    # bytes that neighbours in the array have in common
    view = np.lib.stride_tricks.sliding_window_view(data, min_bytes)
    common = np.zeros(len(order), np.int64)
    for at in range(1, len(order), 1 << 14):
        part = slice(at, min(at + (1 << 14), len(order)))
        before = slice(part.start - 1, part.stop - 1)
        differ = view[where[part]] != view[where[before]]
        equal = np.where(differ.any(axis=1), differ.argmax(axis=1), min_bytes)
        common[part] = np.minimum(equal, np.minimum(left[part], left[before]))
    rank = np.empty(len(starts), np.int64)
    rank[order] = np.arange(len(order))

    # all windows: passage, first byte in the data, distance to the next start of a word
    sizes = np.array([len(p[4]) for p in passages])
    n_windows = sizes - min_bytes + 1
    of = np.repeat(np.arange(len(passages)), n_windows)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    window = (np.cumsum(sizes) - sizes)[of] + step
    word_rows = np.flatnonzero(starts >= 0)
    word_starts = starts[word_rows]
    # a word starts after a blank that is in the window; its first byte may be inside a word
    nxt = np.searchsorted(word_starts, window, side="right")
    inner = nxt < len(word_starts)
    boundary = np.where(inner, word_starts[np.minimum(nxt, len(word_starts) - 1)], len(data))
    lead = np.minimum(boundary - window, min_bytes)
    hashes = RollingHash(data)
    head = hashes(window, window + lead)
    group = np.zeros(len(window), np.int64)
    by_lead = np.argsort(lead, kind="stable")
    cuts = np.searchsorted(lead[by_lead], np.arange(min_bytes + 1))
    for size in range(min_bytes):
        own = by_lead[cuts[size] : cuts[size + 1]]
        if len(own):
            classes = np.cumsum(common < min_bytes - size)
            group[own] = classes[rank[word_rows[nxt[own]]]]
    # passages are in corpus order, and so are their windows: the first of equals comes first
    key = (head * np.uint64(3) + group.astype(np.uint64)) * np.uint64(_BASE) + lead.astype(np.uint64)
    keys = np.argsort(key, kind="stable")
    found = np.zeros(len(keys), bool)
    found[keys[1:]] = key[keys[1:]] == key[keys[:-1]]
    return np.split(found, np.cumsum(n_windows)[:-1])


def _runs(found: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], found, [False]]).astype(np.int8)))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


_COVER = "doc bigint, tie bigint, lo bigint, hi bigint, bytes binary"


class _Covers:
    """Rows (doc, tie, lo, hi, bytes): covered bytes, or with bytes a passage left over."""

    def __init__(self):
        self.columns = [[], [], [], [], []]

    def add(self, doc, tie, lo, hi, data=None):
        for column, value in zip(self.columns, (doc, tie, lo, hi, data)):
            column.append(value)

    def flush(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(self.columns, kinds)]
        self.columns = [[], [], [], [], []]
        return pa.RecordBatch.from_arrays(arrays, names=["doc", "tie", "lo", "hi", "bytes"])


def _sorted_covers(min_bytes: int, max_passages: int):
    """mapInArrow function over occurrences sorted by (anchor, passage, doc, tie, first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Covers()
        waiting: list[tuple] = []  # passages of finished anchors, to be sorted together
        waiting_bytes = 0
        anchor = passage = key = None
        current: list[list] = []  # different passages of this anchor: doc, tie, first, windows, bytes
        n_current = 0  # with those already handed on

        def hand_on():
            """The anchor has too many passages; what is complete leaves the task."""
            for doc, tie, first, n, data in current:
                out.add(doc, tie, first, first + n + min_bytes - 1, data)
            current.clear()

        def finish():
            nonlocal waiting_bytes, n_current
            if n_current > max_passages:
                hand_on()
            elif n_current > 1:
                waiting.extend(map(tuple, current))
                waiting_bytes += sum(len(p[4]) for p in current)
            current.clear()
            n_current = 0

        def sort_waiting():
            nonlocal waiting_bytes
            waiting.sort(key=lambda p: p[:3])
            for p, found in zip(waiting, repeated_windows(waiting, min_bytes) if waiting else ()):
                for a, b in _runs(found):
                    out.add(p[0], p[1], p[2] + a, p[2] + b + min_bytes)
            waiting.clear()
            waiting_bytes = 0

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            anchors, passages, docs, ties, firsts, counts = columns
            data = batch.column(6)
            n = len(anchors)
            change = np.ones(n, bool)
            change[1:] = (anchors[1:] != anchors[:-1]) | (passages[1:] != passages[:-1])
            change[0] = anchor is None or (anchors[0], passages[0]) != (anchor, passage)
            starts = np.flatnonzero(change)
            # a passage that is there already is covered, unless the row itself is repeated
            head = np.repeat(starts, np.diff(np.append(starts, n)))
            again = np.flatnonzero(~change)
            lead = n - len(head)  # rows that go on from the last batch
            if lead and current and current[-1][4] is None:
                current[-1][4] = next((x.as_py() for x in data[:lead] if x.is_valid), None)
            if lead:
                other = (docs[:lead] != key[0]) | (ties[:lead] != key[1]) | (firsts[:lead] != key[2])
                early = np.flatnonzero(other)
            else:
                early = np.empty(0, np.int64)
            own = again[again >= lead]
            of = head[own - lead]
            differ = (docs[own] != docs[of]) | (ties[own] != ties[of]) | (firsts[own] != firsts[of])
            own = np.concatenate([early, own[differ]])
            if len(own):
                lo = firsts[own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[own]),
                        pa.array(ties[own]),
                        pa.array(lo),
                        pa.array(lo + counts[own] + min_bytes - 1),
                        pa.nulls(len(own), pa.binary()),
                    ],
                    names=["doc", "tie", "lo", "hi", "bytes"],
                )
            stops = np.append(starts[1:], n)
            for s, e in zip(starts.tolist(), stops.tolist()):
                if anchors[s] != anchor:
                    finish()
                    if waiting_bytes >= SORT_BYTES:
                        sort_waiting()
                    anchor = anchors[s]
                elif len(current) > max_passages and current[-1][4] is not None:
                    hand_on()
                passage = passages[s]
                value = next((x.as_py() for x in data[s:e] if x.is_valid), None)
                key = docs[s], ties[s], firsts[s]  # of the first place of the passage
                current.append([int(docs[s]), int(ties[s]), int(firsts[s]), int(counts[s]), value])
                n_current += 1
            yield out.flush()
        finish()
        sort_waiting()
        yield out.flush()

    return run


def _listed_covers(left: DataFrame, min_bytes: int) -> DataFrame:
    """Covers of the passages left over, window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie, lo = (batch.column(i).to_pylist() for i in range(3))
            for d, t, first, data in zip(doc, tie, lo, batch.column(4).to_pylist()):
                raw = np.frombuffer(data, np.uint8)
                at = np.arange(len(raw) - min_bytes + 1)
                one, two = (RollingHash(raw, x)(at, at + min_bytes) for x in (_LETTERS, _LETTERS_2))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array(np.full(len(at), d)),
                        pa.array(np.full(len(at), t)),
                        pa.array(first + at),
                    ],
                    names=["one", "two", "doc", "tie", "lo"],
                )

    windows = left.mapInArrow(run, "one bigint, two bigint, doc bigint, tie bigint, lo bigint")
    windows = materialize(windows, "suffix-windows")
    earliest = windows.groupBy("one", "two").agg(F.min(F.struct("doc", "tie", "lo")).alias("at"))
    again = windows.join(earliest, ["one", "two"]).filter(F.struct("doc", "tie", "lo") != F.col("at"))
    return again.select("doc", "tie", "lo", (F.col("lo") + min_bytes).alias("hi"))


def _documents(docs: DataFrame) -> DataFrame:
    """The rows with their bytes and their place in the corpus (doc, tie)."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.withColumns(
        {
            "_bytes": text,
            "_doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)),
            "_tie": F.xxhash64(text),
        }
    )


def repeated_spans(
    docs: DataFrame,
    min_bytes: int = 100,
    max_passages: int = 20_000,
    bits_per_anchor: int = 16,
    max_bits: int = 1 << 27,
) -> DataFrame:
    """(doc, tie, spans): the covered bytes [lo, hi) of each document that has some.

    The spans of a document are an array, not yet merged; there are at most as many as
    windows in the document.
    """
    if not GRAM < min_bytes <= 256:
        raise ValueError(f"min_bytes must be over {GRAM} and at most 256")
    rows = _documents(docs).select(
        F.col("_bytes").alias("text"), F.col("_doc").alias("doc"), F.col("_tie").alias("tie")
    )
    bitmap, bits = repeated_anchors(rows, min_bytes, bits_per_anchor, max_bits)
    keys = ["anchor", "passage", "doc", "tie", "first"]
    met = (
        _occurrences(rows, bitmap, bits, min_bytes)
        .repartition("anchor")
        .sortWithinPartitions(*keys)
        .mapInArrow(_sorted_covers(min_bytes, max_passages), _COVER)
    )
    covers = materialize(met, "suffix-covers")
    found = covers.filter("bytes is null").select("doc", "tie", "lo", "hi")
    left = covers.filter("bytes is not null")
    if left.take(1):
        found = found.unionByName(_listed_covers(left, min_bytes))
    return found.groupBy("doc", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows with their spans; rows without one do not move.

    Which documents have spans is told by a filter of bounded size; only those it lets
    through are joined.
    """
    spans = materialize(spans, "suffix-spans")
    bits = filter_bits(spans.count(), 16, 1 << 27)
    cell = lambda d, t: F.xxhash64(d, t).bitwiseAND(F.lit(bits - 1)) + 1
    table = bitmaps(spans.select(cell("doc", "tie").alias("cell")))
    rows = with_bit(_documents(docs), cell("_doc", "_tie"), table, "_some")
    some = rows.filter("_some")
    met = some.join(
        spans.withColumnsRenamed({"doc": "_d", "tie": "_t", "spans": "_spans"}),
        (some["_doc"] == F.col("_d")) & (some["_tie"] == F.col("_t")),
        "left",
    ).drop("_d", "_t", "_some")
    alone = rows.filter("not _some").drop("_some")
    empty = F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>")
    return alone.withColumn("_spans", empty).unionByName(met)


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for lo, hi in runs:
        parts.append(data[at:lo])
        at = hi
    parts.append(data[at:])
    return b"".join(parts)


def remove_repeats(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of ``docs``.

    ``kept`` are the remaining bytes; cuts may fall inside a character, so they are bytes.
    Null texts are empty.  Documents follow their doc_id, then a hash of their text; rows
    without an id come last.  Rows that share id and text count as one document and get
    the same result.  Other columns are not read.
    """
    narrow = docs.select("doc_id", "text")
    rows = _with_spans(narrow, repeated_spans(narrow, **settings)).select(
        "doc_id", "_bytes", "_spans"
    )
    schema = docs.select("doc_id").schema
    for name, kind in (
        ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept", "binary"),
    ):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1), batch.column(2)
            size, gone, n_runs, digest, rest = [], [], [], [], []
            for text, own in zip(texts, spans):
                data, runs = text.as_py(), merged(own.as_py())
                left = _kept(data, runs)
                size.append(len(data))
                gone.append(len(data) - len(left))
                n_runs.append(len(runs))
                digest.append(hashlib.sha256(left).hexdigest())
                rest.append(left)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array(c, k) for c, k in zip((size, gone, n_runs, digest, rest), kinds)],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)
