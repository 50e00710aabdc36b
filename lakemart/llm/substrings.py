"""Substring dedup by De Bruijn compaction.

Token k-mers are the edges of a De Bruijn graph (an edge leads from its first
k-1 tokens to its last k-1). Of every ``window``-word window its smallest
k-mer by hash (the first of equals) stands for it, so equal windows have the
same edge at the same place and only about one k-mer in (window-k+2)/2 is
shuffled.

1. Each document lists its edges with source coordinates: the range of
   windows the edge stands for, the edge's 64-bit hash, and a 64-bit digest
   (to another base) of the tokens of that range: the edge with its
   extensions.
2. Edges are counted. An edge that occurs once holds no repeated window. A
   repeated edge that always has the same extensions is non-branching: a join
   hands that back to its occurrences, whose windows all repeat, and adjacent
   ones compact into one path (spans are unions).
3. Only at branching edges source coordinates are verified: their windows'
   two 64-bit digests are counted, and repeated ones add to the spans.
4. Words under a span are removed.

Counts aggregate before the shuffle, joins back are splittable equi-joins; a
text is shuffled at most once, by its row's key. Windows are equal if 128
bits of polynomial hashes over 64-bit word hashes are (edge and extensions,
or the window's two digests).

Defined cases: null texts and texts shorter than the window lose nothing
(null: kept text null, digest of the empty string); rows equal in id and text
repeat each other and lose all they cover; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import annotate, apart, persisted, row_key

WINDOW = 35
K = 12
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while self.up.size < n:
            top = self.up[-1:] * self.base, self.down[-1:] * self.inverse
            self.up = np.concatenate((self.up, self.up * top[0]))
            self.down = np.concatenate((self.down, self.down * top[1]))
        return self.up[:n], self.down[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads differences."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = tuple(_Powers(b) for b in _BASES)
_BYTE_POWERS = _Powers(np.uint64(0xD6E8FEB86659FD93))
_BYTES = _mix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
#: Bytes of text worked on together (a longer text alone).
_CHUNK = 1 << 20
#: Bits of a packed range's size; its start has the rest.
_BITS = 17


def _ranges(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... (size[0] numbers), lo[1], ..."""
    before = np.cumsum(size) - size
    return np.repeat(lo - before, size) + np.arange(int(size.sum()))


def _offsets(a: pa.Array) -> np.ndarray:
    """Where the values of a binary, text or list array begin, and the end."""
    large = pa.types.is_large_binary(a.type) or pa.types.is_large_string(a.type) or pa.types.is_large_list(a.type)
    return np.frombuffer(a.buffers()[1], np.int64 if large else np.int32)[a.offset:a.offset + len(a) + 1].astype(np.int64)


class Texts:
    """Some texts as one sequence of words with digests of word ranges in
    constant time. ``start`` and ``end`` are the words' bytes in ``data``;
    text i has the words first[i] to first[i + 1] - 1."""

    def __init__(self, texts: pa.Array):
        offsets = _offsets(texts)
        self.data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets -= offsets[0]
        # with a null's bytes, if any, out of the way
        if texts.null_count:
            null = texts.is_null().to_numpy(zero_copy_only=False)
            self.data = self.data.copy()
            self.data[_ranges(offsets[:-1][null], np.diff(offsets)[null])] = 32
        space = np.concatenate((_SPACE[self.data], [True]))
        edge = np.zeros(space.size, bool)  # a text begins here
        edge[offsets] = True
        before = np.concatenate(([True], space[:-1])) | edge
        after = np.concatenate((space[1:], [True])) | np.concatenate((edge[1:], [True]))
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.n = self.start.size

    def _hashed(self) -> None:
        if hasattr(self, "_sums"):
            return
        h = np.empty(self.n, np.uint64)
        at = 0
        while at < self.n:  # some words whose bytes lie in one chunk
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + _CHUNK, "right")))
            s, e = self.start[at:to] - self.start[at], self.end[at:to] - self.start[at]
            value = _BYTES[self.data[self.start[at]:self.end[to - 1]]]
            up, down = _BYTE_POWERS.to(value.size + 1)
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * up[:-1], dtype=np.uint64)))
            h[at:to] = _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            at = to
        self._sums, self._down = [], []
        for p in _POWERS:
            up, down = p.to(self.n + 1)
            self._sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[:-1], dtype=np.uint64))))
            self._down.append(down)

    def digest(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        self._hashed()
        s = self._sums[which]
        return _mix((s[end] - s[start]) * self._down[which][start])

    def edges(self, window: int, k: int) -> tuple[np.ndarray, ...] | None:
        """text, lo, hi, hash and extension digest of the edges: each stands
        for the windows that start at the words lo to hi of its text."""
        windows = np.maximum(np.diff(self.first) - window + 1, 0)
        if not windows.any():
            return None
        at = np.arange(self.n - k + 1)
        kmer = self.digest(at, at + k, 0)
        # least hash of each window's k-mers, the first of equals: the upper
        # bits of the hash above the position
        bits = np.uint64(int(kmer.size).bit_length())
        least = (kmer >> bits << bits) | np.arange(kmer.size, dtype=np.uint64)
        width, have = window - k + 1, 1
        while have < width:
            step = min(have, width - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        start = _ranges(self.first[:-1], windows)
        chosen = (least[start] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        text = np.repeat(np.arange(windows.size), windows)
        new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1]))))
        last = np.concatenate((new[1:], [start.size])) - 1
        lo, hi, edge, text = start[new], start[last], chosen[new], text[new]
        place = _mix(((edge - lo).astype(np.uint64) << np.uint64(32)) + (hi - lo).astype(np.uint64))
        begin = self.first[text]
        return (text, lo - begin, hi - begin, kmer[edge], _mix(self.digest(lo, hi + window, 1) + place))

    def without(self, spans: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kept words per text, the kept words of all texts each with one
        blank behind, and where each text's bytes begin in them."""
        gone = np.zeros(self.n + 1, np.int64)
        if spans.null_count < len(spans):
            row, start, size = _unpacked(spans)
            np.add.at(gone, self.first[row] + start, 1)
            np.add.at(gone, self.first[row] + start + size, -1)
        keep = np.cumsum(gone[:-1]) == 0
        kept = np.concatenate(([0], np.cumsum(keep)))
        start, size = self.start[keep], (self.end - self.start)[keep] + 1
        out = np.concatenate((self.data, [32]))[_ranges(start, size)].astype(np.uint8)
        ends = np.cumsum(size)
        out[ends - 1] = 32
        return np.diff(kept[self.first]), out, np.concatenate(([0], ends))[kept[self.first]]


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``_CHUNK`` bytes of text."""
    offsets = _offsets(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK, "right")) - 1)
        yield at, to
        at = to


def _unpacked(ranges: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and size of each packed range of a list column."""
    sizes = np.diff(_offsets(ranges))
    sizes = np.where(ranges.is_null().to_numpy(zero_copy_only=False), 0, sizes)
    flat = ranges.flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(ranges)), sizes), flat >> _BITS, flat & ((1 << _BITS) - 1)


def _packed(start: Column, size: Column) -> Column:
    """A range of words as one long."""
    return F.shiftleft(start.cast("long"), _BITS).bitwiseOR(size.cast("long"))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _edge_rows(docs: DataFrame, window: int, k: int) -> DataFrame:
    """(doc_id, key, lo, hi, edge, ext) of all texts in ``__utf8``."""
    names = ["doc_id", "key", "lo", "hi", "edge", "ext"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to in _chunks(b.column(2)):
                found = Texts(b.column(2)[at:to]).edges(window, k)
                if found:
                    text, lo, hi, *rest = found
                    take = pa.array(text + at)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(lo.astype(np.int32)),
                                                      pa.array(hi.astype(np.int32)), *map(_signed, rest)], names=names)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "key", "__utf8").mapInArrow(run, f"doc_id {kind}, key long, lo int, hi int, edge long, ext long")


def _window_rows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, key, at, w1, w2) of the windows in the ranges ``open``."""
    names = ["doc_id", "key", "at", "w1", "w2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to in _chunks(b.column(2)):
                texts = Texts(b.column(2)[at:to])
                row, lo, size = _unpacked(b.column(3)[at:to])
                row, word = np.repeat(row, size), _ranges(lo, size)
                start = word + texts.first[row]
                take = pa.array(row + at)
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(word.astype(np.int32)),
                                                  *(_signed(texts.digest(start, start + window, w)) for w in (0, 1))], names=names)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "key", "__utf8", "open").mapInArrow(run, f"doc_id {kind}, key long, at int, w1 long, w2 long")


def _same_row(key: str = "__k", doc: str = "__i") -> Column:
    return (F.col("key") == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(doc))


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """(doc_id, key, spans): for each row key with repeated windows, the
    ranges of words (start, end exclusive; may overlap) they cover."""
    size = F.lit((1 << _BITS) - 1).cast("long")
    return _packed_spans(docs, text, window, k).withColumn("spans", F.transform("spans", lambda s: F.struct(
        F.shiftright(s, _BITS).alias("start"), (F.shiftright(s, _BITS) + s.bitwiseAND(size)).alias("end"))))


def _packed_spans(docs: DataFrame, text: str, window: int, k: int) -> DataFrame:
    if not 0 < k < window < 1 << (_BITS - 1):
        raise ValueError("0 < k < window < 65536")
    texts = docs.select("doc_id", row_key(docs, text).alias("key"), F.col(text).cast("binary").alias("__utf8"))
    edges = _edge_rows(texts, window, k)
    # an edge is non-branching if its extensions are always the same
    status = (edges.groupBy("edge").agg(F.count(F.lit(1)).alias("n"), F.min("ext").alias("a"), F.max("ext").alias("b")).filter("n > 1")
              .select(apart(F.col("edge")).alias("__e"), (F.col("a") == F.col("b")).alias("whole")))
    # a mark: the packed range of windows, then whether the edge is whole
    mark = F.shiftleft(_packed(F.col("lo"), F.col("hi") - F.col("lo") + 1), 1).bitwiseOR(F.col("whole").cast("long"))
    found = edges.join(status, apart(F.col("edge")) == F.col("__e")).select("doc_id", "key", mark.alias("m"))
    marks = persisted(found.groupBy("doc_id", "key").agg(F.collect_set("m").alias("marks")))

    def ranges(whole: int) -> Column:
        return F.transform(F.filter("marks", lambda m: m.bitwiseAND(F.lit(1).cast("long")) == whole), lambda m: F.shiftright(m, 1))
    branching = marks.select(F.col("doc_id").alias("__i"), F.col("key").alias("__k"), ranges(0).alias("open")).filter(F.size("open") > 0)
    windows = _window_rows(texts.join(branching, _same_row()), window)
    again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = again.select(apart(F.col("w1")).alias("__1"), F.col("w2").alias("__2"))
    verified = windows.join(again, (apart(F.col("w1")) == F.col("__1")) & (F.col("w2") == F.col("__2"))).select(
        "doc_id", "key", _packed(F.col("at"), F.lit(window)).alias("span"))
    # n windows from a word on cover window - 1 words more than n
    paths = marks.select("doc_id", "key", F.explode(ranges(1)).alias("m")).select("doc_id", "key", (F.col("m") + (window - 1)).alias("span"))
    return paths.unionAll(verified).groupBy("doc_id", "key").agg(F.collect_set("span").alias("spans"))


def dedup_substrings(docs: DataFrame, text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per row of ``docs``: doc_id, sub_n_words, sub_n_removed,
    sub_text (kept words joined by one space) and its sha256."""
    spans = _packed_spans(docs, text, window, k).select(F.col("doc_id").alias("__i"), F.col("key").alias("__k"), "spans")
    texts = docs.select("doc_id", row_key(docs, text).alias("key"), F.col(text).cast("binary").alias("__utf8"))
    joined = texts.join(spans, _same_row(), "left").select("doc_id", "spans", F.col("__utf8").alias("__text"))

    def make():
        def run(batch, _):
            column, spans = batch.column(2), batch.column(1)
            n, kept, texts, digest = [], [], [], []
            for at, to in _chunks(column):
                t = Texts(column[at:to])
                count, out, begin = t.without(spans[at:to])
                n.append(np.diff(t.first))
                kept.append(count)
                out, begin = out.tobytes(), begin.tolist()
                for i, (a, b) in enumerate(zip(begin, begin[1:])):
                    whole = out[a:b - 1] if b > a else b""
                    digest.append(hashlib.sha256(whole).hexdigest())
                    texts.append(whole if column[at + i].is_valid else None)
            n, kept = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (n, kept))
            return [pa.array(n, pa.int64()), pa.array(n - kept, pa.int64()), pa.array(texts, pa.binary()), pa.array(digest, pa.string())]
        return run
    out = annotate(joined, "__text", "n bigint, removed bigint, kept binary, digest string", make)
    return out.select("doc_id", F.col("n").alias("sub_n_words"), F.col("removed").alias("sub_n_removed"),
                      F.col("kept").cast("string").alias("sub_text"), F.col("digest").alias("sub_sha256"))
