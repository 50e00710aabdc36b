"""Phrase collocation mining by Toivonen's method.

Frequent word sequences (per language, inside pieces of text) are found by

1. a sample: sequences of 1 to 3 words that one document in ``SAMPLE`` holds
   at least ``SAMPLE_COUNT`` times are proposed;
2. a full pass that counts, exactly and on the words themselves, every
   occurring sequence whose two parts (all but its last word, all but its
   first) are proposed: the proposals and their negative border at once
   (words have no parts and are all counted);
3. expansion passes: a frequent sequence that was not proposed is a border
   failure; with it and its like among the proposals, the sequences that
   become countable are counted, until no failure is left (at most one pass
   a sequence length).

Proposals travel as a bit table of fixed size (``FILTER_BITS``): a sequence is
proposed if the bit of its hash is set. Chance hits only let more sequences be
counted, so results do not depend on the sample, the table or its load.

Inside a task, words are numbered per chunk of text and sequences by (number of
the first part, last word), so counting never rests on hashes; one row per
distinct sequence and chunk leaves Python and is aggregated before the
shuffle. Score arithmetic is long division in integers (``exact_share``).

Defined cases: a null text has no words; a null lang is ``und`` (one language
with documents that say ``und``); repeated rows count as often as they stand;
an empty table gives no rows; a piece longer than ``_CHUNK`` bytes is held
whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import exact_share, persisted, row_key, sized

MIN_COUNT = 30
MAX_WORDS = 4
#: One document in so many proposes, from so many occurrences on.
SAMPLE = 8
SAMPLE_COUNT = 2
FILTER_BITS = 26
#: A candidate goes if a longer one around it has this share (percent).
COVERED = 80
TOP = 2000
#: Bytes of text counted together.
_CHUNK = 1 << 21
_PIECES = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads differences."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _digests(words: pa.Array) -> np.ndarray:
    """A 64-bit polynomial hash of each word of a large_binary array."""
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    start, size = offsets[:-1] - offsets[0], np.diff(offsets)
    place = np.arange(data.size) - np.repeat(start, size)
    powers = np.cumprod(np.full(int(size.max()), _BASE))
    return _mix(np.add.reduceat(_BYTES[data] * powers[place], start) + size.astype(np.uint64))


def _buffers(langs: list[str], texts: list[bytes]) -> Iterator[tuple[str, bytes]]:
    """Folded texts of one language joined by line feeds (which end pieces),
    about ``_CHUNK`` bytes each."""
    by: dict[str, list[bytes]] = {}
    for g, t in zip(langs, texts):
        by.setdefault(g, []).append(t)
    for g, own in by.items():
        held: list[bytes] = []
        size = 0
        for t in own:
            t = t.translate(_PIECES)
            at = 0
            while len(t) - at > _CHUNK:  # cut where a piece ends
                to = t.find(b"\n", at + _CHUNK) + 1
                if not to:
                    break
                yield g, t[at:to]
                at = to
            held.append(t[at:] if at else t)
            size += len(held[-1])
            if size > _CHUNK:
                yield g, b"\n".join(held)
                held, size = [], 0
        if held:
            yield g, b"\n".join(held)


class Sequences:
    """Words of a buffer as numbers, with the pieces they stand in, and the
    hashes of the sequences that start at each word."""

    def __init__(self, lang: str, buffer: bytes):
        data = np.frombuffer(buffer, np.uint8)
        gap = (data == 32) | (data == 10)
        edge = np.flatnonzero(np.concatenate(([True], gap)) != np.concatenate((gap, [True])))
        start, end = edge[::2], edge[1::2]
        self.n = start.size
        self.piece = np.cumsum(data == 10, dtype=np.int32)[start] if self.n else np.zeros(0, np.int32)
        offsets = np.concatenate(([0], np.cumsum(end - start)))
        words = pa.Array.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data[~gap].tobytes())])
        coded = words.dictionary_encode()
        self.ids, self.words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        self._own = _digests(self.words)[self.ids]
        self._hash = [_mix(self._own + np.uint64(xxhash.xxh3_64_intdigest(lang.encode())))]

    def inside(self, m: int) -> np.ndarray:
        """Whether m words from each start lie in one piece."""
        return self.piece[m - 1:] == self.piece[:self.n - m + 1] if self.n >= m else np.zeros(0, bool)

    def hashes(self, m: int) -> np.ndarray:
        while len(self._hash) < m:
            k = len(self._hash)
            before = self._hash[-1][:max(self.n - k, 0)]
            self._hash.append(_mix(before * _BASE + self._own[k:]))
        return self._hash[m - 1]

    def text(self, at: np.ndarray, m: int) -> pa.Array:
        """The sequences of m words from ``at``, joined by blanks."""
        parts = [self.words.take(pa.array(self.ids[at + k])) for k in range(m)]
        joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if m > 1 else parts[0]
        return joined.cast(pa.binary()).cast(pa.string())

    def counts(self, chosen: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, one start of each distinct sequence, occurrences) of the
        sequences of two words or more that start where ``chosen`` says."""
        for m, flags in enumerate(chosen[1:], 2):
            at = np.flatnonzero(flags)
            if not at.size:
                continue
            number = self.ids[at]
            for k in range(1, m):  # numbered by (number of the first part, next word)
                _, first, number, n = np.unique(number * len(self.words) + self.ids[at + k], return_index=True, return_inverse=True, return_counts=True)
            yield m, at[first], n

    def countable(self, bits: np.ndarray, max_words: int) -> list[np.ndarray]:
        """For each length, whether the sequence at each start is counted
        when ``bits`` are the proposals."""
        out = [np.ones(self.n, bool)]
        for m in range(2, max_words + 1):
            part = out[-1] & _has(bits, self.hashes(m - 1)) if self.n >= m - 1 else np.zeros(0, bool)
            out.append(self.inside(m) & part[:-1] & part[1:] if self.n >= m else np.zeros(0, bool))
        return out


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _has(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = _slots(hashes, int(table.size * 64).bit_length() - 1)
    return (table[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def _source(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("utf8"))


def _sample_hashes(docs: DataFrame, longest: int) -> DataFrame:
    """(h, n): hashes of the sample's sequences, summed per chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, buffer in _buffers(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = Sequences(g, buffer)
                for m in range(1, longest + 1):
                    h, n = np.unique(s.hashes(m)[s.inside(m)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])
    return docs.mapInArrow(run, "h long, n long")


def _phrase_hashes(phrases: DataFrame) -> DataFrame:
    """(h): the hashes of counted sequences (lang, phrase)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            by: dict[str, list[bytes]] = {}
            for g, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(g, []).append(p)
            for g, own in by.items():
                s = Sequences(g, b"\n".join(own))
                first = np.flatnonzero(np.diff(s.piece, prepend=-1))
                size = np.diff(np.concatenate((first, [s.n])))
                out += [s.hashes(m)[first[size == m]] for m in range(1, int(size.max(initial=0)) + 1)]
            h = np.concatenate([np.zeros(0, np.uint64), *out])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])
    return phrases.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(run, "h long")


def _table(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bit table of some hashes: at most 2^bits / 64 rows come to the
    driver, whatever the data."""
    slot = F.shiftrightunsigned("h", 64 - bits)
    word = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63).cast("long")).cast("int")))
    rows = hashes.groupBy(F.shiftright(slot, 6).alias("i")).agg(word.alias("w")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return table


def _count(docs: DataFrame, new: np.ndarray, old: np.ndarray | None, max_words: int, min_count: int) -> DataFrame:
    """(lang, words, phrase, n): exact counts (``min_count`` or more) of the
    sequences that are countable with the proposals ``new`` but were not with
    ``old``. The first pass has the languages' word totals too (words 0)."""
    sent = docs.sparkSession.sparkContext.broadcast((new, old))
    names = ["lang", "words", "phrase", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, old = sent.value

        def rows(g: str, m: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            k = len(phrase)
            return pa.RecordBatch.from_arrays([pa.array([g] * k, pa.string()), pa.array(np.full(k, m, np.int32)), phrase, pa.array(n.astype(np.int64))], names=names)

        for b in batches:
            for g, buffer in _buffers(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = Sequences(g, buffer)
                if not s.n:
                    continue
                if old is None:
                    yield rows(g, 0, pa.array([""], pa.string()), np.array([s.n]))
                    yield rows(g, 1, s.words.cast(pa.binary()).cast(pa.string()), np.bincount(s.ids, minlength=len(s.words)))
                    found = s.counts(s.countable(new, max_words))
                elif any(_has(new & ~old, s.hashes(m)).any() for m in range(1, max_words)):
                    now, before = s.countable(new, max_words), s.countable(old, max_words)
                    found = s.counts([n & ~b for n, b in zip(now, before)])
                else:
                    continue
                for m, at, n in found:
                    yield rows(g, m, s.text(at, m), n)

    counted = docs.mapInArrow(run, "lang string, words int, phrase string, n long")
    sums = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    out = persisted(sums.filter((F.col("n") >= min_count) | (F.col("words") == 0)))
    sent.destroy()
    return out


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     sample: int = SAMPLE, sample_count: int = SAMPLE_COUNT, bits: int = FILTER_BITS) -> DataFrame:
    """(lang, words, phrase, n): all sequences of 1 to ``max_words`` words
    with ``min_count`` or more occurrences, and the number of all words of
    each language (words 0)."""
    if not 2 <= max_words or not 6 < bits < 40:
        raise ValueError("max_words from 2, bits from 7 to 39")
    source = _source(docs, text, lang)
    drawn = _source(docs.filter(F.pmod(row_key(docs, text), F.lit(sample)) == 0), text, lang)
    proposed = _sample_hashes(drawn, max_words - 1).groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= sample_count)
    table, old, passes = _table(proposed, bits), None, []
    while True:
        passes.append(_count(source, table, old, max_words, min_count))
        found = _table(_phrase_hashes(passes[-1].filter(F.col("words").between(1, max_words - 1))), bits)
        if not (found & ~table).any():  # closed: the border holds
            break
        table, old = table | found, table
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p)
    return out


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP, covered: int = COVERED, **kw) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top``
    phrases of two words or more by the score of their weakest cut,
    floor(2,000,000 a / (l + r)), that no longer phrase covers."""
    counts = frequent_phrases(docs, text, lang, **kw)
    known = counts.filter("words > 0").select(F.col("lang").alias("g"), F.col("phrase").alias("p"), F.col("n").alias("f"))
    cand = counts.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cand.select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("first"),
                       _part(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known, (F.col("lang") == F.col("g")) & (F.col(side) == F.col("p"))).drop("g", "p").withColumnRenamed("f", name)
    score = exact_share(2 * F.col("a"), F.col("l") + F.col("r"), 2)
    best = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # phrases of two words or more inside longer ones
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: _part(F.col("w"), i, m))))
    around = (cand.filter("words > 2").select("lang", "a", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    left = best.join(around, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    totals = sized(counts.filter("words = 0").select("lang", F.col("n").alias("total")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase")))
    ranked = left.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        F.col("total").alias("n"), F.col("cut.score").alias("score"))
