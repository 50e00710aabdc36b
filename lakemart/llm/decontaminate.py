"""Benchmark decontamination with an FM-index per training shard.

A shard is one Arrow batch of documents (some thousand rows, bounded bytes).
Its index holds every stretch of words that could contain a phrase: words
outside the phrases' vocabulary are one separator symbol, and stretches
shorter than the shortest phrase cannot match. Over that sequence each task
builds a suffix array (prefix doubling), the Burrows-Wheeler transform and a
wavelet tree over its bits; test phrases are searched backwards through
wavelet-tree ranks, all phrases at once; matches are located by walking to
the next sampled suffix position; removal spans are merged per document. A
phrase is a position in an array of the benchmark's words, made once.

Documents are never shuffled and never meet each other. Phrases are sent to
the tasks in blocks of at most ``BLOCK_BYTES`` of benchmark text; a larger
benchmark takes several passes, each adding its spans to those found before,
with a checkpoint between passes, after which a block is dropped everywhere.

Defined cases: null or wordless texts have no words and no hits; items
without words are never found; items with equal text all count; a null
item_id is listed as ``null``; rows are neither merged nor dropped.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from .common import annotate, persisted, without

WINDOW = 13
#: Benchmark text (UTF-8 bytes) that one pass sends to every task.
BLOCK_BYTES = 32 << 20
#: Words a shard's index may hold; a batch with more is cut at documents.
SHARD_WORDS = 4 << 20
SAMPLE = 8
#: Phrases searched at once in a shard's index.
SEARCHED = 1 << 18
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return _WORD.findall((text or b"").lower())


class Phrases:
    """Distinct windows of benchmark items. The items' words are one array of
    word numbers (``flat``) and a window is where it begins in it, so a window
    costs some bytes, not its words; built once and sent to the tasks."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        ids = [np.array([number(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int32) for _, text in items]
        self.names = [name for name, _ in items]
        self.flat = np.concatenate([np.zeros(0, np.int32), *ids])
        sizes = np.array([i.size for i in ids], np.int64)
        first = np.cumsum(sizes) - sizes
        lengths = np.minimum(sizes, window)
        ranks = [self.flat]  # equal numbers where the next 1, 2, 4, ... words are equal
        # (length, where its windows begin, whose they are as ranges of owners)
        self.by_length: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for m in np.unique(lengths[lengths > 0]).tolist():
            have = np.flatnonzero(lengths == m)
            count = sizes[have] - m + 1
            owner = np.repeat(have, count)
            at = np.arange(owner.size) + np.repeat(first[have] - np.cumsum(count) + count, count)
            while 2 << (len(ranks) - 1) <= m:
                half = 1 << (len(ranks) - 1)
                key = ranks[-1].astype(np.int64) << 32
                key[:-half] |= ranks[-1][half:]
                ranks.append(np.unique(key, return_inverse=True)[1].astype(np.int32))
            # m words are equal if their first and their last 2^i words are
            low = ranks[m.bit_length() - 1]
            key = low[at].astype(np.int64) << 32 | low[at + m - (1 << (m.bit_length() - 1))]
            _, begin, same = np.unique(key, return_index=True, return_inverse=True)
            pairs = np.unique(same * np.int64(len(items)) + owner)
            ends = np.searchsorted(pairs // len(items), np.arange(begin.size + 1))
            self.by_length.append((m, at[begin], ends, (pairs % len(items)).astype(np.int32)))
        self.shortest = self.by_length[0][0] if self.by_length else 0


class FMIndex:
    """FM-index of a sequence of symbols in which 0 separates stretches (the
    sequence ends with 0). Symbols are below ``2 ** bits``."""

    def __init__(self, seq: np.ndarray, bits: int, sample: int = SAMPLE):
        n, self.bits = seq.size, bits
        sa = self._suffixes(seq)
        bwt = seq[sa - 1]
        self.first = np.searchsorted(seq[sa], np.arange((1 << bits) + 1))
        # wavelet tree, one level a bit: ranks of ones, and where zeros end
        self.ones, self.zeros, level = [], [], bwt
        for b in range(bits - 1, -1, -1):
            bit = (level >> b & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int64))))
            self.zeros.append(n - int(self.ones[-1][-1]))
            level = np.concatenate((level[~bit], level[bit]))
        # sampled suffix positions: every ``sample``-th of a stretch, and its
        # start, so that no walk crosses a separator
        starts = np.concatenate(([0], np.flatnonzero(seq == 0)[:-1] + 1))
        offset = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        self.marked = offset[sa] % sample == 0
        self.rank = np.cumsum(self.marked) - 1
        self.position = sa[self.marked]

    @staticmethod
    def _suffixes(seq: np.ndarray) -> np.ndarray:
        """Suffix array; each separator is a symbol of its own, so no common
        prefix is longer than a stretch."""
        n, sep = seq.size, seq == 0
        gaps = int(sep.sum())
        sym = np.where(sep, np.cumsum(sep), seq + gaps)
        width = int(sym.max()).bit_length()
        step = max(1, 62 // width)

        def ahead(x: np.ndarray, k: int) -> np.ndarray:
            return np.concatenate((x[k:], np.zeros(min(k, n), x.dtype)))[:n]
        key = sym.copy()
        for k in range(1, step):
            key = key << width | ahead(sym, k)
        while True:
            sa = np.argsort(key, kind="stable")
            ordered = key[sa]
            rank = np.empty(n, np.int64)
            rank[sa] = np.concatenate(([1], 1 + np.cumsum(ordered[1:] != ordered[:-1])))
            if rank[sa[-1]] == n:
                return sa
            key = rank * (n + 1) + ahead(rank, step)
            step *= 2

    def _occurrences(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each symbol, its number in the transform before ``at``."""
        lo, hi = np.zeros_like(at), at
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones, one = self.ones[level], (symbol >> b & 1).astype(bool)
            lo_ones, hi_ones = ones[lo], ones[hi]
            lo = np.where(one, self.zeros[level] + lo_ones, lo - lo_ones)
            hi = np.where(one, self.zeros[level] + hi_ones, hi - hi_ones)
        return hi - lo

    def search(self, words: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of the phrases of ``length`` words that begin in
        ``words`` where ``at`` says: numbers of those that occur, and their
        ranges of rows."""
        alive = np.arange(at.size)
        lo, hi = np.zeros(alive.size, np.int64), np.full(alive.size, self.marked.size, np.int64)
        for j in range(length - 1, -1, -1):
            c = words[at[alive] + j].astype(np.int64)
            lo, hi = self.first[c] + self._occurrences(c, lo), self.first[c] + self._occurrences(c, hi)
            there = lo < hi
            alive, lo, hi = alive[there], lo[there], hi[there]
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes by steps back to a sampled one."""
        steps, rows, open_ = np.zeros(rows.size, np.int64), rows.copy(), np.flatnonzero(~self.marked[rows])
        while open_.size:
            at, symbol, i = rows[open_], np.zeros(open_.size, np.int64), rows[open_]
            for level in range(self.bits):
                ones = self.ones[level]
                one = ones[i + 1] > ones[i]
                symbol = symbol << 1 | one
                i = np.where(one, self.zeros[level] + ones[i], i - ones[i])
            rows[open_] = self.first[symbol] + self._occurrences(symbol, at)
            steps[open_] += 1
            open_ = open_[~self.marked[rows[open_]]]
        return self.position[self.rank[rows]] + steps


def find_in_shard(texts: list[list[int]], phrases: Phrases) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
    """Merged spans of phrase words (start, end) and items found, for each
    document given as vocabulary numbers (0: another word)."""
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)  # a separator after each
    flat = np.zeros(int(sizes.sum()), np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    for b, t in zip(begin.tolist(), texts):
        flat[b:b + len(t)] = t
    # stretches long enough, each with the separator behind it
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flat > 0, [0]))))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= max(1, phrases.shortest)
    starts, ends = starts[long], ends[long]
    if not starts.size or not phrases.by_length:
        return spans, items
    take = np.zeros(flat.size + 1, np.int64)
    np.add.at(take, starts, 1)
    np.add.at(take, ends + 1, -1)
    place = np.flatnonzero(np.cumsum(take[:-1]) > 0)
    index = FMIndex(flat[place], len(phrases.vocabulary).bit_length())
    hits: list[np.ndarray] = []
    for which, (length, windows, _, _) in enumerate(phrases.by_length):
        for cut in range(0, windows.size, SEARCHED):
            found, lo, hi = index.search(phrases.flat, windows[cut:cut + SEARCHED], length)
            if found.size:
                size = hi - lo
                row = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
                at = place[index.locate(row)]
                doc = np.searchsorted(begin, at, "right") - 1
                hits.append(np.stack((doc, at - begin[doc], np.full(at.size, which), np.repeat(found + cut, size))))
    if hits:
        doc, at, which, number = np.concatenate(hits, axis=1)
        for i in np.lexsort((at, doc)).tolist():
            d, s = int(doc[i]), int(at[i])
            e = s + phrases.by_length[which[i]][0]
            if spans[d] and s <= spans[d][-1][1]:
                spans[d][-1] = (spans[d][-1][0], max(e, spans[d][-1][1]))
            else:
                spans[d].append((s, e))
        for d, w, k in set(zip(doc.tolist(), which.tolist(), number.tolist())):
            _, _, ends, owners = phrases.by_length[w]
            items[d].update(phrases.names[o] for o in owners[ends[k]:ends[k + 1]].tolist())
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _one_pass(docs: DataFrame, text: str, shared: Broadcast, last: str | None) -> DataFrame:
    """``shared`` holds the ``Phrases`` of one block."""
    def make():
        phrases = shared.value
        number = phrases.vocabulary.get

        def run(batch, texts):
            counts, spans, names, shard, held = [], [], [], [], 0

            def close():
                s, i = find_in_shard(shard, phrases)
                spans.extend(s)
                names.extend(i)
                shard.clear()
            for t in texts:
                ids = [number(w, 0) for w in words_of(t)]
                counts.append(len(ids))
                shard.append(ids)
                held += len(ids)
                if held >= SHARD_WORDS:
                    close()
                    held = 0
            close()
            if last:
                old = batch.column(batch.schema.get_field_index(last)).to_pylist()
                spans = [merged([(x["start"], x["end"]) for x in o["spans"]] + s) for o, s in zip(old, spans)]
                names = [set(o["items"]) | i for o, i in zip(old, names)]
            out = [{"n_words": n, "spans": [{"start": a, "end": b} for a, b in s], "items": sorted(i)}
                   for n, s, i in zip(counts, spans, names)]
            kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])
            return [pa.array(out, kind)]
        return run

    new = "decon" if last is None else "__decon"
    out = annotate(docs, text, f"{new} struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>", make)
    return out if last is None else out.drop(last).withColumnRenamed(new, last)


def find_phrases(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` plus ``decon``: struct of n_words, merged removal ``spans``
    (word numbers, end exclusive) and the ``items`` found."""
    # results are sets: repeated rows are sent once
    items = persisted(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
                                       F.col("text").cast("binary").alias("text")).distinct())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    passes = 1 + int(size) // block_bytes
    which = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    out, shared = docs, None
    for k in range(passes):
        if shared is not None:
            out = persisted(out)
            shared.destroy()
        block = [(r[0], None if r[1] is None else bytes(r[1])) for r in items.filter(which == k).toLocalIterator()]
        shared = docs.sparkSession.sparkContext.broadcast(Phrases(block, window))
        out = _one_pass(out, text, shared, "decon" if k else None)
    return out


def judge(found: DataFrame) -> DataFrame:
    """The columns ``decon_hit`` (words inside spans) and
    ``decon_contaminated``: a hit, and hits of at least 5 % of the words."""
    hit = F.aggregate("decon.spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    found = without(found, "decon_hit", "decon_contaminated").withColumn("decon_hit", hit)
    return found.withColumn("decon_contaminated", (F.col("decon_hit") > 0) & (20 * F.col("decon_hit") >= F.col("decon.n_words")))


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """``found`` plus ``decon_text``: the text without the spans' words (and
    what stands between them)."""
    def make():
        def run(batch, texts):
            spans = batch.column(batch.schema.get_field_index("decon")).to_pylist()
            out = []
            for t, d in zip(texts, spans):
                if t is None:
                    out.append(None)
                    continue
                at = [m.span() for m in _WORD.finditer(t.lower())] if d["spans"] else []
                parts, end = [], 0
                for s in d["spans"]:
                    parts.append(t[end:at[s["start"]][0]])
                    end = at[s["end"] - 1][1]
                out.append((b"".join(parts) + t[end:]).decode("utf-8", "replace"))
            return [pa.array(out, pa.string())]
        return run
    return annotate(found, text, "decon_text string", make)
