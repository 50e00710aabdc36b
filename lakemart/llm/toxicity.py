"""Toxicity: counterfactual-regularised classifier.

A logistic model over a document's distinct words and word beginnings (4 and
5 letters), hashed to ``2 ** FEATURE_BITS`` weights. For every labelled text
that names identity terms, the terms are swapped for others of their group
and the squared change of the logit is penalised, so that the score follows
what is said of a group and not its name: neutral mentions of a group that
toxic texts name often are no longer false positives.

The model is fitted on the driver from at most ``MAX_ROWS`` labelled rows per
label, chosen by a hash of the id (a documented bound; each row is a list of
feature numbers, cut by nothing); of several rows with one id, the text with
the smallest digest is learnt. Scoring is one narrow pass over all whole
texts; a word's contribution is looked up once per task and word.

Defined cases: null, empty and wordless texts score the intercept; unlabelled
rows, null ids and labels other than 0/1 are not learnt from; without both
labels the score is the share of toxic rows (0.5 without any); repeated rows
score alike.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import annotate, sized

FEATURE_BITS = 18
MAX_ROWS = 2500
SEED = "toxic-1"
L2 = 1e-4
PENALTY = 0.5
ROUNDS = 150
#: Least G statistic of a feature that the model uses (chance gives 10 to
#: about one feature in 600).
MIN_CONTRAST = 10.0
#: Words whose contribution a task remembers.
_CACHE = 400_000
#: Identity terms by group; a swap takes the next term of the same group.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists"), ("muslim", "christian", "jewish", "hindu", "buddhist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("black", "white", "asian", "latino", "indigenous"),
    ("immigrants", "locals", "refugees"), ("disabled", "deaf", "blind"), ("old", "young"),
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> set[bytes]:
    return set(_WORD.findall((text or b"").lower()))


def word_features(word: bytes, bits: int = FEATURE_BITS) -> tuple[int, ...]:
    """Feature numbers of a word: itself and its beginnings."""
    mask = (1 << bits) - 1
    out = [zlib.crc32(b"w" + word) & mask]
    if len(word) > 4 or not word.isascii():
        s = word.decode("utf-8", "replace")
        out += [zlib.crc32(f"p{s[:k]}".encode()) & mask for k in (4, 5) if len(s) > k]
    return tuple(out)


def features(words: set[bytes], bits: int = FEATURE_BITS) -> set[int]:
    return {f for w in words for f in word_features(w, bits)}


def swap_table(groups=IDENTITY_GROUPS) -> dict[bytes, bytes]:
    return {a.encode(): b.encode() for g in groups for a, b in zip(g, [*g[1:], g[0]]) if len(g) > 1}


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", max_rows: int = MAX_ROWS,
                  groups=IDENTITY_GROUPS, bits: int = FEATURE_BITS, seed: str = SEED) -> DataFrame:
    """(toxic, on, swapped): feature numbers of a bounded sample of labelled
    texts, and of their counterfactuals where terms could be swapped."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn).select("doc_id", "toxic")
    # a document with several labels is toxic if any says so
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    pick = [usable.filter(F.col("__toxic") == k).orderBy(order, "doc_id").limit(max_rows) for k in (0, 1)]
    rows = docs.select("doc_id", F.col(text).alias("__text")).join(sized(pick[0].unionAll(pick[1])), "doc_id")
    # one text an id: partial aggregates leave at most one row an id and task
    one = F.min(F.struct(F.xxhash64("__text"), "__text"))["__text"]
    rows = rows.groupBy("doc_id", "__toxic").agg(one.alias("__text"))
    swaps = swap_table(groups)

    def make():
        def run(batch, texts):
            on, off = [], []
            for t in texts:
                w = words_of(t)
                on.append(sorted(features(w, bits)))
                off.append(sorted(features({swaps.get(x, x) for x in w}, bits)) if any(x in swaps for x in w) else None)
            return [pa.array(on, pa.list_(pa.int32())), pa.array(off, pa.list_(pa.int32()))]
        return run
    out = annotate(rows, "__text", "__on array<int>, __swapped array<int>", make)
    return out.select(F.col("__toxic").alias("toxic"), F.col("__on").alias("on"), F.col("__swapped").alias("swapped"))


def contrast(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """G statistics of features that occur in ``a`` of ``n1`` toxic and ``b``
    of ``n0`` other texts."""
    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)
    n, have = n1 + n0, a + b
    return 2 * (part(a, have * n1 / n) + part(b, have * n0 / n) + part(n1 - a, (n - have) * n1 / n) + part(n0 - b, (n - have) * n0 / n))


def fit(rows: list[tuple[int, list[int], list[int] | None]], bits: int = FEATURE_BITS, l2: float = L2,
        penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and intercept: mean log loss of both labels alike + ``l2``
    |w|^2 + ``penalty`` times the mean squared logit change of the swaps;
    full-batch Adam, so equal rows give equal weights."""
    y = np.array([r[0] for r in rows], float)
    if not len(rows) or y.min() == y.max():
        share = y.mean() if len(rows) else 0.5
        return np.zeros(1 << bits), float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    col = np.concatenate([np.asarray(r[1], np.int64) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    # of the features, those whose frequency differs between the labels
    used, col = np.unique(col, return_inverse=True)
    often = contrast(np.bincount(col, y[row], used.size), np.bincount(col, 1 - y[row], used.size), y.sum(), (1 - y).sum()) >= MIN_CONTRAST
    keep = often[col]
    place = np.cumsum(often) - 1
    used, col, row = used[often], place[col[keep]], row[keep]
    at = {int(f): i for i, f in enumerate(used)}
    drow, dcol, dval, pairs = [], [], [], 0
    for r in rows:
        if r[2] is not None:
            a, b = set(r[1]), set(r[2])
            for f, s in [(f, 1.0) for f in sorted(a - b)] + [(f, -1.0) for f in sorted(b - a)]:
                if f in at:
                    drow.append(pairs)
                    dcol.append(at[f])
                    dval.append(s)
            pairs += 1
    drow, dcol, dval = np.array(drow, np.int64), np.array(dcol, np.int64), np.array(dval)
    sample = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b = np.zeros(used.size), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(row, w[col], minlength=y.size) + b
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * sample
        grad = np.bincount(col, err[row], minlength=w.size) + 2 * l2 * w
        if pairs:
            change = np.bincount(drow, w[dcol] * dval, minlength=pairs)
            grad += 2 * penalty / pairs * np.bincount(dcol, change[drow] * dval, minlength=w.size)
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb ** 2
        rate = 0.05 * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w -= rate * m / (np.sqrt(v) + 1e-8)
        b -= rate * mb / (np.sqrt(vb) + 1e-8)
    out = np.zeros(1 << bits)
    out[used] = w
    return out, float(b)


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text") -> DataFrame:
    """``docs`` plus ``toxicity``, the probability of label 1."""
    weights, intercept = model
    bits = int(weights.size).bit_length() - 1
    used = np.flatnonzero(weights)
    shared = docs.sparkSession.sparkContext.broadcast((used.astype(np.int32), weights[used]))

    def make():
        full = np.zeros(1 << bits)
        full[shared.value[0]] = shared.value[1]
        table, known = full.tolist(), {}

        def value(w: bytes) -> float:
            if len(known) >= _CACHE:
                known.clear()
            known[w] = v = sum(table[f] for f in word_features(w, bits))
            return v

        def run(batch, texts):
            z = []
            for t in texts:
                found = [value(w) if (v := known.get(w)) is None else v for w in words_of(t)]
                z.append(intercept + math.fsum(found))  # exact: a set has no order
            z = np.clip(np.array(z, float), -35, 35)
            return [pa.array(1 / (1 + np.exp(-z)), pa.float64())]
        return run
    return annotate(docs, text, "toxicity double", make)


def train(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", groups=IDENTITY_GROUPS, penalty: float = PENALTY,
          max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    rows = training_rows(docs, labels, learn, text, max_rows, groups).orderBy("toxic", "on").collect()
    return fit([(r["toxic"], r["on"], r["swapped"]) for r in rows], penalty=penalty)
