"""Source divergence audit over run-length columns.

A group is the documents of one (lang, source); a language keeps the terms
found in at least ``min_docs`` of its documents. Each kept term has in each
group the smoothed share ``1 + floor(10^9 (count + 5) / (N + 5 V))``; two
groups diverge by the sum over all kept terms of the shares' difference.

1. One narrow pass counts occurrences and documents of (lang, source, term)
   inside each task (bounded dictionaries), then one shuffle by (lang, term)
   adds them up and drops the rare terms.
2. The vocabulary is reordered by its count profiles (range partitions over
   (lang, profile)), so that equal counts stand together, and every block of
   it is run-length encoded: one column of runs per source. Absent terms are
   runs of zero.
3. Per block and pair of sources the run boundaries are intersected; within
   an intersection both shares are constant, so their difference is
   multiplied by its length. Blocks add up by aggregation.

A block holds at most one Arrow batch of terms; a pair's cost is its runs, not
the vocabulary. All arithmetic is in integers (``exact_share``; totals below
9e15). Pairs of sources are the result itself.

Defined cases: null text, lang and source are ''; a group without terms has
count 0 everywhere; a language without kept terms gives pairs of value 0 and
no term rows; repeated rows count as often as they stand; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import exact_share, persisted, sized

MIN_DOCS = 30
SMOOTHING = 5
#: Shares are in units of 1000^-SCALE.
SCALE = 3
TOP_TERMS = 50
#: (lang, source, term) counts that a task holds before it hands them on.
HELD = 200_000
#: Ranges of the vocabulary; Spark samples some 100 short keys for each.
MAX_RANGES = 2000
#: Bytes of text split at once.
_CHUNK = 1 << 20
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _words(clean: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``_CHUNK`` bytes."""
    at = 0
    while at < len(clean):
        to = clean.find(b" ", at + _CHUNK)
        to = len(clean) if to < 0 else to
        yield clean[at:to].split()
        at = to


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", held: int = HELD) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents, summed inside
    tasks only. Every group has at least one row with a null term."""
    names = ["lang", "source", "term", "n", "d"]

    def rows(found: dict) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (g, s), (occurrences, in_docs) in found.items():
            terms = [None, *occurrences]
            for column, part in zip(columns, ([g] * len(terms), [s] * len(terms), terms, [0, *occurrences.values()],
                                              [0, *(in_docs[t] for t in occurrences)])):
                column += part
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        size = 0
        for b in batches:
            for g, s, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                counters = found.get((g, s))
                if counters is None:
                    counters = found[g, s] = (Counter(), Counter())
                before = len(counters[0])
                seen: set = set()
                for words in _words(t.translate(_TERM_BYTES)):
                    counters[0].update(words)
                    seen.update(words)
                counters[1].update(seen)
                size += len(counters[0]) - before
                if size > held:
                    yield rows(found)
                    found, size = {}, 0
        if found:
            yield rows(found)

    src = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))],
                      F.coalesce(F.col(text), F.lit("")).cast("binary").alias("utf8"))
    return src.mapInArrow(run, "lang string, source string, term string, n long, d long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, **columns) -> DataFrame:
    """(lang, term, total, profile): the kept terms with their counts by
    source, sorted; one row a language with a null term names its sources."""
    # one exchange serves both aggregates; tasks have combined their rows
    dealt = term_counts(docs, **columns).repartition("lang", "term")
    each = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    per = each.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("d").alias("d"),
                                           F.sort_array(F.collect_list(F.struct("source", "n"))).alias("profile"))
    return per.filter(F.col("term").isNull() | (F.col("d") >= min_docs)).drop("d")


def group_sizes(kept: DataFrame) -> DataFrame:
    """(lang, source, size, vocab): N and V of every group."""
    sources = kept.select("lang", F.explode("profile").alias("p"), F.col("term").isNotNull().cast("long").alias("real"))
    sizes = sources.groupBy("lang", F.col("p.source").alias("source")).agg(F.sum(F.col("p.n") * F.col("real")).alias("size"))
    vocab = kept.groupBy("lang").agg(F.count("term").alias("vocab"))
    return sizes.join(vocab, "lang")


def run_columns(kept: DataFrame) -> DataFrame:
    """(lang, block, length, source, starts, counts): the reordered
    vocabulary's blocks as one run-length column per source that has one of
    the block's terms. A run lasts to the next start."""
    names = ["lang", "block", "length", "source", "starts", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pyspark.TaskContext.get().partitionId() << 32
        for b in batches:
            at = 0
            langs = b.column(0).to_pylist()
            while at < len(langs):  # sorted by language
                to = at + 1
                while to < len(langs) and langs[to] == langs[at]:
                    to += 1
                profile = b.column(1)[at:to]
                row = np.asarray(pa.compute.list_parent_indices(profile))
                flat = profile.flatten()
                source = flat.field(0).dictionary_encode()
                ids, n = source.indices.to_numpy(), flat.field(1).to_numpy()
                out: list[list] = [[], [], []]
                for i, name in enumerate(source.dictionary.to_pylist()):
                    column = np.zeros(to - at, np.int64)
                    mine = ids == i
                    column[row[mine]] = n[mine]
                    starts = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1])))
                    out[0].append(name)
                    out[1].append(starts.astype(np.int32))
                    out[2].append(column[starts])
                k = len(out[0])
                yield pa.RecordBatch.from_arrays([
                    pa.array([langs[at]] * k, pa.string()), pa.array([block] * k, pa.int64()), pa.array([to - at] * k, pa.int32()),
                    pa.array(out[0], pa.string()), pa.array(out[1], pa.list_(pa.int32())), pa.array(out[2], pa.list_(pa.int64()))], names=names)
                block += 1
                at = to

    # bounds come from a sample of the leading counts, not of whole profiles
    n = min(int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_RANGES)
    ordered = kept.filter("term is not null").select("lang", "profile", "term").repartitionByRange(n, "lang", F.slice("profile", 1, 2), "term")
    return ordered.sortWithinPartitions("lang", "profile", "term").select("lang", "profile").mapInArrow(
        run, "lang string, block long, length int, source string, starts array<int>, counts array<long>")


def _shares(counts: np.ndarray, size: int, vocab: int) -> np.ndarray:
    """``exact_share`` in numpy."""
    total = size + SMOOTHING * vocab
    rest = counts + SMOOTHING
    out, rest = rest // total, rest % total
    for _ in range(SCALE):
        out, rest = out * 1000 + rest * 1000 // total, rest * 1000 % total
    return out + 1


def _block_pairs(pdf):
    """Sums of share differences of one block's pairs of sources."""
    import pandas as pd
    pdf = pdf.sort_values("source")
    length = int(pdf["length"].iloc[0])
    columns = []
    for starts, counts, size, vocab in zip(pdf["starts"], pdf["counts"], pdf["size"], pdf["vocab"]):
        starts = np.zeros(1, np.int64) if starts is None else np.asarray(starts, np.int64)
        counts = np.zeros(1, np.int64) if counts is None else np.asarray(counts, np.int64)
        columns.append((starts, _shares(counts, int(size), int(vocab))))
    names, a, b, value = pdf["source"].tolist(), [], [], []
    for i, (si, pi) in enumerate(columns):
        for j, (sj, pj) in enumerate(columns[:i]):
            cuts = np.union1d(si, sj)
            f = np.abs(pi[np.searchsorted(si, cuts, "right") - 1] - pj[np.searchsorted(sj, cuts, "right") - 1])
            a.append(names[j])
            b.append(names[i])
            value.append(int((f * np.diff(cuts, append=length)).sum()))
    return pd.DataFrame({"lang": pdf["lang"].iloc[0], "a": a, "b": b, "value": np.array(value, np.int64)})


def pair_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value), both directions of every pair."""
    runs = persisted(run_columns(kept))
    blocks = runs.select("lang", "block", "length").distinct().join(groups, "lang")
    whole = blocks.join(runs.drop("length"), ["lang", "block", "source"], "left")
    sums = (whole.groupBy("lang", "block").applyInPandas(_block_pairs, "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    g = groups.filter("vocab = 0").select("lang", "source")
    still = g.join(g.select(F.col("lang").alias("l"), F.col("source").alias("item")), (F.col("lang") == F.col("l")) & (F.col("source") != F.col("item")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return (sums.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")
            .unionByName(still.select("lang", "source", "item", F.lit(0).cast("long").alias("value"))))


def term_excess(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that a group has with a
    larger share than its language."""
    def share(count: Column, size: Column) -> Column:
        return exact_share(count + SMOOTHING, size + SMOOTHING * F.col("vocab"), SCALE) + 1
    langs = sized(groups.groupBy("lang").agg(F.sum("size").alias("lang_size")))
    each = kept.filter("term is not null").select("lang", "term", "total", F.explode("profile").alias("p"))
    each = each.select("lang", "term", "total", F.col("p.source").alias("source"), F.col("p.n").alias("n")).filter("n > 0")
    joined = each.join(groups, ["lang", "source"]).join(langs, "lang")
    value = share(F.col("n"), F.col("size")) - share(F.col("total"), F.col("lang_size"))
    return joined.select("lang", "source", F.col("term").alias("item"), value.alias("value")).filter("value > 0")


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, **columns) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other
    sources of the language, part ``term`` the group's ``top`` terms."""
    kept = persisted(kept_terms(docs, min_docs, **columns))
    groups = sized(group_sizes(kept))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", rank.alias("rank"))
    return part(pair_divergence(kept, groups), "pair").unionByName(part(term_excess(kept, groups), "term").filter(F.col("rank") <= top))
