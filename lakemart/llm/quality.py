"""Quality rules: hashed n-gram log-likelihood ratio (native).

Word uni- and bigrams are hashed (CRC-32) into a fixed number of buckets. Two
multinomials are counted over the buckets: the trusted target texts and the
whole raw corpus. A document's score is the sum over its n-grams of
``ln(p_target / p_raw)`` divided by their number; it is kept if the score
reaches a fixed threshold. Every document is decided by the same
deterministic rule (no sampling): weights are integers in 1e-6 nats, so sums
do not depend on order.

Every row counts, but how often a text was copied says nothing about its
quality, so the rows of a class of copies and near copies share the weight of
one: rows with the same least hash of four consecutive words (a one-band
MinHash; an edit elsewhere leaves it) are of one class, and so are those whose
first rows by (doc_id, MD5) have the same greatest hash. A row counts ``UNIT``
divided by its class's rows in the raw corpus and by its class's trusted rows
in the target. Smoothing is a share of the target's n-grams, so the rule means
the same for little and for much trusted text.

Classes are found on narrow rows; the weights of the rows that share one are
joined back by broadcast up to ``BROADCAST_ROWS`` of them (beyond, by a
splittable shuffle join that moves each text once). Counting is a narrow pass whose partial
aggregates shuffle at most ``buckets`` rows a task; scoring is another that
reads the weights as one array of ``buckets`` numbers (bounded by that
parameter). Repeated windows are found by 64-bit hashes and confirmed on their
words.

Defined cases: a null or blank text has no words, fails the base rule and is
not kept; repeated rows are judged alike; with no trusted text all weights
are 0 and only the base rules decide; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import apart, let, persisted, sized, split_words, without

BUCKETS = 1 << 16
#: Pseudo n-grams of the target, spread over all buckets (and, in proportion,
#: of the raw corpus), as a share of the n-grams counted.
SMOOTHING = 2.0
#: Mean log-likelihood ratio (1e-6 nats an n-gram) that a document must reach.
THRESHOLD = -80_000
MIN_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8  # a power of two
#: A bigram's hash is the first word's times this, plus the second's.
PAIR = 65_599
#: Modulus and multipliers of the hashes that choose a class's four words.
PRIME, MIX, SECOND = 2_147_483_647, 48_271, 40_503
#: What a row without copies counts; rows of a class share it.
UNIT = 1 << 30
SYMBOL_RE = "[#*$%&|<>]"


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.crc32(w.cast("binary")))


def _uni(h: Column, buckets: int) -> Column:
    return (h % buckets).cast("int")


def _bi(h: Column, following: Column, buckets: int) -> Column:
    return ((h * PAIR + following) % buckets).cast("int")


def gram_buckets(words: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers of all uni- and bigrams of a word array."""
    def grams(h: Column) -> Column:
        pairs = F.transform(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), lambda x, i: _bi(x, F.get(h, i + 1), buckets))
        return F.concat(F.transform(h, lambda x: _uni(x, buckets)), pairs)
    return let(word_hashes(words), grams)


def copy_classes(h: Column) -> Column:
    """Two classes of a text from its words' hashes: the least and greatest
    62-bit hash of four consecutive words; a shorter text's own (negative)
    hash."""
    def four(p: Column) -> Column:
        def hashed(x: Column, i: Column) -> Column:
            y = F.get(p, i + 2)
            return ((x * PAIR + y) % PRIME * MIX % PRIME) * (1 << 31) + (x * SECOND + y) % PRIME
        return F.transform(F.slice(p, 1, F.greatest(F.size(p) - 2, F.lit(0))), hashed)
    pairs = F.transform(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), lambda x, i: (x * PAIR + F.get(h, i + 1)) % PRIME)
    whole = F.lit(-1).cast("long") - F.aggregate(h, F.lit(0).cast("long"), lambda a, x: (a * PAIR + x) % PRIME)
    return F.when(F.size(h) >= 4, let(let(pairs, four), lambda q: F.struct(F.array_min(q).alias("least"), F.array_max(q).alias("most")))).otherwise(
        let(whole, lambda x: F.struct(x.alias("least"), x.alias("most"))))


def class_weights(docs: DataFrame, trusted: Column, text: str = "text") -> DataFrame:
    """(words, raw, target) of every row: what the row counts in the raw
    corpus and in the target, ``UNIT`` divided by the (trusted) rows of its
    class of copies (0 in the target if the row is not trusted)."""
    words = split_words(F.col(text))
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    rows = docs.select("doc_id", own.alias("m"), let(word_hashes(words), copy_classes).alias("c"), trusted.alias("t"))
    per = persisted(rows.groupBy("c.least", "c.most", "doc_id", "m").agg(F.count(F.lit(1)).alias("k"), F.count_if("t").alias("kt")))
    groups = per.groupBy("least").agg(F.min(F.struct("doc_id", "m", "most")).alias("r"), F.sum("k").alias("k"), F.sum("kt").alias("kt"))
    sizes = persisted(groups.select("least", "r.most", "k", "kt"))
    classes = sizes.groupBy(apart(F.col("most")).alias("c")).agg(F.sum("k").alias("n"), F.sum("kt").alias("nt")).filter("n > 1")
    shared = sizes.join(classes, apart(F.col("most")) == F.col("c")).select(apart(F.col("least")).alias("__l"), "n", "nt")
    few = sized(per.join(shared, apart(F.col("least")) == F.col("__l")).select(F.col("doc_id").alias("__i"), F.col("m").alias("__m"), "n", "nt"))

    def part(n: str) -> Column:
        return F.call_function("div", F.lit(UNIT).cast("long"), F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("long"))
    marked = docs.select("doc_id", F.col(text), trusted.alias("__t"))
    joined = marked.join(few, (own == F.col("__m")) & F.col("doc_id").eqNullSafe(F.col("__i")), "left")
    return joined.select(words.alias("words"), part("n").alias("raw"), F.when(F.col("__t"), part("nt")).otherwise(F.lit(0).cast("long")).alias("target"))


def gram_weights(docs: DataFrame, trusted: Column, text: str = "text", buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row, one array of ``buckets`` log ratios (1e-6 nats, long);
    ``trusted`` says of a row of ``docs`` whether its text is target text."""
    grams = class_weights(docs, trusted, text).select(F.explode(gram_buckets(F.col("words"), buckets)).alias("bucket"), "raw", "target")
    per = grams.groupBy("bucket").agg(F.sum("raw").alias("r"), F.sum("target").alias("t"))
    spark = docs.sparkSession
    # integers up to here: sums do not depend on the order of rows
    both = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(per, "bucket", "left")
            .select("bucket", *[(F.coalesce(c, F.lit(0)).cast("double") / UNIT).alias(c) for c in ("r", "t")]))
    # one window over the fixed number of buckets, in their order
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    target = F.sum("t").over(w)
    expected = F.col("r") * target / F.greatest(F.sum("r").over(w), F.lit(1.0))
    pseudo = F.greatest(target * smoothing / float(buckets), F.lit(1e-9))
    ratio = F.ln(F.col("t") + pseudo) - F.ln(expected + pseudo)
    weighted = both.select("bucket", F.round(ratio * 1e6).cast("long").alias("weight"))
    packed = weighted.agg(F.sort_array(F.collect_list(F.struct("bucket", "weight"))).alias("p"))
    return packed.select(F.transform("p", lambda x: x["weight"]).alias("weights"))


def repeated_words(words: Column, hashes: Column | None = None) -> Column:
    """Words inside windows of REPEAT_WINDOW words found twice or more.
    Windows whose 64-bit hashes (built by doubling, from the words' own
    ``hashes`` if at hand) meet are compared by their words."""
    n, window = F.size(words), REPEAT_WINDOW

    def doubled(h: Column, step: int) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step)))
    hashes = F.transform(words, lambda x: F.xxhash64(x)) if hashes is None else hashes
    windows = F.when(n >= window, let(hashes, lambda h: let(doubled(h, 1), lambda a: let(doubled(a, 2), lambda b: F.slice(
        doubled(b, 4), 1, F.greatest(n - (window - 1), F.lit(1)))))))

    def met(s: Column) -> Column:
        """Of (key, start) pairs in order, the starts whose key is there twice."""
        hit = F.transform(s, lambda e, j: F.when((e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]), e["i"]))
        return F.filter(hit, lambda x: x.isNotNull())

    def union(p: Column) -> Column:
        step = F.transform(p, lambda v, k: F.coalesce(
            F.least(F.lit(window), F.get(p, k + 1) - v), F.lit(window)).cast("long"))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def confirmed(starts: Column) -> Column:
            return F.sort_array(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i + 1, window), " ").alias("h"), i.alias("i"))))
        return let(let(let(ordered, met), confirmed), lambda s: let(F.sort_array(met(s)), union))

    return F.coalesce(let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h))), F.lit(0)).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def quality_rules(docs: DataFrame, weights: DataFrame, text: str = "text", buckets: int = BUCKETS,
                  threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` plus ``q_`` columns: base counts, ``q_base_failed``,
    ``q_score`` (mean log ratio in nats) and ``q_kept``. One narrow pass."""
    docs = without(docs, "q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words", "q_base_failed", "q_score", "q_kept")
    t = F.col(text)
    d = docs.select("*", weights.scalar().alias("__lr"))
    lr = F.col("__lr")

    def measures(w: Column) -> Column:
        def hashed(h: Column) -> Column:
            per_word = F.transform(h, lambda x, i: F.get(lr, _uni(x, buckets)) + F.coalesce(F.get(lr, _bi(x, F.get(h, i + 1), buckets)), F.lit(0).cast("long")))
            return F.struct(F.size(h).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"),
                            repeated_words(w, h).alias("repeat"), F.aggregate(per_word, F.lit(0).cast("long"), lambda a, x: a + x).alias("sum"))
        return let(word_hashes(w), hashed)
    def judged(m: Column) -> Column:
        n, grams = m["n"], F.greatest(2 * m["n"] - 1, F.lit(1))
        failed = (n < MIN_WORDS) | (100 * m["repeat"] > REPEAT_PERCENT * n)
        return F.struct(m["n"].alias("n_words"), m["chars"].alias("word_chars"), m["repeat"].alias("n_repeat_words"), failed.alias("base_failed"),
                        (m["sum"] / grams / 1e6).alias("score"), (~failed & (m["sum"] >= threshold * grams)).alias("kept"))
    # one expression up to the verdict: a filter on it that the optimizer
    # pushes down evaluates it once
    d = d.select(*docs.columns, let(let(split_words(t), measures), judged).alias("__m"))
    return d.select(
        *docs.columns, *[F.col(f"__m.{c}").alias(f"q_{c}") for c in ("n_words", "word_chars")],
        F.coalesce(F.regexp_count(t, F.lit(SYMBOL_RE)), F.lit(0)).cast("long").alias("q_n_symbols"),
        duplicate_lines(t).alias("q_n_dup_lines"),
        *[F.col(f"__m.{c}").alias(f"q_{c}") for c in ("n_repeat_words", "base_failed", "score", "kept")])


def score_quality(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """Target text: the documents labelled as good quality. Their ids are
    broadcast up to a checked number, else joined by shuffle."""
    good = sized(labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("__good")).distinct())
    marked = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("__good"), "left")
    return quality_rules(docs, gram_weights(marked, F.col("__good").isNotNull()), **kw)
