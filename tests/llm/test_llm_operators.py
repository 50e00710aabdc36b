"""Properties of the operators beyond their queries."""
import collections
import io
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import decontaminate, licenses, lines, mixing, quality, sharding, simhash, substrings, toxicity, warc
from llm_fixtures import edge, edge_rows  # noqa: F401

SMOKE = "/root/testdata/sf0.001"


def naive_find(words, phrase):
    return [i for i in range(len(words) - len(phrase) + 1) if words[i:i + len(phrase)] == phrase]


@pytest.mark.parametrize("seed", range(12))
def test_fm_index_finds_every_occurrence(seed):
    r = random.Random(seed)
    texts = [[r.randrange(0, 5) for _ in range(r.randrange(0, 60))] for _ in range(r.randrange(1, 12))]
    texts += [texts[0]] * 3 + [[1, 2] * 20]
    seq = np.array([x for t in texts for x in (*t, 0)])
    index = decontaminate.FMIndex(seq, 3)
    for length in (1, 2, 3, 5):
        rows = np.array([[r.randrange(1, 5) for _ in range(length)] for _ in range(30)] + [([1, 2] * 3)[:length]])
        found, lo, hi = index.search(rows.ravel(), np.arange(0, rows.size, length), length)
        where = {int(f): sorted(index.locate(np.arange(a, b)).tolist()) for f, a, b in zip(found, lo, hi)}
        for i, p in enumerate(rows.tolist()):
            assert where.get(i, []) == naive_find(seq.tolist(), p)


def test_decontamination_passes_agree(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SMOKE}/benchmark.parquet")
    one = decontaminate.find_phrases(docs, bench).select("doc_id", "decon").collect()
    many = decontaminate.find_phrases(docs, bench, block_bytes=12_000).select("doc_id", "decon").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and any(r.decon["items"] for r in one)


def test_decontamination_sends_repeated_rows_once(spark, monkeypatch):
    phrase = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, f"before {phrase} after"), (2, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, phrase)] * 300 + [(None, "other words")] * 2 + [(2, phrase)], "item_id long, text string")
    sent, build = [], decontaminate.Phrases.__init__

    def spy(self, items, *rest):
        sent.append(items)
        build(self, items, *rest)
    monkeypatch.setattr(decontaminate.Phrases, "__init__", spy)
    got = {r.doc_id: r.decon["items"] for r in decontaminate.find_phrases(docs, bench, block_bytes=4000).collect()}
    assert got == {1: ["1", "2"], 2: []}
    assert sorted(x for block in sent for x in block) == [("1", phrase.encode()), ("2", phrase.encode()), ("null", b"other words")]


@pytest.mark.parametrize("seed,window", [(1, 13), (2, 4), (3, 1), (4, 2), (5, 7), (6, 13)])
def test_phrases_are_the_distinct_windows(seed, window, monkeypatch):
    r = random.Random(seed)
    texts = [" ".join(r.choice("abc") * r.choice((1, 1, 2)) for _ in range(r.randrange(0, 30))) for _ in range(40)]
    items = [(str(i % 25), t.encode()) for i, t in enumerate(texts)] + [("none", None), ("25", texts[0].encode() * 2)]
    want = collections.defaultdict(set)
    for name, t in items:
        w = tuple(decontaminate.words_of(t))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            want[w[i:i + window]].add(name)
    p = decontaminate.Phrases(items, window)
    word = {n: w for w, n in p.vocabulary.items()}
    got = {}
    for length, at, ends, owners in p.by_length:
        for i, a in enumerate(at.tolist()):
            key = tuple(word[n] for n in p.flat[a:a + length].tolist())
            assert key not in got
            got[key] = {p.names[o] for o in owners[ends[i]:ends[i + 1]].tolist()}
    assert got == dict(want)
    # many small searches find what one does
    docs = [[p.vocabulary.get(w, 0) for w in decontaminate.words_of(t.encode())] for t in texts]
    one = decontaminate.find_in_shard(docs, p)
    monkeypatch.setattr(decontaminate, "SEARCHED", 3)
    assert decontaminate.find_in_shard(docs, p) == one


def test_phrases_of_a_large_block_stay_small():
    r = random.Random(7)
    words = [f"w{i}" for i in range(20_000)]
    items = [(str(i), " ".join(r.choices(words, k=1000)).encode()) for i in range(200)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    p = decontaminate.Phrases(items)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sum(at.size for _, at, _, _ in p.by_length) > 190_000
    # 200,000 windows of 13 words: some 30 bytes each, and the vocabulary
    assert held < 10 * size and peak < 30 * size


def test_spans_are_cut_from_the_text(spark):
    phrase = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, f"Before, it. {phrase.upper()}! after"), (2, None), (3, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, phrase)], "item_id long, text string")
    got = {r.doc_id: r.decon_text for r in decontaminate.remove_spans(decontaminate.find_phrases(docs, bench)).collect()}
    assert got == {1: "Before, it. ! after", 2: None, 3: "clean"}


@pytest.mark.parametrize("bits,blocks,group", [(4, 7, 4096), (4, 7, 3), (4, 5, 8), (3, 6, 3), (1, 3, 2), (2, 4, 2)])
def test_simhash_classes_match_all_pairs(spark, bits, blocks, group):
    r = random.Random(bits * 100 + group)
    centres = [r.getrandbits(64) for _ in range(12)]
    values = {c ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, 7))) for c in centres for _ in range(14)}
    fps = [simhash.signed(v) for v in values]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = collections.defaultdict(set)
    seen = simhash.components(simhash.links(df, bits, blocks, group)).collect()
    root = {x.node: x.root for x in seen}
    for f in fps:
        got[root.get(f, f)].add(f)
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in fps:
        for b in fps:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
                up[find(a)] = find(b)
    want = collections.defaultdict(set)
    for f in fps:
        want[find(f)].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_simhash_hot_key_expands_in_many_tasks(spark, monkeypatch):
    # distinct fingerprints that share their lower parts
    df = spark.createDataFrame([(i << 40,) for i in range(400)], "fp long").repartition(8)
    seen, points = [], simhash._points

    def spy(rows, radius):
        placed = rows.select("c", "k", F.spark_partition_id().alias("task"))
        seen.append(placed.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("task").alias("tasks")).collect())
        return points(rows, radius)
    monkeypatch.setattr(simhash, "_points", spy)
    simhash.links(df, group=50)
    assert max(r.n for r in seen[0]) == 400 and all(r.n > 50 for r in seen[0])
    assert min(r.tasks for r in seen[0] if r.n == 400) == 8


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (5001, 5000)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}, 5001: 5000}


def test_keep_one_keeps_one_row_of_each_class(spark, edge):
    kept = simhash.keep_one(edge).collect()
    found = simhash.near_duplicates(edge).collect()
    assert len(kept) == len({r.root for r in found})
    smallest = {}
    for r in found:
        if r.doc_id is not None:
            smallest[r.root] = min(r.doc_id, smallest.get(r.root, r.doc_id))
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(smallest.values())


def test_warc_round_trip_over_any_split(spark, tmp_path):
    r = random.Random(5)
    pages = [(i, f"http://h{i % 3}/ü?{i}", "".join(r.choice("abc<>é \n") for _ in range(r.choice((0, 10, 1500, 90_000))))) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    warc.write_archives(warc.plan_records(df), f"{tmp_path}/w")
    want = {i: h.encode() for i, _, h in pages}
    for split in (700, 5000, 1 << 20):
        got = warc.read_archives(spark, f"{tmp_path}/w", split).collect()
        assert len(got) == 40
        assert all(bytes(x.payload) == want[int(x.record_id[10:-1])] for x in got if x.record_type == "response")
        assert {x.target_uri for x in got} == {u for _, u, _ in pages}


def test_warc_candidates_are_validated():
    record = warc.build_record(1, "http://a", b"x" * 50, "response", None)
    inner = warc._member(record)
    # a payload that is itself an archive, stored without compression
    import zlib
    z = zlib.compressobj(0, zlib.DEFLATED, 31)
    outer = warc.build_record(2, None, b"junk \x1f\x8b\x08 " + b"\x1f\x8b\x08\x00bad", "response", None)
    stored = z.compress(outer) + z.flush()
    data = stored + inner + warc._EMPTY + inner
    for cut in range(1, len(data), 7):
        got = [at for a, b in ((0, cut), (cut, len(data))) for at, _, _ in warc.read_range(io.BytesIO(data), a, b)]
        assert got == [0, len(stored), len(stored) + len(inner) + len(warc._EMPTY)]
    with pytest.raises(ValueError):
        list(warc.read_range(io.BytesIO(data[:-5]), 0, len(data)))
    broken = bytearray(data)
    broken[len(stored) + 40] ^= 255
    assert len(list(warc.read_range(io.BytesIO(bytes(broken)), 0, len(data), "skip"))) == 2


@pytest.mark.parametrize("url", ["u" * (2 << 20), "\x01\n" * (1 << 20), "".join(random.Random(1).choices("abcdefghij/%é", k=2 << 20))],
                         ids=["repetitive", "control characters", "random"])
def test_warc_record_with_a_long_header_comes_first(url):
    long = warc._member(warc.build_record(1, url, b"long", "response", None))
    data = long + warc._EMPTY + warc._member(warc.build_record(2, "http://b", b"short", "response", None))
    got = list(warc.read_range(io.BytesIO(data), 0, len(data)))
    assert [(at, head["warc-record-id"]) for at, head, _ in got] == [(0, "<urn:page:1>"), (len(long) + len(warc._EMPTY), "<urn:page:2>")]
    assert got[0][1]["warc-target-uri"] == warc._header_text(url) and got[0][2].endswith(b"long")


def test_counterfactual_penalty_spares_neutral_mentions():
    r = random.Random(3)
    neutral = [f"word{i}" for i in range(40)]
    swaps = toxicity.swap_table()

    def row(toxic, words):
        w = {x.encode() for x in words}
        off = sorted(toxicity.features({swaps.get(x, x) for x in w})) if w & set(swaps) else None
        return toxic, sorted(toxicity.features(w)), off
    rows = [row(1, ["vile", "muslim", *r.sample(neutral, 8)]) for _ in range(40)] + [row(1, ["muslim", "vile2", *r.sample(neutral, 8)]) for _ in range(40)]
    rows += [row(0, r.sample(neutral, 9)) for _ in range(150)] + [row(0, ["christian", *r.sample(neutral, 8)]) for _ in range(20)]

    def logit(model, words):
        w, b = model
        return b + sum(w[f] for f in toxicity.features({x.encode() for x in words}))
    plain, fair = toxicity.fit(rows, penalty=0.0), toxicity.fit(rows, penalty=toxicity.PENALTY)
    mention = ["muslim", *neutral[:8]]
    assert logit(plain, mention) > 0.5 and logit(fair, mention) < 0
    assert logit(fair, ["vile", "muslim", *neutral[:8]]) > 0
    gap = [abs(logit(m, ["muslim"]) - logit(m, ["christian"])) for m in (plain, fair)]
    assert gap[1] < gap[0] / 2


def test_toxicity_learns_a_repeated_id_once(spark):
    texts = [(1, f"often word{i}") for i in range(300)] + [(1, None)] + [(1, "often word0")] * 50 + [(2, "calm"), (3, "mild"), (4, "rude"), (4, "rude")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (4, 1)], "doc_id long, toxic int")
    seen = []
    for parts in (1, 7):
        rows = toxicity.training_rows(docs.repartition(parts), labels, F.lit(True), max_rows=2).collect()
        assert collections.Counter(r.toxic for r in rows) == {0: 2, 1: 2}
        seen.append(sorted(tuple(r.on) for r in rows))
    assert seen[0] == seen[1]


def test_toxicity_held_out_accuracy(spark):
    import __spark_entry__ as se
    sf = "/root/testdata/sf0.1"
    got = se.queries()["op4_toxicity"](spark, sf)
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").select("score", "toxic").collect()
    pos, neg = [r.score for r in both if r.toxic == 1], [r.score for r in both if r.toxic == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert len(pos) > 30 and auc > 0.95
    assert np.mean([p >= 0.5 for p in pos]) > 0.9 and np.mean([n >= 0.5 for n in neg]) < 0.02


@pytest.mark.parametrize("seed", range(4))
def test_substrings_match_brute_force(spark, seed):
    r = random.Random(seed)
    pool = [[f"t{r.randrange(6)}" for _ in range(r.randrange(5, 30))] for _ in range(6)]
    docs = [(i, " ".join(w for _ in range(r.randrange(1, 8)) for w in r.choice(pool))) for i in range(25)] + [(3, "t1"), (99, None)]
    window, k = 14, 5
    words = [(t or "").split() for _, t in docs]
    seen = collections.Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    want = []
    for (d, _), w in zip(docs, words):
        gone = {i + j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(window)}
        want.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = substrings.dedup_substrings(df, window=window, k=k).select("doc_id", "sub_n_words", "sub_n_removed", F.coalesce("sub_text", F.lit(""))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_substrings_take_large_arrow_types(spark, edge):
    def run():
        return sorted(map(tuple, substrings.dedup_substrings(edge).collect()), key=repr)
    want = run()
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        assert run() == want and any(r[2] for r in want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")


def test_jump_hash_is_the_published_one(spark):
    def jump(key, n):
        b, j = -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
        return b
    keys = [0, 1, 42, (1 << 64) - 1, 1 << 63, *[random.Random(i).getrandbits(64) for i in range(60)]]
    df = spark.createDataFrame([(str(k),) for k in keys], "k string").withColumn("key", F.col("k").cast("decimal(20,0)"))
    for n in (1, 2, 24, 200, 5000):
        h = sharding.jump_hash(F.col("key"), F.lit(n), F.lit(n + 1), n + 1)
        for r in df.select("k", h.alias("h")).collect():
            assert (r.h["shard"], r.h["grown"]) == (jump(int(r.k), n), jump(int(r.k), n + 1))


def test_slots_of_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "_RUN", 7)
    df = spark.createDataFrame([(1, "x")] * 50 + [(None, "x")] * 20 + [(i, None) for i in range(30)], "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in sharding.shard_documents(df, 5).collect():
        got[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert sum(map(len, got.values())) == 100 and all(sorted(s) == list(range(len(s))) for s in got.values())


def test_text_ids_are_sharded(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("007", "y"), ("7", "y"), (None, "y"), ("a", "x")], "doc_id string, text string")
    got = [r.asDict() for r in sharding.shard_documents(df, 3).collect()]
    assert sorted((r["doc_id"] or "-", r["size"]) for r in got) == [("-", 9), ("007", 9), ("7", 9), ("a", 9), ("a", 9), ("b", 8)]
    for shard in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("step", [1, 512, 4096, 1 << 32])
def test_ids_in_a_pattern_fill_all_buckets(spark, step):
    ids = spark.range(20_000).select((F.col("id") * step).alias("doc_id"))
    sizes = ids.groupBy(F.pmod(sharding.spread_of(), F.lit(sharding.BUCKETS)).alias("b")).count().agg(F.count("b"), F.max("count")).first()
    assert sizes[0] == sharding.BUCKETS and sizes[1] < 100  # 39 on average


def test_mixing_meets_targets(spark):
    r = random.Random(2)
    docs = spark.createDataFrame([(i, "w " * r.randrange(1, 40), f"s{min(i % 7, r.randrange(7))}") for i in range(6000)], "doc_id long, text string, source string")
    plan = mixing.mixing_plan(docs)
    by = plan.groupBy("source").agg(F.sum(F.col("mix_size") * F.col("mix_copies")).alias("taken"), F.max("mix_target").alias("target"),
                                    F.max("mix_source_size").alias("size"), F.max("mix_copies").alias("most")).collect()
    assert abs(sum(r.target for r in by) / sum(r.size for r in by) - 1) < 1e-9
    assert all(abs(x.taken / x.target - 1) < 0.1 and x.most <= 3 and x.target <= 3 * x.size for x in by)
    assert mixing.mix(docs).count() == plan.agg(F.sum("mix_copies")).first()[0]
    assert mixing.mix(docs).columns == docs.columns


def test_lines_far_and_near_the_threshold(spark):
    rows = [(100 * s + d, f"on many sites\nnear {s // 12}\nown {s} {d}", f"site{s}") for s in range(60) for d in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = lines.remove_boilerplate(df, min_sites=12).collect()
    # "near k" stands on exactly 12 sites
    assert all(r.line_removed == 2 and r.line_text.startswith("own ") for r in got)
    got = lines.remove_boilerplate(df, min_sites=13).collect()
    assert all(r.line_removed == 1 and r.line_text.startswith("near ") for r in got)


def test_hot_and_rare_lines(spark):
    """One line on most rows, a line often on one site only, lines seen once."""
    rows = [(i, f"hot\nown {i}\n" + ("often" if i % 3 else "local"), f"s{i % 40}" if i % 3 else "home") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.line_text for r in lines.remove_boilerplate(df, min_sites=10).collect()}
    assert got == {i: f"own {i}" if i % 3 else f"own {i}\nlocal" for i, *_ in rows}


def test_warc_tasks_are_bounded(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://x/{i}", f"page {i} " * 20) for i in range(60)], "page_id long, url string, html string")
    warc.write_archives(warc.plan_records(df), f"{tmp_path}/w")
    many, few = (warc.archive_ranges(spark, f"{tmp_path}/w", 256, most) for most in (20_000, 3))
    assert few.rdd.getNumPartitions() == 3 and many.rdd.getNumPartitions() == many.count() > 3
    assert sorted(few.collect()) == sorted(many.collect())


def test_license_templates(spark):
    texts = [(i, f"some words before {notice} and after") for i, (_, notice, _) in enumerate(licenses.TEMPLATES)]
    texts += [(100, "license mit released the under"), (101, "the general public licenses"), (102, "General-Public\nLICENSE general public license")]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, (label, _, _) in enumerate(licenses.TEMPLATES):
        assert label in got[i].lic_labels and got[i].lic_score == 1.0
    assert got[100].lic_labels == [] and got[101].lic_labels == [] and got[101].lic_score == 0
    assert (got[102].lic_n_base, got[102].lic_first_word, got[102].lic_last_word, got[102].lic_base_labels) == (2, 0, 3, ["gpl"])


def test_quality_is_native_and_shuffles_only_counts(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    found = quality.score_quality(docs, spark.read.parquet(f"{SMOKE}/labels.parquet"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
