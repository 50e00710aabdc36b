"""Source divergence, phrase mining and personal data against plain Python."""
import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from lakemart.llm import divergence, phrases, pii
from lakemart.llm.common import exact_share
from llm_fixtures import edge, edge_rows, empty, rows, tables  # noqa: F401

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def corpus(seed, n=60):
    """Few words, so that many sequences repeat; nulls and odd characters."""
    r = random.Random(seed)
    words = ["the", "of", "New", "york", "CITY", "é-ü", "x1", "\U0001f600", "a\x00b", "la"]
    out = []
    for i in range(n):
        t = "".join(r.choice(words[:r.choice((4, 10))]) + r.choice((" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?")) for _ in range(r.randrange(0, 40)))
        out.append((r.choice((i, i, 7, None)), r.choice((t, t, t, t, None)), r.choice(("en", "en", "de", "und", None, "")), r.choice(("a", "a", "é", None, "z"))))
    return out + out[:9]


def test_exact_share_is_exact(spark):
    r = random.Random(3)
    cases = [(a, b) for b in (1, 7, 10**6 + 3, 9 * 10**15 - 1) for a in (0, 1, b // 3, b - 1, b, *(r.randrange(b + 1) for _ in range(20))) if a <= b]
    df = spark.createDataFrame(cases, "a long, b long")
    got = df.select("a", "b", exact_share(F.col("a"), F.col("b"), 3).alias("s")).collect()
    assert all(x.s == x.a * 10**9 // x.b for x in got)
    assert divergence._shares(np.array([0, 10**14]), 8 * 10**15, 3).tolist() == [1 + 10**9 * (c + 5) // (8 * 10**15 + 15) for c in (0, 10**14)]


def brute_divergence(docs, min_docs, top):
    groups, langs, seen = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, t, g, s in docs:
        w = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(t))
        groups[g or "", s or ""].update(w)
        seen[g or ""].update(set(w))
    kept = {g: {t for t, n in c.items() if n >= min_docs} for g, c in seen.items()}
    for (g, s), c in groups.items():
        for t in set(c) - kept[g]:
            del c[t]
        langs[g].update(c)

    def share(c, g):
        total = sum(c.values()) + 5 * len(kept[g])
        return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept[g]}
    p = {k: share(c, k[0]) for k, c in groups.items()}
    out = []
    for g, s in groups:
        pair = [(-sum(abs(p[g, s][t] - p[g, o][t]) for t in kept[g]), o.encode()) for h, o in groups if h == g and o != s]
        q = share(langs[g], g)
        term = [(q[t] - p[g, s][t], t.encode()) for t in kept[g] if groups[g, s][t] and p[g, s][t] > q[t]]
        for part, found, most in (("pair", pair, None), ("term", term, top)):
            out += [(g, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(sorted(found)[:most])]
    return out


@pytest.mark.parametrize("seed,min_docs,held", [(1, 3, 200_000), (2, 5, 4), (3, 40, 1), (4, 1, 10)])
def test_divergence_matches_brute_force(spark, seed, min_docs, held, monkeypatch):
    docs = corpus(seed)
    monkeypatch.setattr(divergence, "_CHUNK", 50)
    monkeypatch.setattr(divergence, "term_counts", lambda d, f=divergence.term_counts, **kw: f(d, held=held, **kw))
    got = divergence.audit_sources(spark.createDataFrame(docs, DOCS).repartition(3), min_docs, 4)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == sorted(brute_divergence(docs, min_docs, 4))


def test_equal_counts_share_runs(spark):
    docs = [(i, "alpha beta gamma delta", "en", s) for i, s in enumerate("abab")]
    runs = divergence.run_columns(divergence.kept_terms(spark.createDataFrame(docs, DOCS).coalesce(1), 2)).collect()
    assert {r.source for r in runs} == {"a", "b"}
    assert all(list(r.starts) == [0] and list(r.counts) == [2] for r in runs)  # four terms of a block, one run
    assert sum(r.length for r in runs if r.source == "a") == 4


def brute_phrases(docs, min_count, top):
    f, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, t, g, _ in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total["und" if g is None else g] += len(w)
            for m in range(1, 5):
                f["und" if g is None else g].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for g, c in f.items():
        cand = {p for p, n in c.items() if n >= min_count and len(p) > 1}
        best = []
        for p in cand:
            score, k = min((2000000 * c[p] // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            if not any(100 * c[o] >= 80 * c[p] and any(o[i:i + len(p)] == p for i in range(len(o))) for o in cand if len(o) > len(p)):
                best.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(g, i + 1, p.decode(), -a, l, r, total[g], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return out


@pytest.mark.parametrize("seed,min_count,sample,bits,chunk", [(1, 3, 8, 26, 1 << 23), (2, 2, 10**9, 26, 200), (3, 4, 1, 7, 64), (4, 3, 3, 12, 1), (5, 10**6, 2, 26, 500)])
def test_phrases_match_brute_force(spark, monkeypatch, seed, min_count, sample, bits, chunk):
    """However little the sample proposes, however full the bit table."""
    docs = corpus(seed, 80)
    monkeypatch.setattr(phrases, "_CHUNK", chunk)
    got = phrases.collocations(spark.createDataFrame(docs, DOCS).repartition(3), top=25, min_count=min_count, sample=sample, bits=bits)
    want = brute_phrases(docs, min_count, 25)
    assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == sorted(want)


def test_border_failures_start_further_passes(spark, monkeypatch):
    passes, count = [], phrases._count

    def spy(docs, new, old, *rest):
        passes.append((new, old))
        return count(docs, new, old, *rest)
    monkeypatch.setattr(phrases, "_count", spy)
    docs = spark.createDataFrame([(i, "one two three four", "en", "a") for i in range(9)], DOCS)
    found = phrases.frequent_phrases(docs, min_count=5, sample=10**9).filter("words > 0").collect()
    assert len(found) == 10 and {r.n for r in found} == {9}
    assert len(passes) == 4 and not passes[0][0].any()  # words, then one pass a length
    passes.clear()
    phrases.frequent_phrases(docs, min_count=5, sample=1).collect()
    assert len(passes) == 1  # all proposed: the border holds at once


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(d) <= 19 and luhn(d),
                    "phone": 8 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_follow_the_patterns():
    r = random.Random(5)
    parts = ["1", "22", "0", "255", "256", "@", "a.b", "c", "-", " ", ".", ".", "+", "(", ")", "é", "4111 1111 1111 1111", "5", "x@y.z", "  ", "%", "_", "007", "\U0001f600"]
    hits = 0
    for _ in range(20000):
        t = "".join(r.choice(parts) for _ in range(r.randrange(1, 30)))
        got = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(t)]
        assert got == brute_base(t), t
        hits += len(got)
    assert hits > 5000


def test_long_runs_take_linear_time():
    import time
    began = time.time()
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000, "1 " * 150_000, "a@" * 150_000, "1" * 300_000 + "." + "9" * 9000 + ".1.1",
              "Ab " * 100_000, "AB12 " * 60_000):
        pii.candidates(t)
    assert time.time() - began < 20


@pytest.fixture(scope="module")
def pii_docs(edge_rows):  # noqa: F811
    extra = ["mail Bob.7@mail.example.com now, ip 10.0.0.1 or +1 (212) 555-0100; card 4111 1111 1111 1111", "\U0001f600é x@y.zz", "icon@2x.png 999.1.1.1 4111111111111112",
             "IBAN DE89 3704 0044 0532 0130 00 of Mr. John Smith, bob (at) example (dot) com", "order 1234 5678 9012 3456 and 2001:db8:0:0:0:0:0:1"]
    return [(i, t) for i, t, *_ in edge_rows] + [(100 + i, t) for i, t in enumerate(extra)]


@pytest.mark.parametrize("where", ["smoke", "edge", "clash", "empty"])
def test_pii_query_has_every_base_span(spark, tables, pii_docs, where):  # noqa: F811
    folder = SMOKE
    if where != "smoke":
        df = spark.createDataFrame(pii_docs if where != "empty" else [], "doc_id long, text string").repartition(2)
        if where == "clash":
            df = df.selectExpr("*", "1 as pii_spans", "'x' as kind", "'y' as t")
        folder = tables(documents=df)
        docs = pii_docs if where != "empty" else []
    else:
        docs = [tuple(r) for r in spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()]
    got = se.queries()["op13_pii"](spark, folder).collect()
    want = sorted(((d, brute_base(t)) for d, t in docs), key=repr)
    have = []
    for r in got:
        spans = r.spans.split(",") if r.spans else []
        order = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)
        base = [s for s in spans if s in set(brute_base(dict(docs).get(r.doc_id)))] if r.doc_id is not None else spans
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in RULES]
        have.append((r.doc_id, base))
    assert sorted(have, key=repr) == want


def test_method_adds_spans_and_leaves_decoys(spark, pii_docs):
    docs = spark.createDataFrame(pii_docs, "doc_id long, text string")
    model = pii.train(docs)
    found = {r.doc_id: r for r in pii.find_pii(docs, model, mask=True).collect()}
    added = {(s.kind, found[i].text[s.start:s.end]) for i in found for s in found[i].pii_spans or [] if not s.base}
    assert {("iban", "DE89 3704 0044 0532 0130 00"), ("person", "Mr. John Smith"), ("email", "bob (at) example (dot) com"), ("ip", "2001:db8:0:0:0:0:0:1")} <= added
    assert not any(kind == "card" for kind, _ in added)
    assert found[100].pii_text == "mail <email> now, ip <ip> or <phone>; card <card>"
    assert found[3].pii_text is None and not found[3].pii_spans


def test_em_finds_the_labelers_reliabilities():
    r = np.random.default_rng(7)
    truth = r.random(60_000) < 0.35
    right = (0.9, 0.7, 0.8)
    votes = np.stack([np.where(r.random(truth.size) < 0.3, 0, np.where(r.random(truth.size) < p, 1, -1) * np.where(truth, 1, -1)) for p in right], axis=1)
    kinds, n = np.unique(votes, axis=0, return_counts=True)
    share, rates, post = pii.estimate(kinds, np.zeros(len(kinds), bool), n.astype(float))
    assert abs(share[0] - 0.35) < 0.03
    for j, p in enumerate(right):
        assert abs(rates[1, j, 2] / (rates[1, j, 2] + rates[1, j, 0]) - p) < 0.03
    said = dict(zip(map(tuple, kinds), post))
    sure = np.array([said[tuple(v)] for v in votes]) > 0.5
    majority = votes.sum(1) > 0
    assert (sure == truth).mean() > (majority == truth).mean()


def test_model_does_not_depend_on_the_order_of_patterns(spark, pii_docs):
    df = spark.createDataFrame(pii_docs, "doc_id long, text string")
    a, b = pii.train(df.repartition(5)), pii.train(df.coalesce(1).orderBy(F.desc("doc_id")))
    assert (a.weights == b.weights).all()
