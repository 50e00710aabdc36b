"""Every operator query on the smallest tables and on edge rows against its
oracle SQL, or against plain Python where SQL cannot express it."""
import collections
import hashlib
import re

import duckdb
import pytest
import xxhash

import __spark_entry__ as se
from check_oracle import _rows, type_mismatches
from llm_fixtures import edge, edge_rows, empty, tables  # noqa: F401

SMOKE = "/root/testdata/sf0.001"
QUERIES, ORACLES = se.queries(), se.oracle_sql()
OPS = sorted(k for k in QUERIES if re.match(r"op\d+_", k))
BENCH = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"
PAGES = "page_id long, url string, html string"


def ask(folder, sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{'' if folder == SMOKE else '/*.parquet'}')")
    return con.execute(sql)


@pytest.fixture(scope="module")
def folders(spark, edge, empty, edge_rows, tables):
    shared = edge_rows[11][1].split()
    bench = spark.createDataFrame([(1, " ".join(shared[30:60])), (2, "ein WORT"), (3, None), (4, ""), (5, "..."), (None, " ".join(shared[40:53])),
                                   (1, " ".join(shared[30:60])), (20, "la la la la la la la la la la la la la la")], BENCH)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (11, 0, 1), (None, 1, 1), (8, None, None), (9, 1, 1), (1, 1, 0), (99, 1, 0)], LABELS)
    big = "<p>" + "long page " * 200
    pages = spark.createDataFrame([(1, "http://a/x", big), (2, "http://b/x", big), (3, None, big), (3, "u\r\nEvil: 1", big), (4, "http://a", "short"),
                                   (5, "http://b", "short"), (6, "http://c", None), (None, "http://d", big), (7, "http://e", ""),
                                   (8, "http://f", "é" * 600), (9, "http://g", "é" * 600)], PAGES)
    extra = edge.selectExpr("*", "n_chars as key", "'x' as fp", "doc_id as shard", "lang as q_kept", "source as decon", "1 as mix_size", "2 as size", "text as line_text")
    return {
        "smoke": SMOKE,
        "edge": tables(documents=edge, benchmark=bench, labels=labels, pages=pages),
        "clash": tables(documents=extra, benchmark=bench.selectExpr("*", "1 as n_words"), labels=labels.selectExpr("*", "'t' as text"),
                        pages=pages.selectExpr("*", "'z' as payload", "1 as digest")),
        "empty": tables(documents=empty, benchmark=spark.createDataFrame([], BENCH), labels=spark.createDataFrame([], LABELS),
                        pages=spark.createDataFrame([], PAGES)),
    }


@pytest.mark.parametrize("where", ["smoke", "edge", "clash", "empty"])
@pytest.mark.parametrize("name", [k for k in OPS if k in ORACLES])
def test_matches_oracle(spark, folders, name, where):
    got = QUERIES[name](spark, folders[where])
    want = ask(folders[where], ORACLES[name])
    cols = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(cols)
    assert type_mismatches(got, want) == []
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(cols, want.fetchall())


def documents(folder):
    return ask(folder, "SELECT doc_id, text FROM documents").fetchall()


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def simhash(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, bits=4):
    """Class root of every fingerprint, all pairs compared."""
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    known = sorted(root)
    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return {f: find(f) for f in known}


def brute_simhash(docs):
    prints = [(d, simhash(t)) for d, t in docs]
    root = classes({f for _, f in prints})
    first = {}
    for d, f in prints:
        first[root[f]] = min((x for x in (first.get(root[f]), d) if x is not None), default=None)
    return [(d, f"{f:016x}", first[root[f]]) for d, f in prints]


@pytest.mark.parametrize("where", ["smoke", "edge", "clash", "empty"])
def test_simhash_matches_brute_force(spark, folders, where):
    got = [tuple(r) for r in QUERIES["op3_simhash"](spark, folders[where]).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=repr) == sorted(brute_simhash(documents(folders[where])), key=repr)


@pytest.mark.parametrize("where", ["smoke", "edge", "clash", "empty"])
def test_warc_matches_brute_force(spark, folders, where):
    pages = ask(folders[where], "SELECT page_id, html FROM pages").fetchall()
    holder = collections.defaultdict(list)
    for p, h in pages:
        holder[h or ""].append(p)
    want = []
    for p, h in pages:
        body = (h or "").encode()
        top = max((x for x in holder[h or ""] if x is not None), default=None)
        again = len(body) >= 1000 and top is not None and p != top
        want.append((p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    got = QUERIES["op1_warc"](spark, folders[where]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("where", ["smoke", "edge", "clash", "empty"])
def test_toxicity_contract(spark, folders, where):
    import zlib
    got = QUERIES["op4_toxicity"](spark, folders[where]).collect()
    docs = documents(folders[where])
    assert sorted((r.doc_id for r in got), key=repr) == sorted((d for d, _ in docs), key=repr)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    texts = dict(docs)
    for a in got:
        for b in got:
            if a.doc_id is not None and b.doc_id is not None and texts[a.doc_id] == texts[b.doc_id]:
                assert a.score == b.score


def brute_pipeline(spark, folder):
    """The stages in plain Python and SQL over whole tables."""
    con = duckdb.connect()
    files = "" if folder == SMOKE else "/*.parquet"
    for t in ("benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{files}')")
    con.execute(f"CREATE TABLE documents AS SELECT doc_id, text, source FROM read_parquet('{folder}/documents.parquet{files}') WHERE doc_id IS NOT NULL")

    def keep(ids):
        con.execute("CREATE OR REPLACE TABLE documents AS SELECT * FROM documents WHERE doc_id IN (SELECT unnest(?::BIGINT[]))", [list(ids)])
    q = con.execute(f"SELECT doc_id FROM ({ORACLES['op5_quality']}) WHERE kept").fetchall()
    keep(r[0] for r in q)
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    keep(d for d, _, c in brute_simhash(docs) if d == c)
    keep(r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op2_decontaminate']}) WHERE NOT contaminated").fetchall())
    copies = con.execute(f"SELECT doc_id, CASE WHEN size > 0 THEN taken // size ELSE 0 END FROM ({ORACLES['op8_mixing']})").fetchall()
    con.execute("CREATE OR REPLACE TABLE c(doc_id BIGINT, n BIGINT)")
    con.executemany("INSERT INTO c VALUES (?, ?)", copies or [(None, None)])
    con.execute("CREATE OR REPLACE TABLE documents AS SELECT d.* FROM documents d JOIN c USING (doc_id), unnest(range(n)) t(i)")
    return con.execute(f"SELECT doc_id, size, text_crc32, law, shard, slot, grown_shard FROM ({ORACLES['op7_sharding']})").fetchall()


def test_pipeline_matches_brute_force(spark):
    got = [tuple(r) for r in QUERIES["pipeline"](spark, SMOKE).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()]
    want = brute_pipeline(spark, SMOKE)
    assert len(got) > 20 and sorted(got) == sorted(want)


@pytest.mark.parametrize("where", ["edge", "clash", "empty"])
def test_pipeline_edge_rows(spark, folders, where):
    import corpus_pipeline
    docs = spark.read.parquet(f"{folders[where]}/documents.parquet")
    names = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {tuple(r) for r in docs.collect()}
        docs = stage(spark, docs, folders[where])
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
            assert {tuple(r) for r in docs.collect()} <= before
    slots = collections.defaultdict(list)
    for r in docs.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
