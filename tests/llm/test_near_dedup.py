import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from data import documents, prose  # noqa: E402

from taskspire.llm import components as C  # noqa: E402
from taskspire.llm import near_dedup as N  # noqa: E402


def brute(texts, n, percent):
    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        return {b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({b" ".join(w)} if w else set())

    s = [shingles(t) for t in texts]
    root = list(range(len(s)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s[i]), find(i)) for i in range(len(s))}


def corpus(seed, n=60):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        w = prose(r, r.randint(3, 120)).split()
        out.append(" ".join(w))
        for _ in range(r.choice((0, 0, 1, 3, 8))):
            v = w[:]
            for _ in range(r.randint(0, max(1, len(v) // 12))):
                v[r.randrange(len(v))] = r.choice("xyz") * 3
            out.append(" ".join(v).upper() if r.random() < 0.2 else "\n".join(v))
    return out + [None, "", "one", "ONE", "two words", "two  words"]


@pytest.mark.parametrize("seed, n", [(1, 2), (2, 5)])
def test_against_brute_force(seed, n, spark):
    texts = corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(documents(spark, texts), n, 80).collect()}
    assert got == brute(texts, n, 80)


def test_large_group(spark, monkeypatch):
    monkeypatch.setattr(N, "REGION", 20)
    monkeypatch.setattr(N, "PART", 10)
    r = random.Random(4)
    w = prose(r, 200).split()
    texts = []
    for i in range(120):
        v = w[:]
        v[r.randrange(200)] = f"own{i}"
        texts.append(" ".join(v))
    got = N.near_duplicates(documents(spark, texts), 2, 80)
    assert {x["component_id"] for x in got.collect()} == {0} and got.where("kept").count() == 1


def sparse_family(n, partners=1):
    """Texts about one template; each resembles its own ``partners`` and no others enough."""
    r = random.Random(12)
    w = prose(r, 300).split()
    out = []
    for i in range(n):
        v = w[:]
        for k in range(14):
            v[r.randrange(300)] = f"own{i}x{k}"
        for p in range(partners + 1):
            u = v[:]
            for k in range(6):
                u[r.randrange(300)] = f"late{i}x{p}x{k}"
            out.append(" ".join(u))
    r.shuffle(out)
    return out


def test_few_links_in_a_dense_region(spark, monkeypatch):
    monkeypatch.setattr(N, "REGION", 20)
    monkeypatch.setattr(N, "PART", 5)
    monkeypatch.setattr(N, "BLOCK", 16)
    texts = sparse_family(150, 1) + sparse_family(50, 2)
    want = brute(texts, 2, 80)
    assert len({c for _, c in want.values()}) > 100
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(documents(spark, texts), 2, 80).collect()}
    assert got == want


@pytest.mark.parametrize("n, edits", [(400, 4), (900, 5)])
def test_family_of_borderline_members(n, edits, spark):
    """Each pair is near the limit, so links are few among many comparisons."""
    r = random.Random(3)
    w, texts = prose(r, 100).split(), []
    for i in range(n):
        v = w[:]
        for k in r.sample(range(100), edits):
            v[k] = f"e{i}x{k}"
        texts.append(" ".join(v))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(documents(spark, texts), 2, 80).collect()}
    assert got == brute(texts, 2, 80)


def test_block_against_brute_force():
    import numpy as np

    r = np.random.default_rng(8)
    base = r.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.where(r.random(60) < 0.08, r.integers(0, 2**63, 60).astype(np.uint64), base)) for _ in range(60)]
    key, stray = np.arange(60) * 7, np.arange(60) % 3 > 0
    links = {(a // 7, b // 7) for a, b in N.links_of_block(key, key, stray, sets, 80)}
    near = {(i, j) for i in range(60) for j in range(i + 1, 60) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert links <= near

    def parts(edges):
        root = list(range(60))
        for _ in range(60):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert parts(links) == parts({(i, j) for i, j in near if stray[i] or stray[j]})


def test_equal_ids_with_other_texts(spark):
    """A doc_id with two texts doesn't lend one of them to the other's set."""
    r = random.Random(2)
    a, b = prose(r, 80), prose(r, 80)
    docs = spark.createDataFrame([(1, a), (1, b), (2, a + " more"), (3, b + " more")], "doc_id long, text string")
    got = sorted(tuple(x) for x in N.near_duplicates(docs, 2, 80).select("doc_id", "n_shingles", "component_id").collect())
    assert [x[0] for x in got] == [1, 1, 2, 3] and {x[2] for x in got} == {1}


def test_large_regions_are_cut_along_their_order(spark, monkeypatch):
    monkeypatch.setattr(N, "REGION", 20)
    monkeypatch.setattr(N, "PART", 10)
    signed = spark.createDataFrame([(2 * i + k, 2 * i + k, 9, [7], [i * 2**49 + k], 0) for i in range(40) for k in (0, 1)], "doc_id long, set_key long, n_shingles long, regions array<long>, orders array<long>, sketch long")
    got = {tuple(r) for r in N.candidates(N.shared_regions(signed)).collect()}
    assert {(2 * i, 2 * i + 1) for i in range(40)} <= got


def test_keep_one(spark):
    texts = corpus(7, 20)
    kept = {r["doc_id"] for r in N.keep_one_of_each(documents(spark, texts), 5, 80).collect()}
    assert kept == {i for i, (_, c) in brute(texts, 5, 80).items() if i == c}


def test_components(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, r.randrange(101, 130)) for _ in range(40)] + [(5, 5), (200, 201), (201, 200)]
    got = {x[0]: x[1] for x in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(v == 100 for k, v in got.items() if 100 <= k < 130) and got[201] == 200
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sql(spark):
    import duckdb

    c = duckdb.connect()
    d = "/root/testdata/sf0.001"
    c.execute(f"create view documents as select * from '{d}/documents.parquet'")
    assert {tuple(r) for r in N.op9_near_dedup(spark, d).collect()} == set(c.execute(N.OP9_SQL).fetchall())
