import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from data import documents, prose  # noqa: E402

from taskspire.llm import substring_dedup as S  # noqa: E402


def brute(texts, n):
    words = [(t or "").encode().split() for t in texts]
    count = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    out = {}
    for k, w in enumerate(words):
        gone = {j for i in range(len(w) - n + 1) if count[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[k] = (len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def corpus(seed):
    r = random.Random(seed)
    passages = [prose(r, k) for k in (15, 16, 17, 30, 90)]
    out = [None, "", "short", "a b " * 40, "z " * 100]
    for _ in range(60):
        parts = [prose(r, r.randint(1, 40)) for _ in range(r.randint(1, 4))]
        for _ in range(r.choice((0, 1, 2))):
            parts.insert(r.randrange(len(parts) + 1), r.choice(passages))
        out.append("\n".join(parts))
    return out + out[6:9] + [out[10].replace(" ", "  ")]


@pytest.mark.parametrize("hot", [S.HOT, 1])
@pytest.mark.parametrize("window", [16, 35])
def test_against_brute_force(window, hot, spark):
    texts = corpus(window)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"], r["kept_text"]) for r in S.remove_repeats(documents(spark, texts), window, hot).collect()}
    assert got == brute(texts, window)


def test_full_filter_only_costs(spark, monkeypatch):
    monkeypatch.setattr(S, "FILTER_WORDS", 1024)
    monkeypatch.setattr(S, "SHARD_WORDS", 50)
    texts = corpus(5)
    got = {r["doc_id"]: r["kept_text"] for r in S.remove_repeats(documents(spark, texts), 16).collect()}
    assert got == {k: v[3] for k, v in brute(texts, 16).items()}


def test_many_minimizers_never_reach_the_driver(spark, monkeypatch):
    monkeypatch.setattr(S, "FILTER_WORDS", 1)
    texts = corpus(7)
    docs = documents(spark, texts)
    keys = spark.range(5).select(F.col("id").alias("h"))
    assert S.filter_of(keys) is None and len(S.filter_of(keys.where("h < 4"))) == 1
    found = S.occurrences(docs.withColumn("row_key", F.col("doc_id")), keys, 16)
    assert "ShuffledHashJoin" in (plan := found._jdf.queryExecution().executedPlan().toString()) and "Broadcast" not in plan
    got = {r["doc_id"]: r["kept_text"] for r in S.remove_repeats(docs, 16).collect()}
    assert got == {k: v[3] for k, v in brute(texts, 16).items()}


def test_automaton():
    a = S.SuffixAutomaton()
    text = [1, 2, 3, 1, 2, 4]
    for c in text:
        a.add(c, 1)
    a.finish()
    assert a.repeated([1, 2, 3], 2) == [0] and a.repeated([9, 1, 2, 4], 2) == [1] and a.repeated([2, 3, 1], 2) == []
    with pytest.raises(ValueError):
        S.repeated_spans(None, 5)


def test_sql(spark):
    import duckdb

    c = duckdb.connect()
    d = "/root/testdata/sf0.001"
    c.execute(f"create view documents as select * from '{d}/documents.parquet'")
    assert {tuple(r) for r in S.op6_substring_dedup(spark, d).collect()} == set(c.execute(S.OP6_SQL).fetchall())
