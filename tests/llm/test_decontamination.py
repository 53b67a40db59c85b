import random
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from data import documents, prose  # noqa: E402

from taskspire.llm import decontamination as D  # noqa: E402


def sentence(r, n):
    return prose(r, n).capitalize() + "."


def test_leaks(spark):
    r = random.Random(2)
    items = [(i, " ".join(sentence(r, r.randint(5, 25)) for _ in range(r.randint(1, 3)))) for i in range(60)]
    items += [(60, "tiny one"), (61, items[0][1])]
    texts, want = [], set()
    for k in range(200):
        body = prose(r, r.randint(5, 600)).split()
        if k % 4 == 0:
            i = r.randrange(60)
            leak = items[i][1]
            if k % 8 == 0:
                leak = leak.upper().replace(" ", "!! ")
            at = r.randrange(len(body) + 1)
            body[at:at] = leak.split()
            want |= {(k, i)} | ({(k, 61)} if i == 0 else set())
        texts.append(" ".join(body))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], leak["item_id"]) for x in D.with_leaks(documents(spark, texts), bench).collect() for leak in x["leaks"]}
    assert {g for g in got if g[1] != 60} == want
    assert D.keep_clean(documents(spark, texts), bench).count() == len(texts) - len({k for k, _ in got})


@pytest.mark.parametrize("size", [300, 3000])
def test_shards_of_the_index(size, spark, monkeypatch):
    """Scores and overlaps are the same however the benchmark is cut, and a long item doesn't widen the passages of others."""
    monkeypatch.setattr(D, "LEAST", 0.0)
    r = random.Random(3)
    items = [(i, sentence(r, r.choice((8, 20, 70)))) for i in range(30)] + [(30, sentence(r, 900)), (31, None), (None, "a b c"), (3, "once more. the same id")]
    texts = [prose(r, 30) + " " + (t or "") + " " + prose(r, r.choice((0, 300))) for _, t in items] + [None, "", prose(r, 400)]
    docs = documents(spark, texts + texts[:5])
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda: sorted((x["doc_id"], [tuple(y) for y in x["leaks"]]) for x in D.with_leaks(docs, bench).collect())
    whole = rows()
    monkeypatch.setattr(D, "INDEX_BYTES", size)
    assert len(list(D.passes(bench))) > 1
    assert rows() == whole and sum(bool(x) for _, x in whole) >= 32
    assert D.build([(1, sentence(r, 10))]).stride == 64 and D.build([(1, sentence(r, 70))]).stride == 128


def test_block_max_wand_is_exact():
    r = random.Random(6)
    index = D.build([(i, prose(r, r.randint(3, 40))) for i in range(200)])
    for _ in range(100):
        terms = sorted(r.sample(range(len(index.terms)), min(len(index.terms), r.randint(1, 60))))
        mass = {}
        for t in terms:
            for k in range(index.start[t], index.start[t + 1]):
                mass[int(index.posting[k])] = mass.get(int(index.posting[k]), 0.0) + float(index.impact[k])
        for threshold in (0.05, 0.3, 0.6):
            want = {i for i, s in mass.items() if s >= threshold - 1e-9}
            got = D.block_max_wand(index, terms, threshold)
            assert {i for i, _ in got} == want and all(abs(s - mass[i]) < 1e-9 for i, s in got)


def test_question_and_answer():
    assert D.question_and_answer("What is it? A thing.") == ("What is it?", "A thing.")
    assert D.question_and_answer("a b c d e f") == ("a b c d", "e f")


def test_test_tables(spark):
    import duckdb

    d = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"select doc_id, text from '{d}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{d}/benchmark.parquet'").fetchall()
    grams = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)})(re.findall(r"[^\W_]+", t.lower()))
    own = {i: grams(t) for i, t in items}
    want = {(k, i) for k, t in docs for g in [grams(t)] for i, s in own.items() if s and len(s & g) >= 0.8 * len(s)}
    assert {(x["doc_id"], x["item_id"]) for x in D.op1_decontamination(spark, d).collect()} == want
