import hashlib
import random
import struct
import sys
from pathlib import Path

import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parent))
from data import ODD, documents, prose  # noqa: E402

from taskspire.llm import simhash as H  # noqa: E402


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text):
    import re

    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    pairs = list(zip(w, w[1:])) if len(w) > 1 else [(w[0], "")] if w else []
    votes = [0] * 128
    for a, b in pairs:
        h = xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42))
        second = xxhash.xxh64_intdigest(struct.pack("<i", 1), xxhash.xxh64_intdigest(struct.pack("<q", signed(h)), 42))
        for k in range(64):
            votes[k] += h >> k & 1
            votes[64 + k] += second >> k & 1
    bits = [2 * v > len(pairs) for v in votes]
    return "".join(format(sum(b << k for k, b in enumerate(bits[i : i + 64])), "016x") for i in (0, 64))


def test_against_brute_force(spark, tmp_path):
    r = random.Random(8)
    texts = [*(t for t in ODD if t is None or "\U0001f600" not in t), *(prose(r, r.randint(1, 80)) for _ in range(40)), "é" * 10 + "\U0001f600" * 5]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {x["doc_id"]: x for x in H.op4_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[i - 1 if i else len(texts) - 1] or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), i
        assert got[i]["fingerprint"] == fingerprint(t) and got[i]["edited_fingerprint"] == fingerprint(edited), i
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        if fingerprint(t) == fingerprint(nxt):
            assert got[i]["near_next"] == 1


def test_radius(spark):
    r = random.Random(2)
    base = [r.getrandbits(128) for _ in range(30)]
    all_ = base + [b ^ sum(1 << k for k in r.sample(range(128), r.randint(1, 6))) for b in base for _ in range(4)]
    frame = lambda v: spark.createDataFrame([(format(x, "032x"),) for x in v], "fingerprint string")
    got = {tuple(x) for x in H.within_radius(frame(base), frame(all_), 3).collect()}
    want = {(format(a, "032x"), format(b, "032x")) for a in base for b in set(all_) if a != b and (a ^ b).bit_count() <= 3}
    assert got == want and want
    assert H.within_radius(frame(base), frame(all_), 3).count() == len(want)


def test_counts_within_radius(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(H, "EVERY", 3)
    monkeypatch.setattr(H, "RADIUS", 9)
    r = random.Random(5)
    base = [prose(r, 60).split() for _ in range(6)]
    texts = [" ".join(w if r.random() > 0.02 else "zz" for w in b) for b in base for _ in range(7)] + [None, "", "one"]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {x["doc_id"]: x["n_within"] for x in H.op4_fingerprints(spark, str(tmp_path)).collect()}
    prints = [int(fingerprint(t or ""), 16) for t in texts]
    want = {i: sum((a ^ b).bit_count() <= 9 for b in prints) - 1 if i % 3 == 0 else None for i, a in enumerate(prints)}
    assert got == want and max(v or 0 for v in want.values()) > 1
    with pytest.raises(ValueError, match="radius"):
        H.within_radius(spark.createDataFrame([], "fingerprint string"), spark.createDataFrame([], "fingerprint string"), 32)


def test_no_python(spark, small):
    plan = H.op4_fingerprints(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_neighbours_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(H, "BUCKET_ROWS", 3)
    monkeypatch.setattr(H, "LEAST_BUCKETS", 1)
    r = random.Random(11)
    ids = r.sample(range(-500, 5000), 300)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = {x["doc_id"]: x["next_text"] for x in H.with_neighbour(df).collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}
    keys = H.with_neighbour(df).select("own", "next").collect()
    assert {k["own"] for k in keys} == {k["next"] for k in keys} and len({k["own"] for k in keys}) == 300
