import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
from data import documents, prose  # noqa: E402

from taskspire.llm import sharding  # noqa: E402


def test_law(spark):
    r = random.Random(1)
    texts = [prose(r, r.randint(1, 120)) for _ in range(600)] + ["same text"] * 300 + ["another copy of it"] * 5 + [None]
    got = sharding.shard_rows(documents(spark, texts), 8, segment_bytes=2000).collect()
    assert len(got) == len(texts)
    size, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for x in got:
        t = (x["text"] or "").encode()
        assert x["size"] == len(t) + 16 and x["text_crc32"] == zlib.crc32(t)
        size[x["shard"]] += x["size"]
        slots[x["shard"]].append(x["slot"])
        where[x["text"]].add(x["shard"])
    assert set(size) == set(range(8))
    assert max(size.values()) - min(size.values()) <= 2 * max(x["size"] for x in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(where["another copy of it"]) == 1


def test_few_rows(spark):
    got = sharding.shard_rows(documents(spark, ["a", "b"]), 40).collect()
    assert len(got) == 2 and all(0 <= x["shard"] < 40 and x["slot"] == 0 for x in got)


def test_query(spark, small):
    got = sharding.op2_sharding(spark, small)
    assert got.count() == 200 and set(r[0] for r in got.select("law").distinct().collect()) == {"bytes"}
