import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from data import documents, prose  # noqa: E402

from taskspire.llm import lm_scoring as L  # noqa: E402
from taskspire.llm.common import _LOWER  # noqa: E402


def brute_counts(texts):
    out = Counter()
    for t in texts:
        c = [L.PAD] * (L.ORDER - 1) + [int(L.CLASS[b]) for b in (t or "").encode()]
        for i in range(L.ORDER - 1, len(c)):
            out[tuple(c[i - L.ORDER + 1 : i + 1])] += 1
    return out


def brute_log(counts, gram):
    p = 1 / L.VOCABULARY
    for order in range(1, L.ORDER + 1):
        tail = gram[-order:]
        n = sum(v for g, v in counts.items() if g[-order:] == tail)
        context = sum(v for g, v in counts.items() if g[-order:-1] == tail[:-1])
        p = (n + L.PRIOR * p) / (context + L.PRIOR)
    return math.log2(p)


def brute_words(t):
    return re.findall(rb"[^ \t-\r]+|[ \t-\r]", (t or "").encode().translate(bytes(_LOWER)))


def brute_loss(text, chars, words, scale, n, types):
    """Bits of a text: words by count and spelling, white space by its byte."""
    out, at, c = 0.0, 0, [L.PAD] * (L.ORDER - 1) + [int(L.CLASS[b]) for b in text.encode()]
    for token in brute_words(text):
        spelled = sum(brute_log(chars, tuple(c[i : i + L.ORDER])) for i in range(at, at + len(token)))
        at += len(token)
        out -= spelled if token.isspace() else math.log2((words[token] * scale + types * 2.0**spelled) / (n + types))
    return out


@pytest.mark.parametrize("hot", (L.HOT_WORDS, 1, 30))
def test_scores(spark, monkeypatch, hot):
    monkeypatch.setattr(L, "HOT_WORDS", hot)
    r = random.Random(3)
    texts = [prose(r, r.randint(1, 20)) for _ in range(12)] + ["ÉCOLE!! *** 123\n", None, "", "\x00", "ÉCOLE!! *** 123\n"]
    good = set(range(6))
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(7, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, texts).select("doc_id", "text")
    got = {x["doc_id"]: x for x in L.score(docs, L.models(L.with_target(docs, labels))).collect()}
    target = [texts[i] for i in good]
    words = [Counter(w for t in group for w in brute_words(t) if not w.isspace()) for group in (target, texts)]
    n, types = sum(words[1].values()), len(words[1])
    chars = brute_counts(target), brute_counts(texts)
    for i in (0, 7, 12, 15, 16):
        tokens = len(brute_words(texts[i]))
        want = [brute_loss(texts[i], c, w, s, n, types) / tokens for c, w, s in zip(chars, words, (n / sum(words[0].values()), 1), strict=True)]
        assert got[i]["n_tokens"] == tokens and abs(got[i]["ce_target"] - want[0]) < 1e-3 and abs(got[i]["ce_background"] - want[1]) < 1e-3
        assert abs(got[i]["lm_score"] - (got[i]["ce_target"] - got[i]["ce_background"])) < 2e-6
    assert got[13]["n_tokens"] == 0 and got[13]["lm_score"] == 0 and got[14]["lm_score"] == 0


def test_probabilities_add_up():
    counts = np.zeros(L.GRAMS, np.float32)
    counts[np.random.default_rng(1).integers(0, L.GRAMS, 5000)] += 3
    p = np.exp2(L.log_probabilities(counts).astype(np.float64)).reshape(-1, L.VOCABULARY).sum(axis=1)
    assert np.allclose(p, 1, atol=1e-3)


def test_long_and_short_pieces():
    ids, sizes = L.gram_ids([b"ab", b"", b"c"])
    assert len(ids) == 3 and sizes.tolist() == [2, 0, 1] and ids[2] == L.gram_ids([b"c"])[0][0]


def test_order_of_quality(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = {(x[0], x[1]): x[2] for x in L.op7_lm_scoring(spark, d).join(labels, "doc_id").groupBy("quality", "toxic").avg("lm_score").collect()}
    assert got[1, 0] < got[0, 0] and got[1, 0] < got[1, 1]
