import random

import numpy as np
from pyspark.sql import functions as F

from taskspire.llm import mixing as M


def brute(n, p, weights, most, total=None):
    """The same least squares by many small projected steps of plain numpy."""
    w = np.array([weights[d] for d in M.DOMAINS])
    total = (n * p[:, 0]).sum() / w[0] * w.sum() if total is None else total
    target, g = total * w / w.sum(), (p * n[:, None]).T @ p
    inverse, r = np.linalg.inv(g + 1e-9 * np.trace(g) * np.eye(3)), np.ones(len(n))
    for _ in range(3000):
        r = np.clip(r - 0.5 * p @ (inverse @ ((n * r) @ p - target)), 0, most)
    return (n * r) @ p, target


def test_fit(spark):
    r = random.Random(1)
    rows = []
    for i in range(400):
        x = np.array([r.random() ** 3, r.random() ** 3, r.random() ** 3]) + 1e-3
        x /= x.sum()
        rows.append((i, r.randint(1, 500), *map(float, x)))
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, p_good double, p_poor double, p_toxic double")
    n, p = np.array([x[1] for x in rows], float), np.array([x[2:] for x in rows])
    for weights, most in (({"good": 0.6, "poor": 0.3, "toxic": 0.1}, None), ({"good": 0.9, "poor": 0.05, "toxic": 0.05}, None), ({"good": 0.9, "poor": 0.05, "toxic": 0.05}, 1.0)):
        moved, met = M.fit_rates(df, weights, most)
        rate = df.select("doc_id", M.rate_of(moved, most).alias("r")).orderBy("doc_id").toPandas()["r"].to_numpy()
        assert (rate >= 0).all() and (most is None or (rate <= most).all())
        want, target = brute(n, p, weights, most or 1e9)
        got = (n * rate) @ p
        assert np.allclose(got, [met[d][0] for d in M.DOMAINS], rtol=1e-6)
        error = lambda x: float((x - target) @ np.linalg.inv((p * n[:, None]).T @ p) @ (x - target))
        assert error(got) <= error(want) * 1.05 + 1e-6 * target.sum()


def test_classifier(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    learned = labels.where("doc_id % 4 <> 1")
    held = M.with_posteriors(docs.select("doc_id", "text"), learned).join(labels.where("doc_id % 4 = 1"), "doc_id")
    truth = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
    best = F.when((F.col("p_good") >= F.col("p_poor")) & (F.col("p_good") >= F.col("p_toxic")), "good").when(F.col("p_poor") >= F.col("p_toxic"), "poor").otherwise("toxic")
    assert held.agg(F.avg((truth == best).cast("int"))).first()[0] > 0.9
    assert held.where(F.abs(F.col("p_good") + F.col("p_poor") + F.col("p_toxic") - 1) > 1e-9).count() == 0


def brute_posteriors(texts, labels):
    """The classifier in plain Python: terms, their weights, bins, naive Bayes."""
    import math

    import xxhash

    def words(t):
        return (t or "").lower().translate(str.maketrans("\n\t\r" + M.PUNCTUATION, " " * (3 + len(M.PUNCTUATION)))).split(" ")

    all_words = [[w for w in words(t) if w] for t in texts]
    hashed = [{int.from_bytes(xxhash.xxh64(w, seed=42).digest(), "big", signed=True) % M.TERMS for w in ws} for ws in all_words]
    sample = [(i, "toxic" if x else "good" if q else "poor") for i, (q, x) in labels.items()]
    weights = [{}, {}]
    for own, these, others in zip(weights, (("toxic",), ("poor",)), (("good", "poor"), ("good",)), strict=True):
        na, nb = (sum(d in x for _, d in sample) for x in (these, others))
        for t in set().union(*(hashed[i] for i, _ in sample)):
            a, b = (sum(t in hashed[i] for i, d in sample if d in x) + 0.5 for x in (these, others))
            odds = math.log(a / (na + 1 - a)) - math.log(b / (nb + 1 - b))
            error = math.sqrt(1 / a + 1 / b + 1 / (na + 1 - a) + 1 / (nb + 1 - b))
            if abs(odds) > M.CAUTION * error:
                own[t] = max(-127, min(127, round(math.copysign(abs(odds) - M.CAUTION * error, odds) * M.SCALE))) / M.SCALE

    def bins(i):
        t, n, size = texts[i] or "", len(all_words[i]), max(1, len((texts[i] or "").encode()))
        sums = [sum(w.get(h, 0.0) for h in hashed[i]) for w in weights]
        step = lambda x, *edges: sum(x >= e for e in edges)
        return [
            step(n, 20, 100, 500, 2000), step(t.count("!") / size, 0.0005, 0.005, 0.05), step(sum(t.count(c) for c in M.MARKS[1:]) / size, 0.0005, 0.005, 0.02, 0.1),
            step(0.85 * math.log(max(n, 1)) - math.log(max(len(set(all_words[i])), 1)), -0.5, -0.25, 0.0, 0.25, 0.75, 1.5), step(sums[0], -4, -1, 0.25, 1, 2, 4, 8), step(sums[0] / max(n, 1), 0.001, 0.004, 0.01, 0.03, 0.1),
            step(sums[1], -8, -4, -1, 0.25, 1, 4, 8), step(sums[1] / max(n, 1), -0.02, -0.005, 0.005, 0.02, 0.1),
        ]

    rows = [bins(i) for i in range(len(texts))]
    out = []
    for i in range(len(texts)):
        e = []
        for d in M.DOMAINS:
            own = [rows[k] for k, x in sample if x == d]
            s = math.log((len(own) + 1) / (len(sample) + 3)) + sum(math.log((sum(r[j] == rows[i][j] for r in own) + 0.5) / (len(own) + 4)) for j in range(M.KINDS))
            e.append(s)
        z = [math.exp(x - max(e)) for x in e]
        out.append([x / sum(z) for x in z])
    return out, [len(w) for w in all_words], weights


def test_posteriors_against_brute_force(spark):
    r = random.Random(6)
    texts, labels = [None, "", "!!! ***"], {0: (0, 0), 1: (1, 0), 2: (0, 1)}
    for i in range(3, 160):
        kind = r.choice(("good", "poor", "toxic"))
        w = [f"w{r.randint(0, 60)}" for _ in range(r.randint(5, 60))]
        w += {"good": ["Fine", "kind,"], "poor": ["buy", "now!!"], "toxic": ["awful.", "vile"]}[kind] * r.randint(1, 3)
        r.shuffle(w)
        texts.append(" ".join(w))
        if i % 4:
            labels[i] = (int(kind != "poor"), int(kind == "toxic"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame([(i, q, x) for i, (q, x) in labels.items()] + [(3, None, 1)], "doc_id long, quality int, toxic int")
    want, n, weights = brute_posteriors(texts, labels)
    assert weights[0] and weights[1] and M.learn(docs, table)[0] == tuple(weights)
    for x in M.with_posteriors(docs, table).collect():
        assert x["n_tokens"] == n[x["doc_id"]] and np.allclose([x["p_good"], x["p_poor"], x["p_toxic"]], want[x["doc_id"]], atol=1e-9)


def test_targets_are_met(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    sums = M.rated(docs, labels).agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")) for d in M.DOMAINS), F.min("rate")).first()
    assert sums[3] >= 0
    for x, d in zip(sums[:3], M.DOMAINS, strict=True):
        assert abs(x / sum(sums[:3]) - M.WEIGHTS[d]) < 1e-3 * M.WEIGHTS[d], d


def test_stage_without_repeats(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    got = M.mix(docs, labels, repeat=False)
    assert got.groupBy("doc_id").count().where("count > 1").count() == 0 and 0 < got.count() <= docs.count()


def test_conflicting_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (2, 1, 0), (3, 1, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert dict(map(tuple, M.labelled(docs, labels).collect())) == {"a": "poor", "b": "toxic", "c": "good"}


def test_copies(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(1.3).alias("r"))
    got = [x[0] for x in df.select(M.copies(F.col("r"), M.chance())).collect()]
    assert set(got) == {1, 2} and abs(sum(got) / 20000 - 1.3) < 0.02


def test_repeats(spark):
    docs = spark.createDataFrame([(i, f"good words here number {i}", "en", "s", 1) for i in range(30)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    got = M.mix(docs, labels, {"good": 1.0, "poor": 1.0, "toxic": 1.0}, None)
    assert got.columns == docs.columns and got.count() >= 30


def test_solve():
    assert np.allclose(M.solve([[2.0, 1.0], [1.0, 3.0]], [3.0, 5.0]), np.linalg.solve([[2, 1], [1, 3]], [3, 5]), atol=1e-6)


def test_no_python(spark, small):
    plan = M.op3_mixing(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
