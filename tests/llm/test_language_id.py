import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from taskspire.llm import language_id as L


def by_hand(text):
    """Binding and bundling one trigram after the other."""
    c, out = L.codes_of(text).tolist(), np.zeros(L.DIMENSIONS)
    v = lambda code: np.random.default_rng([L.SEED, code]).integers(0, 2, L.DIMENSIONS) * 2.0 - 1
    for x, y, z in zip(c, c[1:], c[2:], strict=False):
        out += np.roll(v(x), 2) * np.roll(v(y), 1) * v(z)
    return out


def test_codes_and_bundle():
    assert L.codes_of("aB-é").tolist() == [0, ord("a"), ord("b"), 0, ord("é"), 0] and L.codes_of("𐐀x").tolist() == [0, 0x10428, ord("x"), 0]
    assert len(L.grams_of("")[0]) == 0 and len(L.grams_of("123 --")[0]) == 0
    a, b = L.Bundler(), L.Bundler(most=3)
    for text in ("some longer text with many trigrams " * 3, "abc", "Юлия и Яна", "中文 字", "ﬁ ß Ünï"):
        assert np.allclose(a.bundle(text), by_hand(text)) and np.allclose(b.bundle(text), by_hand(text))


def test_letters_of_a_script_differ():
    b = L.Bundler()
    letters = [b.letter(c) for c in [*range(0x430, 0x450), *range(0x3B1, 0x3C9)]]
    assert max(abs(float(x @ y)) for i, x in enumerate(letters) for y in letters[:i]) < 6 * L.DIMENSIONS**0.5


def test_against_brute_force(spark):
    """Learning and prediction on a small fixture, one text after the other."""
    docs = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("кот и собака", "ru"), ("dog and cat", "en"), ("un chien", "fr"), ("собака и кот", "ru"), ("the the", None), ("x", "en"), ("le et un", "fr")] * 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    sums = {}
    for i, t, lang in docs:
        if zlib.crc32(str(i).encode()) % 4 != 2 and lang:
            v = by_hand(t)
            sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
    names = sorted(sums)
    learned = L.learn(df)
    assert list(learned) == names and all(np.allclose(learned[x], sums[x] / np.linalg.norm(sums[x]), atol=1e-5) for x in names)
    for r in L.identify(df, learned).collect():
        v = by_hand(r["text"])
        cosines = [float(sums[x] @ v / np.linalg.norm(sums[x]) / np.linalg.norm(v)) for x in names]
        assert r["lang_pred"] == names[int(np.argmax(cosines))] and abs(r["score"] - max(0.0, max(cosines))) < 1e-5


def test_long_text_counts_the_same():
    t = "lorem ipsum " * 2000
    g, n = L.grams_of(t)
    assert dict(zip(g.tolist(), n.tolist()))[L.grams_of("lor")[0].tolist()[1]] == 2000


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = L.op10_language_id(spark, d)
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    by = {r[0]: (r[1], r[2]) for r in got.join(docs, "doc_id").groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).collect()}
    assert by[True][0] > 0.97 and by[False][0] > 0.97 and by[True][1] > 200


def test_und(spark):
    p = {"en": np.ones(L.DIMENSIONS)}
    df = spark.createDataFrame([(1, None), (2, "123 !?"), (3, "abc"), (4, "中")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.identify(df, p).collect()}
    assert got[1] == ("und", 0.0) and got[2] == ("und", 0.0) and got[3][0] == "en" and got[4][0] == "en" and all(0 <= s <= 1 for _, s in got.values())
    assert L.identify(df, {}).where("lang_pred <> 'und'").count() == 0


def test_stage_rejects_what_it_has_not_learned(spark):
    r = random.Random(4)
    text = lambda letters, n: " ".join("".join(r.choices(letters, k=r.randint(2, 8))) for _ in range(n))
    en = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**6 + i, text("абвгдежзиклмнопрстуфхцчшщыэюя", 50), None) for i in range(60)], en.schema)
    kept = L.keep_identified(en.union(odd))
    assert kept.where("doc_id >= 1000000").count() <= 3
    assert kept.where("doc_id < 1000000").count() >= 0.98 * en.where("text rlike '[a-zA-Z]'").count()
