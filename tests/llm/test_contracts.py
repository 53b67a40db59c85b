"""Each operator on null, empty and odd texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from data import ODD, documents, prose  # noqa: E402

from taskspire.llm import decontamination, language_id, lm_scoring, mixing, near_dedup, secrets, sharding, simhash, substring_dedup  # noqa: E402

BENCHMARK, LABELS = "item_id long, text string", "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    return [*ODD, *(prose(r, r.randint(5, 200)) for _ in range(20))] * 2


@pytest.fixture(scope="module")
def side(spark):
    bench = spark.createDataFrame([(1, "the answer is here in this long sentence. It is forty two."), (2, None), (None, "x y z"), (3, ""), (1, "the answer is here in this long sentence. It is forty two.")], BENCHMARK)
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(30)] + [(1, None, None), (2, 1, 1), (None, 1, 0)], LABELS)
    return bench, labels


OPERATORS = {
    "shard": lambda d, b, l: sharding.shard_rows(d, 4),
    "identify": lambda d, b, l: language_id.identify(d, language_id.learn(d)),
    "keep_identified": lambda d, b, l: language_id.keep_identified(d),
    "leaks": lambda d, b, l: decontamination.with_leaks(d, b),
    "keep_clean": lambda d, b, l: decontamination.keep_clean(d, b),
    "rated": lambda d, b, l: mixing.rated(d, l),
    "mix": lambda d, b, l: mixing.mix(d, l),
    "fingerprints": lambda d, b, l: simhash.fingerprint_documents(d),
    "lm": lambda d, b, l: lm_scoring.score(d, lm_scoring.models(lm_scoring.with_target(d.select("doc_id", "text"), l))),
    "secrets": lambda d, b, l: secrets.scan(d),
    "repeats": lambda d, b, l: substring_dedup.remove_repeats(d, 16),
    "near": lambda d, b, l: near_dedup.near_duplicates(d, 2),
    "keep_one": lambda d, b, l: near_dedup.keep_one_of_each(d),
}
SAME_ROWS = {"shard", "identify", "leaks", "rated", "fingerprints", "lm", "secrets", "repeats", "near"}
SAME_COLUMNS = {"keep_identified", "keep_clean", "mix", "keep_one"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_texts(name, spark, texts, side):
    docs = documents(spark, texts)
    got = OPERATORS[name](docs, *side).toPandas()
    assert len(got) == len(texts) if name in SAME_ROWS else len(got) <= len(texts)
    if name in SAME_COLUMNS:
        assert list(got.columns) == docs.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(name, spark, texts, side):
    docs = documents(spark, texts[:12], extra=True)
    got = OPERATORS[name](docs, *side)
    assert len(set(got.columns)) == len(got.columns)
    rows = got.count()
    assert rows == 12 if name in SAME_ROWS else rows <= 12
    if name in SAME_COLUMNS:
        assert got.columns == docs.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(name, spark, side):
    docs = documents(spark, ["x"]).limit(0)
    empty = tuple(s.limit(0) for s in side)
    assert OPERATORS[name](docs, *side).count() == 0
    assert OPERATORS[name](docs, *empty).count() == 0
    assert OPERATORS[name](documents(spark, [prose(random.Random(1), 30), None]), *empty).count() == 2 or name == "keep_identified"


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_and_ids(name, spark, side):
    r = random.Random(5)
    a, b = prose(r, 60), prose(r, 60)
    rows = [(1, a, "en", "s", 1), (1, a, "en", "s", 1), (1, b, "en", "s", 1), (None, b, None, None, None), (2, b, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = OPERATORS[name](docs, *side).count()
    assert got == 5 if name in SAME_ROWS else got <= 5
