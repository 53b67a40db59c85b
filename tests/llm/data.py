"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import random

SYLLABLES = "the an re tion er in on st en ed or ing".split()


def prose(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choices(SYLLABLES, k=r.choice((1, 2, 2, 3)))) for _ in range(n))


#: Null, empty and odd texts that each operator has to take.
ODD = [None, "", " \n\t ", "a", "A b", "ÀÉ ß \U0001f600  x", "x" * 5000, "word " * 3000, "\x00\x01 control"]


def documents(spark, texts, extra: bool = False):
    """doc_id, text, lang, source, n_chars; with ``extra``, columns whose names the operators use themselves."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    if extra:
        from pyspark.sql import functions as F

        for c in ("size", "shard", "slot", "sort_key", "segment", "score", "lang_pred", "leaks", "n_tokens", "rate", "copies", "bins", "words", "p_good", "set_key", "row_key", "spans", "key", "fingerprint", "lm_score", "is_target", "found", "h", "_id", "bucket", "component_id", "kept", "text_key"):
            df = df.withColumn(c, F.lit("clash"))
    return df
