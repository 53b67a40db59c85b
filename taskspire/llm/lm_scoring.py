"""Operator 7, language-model scoring by cross-entropy difference.

Two models of the same form, smoothing and vocabulary are counted: the target's over the documents labelled good and not toxic,
the background's over all documents. A document's score is its mean loss a token under the target model less that under the
background model; the lower, the more it reads like the target.

Tokens are words (runs of characters other than white space, a-z for A-Z) and the white-space bytes between them. The
vocabulary, shared by both models, is every word of all documents, so it grows with the corpus: it stays a distributed table,
and words are looked up by a join. A word's probability is (count + V * spelling) / (tokens + V) for a vocabulary of V words;
its spelling is the product of its bytes' probabilities under 4-grams of byte classes (a fixed table), which carry the context
over word ends and give unseen words their share. The target's counts are scaled to the background's number of words, so that both
models are matched in mass and smoothing.

Words that make up at least one in HOT_WORDS of all are at most that many; they are sent to every task and add up there. Only the
rarer ones are shuffled, and none of them has more than that share of the rows. Equal texts get equal scores; null and empty
texts have 0 tokens and zeros; repeated rows are counted and kept; without target documents the target's words are all unseen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspire.llm.common import Words, as_bytes, fits_broadcast, free_name, map_arrow, materialize, pieces, row_key

#: Tokens of a model's context and its next token together; the pseudo-count that a lower order gets.
ORDER, PRIOR = 4, 64.0
#: Classes of marks, in order of their token; letters come before them, the classes of upper bytes after.
MARKS = (" \t\r\x0b\x0c", "\n", "0123456789", ".", ",", "!", "?", ":;", "\"'`", "-_", "()[]{}<>", "|", "*#$%&@", "=+/\\^~")
PAD, FIRST_MARK = 0, 27


def _classes() -> tuple[np.ndarray, int]:
    out = np.full(256, FIRST_MARK + len(MARKS), np.uint8)  # controls and the rest
    for i in range(26):
        out[ord("a") + i] = out[ord("A") + i] = 1 + i
    for i, chars in enumerate(MARKS):
        out[list(chars.encode())] = FIRST_MARK + i
    upper = FIRST_MARK + len(MARKS) + 1
    out[0x80:0xC0] = upper + np.arange(64) % 8
    out[0xC0:0xE0], out[0xE0:0xF0], out[0xF0:] = upper + 8, upper + 9, upper + 10
    return out, upper + 11


CLASS, VOCABULARY = _classes()
GRAMS = VOCABULARY**ORDER
#: Bytes of text for which n-grams are made at once; distinct words a task holds before it sends their counts on.
PIECE, HELD = 1 << 20, 1 << 20
#: A word is sent to every task if at least one in this many of all words is it (at most 12 MB), a text's score if one row in HOT_TEXTS has it.
HOT_WORDS, HOT_TEXTS = 500_000, 10_000


def gram_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of ``texts``, and the number of bytes of each text."""
    gap = ORDER - 1
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"\0" * gap + (b"\0" * gap).join(texts), np.uint8)
    codes = CLASS[data].astype(np.int32)
    first = gap + np.concatenate([[0], np.cumsum(sizes + gap)[:-1]])
    own = np.zeros(len(data) + 1, np.int32)
    np.add.at(own, first, 1)
    np.add.at(own, first + sizes, -1)
    own = np.cumsum(own[:-1]) > 0
    codes[~own] = PAD
    ids = codes[gap:].copy()
    for k in range(1, ORDER):
        ids += codes[gap - k : len(codes) - k] * VOCABULARY**k
    return ids[own[gap:]], sizes


def count_grams(docs: DataFrame) -> DataFrame:
    """Counts over all rows of ``docs`` (text, is_target): is_word, gram (the hash of a word or the number of a byte n-gram), background, target. Each task adds up its own first."""

    def rows(is_word: bool, ids: np.ndarray, background: np.ndarray, target: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(ids), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_pydict({"is_word": pa.array(np.full(len(ids[part]), is_word)), "gram": pa.array(ids[part].astype(np.int64)), "background": pa.array(background[part].astype(np.int64)), "target": pa.array(target[part].astype(np.int64))})

    def merge(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return ids, *(np.bincount(at, np.concatenate([h[k] for h in held]), len(ids)).astype(np.int64) for k in (1, 2))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, held, size = np.zeros((2, GRAMS), np.int32), [], 0
        for batch in batches:
            texts, target = as_bytes(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for kind in (0, 1):
                own = [t for t, x in zip(texts, target, strict=True) if t and bool(x) == bool(kind)]
                for a, b in pieces(own, PIECE):
                    totals[kind] += np.bincount(gram_ids(own[a:b])[0], minlength=GRAMS).astype(np.int32)
                    words, n = np.unique(Words(own[a:b], lower=True).hashes().view(np.int64), return_counts=True)
                    held.append((words, n, n * kind))
                    size += len(words)
                    if size > 2 * HELD:
                        held = [merge(held)]
                        size = len(held[0][0])
                        if size > HELD:
                            yield from rows(True, *held[0])
                            held, size = [], 0
        if held:
            yield from rows(True, *merge(held))
        seen = np.flatnonzero(totals.any(axis=0))
        yield from rows(False, seen, totals[:, seen].sum(axis=0, dtype=np.int64), totals[1, seen])

    counted = map_arrow(docs.select("text", "is_target"), count, "is_word boolean, gram long, background long, target long")
    return counted.groupBy("is_word", "gram").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log2 P(last token | the tokens before) for each n-gram: each order is smoothed with the next lower one."""
    p = np.full(VOCABULARY, 1.0 / VOCABULARY, np.float32)
    for order in range(1, ORDER + 1):
        n = counts.reshape(-1, VOCABULARY**order).sum(axis=0, dtype=np.float64).reshape(-1, VOCABULARY).astype(np.float32)
        context = n.sum(axis=1, keepdims=True)
        # the lower order's table is over the last order - 1 tokens: it repeats for each first token
        lower = np.tile(p.reshape(-1, VOCABULARY), (len(n) // max(1, len(p) // VOCABULARY), 1))
        n += PRIOR * lower
        n /= context + PRIOR
        p = n.reshape(-1)
    return np.log2(p, out=p)


@dataclass
class Models:
    """Both models: ``words`` (gram, background, target) as a table; ``spelling``, the logarithms of byte n-grams, target first; sizes."""

    words: DataFrame
    spelling: tuple[np.ndarray, np.ndarray]
    n_words: int
    vocabulary: int
    scale: float


def models(docs: DataFrame) -> Models:
    """Counts both models over all of ``docs`` (text, is_target). The driver gets the table of byte n-grams, of at most VOCABULARY ** ORDER rows, and sums; words stay distributed."""
    counted = materialize(count_grams(docs), "lm-counts")
    got = counted.where("not is_word").select(F.col("gram").cast("int"), "background", "target").toPandas()
    spelling = []
    for kind in ("target", "background"):
        counts = np.zeros(GRAMS, np.float32)
        counts[got["gram"].to_numpy()] = got[kind].to_numpy()
        spelling.append(log_probabilities(counts))
    words = counted.where("is_word").select("gram", "background", "target")
    n, target, types = words.agg(F.sum("background"), F.sum("target"), F.count("*")).first()
    return Models(words, tuple(spelling), n or 0, max(types, 1), (n or 0) / target if target else 0.0)


def log_word(count: np.ndarray, spelled: np.ndarray, m: Models | tuple[int, int]) -> np.ndarray:
    """log2 P(word) by its (scaled) count and the log2 of its spelling, for (n_words, vocabulary)."""
    n, types = m
    with np.errstate(divide="ignore"):
        return np.logaddexp2(np.log2(count), np.log2(types) + spelled) - np.log2(n + types)


def _log_word_column(count, spelled, n: int, types: int):
    """``log_word`` as a column."""
    unseen = spelled + F.lit(float(np.log2(types)))
    seen = F.log2(count)
    both = F.greatest(seen, unseen) + F.log2(1 + F.pow(F.lit(2.0), -F.abs(seen - unseen)))
    return F.when(count > 0, both).otherwise(unseen) - F.lit(float(np.log2(n + types)))


def text_losses(docs: DataFrame, m: Models) -> DataFrame:
    """For each distinct text that isn't empty, by its keys k1 and k2: copies, n_tokens of one copy, and its bits under both models."""
    size = (m.n_words, m.vocabulary)
    least = m.n_words / HOT_WORDS
    hot = m.words.where(F.col("background") >= least).toPandas().sort_values("gram")
    shared = docs.sparkSession.sparkContext.broadcast((*m.spelling, hot["gram"].to_numpy(np.int64), hot["target"].to_numpy(float) * m.scale, hot["background"].to_numpy(float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell_target, spell_background, known, *counts = shared.value
        for batch in batches:
            keys, texts = [batch.column(k).to_numpy() for k in (1, 2)], as_bytes(batch.column(0))
            for a, b in pieces(texts, PIECE):
                part = texts[a:b]
                ids, sizes = gram_ids(part)
                words = Words(part, lower=True)
                h, n_words = words.hashes().view(np.int64), np.diff(words.bound)
                place = np.searchsorted(known, h)
                is_hot = np.zeros(len(h), bool)
                inside = place < len(known)
                is_hot[inside] = known[place[inside]] == h[inside]
                cold, ends = np.flatnonzero(~is_hot), np.cumsum(sizes)
                n_tokens = n_words + sizes - np.bincount(words.doc, words.end - words.start, len(part)).astype(np.int64)
                bits, spelled = [], []
                for spelling, count in zip((spell_target, spell_background), counts, strict=True):
                    total = np.concatenate([[0.0], np.cumsum(spelling[ids], dtype=np.float64)])
                    own = total[words.end - words.doc] - total[words.start - words.doc]
                    between = total[ends] - total[ends - sizes] - np.bincount(words.doc, own, len(part))
                    known_bits = log_word(count[place[is_hot]], own[is_hot], size)
                    bits.append(-between - np.bincount(words.doc[is_hot], known_bits, len(part)))
                    spelled.append(own[cold])
                row = np.flatnonzero(sizes)
                yield _losses(keys[0][a:b][row], keys[1][a:b][row], None, np.ones(len(row), np.int64), n_tokens[row], bits[0][row], bits[1][row])
                doc = words.doc[cold]
                for at in range(0, len(cold), 100_000):
                    x = slice(at, at + 100_000)
                    yield _losses(keys[0][a:b][doc[x]], keys[1][a:b][doc[x]], h[cold[x]], np.zeros(len(doc[x]), np.int64), np.zeros(len(doc[x]), np.int64), spelled[0][x], spelled[1][x])

    keyed = docs.where("text <> ''").select("text", row_key("text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2"))
    got = map_arrow(keyed, run, "k1 long, k2 long, word long, copies long, n_tokens long, target float, background float")
    sums = ("copies", "n_tokens", "target", "background")
    done = got.select("k1", "k2", "copies", "n_tokens", F.col("target").cast("double"), F.col("background").cast("double"), "word")
    rare = m.words.where(F.col("background") < least).select(F.col("gram").alias("word"), F.col("target").alias("c_target"), F.col("background").alias("c_background"))
    # rows of whole texts carry no word: they go round the join, in which their keys would all be null
    done = materialize(done, "lm-losses")
    n, types = size
    joined = done.where("word is not null").join(rare, "word", "left")
    bits = {k: -_log_word_column(F.coalesce(F.col(f"c_{k}"), F.lit(0)) * F.lit(m.scale if k == "target" else 1.0), F.col(k), n, types) for k in ("target", "background")}
    joined = joined.select("k1", "k2", "copies", "n_tokens", *(v.alias(k) for k, v in bits.items()))
    added = done.where("word is null").drop("word").unionByName(joined).groupBy("k1", "k2").agg(*(F.sum(c).alias(c) for c in sums))
    one = added.select("k1", "k2", "copies", *((F.col(c) / F.col("copies")).alias(c) for c in sums[1:]))
    return one.withColumn("n_tokens", F.col("n_tokens").cast("long"))


def _losses(k1, k2, word, copies, n_tokens, target, background) -> pa.RecordBatch:
    word = pa.nulls(len(k1), pa.int64()) if word is None else pa.array(word)
    return pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), word, pa.array(copies), pa.array(n_tokens), pa.array(target.astype(np.float32)), pa.array(background.astype(np.float32))], names=["k1", "k2", "word", "copies", "n_tokens", "target", "background"])


def score(docs: DataFrame, m: Models) -> DataFrame:
    """``docs`` with n_tokens, ce_target, ce_background (bits a token) and lm_score, their difference. Null or empty text: 0 tokens and zeros. Columns of these names are replaced."""
    docs = docs.drop("n_tokens", "ce_target", "ce_background", "lm_score")
    losses = materialize(text_losses(docs.select("text"), m), "lm-scores")
    rows = losses.agg(F.sum("copies")).first()[0] or 0
    frequent = losses.where(F.col("copies") >= max(2, rows / HOT_TEXTS))
    k1, k2, own, fit = (free_name(docs, c) for c in ("lm_k1", "lm_k2", "lm_own", "lm_fit"))
    values = F.struct("n_tokens", "target", "background")
    docs = docs.withColumn(k1, row_key("text")).withColumn(k2, F.xxhash64("text", F.lit(1)))
    docs = docs.join(F.broadcast(frequent.select(F.col("k1").alias(k1), F.col("k2").alias(k2), values.alias(own))), [k1, k2], "left")
    # rows that have their score are spread over all partitions
    docs = docs.withColumn(k1, F.when(F.col(own).isNull() & F.col("text").isNotNull(), F.col(k1)).otherwise(F.monotonically_increasing_id()))
    docs = docs.join(losses.select(F.col("k1").alias(k1), F.col("k2").alias(k2), values.alias(fit)), [k1, k2], "left")
    value = F.coalesce(own, fit)
    n = F.coalesce(value["n_tokens"], F.lit(0).cast("long"))
    docs = docs.withColumn("n_tokens", n)
    for k in ("target", "background"):
        docs = docs.withColumn(f"ce_{k}", F.when(F.col("n_tokens") > 0, F.round(value[k] / F.col("n_tokens"), 6)).otherwise(F.lit(0.0)))
    return docs.withColumn("lm_score", F.round(F.col("ce_target") - F.col("ce_background"), 6)).drop(k1, k2, own, fit)


def with_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with is_target: whether a label row says good quality and not toxic. The labels are broadcast only if few enough."""
    good = labels.where("quality = 1 and toxic = 0").select("doc_id").distinct()
    good = F.broadcast(good) if fits_broadcast(labels, 16) else good
    return docs.join(good.withColumn("is_target", F.lit(True)), "doc_id", "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, models(with_target(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))).drop("text")


QUERIES = {"op7_lm_scoring": op7_lm_scoring}
SQL: dict[str, str] = {}
