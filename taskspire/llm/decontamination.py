"""Operator 1, benchmark decontamination with BM25 and block-max WAND.

The test items are put into an inverted index of BM25 impacts, each item's impacts divided by its score for its own text, so
that one threshold holds for all: the share of an item's BM25 mass that a passage covers. Every passage of every document is
a query. A passage's bounds are taken for a whole batch at once; those that may reach the threshold go through block-max
WAND, which returns all items above it; their shingles and the words of their question and answer are then compared.

Number of items, document frequencies and mean length are taken over the whole benchmark, and an item's passages are as long
as its own class of length asks for, so results don't depend on how the benchmark is cut into shards. Items without words or
id are left out; repeated items count as often as they come and are found each; ties in score don't matter, as all items
above the threshold are returned, by id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskspire.llm.common import Words, as_bytes, free_name, gram_hashes, map_arrow, materialize, pieces

#: BM25's saturation and length weight.
K1, B = 1.2, 0.75
#: Least share of an item's BM25 mass, and least overlaps of a leak: shingles of the item, words of its question and answer.
THRESHOLD, LEAST = 0.6, 0.8
SHINGLE, BLOCK = 5, 16
#: A passage has twice so many words and begins at each multiple of it; for longer items, the next power of two.
STRIDE = 64
#: Benchmark text that is searched at a time; more is cut into shards that are sent out and searched in turn, one pass over the documents each.
INDEX_BYTES = 16 * 2**20
#: Item ids that end a postings list.
END = 1 << 60


@dataclass
class Item:
    item_id: int
    shingles: np.ndarray
    question: np.ndarray
    answer: np.ndarray


@dataclass
class Index:
    """Terms are the sorted hashes of words. Term t's postings are start[t]:start[t + 1]; ``bound`` is the greatest impact in a block of BLOCK postings."""

    items: list[Item] = field(default_factory=list)
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    posting: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    impact: np.ndarray = field(default_factory=lambda: np.zeros(0))
    most: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of each term
    bound: list[list[float]] = field(default_factory=list)
    essential: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    light: np.ndarray = field(default_factory=lambda: np.zeros(0))  # mass of an item's terms that aren't essential
    stride: int = STRIDE


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's last sentence is its answer; of an item of one sentence, its last third of words."""
    sentences = [s for s in re.split(r"(?<=[.?!])\s+", text.strip()) if s]
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    cut = len(words) - max(1, len(words) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def _words(text: str) -> np.ndarray:
    return Words([text.encode()], plain=True).hashes()


def shingles(h: np.ndarray) -> np.ndarray:
    """Distinct hashes of the runs of SHINGLE words; of all words, if there are fewer."""
    return np.unique(gram_hashes(h, min(SHINGLE, len(h)))) if len(h) else np.zeros(0, np.uint64)


@dataclass
class Corpus:
    """What scores need to know of the whole benchmark: number of items, mean length, and document frequency of each of the sorted ``terms``."""

    items: int
    mean_length: float
    terms: np.ndarray
    df: np.ndarray


def corpus_of(rows: list[tuple[int, str]]) -> Corpus:
    """Of items that are all at hand."""
    hashes = [h for i, t in rows if t and i is not None and len(h := _words(t))]
    terms, df = np.unique(np.concatenate([np.unique(h) for h in hashes] or [np.zeros(0, np.uint64)]), return_counts=True)
    return Corpus(len(hashes), float(np.mean([len(h) for h in hashes] or [1.0])), terms, df)


def stride_of(n_words: int) -> int:
    return max(STRIDE, 1 << max(n_words - 1, 0).bit_length())


def build(rows: list[tuple[int, str]], corpus: Corpus | None = None, stride: int = STRIDE) -> Index:
    """The index of items (item_id, text) of one class of length, as a part of ``corpus`` (of itself, if none is given). Items without words can't leak and are left out."""
    corpus = corpus or corpus_of(rows)
    found = [(i, t, h) for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or "")) if t and i is not None and len(h := _words(t))]
    if not found:
        return Index()
    counted = [np.unique(h, return_counts=True) for _, _, h in found]
    terms, at = np.unique(np.concatenate([t for t, _ in counted]), return_inverse=True)
    item = np.repeat(np.arange(len(found)), [len(t) for t, _ in counted])
    tf = np.concatenate([c for _, c in counted]).astype(float)
    length = np.array([len(h) for _, _, h in found], float)
    df = np.bincount(at, minlength=len(terms))
    everywhere = corpus.df[np.searchsorted(corpus.terms, terms)]
    idf = np.log(1 + (corpus.items - everywhere + 0.5) / (everywhere + 0.5))
    impact = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / corpus.mean_length))
    impact /= np.bincount(item, impact)[item]
    # the commonest terms are not essential as long as they hold at most half the threshold of each item
    essential, light = np.ones(len(terms), bool), np.zeros(len(found))
    order = np.lexsort((item, at))
    start = np.concatenate([[0], np.cumsum(df)])
    for t in np.argsort(-df, kind="stable"):
        own = order[start[t] : start[t + 1]]
        new = light[item[own]] + impact[own]
        if df[t] == 1 or (new > THRESHOLD / 2).any():
            break
        essential[t], light[item[own]] = False, new
    item, impact = item[order], impact[order]
    items = [Item(int(i), shingles(h), *(np.unique(_words(x)) for x in question_and_answer(t))) for i, t, h in found]
    bounds = [[float(impact[a : min(a + BLOCK, start[t + 1])].max()) for a in range(start[t], start[t + 1], BLOCK)] for t in range(len(terms))]
    return Index(items, terms, start, item, impact, np.maximum.reduceat(impact, start[:-1]), bounds, essential, light, max(stride, stride_of(int(length.max()))))


def block_max_wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All (item, score) with a score of at least ``threshold`` for the distinct ``terms`` of a passage."""
    lists = [[int(index.posting[index.start[t]]), t, 0] for t in terms]  # where the list stands: item, term, place
    out = []

    def advance(one: list[int], to: int) -> None:
        t, a, b = one[1], index.start[one[1]] + one[2], index.start[one[1] + 1]
        place = int(np.searchsorted(index.posting[a:b], to)) + one[2]
        one[2] = place
        one[0] = int(index.posting[index.start[t] + place]) if index.start[t] + place < b else END

    while True:
        lists = [x for x in lists if x[0] < END]
        lists.sort()
        total, pivot = 0.0, -1
        for k, (_, t, _) in enumerate(lists):
            total += index.most[t]
            if total >= threshold - 1e-9:
                pivot = k
                break
        if pivot < 0:
            return out
        item = lists[pivot][0]
        while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
            pivot += 1
        # the blocks in which the lists stand, or will stand at the pivot, bound its score more closely
        closer, nearest = 0.0, END
        for one in lists[: pivot + 1]:
            a, b = index.start[one[1]], index.start[one[1] + 1]
            place = int(np.searchsorted(index.posting[a:b], item))
            if a + place < b:
                block = place // BLOCK
                closer += index.bound[one[1]][block]
                nearest = min(nearest, int(index.posting[min(b, a + (block + 1) * BLOCK) - 1]) + 1)
        if closer < threshold - 1e-9:
            after = min(nearest, lists[pivot + 1][0] if pivot + 1 < len(lists) else END)
            for one in lists[: pivot + 1]:
                if one[0] < max(after, item + 1):
                    advance(one, max(after, item + 1))
            continue
        score = 0.0
        for one in lists[: pivot + 1]:
            if one[0] < item:
                advance(one, item)
            if one[0] == item:
                score += float(index.impact[index.start[one[1]] + one[2]])
        if score >= threshold - 1e-9:
            out.append((item, score))
        for one in lists[: pivot + 1]:
            if one[0] <= item:
                advance(one, item + 1)


Leak = dict[str, float]


def find_leaks(index: Index, texts: list[bytes]) -> list[list[Leak]]:
    """For each text its leaks, one entry an item: the greatest score and overlaps of its passages, and the number of passages."""
    out: list[list[Leak]] = [[] for _ in texts]
    if not index.items:
        return out
    n = len(index.items)
    for a, b in pieces(texts):
        words = Words(texts[a:b], plain=True)
        h = words.hashes()
        if not len(h):
            continue
        term = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
        known = index.terms[term] == h
        # cells of ``stride`` words; a passage is two neighbouring cells of a text
        inside = np.arange(len(h)) - words.bound[words.doc]
        cells = np.maximum(1, -(-np.diff(words.bound) // index.stride))
        first_cell = np.concatenate([[0], np.cumsum(cells)])
        cell = first_cell[words.doc] + inside // index.stride
        heavy = np.flatnonzero(known & index.essential[term])
        df = (index.start[1:] - index.start[:-1])[term[heavy]]
        reps = np.repeat(np.arange(len(heavy)), df)
        offset = np.arange(len(reps)) - np.repeat(np.cumsum(df) - df, df)
        post = index.start[term[heavy]][reps] + offset
        at, mass = cell[heavy][reps] * n + index.posting[post], index.impact[post]
        # a cell is in the passage that it begins and in the one before, unless it is its text's first
        second = inside[heavy][reps] >= index.stride
        keys, inverse = np.unique(np.concatenate([at, at[second] - n]), return_inverse=True)
        bound = np.bincount(inverse, np.concatenate([mass, mass[second]]), len(keys))
        may = keys[bound >= THRESHOLD - index.light[keys % n] - 1e-9]
        best: dict[tuple[int, int], Leak] = {}
        for c in np.unique(may // n):
            i = int(np.searchsorted(first_cell, c, "right")) - 1
            begin = words.bound[i] + (c - first_cell[i]) * index.stride
            span = slice(begin, min(begin + 2 * index.stride, words.bound[i + 1]))
            own = h[span]
            for item, score in block_max_wand(index, np.unique(term[span][known[span]]).tolist(), THRESHOLD):
                x = index.items[item]
                overlap = np.isin(x.shingles, gram_hashes(own, min(SHINGLE, max(1, len(own)))) if len(x.shingles) > 1 or len(own) >= SHINGLE else shingles(own)).mean()
                parts = [np.isin(p, own).mean() if len(p) else 1.0 for p in (x.question, x.answer)]
                if overlap < LEAST or min(parts) < LEAST:
                    continue
                got = {"item_id": x.item_id, "bm25": round(score, 6), "overlap": round(float(overlap), 6), "question_overlap": round(float(parts[0]), 6), "answer_overlap": round(float(parts[1]), 6), "n_passages": 1}
                old = best.get((i, item))
                best[i, item] = got if old is None else {k: v if k == "item_id" else old[k] + 1 if k == "n_passages" else max(v, old[k]) for k, v in got.items()}
        for (i, _), leak in sorted(best.items()):
            out[a + i].append(leak)
    return out


LEAK = "struct<item_id:long,bm25:double,overlap:double,question_overlap:double,answer_overlap:double,n_passages:long>"
_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), *((k, pa.float64()) for k in ("bm25", "overlap", "question_overlap", "answer_overlap")), ("n_passages", pa.int64())]))


def benchmark_terms(benchmark: DataFrame) -> DataFrame:
    """item_id, text, n_words and the distinct hashed terms of each item that has words and an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_words(t or "") for t in batch.column(1).to_pylist()]
            longs = [np.unique(h).view(np.int64) for h in hashes]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(h) for h in hashes], pa.int64()), pa.array(longs, pa.list_(pa.int64()))], names=["item_id", "text", "n_words", "terms"])

    source = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    return map_arrow(source, run, "item_id long, text string, n_words long, terms array<long>").where("n_words > 0")


def passes(benchmark: DataFrame) -> Iterator[list[Index]]:
    """The benchmark's indexes, in groups of at most INDEX_BYTES of its text: those of a group are searched in one pass. A group is read when it is asked for."""
    items = materialize(benchmark_terms(benchmark), "benchmark-terms")
    n, mean = items.agg(F.count("*"), F.avg("n_words")).first()
    if not n:
        return
    stride = F.greatest(F.lit(STRIDE), F.pow(F.lit(2.0), F.ceil(F.log2("n_words"))).cast("int"))
    classed = items.withColumn("stride", stride)
    sizes = {r[0]: r[1] for r in classed.groupBy("stride").agg(F.sum(F.octet_length("text") + 16)).collect()}  # one row for each doubling of length
    cuts = {c: max(1, -(-size // INDEX_BYTES)) for c, size in sizes.items()}
    shards = [(c, k) for c in sorted(cuts) for k in range(cuts[c])]
    df = materialize(items.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")), "benchmark-df")
    group: list[Index] = []
    size = 0.0
    for c, k in shards:
        own = classed.where((F.col("stride") == c) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(cuts[c])) == k))
        rows = [(r[0], r[1]) for r in own.select("item_id", "text").collect()]
        known = df.join(own.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi").toPandas()
        terms, counts = known["term"].to_numpy(np.int64).view(np.uint64), known["df"].to_numpy(np.int64)
        order = np.argsort(terms)
        if group and size + sizes[c] / cuts[c] > INDEX_BYTES:
            yield group
            group, size = [], 0.0
        group.append(build(rows, Corpus(n, mean, terms[order], counts[order]), c))
        size += sizes[c] / cuts[c]
    yield group


def search(docs: DataFrame, indexes: list[Index], name: str) -> DataFrame:
    """``docs`` with the array of leaks of one group of indexes."""
    at = docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(indexes)  # at most INDEX_BYTES of text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(at))
            found: list[list[Leak]] = [[] for _ in texts]
            for index in sent.value:
                found = [a + b for a, b in zip(found, find_leaks(index, texts), strict=True)]
            found = [sorted(x, key=lambda leak: leak["item_id"]) for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _LEAK)], names=[*batch.schema.names, name])

    return map_arrow(docs, run, docs.select("*", F.array().cast(f"array<{LEAK}>").alias(name)).schema)


def leaks_as(docs: DataFrame, benchmark: DataFrame, name: str) -> DataFrame:
    """``docs`` with the array of ``with_leaks`` under a free name.

    A benchmark of one group is searched on the way. Of more, each group's leaks are written by the text's digest before the
    next group is read, and joined at the end; a text's leaks are at most as many as there are items.
    """
    groups = passes(benchmark)
    first, second = next(groups, []), next(groups, None)
    if second is None:
        return search(docs, first, name)
    digest = F.md5(F.encode("text", "UTF-8"))
    found = None
    for group in (first, second):
        found = _pass(docs, group, digest, found)
    for group in groups:
        found = _pass(docs, group, digest, found)
    key = free_name(docs, "_digest")
    listed = found.groupBy("digest").agg(F.sort_array(F.collect_list("leak")).alias(name)).withColumnRenamed("digest", key)
    joined = docs.withColumn(key, F.coalesce(digest, F.lit(""))).join(listed, key, "left")
    return joined.select(*docs.columns, F.coalesce(name, F.array().cast(f"array<{LEAK}>")).alias(name))


def _pass(docs: DataFrame, group: list[Index], digest: Column, before: DataFrame | None) -> DataFrame:
    rows = search(docs.select("text"), group, "leaks").where(F.size("leaks") > 0)
    # equal texts have equal leaks; what a repeated item adds stays
    own = rows.select(digest.alias("digest"), "leaks").dropDuplicates(["digest"]).select("digest", F.explode("leaks").alias("leak"))
    written = materialize(own, "leaks")
    return written if before is None else before.union(written)


def with_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the array ``leaks``, one entry an item, empty where there is none (also for null and empty texts). A column of that name is replaced."""
    return leaks_as(docs.drop("leaks"), benchmark, "leaks")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The filtering stage: documents without a leak; columns as in ``docs``."""
    name = free_name(docs, "leaks")
    return leaks_as(docs, benchmark, name).where(F.size(name) == 0).select(*docs.columns)


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it leaks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")


QUERIES = {"op1_decontamination": op1_decontamination}
SQL: dict[str, str] = {}
