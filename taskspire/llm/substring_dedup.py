"""Operator 6, removal of repeated word sequences by matching statistics in suffix automata.

A window of n words has a minimizer: its run of K words with the least hash. Equal windows have equal minimizers at the same
offset, so documents are cut into segments, the stretches of windows that share one, and only segments with equal minimizers
need be compared. The distinct segments of a range of minimizers are a reference shard. Each shard's automaton is built
where the shard is (the corpus is its own reference, too large to be sent everywhere), weighted by how often each segment
occurs, and the segments are streamed through it: a window is repeated if its state's weight is 2 or more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taskspire.llm.common import Words, as_bytes, free_shuffles, gram_hashes, map_arrow, materialize, mix, pieces

#: Words of a minimizer; a window has window - K + 1 of them.
K = 8
#: Words for which one automaton is built at a time.
SHARD_WORDS = 60_000
#: A minimizer with more distinct segments than this is cut into single windows, each a segment of its own.
HOT = 4096
#: The filter of repeated minimizers goes through the driver, so it has at most this many 64-bit words (128 KB), 16 bits for
#: each minimizer. More minimizers than that stay a distributed table, and the segments are joined with it.
FILTER_WORDS = 1 << 14


class SuffixAutomaton:
    """Of a sequence of numbers: its states' longest lengths, suffix links and transitions, and the weight of their ends."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]
        self.last = 0

    def add(self, c: int, weight: int) -> None:
        cur = len(self.next)
        self.next.append({})
        self.length.append(self.length[self.last] + 1)
        self.weight.append(weight)
        self.link.append(0)
        p, nxt, link, length = self.last, self.next, self.link, self.length
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                self.weight.append(0)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        self.last = cur

    def finish(self) -> None:
        """Passes each state's weight on to its suffixes."""
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.weight[self.link[v]] += self.weight[v]

    def repeated(self, sequence: list[int], window: int) -> list[int]:
        """The starts of the windows of ``sequence`` that end in states of weight 2 or more: those whose matching statistic, counted twice, reaches the window."""
        out, v, size = [], 0, 0
        for i, c in enumerate(sequence):
            while v and c not in self.next[v]:
                v = self.link[v]
                size = self.length[v]
            if c in self.next[v]:
                v, size = self.next[v][c], size + 1
            while v and self.length[self.link[v]] >= window:
                v = self.link[v]
                size = self.length[v]
            if size >= window and self.weight[v] >= 2:
                out.append(i - window + 1)
        return out


def segments(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For slices of ``texts``: arrays of each segment's minimizer, text, first window (as a word's number in the text), number of windows, and hash."""
    for a, b in pieces(texts):
        words = Words(texts[a:b])
        h = words.hashes()
        if len(h) < window:
            continue
        g, width = gram_hashes(h, K), window - K + 1
        # the leftmost least minimizer of each window, by doubling
        least, place, size = g, np.arange(len(g)), 1
        while size < width:
            by = min(size, width - size)
            keep = least[:-by] <= least[by:]
            least, place = np.where(keep, least[:-by], least[by:]), np.where(keep, place[:-by], place[by:])
            size += by
        n = len(h) - window + 1
        whole = words.doc[:n] == words.doc[window - 1 :]
        new = np.ones(n, bool)
        new[1:] = (place[1:n] != place[: n - 1]) | ~whole[:-1]
        first = np.flatnonzero(new & whole)
        ends = np.concatenate([np.flatnonzero(new | ~whole), [n]])
        count = ends[np.searchsorted(ends, first, "right")] - first
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(g), dtype=np.uint64)])
        # of the segment's grams in their places: sums of neighbouring grams, so that order tells
        mixed = np.concatenate([[np.uint64(0)], np.cumsum(mix(g[:-1] * np.uint64(3) + g[1:]), dtype=np.uint64)]) if len(g) > 1 else total
        stop = first + count + window - 1 - K
        hashed = mix((total[stop + 1] - total[first]) ^ mix(mixed[stop] - mixed[first]) ^ (count.astype(np.uint64) << np.uint64(32)) ^ (place[first] - first).astype(np.uint64))
        yield g[place[first]].view(np.int64), a + words.doc[first], first - words.bound[words.doc[first]], count, hashed.view(np.int64)


def repeated_minimizers(docs: DataFrame, window: int) -> DataFrame:
    """Minimizers (h) that occur twice or more among all segments of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [s[0] for s in segments(as_bytes(batch.column(0)), window)]
            h, n = np.unique(np.concatenate(got), return_counts=True) if got else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"])

    return map_arrow(docs.select("text"), run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")


def filter_of(keys: DataFrame) -> np.ndarray | None:
    """A Bloom filter of ``keys`` (h): two bits in one 64-bit word for each key. None if it would be over ``FILTER_WORDS``."""
    n = keys.count()
    if n > 4 * FILTER_WORDS:
        return None
    words = min(FILTER_WORDS, 1 << max(10, n.bit_length()))
    bit = lambda by: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("h", by).bitwiseAND(F.lit(63)).cast("int"))
    rows = keys.select(F.shiftrightunsigned("h", 12).bitwiseAND(F.lit(words - 1)).alias("word"), bit(0).bitwiseOR(bit(6)).alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(words, np.int64)
    for word, bits in rows.collect():
        out[word] = bits
    return out


def may_hold(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    u = h.view(np.uint64)
    bits = (np.uint64(1) << (u & np.uint64(63))) | (np.uint64(1) << ((u >> np.uint64(6)) & np.uint64(63)))
    return (bloom.view(np.uint64)[((u >> np.uint64(12)) & np.uint64(len(bloom) - 1)).astype(np.int64)] & bits) == bits


def occurrences(docs: DataFrame, keys: DataFrame, window: int) -> DataFrame:
    """h, seg, row_key, first and count of each segment of ``docs`` (row_key, text) whose minimizer is, or by the filter may be, in ``keys`` (h)."""
    bloom = filter_of(keys)
    sent = None if bloom is None else docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for h, doc, first, count, seg in segments(as_bytes(batch.column(1)), window):
                on = slice(None) if sent is None else np.flatnonzero(may_hold(sent.value, h))
                yield pa.RecordBatch.from_arrays([pa.array(h[on]), pa.array(seg[on]), pa.array(keys[doc[on]]), pa.array(first[on].astype(np.int32)), pa.array(count[on].astype(np.int32))], names=["h", "seg", "row_key", "first", "count"])

    found = map_arrow(docs.select("row_key", "text"), run, "h long, seg long, row_key long, first int, count int")
    # by a shuffle, whatever Spark's threshold is: a broadcast would gather the keys on the driver
    return found.join(keys.hint("shuffle_hash"), "h", "left_semi") if sent is None else found


def segment_words(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(h, seg, c, kinds, words) for the segments ``wanted`` (h, seg, c, kinds, row_key, first, count), cut out of their documents."""
    listed = wanted.groupBy("row_key").agg(F.collect_list(F.struct("h", "seg", "c", "kinds", "first", "count")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, own in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                words = text.split()
                cut = [b" ".join(words[x["first"] : x["first"] + x["count"] + window - 1]) for x in own]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in own], pa.int64()) for k in ("h", "seg", "c", "kinds")] + [pa.array(cut, pa.binary())], names=["h", "seg", "c", "kinds", "words"])

    return map_arrow(docs.join(listed, "row_key").select("text", "own"), run, "h long, seg long, c long, kinds long, words binary").dropDuplicates(["h", "seg"])


def stream_shards(distinct: DataFrame, window: int) -> DataFrame:
    """(h, seg, mask) for the distinct segments (h, seg, c, words): bit i of mask is set if window i of the segment is repeated."""

    def shard(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        automaton, names = SuffixAutomaton(), {}
        sequences = [[names.setdefault(w, len(names)) for w in words.split()] for _, _, _, words in rows]
        for k, ((_, _, c, _), sequence) in enumerate(zip(rows, sequences, strict=True)):
            for w in sequence:
                automaton.add(w, c)
            automaton.add(-1 - k, 0)
        automaton.finish()
        masks = [sum(1 << i for i in automaton.repeated(s, window)) for s in sequences]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(masks, pa.int64())], names=["h", "seg", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, bytes]] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if size > SHARD_WORDS and row[0] != rows[-1][0]:
                    yield shard(rows)
                    rows, size = [], 0
                rows.append(row)
                size += row[3].count(b" ") + 1
        if rows:
            yield shard(rows)

    return map_arrow(distinct.select("h", "seg", "c", "words").repartition("h").sortWithinPartitions("h", "seg"), run, "h long, seg long, mask long")


def count_windows(distinct: DataFrame, window: int) -> DataFrame:
    """The same for segments of hot minimizers: each window is a segment of its own, so its shard is a single path, and its weight the sum over its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, seg, c, out = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), []
            for i, text in enumerate(batch.column(3).to_pylist()):
                g = gram_hashes(Words([text]).hashes(), window)
                out.append((np.full(len(g), i), np.arange(len(g)), g.view(np.int64)))
            i, bit, g = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
            yield pa.RecordBatch.from_arrays([pa.array(h[i]), pa.array(seg[i]), pa.array(c[i]), pa.array(bit.astype(np.int32)), pa.array(g)], names=["h", "seg", "c", "bit", "g"])

    windows = materialize(map_arrow(distinct.select("h", "seg", "c", "words"), run, "h long, seg long, c long, bit int, g long"), "hot-windows")
    twice = windows.groupBy("g").agg(F.sum("c").alias("n")).where("n > 1").select("g")
    return windows.join(twice, "g").groupBy("h", "seg").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("mask"))


def repeated_spans(docs: DataFrame, window: int, hot: int = HOT) -> DataFrame:
    """(row_key, first, mask) for ``docs`` (row_key, text): bit i of mask says that the window which begins at word first + i is repeated."""
    if not 2 * K <= window <= 62 + K:
        raise ValueError(f"window must be {2 * K} to {62 + K} words")
    found = materialize(occurrences(docs, materialize(repeated_minimizers(docs, window), "minimizers"), window), "segments")
    distinct = materialize(found.groupBy("h", "seg").agg(F.count("*").alias("c"), F.min("count").alias("count"), F.min(F.struct("row_key", "first")).alias("at")), "distinct-segments")
    of_h = distinct.groupBy("h").agg(F.sum("c").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    known = materialize(distinct.join(of_h, "h"), "repeated-segments")
    free_shuffles(docs.sparkSession)
    # one kind of segment, twice or more: its automaton is a path of that weight
    alone = known.where("kinds = 1").select("h", "seg", F.when(F.col("count") >= 63, F.lit(-1)).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("count")) - 1).alias("mask"))
    # the words come from one document for each segment, so a segment that many documents share doesn't meet in one task
    texts = materialize(segment_words(docs, known.where("kinds > 1").select("h", "seg", "c", "kinds", "at.row_key", "at.first", "count"), window), "segment-texts")
    free_shuffles(docs.sparkSession)
    masks = stream_shards(texts.where(F.col("kinds") <= hot), window).union(count_windows(texts.where(F.col("kinds") > hot), window)).where("mask <> 0")
    masks = materialize(masks.union(alone), "masks")
    free_shuffles(docs.sparkSession)
    return found.select("h", "seg", "row_key", "first").join(masks, ["h", "seg"]).select("row_key", "first", "mask")


def remove_repeats(docs: DataFrame, window: int = 35, hot: int = HOT) -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and the kept text. Null and empty texts have no words; texts shorter than the window lose none. Equal rows are repeats of each other."""
    rows = docs.select("doc_id", "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    spans = materialize(repeated_spans(rows, window, hot), "spans")
    free_shuffles(docs.sparkSession)
    listed = spans.groupBy("row_key").agg(F.collect_set(F.struct("first", "mask")).alias("spans"))
    joined = rows.join(listed, "row_key", "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digest, kept = [], [], [], []
            for text, own in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = text.split()
                if own:
                    change = np.zeros(len(words) + 1, np.int64)
                    for x in own:
                        mask = x["mask"] & (2**64 - 1)
                        while mask:
                            low = (mask & -mask).bit_length() - 1
                            change[x["first"] + low] += 1
                            change[x["first"] + low + window] -= 1
                            mask &= mask - 1
                    left = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                else:
                    left = words
                whole = b" ".join(left)
                total.append(len(words))
                removed.append(len(words) - len(left))
                digest.append(hashlib.sha256(whole).hexdigest())
                kept.append(whole.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    zero = F.lit(0).cast("long")
    return map_arrow(joined, run, joined.select("doc_id", zero.alias("n_words"), zero.alias("n_removed"), F.lit("").alias("kept_sha256"), F.lit("").alias("kept_text")).schema)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept_text")


OP6_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), starts AS (
  SELECT r, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35
), windows AS (
  SELECT s.r, s.i, md5(array_to_string(w[s.i : s.i + 34], ' ')) AS k FROM starts s JOIN words USING (r)
), repeated AS (
  SELECT r, i FROM windows WHERE k IN (SELECT k FROM windows GROUP BY k HAVING count(*) > 1)
), covered AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM repeated
), gone AS (
  SELECT r, list(i) AS g, count(*) AS n FROM covered GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(g, i)) END, ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (r)
"""

QUERIES = {"op6_substring_dedup": op6_substring_dedup}
SQL = {"op6_substring_dedup": OP6_SQL}
