"""Operator 9, MinHash near-duplicates with an LSH forest.

A document is its set of word shingles. Each tree of the forest sorts the sets by a signature of its own. Sets that agree on
the first values share a region; within it, those with the longest common prefix, so neighbours in the sorted order, are the
candidates of a first round, which cuts large regions deeper. A sketch throws out most chance candidates, and the rest is
confirmed on the full sets. Links join into components. A second round compares all sets of a region that are not in one
component yet, exactly and in bounded blocks, so a link is missed only if its sets share a region in no tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taskspire.llm.common import Words, as_bytes, fits_broadcast, gram_hashes, map_arrow, materialize, mix, pieces
from taskspire.llm.components import components

#: Trees, values that make a region, values that order it, values of the sketch.
TREES, ROOT, DEEP, SKETCH = 16, 4, 8, 16
#: Candidates: so many neighbours that follow in a region's order. Two sketches that agree on fewer values are no candidates.
NEIGHBOURS, LEAST_SKETCH = 4, 6
#: The second round compares the sets of a region in blocks of about so many sets by so many, and of so many shingles on either side.
BLOCK, BLOCK_SHINGLES = 1000, 2_000_000
#: A region of more sets is ordered in parts of about PART sets that follow in its order; the first LINKS of each part are ordered once more together.
REGION, PART, LINKS = 1000, 500, 4
#: Values of the order, after those that make the region, by which a large region is cut.
CUT = 2
_RNG = np.random.default_rng(991)
_K = TREES * (ROOT + DEEP) + SKETCH
_MULTIPLY = _RNG.integers(1, 2**32, _K, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 2**32, _K, dtype=np.uint32)


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of n words, A-Z lowered; of all its words, if it has fewer; empty without words."""
    out: list[np.ndarray] = []
    for a, b in pieces(texts):
        words = Words(texts[a:b], lower=True)
        h = words.hashes()
        grams = gram_hashes(h, n)
        for i in range(b - a):
            first, last = words.bound[i], words.bound[i + 1]
            if last - first >= n:
                out.append(np.unique(grams[first : last - n + 1]))
            elif last > first:
                out.append(gram_hashes(h[first:last], last - first) + np.uint64(last - first))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def set_key_of(shingles: np.ndarray) -> int:
    return int((mix(shingles).sum(dtype=np.uint64) ^ np.uint64(len(shingles))).view(np.int64))


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of a set that isn't empty: each tree's region and order, and the sketch, as 64-bit numbers."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(_K, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 4096):
        least = np.minimum(least, (np.multiply.outer(_MULTIPLY, low[at : at + 4096]) + _ADD[:, None]).min(axis=1))
    values = mix(least.astype(np.uint64))
    trees = values[: TREES * (ROOT + DEEP)].reshape(TREES, ROOT + DEEP)
    pack = lambda v, bits: np.bitwise_or.reduce((v & np.uint64(2**bits - 1)) << (np.arange(v.shape[-1], dtype=np.uint64)[::-1] * np.uint64(bits)), axis=-1)
    return pack(trees[:, :ROOT], 64 // ROOT).view(np.int64), pack(trees[:, ROOT:], 64 // DEEP).view(np.int64), int(pack(values[-SKETCH:], 64 // SKETCH).view(np.int64))


def sign(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets; null for empty ones), regions, orders and sketch of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, regions, orders, sketches = [], [], [], [], []
            for s in shingle_sets(as_bytes(batch.column(1)), n):
                sizes.append(len(s))
                if not len(s):
                    keys.append(None), regions.append(None), orders.append(None), sketches.append(None)
                    continue
                r, o, k = signature(s)
                keys.append(set_key_of(s))
                regions.append(r), orders.append(o), sketches.append(k)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(regions, longs), pa.array(orders, longs), pa.array(sketches, pa.int64())], names=["doc_id", "n_shingles", "set_key", "regions", "orders", "sketch"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n_shingles long, set_key long, regions array<long>, orders array<long>, sketch long")


def _agreeing(a: Column, b: Column) -> Column:
    """How many of two sketches' values (4 bits each) are equal."""
    x = a.bitwiseXOR(b)
    for by in (1, 2):
        x = x.bitwiseOR(F.shiftrightunsigned(x, by))
    return SKETCH - F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def shared_regions(signed: DataFrame) -> DataFrame:
    """A row for each set and tree in whose region other sets are, too, with the region's number of sets."""
    sets = signed.where("set_key is not null").dropDuplicates(["set_key"])
    rows = sets.select("set_key", "sketch", F.posexplode(F.arrays_zip("regions", "orders")).alias("tree", "x")).select("set_key", "sketch", "tree", F.col("x.regions").alias("region"), F.col("x.orders").alias("order"))
    dense = rows.groupBy("tree", "region").agg(F.count("*").alias("n")).where("n > 1")
    shared = rows.join(dense, ["tree", "region"]).withColumn("cell", F.when(F.col("n") > REGION, F.shiftrightunsigned("order", 64 - CUT * 64 // DEEP)))
    # cells agree on CUT more values and follow in the order: parts are runs of them, so that sets with a long common prefix stay together
    cells = shared.where("cell is not null").groupBy("tree", "region", "cell").agg(F.count("*").alias("c"))
    before = Window.partitionBy("tree", "region").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    runs = cells.withColumn("run", F.floor(F.coalesce(F.sum("c").over(before), F.lit(0)) / PART))
    # a cell of more than REGION sets is dealt out; what that separates is left to the second round
    dealt = F.xxhash64("cell", F.pmod(F.xxhash64("set_key", "tree"), F.ceil(F.col("c") / PART)))
    part = F.coalesce(F.when(F.col("c") > REGION, dealt).otherwise(F.col("run")), F.lit(0))
    return materialize(shared.join(runs, ["tree", "region", "cell"], "left").withColumn("part", part).drop("cell", "c", "run"), "forest")


def candidates(shared: DataFrame) -> DataFrame:
    """Distinct pairs a < b of set keys that are neighbours in some tree and whose sketches agree enough."""

    def neighbours(frame: DataFrame, by: list[str]) -> DataFrame:
        order = Window.partitionBy(*by).orderBy("order", "set_key")
        following = F.array(*(F.struct(F.lead("set_key", k).over(order).alias("b"), F.lead("sketch", k).over(order).alias("s")) for k in range(1, NEIGHBOURS + 1)))
        near = frame.withColumn("following", following).select("set_key", "sketch", F.explode("following").alias("y")).select(F.col("set_key").alias("a"), "sketch", "y.*")
        return near.where(F.col("b").isNotNull() & (_agreeing(F.col("sketch"), F.col("s")) >= LEAST_SKETCH)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    in_part = neighbours(shared, ["tree", "region", "part"])
    heads = shared.where(F.col("n") > REGION).withColumn("place", F.row_number().over(Window.partitionBy("tree", "region", "part").orderBy("order", "set_key"))).where(F.col("place") <= LINKS)
    return in_part.union(neighbours(heads, ["tree", "region"])).distinct()


def shingles_of(docs: DataFrame, keys: DataFrame, signed: DataFrame, n: int) -> DataFrame:
    """set_key and the set itself, as the bytes of its sorted 64-bit hashes, for each of ``keys`` (set_key)."""
    texts = texts_of(docs, keys, signed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(as_bytes(batch.column(1)), n)
            own = [i for i, (k, s) in enumerate(zip(batch.column(0).to_pylist(), sets, strict=True)) if k == set_key_of(s)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own, pa.int64())), pa.array([sets[i].tobytes() for i in own], pa.binary())], names=["set_key", "shingles"])

    return map_arrow(texts.select("set_key", "text"), run, "set_key long, shingles binary").dropDuplicates(["set_key"])


def links_of_block(key: np.ndarray, label: np.ndarray, stray: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the strays of a block and all its other sets, as few as join what they join: exact, by size of intersection."""
    order = np.argsort([len(x) for x in sets], kind="stable")
    key, label, stray, sets = key[order], label[order], stray[order], [sets[i] for i in order]
    size = np.array([len(x) for x in sets])
    ids, inverse, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = seen[inverse] > 1  # what only one set has is in no intersection
    owner = np.repeat(np.arange(len(sets)), size)[common]
    token, first = inverse[common], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sets)))])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = root[x]
        return x

    out, mark = [], np.zeros(len(ids) + 1, np.int32)
    for i in np.flatnonzero(stray):
        own = token[first[i] : first[i + 1]]
        # sets of a size that may resemble this one enough
        low, high = np.searchsorted(size, -(-size[i] * percent // 100)), np.searchsorted(size, size[i] * 100 // percent, "right")
        mark[own] = 1
        total = np.concatenate([[0], np.cumsum(mark[token[first[low] : first[high]]])])
        both = np.diff(total[first[low : high + 1] - first[low]])
        mark[own] = 0
        for j in low + np.flatnonzero(100 * both >= percent * (size[i] + size[low:high] - both)):
            x, y = find(int(label[i])), find(int(label[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(min(key[i], key[j])), int(max(key[i], key[j]))))
    return out


def remaining_links(shared: DataFrame, docs: DataFrame, signed: DataFrame, label: DataFrame, n: int, percent: int) -> DataFrame:
    """Links a < b of set keys that share a region of any size but no component of ``label``: as few as join the components.

    The sets outside a region's largest component, its strays, meet all of its sets, so whatever the order kept apart is
    found. Regions in which the first round has compared all pairs are left out. A region is dealt into blocks of bounded
    sets and bytes; a block's task compares its sets as they are and returns links only, never pairs that fail.
    """
    wide = shared.where(F.col("n") > NEIGHBOURS + 1).join(label.withColumnRenamed("node", "set_key"), "set_key", "left")
    sizes = signed.where("set_key is not null").groupBy("set_key").agg(F.min("n_shingles").alias("size"))
    wide = materialize(wide.select("tree", "region", "set_key", F.coalesce("label", "set_key").alias("label")).join(sizes, "set_key"), "wide")
    members = wide.groupBy("tree", "region", "label").agg(F.count("*").alias("c"), F.sum("size").alias("size"))
    mixed = members.groupBy("tree", "region").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("n"), (F.sum("c") - F.max("c")).alias("strays"), F.sum("size").alias("size"), F.max_by("size", F.struct("c", "label")).alias("main_size")).where("strays > 0")
    blocks = lambda sets, size: F.ceil(F.greatest(F.col(sets) / BLOCK, size / BLOCK_SHINGLES)).cast("int")
    mixed = mixed.select("tree", "region", "main", blocks("strays", F.col("size") - F.col("main_size")).alias("across"), blocks("n", F.col("size")).alias("down"))
    rows = materialize(wide.join(mixed, ["tree", "region"]).drop("size"), "strays")
    sets = materialize(shingles_of(docs, rows.select("set_key").distinct(), signed, n), "sets")
    at = lambda salt, most: F.pmod(F.xxhash64("set_key", F.lit(salt)), F.col(most)).cast("int")
    each = lambda most: F.explode(F.sequence(F.lit(0), F.col(most) - 1))
    cell = ["tree", "region", "i", "j"]
    strays = rows.where("label <> main").withColumn("i", at(1, "across")).withColumn("j", each("down")).select(*cell, "set_key", "label", F.lit(1).alias("stray"))
    others = rows.withColumn("j", at(2, "down")).withColumn("i", each("across")).select(*cell, "set_key", "label", F.lit(0).alias("stray"))
    # a stray that is in both parts of a block comes once
    dealt = strays.union(others).groupBy(*cell, "set_key").agg(F.max("label").alias("label"), F.max("stray").alias("stray")).join(sets, "set_key")

    def run(block: pa.Table) -> pa.Table:
        held = [np.frombuffer(x, np.uint64) for x in block.column("shingles").to_pylist()]
        found = links_of_block(*(block.column(c).to_numpy() for c in ("set_key", "label", "stray")), held, percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt.groupBy(*cell).applyInArrow(run, "a long, b long").distinct()


def texts_of(docs: DataFrame, keys: DataFrame, signed: DataFrame) -> DataFrame:
    """set_key, n and text of one document for each of ``keys`` (set_key). Where a doc_id stands in several rows, all their texts come: the caller tells them apart by their sets' keys."""
    owners = signed.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n")).join(keys, "set_key")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(owners) if fits_broadcast(owners, 24) else owners, "doc_id").select("set_key", "n", "text")


def confirm(pairs: DataFrame, docs: DataFrame, signed: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    texts = materialize(texts_of(docs, pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct(), signed), "candidate-texts")
    left, right = texts.select(F.col("set_key").alias("a"), F.col("text").alias("text_a"), F.col("n").alias("n_a")), texts.select(F.col("set_key").alias("b"), F.col("text").alias("text_b"), F.col("n").alias("n_b"))
    # the sets' sizes alone rule some pairs out
    joined = pairs.join(left, "a").join(right, "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys = {}
                for key, text in ((k, t) for c in (0, 1) for k, t in zip(part.column(c).to_pylist(), as_bytes(part.column(c + 2)), strict=True)):
                    keys.setdefault((key, text), None)
                sets = dict(zip(keys, shingle_sets([t for _, t in keys], n), strict=True))
                sides = [list(zip(part.column(c).to_pylist(), as_bytes(part.column(c + 2)), strict=True)) for c in (0, 1)]
                good = []
                for x, y in zip(*sides, strict=True):
                    if set_key_of(sets[x]) != x[0] or set_key_of(sets[y]) != y[0]:
                        good.append(False)
                        continue
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    good.append(100 * both >= percent * (len(sets[x]) + len(sets[y]) - both))
                yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return map_arrow(joined, run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, set_key, n_shingles, component_id and kept for each row of ``docs``.

    Documents with equal sets are one class; links are sought between classes. component_id is the least doc_id reachable.
    Rows without words have 0 shingles and stand alone. A null doc_id sorts after all others and is its own component.
    """
    signed = materialize(sign(docs, n), "signed")
    shared = shared_regions(signed)
    links = materialize(confirm(materialize(candidates(shared), "pairs"), docs, signed, n, percent), "links")
    label = materialize(components(links), "first-components")
    rest = materialize(remaining_links(shared, docs, signed, label, n, percent), "remaining-links")
    # the components are joined as they are, not their links anew
    of = lambda end: label.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
    joined = rest.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    root = materialize(components(joined), "second-components").select(F.col("node").alias("label"), F.col("label").alias("root"))
    label = label.join(root, "label", "full").select(F.coalesce("node", "label").alias("node"), F.coalesce("root", "label").alias("label"))
    classes = signed.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("least"))
    labelled = classes.join(label.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
    # written, so that the join with it is one whose large partitions can be split: a component may hold many classes
    root = materialize(labelled.groupBy("label").agg(F.min("least").alias("component_id")), "roots")
    of_set = labelled.join(root, "label").select("set_key", "component_id")
    # rows without a set get keys of their own, so that they don't meet in one task
    rows = signed.select("doc_id", "n_shingles", "set_key", F.coalesce("set_key", F.xxhash64("doc_id")).alias("key"))
    got = rows.join(of_set.withColumnRenamed("set_key", "key"), "key", "left").withColumn("component_id", F.when(F.col("set_key").isNotNull(), F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")))
    return got.select("doc_id", "set_key", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The filtering stage: of each component the rows with its least doc_id, once each; columns as in ``docs``."""
    found = materialize(near_duplicates(docs, n, percent), "near-duplicates")
    gone = found.where("not kept").select("doc_id").distinct()
    gone = F.broadcast(gone) if fits_broadcast(gone, 16) else gone
    left = docs.join(gone, "doc_id", "left_anti")
    repeated = found.where("kept").groupBy("doc_id").count().where("count > 1")
    return left.dropDuplicates(["doc_id", "text"]) if repeated.limit(1).count() else left


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 2, 80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


#: Exact: all pairs of distinct shingle sets that share a shingle, by set size; components by recursion over links.
OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words
), shingles AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), sizes AS (
  SELECT doc_id, len(s)::BIGINT AS n FROM sets
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, e.y FROM reach r JOIN edges e ON e.x = r.b
), roots AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, s.n AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept FROM sizes s JOIN roots r USING (doc_id)
"""

QUERIES = {"op9_near_dedup": op9_near_dedup}
SQL = {"op9_near_dedup": OP9_SQL}
