"""Shared pieces of the training-data operators: materialised stages in the shared folder, size checks, byte-level tokenising."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table is sent to every executor only if its measured size stays under this many bytes.
BROADCAST_LIMIT_BYTES = 64 * 2**20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; one of our own only where it is unset (local tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    at = tempfile.mkdtemp(prefix="stages-")
    spark.conf.set("spark.checkpoint.dir", at)
    return at


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` as Parquet in the shared folder and reads it back. A lost executor then costs a re-read, not a re-run."""
    at = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of stages that are materialised: it does so only when the driver collects its garbage, which may be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of an Arrow batch: texts are long, and a worker holds a batch, its decoded texts and its result at once.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 2**20)}


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` in small batches. Spark reads the size when the plan runs, so it stays set for the session."""
    for k, v in BATCH.items():
        df.sparkSession.conf.set(k, v)
    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one made from it that ``df`` has no column of."""
    while name in df.columns:
        name = f"_{name}"
    return name


def fits_broadcast(df: DataFrame, bytes_a_row: int, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Counts the rows of ``df`` and tells whether they stay under ``limit``."""
    return df.count() * bytes_a_row <= limit


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row's identity: equal rows share it."""
    return F.xxhash64(*columns)


# ---------------------------------------------------------------- byte-level tokenising

#: ASCII white space, the separators of words.
SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
#: Separators of plain words: all of ASCII but letters and digits.
_IS_MARK = np.ones(256, bool)
_IS_MARK[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
#: Odd bases of the rolling hashes over bytes and over words.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i < n."""
    got = _POWERS.get(base)
    if got is None or len(got[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        got = _POWERS[base] = tuple(out)
    return got[0][:n], got[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of several texts at once (plain: runs of letters and digits, without case). Word i has the bytes start[i]:end[i] of data and belongs to text doc[i]."""

    def __init__(self, texts: list[bytes], lower: bool = False, plain: bool = False):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower or plain:
            self.data = _LOWER[self.data]
        if plain:  # the capitals of Latin-1, in UTF-8
            capital = np.flatnonzero((self.data[1:] >= 0x80) & (self.data[1:] <= 0x9E) & (self.data[1:] != 0x97) & (self.data[:-1] == 0xC3)) + 1
            self.data[capital] += 0x20
        space = (_IS_MARK if plain else _IS_SPACE)[self.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])  # of each text, in bytes
        self.bound = np.searchsorted(self.start, self.first)  # of each text, in words
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.bound))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        up, down = powers(BYTE_BASE, len(self.data))
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up, out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words; there are len(h) - n + 1."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    up, down = powers(WORD_BASE, len(h))
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up, out=total[1:])
    return mix((total[n:] - total[:-n]) * down[: len(h) - n + 1])


def pieces(texts: list[bytes], most: int = 500_000):
    """Slices of ``texts`` of about ``most`` bytes each (a longer text stands alone and whole), as (from, to)."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def as_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null gives b''."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
