"""Helpers shared by the operators: tables, shared folders, hashing of words in numpy.

Hashing works on the UTF-8 bytes of a batch of texts at once: every word gets
a 64-bit hash from prefix sums of a polynomial, so no Python loop runs per word.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlmeta.session import checkpoint_dir, ship_package

#: Bytes of text that one numpy pass holds; a longer text is a pass of its own.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder. It goes when the
    driver's JVM ends: results that Spark reads from it are lazy."""
    ship_package(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return path


def unused(taken: list[str], *names: str) -> list[str]:
    """Names like ``names`` that no column of ``taken`` has, whatever its case."""
    held, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_train(id_col: str = "doc_id") -> Column:
    """Rows labels may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def held_out(id_col: str = "doc_id") -> Column:
    """A row without an id counts as held out: nothing is learnt from it."""
    return ~is_train(id_col)


# Fixed values of the hash family.
_SEED = 0x5EED
_RNG = np.random.default_rng(_SEED)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 2**64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R^i and R^-i modulo 2^64 for i < n."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for r in (_R, _R_INV):
            x = np.full(n, r, np.uint64)
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
        _powers = made[0], made[1]
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have ``limit`` bytes together; at least one row each."""
    a = size = 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > limit:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


class Words:
    """Words of a block of texts: ``hash`` and ``doc`` per word, ``first`` per
    text (index of its first word, one more at the end), ``start`` and ``end`` in ``raw``."""

    def __init__(self, texts: list[bytes], lower: bool = True, space: np.ndarray = _SPACE):
        raw = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
        if lower:
            raw = _LOWER[raw]
        gap = space[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        self.raw, self.start, self.end = raw, edge[0::2], edge[1::2]
        forth, back = _power(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * forth[: len(raw)], out=sums[1:])
        self.hash = mix64((sums[self.end] - sums[self.start]) * back[self.start])
        self._sums, self._back = sums, back
        size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(size)]) + 1
        self.first = np.searchsorted(self.start, self.text_start)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of any byte ranges of ``raw``."""
        return mix64((self._sums[end] - self._sums[start]) * self._back[start])


def to_bytes(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def map_rows(df: DataFrame, make: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``make`` per Arrow batch; it must not depend on how rows are batched."""
    ship_package(df.sparkSession)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield make(pdf)

    return df.mapInPandas(run, schema)


def local_path(uri: str) -> tuple[object, str]:
    """pyarrow file system and path for a folder URI (a plain path is local)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))
