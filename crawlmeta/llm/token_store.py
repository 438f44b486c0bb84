"""Token ids in binary shards with a minimal perfect hash index for keyed access.

A shard holds the ids of a range of keys in ascending order:

- ``shard-<n>-<attempt>.ids``: the raw ids, little-endian, two bytes each when
  the vocabulary has at most 65,536 ids, else four.
- ``shard-<n>-<attempt>.idx``: arrays in NumPy's public ``.npy`` format, one
  after the other: header (id width, records, records without key, levels), bit
  sizes of the levels, their bits, 32-bit fingerprints by hash slot, record
  number by slot, record offsets, record keys.

The index is minimal and perfect: level by level, keys that fall alone on a bit
keep it, the others go on to the next level; a key's slot is the rank of its
bit. A lookup takes a few hash evaluations and compares the stored fingerprint.

``write_store`` is a Spark job: rows are range-partitioned by key, sorted, and
each task encodes its rows and writes one shard to the shared folder. A task
attempt has file names of its own; only files that its committed manifest row
names are ever read, so a lost executor or a second attempt leaves no trace in
the results. The manifest has one row per shard.

Defined cases: null or empty text is the end id alone; null keys come first and
have no index entry; repeated keys are stored once per row, ordered by the
text's hash (in several shards if they are many), and a lookup returns all of them; an empty table is a store without
shards; further columns are not read.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlmeta.llm.byte_bpe import coder, portions, share_model
from crawlmeta.llm.common import local_path, mix64

MANIFEST = "shard int, rows long, ids long, min_key long, max_key long, file string"
#: Bits per key on each level of the index.
GAMMA = 2
_LEVELS = 64
_READ_IDS = 1 << 20


def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(keys.view(np.uint64) + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes = sizes
        self.bits = np.unpackbits(bits, bitorder="little")[:int(sizes.sum())].astype(bool)
        self.rank = np.concatenate([[0], np.cumsum(self.bits)])
        self.base = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            if len(sizes) == _LEVELS:
                raise ValueError("keys are not distinct")
            m = max(8, GAMMA * len(left))
            at = (_level_hash(left, len(sizes)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            sizes.append(m)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.packbits(np.concatenate([np.zeros(0, bool), *levels]), bitorder="little")
        return cls(np.array(sizes, np.int64), bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for keys that surely are not in the set."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, m in enumerate(self.sizes):
            at = (_level_hash(keys[todo], level) % np.uint64(m)).astype(np.int64) + self.base[level]
            hit = self.bits[at]
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
        return out

    def packed(self) -> np.ndarray:
        return np.packbits(self.bits, bitorder="little")


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_level_hash(keys, _LEVELS) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray, n_null: int, offsets: np.ndarray, width: int) -> bytes:
    """``keys`` of the records in order (null ones first, as 0); offsets in ids, one more than records."""
    known, first = np.unique(keys[n_null:], return_index=True)
    perfect = PerfectHash.build(known)
    slot = perfect.slots(known)
    prints, record = np.zeros(len(known), np.uint32), np.zeros(len(known), np.int64)
    prints[slot], record[slot] = fingerprint(known), first + n_null
    out = io.BytesIO()
    for a in (np.array([width, len(keys), n_null, len(perfect.sizes)], np.int64), perfect.sizes,
              perfect.packed(), prints, record, offsets, keys):
        np.lib.format.write_array(out, a, allow_pickle=False)
    return out.getvalue()


class Shard:
    """Keyed access to one shard's files."""

    def __init__(self, path: str):
        self.fs, self.file = local_path(path)
        with self.fs.open_input_stream(self.file + ".idx") as f:
            data = io.BytesIO(f.read())
        read = [np.lib.format.read_array(data, allow_pickle=False) for _ in range(7)]
        (self.width, self.n, self.n_null, _), sizes, bits, self.prints, self.record, self.offsets, self.keys = read
        self.perfect = PerfectHash(sizes, bits)
        self.ids = self.fs.open_input_file(self.file + ".ids")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First record of each key, or -1."""
        slot = self.perfect.slots(keys)
        at = np.maximum(slot, 0)
        if not len(self.prints):
            return np.full(len(keys), -1, np.int64)
        return np.where((slot >= 0) & (self.prints[at] == fingerprint(keys)), self.record[at], -1)

    def read(self, a: int, b: int) -> np.ndarray:
        """Ids of the records a to b (exclusive)."""
        lo, hi = int(self.offsets[a]), int(self.offsets[b])
        data = self.ids.read_at((hi - lo) * int(self.width), lo * int(self.width))
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")

    def span(self, lo: int, hi: int) -> bytes:
        """The ids lo to hi (exclusive) of the shard, as little-endian 32-bit integers."""
        data = self.ids.read_at((hi - lo) * int(self.width), lo * int(self.width))
        return np.frombuffer(data, f"<u{self.width}").astype("<u4").tobytes()

    def close(self) -> None:
        self.ids.close()


def write_store(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2,
                id_col: str = "doc_id", text_col: str = "text", vocabulary: int = 50_257) -> DataFrame:
    """Write all rows; returns the manifest, read back from the folder."""
    spark = docs.sparkSession
    model = share_model(spark, tokenizer_path)
    width = 2 if max(vocabulary, end_id + 1) <= 65_536 else 4
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = coder(model).encode
        shard = TaskContext.get().partitionId()
        name = f"{folder.rstrip('/')}/shard-{shard:06d}-{uuid.uuid4().hex}"
        fs, path = local_path(name)
        ids = None
        keys, sizes, n_null = [], [], 0
        for pdf in batches:
            if ids is None and len(pdf):
                ids = fs.open_output_stream(path + ".ids")
            texts = pdf.t.tolist()
            n_null += int(pdf.k.isna().sum())
            keys.append(pdf.k.fillna(0).astype(np.int64).to_numpy())
            del pdf
            for a, b in portions(texts):
                made = [data + end for data in encode(texts[a:b])]
                sizes += [len(data) // 4 for data in made]
                ids.write(np.frombuffer(b"".join(made), "<u4").astype(f"<u{width}").tobytes())
        if ids is None:
            return
        ids.close()
        key = np.concatenate(keys)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        with fs.open_output_stream(path + ".idx") as f:
            f.write(index_bytes(key, n_null, offsets, width))
        real = key[n_null:]
        bounds = (int(real[0]), int(real[-1])) if len(real) else (None, None)
        yield pd.DataFrame([(shard, len(key), int(offsets[-1]), *bounds, name)],
                           columns=["shard", "rows", "ids", "min_key", "max_key", "file"]).astype(
            {"min_key": "Int64", "max_key": "Int64"})

    # A number of its own for every row: rows that repeat id and text can lie in several shards.
    rows = docs.selectExpr(f"`{id_col}` AS k", f"`{text_col}` AS t").withColumns(
        {"h": F.xxhash64("t"), "row": F.monotonically_increasing_id()})
    parts = rows.repartitionByRange("k", "h", "row").sortWithinPartitions("k", "h", "row").drop("row")
    parts.mapInPandas(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return open_store(spark, folder)


def open_store(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with ``first_id``, the ids in all shards before (one row per shard)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
            .withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long"))))


def read_store(manifest: DataFrame, tasks: int | None = None, part_ids: int = _READ_IDS) -> DataFrame:
    """All records, one task per shard: each key's slot, fingerprint and offset lead to its ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                s = Shard(row.file)
                a = 0
                while a < s.n:
                    b = max(a + 1, int(np.searchsorted(s.offsets, s.offsets[a] + part_ids, "right")) - 1)
                    keys = s.keys[a:b]
                    null = np.arange(a, b) < s.n_null
                    # slot -> fingerprint -> first record of the key; the rows that repeat it follow there
                    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | null[:-1]])
                    which = np.cumsum(new) - 1
                    begin = np.flatnonzero(new)
                    seen = np.searchsorted(s.keys[s.n_null:a], keys[0]) if a > s.n_null else 0
                    before = np.where(which == 0, max(0, a - s.n_null - int(seen)), 0)  # rows of the key in the part before
                    at = np.where(null, np.arange(a, b), s.find(keys[begin])[which] + np.arange(b - a) - begin[which] + before)
                    if (at < 0).any() or (at >= s.n).any():
                        raise ValueError(f"the index of {row.file} does not fit its keys")
                    lo, hi = s.offsets[at], s.offsets[at + 1]
                    low = int(lo.min())
                    view = memoryview(s.span(low, int(hi.max())))
                    yield pd.DataFrame({
                        "doc_id": pd.arrays.IntegerArray(keys.copy(), null), "shard": row.shard,
                        "start": lo + row.first_id, "n_tokens": hi - lo,
                        "ids_crc32": [zlib.crc32(view[4 * (x - low):4 * (y - low)]) for x, y in zip(lo.tolist(), hi.tolist())]})
                    a = b
                s.close()

    return manifest.repartition(tasks or max(1, manifest.count())).mapInPandas(run, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """Records of the given keys, ids included: doc_id, ids. Keys that are not stored give no row."""
    shards = [(r.shard, r.min_key, r.max_key, r.file) for r in manifest.collect() if r.min_key is not None]
    shards.sort()
    low, high = np.array([s[1] for s in shards], np.int64), np.array([s[2] for s in shards], np.int64)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            k = pdf.k.to_numpy(np.int64)
            a, b = np.searchsorted(high, k, "left"), np.searchsorted(low, k, "right")
            n = np.maximum(b - a, 0)
            yield pd.DataFrame({"k": np.repeat(k, n), "s": np.concatenate(
                [np.zeros(0, np.int64), *(np.arange(x, y) for x, y in zip(a, b) if y > x)])})

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, at = None, -1
        for pdf in batches:
            for s, part in pdf.groupby("s", sort=True):
                if s != at:
                    if opened:
                        opened.close()
                    opened, at = Shard(shards[s][3]), s
                out = []
                for k, r in zip(part.k.tolist(), opened.find(part.k.to_numpy(np.int64)).tolist()):
                    while 0 <= r < opened.n and opened.keys[r] == k:
                        out.append((k, opened.read(r, r + 1).astype(np.int64)))
                        r += 1
                if out:
                    yield pd.DataFrame(out, columns=["doc_id", "ids"])
        if opened:
            opened.close()

    wanted = keys.select(F.col(key_col).cast("long").alias("k")).where("k IS NOT NULL").distinct()
    return (wanted.mapInPandas(route, "k long, s long").repartition("s", F.expr("k % 8"))
            .sortWithinPartitions("s", "k").mapInPandas(fetch, "doc_id long, ids array<long>"))
