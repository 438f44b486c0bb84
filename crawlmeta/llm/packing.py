"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bounded-space online best fit: each task reads its rows once and holds a fixed
number of open bins, indexed by a bitset over their free space. A piece goes to
the bin it fills best, which is the lowest set bit at or above its length. If
none has room and all bins are open, the fullest bin closes. When the rows end,
the pieces still in open bins (a bounded number) are laid out again, longest
first. There is no shuffle: bins never span tasks, and a task loses at most the
room left in its open bins.

Defined cases: a null or empty text is the end id alone; a null id stays null
and is packed like any other row; repeated rows are packed once each; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from crawlmeta.llm.byte_bpe import coder, portions, share_model

SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "sequence_id long, offset long")
#: Bins that a task holds open.
OPEN_BINS = 2048


class BestFit:
    """Packs (length, item) pairs into bins of ``size``; yields closed bins as lists of pairs."""

    def __init__(self, size: int, open_bins: int = OPEN_BINS):
        self.size, self.open_bins = size, open_bins
        self.by_room: list[list[list]] = [[] for _ in range(size + 1)]
        self.rooms = 0  # bit r is set when an open bin has r free
        self.n_open = 0

    def _take(self, room: int) -> list:
        found = self.by_room[room].pop()
        if not self.by_room[room]:
            self.rooms ^= 1 << room
        self.n_open -= 1
        return found

    def _put(self, room: int, content: list) -> None:
        self.by_room[room].append(content)
        self.rooms |= 1 << room
        self.n_open += 1

    @staticmethod
    def _lowest(bits: int) -> int:
        return (bits & -bits).bit_length() - 1

    def add(self, length: int, item: object) -> Iterator[list]:
        fits = self.rooms >> length
        if fits:
            room = self._lowest(fits) + length
            content = self._take(room)
        else:
            if self.n_open >= self.open_bins:
                yield self._take(self._lowest(self.rooms))
            room, content = self.size, []
        content.append((length, item))
        if room == length:
            yield content
        else:
            self._put(room - length, content)

    def finish(self) -> Iterator[list]:
        """Lay out what is still open again, longest first, and close it."""
        left = sorted((pair for bins in self.by_room for b in bins for pair in b),
                      key=lambda p: -p[0])
        again = BestFit(self.size, len(left) + 1)
        for length, item in left:
            yield from again.add(length, item)
        for bins in again.by_room:
            yield from bins
        self.by_room, self.rooms, self.n_open = [[] for _ in range(self.size + 1)], 0, 0


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than ``size``."""
    first = n - (n - 1) // size * size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0,
         open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document with its sequence and its place there."""
    model = share_model(docs.sparkSession, tokenizer_path)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = coder(model).encode
        bins, made = BestFit(size, open_bins), []
        sequence = TaskContext.get().partitionId() << 40

        def place(closed: Iterator[list]) -> None:
            nonlocal sequence
            for content in closed:
                offset = 0
                for length, item in content:
                    made.append((*item, sequence, offset))
                    offset += length
                sequence += 1

        def out() -> pd.DataFrame:
            frame = pd.DataFrame(made, columns=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
            made.clear()
            return frame.astype({"doc_id": "Int64"})

        for pdf in batches:
            texts, ids = pdf.text.tolist(), pdf.doc_id.astype("Int64").tolist()
            for a, b in portions(texts):
                for doc, data in zip(ids[a:b], encode(texts[a:b])):
                    data += end
                    for k, (s, n) in enumerate(cut(len(data) // 4, size)):
                        crc = zlib.crc32(memoryview(data)[4 * s:4 * (s + n)])
                        place(bins.add(n, (doc, k, s, n, crc)))
            if made:
                yield out()
        place(bins.finish())
        if made:
            yield out()

    rows = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    return rows.mapInPandas(run, SCHEMA)
