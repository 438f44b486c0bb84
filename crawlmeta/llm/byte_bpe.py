"""Ids of a byte-level BPE vocabulary, by the tokenizers library.

Such a vocabulary splits a text into pieces before it merges bytes, and a
space in front of a non-space always opens a new piece, whatever comes before it. So the
text is cut at these spaces, every distinct cut is encoded once per worker, and
the ids are joined. Most texts have no other spaces: they are cut at every space and
looked up at once; a cut that is not known sends its text to the exact cutting,
which learns what is missing.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

from crawlmeta.session import ship_package

#: Distinct pieces, and characters of them, that a worker remembers before it starts anew (some 200 MB;
#: with twice as many, two workers and their executor came to over 3,000 MB).
REMEMBERED, HELD_CHARS = 800_000, 1 << 25
#: Texts, and characters of them, of one call.
PORTION, PORTION_CHARS = 1024, 1 << 21
_ALONE = re.compile(r"\s")
_CUT = re.compile(r" (?=\S)")
_NO_CUT = re.compile(r" (?:\s|\Z)")
#: Beginnings of texts that are remembered are at most so long.
_SHORT = 64
_PER_CALL = 64
_SPACE = "\u0120"  # how such vocabularies write the byte of a space
_coders: dict[int, Coder] = {}


class Coder:
    """Texts to ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(model)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(_SPACE)]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}   # pieces that follow a cut; each begins with a non-space
        self.begins: dict[str, bytes] = {}  # pieces that begin a text
        self.held = 0

    def _ids(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in made]

    def _learn(self, pieces: list[str]) -> None:
        """Ids of each piece after a space. Pieces without white space share calls: the
        space in front of each is the first byte of its first id, and no other id has one."""
        self.held += sum(map(len, pieces))
        alone = [p for p in pieces if _ALONE.search(p)]
        self.known.update(zip(alone, self._ids([" " + p for p in alone])))
        plain = list(set(pieces).difference(alone)) if alone else pieces
        groups = [plain[i:i + _PER_CALL] for i in range(0, len(plain), _PER_CALL)]
        made = self.tokenizer.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, made):
            ids = np.asarray(e.ids, "<u4")
            at = (np.flatnonzero(self.opens[ids]) * 4).tolist()
            if len(at) == len(group) and at[0] == 0:
                data = ids.tobytes()
                self.known.update(zip(group, map(data.__getitem__, map(slice, at, [*at[1:], len(data)]))))
            else:  # a vocabulary that treats spaces otherwise
                self.known.update(zip(group, self._ids([" " + p for p in group])))

    def _begun(self, firsts: list[str]) -> list[bytes]:
        new = list({f for f in firsts if len(f) <= _SHORT}.difference(self.begins))
        self.begins.update(zip(new, self._ids(new)))
        long = iter(self._ids([f for f in firsts if len(f) > _SHORT]))
        return [self.begins[f] if len(f) <= _SHORT else next(long) for f in firsts]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) + len(self.begins) > REMEMBERED or self.held > HELD_CHARS:
            self.forget()
        look, join = self.known.__getitem__, b"".join
        firsts, rests, late = [], [], []
        for i, t in enumerate(texts):
            first, *cut = (t or "").split(" ")
            try:
                rest = join(map(look, cut))
            except KeyError:  # a new piece, or a space that is no cut
                if _NO_CUT.search(t):
                    first, *cut = _CUT.split(t)
                rest = b""
                late.append((i, cut))
            firsts.append(first)
            rests.append(rest)
        if late:
            wanted = set().union(*(cut for _, cut in late))
            self._learn(list(wanted.difference(self.known)))
            for i, cut in late:
                rests[i] = join(map(look, cut))
        return [f + r for f, r in zip(self._begun(firsts), rests)]


def portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts for one call each; a longer text is one of its own."""
    a = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > a and (i - a == PORTION or size + n > PORTION_CHARS):
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


def coder(model: Broadcast) -> Coder:
    """One coder per worker process and model."""
    key = hash(model.value)
    if key not in _coders:
        _coders[key] = Coder(model.value)
    return _coders[key]


def share_model(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file (a few MB, fixed) for all executors."""
    ship_package(spark)
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())
