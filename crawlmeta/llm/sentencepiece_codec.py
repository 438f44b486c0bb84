"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model file is a protobuf; a small reader takes its pieces with scores and
types, the kind of model, and the normaliser's settings. From these a tokenizers
pipeline is rebuilt: normaliser (character map, extra spaces, the metaspace mark),
a Unigram model over the scores or a BPE model whose merges are ordered by them,
byte fallback, and a decoder.

Where no piece has the metaspace mark after another character, a text falls into
words (a run of marks and what follows it) that are encoded apart from each other.
Each worker encodes a distinct word once, in batches that use as many threads as a
Spark task has cores (``spark.task.cpus``) unless another number is given. ``encode``
checks each such word against the sentencepiece library: same ids, and the decoder
gives the word back. So parity is verified on everything that is encoded, without
encoding every text twice. (Of two unigram paths with one score the libraries may
take different ones: such texts are marked as not verified, as are literal marks at
the ends of a text whose model trims it.) Texts of other models are encoded and
checked whole. ``round_trip`` checks every text whole instead, which holds for its words too:
its ids against those the sentencepiece library gives for the text, and the decoding
of its ids against that library's.

Defined cases: a null or empty text has no ids and decodes to an empty text; null
ids decode to an empty text; a null id column value stays null; repeated rows are
encoded alike; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.byte_bpe import share_model

MARK = "▁"
#: Words that a worker remembers before it starts anew, and words of one call.
REMEMBERED = 1_500_000
PER_CALL = 64
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
# Fixed values of the public model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; fixed-width values stay bytes."""
    at, n = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at:at + size]
        at += size


@dataclass
class PieceModel:
    """What a SentencePiece model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    extra_spaces_go: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
                out.pieces.append((piece[1].decode("utf-8"), struct.unpack("<f", piece[2])[0], piece[3]))
            elif number == 2:
                trainer = dict(_fields(value))
                out.kind, out.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                normal = dict(_fields(value))
                out.charsmap = normal.get(2, b"")
                out.dummy_prefix, out.extra_spaces_go = bool(normal.get(3, 1)), bool(normal.get(4, 1))
        return out

    def by_words(self) -> bool:
        """Whether texts may be cut in front of metaspace marks."""
        return (not self.charsmap and self.dummy_prefix and not self.extra_spaces_go
                and all(MARK not in p.lstrip(MARK) for p, _, _ in self.pieces))

    def tokenizer(self):
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        unknown = next((i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN), 0)
        if self.kind == UNIGRAM:
            # ordinary text must not become these: they lose against every path
            worst = min((s for _, s, t in self.pieces if t == NORMAL), default=0.0) - 1e4
            scored = [(p, s if t in (NORMAL, USER_DEFINED) else worst) for p, s, t in self.pieces]
            model = models.Unigram(scored, unk_id=unknown, byte_fallback=self.byte_fallback)
        elif self.kind == BPE:
            usable = {p: i for i, (p, _, t) in enumerate(self.pieces) if t == NORMAL}
            merges = sorted((-self.pieces[i][1], i, k, p[:k], p[k:]) for p, i in usable.items()
                            for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable)
            model = models.BPE(vocab=vocab, merges=[(a, b) for *_, a, b in merges], fuse_unk=True,
                               unk_token=self.pieces[unknown][0], byte_fallback=self.byte_fallback)
        else:
            raise ValueError(f"model kind {self.kind} is not supported")
        out = Tokenizer(model)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.extra_spaces_go:
            steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        parts = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        out.decoder = decoders.Sequence([*parts, decoders.Strip(" ", 1, 0)] if self.dummy_prefix else parts)
        own = [p for p, _, t in self.pieces if t == USER_DEFINED]
        if own:
            out.add_tokens([AddedToken(p, normalized=True) for p in own])
        return out


class Codec:
    """Encodes and decodes batches; ``known`` maps a word, without its first mark, to its ids."""

    def __init__(self, data: bytes, threads: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        import sentencepiece

        self.threads = threads
        model = PieceModel.parse(data)
        self.tokenizer = model.tokenizer()
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.words = model.by_words()
        self.opens = np.array([p.startswith(MARK) for p, _, _ in model.pieces])
        self.known: dict[str, bytes] = {}
        self.checked: set[str] = set()
        self.doubtful: set[str] = set()  # words that the reference encodes or decodes otherwise
        if self.words:
            self.known[""] = self.whole(["a "])[0][len(self.whole(["a"])[0]):].tobytes()

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4") if t else np.zeros(0, "<u4") for e, t in zip(made, texts)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def agrees(self, texts: list[str], ids: list[bytes]) -> tuple[list[bool], list[str], list[bool]]:
        """Whether the reference has the same ids of each text; the decoded texts; whether it decodes alike."""
        wanted = self.reference.encode(texts, out_type="numpy", num_threads=self.threads)
        same = [x == y.astype("<u4", copy=False).tobytes() for x, y in zip(ids, wanted)]
        lists = [np.frombuffer(x, "<u4").tolist() for x in ids]
        back = self.decode(lists)
        again = self.reference.decode(lists, num_threads=self.threads)
        return same, back, [x == y for x, y in zip(back, again)]

    def _verified(self, texts: list[str], ids: list[np.ndarray]) -> list[tuple[bytes, bool]]:
        if not texts:
            return []
        made = [x.tobytes() for x in ids]
        same, _, back = self.agrees(texts, made)
        return [(x, a and b) for x, a, b in zip(made, same, back)]

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if MARK not in w]
        marked = [w for w in words if MARK in w]  # a run of marks may be several pieces
        self.known.update(zip(marked, [x.tobytes() for x in self.whole(marked)]))
        groups = [plain[i:i + PER_CALL] for i in range(0, len(plain), PER_CALL)]
        for group, together in zip(groups, self.whole([" ".join(g) for g in groups])):
            first = np.flatnonzero(self.opens[together])
            if len(first) == len(group) and first[0] == 0:
                data, at = together.tobytes(), (first * 4).tolist()
                self.known.update(zip(group, [data[a:b] for a, b in zip(at, [*at[1:], len(data)])]))
            else:
                self.known.update(zip(group, [x.tobytes() for x in self.whole(group)]))

    def _check(self, words: set[str]) -> None:
        new = list(words - self.checked)
        ok = self._verified(new, [np.frombuffer(self.known[w], "<u4") for w in new])
        self.checked.update(new)
        self.doubtful.update(w for w, (_, good) in zip(new, ok) if not good)

    def _cut(self, text: str) -> list[str]:
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit bytes."""
        if not self.words:
            return [x.tobytes() for x in self.whole(texts)]
        if len(self.known) > REMEMBERED:
            self.known, self.checked = {"": self.known[""]}, set()
        look, join, out, late = self.known.__getitem__, b"".join, [], []
        for i, t in enumerate(texts):
            cut = self._cut(t) if t else []
            try:
                out.append(join(map(look, cut)))
            except KeyError:
                out.append(b"")
                late.append((i, cut))
        if late:
            self._learn(list(set().union(*(cut for _, cut in late)).difference(self.known)))
            for i, cut in late:
                out[i] = join(map(look, cut))
        return out

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bool]]:
        """Ids as little-endian unsigned 32-bit bytes, and whether all of them were verified."""
        texts = [t or "" for t in texts]
        if not self.words:
            return self._verified(texts, self.whole(texts))
        made = self.ids(texts)
        cuts = [self._cut(t) if t else [] for t in texts]
        # The word of a last space exists only behind another one: its ids are checked with the texts they end.
        self._check(set().union(*cuts) - {""})
        return [(x, self.doubtful.isdisjoint(cut) and ("" not in cut or self._verified([t], [np.frombuffer(x, "<u4")])[0][1]))
                for t, x, cut in zip(texts, made, cuts)]


_codecs: dict[tuple[int, int], Codec] = {}


def codec(model: Broadcast, threads: int) -> Codec:
    """One codec per worker process and model."""
    key = hash(model.value), threads
    if key not in _codecs:
        _codecs[key] = Codec(model.value, threads)
    return _codecs[key]


def task_threads(df: DataFrame) -> int:
    """The cores that one task has: more threads than that would wait for other tasks' cores."""
    return int(df.sparkSession.sparkContext.getConf().get("spark.task.cpus", "1"))


def encode(docs: DataFrame, model_path: str, threads: int | None = None, with_ids: bool = True, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (unless left out), n_tokens, ids_crc32, parity."""
    model, threads = share_model(docs.sparkSession, model_path), threads or task_threads(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model, threads)
        for pdf in batches:
            for a in range(0, len(pdf), 512):
                part = pdf.iloc[a:a + 512]
                made = own.encode(part.text.tolist())
                out = pd.DataFrame({"doc_id": part.doc_id.to_numpy(), "n_tokens": [len(x) // 4 for x, _ in made],
                                    "ids_crc32": [zlib.crc32(x) for x, _ in made], "parity": [ok for _, ok in made]})
                if with_ids:
                    out.insert(1, "ids", [np.frombuffer(x, "<u4").astype(np.int32) for x, _ in made])
                yield out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = "ids array<int>, " if with_ids else ""
    return rows.mapInPandas(run, f"doc_id long, {ids}n_tokens long, ids_crc32 long, parity boolean")


def round_trip(docs: DataFrame, model_path: str, threads: int | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_crc32, parity (the whole text's ids),
    decoded_sha256 of the text that the ids decode to, decoded_parity (the reference's decoding is equal)."""
    model, threads = share_model(docs.sparkSession, model_path), threads or task_threads(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model, threads)
        for pdf in batches:
            for a in range(0, len(pdf), 512):
                part = pdf.iloc[a:a + 512]
                texts = [t or "" for t in part.text]
                made = own.ids(texts)
                same, back, back_same = own.agrees(texts, made)
                yield pd.DataFrame({
                    "doc_id": part.doc_id.to_numpy(), "n_tokens": [len(x) // 4 for x in made],
                    "ids_crc32": [zlib.crc32(x) for x in made], "parity": same,
                    "decoded_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back],
                    "decoded_parity": back_same})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids_crc32 long, parity boolean, "
                                 "decoded_sha256 string, decoded_parity boolean")


def decode(encoded: DataFrame, model_path: str, threads: int | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids)."""
    model, threads = share_model(encoded.sparkSession, model_path), threads or task_threads(encoded)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(model, threads)
        for pdf in batches:
            for a in range(0, len(pdf), 512):
                part = pdf.iloc[a:a + 512]
                texts = own.decode([[] if x is None else [int(y) for y in x] for x in part.ids])
                yield pd.DataFrame({"doc_id": part.doc_id.to_numpy(), "text": texts})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")
