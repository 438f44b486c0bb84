"""Repeated passages of lines, found by winnowing and deleted after their first place.

A text's lines (trimmed, blank ones left out) become 64-bit hashes. A window is
the shortest run of lines from a line on that has WINDOW_WORDS words. The line
with the least hash in a window is an anchor (winnowing), and the hash of the
window that starts at an anchor is a fingerprint. Two texts that share a run of
at least twice WINDOW_WORDS words share a fingerprint, that is guaranteed: the
run's first window gives both the same anchor, and the anchor's window ends
inside the run.

Places with one fingerprint are a group. An aggregate keeps the group's first place
(doc_id, line), combined map-side, and every other place is compared with that first
one only, so a passage in many texts gives as many rows, not pairs. The match is
extended both ways over the two line sequences, and the run is deleted from the later
place. Another earlier text may share more than the first. Ahead, places that leave the
first one after the same number of lines, with the same next line, form a new group,
whose own first place the others are compared with in the next round; any two places
that share more lines than they share with the first are in one such group, so rounds
go on until no group has two places. Back, only what lies less than a window before an anchor matters,
since a run that begins earlier has an anchor nearer to its beginning: the groups
of places that share one line more, two lines more, ... are named at once, and one
aggregate finds the longest that has an earlier place. Then no run of twice
WINDOW_WORDS words that an earlier text holds is left. Line sequences travel as hashes, texts only to be
rewritten. Runs are runs of whole lines: a passage inside differing lines is not found.

Defined cases: a null or empty text has no lines and stays as it is; texts of
fewer than WINDOW_WORDS words have no window and stay; a run that repeats within
its own text is deleted there too; rows that repeat an id and text are one text
and lose the same lines; a row without id stays as it is; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.common import Words, blocks, map_rows, shared_folder, to_bytes, written

#: Words of a window; runs of twice as many that repeat are always found.
WINDOW_WORDS = 25
LINES = "doc_id long, h long, hashes array<long>, words array<int>"
PLACES = "doc_id long, h long, line long, g long, back array<long>"


def line_table(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash and number of words of each non-blank line of each text."""
    for a, b in blocks(texts):
        w = Words(texts[a:b], lower=False)
        line = np.cumsum(w.raw == 10)
        name = line[w.start] if len(w.start) else np.zeros(0, np.int64)
        for i in range(b - a):
            p, q = int(w.first[i]), int(w.first[i + 1])
            first = p + np.flatnonzero(np.diff(name[p:q], prepend=-1))
            last = np.append(first[1:], q)[: len(first)] - 1
            yield (w.span_hash(w.start[first], w.end[last]).view(np.int64) if q > p else np.zeros(0, np.int64),
                   (last - first + 1).astype(np.int32))


def fingerprints(hashes: np.ndarray, words: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(line, hash of the window from there) of each anchor."""
    total = np.concatenate([[0], np.cumsum(words)])
    end = np.searchsorted(total, total[:-1] + least, "left").tolist()
    order, n, anchors = hashes.tolist(), len(hashes), set()
    for a, b in enumerate(end):
        if b > n:
            break
        anchors.add(min(range(a, b), key=order.__getitem__))
    return [(p, hash(tuple(order[p:end[p]]))) for p in sorted(anchors) if end[p] <= n]


def extend(late: np.ndarray, j: int, early: np.ndarray, i: int) -> tuple[int, int]:
    """The run around line j of ``late`` that equals the one around line i of ``early``."""
    n = min(len(late) - j, len(early) - i)
    ahead = late[j:j + n] != early[i:i + n]
    after = int(ahead.argmax()) if ahead.any() else n
    m = min(j, i)
    behind = (late[j - m:j] != early[i - m:i])[::-1]
    before = int(behind.argmax()) if behind.any() else m
    return j - before, j + after


def _begun(lines: DataFrame, least: int) -> DataFrame:
    """Every fingerprint's place: doc_id, h, line, the group ``g`` of the places that share it, and in ``back``
    the names of the groups that also share one line, two lines, ... before it, for less than a window."""
    def places(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc, h, hashes, words in zip(pdf.doc_id, pdf.h, pdf.hashes, pdf.words):
            hashes, words = np.asarray(hashes, np.int64), np.asarray(words)
            for line, f in fingerprints(hashes, words, least):
                back, name, total = [], f, 0
                for k in range(line - 1, -1, -1):
                    total += int(words[k])
                    if total >= least:
                        break
                    name = hash((name, int(hashes[k])))
                    back.append(name)
                out.append((doc, h, line, f, back))
        return pd.DataFrame(out, columns=["doc_id", "h", "line", "g", "back"])

    return map_rows(lines, places, PLACES)


def _first_places(state: DataFrame) -> DataFrame:
    """g and its first place, for groups of several places."""
    return (state.groupBy("g").agg(F.min(F.struct("doc_id", "h", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("g", "first"))


def _runs_before(state: DataFrame) -> DataFrame:
    """The lines before a place that an earlier place has too. A run that begins further back than a window
    has an anchor nearer to its beginning, so all lengths are known beforehand and one aggregate finds the longest."""
    several = state.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g")
    backs = state.join(several, "g", "left_semi").select("doc_id", "h", "line", F.posexplode("back").alias("k", "g"))
    held = backs.join(_first_places(backs), "g").where("struct(doc_id, h, line) > first")
    longest = held.groupBy("doc_id", "h", "line").agg(F.max("k").alias("k"))
    return longest.select("doc_id", "h", F.expr("cast(line - k - 1 as int)").alias("a"), F.col("line").cast("int").alias("b"))


def _compared(hits: DataFrame) -> DataFrame:
    """The run that each place shares with its group's first place, and the group that it goes on in:
    places that leave the first one after the same lines, with the same next line."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc, h, found, late, early in zip(pdf.doc_id, pdf.h, pdf.hits, pdf.hashes, pdf.early):
            late, early = np.asarray(late, np.int64), np.asarray(early, np.int64)
            done: dict[int, tuple[int, int]] = {}
            for j, i, g in sorted((int(x["line"]), int(x["at"]), int(x["g"])) for x in found):
                a, b = done.get(j - i, (0, 0))
                if b <= j:
                    a, b = done[j - i] = extend(late, j, early, i)
                if b > j:  # else not the lines of the first place: a collision of hashes
                    out.append((doc, h, a, b, j, hash((g, b - j, int(late[b]))) if b < len(late) else None))
        return pd.DataFrame(out, columns=["doc_id", "h", "a", "b", "line", "after"]).astype({"after": "Int64"})

    return map_rows(hits, run, "doc_id long, h long, a int, b int, line long, after long")


def repeated_runs(lines: DataFrame, folder: str, least: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, h, runs): runs [a, b) of line numbers to delete; h is the text's hash."""
    begun = written(_begun(lines, least), folder, "places")
    source = lines.select(F.col("doc_id").alias("from_doc"), F.col("h").alias("from_h"), F.col("hashes").alias("early"))
    every = _runs_before(begun)
    state, rounds = begun.drop("back"), 0
    while True:
        met = (state.join(_first_places(state), "g").where("struct(doc_id, h, line) > first")
               .groupBy("doc_id", "h", F.col("first.doc_id").alias("from_doc"), F.col("first.h").alias("from_h"))
               .agg(F.collect_list(F.struct("line", F.col("first.line").alias("at"), "g")).alias("hits")))
        both = met.join(lines, ["doc_id", "h"]).join(source, ["from_doc", "from_h"])
        made = written(_compared(both.select("doc_id", "h", "hits", "hashes", "early")), folder, f"runs-{rounds}")
        every, rounds = every.union(made.select("doc_id", "h", "a", "b")), rounds + 1
        onward = made.where("after IS NOT NULL").select("doc_id", "h", "line", F.col("after").alias("g"))
        # A place that is alone in its group has no further holder.
        several = onward.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g")
        state = written(onward.join(several, "g", "left_semi"), folder, f"places-{rounds}")
        if not state.limit(1).count():
            return every.groupBy("doc_id", "h").agg(F.collect_set(F.struct("a", "b")).alias("runs"))


def without_lines(text: str, drop: set[int]) -> str:
    """The text without the given ones of its non-blank lines."""
    keep, number = [], -1
    for line in text.split("\n"):
        bare = bool(line.strip(" \t\x0b\x0c\r"))
        number += bare
        if not (bare and number in drop):
            keep.append(line)
    return "\n".join(keep)


def dedup_lines(docs: DataFrame, least: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text (later repeated runs deleted), n_lines, deleted_lines, deleted_words."""
    folder = shared_folder(docs.sparkSession, "line-dedup")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))

    def lined(pdf: pd.DataFrame) -> pd.DataFrame:
        made = list(line_table(to_bytes(pdf.text)))
        return pd.DataFrame({"doc_id": pdf.doc_id, "h": pdf.h, "hashes": [x for x, _ in made], "words": [n for _, n in made]})

    lines = map_rows(rows.where("doc_id IS NOT NULL AND text IS NOT NULL"), lined, LINES).where(F.size("hashes") > 0)
    lines = written(lines.dropDuplicates(["doc_id", "h"]), folder, "lines")
    runs = written(repeated_runs(lines, folder, least), folder, "runs")

    def rewrite(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc, text, found, (_, words) in zip(pdf.doc_id, pdf.text, pdf.runs, line_table(to_bytes(pdf.text))):
            drop = set() if found is None else {k for r in found for k in range(r["a"], r["b"])}
            out.append((doc, without_lines(text, drop) if drop else text, len(words), len(drop),
                        int(words[sorted(drop)].sum()) if drop else 0))
        return pd.DataFrame(out, columns=["doc_id", "text", "n_lines", "deleted_lines", "deleted_words"]).astype({"doc_id": "Int64"})

    # sorted and merged at every size: the runs grow with the input, so no broadcast on an estimate
    return map_rows(rows.join(runs.hint("merge"), ["doc_id", "h"], "left").select("doc_id", "text", "runs"), rewrite,
                    "doc_id long, text string, n_lines long, deleted_lines long, deleted_words long")
