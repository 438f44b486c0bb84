"""Near-duplicate documents: an LSH forest of sorted MinHash signature orders.

1. Each text becomes the set of its word shingles and a MinHash signature of
   one byte per column. Equal sets are one class, named by its least id.
2. The signature is read in several orders: each starts at another column and
   wraps. Per order, classes are range-partitioned and sorted by their bytes, so
   the neighbours with the longest common prefix are next to each other. A task
   streams its sorted rows and joins a row with its last neighbours when the
   common prefix is deep enough and the signatures agree well. Where many alike
   documents lie, the neighbours share long prefixes; where few do, short ones
   suffice: the depth adapts to each region. A hot region is split by the range
   partitioning like any other. Where more rows share the least prefix than the
   window holds, the window is not enough: such a run is dealt into blocks of a
   bounded number of rows, and each pair of blocks is one task, in which every pair
   of rows is compared by its whole signatures. Tasks emit spanning links only, never pairs.
3. Connected neighbours form a region (by links of ids alone). A region is dealt
   into blocks of a bounded total, by set size; each pair of blocks whose
   set sizes can reach the threshold is one task's work. There every pair whose
   signatures come near the threshold is confirmed on the full sets, unless both
   are already connected by confirmed links. No pair is capped: a region larger
   than one block gets more pairs of blocks. Texts that lie in no region are told
   by a table of bounded size and stay where they are read.
4. Components of the confirmed links give the least reachable id.

A pair at the threshold shares the least prefix in some order with probability
1 - (1 - t^depth)^orders (above 0.99999 for the defaults), and comes near enough
by signature with more than four standard deviations to spare. A pair that shares
it is compared however many rows stand between: in a run of at most NEIGHBOURS + 1
rows by the window (where the range partitioning cuts a run, by a second window over the
rows at the cut), in a longer one by the blocks. The work on a run grows
with the square of its rows that are no near duplicates. Sets are of 64-bit shingle hashes.

Defined cases: a null or empty text, or one without words, has an empty set and
is linked with nothing; a text with fewer words than a shingle is one shingle;
rows that repeat an id are one document; a row without an id takes the least id
of the rows with an equal set, if any, and is otherwise alone (component_id
null, kept); an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlmeta.llm.common import Words, blocks, map_rows, mix64, shared_folder, to_bytes, unused, written
from crawlmeta.llm.components import connected_components

COLUMNS = 128
ORDERS = 16
#: Bytes of an order that travel with a row, and of those that neighbours must share.
ORDER_BYTES = 64
DEPTH = 4
#: Rows before a row in its order that are compared with it.
NEIGHBOURS = 8
#: Rows of the sorted orders that one task takes.
TASK_ROWS = 500_000
#: Rows of one block of a run that is longer than the window.
RUN_ROWS = 1 << 14
#: Shingles of one block of a region.
BLOCK_SHINGLES = 1 << 21
#: Words of 64 bits of the table by which tasks tell the texts that no region holds.
MARK_WORDS = 1 << 18
#: Standard deviations of the signature's estimate that a pair may fall short of the threshold.
SLACK = 4.5
_RNG = np.random.default_rng(20)
_MUL = _RNG.integers(1, 2**63, COLUMNS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(1, 2**63, COLUMNS, dtype=np.uint64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    with np.errstate(over="ignore"):
        for a, b in blocks(texts):
            w = Words(texts[a:b])
            mixed = np.zeros(max(0, len(w.hash) - width + 1), np.uint64)
            for k in range(width):
                mixed += w.hash[k:k + len(mixed)] * _PLACE[k]
            mixed = mix64(mixed)
            for i in range(b - a):
                first, end = int(w.first[i]), int(w.first[i + 1])
                n = end - first
                if n >= width:
                    yield np.unique(mixed[first:end - width + 1])
                elif n:
                    short = w.hash[first:end] * _PLACE[:n]
                    yield mix64(np.array([short.sum(dtype=np.uint64) + np.uint64(n)], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One byte per column and set; an empty set has zeros."""
    out = np.zeros((len(sets), COLUMNS), np.uint8)
    full = [i for i, s in enumerate(sets) if len(s)]
    with np.errstate(over="ignore"):
        a = 0
        while a < len(full):
            b, size = a, 0
            while b < len(full) and (b == a or size + len(sets[full[b]]) <= 1 << 15):
                size += len(sets[full[b]])
                b += 1
            part = [sets[i] for i in full[a:b]]
            flat = np.concatenate(part)
            start = np.concatenate([[0], np.cumsum([len(s) for s in part])[:-1]])
            work, least = np.empty_like(flat), np.empty((COLUMNS, len(part)), np.uint64)
            for c in range(COLUMNS):
                np.multiply(flat, _MUL[c], out=work)
                work += _ADD[c]
                least[c] = np.minimum.reduceat(work, start)
            out[full[a:b]] = (mix64(least) >> np.uint64(56)).astype(np.uint8).T
            a = b
    return out


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, h1, h2 (hash of the set), sig."""

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = list(shingle_sets(to_bytes(pdf.text), width))
        sig = signatures(sets)
        with np.errstate(over="ignore"):
            h1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            h2 = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        return pd.DataFrame({"doc_id": pdf.doc_id, "n_shingles": [len(s) for s in sets],
                             "h1": h1, "h2": h2, "sig": [x.tobytes() for x in sig]})

    return map_rows(docs, make, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


class Union:
    """Union of ids; the least id is the root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (p := self.up.get(root, root)) != root:
            root = p
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.up.setdefault(min(a, b), min(a, b))
        return a != b

    def links(self) -> pd.DataFrame:
        return pd.DataFrame([(x, self.find(x)) for x in list(self.up) if self.find(x) != x],
                            columns=["u", "v"], dtype=np.int64)


def _window_links(near: Union, pdf: pd.DataFrame, old: int, threshold: float, least: int) -> None:
    """Join each row from ``old`` on with its last neighbours in the order."""
    key = np.frombuffer(b"".join(pdf.key), np.uint8).reshape(len(pdf), ORDER_BYTES)
    o, rep, n = pdf.o.to_numpy(), pdf.rep.to_numpy(), pdf.n_shingles.to_numpy()
    for back in range(1, min(NEIGHBOURS, len(pdf) - 1) + 1):
        i = np.arange(max(back, old), len(pdf))
        i = i[(o[i] == o[i - back]) & (key[i, :DEPTH] == key[i - back, :DEPTH]).all(1)]
        i = i[np.minimum(n[i], n[i - back]) >= threshold * np.maximum(n[i], n[i - back])]
        i = i[(key[i] == key[i - back]).sum(1) >= least]
        for x, y in zip(rep[i].tolist(), rep[i - back].tolist()):
            near.join(x, y)


def _neighbours(classes: DataFrame, threshold: float, folder: str) -> DataFrame:
    """Spanning links (u, v) between neighbours in the sorted orders. A task's first and last
    rows meet those of the tasks beside it in a second, small step."""
    least = int((threshold - SLACK * (threshold * (1 - threshold) / ORDER_BYTES) ** 0.5) * ORDER_BYTES)
    step = COLUMNS // ORDERS
    rows = classes.select(
        "rep", "n_shingles", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("o"), "sig").select(
        F.expr("cast(o as byte)").alias("o"),
        F.expr(f"substring(concat(sig, sig), o * {step} + 1, {ORDER_BYTES})").alias("key"), "rep", "n_shingles")
    columns = ["o", "key", "rep", "n_shingles"]
    out, numbers = ["u", "v", "edge", *columns], dict.fromkeys(["u", "v", "edge", "o", "rep", "n_shingles"], "Int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        near, head, kept = Union(), None, None
        for pdf in batches:
            head = pdf if head is None else head if len(head) >= NEIGHBOURS else pd.concat([head, pdf], ignore_index=True)
            head = head.iloc[:NEIGHBOURS]
            if kept is not None:
                pdf = pd.concat([kept, pdf], ignore_index=True)
            _window_links(near, pdf, 0 if kept is None else len(kept), threshold, least)
            kept = pdf.iloc[-NEIGHBOURS:]
        yield near.links().reindex(columns=out).astype(numbers)
        if kept is not None:
            yield pd.concat([head.assign(edge=task - 1), kept.assign(edge=task)], ignore_index=True).reindex(columns=out).astype(numbers)

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        near = Union()
        _window_links(near, pdf.sort_values(["o", "key", "rep"], ignore_index=True), 0, threshold, least)
        return near.links()

    # Tasks hold far more rows than the window, so that no run spans more than two of them.
    n = classes.count() * ORDERS
    tasks = max(1, n // TASK_ROWS, min(n // 2_000, 4 * classes.sparkSession.sparkContext.defaultParallelism))
    ordered = rows.repartitionByRange(tasks, "o", "key", "rep").sortWithinPartitions("o", "key", "rep")
    found = written(ordered.mapInPandas(run, "u long, v long, edge int, o byte, key binary, rep long, n_shingles long"), folder, "neighbours")
    edges = found.where("edge IS NOT NULL").groupBy("edge").applyInPandas(
        lambda pdf: met(pdf[columns].astype({"o": "int64"})), "u long, v long")
    return found.where("u IS NOT NULL").select("u", "v").union(edges)


def _agreeing(sig: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Equal columns of each row of ``sig`` with ``one``: 0 or 1 per byte, eight bytes added at once."""
    lanes = (sig == one).view(np.uint64).sum(1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return (lanes * np.uint64(0x0101010101010101)) >> np.uint64(56)


def _run_links(classes: DataFrame, threshold: float) -> DataFrame:
    """Spanning links (u, v) among all rows of each run that is longer than the window.
    The runs are a table of their own: a plan of many shuffles is planned anew in the driver
    after each of them."""
    least = int((threshold - SLACK * (threshold * (1 - threshold) / COLUMNS) ** 0.5) * COLUMNS)
    step = COLUMNS // ORDERS
    places = classes.select("rep", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("o"), "sig").select(
        "rep", F.expr("cast(o as byte)").alias("o"),
        F.expr(f"substring(concat(sig, sig), o * {step} + 1, {DEPTH})").alias("prefix"))
    runs = places.groupBy("o", "prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NEIGHBOURS + 1).select(
        "o", "prefix", F.ceil(F.col("n") / RUN_ROWS).cast("int").alias("parts"))
    runs = written(runs, shared_folder(classes.sparkSession, "runs"), "runs")
    members = (places.join(runs, ["o", "prefix"])
               .withColumn("part", F.expr("cast(pmod(xxhash64(rep), parts) as int)"))
               .join(classes.select("rep", "n_shingles", "sig"), "rep"))
    met = F.expr("explode(transform(sequence(0, parts - 1), q -> named_struct('a', least(part, q), 'b', greatest(part, q))))")
    spread = members.select("o", "prefix", met.alias("task"), "part", "rep", "n_shingles", "sig")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_shingles", "rep"])
        size, rep, part = pdf.n_shingles.to_numpy(), pdf.rep.to_numpy(), pdf.part.to_numpy()
        sig = np.frombuffer(b"".join(pdf.sig), np.uint8).reshape(len(pdf), COLUMNS)
        two = (part != part[0]).any()
        ends = np.searchsorted(size * threshold, size, "right")
        group, links = np.arange(len(pdf)), []
        for i in range(len(pdf) - 1):
            a, b = i + 1, int(ends[i])
            open_ = group[a:b] != group[i]
            if two:  # pairs within one block are another task's
                open_ &= part[a:b] != part[i]
            other = np.flatnonzero(open_) + a
            near = other[_agreeing(sig[other], sig[i]) >= least]
            if len(near):
                groups, first = np.unique(group[near], return_index=True)
                links += [(rep[i], rep[j]) for j in near[first]]
                group[np.isin(group, groups)] = group[i]
        return pd.DataFrame(links, columns=["u", "v"], dtype=np.int64)

    return spread.groupBy("o", "prefix", "task").applyInPandas(compare, "u long, v long")


def _marked(texts: DataFrame, ids: DataFrame, folder: str) -> DataFrame:
    """All rows of ``texts`` whose ``rep`` is in ``ids``, and a few others: every id sets two bits of
    one word in a table of at most MARK_WORDS words, which each task holds, so that the other texts
    need not move to meet the ids. With many more ids than words more others pass, none is lost."""

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("h", F.xxhash64("rep")).withColumn("word", F.expr(f"pmod(shiftright(h, 12), {MARK_WORDS}L)")).withColumn(
            "bits", F.expr("shiftleft(1L, cast(pmod(h, 64) as int)) | shiftleft(1L, cast(pmod(shiftright(h, 6), 64) as int))"))

    marks = written(placed(ids.select("rep")).groupBy("word").agg(F.bit_or("bits").alias("marks")), folder, "marks")
    return placed(texts).join(F.broadcast(marks), "word").where("(marks & bits) = bits").select(*texts.columns)


def _confirmed(docs: DataFrame, regions: DataFrame, width: int, percent: int) -> DataFrame:
    """Spanning links (u, v) of the confirmed pairs of each region (rep, region, n_shingles). Sizes,
    their totals and the tasks are tables of their own, like the runs."""
    t, folder = percent / 100, shared_folder(docs.sparkSession, "confirmed")
    need = (t - SLACK * (t * (1 - t) / COLUMNS) ** 0.5) * COLUMNS
    # sizes of two sets that can be linked lie in the same step or in adjacent
    # ones; a step of a region is dealt into parts of a bounded total
    step = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1 / t))).cast("int")
    sized = written(regions.withColumn("step", step), folder, "sized")
    per_step = written(sized.groupBy("region", "step").agg(F.sum("n_shingles").alias("total")), folder, "per-step")
    dealt = (sized.join(per_step, ["region", "step"])
             .withColumn("parts", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int"))
             .withColumn("part", F.expr("cast(pmod(xxhash64(rep), parts) as int)")))
    # a set meets sets of its own step and of the next smaller one; parts of both in all combinations
    lower = per_step.select("region", (F.col("step") + 1).alias("step"),
                            F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int").alias("below"))
    upper = per_step.select("region", (F.col("step") - 1).alias("step"),
                            F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int").alias("above"))
    dealt = dealt.join(lower, ["region", "step"], "left").join(upper, ["region", "step"], "left")
    span = per_step.groupBy("region").agg(F.sum("total").alias("all"))
    dealt = dealt.join(span, "region")
    whole = F.col("all") <= BLOCK_SHINGLES
    # task name: (step of the larger block, its part, part of the other block, same step or not)
    same = F.expr("transform(sequence(0, parts - 1), q -> named_struct('s', step, 'k', 0, 'a', least(part, q), 'b', greatest(part, q)))")
    down = F.expr("case when below is not null then transform(sequence(0, below - 1), q -> named_struct('s', step, 'k', 1, 'a', part, 'b', q)) else array() end")
    up = F.expr("case when above is not null then transform(sequence(0, above - 1), q -> named_struct('s', step + 1, 'k', 1, 'a', q, 'b', part)) else array() end")
    one = F.expr("array(named_struct('s', 0, 'k', 0, 'a', 0, 'b', 0))")
    tasks = dealt.select("rep", "region", F.when(whole, one).otherwise(F.concat(same, down, up)).alias("tasks"))
    tasks = written(tasks, folder, "tasks")

    def with_set(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = list(shingle_sets(to_bytes(pdf.text), width))
        return pd.DataFrame({"rep": pdf.rep, "region": pdf.region, "tasks": pdf.tasks,
                             "shingles": [s.tobytes() for s in sets]})

    texts = docs.select(F.col("doc_id").alias("rep"), "text").where("rep IS NOT NULL")
    sets = map_rows(_marked(texts, tasks, folder).join(tasks, "rep"), with_set,
                    "rep long, region long, tasks array<struct<s int, k int, a int, b int>>, shingles binary")
    spread = sets.select("rep", "region", F.explode("tasks").alias("task"), "shingles")

    def confirm(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in pdf.shingles]
        sig, rep = signatures(sets), pdf.rep.to_numpy()
        size = np.array([len(s) for s in sets])
        # the text that most others were edited from comes first: it links them at once
        mode = np.array([np.bincount(c, minlength=256).argmax() for c in sig.T], np.uint8)
        order = np.argsort(-(sig == mode).sum(1), kind="stable")
        sig, size, rep = sig[order], size[order], rep[order].tolist()
        sets = [sets[i] for i in order]
        linked = Union()
        for i in range(len(sets) - 1):
            agree = (sig[i + 1:] == sig[i]).sum(1)
            ok = (agree >= need) & (100 * np.minimum(size[i], size[i + 1:]) >= percent * np.maximum(size[i], size[i + 1:]))
            near = np.flatnonzero(ok)
            for j in (near[np.argsort(-agree[near], kind="stable")] + i + 1).tolist():
                if linked.find(rep[i]) == linked.find(rep[j]):
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    linked.join(rep[i], rep[j])
        return linked.links()

    return spread.groupBy("region", "task").applyInPandas(confirm, "u long, v long")


def near_dedup(docs: DataFrame, width: int = 3, percent: int = 85, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept. Links have
    100 * intersection >= percent * union of the shingle sets."""
    folder = shared_folder(docs.sparkSession, "near-dedup")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = written(_signed(rows, width), folder, "signed")
    key = ["h1", "h2", "n_shingles"]
    classes = signed.where("n_shingles > 0").groupBy(*key).agg(
        F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = written(classes, folder, "classes")
    named = classes.where("rep IS NOT NULL")
    links = written(_neighbours(named, percent / 100, folder), folder, "in-window").union(
        written(_run_links(named, percent / 100), folder, "in-runs"))
    near = connected_components(links, f"{folder}/near")
    near = written(near, folder, "regions")
    member = near.select(F.col("node").alias("rep"), F.col("component").alias("region")).union(
        near.select(F.col("component").alias("rep"), F.col("component").alias("region")).distinct())
    sizes = named.groupBy("rep").agg(F.max("n_shingles").alias("n_shingles"))
    confirmed = written(_confirmed(rows, member.join(sizes, "rep"), width, percent), folder, "confirmed")
    linked = connected_components(confirmed, f"{folder}/linked")
    of_class = classes.select(*key, "rep").join(
        linked.withColumnRenamed("node", "rep"), "rep", "left").select(
        *key, F.coalesce("component", "rep").alias("of_set"))
    found = signed.select("doc_id", *key).join(of_class, key, "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("of_set"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"),
                        F.col("doc_id").eqNullSafe(own).alias("kept"))


def keep_one(docs: DataFrame, width: int = 3, percent: int = 85, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: all but those that
    the decision drops. A row without an id stays."""
    found = near_dedup(docs, width, percent, id_col, text_col)
    (name,) = unused(docs.columns, "__drop")
    drop = found.where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(drop, F.col(f"`{id_col}`") == F.col(name), "left_anti")
