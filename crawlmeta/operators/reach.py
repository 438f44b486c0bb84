"""Least depths in a link graph in a logarithmic number of joins.

``least_depths`` gives (root, url, depth) for every URL that a root reaches in at
most ``max_depth`` links, without a job per level. Shortcuts of up to p links
are pairs (a, b, d) with their least length d; joined with themselves they give
those of up to 2p links (pointer doubling, with a least-length aggregate). Roots
then advance by p links at a time. For depth 20 these are three doublings and
three advances, whatever the graph looks like.

Three things keep the joins small. Only links between URLs that have links
themselves are doubled; ends of paths join once, at the end. A shortest path of
more than p links has a first part of exactly p, so only pairs of length p are
continued. URLs are numbered once, so joins move numbers.

Doubling computes shortcuts of URLs that no root may reach. Before each doubling
the pairs that its join would make are counted (products of numbers of links,
not the pairs); when they pass ``WORK_PER_LINK`` times the links and roots, the
doubling stops and the roots advance by the shortcuts there are, in more rounds.
The result is the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Joined pairs per link and root that a doubling may make, and pairs that it may always make.
WORK_PER_LINK, WORK_FREE = 16, 1 << 26
#: Bytes that a row of numbers takes in a hash table.
ROW_BYTES = 48


@dataclass
class Counted:
    """A written table and what was counted as it was written."""

    df: DataFrame
    rows: int
    seen: dict


def written(df: DataFrame, path: str, **more: Column) -> Counted:
    """Cut lineage: write ``df`` to the shared folder, counting rows and ``more`` in the same pass."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]).write.parquet(path)
    seen = dict(obs.get)
    return Counted(df.sparkSession.read.schema(df.schema).parquet(path), seen["rows"], seen)


def sized(df: DataFrame, size: int, limit: int) -> DataFrame:
    """Broadcast a side whose counted bytes are few; otherwise sort and merge,
    so that neither a stale estimate nor a hash table decides."""
    return F.broadcast(df) if size <= limit else df.hint("merge")


def plan_rounds(max_depth: int) -> tuple[int, list[int]]:
    """Number of doublings, then the links that each advance covers: the fewest joins."""
    best = None
    for k in range(max_depth.bit_length()):
        p = 1 << k
        steps = [p] * (max_depth // p) + [1 << i for i in reversed(range(k)) if max_depth % p >> i & 1]
        if best is None or k + len(steps) < best[0]:
            best = k + len(steps), k, steps
    return (best[1], best[2]) if best else (0, [])


def _join_work(left: DataFrame, right: DataFrame) -> int:
    """Rows of left JOIN right ON left.b = right.a, without making them."""
    ends = left.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    starts = right.groupBy(F.col("a").alias("b")).agg(F.count(F.lit(1)).alias("m"))
    work = F.sum(F.col("n").cast("double") * F.col("m"))
    return int(ends.join(starts, "b").agg(F.coalesce(work, F.lit(0.0))).first()[0])


def _continued(pairs: DataFrame, by: DataFrame) -> DataFrame:
    """Pairs (a, b, d) lengthened by shortcuts that start at their ends."""
    on = by.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("d").alias("e"))
    return pairs.join(on, "b").select("a", F.col("c").alias("b"), (F.col("d") + F.col("e")).alias("d"))


def least_depths(roots: DataFrame, links: DataFrame, max_depth: int, folder: str,
                 broadcast_bytes: int = 32 << 20) -> tuple[DataFrame, int]:
    """``roots`` (root) and ``links`` (url, target) to (root, url, depth) and its
    bytes as strings. ``folder`` is a new folder in shared storage. Links of a
    URL to itself and repeated links and roots change nothing; null URLs are
    left out."""
    if max_depth < 0:
        raise ValueError("max_depth must be >= 0")

    def few(df: DataFrame, rows: int) -> DataFrame:
        return sized(df, rows * ROW_BYTES, broadcast_bytes)

    names = (roots.select(F.col("root").alias("url")).union(links.select("url")).union(links.select("target"))
             .where("url IS NOT NULL").distinct())
    named = written(names, f"{folder}/names", bytes=F.coalesce(F.sum(F.octet_length("url") + 16), F.lit(0)))
    # Numbers of rows of a written table: the same in every reading of it.
    ids = written(named.df.select("url", F.monotonically_increasing_id().alias("id")), f"{folder}/ids").df
    ids_sized = sized(ids, named.seen["bytes"], broadcast_bytes)

    def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.join(ids_sized.select(F.col("url").alias(column), F.col("id").alias(name)), column).drop(column)

    edges = numbered(numbered(links.select("url", "target").where("url <> target"), "url", "a"), "target", "b").distinct()
    all_edges = written(edges, f"{folder}/edges")
    opens = all_edges.df.select(F.col("a").alias("b")).distinct().withColumn("open", F.lit(True))
    tagged = written(all_edges.df.join(few(opens, all_edges.rows), "b", "left").select("a", "b", F.lit(1).alias("d"), "open"),
                     f"{folder}/tagged", inner=F.count("open"))
    inner, n_inner = tagged.df.where("open").drop("open"), tagged.seen["inner"]
    ends, n_ends = tagged.df.where("open IS NULL").drop("open"), tagged.rows - tagged.seen["inner"]
    start = written(numbered(roots.select("root").distinct(), "root", "a").select("a", F.col("a").alias("b"), F.lit(0).alias("d")),
                    f"{folder}/reached/step=0")

    doublings, _ = plan_rounds(max_depth)
    limit = max(WORK_FREE, WORK_PER_LINK * (n_inner + start.rows))
    cuts, n_cuts, power, whole = {1: inner}, n_inner, 1, n_inner == 0
    n_longest = n_inner
    for _ in range(doublings):
        longest = cuts[power].where(F.col("d") == power)
        if n_longest * n_cuts > limit and _join_work(longest, cuts[power]) > limit:
            break
        more = _continued(few(longest, n_longest), cuts[power]).where("a <> b")
        both = cuts[power].unionByName(more).groupBy("a", "b").agg(F.min("d").alias("d"))
        power *= 2
        made = written(both, f"{folder}/cuts={power}", longest=F.count_if(F.col("d") == power))
        cuts[power], n_cuts, n_longest = made.df, made.rows, made.seen["longest"]
        whole = n_longest == 0
        if whole:  # no path is longer: these are all pairs
            break

    def so_far() -> DataFrame:
        return roots.sparkSession.read.schema(start.df.schema).parquet(f"{folder}/reached").select("a", "b", "d")

    reached = so_far()
    front, n_front, n_reached, at, step = start.df, start.rows, start.rows, 0, 0
    while at < max_depth and n_front:
        left = max_depth - at
        by = power if whole else max(p for p in cuts if p <= left)
        new = _continued(few(front, n_front), cuts[by]).where(F.col("d") <= max_depth).groupBy("a", "b").agg(F.min("d").alias("d"))
        seen = few(reached.select("a", "b"), n_reached)
        step, at = step + 1, at + by
        made = written(new.join(seen, ["a", "b"], "left_anti"), f"{folder}/reached/step={step}",
                       front=F.count_if(F.col("d") == at))
        reached = so_far()
        n_reached += made.rows
        front, n_front = made.df.where(F.col("d") == at), made.seen["front"]
        if whole:
            break

    last = _continued(few(reached.where(F.col("d") < max_depth), n_reached), ends)
    # Inner URLs have their least depth already; a root may itself be an end.
    every = written(reached.unionByName(last).groupBy("a", "b").agg(F.min("d").alias("d")), f"{folder}/every") if n_ends \
        else Counted(reached, n_reached, {})
    back = lambda name, column: ids_sized.select(F.col("id").alias(name), F.col("url").alias(column))
    out = every.df.join(back("a", "root"), "a").join(back("b", "url"), "b").select("root", "url", F.col("d").alias("depth"))
    mean = named.seen["bytes"] // max(1, named.rows)
    return out, every.rows * (2 * mean + 32)
