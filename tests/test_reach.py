import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from crawlmeta.operators import crawl as crawl_op
from crawlmeta.operators import reach, visited
from crawlmeta.session import work_folder
from crawlmeta.sources import corpus
from tests.conftest import SF0001


def walk(roots, links, max_depth):
    """Breadth-first walk per root, one queue."""
    out = {}
    after = {}
    for a, b in links:
        after.setdefault(a, []).append(b)
    for r in {r for r in roots if r is not None}:
        seen, queue = {r: 0}, deque([r])
        while queue:
            u = queue.popleft()
            for v in after.get(u, []) if seen[u] < max_depth else []:
                if v is not None and v not in seen:
                    seen[v] = seen[u] + 1
                    queue.append(v)
        out |= {(r, u): d for u, d in seen.items()}
    return out


def graphs():
    r = random.Random(11)
    chain = [(f"c{i}", f"c{i + 1}") for i in range(40)]
    ring = [(f"r{i}", f"r{(i + 1) % 17}") for i in range(17)]
    hub = [(f"h{i}", "hub") for i in range(60)] + [("hub", f"leaf{i}") for i in range(80)]
    dense = [(f"d{i}", f"d{j}") for i in range(25) for j in range(25) if (i * 7 + j) % 3]
    noise = [(f"n{r.randrange(50)}", f"n{r.randrange(50)}") for _ in range(90)]
    odd = [("a", "a"), ("a", "b"), ("a", "b"), ("b", None), (None, "a")]
    links = chain + ring + hub + dense + noise + odd
    roots = ["c0", "c0", "c25", "r3", "h1", "leaf2", "d4", "n1", "n2", "a", "unknown", None]
    return roots, links


def got(spark, roots, links, depth, **more):
    df, size = reach.least_depths(spark.createDataFrame([(r,) for r in roots], "root string"),
                                  spark.createDataFrame(links, "url string, target string"), depth,
                                  work_folder(spark, "reach"), **more)
    rows = df.collect()
    assert len(rows) == len({(r.root, r.url) for r in rows}) and size >= 0
    return {(r.root, r.url): r.depth for r in rows}


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 7, 20])
def test_depths_equal_a_walk(spark, depth):
    roots, links = graphs()
    assert got(spark, roots, links, depth) == walk(roots, links, depth)


def test_depths_when_doubling_is_too_dear_and_without_broadcast(spark, monkeypatch):
    roots, links = graphs()
    monkeypatch.setattr(reach, "WORK_FREE", 10)
    monkeypatch.setattr(reach, "WORK_PER_LINK", 0)
    assert got(spark, roots, links, 20, broadcast_bytes=-1) == walk(roots, links, 20)


def test_work_is_counted_without_making_the_pairs(spark):
    left = spark.range(5000).select(F.lit(1).alias("b"))
    right = spark.range(7000).select(F.lit(1).alias("a"))
    assert reach._join_work(left, right) == 35_000_000


def test_few_rounds_for_any_depth():
    assert reach.plan_rounds(20) == (3, [8, 8, 4])
    for d in range(200):
        k, steps = reach.plan_rounds(d)
        assert sum(steps) == d and k + len(steps) <= 3 * max(1, d).bit_length()


def test_jobs_do_not_grow_with_the_depth(spark):
    links = [(f"x{i}", f"x{i + 1}") for i in range(130)]
    tracker, counts = spark.sparkContext.statusTracker(), []
    for depth in (8, 64, 128):
        group = f"reach-{depth}"
        spark.sparkContext.setJobGroup(group, group)
        assert len(got(spark, ["x0"], links, depth)) == depth + 1
        counts.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[2] < 2.5 * counts[0]


def test_empty_inputs(spark):
    assert got(spark, [], [("a", "b")], 5) == {}
    assert got(spark, ["a"], [], 5) == {("a", "a"): 0}


def documents(spark):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet").select("page_id", "url")
    return corpus.sitemap_seeds(pages), corpus.sitemap_documents(pages)


def crawled(seeds, fetch):
    res = crawl_op.crawl(seeds, fetch)
    return sorted(map(tuple, res.visits.collect()), key=str), sorted(map(tuple, res.links.collect()), key=str)


def body_fetch(docs):
    return crawl_op.body_fetcher(lambda urls: urls.join(docs, "url", "left").select("url", "body"))


def test_walk_by_levels_gives_the_same_visits(spark, monkeypatch):
    seeds, docs = documents(spark)
    want = crawled(seeds, crawl_op.table_fetcher(docs))
    assert crawled(seeds.where("seed_id < 12"), body_fetch(docs)) == tuple(
        [r for r in rows if r[0] < 12] for rows in want)
    # Every level over the limit: Bloom filter and bucketed table; a filter of one word knows everything.
    for words in (1 << 20, 1):
        monkeypatch.setattr(crawl_op, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(visited, "WORDS", words)
        assert crawled(seeds.where("seed_id < 3"), body_fetch(docs)) == tuple(
            [r for r in rows if r[0] < 3] for rows in want)


def test_filter_has_no_false_negatives_and_few_false_hits(spark):
    pairs = spark.range(30_000).select((F.col("id") % 7).cast("string").alias("root"), F.col("id").cast("string").alias("url"))
    seen = visited.Visited(spark, work_folder(spark, "visited"), -1)
    seen.add(pairs, 0)
    other = pairs.withColumn("url", F.concat("url", F.lit("x")))
    assert pairs.where(visited.probe(seen.shared)).count() == 30_000
    assert other.where(visited.probe(seen.shared)).count() < 300
    left = seen.unseen(pairs.union(other).union(other))
    assert left.count() == left.distinct().count() == 30_000 and left.where("url NOT LIKE '%x'").count() == 0
    seen.close()


def test_the_visited_side_is_not_shuffled(spark):
    pairs = spark.range(100).select(F.col("id").cast("string").alias("root"), F.col("id").cast("string").alias("url"))
    seen = visited.Visited(spark, work_folder(spark, "visited"), -1)
    seen.add(pairs, 0)
    seen.add(pairs.withColumn("url", F.lit("later")), 1)
    plan = seen.unseen(pairs)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    visited_side = join[join.index("buckets") - 800:join.index("buckets")] if "buckets" in join else join
    assert "Bucketed: true" in plan and f"hashpartitioning(root" in plan
    assert visited_side.rindex("Scan parquet") > visited_side.rfind("Exchange")
    assert plan.count("Exchange") <= 2  # the candidates, once for each branch (one shuffle is reused)
    seen.close()
