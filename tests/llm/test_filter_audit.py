import itertools
import re
from collections import Counter

from pyspark.sql import functions as F

from crawlmeta.llm import filter_audit

from . import odd

COLUMNS = ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]


def fails(text, later_copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = ""
    if len(words) < 50:
        found += "A"
    if 100 * len(set(words)) < 65 * len(words):
        found += "B"
    if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
        found += "C"
    if re.search(r"[#$%&*|]", text):
        found += "D"
    return found + ("E" if later_copy else "")


def brute(rows, labels, letters="ABCDE"):
    """rows: (id, text, part); every document walks through every order."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    got = {}
    for i, t, part in rows:
        f = fails(t or "", i is not None and i > least[t or ""])
        good, toxic = labels.get(i, (0, 0)) if i is not None else (0, 0)
        for order in map("".join, itertools.permutations(letters)):
            gone = False
            for step, x in enumerate(order, 1):
                c = got.setdefault((part or "", order, step), Counter())
                here = x in f
                c["kept"] += not gone and not here
                c["removed"] += not gone and here
                c["redundant"] += gone and here
                c["unique_fails"] += f == x
                c["good_lost"] += (not gone and here) and good
                c["toxic_lost"] += (not gone and here) and toxic
                gone = gone or here
    total = Counter()
    for (part, order, step), c in got.items():
        total[part, order[step - 1]] += c["removed"]
    return sorted((*k, *[c[n] for n in filter_audit.COUNTS], total[k[0], k[1][k[2] - 1]]) for k, c in got.items())


def rows_of(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()))


def test_equals_a_walk_through_all_orders(spark):
    docs = odd.documents(spark)
    flags = {r.doc_id: (r.quality == 1, r.toxic == 1) for r in odd.labels(spark).collect()}
    want = brute([(r.doc_id, r.text, r.source) for r in docs.collect()], flags)
    got = rows_of(filter_audit.audit(docs, odd.labels(spark)))
    assert got == want and len(got) == 600 * docs.select("source").distinct().count()


def test_odd_rows_copies_and_labels(spark):
    docs = odd.odd(spark).withColumn("source", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 2))
    labels = spark.createDataFrame([(2, 1, 0), (2, 0, 1), (None, 1, 1), (8, None, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, None if r.source is None else str(r.source)) for r in docs.collect()]
    got = rows_of(filter_audit.audit(docs, labels))
    assert got == brute(rows, {2: (1, 1), 8: (0, 1)})
    assert any(r[0] == "" for r in got)


def test_empty_tables(spark):
    assert filter_audit.audit(odd.empty(spark), odd.labels(spark)).collect() == []
    no_labels = odd.labels(spark).limit(0)
    docs = odd.odd(spark)
    assert rows_of(filter_audit.audit(docs, no_labels)) == brute(
        [(r.doc_id, r.text, r.source) for r in docs.collect()], {})


def test_other_filters(spark):
    short = {"x": lambda t, w: F.length(t) < 20}
    docs = odd.odd(spark)
    got = filter_audit.audit(docs, odd.labels(spark), short, duplicates="y").collect()
    assert {(r.filter_order, r.step) for r in got} == {("xy", 1), ("xy", 2), ("yx", 1), ("yx", 2)}
    assert {r.removed + r.kept for r in got if r.step == 1} == {docs.count()}
