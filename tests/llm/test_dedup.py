import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from crawlmeta.llm import exact_dedup, imatch, line_winnow, minhash_forest
from crawlmeta.llm.common import shared_folder
from crawlmeta.llm.components import connected_components

from . import odd


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def weak_hash(text):
    return F.length(text) % 3


@pytest.mark.parametrize("hash_fn", [exact_dedup.content_hash, weak_hash])
def test_exact_groups_by_bytes(spark, hash_fn):
    rows = [(d, t) for d, t in odd.texts()] + [(r[0], r[1]) for r in odd.rows()]
    docs = odd.documents(spark).select("doc_id", "text").union(odd.odd(spark).select("doc_id", "text"))
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[norm(t)].append(d)
    want = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        want += [(d, keep, len(ids), d == keep, hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    got = exact_dedup.exact_dedup(docs, hash_fn=hash_fn).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_exact_keep_first_keeps_columns(spark):
    docs = odd.odd(spark)
    got = exact_dedup.keep_first(docs)
    assert got.dtypes == docs.dtypes
    texts = [norm(r.text) for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({norm(r[1]) for r in odd.rows()})
    assert exact_dedup.keep_first(odd.empty(spark)).collect() == []
    assert exact_dedup.exact_dedup(odd.empty(spark)).collect() == []


def extras(rows):
    return {tuple(r)[5:] for r in rows}


def test_deciding_functions_keep_every_row_and_column(spark):
    docs = odd.odd(spark)
    got = exact_dedup.keep_first(docs)
    assert got.columns == docs.columns and extras(got.collect()) == {odd.EXTRA}
    nobody = docs.where("doc_id IS NULL AND text LIKE 'ein %'")
    copies = docs.where("doc_id IS NOT NULL").union(nobody).union(nobody).union(nobody)
    assert exact_dedup.keep_first(copies).where("doc_id IS NULL").count() == 3
    decided = exact_dedup.exact_dedup(copies).where("kept AND doc_id IS NULL").count()
    assert decided == 3
    near = minhash_forest.keep_one(docs)
    assert near.columns == docs.columns and extras(near.collect()) == {odd.EXTRA}
    assert near.where("doc_id IS NULL").count() == docs.where("doc_id IS NULL").count()


def shingles(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute_components(rows, percent=85):
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def edits(seed, groups=12, copies=9):
    """Groups of texts with 0 to 6 changed words, and words in common between groups."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc = [], 1000
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.randint(20, 150))]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randint(0, 6)):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            rows.append((doc, " ".join(text)))
            doc += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [minhash_forest.BLOCK_SHINGLES, 400])
def test_near_components_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_forest, "BLOCK_SHINGLES", block)
    rows = edits(4) + odd.texts()[:120]
    got = minhash_forest.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(got) == len(rows)


@pytest.mark.parametrize("rows_of_block", [minhash_forest.RUN_ROWS, 7])
def test_near_pair_with_a_crowd_between_is_linked(spark, monkeypatch, rows_of_block):
    """A pair shares the least prefix in one order only, and forty rows of that prefix stand between."""
    monkeypatch.setattr(minhash_forest, "RUN_ROWS", rows_of_block)
    r = random.Random(5)
    depth, step = minhash_forest.DEPTH, minhash_forest.COLUMNS // minhash_forest.ORDERS
    one = [100] * minhash_forest.COLUMNS
    two = [101 if c >= step and c % step == 0 else x for c, x in enumerate(one)]
    one[depth], two[depth] = 0, 255
    crowd = [one[:depth] + [10 + k] + [r.randrange(256) for _ in one[depth + 1:]] for k in range(40)]
    rows = [(i, 50, bytearray(s)) for i, s in enumerate([one, two, *crowd], 1)]
    classes = spark.createDataFrame(rows, "rep long, n_shingles long, sig binary")
    monkeypatch.setattr(minhash_forest, "_signed", lambda docs, width: classes.selectExpr(
        "rep as doc_id", "n_shingles", "rep as h1", "rep as h2", "sig"))
    found = []
    monkeypatch.setattr(minhash_forest, "_confirmed", lambda docs, regions, width, percent: found.append(
        {x.rep: x.region for x in regions.collect()}) or spark.createDataFrame([], "u long, v long"))
    docs = spark.createDataFrame([(i, "") for i, _, _ in rows], "doc_id long, text string")
    minhash_forest.near_dedup(docs).collect()
    assert found == [{1: 1, 2: 1}]


def test_near_takes_odd_rows(spark):
    docs = odd.odd(spark)
    got = minhash_forest.near_dedup(docs).collect()
    assert len(got) == len(odd.rows())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[2].component_id == by_id[3].component_id == 1 and by_id[8].component_id == 7
    for alone in (4, 5, 6):
        assert (by_id[alone].n_shingles, by_id[alone].component_id, by_id[alone].kept) == (0, alone, True)
    assert by_id[9].n_shingles == by_id[10].n_shingles == 1
    staying = minhash_forest.keep_one(docs)
    assert staying.dtypes == docs.dtypes
    assert {r.doc_id for r in staying.collect()} == {1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, None}
    assert minhash_forest.near_dedup(odd.empty(spark)).collect() == []


def test_components_of_chains_and_stars(spark):
    r = random.Random(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(300, 300), (None, 5)]
    links += [(r.randrange(400, 460), r.randrange(400, 460)) for _ in range(40)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links, "u long, v long")
    got = {x.node: x.component for x in connected_components(df, shared_folder(spark, "t")).collect()}
    assert got == {x: find(x) for x in list(up) if find(x) != x}
    assert connected_components(df.limit(0), shared_folder(spark, "t")).collect() == []


def test_imatch_against_plain_texts(spark):
    rows = odd.texts()
    got = {r.doc_id: r for r in imatch.fingerprint(odd.documents(spark), parts=5).collect()}
    assert len(got) == len(rows)
    prints = {}
    for i, (doc, text) in enumerate(rows):
        follows = rows[(i + 1) % len(rows)]
        changed = text[:len(text) - len(text) // 2] + follows[1][:len(text) // 2]
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint

        def like(a, b):
            a, b = ([x[k:k + 8] for k in range(0, len(x), 8)] for x in (a, b))
            both = [(p, q) for p, q in zip(a, b) if p != "0" * 8 or q != "0" * 8]
            return sum(p == q for p, q in both) / len(both) if both else 1.0

        assert r.near_edited == pytest.approx(like(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(like(r.fingerprint, got[follows[0]].fingerprint))
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.8 * len(got)


def test_imatch_subsets_by_definition():
    words = imatch.np.unique(imatch.np.concatenate(list(imatch.terms([b"alpha beta gamma delta"]))))
    one, two, three, none = imatch.fingerprints(
        [b"alpha beta common", b"BETA, alpha other!", b"gamma", b" . "], words)
    assert (one == two).all() and one.any() and not none.any()
    assert imatch.likeness(one[None], two[None])[0] == 1.0 and imatch.likeness(none[None], none[None])[0] == 1.0
    assert imatch.likeness(one[None], three[None])[0] < 0.5


@pytest.mark.parametrize("parts", [1, 4])
def test_imatch_takes_odd_rows(spark, parts):
    got = imatch.fingerprint(odd.odd(spark), parts=parts).collect()
    assert len(got) == len(odd.rows())
    assert {r.fingerprint for r in got if r.doc_id in (1, 2)} == {next(r.fingerprint for r in got if r.doc_id == 2)}
    lone = spark.createDataFrame([(7, "abcd")], "doc_id long, text string")
    assert imatch.fingerprint(lone, parts=parts).first().edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert imatch.fingerprint(odd.empty(spark), parts=parts).collect() == []


def brute_lines(rows, least=line_winnow.WINDOW_WORDS):
    """Deleted line numbers per document, by plain loops over the same definition."""
    lines = {d: [x for x in (y.strip(" \t\x0b\x0c\r") for y in (t or "").split("\n")) if x] for d, t in rows}
    hashed = {d: dict(zip(range(len(v)), next(iter(line_winnow.line_table([(t or "").encode()])))[0].tolist()))
              for (d, t), v in zip(rows, (lines[d] for d, _ in rows))}
    first, marks = {}, []
    for d in sorted(lines):
        n = [len(x.split()) for x in lines[d]]

        def end(a):
            total = 0
            for b in range(a, len(n)):
                total += n[b]
                if total >= least:
                    return b + 1
            return None

        anchors = set()
        for a in range(len(n)):
            if end(a):
                anchors.add(min(range(a, end(a)), key=lambda k: hashed[d][k]))
        for p in sorted(anchors):
            if end(p):
                key = tuple(lines[d][p:end(p)])
                first.setdefault(key, (d, p))
                marks.append((d, p, key))
    out = collections.defaultdict(set)
    for d, p, key in marks:
        e, i = first[key]
        if (e, i) == (d, p):
            continue
        for step in (1, -1):
            j, k = p, i
            while 0 <= j < len(lines[d]) and 0 <= k < len(lines[e]) and lines[d][j] == lines[e][k]:
                out[d].add(j)
                j, k = j + step, k + step
    return lines, out


def test_lines_against_loops(spark):
    passage = "\n".join(" ".join(f"p{i}q{j}" for j in range(9)) for i in range(8))
    rows = [(d, t) for d, t in odd.texts()] + [
        (5001, "intro line here\n" + passage + "\n\nown end"), (5002, passage + "\nother end"), (5003, "a b c\nd e f"),
        (5004, passage + "\nbetween\n" + passage), (5005, ""), (5006, None), (5007, "x\n" * 200)]
    got = {r.doc_id: r for r in line_winnow.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lines, gone = brute_lines(rows)
    for d, t in rows:
        assert got[d].n_lines == len(lines[d]) and got[d].deleted_lines == len(gone[d]), d
        assert got[d].deleted_words == sum(len(lines[d][k].split()) for k in gone[d])
        kept = [x for x in (y.strip(" \t\x0b\x0c\r") for y in (got[d].text or "").split("\n")) if x]
        assert kept == [x for k, x in enumerate(lines[d]) if k not in gone[d]]
    assert got[5001].deleted_lines == 0 and got[5002].text == "other end" and got[5004].text == "between"


def test_lines_take_odd_rows(spark):
    got = line_winnow.dedup_lines(odd.odd(spark)).collect()
    assert len(got) == len(odd.rows())
    assert all(r.text is None for r in got if r.doc_id == 4)
    assert line_winnow.dedup_lines(odd.empty(spark)).collect() == []
