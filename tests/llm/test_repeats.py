"""Long texts of I-Match, and line runs against the definition."""

import random

import numpy as np
import pytest

from crawlmeta.llm import imatch, line_winnow


@pytest.mark.parametrize("n", [1, 5, 300, 3000, 4095, 4096, 20_000, 80_000, 500_000])
def test_likeness_of_long_texts(n):
    def text(name, k=n):
        return " ".join(f"{name}{i}" for i in range(k)).encode()

    r = np.random.default_rng(n)
    half = text("a").split()
    edit = b" ".join([*half[:n - n // 2], *text("z", n // 2).split()])
    a, same, b, c = imatch.fingerprints([text("a"), b" ".join(r.permutation(half)), text("b"), edit], np.zeros(0, np.uint64))
    assert (a == same).all() and a.any()
    assert imatch.likeness(a[None], b[None])[0] < 0.05
    if n > 1:
        assert imatch.likeness(a[None], c[None])[0] > (0.05 if n > 100 else 0)


def test_lengths_around_a_density_step_stay_comparable():
    words = [f"t{i}".encode() for i in range(8300)]
    a, b = imatch.fingerprints([b" ".join(words[:8150]), b" ".join(words)], np.zeros(0, np.uint64))
    assert len(words[:8150]).bit_length() != len(words).bit_length()
    assert imatch.likeness(a[None], b[None])[0] > 0.7


def test_the_lexicon_is_the_band(spark):
    rows = [(i, " ".join(["all"] + ["most"] * (i % 4 == 0) + ["some"] * (i % 50 == 0) + [f"own{i}"])) for i in range(4000)]
    words = imatch.lexicon(spark.createDataFrame(rows, "doc_id long, text string"))
    (want,) = imatch.terms([b"most some"])
    assert sorted(words.tolist()) == sorted(want.tolist())


def test_fingerprints_by_definition():
    """Each subset's hash from single terms, one at a time."""
    r = random.Random(4)
    texts = [" ".join(r.sample([f"w{i}" for i in range(9000)], k)).encode() for k in (3, 40, 700, 6000)]
    got = imatch.fingerprints(texts, np.zeros(0, np.uint64))
    with np.errstate(over="ignore"):
        for text, row in zip(texts, got):
            (terms,) = imatch.terms([text])
            on = max(0, len(terms).bit_length() - 12)
            for s in range(imatch.SUBSETS):
                place = s // imatch.PER_DENSITY
                d = next(d for d in range(1 + on, 13 + on) if (d - 1) % 12 == place)
                chance = imatch.mix64(terms * imatch._SEEDS[s])
                held = chance < np.uint64(2 ** (64 - d))
                if not 1 <= held.sum() <= imatch.MOST_TERMS:
                    assert row[s] == 0
                    continue
                total = imatch.mix64(chance[held] ^ terms[held]).sum(dtype=np.uint64)
                assert row[s] == max(int(imatch.mix64(np.array([total]))[0]) >> 32, 1)


def repeated(seqs, least):
    """By definition: (doc, line) of every run of whole lines with ``least`` words or more that an earlier place holds."""
    places = {}
    gone = set()
    for d, seq in enumerate(seqs):
        for s in range(len(seq)):
            best = 0
            for e, i in places.get(seq[s], []):
                k = 0
                while s + k < len(seq) and i + k < len(seqs[e]) and seq[s + k] == seqs[e][i + k]:
                    k += 1
                best = max(best, k)
            if sum(len(x.split()) for x in seq[s:s + best]) >= least:
                gone.update((d, s + k) for k in range(best))
            places.setdefault(seq[s], []).append((d, s))
    return gone


def chains(seed):
    """Texts that are chains of shared passages, with lines of their own between some of them."""
    r = random.Random(seed)
    line = lambda name: " ".join(f"{name}{i}" for i in range(r.choice([3, 6, 11])))
    passages = [[line(f"s{seed}p{p}l{k}w") for k in range(r.choice([2, 5, 12, 20]))] for p in range(7)]
    out = []
    for d in range(14):
        seq = []
        for _ in range(r.randint(1, 5)):
            p = r.choice(passages)
            seq += p if r.random() < 0.7 else p[r.randrange(len(p)):]
            if r.random() < 0.4:
                seq.append(line(f"s{seed}d{d}o{len(seq)}w"))
        out.append(seq)
    return out


def test_no_repeated_run_is_left_and_nothing_else_goes(spark):
    least = line_winnow.WINDOW_WORDS
    sets = [chains(seed) for seed in range(40)]
    rows = [(1000 * s + d, "\n".join(seq)) for s, seqs in enumerate(sets) for d, seq in enumerate(seqs)]
    got = {r.doc_id: r.text for r in line_winnow.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    deleted = 0
    for s, seqs in enumerate(sets):
        must, may = repeated(seqs, 2 * least), repeated(seqs, least)
        for d, seq in enumerate(seqs):
            kept = [x for x in got[1000 * s + d].split("\n") if x]
            # must go <= gone <= may go; lines of a text repeat, so compare what is kept
            strict = [x for k, x in enumerate(seq) if (d, k) not in may]
            loose = [x for k, x in enumerate(seq) if (d, k) not in must]
            rest = iter(loose)
            assert all(x in rest for x in kept), (s, d)
            rest = iter(kept)
            assert all(x in rest for x in strict), (s, d)
            deleted += len(seq) - len(kept)
    assert deleted > 1000


def test_a_second_passage_that_only_a_later_holder_shares(spark):
    line = lambda name: " ".join(f"{name}{i}" for i in range(10))
    p1, p2 = [line(f"a{k}") for k in range(10)], [line(f"b{k}") for k in range(2)]
    rows = [(1, "\n".join(p1 + [line("x")])), (2, "\n".join(p1 + p2 + [line("y")])), (3, "\n".join([line("z")] + p1 + p2))]
    got = {r.doc_id: r.text for r in line_winnow.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[3] == line("z") and got[2] == "\n".join(p2 + [line("y")])


def test_neighbours_on_two_sides_of_a_cut_are_linked(spark, monkeypatch):
    """Rows in one sorted order, dealt to many tasks: every near neighbour pair is found, cut or not."""
    from crawlmeta.llm import minhash_forest as forest
    from crawlmeta.llm.common import shared_folder
    r = np.random.default_rng(3)
    base = r.integers(0, 256, (900, forest.COLUMNS), dtype=np.uint8)
    twin = base.copy()
    twin[:, forest.COLUMNS - 3:] ^= 1  # neighbours in the orders that start far from the end
    sig = np.concatenate([base, twin])
    rows = [(i + 1, 40, bytearray(x.tobytes())) for i, x in enumerate(sig)]
    classes = spark.createDataFrame(rows, "rep long, n_shingles long, sig binary")
    monkeypatch.setattr(forest, "TASK_ROWS", 100)
    monkeypatch.setattr(forest, "ORDERS", 1)
    monkeypatch.setattr(forest, "NEIGHBOURS", 1)
    links = forest._neighbours(classes, 0.85, shared_folder(spark, "cut"))
    assert sorted(map(tuple, links.distinct().collect())) == [(i + 901, i + 1) for i in range(900)]
