"""Line dedup and near-dedup against brute force."""

import random

import numpy as np
import pytest

from ledgerloom.llm import graph, line_dedup, near_dedup
from ledgerloom.llm.common import Scratch

FRAME = "doc_id long, text string, n long, line string, component_id long, row string, version string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "l", 2, "r", "v") for i, t in rows], FRAME)


# ------------------------------------------------------------------ lines


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_a_repeated_block_goes_whole_although_its_frequent_lines_stood_earlier_elsewhere(spark):
    line = lambda k: " ".join(f"w{k}n{i}" for i in range(20))
    p, q, r, x, y = line(1), line(2), line(3), "short line", "other line"
    rows = [(1, f"{y}\n{x}"), (2, "\n".join([p, x, q, x, r])), (3, "\n".join([p, x, q, x, r])), (4, "\n".join([line(4), x, line(5), y, line(6)])), (5, "\n".join(["own", line(4), x, line(5), y, line(6)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == dict(rows) | {3: "", 5: "own"}


def test_patience_aligns_in_order_and_finds_unique_lines():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(12) for _ in range(rng.randrange(20))]
        b = [rng.randrange(12) for _ in range(rng.randrange(20))]
        got = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
        assert len(got) <= longest(a, b)
    a, b = list(range(30)), [*range(100, 110), *range(5, 25), *range(200, 203)]
    assert line_dedup.patience(a, b) == [(i, i + 5) for i in range(5, 25)]
    assert len(line_dedup.patience([1] * 7, [1] * 5)) == 5
    assert len(line_dedup.patience([1, 2] * 4, [2, 1] * 4)) >= 4


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def lines_brute(rows, least):
    """Texts after deletion by definition: lines in ``least`` consecutive words' worth of lines that an earlier document has."""
    split = lambda t: [x.strip() for x in (t or "").split("\n") if x.strip()]
    out = []
    for i, t in rows:
        mine, gone = split(t), set()
        for other, theirs in rows:
            if i is None or t is None or other is None or theirs is None or other >= i:
                continue
            theirs = split(theirs)
            for p in range(len(mine)):
                for q in range(len(theirs)):
                    if p and q and mine[p - 1] == theirs[q - 1]:
                        continue  # begins further up
                    n = 0
                    while p + n < len(mine) and q + n < len(theirs) and mine[p + n] == theirs[q + n]:
                        n += 1
                    if sum(len(x.split()) for x in mine[p : p + n]) >= least:
                        gone |= set(range(p, p + n))
        n, kept = 0, []
        for x in (t or "").split("\n"):
            if not x.strip() or n not in gone:
                kept.append(x)
            n += bool(x.strip())
        out.append((i, None if t is None else "\n".join(kept)))
    return out


def test_lines_equal_brute_force(spark):
    shared = [words(k, 20) for k in range(12)]
    rng = random.Random(5)
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(10)
            parts += shared[a : a + rng.randrange(1, 4)] if rng.random() < 0.5 else [words(1000 + i, 15), "", "short line"]
        rows.append((i, "\n".join(parts)))
    small = ["a", "b b", "c c c", "d " * 30, "e " * 49]
    rows += [(60 + k, "\n".join(rng.choice(small) for _ in range(rng.randrange(40)))) for k in range(30)]  # frequent lines, repeats, moved blocks
    rows += [(100, None), (101, ""), (None, rows[0][1]), (None, None), (5, rows[5][1]), (5, rows[6][1]), (102, rows[3][1]), (103, "\n".join([shared[0]] * 400)), (104, "\n".join([shared[0]] * 300))]
    got = line_dedup.dedup_lines(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "n", "line", "component_id", "row", "version", "_cut"]
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(lines_brute(rows, line_dedup.MIN_WORDS), key=key)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_one_line_of_each_of_many_donors_is_no_passage(spark):
    lines = [words(300 + k, 30) for k in range(6)]
    rows = [*enumerate(lines), (7, "\n".join(lines)), (8, "\n".join(reversed(lines))), (9, "\n".join([lines[2], lines[3], "own", lines[0]]))]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(rows) | {9: "own\n" + lines[0]}  # two lines in a row are document 7's


def test_passages_that_moved_are_found_by_the_second_alignment():
    lines = {p: p for p in range(12)}
    count = dict.fromkeys(lines, 20)
    moved = [(0, 3, 30), (1, 3, 31), (6, 3, 10), (7, 3, 11)]
    assert line_dedup.passages(moved, lines, count, 50, exact=False) == {0, 1, 2, 3, 6, 7, 8, 9}
    in_order = [(0, 3, 10), (6, 3, 30)]
    assert line_dedup.passages(in_order, lines, count, 50, exact=False) == {0, 1, 2, 6, 7, 8}


def test_what_goes_is_what_patience_aligns(monkeypatch):
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([bytes([rng.randrange(30)]) for _ in range(rng.randrange(40))] for _ in range(2))
        assert line_dedup.align(a, b) == set(a) & set(b)
    made = []
    monkeypatch.setattr(line_dedup, "patience", lambda a, b, real=line_dedup.patience: made.append(1) or real(a, b))
    items = [k.to_bytes(2, "big") for k in range(900)]
    mixed = rng.sample(items, len(items))
    for other in (items[::-1], mixed, [*mixed, *items[::-1]]):
        made.clear()
        assert line_dedup.align(items, other) == set(items) and len(made) <= 2 * 30 + 2
    monkeypatch.setattr(line_dedup, "patience", lambda a, b: [])
    lines = dict(enumerate(range(6)))
    assert line_dedup.passages([(0, 3, 10), (1, 3, 11)], lines, dict.fromkeys(lines, 20), 50) == set()


def test_windows_are_least_and_stay_in_stretches():
    at, count = np.array([0, 1, 2, 5, 6, 7, 8]), np.array([30, 30, 30, 10, 60, 1, 2])
    assert line_dedup.windows_of(at, count, 50) == [(0, 2), (1, 3), (3, 5), (4, 5), (4, 6), (4, 7)]


def test_clashing_names_pass_through_the_line_stage(spark):
    rows = [(1, words(1, 60), 7, "a"), (2, words(1, 60), 8, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cut long, _id string").withColumnRenamed("cut", "_runs")
    got = {r.doc_id: (r.text, r["_runs"], r["_id"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (rows[0][1], 7, "a"), 2: ("", 8, "b")}


def test_spans_tell_what_went(spark):
    passage = words(1, 30) + "\n" + words(2, 30)
    rows = [(1, "a first line\n" + passage), (2, words(9, 10) + "\n" + passage + "\nthe end"), (3, "clean text")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got[1].text == rows[0][1] and got[3].text == "clean text" and got[1]["_cut"] is None
    assert got[2].text == words(9, 10) + "\nthe end"
    (span,) = got[2]["_cut"].spans
    assert rows[1][1][span.start : span.end] == passage + "\n" and got[2]["_cut"].partners == [1]


# ------------------------------------------------------------------ near duplicates


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_brute(rows):
    named = [(i, sets_of(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in named}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(named):
        for j, b in named[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    low = {i: find(i) for i, _ in named}
    return sorted(((i if i is not None else -1), len(sets_of(t)), low.get(i, -1), i is None or low[i] == i) for i, t in rows)


def edited(text, rate, rng):
    return " ".join(words(rng.random(), 1) if rng.random() < rate else w for w in text.split())


@pytest.mark.parametrize("large", [2_000, 5])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(near_dedup, "LARGE", large)
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = random.Random(7)
    rows = [(i, words(i, rng.randrange(1, 120))) for i in range(40)]
    base = words(999, 90)
    rows += [(100 + k, edited(base, 0.03, rng)) for k in range(60)]  # a group around the threshold
    common = words(998, 60)
    rows += [(200 + k, common + " " + words(5000 + k, 40)) for k in range(40)]  # share a passage, are no copies
    rows += [(300 + k, rows[3][1].upper() + " ") for k in range(30)]
    rows += [(400, None), (401, ""), (402, " \n"), (403, "two words"), (404, "TWO  words"), (None, base), (7, rows[7][1]), (9, rows[12][1]), (500, words(3, 30_000))]
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    out = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1, r.kept) for r in got)
    assert out == near_brute(rows)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    assert near_dedup.near_duplicates(frame(spark, [(1, None), (2, "")])).where("kept").count() == 2


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:750], rng.integers(0, 2**63, 250).astype(np.uint64)])
    rows = near_dedup.sketch([a, b, a[:1], a[:3]])
    assert (rows != near_dedup.EMPTY).all()
    assert abs((rows[0] == rows[1]).mean() - 750 / 1250) < 0.12
    assert (near_dedup.sketch([a[::-1].copy()])[0] == rows[0]).all()


def test_components(spark, tmp_path):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 440)] + [(500, 500 + k) for k in range(1, 60)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "cc"), "t").collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
