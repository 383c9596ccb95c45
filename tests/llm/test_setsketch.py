import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerlake.llm import setsketch
from ledgerlake.llm.components import connected_components
from tests.llm.helpers import docs, edge_docs, empty_docs, make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(text, width):
    w = WORD.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width=4):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    shared = defaultdict(int)
    for group in where.values():
        for k, i in enumerate(group):
            for j in group[k + 1:]:
                shared[i, j] += 1
    for (i, j), n in shared.items():
        if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return sorted([(doc_id, len(sets[i]), least.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)],
                  key=str)


def report(df, width=4):
    got = setsketch.near_duplicate_report(df, width, 80).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str)


@pytest.mark.parametrize("source", [docs, edge_docs, lambda s: docs(s, "/root/testdata/sf0.01")])
def test_components_against_brute_force(spark, source):
    df = source(spark)
    assert report(df) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_chains_groups_and_borderline_pairs(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(5000)]
    base = [words[i] for i in rng.integers(0, 5000, 120)]
    rows = []
    for i in range(60):  # near copies of near copies: a chain whose ends are unlike
        base = list(base)
        base[rng.integers(0, 120)] = f"new{i}"
        rows.append((1000 - i, " ".join(base)))
    core = [words[i] for i in rng.integers(0, 5000, 100)]
    for i in range(300):  # a large group, edits of one text
        t = list(core)
        for _ in range(rng.integers(0, 4)):
            t[rng.integers(0, 100)] = f"edit{rng.integers(0, 10 ** 9)}"
        rows.append((2000 + i, " ".join(t)))
    for i in range(60):  # a shared passage makes texts alike, but not enough
        rows.append((4000 + i, " ".join(core[:70] + [f"own{i}x{j}" for j in range(25)])))
    rows += [(5000, "Short One"), (5001, "short one"), (5002, "short"), (5003, None)]
    assert report(make(spark, rows)) == brute(rows)


def test_five_word_shingles(spark):
    df = docs(spark)
    assert report(df, 5) == brute([(r["doc_id"], r["text"]) for r in df.collect()], 5)


def test_one_document_of_each_group_stays(spark):
    df = docs(spark)
    out = setsketch.drop_near_duplicates(df, 5)
    assert out.columns == df.columns
    want = {d for d, n, c in brute([(r["doc_id"], r["text"]) for r in df.collect()], 5) if d == c}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want)
    edge = setsketch.drop_near_duplicates(edge_docs(spark), 5)
    assert edge.columns == edge_docs(spark).columns
    ids = sorted(str(r["doc_id"]) for r in edge.collect())
    assert ids == sorted(map(str, [1, 2, 3, 4, None, None, 7, 8, 9, 10, 12, 12]))


def test_empty(spark):
    assert report(empty_docs(spark)) == []
    assert setsketch.drop_near_duplicates(empty_docs(spark)).collect() == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[400:]
    regs = setsketch.exponents(setsketch.minima([a, b, np.union1d(a, b), a[:1], np.zeros(0, np.uint64)]))
    assert (setsketch.merge(regs[0], regs[1]) == regs[2]).all()
    assert not regs[4].any()
    many = [(pool[:1000], pool[k:1000 + k]) for k in range(0, 900, 60)]
    ra = setsketch.exponents(setsketch.minima([x for x, _ in many]))
    rb = setsketch.exponents(setsketch.minima([y for _, y in many]))
    n = np.full(len(many), 1000.0)
    true = np.array([(1000 - k) / (1000 + k) for k in range(0, 900, 60)])
    assert np.abs(setsketch.likelihood_jaccard(ra, rb, n, n) - true).max() < 6 * 0.5 / setsketch.REGISTERS ** 0.5


def test_minima_are_exponential():
    """Means of the minima over sets of n elements are 1 / n."""
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, 50, dtype=np.uint64) for _ in range(200)]
    low = setsketch.minima(sets)
    assert low.mean() * 50 == pytest.approx(1, abs=0.03) and low.std() * 50 == pytest.approx(1, abs=0.05)


def test_connected_components(spark):
    edges = [(2, 1), (3, 2), (10, 3), (20, 19), (19, 30), (7, 7), (40, 41), (41, 42), (42, 43), (43, 40)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {2: 1, 3: 1, 10: 1, 20: 19, 30: 19, 41: 40, 42: 40, 43: 40}
    path = [(i, i + 1) for i in range(200)]
    got = connected_components(spark.createDataFrame(path, "a long, b long")).collect()
    assert {r["component"] for r in got} == {0} and len(got) == 200


def test_one_of_a_group_stays_without_distinct_ids(spark):
    words = [f"word{i}" for i in range(200)]
    first, second, third = (" ".join(words[:-1] + [w]) for w in ("a", "b", "c"))
    other = " ".join(f"other{i}" for i in range(200))
    for ids in ((None, None, None), (7, 7, 7), (7, 7, 9), (7, None, None)):
        df = make(spark, [*zip(ids, (first, second, third)), (ids[0], first), (ids[1], other)])
        out = [(r["doc_id"], r["text"]) for r in setsketch.drop_near_duplicates(df, 5).collect()]
        assert len(out) == 2 and (ids[1], other) in out, ids
        assert {i for i, t in out if t != other} == {ids[0]}
