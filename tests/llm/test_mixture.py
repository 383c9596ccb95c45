import re
from collections import Counter, defaultdict

import pytest

from ledgerlake.llm import mixture
from tests.llm.helpers import docs, edge_docs, empty_docs, make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Share by weight; whatever is above its cap is reshared until none is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s] + 1e-9}
        if not over:
            for s in open_:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("source", [docs, edge_docs])
def test_report_against_brute_force(spark, source):
    df = source(spark)
    rows = df.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    target = brute_targets(sizes)
    got = mixture.mixture_report(df).collect()
    want = Counter((r["doc_id"], len(WORD.findall(r["text"] or "")), sizes[r["source"]], round(target[r["source"]], 6))
                   for r in rows)
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got) == want
    taken = defaultdict(int)
    by_target = defaultdict(float)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    for s in sizes:
        by_target[sizes[s], round(target[s], 6)] += target[s]
    for k, v in by_target.items():
        assert abs(taken[k] - v) <= len(sizes)  # whole words
    again = sorted(map(str, mixture.mixture_report(df).collect()))
    assert again == sorted(map(str, got))


def test_all_sources_capped_but_one(spark):
    """Small sources reach twice their size and the excess is reshared."""
    rows = [(i, "w " * (5 if i % 4 else 400), f"s{i % 4}") for i in range(80)]
    df = spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string")
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    target = brute_targets(sizes)
    got = mixture.mixture_report(df).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert any(t == 2 * sizes[s] for s, t in target.items())
    total = defaultdict(float)
    for s in sizes:
        total[sizes[s], round(target[s], 6)] += target[s]
    for r in got:
        assert r["sum(taken)"] == pytest.approx(total[r["source_size"], round(r["target"], 6)], abs=4)


def test_tree_splits_quotas_exactly(spark):
    q = spark.createDataFrame([(0, 100), (1, 37), (2, 1), (3, 0), (4, 900)], "rank int, n int")
    out = mixture.split_tree(q, 4).collect()
    per_source, per_shard = Counter(), Counter()
    for r in out:
        per_source[r["rank"]] += r["n"]
        per_shard[r["shard"]] += r["n"]
    assert per_source == Counter({0: 100, 1: 37, 2: 1, 4: 900})
    assert len(per_shard) == 16 and max(per_shard.values()) - min(per_shard.values()) <= 1
    big = [r["n"] for r in out if r["rank"] == 4]
    assert len(big) == 16 and min(big) > 35 and len(set(big)) > 1  # random, near 900 / 16


def test_documents_are_whole_rows_near_the_targets(spark):
    df = docs(spark, "/root/testdata/sf0.01")
    rows = {r["doc_id"]: r for r in df.collect()}
    mixed = mixture.mix_documents(df)
    assert mixed.schema == df.schema
    got = mixed.collect()
    assert all(r == rows[r["doc_id"]] for r in got)
    assert max(Counter(r["doc_id"] for r in got).values()) <= 2
    sizes, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows.values():
        n = len(WORD.findall(r["text"]))
        sizes[r["source"]] += n
        biggest[r["source"]] = max(biggest[r["source"]], n)
    for r in got:
        taken[r["source"]] += len(WORD.findall(r["text"]))
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= biggest[s]


def test_edges(spark):
    assert mixture.mixture_report(empty_docs(spark)).collect() == []
    assert mixture.mix_documents(empty_docs(spark)).collect() == []
    only_empty = make(spark, [(1, None), (2, "")])
    assert [(r["size"], r["target"], r["taken"]) for r in mixture.mixture_report(only_empty).collect()] == [(0, 0.0, 0)] * 2
    assert mixture.mix_documents(edge_docs(spark)).columns == edge_docs(spark).columns
