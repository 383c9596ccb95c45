import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import decontaminate as dc
from ledgerlake.llm.common import PUNCTUATED, text_buffers, word_hashes
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, edge_docs, empty_docs, make

WORD = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def items(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/benchmark.parquet")


def brute_scores(texts, passage):
    """BM25 of a passage's distinct words against every item, over the item's own score."""
    docs_ = [Counter(words(t)) for t in texts]
    docs_ = [d for d in docs_]
    n, avg = sum(bool(d) for d in docs_), np.mean([sum(d.values()) for d in docs_ if d])
    df = Counter(w for d in docs_ for w in d)
    out = []
    for d in docs_:
        size = sum(d.values())
        weight = {w: math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / avg))
                  for w, tf in d.items()}
        out.append(sum(v for w, v in weight.items() if w in passage) / sum(weight.values()) if weight else 0.0)
    return out


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.5])
@pytest.mark.parametrize("block", [1, 4, 32])
def test_wand_retrieves_everything_above_the_threshold(spark, threshold, block, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", block)
    bench = items(spark)
    rows = bench.orderBy("item_id").collect()
    ix, = dc.indexes(bench)
    texts = [r["text"] for r in docs(spark).limit(60).collect()] + [rows[3]["text"], rows[5]["text"][:80]]
    import pyarrow as pa
    h, first = word_hashes(*text_buffers(pa.array(texts)), PUNCTUATED)
    pairs, sets = [], []
    for i, t in enumerate(texts):
        own = h[first[i]:first[i + 1]][:256]
        sets.append(set(words(t)[:256]))
        pos = np.minimum(np.searchsorted(ix.hashes, own), len(ix.hashes) - 1)
        pairs += [(i, int(ix.number[p])) for p, x in zip(pos, own) if ix.hashes[p] == x]
    pairs = np.array(sorted(set(pairs)))
    w, item, score = dc.retrieve(ix, pairs[:, 0], pairs[:, 1], threshold)
    got = {(a, ix.item_id[b]): s for a, b, s in zip(w.tolist(), item.tolist(), score.tolist())}
    want = {}
    for i, s in enumerate(sets):
        for r, x in zip(rows, brute_scores([r["text"] for r in rows], s)):
            if x >= threshold:
                want[i, r["item_id"]] = x
    assert got.keys() == want.keys() and want
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_planted_items_are_found_and_clean_documents_left_alone(spark):
    sf = "/root/testdata/sf0.01"
    df, bench = docs(spark, sf), items(spark, sf)
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(df, bench).collect()}
    flat = lambda t: " ".join(words(t))
    bodies = {r["doc_id"]: f" {flat(r['text'])} " for r in df.collect()}
    want = {(i, r["item_id"]) for r in bench.collect() for i, t in bodies.items() if f" {flat(r['text'])} " in t}
    assert want <= got and want
    assert {i for i, _ in got} == {i for i, _ in want}
    left = {r["doc_id"] for r in dc.drop_leaks(df, bench).collect()}
    assert left == set(bodies) - {i for i, _ in got}


def test_both_question_and_answer_are_needed(spark):
    rng = np.random.default_rng(1)
    w = lambda n, p: " ".join(f"{p}{x}" for x in rng.integers(0, 10 ** 6, n))
    q, a = w(30, "q"), w(12, "a")
    bench = spark.createDataFrame([(1, f"{q}. {a}."), (2, None), (3, ""), (4, "one two"), (None, f"{w(20, 'z')}")],
                                  "item_id long, text string")
    pad = lambda: w(300, "p")
    df = make(spark, [(1, f"{pad()} {q}. {a}. {pad()}"), (2, f"{pad()} {q}. {pad()}"), (3, f"{pad()} {a}. {pad()}"),
                      (4, pad()), (5, f"{pad()} {q.upper()}, {a} {pad()}"), (6, "so One, TWO!"), (7, None),
                      (8, f"{pad()} {q}. changed {a}. {pad()}")])
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(df, bench).collect()}
    assert got == {(1, 1), (5, 1), (6, 4), (8, 1)}


def test_items_at_any_place_of_a_long_text(spark):
    rng = np.random.default_rng(2)
    item = " ".join(f"k{x}" for x in rng.integers(0, 10 ** 6, 60))
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    rows = []
    for i, at in enumerate(range(0, 400, 13)):
        pad = [f"f{x}" for x in rng.integers(0, 10 ** 6, 400)]
        rows.append((i, " ".join(pad[:at] + [item] + pad[at:])))
    assert {r["doc_id"] for r in dc.find_leaks(make(spark, rows), bench).collect()} == set(range(len(rows)))


def test_groups_of_items(spark, monkeypatch):
    bench, df = items(spark), docs(spark)
    want = sorted(map(tuple, dc.find_leaks(df, bench).select("doc_id", "item_id").collect()))
    monkeypatch.setattr(dc, "GROUP_ITEMS", 7)
    assert len(dc.indexes(bench)) > 3
    assert sorted(map(tuple, dc.find_leaks(df, bench).select("doc_id", "item_id").collect())) == want


def test_edges(spark):
    bench = items(spark)
    assert dc.find_leaks(empty_docs(spark), bench).collect() == []
    assert dc.find_leaks(docs(spark), bench.limit(0)).collect() == []
    edge = edge_docs(spark)
    assert dc.find_leaks(edge, bench).collect() == []
    kept = dc.drop_leaks(edge, bench)
    assert kept.schema == edge.schema and kept.count() == edge.count()
