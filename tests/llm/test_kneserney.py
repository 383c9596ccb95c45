import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerlake.llm import kneserney as kn
from tests.llm.helpers import docs, edge_docs, empty_docs, make

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + ["</s>"]


class Brute:
    def __init__(self, texts):
        self.c, self.big = Counter(), Counter()
        for t in texts:
            before = "<s>"
            for w in tokens(t):
                self.c[w] += 1
                self.big[before, w] += 1
                before = w
        self.n, self.v, self.k = sum(self.c.values()), len(self.c), Counter(w for _, w in self.big)
        count = lambda xs: [sum(x == i for x in xs) for i in (1, 2, 3, 4)]
        self.d, self.e = kn.discounts(*count(self.big.values())), kn.discounts(*count(self.k.values()))
        self.after = defaultdict(list)
        for (h, _), n in self.big.items():
            self.after[h].append(n)
        one, two = (sum(x == i for x in self.k.values()) for i in (1, 2))
        self.spare = (self.e[0] * one + self.e[1] * two + self.e[2] * (self.v - one - two)) / len(self.big) if self.big else 1.0

    def cut(self, n, d):
        return d[min(n, 3) - 1] if n else 0.0

    def p1(self, w):
        k = self.k[w]
        return (max(k - self.cut(k, self.e), 0) / len(self.big) if self.big else 0) + self.spare / (self.v + 1)

    def p(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.p1(w)
        n, total = self.big[h, w], sum(seen)
        gamma = sum(self.cut(x, self.d) for x in seen) / total
        return max(n - self.cut(n, self.d), 0) / total + gamma * self.p1(w)

    def row(self, t):
        ws = tokens(t)
        base = sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in ws)
        return len(ws), sum(self.c[w] > 0 for w in ws), base, sum(math.log10(self.p(h, w)) for h, w in zip(["<s>"] + ws, ws))


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("source", [docs, edge_docs, lambda s: make(s, [(1, "a a a b"), (2, "b a"), (3, "c")])])
def test_scores_against_brute_force(spark, source):
    df = source(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    model = Brute([t for i, t in rows if not out(i)])
    want = defaultdict(list)
    for i, t in rows:
        want[i].append((out(i), *model.row(t)))
    got = kn.language_model_report(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["train_tokens"] == model.n
        mine = (r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"])
        assert any(mine[:3] == w[:3] and mine[3:] == pytest.approx(w[3:]) for w in want[r["doc_id"]]), (mine, want[r["doc_id"]])


def test_probabilities_sum_to_one(spark):
    brute = Brute([r["text"] for r in docs(spark).limit(30).collect()])
    for h in ["<s>", *list(brute.c)[:20], "never seen"]:
        assert sum(brute.p(h, w) for w in brute.c) + brute.p(h, "\0unknown") == pytest.approx(1)


def test_counts_over_255_are_exact(spark):
    rows = [(i, "the cat " * 50) for i in range(40)]
    model = Brute([t for i, t in rows if not out(i)])
    got = {r["doc_id"]: r["score"] for r in kn.language_model_report(make(spark, rows)).collect()}
    assert got[0] == pytest.approx(model.row(rows[0][1])[3])


def test_held_out_text_is_less_likely_but_better_than_the_base(spark):
    rows = kn.language_model_report(docs(spark, "/root/testdata/sf0.01")).collect()
    mean = lambda rs, c: sum(r[c] for r in rs) / sum(r["n_tokens"] for r in rs)
    held, seen = [r for r in rows if r["held_out"]], [r for r in rows if not r["held_out"]]
    assert mean(seen, "score") > mean(held, "score") > mean(held, "base_score")


def test_empty(spark):
    assert kn.language_model_report(empty_docs(spark)).collect() == []


def test_packing():
    import numpy as np
    v = np.array([0, 1, 2 ** 48 - 1, 123456789012], np.uint64)
    assert kn.unpack48(kn.pack48(v)).tolist() == v.tolist() and kn.unpack48(b"").tolist() == []
