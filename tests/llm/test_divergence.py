"""One-hot products against term-by-term pricing."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import divergence as dv
from tests.conftest import SF_ORACLE
from tests.llm.helpers import LONG, edge_docs, empty_docs

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(lower)))) for lang, source, text in rows]
    out = set()
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in d[2])
        kept = sorted(t for t, n in seen.items() if n >= 10)
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, c in own:
            counts[s].update(c)
        every = sum(counts.values(), Counter())

        def prices(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        q, p = prices(every), {s: prices(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1)
                        if part == "pair" or i <= 10}
    return out


def report(docs):
    got = [tuple(r) for r in dv.divergence_report(docs).select(COLUMNS).collect()]
    assert len(got) == len(set(got))
    return set(got)


def plain(docs):
    return [tuple(r) for r in docs.select("lang", "source", "text").collect()]


def random_rows(seed, n=160):
    """A hot source and term, ties, groups without terms or without kept ones."""
    rng = random.Random(seed)
    words = ["the", *(f"{a}{b}" for a in "éaZz" for b in "xyñ漢😀")]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["hot"] * 4 + ["s1", "s2", "é", None]),
             " ".join(rng.choices(words, weights=[9, *range(1, len(words))], k=rng.randrange(0, 30)))) for _ in range(n)]
    return rows + [("en", "bare", "12 ##"), ("en", "rare", "unseen words"), ("fr", "lone", "a b"), ("fr", "other", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = random_rows(seed)
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "lang string, source string, text string, p string, n string")
    assert report(docs.repartition(5)) == brute(rows)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    many = docs.withColumn("doc_id", F.explode(F.sequence(F.lit(1), F.lit(11))))   # all terms reach ten documents
    assert report(docs) == brute(plain(docs))
    assert report(many) == brute(plain(many))


def test_empty_table(spark):
    assert report(empty_docs(spark)) == set()


def test_blocks_and_tiles_change_nothing(spark, monkeypatch):
    rows = random_rows(3)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    want = brute(rows)
    monkeypatch.setattr(dv, "BLOCK_TERMS", 2)
    monkeypatch.setattr(dv, "BLOCK_COLUMNS", 3)
    monkeypatch.setattr(dv, "MAX_HELD", 5)
    assert report(docs) == want


def test_block_product_holds_the_joint_tables():
    rng = np.random.default_rng(4)
    row, group = np.divmod(rng.permutation(300)[:190], 6)
    p0 = np.array([3, 5, 7, 11, 13, 17])[group]
    p = p0 + rng.integers(1, 4, len(row)) * 100
    want = Counter()
    f = lambda a, b: (a - b) ** 2 // (a + b)
    for i in range(len(row)):
        for j in range(len(row)):
            if row[i] == row[j] and group[i] < group[j]:
                want[group[i], group[j]] += f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
    for width in (2, 7, 512):
        a, b, value = dv.block_values(row, group, p, p0, width)
        got = Counter()
        for x, y, v in zip(a, b, value):
            got[x, y] += v
        assert got == want


def test_terms_split_by_windows_as_at_once():
    raw = (LONG[:3000] + " ÉX-éx_ÉX").encode()
    want = (Counter(), Counter())
    dv.add_terms(raw, *want)
    for window in (1, 50):
        got = (Counter(), Counter())
        dv.add_terms(raw, *got, window)
        assert got == want
    assert want[0]["Éx".encode()] == 2 and want[1]["Éx".encode()] == 1


def test_prices_are_exact_beyond_64_bits(spark):
    n, total, kept = 90_000_000_000_000, 7 * 10 ** 15 + 3, 123_456_789
    row = spark.createDataFrame([(n, total, kept)], "n bigint, t bigint, v bigint").select(
        dv.price(F.col("n"), F.col("t"), F.col("v")).alias("p")).first()
    assert row["p"] == 1 + 10 ** 9 * (n + 2) // (total + 2 * kept)


def test_oracle_agrees_on_the_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_ORACLE}/documents.parquet'")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({dv.oracle_sql()})").fetchall()
    assert report(spark.read.parquet(f"{SF_ORACLE}/documents.parquet")) == set(want)
