import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import multiset
from tests.llm.helpers import docs, edge_docs, empty_docs, make


def brute(rows):
    """(doc_id, n_chars, sha of the edited text), rows by falling (doc_id, text)."""
    rows = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("source", [docs, edge_docs])
def test_edited_text_against_brute_force(spark, source):
    df = source(spark)
    got = multiset.fingerprint_report(df).collect()
    assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got], key=str) == \
        brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


@pytest.mark.parametrize("buckets", [1, 2, 7, 50])
def test_next_row_for_any_number_of_ranges(spark, buckets):
    df = docs(spark).select("doc_id", "text")
    got = {r["doc_id"]: r["nxt"]["doc_id"] for r in multiset.with_next(df, buckets).collect()}
    ids = sorted(got, reverse=True)
    assert [got[i] for i in ids] == ids[1:] + ids[:1]


def test_equal_texts_and_order(spark):
    df = make(spark, [(1, "One. Two.\nThree"), (2, "Three\nTwo.\nOne."), (3, "One. Two.\nThree"), (4, "One. Two. Two.\nThree")])
    fp = {r["doc_id"]: r["fingerprint"] for r in multiset.fingerprint_report(df).collect()}
    assert fp[1] == fp[2] == fp[3] != fp[4]


def test_insert_and_delete(spark):
    f = lambda s: multiset.fingerprint(F.lit(s))
    row = spark.range(1).select(f("a\nb\nc").alias("abc"), f("a\nb").alias("ab"), f("c").alias("c"), f("b\nc\na").alias("bca")) \
        .select("*", multiset.insert(F.col("ab"), F.col("c")).alias("plus"), multiset.delete(F.col("abc"), F.col("c")).alias("minus")).first()
    assert row["plus"] == row["abc"] == row["bca"] and row["minus"] == row["ab"]


def test_likeness_follows_shared_paragraphs(spark):
    lines = [f"line number {i} of the text" for i in range(200)]
    other = [f"something else {i}" for i in range(200)]
    texts = {0.0: other, 0.5: lines[:100] + other[:100], 0.9: lines[:180] + other[:20], 1.0: lines[::-1]}
    for share, t in texts.items():
        got = spark.range(1).select(multiset.likeness(multiset.fingerprint(F.lit("\n".join(lines))),
                                                      multiset.fingerprint(F.lit("\n".join(t))))).first()[0]
        assert got == pytest.approx(share, abs=0.25) and (got == 1.0) == (share == 1.0)


def test_edited_is_nearer_than_next(spark):
    r = multiset.fingerprint_report(docs(spark)).agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert r["e"] > 0.35 and r["n"] < 0.15


def test_empty(spark):
    assert multiset.fingerprint_report(empty_docs(spark)).collect() == []
    one = multiset.fingerprint_report(make(spark, [(1, "")])).first()
    assert (one["n_chars"], one["near_edited"], one["near_next"]) == (0, 1.0, 1.0)
