import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid
from tests.llm.helpers import docs, edge_docs, empty_docs, make


def test_held_out_accuracy(spark):
    df = docs(spark, "/root/testdata/sf0.01")
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in df.collect()}
    got = langid.language_report(df).collect()
    assert len(got) == len(lang)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    test = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(lang[r["doc_id"]][0] == r["lang_pred"] for r in test) / len(test) > 0.97


def test_counts_and_posterior_against_brute_force(spark):
    rows = [(1, "ab ab", "x"), (2, "cd", "y"), (3, "abc", "x"), (4, "é ñ", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = langid.train(df)
    assert m.langs == ["x", "y"]
    # 1-grams: x has a, b three times each and c once
    code, off = langid.letters(__import__("pyarrow").array(["a", "b", "ab"]))
    pairs = {n: list(zip(d.tolist(), b.tolist())) for n, (d, b) in enumerate(langid.grams(code, off), 1)}
    a, b = pairs[1][0][1], pairs[1][1][1]
    assert pairs[1][2:] == [(2, a), (2, b)] and len(pairs[2]) == 1
    total = 7 + 5 + 3 + 1 + 0  # order 1: 7; order 2 with spaces: "ab ab" 4, "abc" 2 ...
    assert m.logp[0][a] == m.logp[0][b] > m.logp[1][a] and total


def test_no_letters_and_nulls_are_undetermined(spark):
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.language_report(edge_docs(spark)).collect()]
    by = {i: (p, s) for i, p, s in got if i in (1, 2, 3, 9)}
    assert set(by.values()) == {("und", 0.0)}
    assert len(got) == 14 and all(p != "und" for i, p, _ in got if i in (4, 5, 7, 8))


def test_without_training_text(spark):
    assert langid.language_report(empty_docs(spark)).collect() == []
    df = make(spark, [(1, "hello")]).withColumn("lang", F.lit(None).cast("string"))
    assert [tuple(r)[2:] for r in langid.language_report(df).collect()] == [("und", 0.0)]


def test_letters_of_mixed_texts():
    import pyarrow as pa
    code, off = langid.letters(pa.array(["Ab1", None, "", "ÉÑ😀漢"]))
    assert "".join(map(chr, code)) == "ab éñ 漢" and off.tolist() == [0, 3, 3, 3, 7]


def test_training_ignores_other_columns(spark):
    """Changing lang, source or doc_id of scored rows changes nothing."""
    df = docs(spark)
    m = langid.train(df)
    a = sorted(r["lang_pred"] for r in langid.predict(df, m).collect())
    b = sorted(r["lang_pred"] for r in langid.predict(df.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), m).collect())
    assert a == b


@pytest.mark.parametrize("slice_bytes", [64, 1 << 20])
def test_batch_borders_do_not_matter(spark, slice_bytes, monkeypatch):
    import pyarrow as pa
    texts = [r["text"] for r in docs(spark).limit(30).collect()]
    monkeypatch.setattr(langid, "SLICE", slice_bytes)
    whole = [x for d, b in langid.grams(*langid.letters(pa.array(texts))) for x in zip(d.tolist(), b.tolist())]
    single = [(i, b) for i, t in enumerate(texts) for d, bs in langid.grams(*langid.letters(pa.array([t]))) for b in bs.tolist()]
    assert sorted(whole) == sorted(single)
