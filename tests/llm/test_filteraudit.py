"""The retracting stream against brute force, on tables and on planted cases."""

import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import filteraudit as fa
from tests.conftest import SF_ORACLE
from tests.llm.helpers import edge_docs, empty_docs, make

LABELS = "doc_id bigint, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
           "shapley"]


def brute_masks(rows, labels):
    """(part, mask, good, toxic) per row, straight from the filters' definitions."""
    out = []
    spaces = " \t\n\x0b\x0c\r"
    for doc_id, text, source in rows:
        text = text or ""
        words = "".join(" " if c in spaces else c for c in text).split(" ")
        words = [w for w in words if w]
        mask = 1 * (len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words))
        mask += 4 * (100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)) + 8 * any(c in "#$%&*|" for c in text)
        mask += 16 * any(i is not None and doc_id is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        flags = [(q, t) for i, q, t in labels if i == doc_id and i is not None]
        out.append((source or "", mask, any(q == 1 for q, _ in flags), any(t == 1 for _, t in flags)))
    return out


def brute_audit(masks):
    out = set()
    for part in {m[0] for m in masks}:
        own = [m[1:] for m in masks if m[0] == part]
        steps, shares = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [m for m in left if m[0] & bit]
                left = [m for m in left if not m[0] & bit]
                fails = sum(bool(m[0] & bit) for m in own)
                shares[letter] += len(gone)
                steps.append((letter, part, "".join(order), step, len(left), len(gone), fails - len(gone),
                              sum(m[0] == bit for m in own), sum(m[1] for m in gone), sum(m[2] for m in gone)))
        out |= {(*s[1:], shares[s[0]]) for s in steps}
    return out


def run(spark, docs, labels, folder, files, batches):
    docs.repartition(files, F.rand(7)).write.parquet(str(folder))
    got = fa.filter_audit(spark, str(folder), spark.createDataFrame(labels, LABELS), batches).select(COLUMNS).collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def plain(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]


def test_copies_whose_smaller_ids_come_later(spark, tmp_path):
    """Files come by descending id, one a batch: every batch retracts."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(i, long if i % 2 else f"short {i % 3}") for i in range(12, 0, -1)]
    docs, folder = make(spark, rows), tmp_path / "documents"
    for i, _ in rows:
        docs.where(F.col("doc_id") == i).coalesce(1).write.mode("append").parquet(str(folder))
    labels = [(1, 1, 0), (3, 0, 1), (3, 1, None), (7, 1, 1), (None, 1, 1), (2, None, None)]
    counters = fa.mask_counters(spark, str(folder), spark.createDataFrame(labels, LABELS), batches=12)
    masks = brute_masks([(i, t, "s") for i, t in rows], labels)
    assert {(r.part, r.mask, r.good, r.toxic): r.n for r in counters.collect()} == {m: masks.count(m) for m in masks}
    assert sum(bool(m[1] & 16) for m in masks) == 12 - 4


@pytest.mark.parametrize("batches", [1, 3])
def test_edge_rows_against_brute_force(spark, tmp_path, batches):
    docs = edge_docs(spark)
    labels = [(4, 1, 0), (4, 1, 1), (1, 0, 1), (None, 1, 1), (8, 1, None)]
    assert run(spark, docs, labels, tmp_path / "d", 5, batches) == brute_audit(brute_masks(plain(docs), labels))


def test_empty_table(spark, tmp_path):
    empty_docs(spark).write.parquet(str(tmp_path / "d"))
    assert fa.filter_audit(spark, str(tmp_path / "d"), spark.createDataFrame([], LABELS)).collect() == []


def test_words_split_by_windows_as_at_once():
    raw = ("aa bb\tcc\x0bdd  ee\n" * 40 + "tail").encode()
    for window in (1, 7, 64, 10_000):
        assert fa.count_words(raw, window) == (201, 6)
    assert fa.count_words(b"") == (0, 0)
    assert fa.count_words("a b\x85c \x1c".encode()) == (2, 2)   # other spaces part no words


def test_hot_text_leaves_a_task_as_a_few_rows(spark):
    """A text with 20,000 copies sends its key one candidate per task."""
    rows = spark.range(20000, numPartitions=4).select(
        F.lit(b"k" * 32).alias("key"), F.col("id").alias("doc_id"), F.lit("s").alias("part"), F.lit(1).alias("mask"),
        F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    assert fa.combine(rows, 8).where("key IS NOT NULL").count() == 4


def test_oracle_agrees_on_the_table(spark):
    table = f"{SF_ORACLE}/documents.parquet"
    got = fa.filter_audit(spark, table, spark.read.parquet(f"{SF_ORACLE}/labels.parquet")).select(COLUMNS).collect()
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_ORACLE}/{name}.parquet'")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({fa.oracle_sql()})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
