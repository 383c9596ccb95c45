"""Rows that every operator must handle, and readers for the small tables."""

from pyspark.sql import types as T

from tests.conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       # names that operators use for themselves
                       T.StructField("size", T.StringType()), T.StructField("rank", T.StringType()),
                       T.StructField("uid", T.StringType()), T.StructField("hub", T.StringType()),
                       T.StructField("score", T.StringType()), T.StructField("_block", T.StringType()),
                       T.StructField("_thash", T.StringType()),
                       T.StructField("Shard key", T.StringType())])
CLASH = ("x",) * 8

LONG = " ".join(f"word{i % 977}q{i % 13}" for i in range(40000))
EDGE = [
    (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n ", None, "b", 4), (4, "Hello world", "en", "a", 11),
    (4, "Hello world", "en", "a", 11), (5, "Hello world", "de", "b", 11), (None, "no id here", "fr", "a", 10),
    (None, None, None, None, None), (7, "ünïcödé ✓ text 漢字 😀 end", "es", "c", 20), (8, LONG, "en", "b", len(LONG)),
    (9, "!!! ### 123", "en", "a", 11), (10, "z" * 5000, "en", "c", 5000),
    (12, "same id, first text", "en", "a", 1), (12, "same id, other text", "en", "a", 1),
]


def edge_docs(spark):
    return spark.createDataFrame([r + CLASH for r in EDGE], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def docs(spark, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")


def make(spark, rows):
    """Documents from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) + CLASH for i, t in rows], SCHEMA)
