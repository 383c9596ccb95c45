"""Homomorphic multiset fingerprints of documents (operator 7).

A document is the multiset of its paragraphs (lines, and sentences of long
lines). Each paragraph is hashed to a wide vector of 126 bits, and the
fingerprint is the sum of these vectors modulo 2**20 with the paragraph
count: it does not depend on the order, and paragraphs are inserted or
deleted by adding or subtracting their vectors.

Read as +1/-1 the lanes are a sketch of the multiset, so two fingerprints
also tell how alike the documents are: the mean product of the lanes over the
mean square estimates 2 * shared / (both), exactly 1 for equal multisets.

Three lanes share one 63-bit integer, 21 bits each: 20 for the value and one
that takes the carry and is masked away. Only DataFrame functions.

Defined results: null text is empty; empty texts have the zero fingerprint,
alike to each other (1) and unlike anything else (0); an empty table gives no
rows; rows with equal doc_id follow each other by text, descending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import range_bucket, shuffle_partitions, take_columns

HASHES = 2                                   # 63 lanes each
SHIFTS = 21
EACH = 1 | 1 << SHIFTS | 1 << 2 * SHIFTS     # lowest bit of the three lanes
MODULUS = 1 << 20
KEEP = (MODULUS - 1) * EACH
WIDE = HASHES * SHIFTS
PARAGRAPH = r"[\n\r]+|(?<=[.!?]) +"


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, PARAGRAPH, -1), lambda p: p != "")


def fingerprint(text: Column) -> Column:
    """array<long>: WIDE integers of three lanes, then the paragraph count."""
    # the salt goes first: behind the paragraph it would only rehash the first word
    parts = F.transform(paragraphs(text), lambda p: F.struct(
        F.xxhash64(p).alias("a"), F.xxhash64(F.lit("second word"), p).alias("b")))
    lanes = F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda i: F.lit(0).cast("long"))
    start = F.struct(lanes.alias("v"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, h: Column) -> Column:
        def lane(v: Column, i: Column) -> Column:
            word = F.when(i < SHIFTS, h["a"]).otherwise(h["b"])
            bits = F.call_function("shiftrightunsigned", word, i % SHIFTS).bitwiseAND(F.lit(EACH))
            return (v + bits).bitwiseAND(F.lit(KEEP))
        return F.struct(F.transform(acc["v"], lane).alias("v"), (acc["n"] + 1).alias("n"))
    return F.aggregate(parts, start, add, lambda a: F.concat(a["v"], F.array(a["n"])))


def insert(a: Column, b: Column) -> Column:
    """Fingerprint of the union of two multisets."""
    return _lanewise(a, b, 1)


def delete(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` without the paragraphs of ``b``."""
    return _lanewise(a, b, -1)


def _lanewise(a: Column, b: Column, sign: int) -> Column:
    pairs = F.arrays_zip(F.slice(a, 1, WIDE).alias("x"), F.slice(b, 1, WIDE).alias("y"))
    if sign > 0:
        lanes = F.transform(pairs, lambda p: (p["x"] + p["y"]).bitwiseAND(F.lit(KEEP)))
    else:  # borrow from the carry bit, which the mask then drops
        carry = MODULUS * EACH
        lanes = F.transform(pairs, lambda p: ((p["x"].bitwiseOR(F.lit(carry))) - p["y"]).bitwiseAND(F.lit(KEEP)))
    count = F.element_at(a, WIDE + 1) + sign * F.element_at(b, WIDE + 1)
    return F.concat(lanes, F.array(count))


def as_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the shared paragraphs over all, estimated from lanes."""
    def signed(v: Column, n: Column, k: int) -> Column:
        lane = F.shiftright(v, k * SHIFTS).bitwiseAND(F.lit(MODULUS - 1))
        return (F.pmod(2 * lane - n + MODULUS // 2, F.lit(MODULUS)) - MODULUS // 2).cast("double")

    na, nb = F.element_at(a, WIDE + 1), F.element_at(b, WIDE + 1)
    pairs = F.arrays_zip(F.slice(a, 1, WIDE).alias("x"), F.slice(b, 1, WIDE).alias("y"))
    zero = F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("sq"))

    def add(acc: Column, p: Column) -> Column:
        dot, sq = acc["dot"], acc["sq"]
        for k in range(3):
            x, y = signed(p["x"], na, k), signed(p["y"], nb, k)
            dot, sq = dot + x * y, sq + x * x + y * y
        return F.struct(dot.alias("dot"), sq.alias("sq"))
    near = F.aggregate(pairs, zero, add, lambda s: F.when(s["sq"] > 0, 2 * s["dot"] / s["sq"]).otherwise(0.0))
    return F.when(a == b, 1.0).when((na == 0) | (nb == 0), 0.0).otherwise(
        F.least(F.greatest(near, F.lit(0.0)), F.lit(1.0)))


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``docs(doc_id, text, ...)`` with ``nxt``: the row after it in descending
    (doc_id, text), the first row after the last.

    Rows are dealt to ranges of doc_id, ordered inside each, and the first
    row of a range is also sent to the range above, whose last row it
    follows - so no task sees more than a range.
    """
    spark = docs.sparkSession
    buckets = buckets or 2 * shuffle_partitions(spark)
    row = F.struct(*[F.col(c) for c in docs.columns])
    dealt = docs.withColumn("_bucket", range_bucket(docs, "doc_id", buckets))
    ids = docs.select("doc_id").withColumn("_bucket", range_bucket(docs, "doc_id", buckets))
    heads = {r["_bucket"]: r["head"] for r in
             ids.groupBy("_bucket").agg(F.max("doc_id").alias("head")).collect()}  # one row per range
    if not heads:
        return docs.withColumn("nxt", row)
    full = sorted(heads)
    above = dict(zip(full, full[1:] + full[:1]))
    n = max(full) + 1
    head = F.element_at(F.lit([heads.get(b) for b in range(n)]).cast("array<bigint>"), F.col("_bucket") + 1)
    to = F.element_at(F.lit([above.get(b, 0) for b in range(n)]).cast("array<int>"), F.col("_bucket") + 1)
    own = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("carried"))
    sent = F.when(F.col("doc_id").eqNullSafe(head), F.array(own, F.struct(to.alias("b"), F.lit(1).alias("carried")))) \
        .otherwise(F.array(own))
    rows = dealt.withColumn("_to", F.explode(sent))
    order = Window.partitionBy("_to.b").orderBy("_to.carried", F.col("doc_id").desc_nulls_last(),
                                                F.col("text").desc_nulls_last())
    out = rows.withColumn("nxt", F.lead(row).over(order)).where("_to.carried = 0")
    return out.select(*docs.columns, "nxt")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    base = take_columns(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("fp", fingerprint(F.col("text")))
    rows = with_next(base)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("nxt.text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp",
                       F.col("nxt.fp").alias("next_fp"))
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
