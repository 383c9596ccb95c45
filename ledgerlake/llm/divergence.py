"""Source divergence audit by products of one-hot count levels.

Within a language every source is compared with every other one, and with the
language as a whole, by the price p = 1 + floor(10^9 (c + 2) / (N + 2 V)) of
each kept term: c its count in the group, N the group's counts over all V kept
terms. Two prices differ by f = floor((p - q)^2 / (p + q)).

A group has one price per *count level*, and most terms stand at few levels.
So the terms are not priced pair by pair. For a block of terms, X holds one
indicator column for every (group, count level) that occurs in it; the cells
of the product X'X say how many terms have level a in one group and level b in
another, which is the block's joint table of every pair of groups at once, and
each cell is priced once. Terms are sorted by their count first, so blocks of
rare terms have few columns and many rows and blocks of frequent ones the
other way round; products are cut into tiles of columns. Entries are 0 or 1
and a block has at most 4,096 terms, so float32 products are exact.

Columns of level 0 are never built. With a and b over positive levels, f00 the
price of two zeros and m(a) the terms of a group at level a, the sum over all
V terms is

    V f00 + sum m(a) [f(a, 0) - f00] + sum m(b) [f(0, b) - f00]
          + sum joint(a, b) [f(a, b) - f(a, 0) - f(0, b) + f00]

which is exact in integers: the first line needs each group's own levels (the
diagonal of the product), the second the joint tables. So work and memory grow
with the counts that occur, not with groups x terms.

Counts come from one pass over the whole texts that sums per task, so neither
a hot source nor a frequent term meets in one task unsummed.

Defined cases: null text, lang and source read as ''. A group without terms,
or whose terms are all dropped, still has prices (c = 0, N = 0). A language
without kept terms has value 0 in all its pairs. Repeated rows count as
documents of their own; doc_ids and other columns are not read. Ties rank by
the item's UTF-8 bytes. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import landed, shuffle_partitions, take_columns, workers_can_import

MIN_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10

WINDOW_BYTES = 1 << 22     # text split into terms at once
MAX_HELD = 400_000         # counters that one task holds before it passes them on
BLOCK_TERMS = 4096         # rows of a one-hot block; below 2^24, so float32 sums are exact
BLOCK_COLUMNS = 512        # columns of a one-hot block, and of a tile of its product

#: bytes of terms as they are, capitals lower-cased, all others a gap; in UTF-8
#: every byte of a code point from U+0080 on is 0x80 or more
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def add_terms(raw: bytes, counts: Counter, docs_with: Counter, window: int = WINDOW_BYTES) -> None:
    """Count a text's terms, split a window at a time, and each of them once
    as a document's."""
    raw = raw.translate(TERM_BYTES)
    seen, lo = set(), 0
    while lo < len(raw):
        hi = raw.find(b" ", lo + window)
        hi = len(raw) if hi < 0 else hi
        terms = raw[lo:hi].split()
        counts.update(terms)
        seen.update(terms)
        lo = hi
    docs_with.update(seen)


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) summed inside each task; every group also
    has one row with a null term, as groups without terms count too."""
    workers_can_import(docs.sparkSession)
    rows = take_columns(docs, "lang", "source", "text").select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}

        def passed_on():
            for (lang, source), (n, docs_with) in counts.items():
                terms = [None, *n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                     pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
                     pa.array([0, *(docs_with[t] for t in n)], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])
            counts.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n, docs_with = counts.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                add_terms(text.encode(), n, docs_with)
                held += len(n) + 1
                if held > MAX_HELD:
                    yield from passed_on()
                    held = 0
        yield from passed_on()
    return rows.mapInArrow(run, COUNTS)


# ------------------------------------------------------------------------ prices

def price(n, total, kept_terms) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 V)), exact at any count."""
    wide = lambda c: c.cast("decimal(27,0)")
    whole = F.call_function("div", (wide(n) + 2) * F.lit(SCALE).cast("decimal(10,0)"), wide(total) + 2 * wide(kept_terms))
    return whole + 1


def difference(p, q) -> Column:
    """floor((p - q)^2 / (p + q)); prices stay under 2^31, so squares fit."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The kept terms' counts (lang, source, term, n, all_n: the language's
    count), and the groups (lang, source, total, all_total, kept_terms)."""
    # summed per task already: another sum before the shuffle would find little to add up
    partial = count_terms(docs).repartition(shuffle_partitions(docs.sparkSession), "lang", "source", "term")
    counts = landed(partial.groupBy("lang", "source", "term")
                    .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    term = Window.partitionBy("lang", "term")
    kept = landed(counts.where("term IS NOT NULL")
                  .select("lang", "source", "term", "n", F.sum("docs").over(term).alias("docs"),
                          F.sum("n").over(term).alias("all_n"))
                  .where(F.col("docs") >= MIN_DOCUMENTS).drop("docs"), "divergence-kept")
    by_lang = (kept.groupBy("lang", "term").agg(F.sum("n").alias("n"))
               .groupBy("lang").agg(F.sum("n").alias("all_total"), F.count("*").alias("kept_terms")))
    groups = (counts.where("term IS NULL").select("lang", "source")
              .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(by_lang, "lang", "left").na.fill(0, ["total", "all_total", "kept_terms"]))
    return kept, landed(groups, "divergence-groups")


def priced(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Kept counts with the group's price p, its price of level 0 and the
    language's price q."""
    return kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "all_n",
        price(F.col("n"), F.col("total"), F.col("kept_terms")).alias("p"),
        price(F.lit(0), F.col("total"), F.col("kept_terms")).alias("p0"),
        price(F.col("all_n"), F.col("all_total"), F.col("kept_terms")).alias("q"))


# ---------------------------------------------------------------- one-hot products

def _tile(rows: np.ndarray, columns: np.ndarray, terms: int, lo: int, hi: int) -> np.ndarray:
    x = np.zeros((terms, hi - lo), np.float32)
    inside = (columns >= lo) & (columns < hi)
    x[rows[inside], columns[inside] - lo] = 1
    return x


def _floor_f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def block_values(row: np.ndarray, group: np.ndarray, p: np.ndarray, p0: np.ndarray, width: int = BLOCK_COLUMNS):
    """(first group, second group, value) of one block of terms: for entries
    (row, group, price, price of 0), the priced joint tables of all pairs of
    different groups with a positive level."""
    column_keys, column = np.unique(np.stack([group, p]), axis=1, return_inverse=True)
    column = column.reshape(-1)
    own, level = column_keys
    zero = np.zeros(len(own), np.int64)
    zero[column] = p0
    terms, n = int(row.max()) + 1, len(own)
    firsts, seconds, values = [], [], []
    for a in range(0, n, width):
        left = _tile(row, column, terms, a, min(a + width, n))
        for b in range(a, n, width):
            right = left if a == b else _tile(row, column, terms, b, min(b + width, n))
            i, j = np.nonzero(joint := left.T @ right)
            count, i, j = joint[i, j].astype(np.int64), i + a, j + b
            other = own[i] < own[j]    # columns are in order of their group
            count, i, j = count[other], i[other], j[other]
            p_i, p_j, z_i, z_j = level[i], level[j], zero[i], zero[j]
            firsts.append(own[i])
            seconds.append(own[j])
            values.append(count * (_floor_f(p_i, p_j) - _floor_f(p_i, z_j) - _floor_f(z_i, p_j) + _floor_f(z_i, z_j)))
    return np.concatenate(firsts), np.concatenate(seconds), np.concatenate(values)


def joint_values(rows: DataFrame) -> DataFrame:
    """(lang, source, other, value): priced joint tables of positive levels,
    summed over blocks, source before other."""
    workers_can_import(rows.sparkSession)
    schema = "lang string, source string, other string, value bigint"

    def flush(lang, names, entries):
        row, group, p, p0 = (np.array(x, np.int64) for x in zip(*entries))
        order = sorted(range(len(names)), key=lambda i: names[i].encode())
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        a, b, value = block_values(row, rank[group], p, p0)
        pairs, at = np.unique(a * len(names) + b, return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, at, value)
        name = [names[i] for i in order]
        return [(lang, name[k // len(names)], name[k % len(names)], v) for k, v in zip(pairs.tolist(), total.tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        at, names, entries, columns, terms = None, {}, [], set(), 0

        def finish():
            for lang, a, b, value in flush(at[0], list(names), entries):
                sums[lang, a, b] += value
            names.clear(), entries.clear(), columns.clear()

        def passed_on():
            if sums:
                keys = list(zip(*sums))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(k, pa.string()) for k in keys), pa.array(list(sums.values()), pa.int64())],
                    names=["lang", "source", "other", "value"])
                sums.clear()

        for batch in batches:
            for lang, term, source, p, p0 in zip(*(batch.column(c).to_pylist()
                                                   for c in ("lang", "term", "source", "p", "p0"))):
                if at != (lang, term):
                    if at and (lang != at[0] or terms >= BLOCK_TERMS or len(columns) >= BLOCK_COLUMNS):
                        finish()
                        terms = 0
                        if len(sums) > MAX_HELD:
                            yield from passed_on()
                    at, terms = (lang, term), terms + 1
                group = names.setdefault(source, len(names))
                columns.add((group, p))
                entries.append((terms - 1, group, p, p0))
        if entries:
            finish()
        yield from passed_on()

    n = shuffle_partitions(rows.sparkSession)
    return (rows.repartition(n, "lang", "term").sortWithinPartitions("lang", "all_n", "term")
            .select("lang", "term", "source", "p", "p0").mapInArrow(run, schema)
            .groupBy("lang", "source", "other").agg(F.sum("value").alias("value")))


def pair_values(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) over all V terms, both directions."""
    zeros = groups.select("lang", "source", "kept_terms",
                          price(F.lit(0), F.col("total"), F.col("kept_terms")).alias("p0")).where("kept_terms > 0")
    others = zeros.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    pairs = zeros.join(others, "lang").where("source <> other")   # the output's own rows
    both_zero = pairs.select("lang", "source", "other",
                             (F.col("kept_terms") * difference(F.col("p0"), F.col("q0"))).alias("value"))
    levels = rows.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("m"))   # the product's diagonal
    alone = (levels.join(others, "lang").where("source <> other")
             .groupBy("lang", "source", "other")
             .agg(F.sum(F.col("m") * (difference(F.col("p"), F.col("q0")) - difference(F.col("p0"), F.col("q0"))))
                  .alias("value")))
    both_ways = F.inline(F.array(F.struct(F.col("source"), F.col("other"), F.col("value")),
                                 F.struct(F.col("other").alias("source"), F.col("source").alias("other"), F.col("value"))))
    positive = alone.unionByName(joint_values(rows)).select("lang", both_ways)
    return (both_zero.unionByName(positive)
            .groupBy("lang", "source", "other").agg(F.sum("value").alias("value")))


def divergence_report(docs: DataFrame) -> DataFrame:
    """Pairs of sources and each source's ten most distinctive terms."""
    kept, groups = kept_counts(docs)
    rows = landed(priced(kept, groups), "divergence-priced")
    names = groups.select("lang", "source")
    pairs = (names.join(names.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
             .join(pair_values(rows, groups).withColumnRenamed("other", "item"), ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce("value", F.lit(0)).cast("bigint").alias("value")))
    terms = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                       difference(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return (pairs.withColumn("rank", F.row_number().over(order))
            .unionByName(terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)))


def oracle_sql() -> str:
    """The report in DuckDB SQL, term by term for every pair."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    p = lambda c, n: f"1 + (CAST({SCALE} AS HUGEINT) * (coalesce({c}, 0) + 2)) // ({n} + 2 * v)"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCUMENTS}),
counts AS (
  SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts USING (lang, source) GROUP BY g.lang, g.source),
langs AS (
  SELECT lang, sum(n) AS all_n, (SELECT count(*) FROM kept k WHERE k.lang = groups.lang) AS v
  FROM groups GROUP BY lang),
prices AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, {p('c', 'n')} AS p,
         {p('sum(c) OVER (PARTITION BY g.lang, k.term)', 'all_n')} AS q
  FROM groups g JOIN langs USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts USING (lang, source, term)),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item,
         sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM prices a JOIN prices b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM prices WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
