"""Filter interaction audit by an incremental, retracting stream.

Five filters judge every document of a Parquet folder; the audit says, for
each part of the corpus and each of the 120 orders of the filters, what every
step keeps and removes, how much of its work is redundant, which labelled
documents it costs and its Shapley share. Four filters look at one text
alone; the fifth fails a text that a smaller doc_id also has, anywhere in the
table, so a document's set of failed filters can change when later files
bring a smaller id.

All files are processed as available-now micro-batches:

1. a stateless pass reads each text once: failed filters A to D as bits and
   the text's SHA-256;
2. rows are combined inside a task: per text only the rows of its smallest id
   go on as *candidates*, counted as if no smaller id existed. All other rows
   fail E for certain. Both are summed by (part, mask, labels) and leave the
   task as counter rows, so a text that holds a third of all rows sends a few
   rows per task to its key, not its copies;
3. keyed state holds, for every text, the smallest id seen and what stands at
   it. A candidate that meets a smaller id, in its batch or an earlier one, is
   retracted from its counter and added with E; so is the former holder when a
   smaller id arrives. Texts share a state key by bucket of their digest, some
   1,024 to a key at any size of the table, as a call per text would cost more
   than the text's own work;
4. the deltas are summed per task again and appended to a Parquet sink, whose
   log makes every batch count exactly once when executors are lost.

The counters (parts x 32 masks x label flags) are then the whole input of the
audit table.

Defined cases: null text is empty; an empty text has no words (A fails, B and
C pass). Null doc_ids are neither smaller than others nor have a smaller one:
they never fail E. Rows that repeat a (doc_id, text) are all counted, and E
compares ids only, so none of them fails E by the others. Several label rows
of a doc_id: a flag counts if any of them sets it. Null source is part ''.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerlake.llm.common import take_columns, workers_can_import
from ledgerlake.session import scratch_path

FILTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}
REPEATED = BIT["E"]
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]

MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
MARKS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(65, 91))
GAP = re.compile(rb"[\x20\x09-\x0D]")

BATCHES = 4                # micro-batches that the files are dealt to
WINDOW_BYTES = 1 << 22     # text split into words at once
BUCKET_ROWS = 1024         # rows of the table per state key, on the mean
MAX_HELD = 1 << 17         # texts or counters that one task holds before it passes them on

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",   # many small stores
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}

#: Rows sent to the state: candidates by the bucket of their text's digest, or
#: a task's counter rows (no digest) under a bucket number of the task's own.
MOVES = ("bucket bigint, key binary, doc_id bigint, part string, mask int, good boolean, toxic boolean, n bigint")
MOVE_TYPES = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64())
COUNTER = ["part", "mask", "good", "toxic"]
HOLDER = ["key", "doc_id", *COUNTER]
STATE = "held binary"
DELTAS = "part string, mask int, good boolean, toxic boolean, n bigint"


# ------------------------------------------------------------- one text alone

def count_words(raw: bytes, window: int = WINDOW_BYTES) -> tuple[int, int]:
    """(words, distinct words) of a text, split a window at a time."""
    total, seen, lo = 0, set(), 0
    while lo < len(raw):
        end = GAP.search(raw, lo + window)
        hi = end.start() if end else len(raw)
        words = raw[lo:hi].split()   # of bytes: exactly the six ASCII spaces
        total += len(words)
        seen.update(words)
        lo = hi
    return total, len(seen)


def failed_alone(text: str, raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words, distinct = count_words(raw)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (BIT["A"] * (words < MIN_WORDS)
            | BIT["B"] * (100 * distinct < MIN_DISTINCT_PERCENT * words)
            | BIT["C"] * (100 * capitals > MAX_CAPITAL_PERCENT * len(text))
            | BIT["D"] * (MARKS.search(raw) is not None))


def judged(docs: DataFrame) -> DataFrame:
    """(key, doc_id, part, mask, spread) of each row: its text is read here and
    goes no further. ``spread`` parts rows without doc_id by task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for batch in batches:
            keys, masks = [], []
            for cell in batch.column("text"):
                text = cell.as_py() or ""
                raw = text.encode()
                keys.append(hashlib.sha256(raw).digest())
                masks.append(failed_alone(text, raw))
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), ids, batch.column("part"), pa.array(masks, pa.int32()),
                 pa.array([0 if ok else task + 1 for ok in ids.is_valid().to_pylist()], pa.int32())],
                names=["key", "doc_id", "part", "mask", "spread"])
    return docs.mapInArrow(run, "key binary, doc_id bigint, part string, mask int, spread int")


# ------------------------------------------------------------------- the stream

def _counter_batches(counters: Counter) -> Iterator[pa.RecordBatch]:
    rows = [(*k, n) for k, n in counters.items() if n]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()))],
            names=["part", "mask", "good", "toxic", "n"])


def combine(rows: DataFrame, buckets: int) -> DataFrame:
    """Candidates by digest bucket and counters by task (``MOVES``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = -1 - TaskContext.get().partitionId()
        counters: Counter = Counter()
        held: dict = {}   # digest: [doc_id, mask, good, toxic, {part: rows}]

        def passed_on():
            moves = []
            for key, (doc_id, mask, good, toxic, parts) in held.items():
                bucket = int.from_bytes(key[:8], "little") % buckets
                for part, n in parts.items():
                    counters[part, mask, good, toxic] += n
                    moves.append((bucket, key, doc_id, part, mask, good, toxic, n))
            moves += [(own, None, 0, *k, n) for k, n in counters.items() if n]
            held.clear()
            counters.clear()
            if moves:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*moves), MOVE_TYPES)],
                                                 names=["bucket", *HOLDER, "n"])

        for batch in batches:
            for key, doc_id, part, mask, good, toxic in zip(*(batch.column(c).to_pylist() for c in HOLDER)):
                least = held.get(key) if doc_id is not None else None
                if doc_id is None:
                    counters[part, mask, good, toxic] += 1
                elif least is None:
                    held[key] = [doc_id, mask, good, toxic, {part: 1}]
                elif doc_id > least[0]:
                    counters[part, mask | REPEATED, good, toxic] += 1
                elif doc_id == least[0]:
                    least[4][part] = least[4].get(part, 0) + 1
                else:
                    for p, n in least[4].items():
                        counters[p, least[1] | REPEATED, least[2], least[3]] += n
                    held[key] = [doc_id, mask, good, toxic, {part: 1}]
            if len(held) + len(counters) > MAX_HELD:
                yield from passed_on()
        yield from passed_on()
    return rows.mapInArrow(run, MOVES)


def track(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep the smallest id of every text of a bucket and what stands at it;
    retract what stands at larger ones, whether it came before or comes now."""
    if bucket[0] < 0:   # a task's counters
        yield from (frame[[*COUNTER, "n"]] for frame in frames)
        return
    known = [pa.ipc.open_stream(state.get[0]).read_pandas()] if state.exists else []
    rows = pd.concat([*known, *(frame[[*HOLDER, "n"]] for frame in frames)], ignore_index=True)
    beaten = rows["doc_id"] > rows.groupby("key")["doc_id"].transform("min")
    if beaten.any():
        gone = rows[beaten].groupby(COUNTER, as_index=False)["n"].sum()
        yield pd.concat([gone.assign(n=-gone["n"]), gone.assign(mask=gone["mask"] | REPEATED)], ignore_index=True)
    holders = pa.Table.from_pandas(rows[~beaten].groupby(HOLDER, as_index=False)["n"].sum(), preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, holders.schema) as out:
        out.write_table(holders)
    state.update((sink.getvalue().to_pybytes(),))


def summed(deltas: DataFrame) -> DataFrame:
    """Deltas summed by counter inside each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: Counter = Counter()
        for batch in batches:
            for *k, n in zip(*(c.to_pylist() for c in batch.columns)):
                counters[tuple(k)] += n
            if len(counters) > MAX_HELD:
                yield from _counter_batches(counters)
                counters.clear()
        yield from _counter_batches(counters)
    return deltas.mapInArrow(run, DELTAS)


@contextmanager
def state_settings(spark: SparkSession):
    """State in RocksDB (disk, bounded memory) while a query starts, which
    copies the settings; what the session has set itself stays."""
    ours = [k for k in STATE_CONF if spark.conf.get(k, None) is None or k == "spark.sql.streaming.stateStore.providerClass"]
    before = {k: spark.conf.get(k, None) for k in ours}
    for k in ours:
        spark.conf.set(k, STATE_CONF[k])
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def mask_counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(part, mask, good, toxic, n): documents of the Parquet files at ``path``
    by the filters they fail, after all files went through the stream."""
    workers_can_import(spark)
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    if not re.search(r"[*?\[{]", path):   # as a pattern the stream takes a folder or a single file
        path = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    stream = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches)))
              .option("maxFileAge", "36500d")   # files of any age count
              .parquet(path))
    docs = take_columns(stream, "doc_id", "text", "source").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
    flags = (take_columns(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL")
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                  F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
             .where("good OR toxic").withColumn("spread", F.lit(0)))
    rows = (judged(docs).join(flags, ["doc_id", "spread"], "left")
            .select("key", "doc_id", "part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]))
    deltas = combine(rows, max(1, table.count() // BUCKET_ROWS)).groupBy("bucket").applyInPandasWithState(
        track, DELTAS, STATE, "append", GroupStateTimeout.NoTimeout)
    out = scratch_path(spark, "filter-audit-deltas")
    with state_settings(spark):
        query = (summed(deltas).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
                 .option("checkpointLocation", scratch_path(spark, "filter-audit-stream")).start(out))
        query.awaitTermination()
    return (spark.read.schema(DELTAS).parquet(out).groupBy("part", "mask", "good", "toxic")
            .agg(F.sum("n").alias("n")).where("n <> 0"))


# --------------------------------------------------------------------- the audit

def _over(cells: str, value: str, holds) -> Column:
    """Sum of a field over the cells of a part whose mask satisfies ``holds``."""
    return F.aggregate(cells, F.lit(0).cast("bigint"),
                       lambda total, c: total + F.when(holds(c["mask"]), c[value]).otherwise(F.lit(0).cast("bigint")))


def audit(counters: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    cells = (counters.groupBy("part", "mask")
             .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                  F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
             .groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")))  # 32 at most
    at = lambda letter: F.instr("filter_order", letter)
    steps = (cells.withColumn("filter_order", F.explode(F.lit(ORDERS)))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
             .withColumn("own", sum((F.when(at(x) == F.col("step"), BIT[x]).otherwise(0) for x in FILTERS), F.lit(0)))
             .withColumn("before", sum((F.when(at(x) < F.col("step"), BIT[x]).otherwise(0) for x in FILTERS), F.lit(0))))
    fails = lambda m: m.bitwiseAND(F.col("own")) != 0          # noqa: E731
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0        # noqa: E731
    # of the orders of a document's k failed filters, each comes first in 1 / k of the 120
    share = F.aggregate("cells", F.lit(0).cast("bigint"), lambda total, c: total + F.when(
        fails(c["mask"]), c["n"] * F.element_at(F.lit([len(ORDERS) // k for k in range(1, len(FILTERS) + 1)]),
                                                F.bit_count(c["mask"]))).otherwise(F.lit(0).cast("bigint")))
    return steps.select(
        "part", "filter_order", "step",
        _over("cells", "n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        _over("cells", "n", lambda m: fails(m) & ~gone(m)).alias("removed"),
        _over("cells", "n", lambda m: fails(m) & gone(m)).alias("redundant"),
        _over("cells", "n", lambda m: m == F.col("own")).alias("unique_fails"),
        _over("cells", "good", lambda m: fails(m) & ~gone(m)).alias("good_lost"),
        _over("cells", "toxic", lambda m: fails(m) & ~gone(m)).alias("toxic_lost"),
        share.alias("shapley"))


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    return audit(mask_counters(spark, path, labels, batches))


def oracle_sql() -> str:
    """The audit in DuckDB SQL, by brute force over all orders."""
    letters = ", ".join(f"'{x}'" for x in FILTERS)
    tables = " ".join(f"CROSS JOIN (SELECT unnest([{letters}]) AS x{i})" for i in range(2, 6))
    distinct = " AND ".join(f"x{i} <> x{j}" for i in range(1, 6) for j in range(i + 1, 6))
    bits = lambda op: " + ".join(
        f"CASE WHEN instr(filter_order, '{x}') {op} step THEN {BIT[x]} ELSE 0 END" for x in FILTERS)
    total = lambda when, name: f"CAST(coalesce(sum(CASE WHEN {when} THEN 1 END), 0) AS BIGINT) AS {name}"
    return rf"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
flags AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < {MIN_WORDS} THEN {BIT['A']} ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w) THEN {BIT['B']} ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_CAPITAL_PERCENT} * length(t)
                THEN {BIT['C']} ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN {BIT['D']} ELSE 0 END
         + CASE WHEN coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false)
                THEN {REPEATED} ELSE 0 END AS mask
  FROM words LEFT JOIN flags ON words.doc_id = flags.doc_id),
orders AS (
  SELECT x1 || x2 || x3 || x4 || x5 AS filter_order FROM (SELECT unnest([{letters}]) AS x1) {tables}
  WHERE {distinct}),
steps AS (
  SELECT filter_order, step, {bits('=')} AS own, {bits('<')} AS earlier
  FROM orders CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
audited AS (
  SELECT part, filter_order, step, own,
         {total('mask & (own | earlier) = 0', 'kept')},
         {total('mask & own <> 0 AND mask & earlier = 0', 'removed')},
         {total('mask & own <> 0 AND mask & earlier <> 0', 'redundant')},
         {total('mask = own', 'unique_fails')},
         {total('mask & own <> 0 AND mask & earlier = 0 AND good', 'good_lost')},
         {total('mask & own <> 0 AND mask & earlier = 0 AND toxic', 'toxic_lost')}
  FROM masks CROSS JOIN steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM audited"""
