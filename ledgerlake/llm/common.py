"""Helpers shared by the operators of this subpackage.

Text handling works on Arrow buffers with numpy: a batch of texts is one byte
array with offsets, words are found and hashed for all texts at once, and no
Python string is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.session import scratch_path

U64 = np.uint64
SLICE_BYTES = 8 << 20     # text handled at once inside a task
SEGMENT_BYTES = 1 << 18   # bytes hashed at once (position tables stay in cache)


# ---------------------------------------------------------------- Spark side

def workers_can_import(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's path (a
    cluster installs the package or ships it with ``--py-files``)."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(":")
    if root not in have:
        env["PYTHONPATH"] = ":".join([root, *filter(None, have)])


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and reread: cuts lineage, survives the loss
    of any executor, and lets later passes share the work."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "lz4").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only when a count proves at most ``max_rows`` rows;
    beyond that the join is left to the shuffle planner."""
    return F.broadcast(df) if df.count() <= max_rows else df


def take_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns (extra columns of any name cannot clash);
    a missing one is a clear error."""
    missing = [n for n in names if n not in docs.columns]
    if missing:
        raise ValueError(f"documents table lacks column(s): {', '.join(missing)}")
    return docs.select(*[F.col(f"`{n}`") for n in names])


def range_bucket(docs: DataFrame, column: str, buckets: int):
    """Column dealing ascending values to ranges 0 .. buckets - 1 of like row
    counts: approximate quantiles of that column alone, ``buckets`` values on
    the driver. Nulls fall in range 0; equal values share a range."""
    cuts = []
    if buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        got = docs.agg(F.percentile_approx(column, probs, 20 * buckets).alias("c")).first()["c"]
        cuts = sorted(set(got or []))
    if not cuts:
        return F.lit(0)
    # position among the cuts in two steps, so a row looks at about 2 * sqrt(buckets) of them
    width = max(1, int(len(cuts) ** 0.5))
    value = F.col(column)
    groups = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    group = F.size(F.filter(F.lit([g[0] for g in groups]).cast("array<bigint>"), lambda c: c < value))
    inner = F.element_at(F.lit(groups).cast("array<array<bigint>>"), F.greatest(group, F.lit(1)))
    rank = F.when(group == 0, 0).otherwise(
        (group - 1) * width + F.size(F.filter(inner, lambda c: c < value)))
    return F.coalesce(rank, F.lit(0)).cast("int")


def filter_rows(docs: DataFrame, keep, limit: int = SLICE_BYTES) -> DataFrame:
    """Rows of ``docs``, all columns untouched, for which ``keep(texts)`` - a
    mask over a run of the text column - is true. Row-local, no shuffle."""
    workers_can_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", limit):
                yield part.filter(pa.array(keep(part.column("text")), pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


# ------------------------------------------------------------- Arrow and numpy

def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    n = len(col)
    offsets = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text."""
    if not batch.num_rows:
        return
    _, off = text_buffers(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 (a bijection with good avalanche)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


_RNG = np.random.Generator(np.random.PCG64(20260101))
BYTE_KEYS = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * U64(2) + U64(1)
SHINGLE_KEYS = _RNG.integers(1, 2 ** 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)

# the six ASCII white-space bytes of [^\x20\x09-\x0D]+
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# words of letters, digits and non-ASCII bytes only (punctuation separates)
PUNCTUATED = np.ones(256, bool)
PUNCTUATED[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_KEYS = BYTE_KEYS[LOWER]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, SEGMENT_BYTES + 1)
        step, back = np.full(size, _P, np.uint64), np.full(size, _PINV, np.uint64)
        step[0] = back[0] = 1
        _POW, _INV = np.cumprod(step), np.cumprod(back)
    return _POW, _INV


def _segment_words(buf: np.ndarray, gap: np.ndarray, breaks: np.ndarray):
    """Starts, ends and hashes of the words of one segment. ``breaks``:
    positions where a new text begins."""
    word = ~gap
    edge = np.zeros(len(buf) + 1, bool)
    edge[1:-1] = word[1:] != word[:-1]
    edge[0] = word[0]
    edge[-1] = word[-1]
    inner = np.unique(breaks[(breaks > 0) & (breaks < len(buf))])  # empty texts share theirs
    joined = inner[word[inner] & word[inner - 1]]  # a word ends and another begins here
    at = np.flatnonzero(edge)
    if len(joined):
        at = np.sort(np.concatenate([at, joined, joined]))
    starts, ends = at[0::2], at[1::2]
    pw, inv = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(LOWER_KEYS[buf] * pw[:len(buf)], out=total[1:])
    h = (total[ends] - total[starts]) * inv[starts]
    return starts, ends, mix(h ^ ((ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93)))


def word_hashes(buf: np.ndarray, off: np.ndarray, gaps: np.ndarray = SPACE, spans: bool = False):
    """Hashes of all words (A-Z lower-cased) of texts ``buf[off[i]:off[i+1]]``.

    Returns (hashes, first): the words of text i are
    ``hashes[first[i]:first[i+1]]``; with ``spans`` also start and end bytes.
    The hash is a polynomial over random byte keys modulo 2**64, finalised.
    """
    hs, ss, es = [], [], []
    lo, n = 0, len(buf)
    while lo < n:
        hi = min(lo + SEGMENT_BYTES, n)
        if hi < n:  # cut where a text begins or at a gap, never inside a word
            k = int(np.searchsorted(off, hi, "right")) - 1
            cut = int(off[k])
            if cut <= lo:
                back = np.flatnonzero(gaps[buf[lo:hi]])
                while not len(back) and hi < n and hi not in (int(off[k + 1]),):
                    hi = min(hi + SEGMENT_BYTES, int(off[k + 1]))
                    back = np.flatnonzero(gaps[buf[lo:hi]])
                cut = lo + int(back[-1]) + 1 if len(back) and hi != int(off[k + 1]) else hi
            hi = cut
        seg = buf[lo:hi]
        a, b = np.searchsorted(off, [lo, hi])
        s, e, h = _segment_words(seg, gaps[seg], off[a:b] - lo)
        hs.append(h)
        ss.append(s + lo)
        es.append(e + lo)
        lo = hi
    h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
    s = np.concatenate(ss) if ss else np.zeros(0, np.int64)
    first = np.searchsorted(s, off)
    if spans:
        return h, first, s, (np.concatenate(es) if es else np.zeros(0, np.int64))
    return h, first


def shingle_sets(hashes: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text; a text of fewer words than
    ``width`` has one shingle, its whole sequence; no words, none."""
    n = len(hashes)
    flat = np.zeros(max(n - width + 1, 0), np.uint64)
    for j in range(width):
        flat += hashes[j:j + len(flat)] * SHINGLE_KEYS[j]
    flat = mix(flat)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            x = np.sort(flat[a:b - width + 1])
            keep = np.ones(len(x), bool)
            keep[1:] = x[1:] != x[:-1]
            out.append(x if keep.all() else x[keep])
        elif b > a:
            short = (hashes[a:b] * SHINGLE_KEYS[:b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short ^ U64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
