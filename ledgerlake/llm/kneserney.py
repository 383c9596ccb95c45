"""Interpolated modified Kneser-Ney language model (operator 9).

Bigram model with the discounts of Chen and Goodman: for a word w after h

    P(w|h) = max(c(hw) - D(c), 0) / c(h) + gamma(h) * P1(w)
    P1(w)  = max(k(w) - d(k), 0) / K + gamma1 / (V + 1)

where k(w) is the number of different words before w and K the number of
different bigrams; V + 1 leaves room for unknown words.

1. Tasks count the bigrams of their training texts as packed sorted arrays,
   cut into shards by the hash of the first word.
2. One task per shard merges them: exact counts, what each history needs
   (total, words seen once, twice, more), and per second word its count and
   number of histories, cut into shards by that word.
3. One task per word shard merges these into counts and continuation counts.
4. Each shard's arrays, sorted by hash, lie in the shared folder; workers
   memory-map them, look up the distinct bigrams of a batch and sum logs.

The driver sees one row of counts-of-counts per shard. A word is known by 48
bits of its hash, a bigram by 64. Texts start after a begin mark and end with
an end token that counts as a token.

Defined results: null text is empty (just the end token); a null doc_id is
not held out; without training text every token has probability 1/(V + 1)
with V = 0; repeated rows all count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import (SHINGLE_KEYS, mix, shuffle_partitions, slices, take_columns, text_buffers,
                                   word_hashes, workers_can_import)
from ledgerlake.llm.langid import held_out
from ledgerlake.llm.sharedfiles import mapped, put
from ledgerlake.session import scratch_path

U64 = np.uint64
BEGIN, END = U64(1), U64(2)     # 48-bit ids of the marks
HELD_TOKENS = 2_000_000          # tokens a counting task holds before it packs them
SLICE = 4 << 20


# ------------------------------------------------------------------ packing

def pack48(v: np.ndarray) -> bytes:
    return np.ascontiguousarray(v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(raw) -> np.ndarray:
    small = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(small), 8), np.uint8)
    out[:, :6] = small
    return out.view("<u8").ravel()


def word_ids(col) -> tuple[np.ndarray, np.ndarray]:
    """48-bit word ids with the end token after each text: (ids, first)."""
    h, first = word_hashes(*text_buffers(col))
    n = len(first) - 1
    ids = np.empty(len(h) + n, np.uint64)
    ends = first[1:] + np.arange(n)
    is_end = np.zeros(len(ids), bool)
    is_end[ends] = True
    ids[is_end] = END
    ids[~is_end] = (h >> U64(16)) | U64(4)  # never a mark
    return ids, np.concatenate([[0], ends + 1])


def histories(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[first[:-1]] = BEGIN
    return before


def shard_by(ids: np.ndarray, shards: int) -> np.ndarray:
    return (mix(ids ^ SHINGLE_KEYS[60]) >> U64(32)).astype(np.int64) * shards >> 32


def bigram_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * SHINGLE_KEYS[61] + b * SHINGLE_KEYS[62])


def _sum_runs(keys: tuple[np.ndarray, ...], values: tuple[np.ndarray, ...]):
    """Sorted distinct key rows (first key major) and their summed values."""
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    sums = tuple(np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values)
    return tuple(k[at] for k in keys), sums


# ----------------------------------------------------------------- counting

PARTIAL = "shard int, a binary, runs binary, b binary, n binary"
HALF = "shard int, w binary, n binary, k binary, counts array<long>"


def _count(shards: int):
    """Packed bigram counts per shard; a history is stored once per run."""
    def pack(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        (a, b), (n,) = _sum_runs((a, b), (np.ones(len(a), np.int64),))
        s = shard_by(a, shards)
        order = np.argsort(s, kind="stable")
        a, b, n, s = a[order], b[order], n[order], s[order]
        cuts = np.searchsorted(s, np.arange(shards + 1))
        rows = []
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            x, y = cuts[i], cuts[i + 1]
            heads, runs = np.unique(a[x:y], return_counts=True)
            rows.append({"shard": i, "a": pack48(heads), "runs": runs.astype("<u4").tobytes(),
                         "b": pack48(b[x:y]), "n": n[x:y].astype("<u4").tobytes()})
        schema = pa.schema([("shard", pa.int32())] + [(c, pa.binary()) for c in ("a", "runs", "b", "n")])
        for lo in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist(rows[lo:lo + 64], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, first = word_ids(part.column("text"))
                held.append((histories(ids, first), ids))
                size += len(ids)
                if size >= HELD_TOKENS:
                    yield from pack(*(np.concatenate(x) for x in zip(*held)))
                    held, size = [], 0
        if size:
            yield from pack(*(np.concatenate(x) for x in zip(*held)))
    return run


def _merge_bigrams(model: str, shards: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        a, b, n = [], [], []
        for row in table.to_pylist():
            a.append(np.repeat(unpack48(row["a"]), np.frombuffer(row["runs"], "<u4")))
            b.append(unpack48(row["b"]))
            n.append(np.frombuffer(row["n"], "<u4"))
        (a, b), (n,) = _sum_runs((np.concatenate(a), np.concatenate(b)), (np.concatenate(n).astype(np.int64),))
        # histories: total count, words seen once, twice, more often
        starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        sums = [np.add.reduceat(v, starts) for v in (n, n == 1, n == 2, n >= 3)]
        put(f"{model}/history-{shard}.key", a[starts].tobytes())
        put(f"{model}/history-{shard}.sum", np.stack(sums, 1).astype("<u4" if n.sum() < 1 << 32 else "<u8").tobytes())
        key = bigram_key(a, b)
        order = np.argsort(key)
        put(f"{model}/bigram-{shard}.key", key[order].tobytes())
        # one byte a count; larger ones again in a short list of their own
        small = np.minimum(n[order], 255).astype(np.uint8)
        big = small == 255
        put(f"{model}/bigram-{shard}.n", small.tobytes())
        put(f"{model}/bigram-{shard}.bigkey", key[order][big].tobytes())
        put(f"{model}/bigram-{shard}.bign", n[order][big].astype("<i8").tobytes())
        counts = [int((n == i).sum()) for i in (1, 2, 3, 4)] + [len(n)]
        (w,), (total, k) = _sum_runs((b,), (n, np.ones(len(b), np.int64)))
        s = shard_by(w, shards)
        order = np.argsort(s, kind="stable")
        w, total, k, s = w[order], total[order], k[order], s[order]
        cuts = np.searchsorted(s, np.arange(shards + 1))
        rows = [{"shard": i, "w": pack48(w[x:y]), "n": total[x:y].astype("<u8").tobytes(),
                 "k": k[x:y].astype("<u8").tobytes(), "counts": counts if i == 0 else [0] * 5}
                for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if x < y or i == 0]
        return pa.Table.from_pylist(rows, pa.schema([
            ("shard", pa.int32()), ("w", pa.binary()), ("n", pa.binary()), ("k", pa.binary()),
            ("counts", pa.list_(pa.int64()))]))
    return run


STATS = ("n1", "n2", "n3", "n4", "bigrams", "m1", "m2", "m3", "m4", "types", "tokens")


def _merge_words(model: str):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        rows = table.to_pylist()
        w = np.concatenate([unpack48(r["w"]) for r in rows])
        n = np.concatenate([np.frombuffer(r["n"], "<u8") for r in rows]).astype(np.int64)
        k = np.concatenate([np.frombuffer(r["k"], "<u8") for r in rows]).astype(np.int64)
        (w,), (n, k) = _sum_runs((w,), (n, k))
        put(f"{model}/word-{shard}.key", w.tobytes())
        put(f"{model}/word-{shard}.n", n.astype("<i8").tobytes())
        put(f"{model}/word-{shard}.k", k.astype("<i8").tobytes())
        below = np.sum([r["counts"] for r in rows], axis=0).tolist()
        own = [int((k == i).sum()) for i in (1, 2, 3, 4)] + [len(w), int(n.sum())]
        return pa.Table.from_pydict({c: pa.array([v], pa.int64()) for c, v in zip(STATS, below + own)})
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; where a class is
    empty (tiny corpora) the usual halves."""
    if not (n1 and n2):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(v, 0.01), i + 0.99) for i, v in enumerate(d))


@dataclass(frozen=True)
class Model:
    path: str
    shards: int
    tokens: int          # N
    types: int           # V
    bigrams: int         # K
    d: tuple             # discounts of the bigram counts
    e: tuple             # discounts of the continuation counts
    spare: float         # gamma1: what the unigram level leaves to 1 / (V + 1)


def train(docs: DataFrame) -> Model:
    """Count ``docs(text)``; the model's arrays stay in the shared folder."""
    spark = docs.sparkSession
    workers_can_import(spark)
    path, shards = scratch_path(spark, "kneser-ney"), max(8, 2 * shuffle_partitions(spark))
    partial = take_columns(docs, "text").mapInArrow(_count(shards), PARTIAL)
    half = partial.groupBy("shard").applyInArrow(_merge_bigrams(path, shards), HALF)
    stats = half.groupBy("shard").applyInArrow(_merge_words(path), ", ".join(f"{c} long" for c in STATS))
    s = stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in STATS]).first()
    e = discounts(s["m1"], s["m2"], s["m3"], s["m4"])
    more = s["types"] - s["m1"] - s["m2"]
    spare = (e[0] * s["m1"] + e[1] * s["m2"] + e[2] * more) / s["bigrams"] if s["bigrams"] else 1.0
    return Model(path, shards, s["tokens"], s["types"], s["bigrams"],
                 discounts(s["n1"], s["n2"], s["n3"], s["n4"]), e, spare)


# ------------------------------------------------------------------ scoring

def _find(keys: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, found) of sorted ``want`` in the sorted array ``keys``."""
    if not len(keys):
        return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    return at, keys[at] == want


def _by_shard(shard: np.ndarray, shards: int):
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        yield i, order[cuts[i]:cuts[i + 1]]


def _words(m: Model, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and continuation counts of distinct sorted words."""
    n, k = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
    for s, rows in _by_shard(shard_by(w, m.shards), m.shards):
        at, ok = _find(mapped(f"{m.path}/word-{s}.key", "<u8"), w[rows])
        n[rows[ok]] = mapped(f"{m.path}/word-{s}.n", "<i8")[at[ok]]
        k[rows[ok]] = mapped(f"{m.path}/word-{s}.k", "<i8")[at[ok]]
    return n, k


def _discount(n: np.ndarray, d: tuple) -> np.ndarray:
    return np.where(n == 0, 0.0, np.array([0.0, *d])[np.minimum(n, 3)])


def _bigrams(m: Model, a: np.ndarray, b: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """P(b|a) of distinct pairs; ``lower`` is P1(b)."""
    out = lower.copy()
    for s, rows in _by_shard(shard_by(a, m.shards), m.shards):
        heads = mapped(f"{m.path}/history-{s}.key", "<u8")
        sums = mapped(f"{m.path}/history-{s}.sum", "<u4")
        if len(sums) != 4 * len(heads):
            sums = mapped(f"{m.path}/history-{s}.sum", "<u8")
        at, ok = _find(heads, a[rows])
        rows, at = rows[ok], at[ok]
        if not len(rows):
            continue
        total, one, two, more = sums.reshape(-1, 4)[at].astype(np.float64).T
        key = bigram_key(a[rows], b[rows])
        order = np.argsort(key)
        found, hit = _find(mapped(f"{m.path}/bigram-{s}.key", "<u8"), key[order])
        n = np.zeros(len(rows), np.int64)
        n[order[hit]] = mapped(f"{m.path}/bigram-{s}.n", "u1")[found[hit]]
        if (n == 255).any():
            big = np.flatnonzero(n == 255)
            big = big[np.argsort(key[big])]
            found, hit = _find(mapped(f"{m.path}/bigram-{s}.bigkey", "<u8"), key[big])
            n[big[hit]] = mapped(f"{m.path}/bigram-{s}.bign", "<i8")[found[hit]]
        gamma = (m.d[0] * one + m.d[1] * two + m.d[2] * more) / total
        out[rows] = np.maximum(n - _discount(n, m.d), 0) / total + gamma * lower[rows]
    return out


def _score(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, first = word_ids(part.column("text"))
                w, back = np.unique(ids, return_inverse=True)
                n, k = _words(m, w)
                p1 = (np.maximum(k - _discount(k, m.e), 0) / m.bigrams if m.bigrams else 0.0) \
                    + m.spare / (m.types + 1)
                base = np.log10((n + 1) / (m.tokens + m.types + 1))
                before = histories(ids, first)
                pair = bigram_key(before, ids)
                _, one, again = np.unique(pair, return_index=True, return_inverse=True)
                order = np.argsort(before[one], kind="stable")  # histories are looked up in order
                one_sorted = one[order]
                p = np.empty(len(one))
                p[order] = _bigrams(m, before[one_sorted], ids[one_sorted], p1[back[one_sorted]])
                logp = np.log10(p)[again]
                cut = first[:-1]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n_tokens": pa.array(np.diff(first)),
                    "n_known": pa.array(np.add.reduceat((n > 0)[back].astype(np.int64), cut)),
                    "base_score": pa.array(np.add.reduceat(base[back], cut)),
                    "score": pa.array(np.add.reduceat(logp, cut))})
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score (log10) of every row."""
    workers_can_import(docs.sparkSession)
    rows = take_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(model), "doc_id long, n_tokens long, n_known long, base_score double, score double")


def language_model_report(docs: DataFrame) -> DataFrame:
    out = held_out(F.col("doc_id"), 7, 2)
    model = train(docs.where(~out))
    return score(docs, model).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
