"""Language identification: multinomial naive Bayes over hashed character
n-grams (operator 8).

Training counts every n-gram of every labelled training text in Spark:
each task keeps one count vector per language, the vectors are summed by
(language, bucket). The log-probability matrix (languages x 2**16 buckets) is
broadcast; its size does not depend on the number of documents. Scoring is
sparse: the buckets of a batch index the matrix and are summed per text.

Characters are lower-cased, anything but a letter is a space, and n-grams
with two spaces in a row are skipped.

Defined results: null texts and texts without a letter get ``und`` with score
0; without any training text every prediction is ``und``; a null doc_id is
not held out; ties go to the smaller language name; repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import slices, take_columns, text_buffers, workers_can_import

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
SMOOTHING = 0.5
SLICE = 1 << 20
UNKNOWN = "und"
_KEYS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_TABLES: list[np.ndarray] = []


def _tables() -> np.ndarray:
    """Letter code of each code point: lower-cased letter, else a space."""
    if not _TABLES:
        def code(i: int) -> int:
            c = chr(i)
            if not c.isalpha():
                return 32
            low = c.lower()
            return ord(low) if len(low) == 1 else i
        _TABLES.append(np.array([code(i) for i in range(0x110000)], np.uint32))
    return _TABLES[0]


def letters(col) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all texts and the offsets of each text."""
    buf, off = text_buffers(col)
    starts = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    raw = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(raw) != starts[-1]:  # ill-formed bytes: one replacement per text piece
        texts = [buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])]
        raw = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        return _tables()[raw], np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return _tables()[raw], starts[off]


def grams(code: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text index, bucket) of all n-grams, one order at a time."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    space = code == 32
    double = space[1:] & space[:-1]
    bad = np.zeros(len(code), bool)
    h = np.zeros(len(code), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        size = len(code) - n + 1
        if size <= 0:
            break
        h = h[:size] * np.uint32(0x01000193) + code[n - 1:] * _KEYS[n - 1]
        bad = bad[:size] | double[n - 2:] if n > 1 else space.copy()
        if n == 2:
            bad = double.copy()
        if n in ORDERS:
            ok = ~bad & (doc[:size] == doc[n - 1:])
            mixed = h[ok] ^ (h[ok] >> np.uint32(15))
            mixed *= np.uint32(0x2C1B3C6D)
            mixed ^= mixed >> np.uint32(12)
            yield doc[:size][ok], (mixed * np.uint32(0x297A2D39)) >> np.uint32(16)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    seen: dict[str, int] = {}
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            of = np.array([names.index(x) for x in langs])
            for x in langs:
                seen[x] = seen.get(x, 0) + 1
            for doc, bucket in grams(*letters(part.column("text"))):
                got = np.bincount(of[doc] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
                for i, name in enumerate(names):
                    own = got[i * BUCKETS:(i + 1) * BUCKETS]
                    counts[name] = counts[name] + own if name in counts else own
    for name in sorted(seen):
        own = counts.get(name, np.zeros(BUCKETS, np.int64))
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_pydict({  # bucket -1 counts the texts
            "lang": pa.array([name] * (len(at) + 1)),
            "bucket": pa.array(np.concatenate([[-1], at]), pa.int32()),
            "n": pa.array(np.concatenate([[seen[name]], own[at]]), pa.int64())})


class Model:
    def __init__(self, langs: list[str], logp: np.ndarray, prior: np.ndarray):
        self.langs, self.logp, self.prior = langs, logp, prior


def train(docs: DataFrame) -> Model:
    """``docs(text, lang)``: all rows with a language count."""
    workers_can_import(docs.sparkSession)
    rows = take_columns(docs, "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    sums = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()  # at most languages x BUCKETS rows
    names, buckets, n = (sums.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "bucket", "n"))
    langs = sorted(set(names))
    table = np.zeros((len(langs), BUCKETS))
    texts = np.zeros(len(langs))
    index = {x: i for i, x in enumerate(langs)}
    row = np.array([index[x] for x in names], int)
    real = buckets >= 0
    table[row[real], buckets[real]] = n[real]
    texts[row[~real]] = n[~real]
    logp = np.log(table + SMOOTHING) - np.log(table.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    prior = np.log((texts + 1) / (texts + 1).sum()) if langs else texts
    return Model(langs, logp.astype(np.float32), prior)


def score(model: Model, code: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language index, its posterior, has a letter) per text."""
    n = len(off) - 1
    total = np.tile(model.prior, (n, 1))
    for doc, bucket in grams(code, off):
        for i in range(len(model.langs)):
            total[:, i] += np.bincount(doc, weights=model.logp[i][bucket], minlength=n)
    best = total.argmax(axis=1)
    post = np.exp(total - total.max(axis=1, keepdims=True))
    some = np.concatenate([[0], np.cumsum(code != 32)])[off]
    return best, 1 / post.sum(axis=1), np.diff(some) > 0


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(doc_id, text)`` with lang_pred and score."""
    spark = docs.sparkSession
    workers_can_import(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.logp, model.prior))
    docs = take_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                n = part.num_rows
                pred, post = np.array([UNKNOWN] * n, object), np.zeros(n)
                if own.langs:
                    best, p, some = score(own, *letters(part.column("text")))
                    pred[some] = np.array(own.langs, object)[best[some]]
                    post[some] = p[some]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "lang_pred": pa.array(pred, pa.string()),
                                                  "score": pa.array(post)})
    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
