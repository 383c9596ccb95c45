"""Benchmark decontamination with a BM25 index and block-max WAND (operator 10).

The benchmark's items are the indexed side; every passage of every training
document is a query. Spark computes the postings (term, item, BM25 weight)
over all items; weights are divided by the item's own score, so the score of
a passage is the share of an item that it contains, and one threshold serves
all items.

Passages are windows of words that overlap by half and are at least twice the
longest item, so an item always lies inside one. For a run of passages at once:

1. Terms of a passage in rising order of their largest weight; the leading
   ones whose sum stays below the threshold cannot retrieve an item alone.
   A passage whose total stays below it is done (WAND's pivot test).
2. The remaining, essential terms name the blocks of items where they occur;
   block maxima bound the score, and blocks below the threshold are skipped.
3. Items of the blocks left are scored exactly; all at or above the threshold
   are retrieved.
4. Each is verified: of the five-word shingles of the item's question (all
   but its last sentence) and of its answer, at least 80 % must stand in the
   passage.

The index is broadcast in groups of ``GROUP_ITEMS`` items; a larger benchmark
takes several passes over the documents.

Defined results: null texts match nothing; items without words are never
found; repeated items and rows are all reported; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import (PUNCTUATED, filter_rows, landed, shingle_sets, slices, take_columns,
                                   text_buffers, word_hashes, workers_can_import)

K1, B = 1.2, 0.75        # BM25
THRESHOLD = 0.5          # share of an item's own score
OVERLAP = 0.8            # of the shingles of question and answer
WIDTH = 5                # words of a shingle
BLOCK_ITEMS = 32         # consecutive items with common maxima
GROUP_ITEMS = 20_000     # items of one broadcast index
SLICE = 1 << 19          # text handled at once
SENTENCE_END = frozenset(b".!?\n")


# ------------------------------------------------------------ indexed side

def question_and_answer(words: int, ends: list[int]) -> int:
    """First word of the answer: the last sentence; of a single sentence the
    second half. ``ends``: word counts at which sentences end."""
    inner = [e for e in ends if 0 < e < words]
    return inner[-1] if inner else words // 2


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with counts, and the shingles of question and answer."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            buf, off = text_buffers(part.column("text"))
            h, first, _, end = word_hashes(buf, off, PUNCTUATED, spans=True)
            rows = []
            for i, no in enumerate(part.column("no").to_pylist()):
                a, b = int(first[i]), int(first[i + 1])
                if a == b:
                    continue
                stop = [j + 1 - a for j in range(a, b)
                        if SENTENCE_END & set(buf[end[j]:min(end[j] + 2, off[i + 1])].tolist())]
                cut = a + question_and_answer(b - a, stop)
                terms, tf = np.unique(h[a:b], return_counts=True)
                parts = shingle_sets(h[a:b], np.array([0, cut - a, b - a]), WIDTH)
                rows.append({"no": no, "words": b - a, "terms": terms.view(np.int64).tolist(), "tf": tf.tolist(),
                             "question": parts[0].tobytes(), "answer": parts[1].tobytes(),
                             "q_words": cut - a, "a_words": b - cut})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("no", pa.int64()), ("words", pa.int64()), ("terms", pa.list_(pa.int64())), ("tf", pa.list_(pa.int64())),
                ("question", pa.binary()), ("answer", pa.binary()), ("q_words", pa.int64()), ("a_words", pa.int64())]))


def index_tables(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, postings): postings(no, term, weight) with BM25 weights over
    all items, divided by the item's own score."""
    workers_can_import(benchmark.sparkSession)
    numbered = landed(take_columns(benchmark, "item_id", "text").withColumn("id", F.monotonically_increasing_id()), "items")
    known = numbered.select(F.col("id").alias("no"), "text").mapInArrow(
        _items, "no long, words long, terms array<long>, tf array<long>, question binary, answer binary, "
                "q_words long, a_words long")
    items = landed(known.join(numbered.select(F.col("id").alias("no"), F.col("item_id").cast("long").alias("item_id")), "no"),
                   "items")
    total = items.agg(F.count("*").alias("n"), F.avg("words").alias("avg")).first()
    n, avg = total["n"], total["avg"] or 1.0
    each = items.select("no", "words", F.explode(F.arrays_zip("terms", "tf")).alias("p")) \
        .select("no", "words", F.col("p.terms").alias("term"), F.col("p.tf").alias("tf"))
    df = each.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("words") / avg))
    raw = landed(each.join(df, "term").select("no", "term", weight.alias("weight")), "postings")
    own = raw.groupBy("no").agg(F.sum("weight").alias("own"))
    return items, landed(raw.join(own, "no").select("no", "term", (F.col("weight") / F.col("own")).alias("weight")), "postings")


class Index:
    """Arrays of one group of items; terms are numbered by rising maximum."""

    def __init__(self, items: pa.Table, postings: pa.Table):
        order = np.argsort(items.column("no").to_numpy())
        items = items.take(pa.array(order))
        self.item_id = items.column("item_id").to_pylist()
        self.question = [np.frombuffer(x, np.uint64) for x in items.column("question").to_pylist()]
        self.answer = [np.frombuffer(x, np.uint64) for x in items.column("answer").to_pylist()]
        self.widths = list(zip(items.column("q_words").to_pylist(), items.column("a_words").to_pylist()))
        self.stride = max(64, max(items.column("words").to_pylist(), default=0))
        item = np.searchsorted(items.column("no").to_numpy(), postings.column("no").to_numpy())
        weight = postings.column("weight").to_numpy()
        terms, of = np.unique(postings.column("term").to_numpy().view(np.uint64), return_inverse=True)
        top = np.zeros(len(terms))
        np.maximum.at(top, of, weight)
        rank = np.empty(len(terms), np.int64)
        rank[np.argsort(top, kind="stable")] = np.arange(len(terms))
        self.hashes, self.number = terms, rank          # sorted hash -> term number
        self.top = np.sort(top, kind="stable")          # by term number
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(terms >> np.uint64(44)).astype(np.int64)] = True
        term = rank[of]
        order = np.lexsort((item, term))
        self.item, self.weight, term = item[order], weight[order], term[order]
        self.items_of = np.searchsorted(term, np.arange(len(terms) + 1))
        self.blocks = -(-len(self.item_id) // BLOCK_ITEMS)
        key = term * max(self.blocks, 1) + self.item // BLOCK_ITEMS
        self.block_key, at = np.unique(key, return_index=True)
        self.block_max = np.maximum.reduceat(self.weight, at) if len(at) else self.weight
        self.blocks_of = np.searchsorted(self.block_key, np.arange(len(terms) + 1) * max(self.blocks, 1))


def _spread(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ranges ``first[w]:first[w+1]`` one after the other,
    and which entry each belongs to."""
    size = first[which + 1] - first[which]
    entry = np.repeat(np.arange(len(which)), size)
    return np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size) + first[which][entry], entry


DENSE = 1 << 22          # sums over so many keys use a table, larger ones sort


def _sum_by(key: np.ndarray, value: np.ndarray, size: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """(keys, sums) whose sums reach ``floor`` (keys are below ``size``)."""
    if size <= DENSE:
        total = np.bincount(key, weights=value, minlength=1)
        keys = np.flatnonzero(total >= floor)
        return keys, total[keys]
    keys, of = np.unique(key, return_inverse=True)
    total = np.bincount(of, weights=value, minlength=len(keys))
    return keys[total >= floor], total[total >= floor]


def _among(key: np.ndarray, wanted: np.ndarray, size: int) -> np.ndarray:
    if size > DENSE:
        return np.isin(key, wanted)
    table = np.zeros(size, bool)
    table[wanted] = True
    return table[key]


def retrieve(ix: Index, window: np.ndarray, term: np.ndarray, threshold: float = THRESHOLD):
    """(window, item, score) of all pairs at or above the threshold. Input:
    distinct (window, term number) pairs sorted by window, then term."""
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    floor = threshold - 1e-9
    bound = ix.top[term]
    total = np.bincount(window, weights=bound, minlength=int(window[-1]) + 1 if len(window) else 0)
    alive = total[window] >= floor                       # pivot test
    window, term, bound = window[alive], term[alive], bound[alive]
    if not len(window):
        return empty
    run = np.cumsum(bound)
    starts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
    owner = np.cumsum(np.concatenate([[False], window[1:] != window[:-1]]))
    run -= np.concatenate([[0.0], run])[starts][owner]
    essential = run >= floor
    rest = np.bincount(owner, weights=np.where(essential, 0, bound))  # bound of the others
    # blocks of essential terms
    at, entry = _spread(ix.blocks_of, term[essential])
    key = owner[essential][entry] * ix.blocks + ix.block_key[at] % ix.blocks
    size = len(starts) * ix.blocks
    pairs, score = _sum_by(key, ix.block_max[at], size, 0.0 if size > DENSE else 1e-12)
    pairs = pairs[score + rest[pairs // ix.blocks] >= floor]
    if not len(pairs):
        return empty
    # with the other terms' own block maxima
    first = np.append(starts, len(term))
    at, entry = _spread(first, pairs // ix.blocks)
    want = term[at] * ix.blocks + pairs[entry] % ix.blocks
    pos = np.minimum(np.searchsorted(ix.block_key, want), len(ix.block_key) - 1)
    held = np.where(ix.block_key[pos] == want, ix.block_max[pos], 0)
    pairs = pairs[np.bincount(entry, weights=held, minlength=len(pairs)) >= floor]
    if not len(pairs):
        return empty
    # exact scores of the items of the blocks left
    own = np.unique(pairs // ix.blocks)
    pos, entry = _spread(first, own)
    at, again = _spread(ix.items_of, term[pos])
    item, who = ix.item[at], own[entry[again]]
    inside = _among(who * ix.blocks + item // BLOCK_ITEMS, pairs, size)
    n = len(ix.item_id)
    found, score = _sum_by(who[inside] * n + item[inside], ix.weight[at][inside], len(starts) * n, floor)
    return window[starts][found // n], found % n, score


def passages_of(first: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(first passage of each text, first word of each passage): windows of
    two strides that advance by one."""
    words = np.diff(first)
    count = np.maximum(1, -(-words // stride) - 1)
    start = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(words)), count)
    return start, first[text] + (np.arange(start[-1]) - start[text]) * stride


def matches(ix: Index, texts) -> list[tuple[int, int, float, float, float]]:
    """(row, item, score, question overlap, answer overlap), verified, the
    best passage of each (row, item)."""
    h, first = word_hashes(*text_buffers(texts), PUNCTUATED)
    if not len(h) or not ix.item_id:
        return []
    maybe = np.flatnonzero(ix.filter[(h >> np.uint64(44)).astype(np.int64)])
    pos = np.minimum(np.searchsorted(ix.hashes, h[maybe]), len(ix.hashes) - 1)
    hit = ix.hashes[pos] == h[maybe]
    place, term = maybe[hit], ix.number[pos[hit]]
    p_first, p_word = passages_of(first, ix.stride)
    text = np.searchsorted(first, place, "right") - 1
    step = (place - first[text]) // ix.stride
    last = p_first[text + 1] - p_first[text] - 1
    terms = len(ix.hashes)
    key = np.concatenate([(p_first[text] + np.minimum(step, last)) * terms + term,
                          (p_first[text] + np.clip(step - 1, 0, last)) * terms + term])
    key = np.unique(key)
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    p_text = np.searchsorted(p_first, np.arange(p_first[-1]), "right") - 1
    for w, item, score in zip(*(x.tolist() for x in retrieve(ix, key // terms, key % terms))):
        row = int(p_text[w])
        words = h[p_word[w]:min(p_word[w] + 2 * ix.stride, first[row + 1])]
        got = []
        for part, width in zip((ix.question[item], ix.answer[item]), ix.widths[item]):
            width = min(width, WIDTH)
            if not len(part):
                got.append(1.0)
                continue
            if width == WIDTH:
                there = shingle_sets(words, np.array([0, len(words)]), WIDTH)[0]
            else:  # a part shorter than a shingle is one sequence
                edges = np.arange(len(words) - width + 1)
                there = np.concatenate([shingle_sets(words[e:e + width], np.array([0, width]), WIDTH)[0]
                                        for e in edges.tolist()] or [np.zeros(0, np.uint64)])
            got.append(float(np.isin(part, there).mean()))
        if min(got) >= OVERLAP and (score, *got) > best.get((row, item), (0.0, 0.0, 0.0)):
            best[row, item] = (score, *got)
    return [(r, i, *v) for (r, i), v in sorted(best.items())]


def indexes(benchmark: DataFrame) -> list[Index]:
    """One index per group of items, in item order."""
    items, postings = index_tables(benchmark)
    out, last = [], -1
    while True:
        # numbers rise but have holes: the group ends at its GROUP_ITEMS-th number
        group = items.where(F.col("no") > last).select("no").orderBy("no").limit(GROUP_ITEMS)
        top = group.agg(F.max("no")).first()[0]
        if top is None:
            return out
        span = F.col("no").between(last + 1, top)
        out.append(Index(items.where(span).toArrow(), postings.where(span).toArrow()))
        last = top


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row per
    document and item it contains."""
    spark = docs.sparkSession
    workers_can_import(spark)
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    rows = take_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], schema)
    for ix in indexes(benchmark):
        shared = spark.sparkContext.broadcast(ix)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    ids = part.column("doc_id").to_pylist()
                    got = matches(own, part.column("text"))
                    cols = list(zip(*[(ids[r], own.item_id[i], s, q, a) for r, i, s, q, a in got])) or [[]] * 5
                    kinds = [pa.int64()] * 2 + [pa.float64()] * 3
                    names = ("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
                    yield pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, cols, kinds)})
        out = out.union(rows.mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that contain no benchmark item."""
    for ix in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(ix)

        def keep(texts, shared=shared):
            mask = np.ones(len(texts), bool)
            mask[[r for r, *_ in matches(shared.value, texts)]] = False
            return mask
        docs = filter_rows(docs, keep, SLICE)
    return docs


__all__ = ["Index", "drop_leaks", "find_leaks", "index_tables", "matches", "retrieve"]
