"""Near-duplicate documents by SetSketch registers (operator 5).

A document is the set of its word shingles. Every shingle holds one
exponential variable per register; a register keeps the minimum over the set,
truncated to the exponent of an exponentially spaced grid (base ``BASE``).
Registers of a union are the larger exponents of both (``merge``), and two
sets agree in a register about as often as they are alike.

1. Documents with equal sets collapse to one representative (digest of the
   sorted set).
2. ``BANDS`` bands of ``ROWS`` registers name buckets. At the threshold 0.8 a
   pair shares no bucket with probability (1 - 0.8**5)**40 = 1e-7.
3. In each bucket the smallest representative is the hub. Every
   representative is held against its best hub: first by the maximum
   likelihood estimate of the Jaccard similarity from the registers (six
   standard errors of slack), then exactly on the full sets. This settles
   most of a large group of near copies with one test per member.
4. Buckets whose members are not all connected yet are gone through again:
   in blocks, all their pairs across components are estimated; the pairs that
   remain possible connect representatives to clusters, and all pairs of a
   cluster are tested exactly, again in blocks (a block product of 0/1
   matrices counts shared shingles). A task gives back only the links that
   connect its rows, never the pairs. Nothing is capped: a pair that shares a
   bucket is either connected already or was tested.
5. Components of the verified links; copies take their representative's.

Defined results: null and empty texts have no shingles, link with nothing and
stay; fewer words than the shingle width make one shingle; rows with equal
doc_id are linked only by their sets; null doc_id rows link and are reported
under the smallest non-null id of their component (null if it has none).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import (SHINGLE_KEYS, broadcast_if_small, landed, mix, shingle_sets, slices, take_columns,
                                   text_buffers, word_hashes, workers_can_import)
from ledgerlake.llm.components import connected_components

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
BASE = 1.001             # spacing of the truncated minima
STEPS, ZERO = 65535, 25000  # exponents fit 16 bits; a minimum of 1 has exponent ZERO + 1
SLACK = 6.0              # standard errors of the estimate
BLOCK_ROWS = 1024        # rows of a bucket that are estimated against each other at once
PAIRS_AT_ONCE = 40_000
BLOCK_SHINGLES = 500_000  # of a cluster that are held together in one exact test
EXACT_ROWS = 1024        # rows of a cluster in one block of it: two blocks make a table of 2048 x 2048
COLUMNS_AT_ONCE = 4096
SMALL_ROLES = 2_000_000  # rows (40 bytes) that may be broadcast, proved by a count
U64 = np.uint64


# ------------------------------------------------------------------- sketch

def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> U64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def minima(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Minimum exponential variable per (set, register).

    A shingle's variables are the first arrivals of a Poisson stream of rate
    ``registers`` whose points fall on registers at random - the same
    distribution as independent exponentials, made in ascending order, so a
    shingle stops as soon as it cannot lower any register. A set is done once
    all its registers are met below the limit; the few others go on.
    """
    out = np.full((len(sets), registers), np.inf)
    todo = [i for i, s in enumerate(sets) if len(s)]
    extra = 3.0
    while todo:
        sizes = np.array([len(sets[i]) for i in todo])
        limit = (np.log(registers) + extra) / sizes
        row = np.repeat(np.arange(len(todo)), sizes)
        state = mix(np.concatenate([sets[i] for i in todo]) ^ SHINGLE_KEYS[40])
        at = -np.log(_uniform(state)) / registers
        flat = np.full(len(todo) * registers, np.inf)
        while True:
            live = at <= limit[row]
            if not live.all():
                row, state, at = row[live], state[live], at[live]
            if not len(at):
                break
            state = mix(state + SHINGLE_KEYS[41])
            slot = (state % U64(registers)).astype(np.int64) + row * registers
            np.minimum.at(flat, slot, at)
            state = mix(state + SHINGLE_KEYS[42])
            at = at - np.log(_uniform(state)) / registers
        grid = flat.reshape(len(todo), registers)
        full = np.isfinite(grid).all(axis=1)
        idx = np.array(todo)
        out[idx[full]] = grid[full]
        todo = idx[~full].tolist()
        extra *= 3
    return out


def exponents(low: np.ndarray) -> np.ndarray:
    """Truncated registers: larger for smaller minima, 0 for the empty set."""
    k = np.floor(1 - np.log(low) / np.log(BASE)) + ZERO
    return np.where(np.isfinite(low), np.clip(k, 1, STEPS), 0).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    h = np.zeros((len(regs), bands), np.uint64)
    parts = regs.reshape(len(regs), bands, rows).astype(np.uint64)
    for j in range(rows):
        h += (parts[:, :, j] + U64(1)) * SHINGLE_KEYS[j]
    return mix(h + np.arange(bands, dtype=np.uint64) * SHINGLE_KEYS[50]).view(np.int64)


def likelihood_jaccard(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum likelihood Jaccard similarity of pairs of register rows, given
    the set sizes: the counts of larger, smaller and equal registers have
    probabilities p(u - vJ), p(v - uJ) and the rest; the log likelihood is
    concave in J, found by ternary search."""
    plus = (ra > rb).sum(axis=1)
    minus = (ra < rb).sum(axis=1)
    same = ra.shape[1] - plus - minus
    u, v = na / (na + nb), nb / (na + nb)

    def p(x):
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    def loglik(j):
        a, b = p(u - v * j), p(v - u * j)
        tiny = 1e-300
        return (plus * np.log(np.maximum(a, tiny)) + minus * np.log(np.maximum(b, tiny))
                + same * np.log(np.maximum(1 - a - b, tiny)))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = loglik(x) < loglik(y)
        lo, hi = np.where(left, x, lo), np.where(left, hi, y)
    return (lo + hi) / 2


# --------------------------------------------------------------- Spark tasks

def _set_batches(batches: Iterator[pa.RecordBatch], width: int, limit: int):
    for batch in batches:
        for part in slices(batch, "text", limit):
            yield part, shingle_sets(*word_hashes(*text_buffers(part.column("text"))), width)


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _set_batches(batches, width, 2 << 20):
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "thash": part.column("thash"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                                    for s in sets], pa.binary()),
                "regs": pa.array([r.tobytes() for r in exponents(minima(sets))], pa.binary())})
    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            regs = np.frombuffer(b"".join(part.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            rid = np.repeat(part.column("rid").to_numpy(), BANDS)
            yield pa.RecordBatch.from_pydict({"key": pa.array(band_keys(regs).ravel()), "rid": pa.array(rid)})


def _sets(width: int, columns: tuple[str, ...]):
    """Shingle sets of texts, with the named columns passed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _set_batches(batches, width, 4 << 20):
            yield pa.RecordBatch.from_pydict({**{c: part.column(c) for c in columns},
                                              "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})
    return run


def _estimates(percent: int):
    """Pairs whose likelihood estimate reaches the threshold less the slack."""
    goal = percent / 100
    least = goal - SLACK * (goal * (1 - goal) / REGISTERS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                ra, rb = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                          for c in ("regs_a", "regs_b"))
                na, nb = (part.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
                est = likelihood_jaccard(ra, rb, na, nb)
                keep = pa.array(np.flatnonzero(est >= least))
                yield pa.RecordBatch.from_pydict({"member": part.column("member").take(keep),
                                                  "hub": part.column("hub").take(keep),
                                                  "est": pa.array(est).take(keep)})
    return run


def _set_lists(width: int, columns: tuple[str, ...]):
    """As ``_sets``, the sets as arrays that Spark's own functions read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _set_batches(batches, width, 4 << 20):
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_pydict({**{c: part.column(c) for c in columns},
                                              "shingles": pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                                                   pa.array(values))})
    return run


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """Exact test on the full sets: 100 * shared >= percent * union. A pair of
    rows at a time, so long sets never gather in a batch."""
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    union = F.size("set_a") + F.size("set_b") - F.col("shared")
    return pairs.withColumn("shared", shared).where(100 * F.col("shared") >= percent * union)


def _with_sets(rows: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``rows(rid, cluster, comp, doc_id, thash)`` with their shingle sets."""
    small = broadcast_if_small(rows, SMALL_ROLES).alias("r")
    same_row = F.col("t.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("t.thash") == F.col("r.thash"))
    held = texts.alias("t").join(small, same_row).select("r.rid", "r.cluster", "r.comp", "t.text")
    # a row repeated as a whole gives its set twice
    return held.mapInArrow(_sets(width, ("rid", "cluster", "comp")), "rid long, cluster long, comp long, shingles binary") \
        .dropDuplicates(["rid"])


def _block_pairs(rows: DataFrame, group: str) -> DataFrame:
    """Deal a group's rows to ``blocks`` blocks and each block to every pair
    (i <= j) it is part of: two rows of a group meet in exactly one pair, and
    no task sees more than two blocks. ``own``: the row's block."""
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    return rows.select(*[c for c in rows.columns if c not in ("other", "blocks")],
                       F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest connected position of each of n positions joined by a - b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label[a] == label[b]).all():
            break
    return label


def _stars(rid: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs connect, one per position at most."""
    label = _roots(len(rid), a, b)
    far = np.flatnonzero(label != np.arange(len(rid)))
    return rid[far], rid[label[far]]


def _candidates(percent: int):
    """Rows sorted by (key, i, j): pairs of different components whose
    likelihood estimate reaches the threshold less the slack, given as the
    fewest links that connect the same rows."""
    goal = percent / 100
    least = goal - SLACK * (goal * (1 - goal) / REGISTERS) ** 0.5

    def pairs_of(group, own, i, j, comp, n, regs):
        """All pairs of a run of complete groups, in steps of bounded size."""
        end = np.searchsorted(group, group, "right")
        count = end - np.arange(len(group)) - 1
        at = 0
        while at < len(group):
            upto = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), PAIRS_AT_ONCE, "right")) + at)
            c = count[at:upto]
            a = np.repeat(np.arange(at, upto), c)
            b = np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c) + a + 1
            at = upto
            meet = (comp[a] != comp[b]) & ((own[a] != own[b]) | (i[a] == j[a]))
            meet &= np.minimum(n[a], n[b]) * 100 >= percent * np.maximum(n[a], n[b])
            a, b = a[meet], b[meet]
            if len(a):
                est = likelihood_jaccard(regs[a], regs[b], n[a].astype(float), n[b].astype(float))
                yield a[est >= least], b[est >= least]

    def solve(t: pa.Table):
        key, i, j, own, rid, comp, n = (t.column(c).to_numpy() for c in ("key", "i", "j", "own", "rid", "comp", "n"))
        regs = np.frombuffer(b"".join(t.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        got = list(pairs_of(np.cumsum(new), own, i, j, comp, n, regs))
        a = np.concatenate([x for x, _ in got]) if got else np.zeros(0, int)
        b = np.concatenate([y for _, y in got]) if got else np.zeros(0, int)
        x, y = _stars(rid, a, b)
        return pa.RecordBatch.from_pydict({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(h.num_rows for h in held) < 4 * BLOCK_ROWS:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            cols = [t.column(c).to_numpy() for c in ("key", "i", "j")]
            last = np.ones(t.num_rows, bool)
            for c in cols:
                last &= c == c[-1]
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0  # the last group may go on
            if cut:
                yield solve(t.slice(0, cut))
                held = t.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())
    return run


def _exact_links(percent: int):
    """One pair of blocks of a cluster: shared shingles of all its pairs by
    products of 0/1 matrices (columns in steps), tested exactly."""
    def run(t: pa.Table) -> pa.Table:
        rid, comp, own = (t.column(c).to_numpy() for c in ("rid", "comp", "own"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
        size = np.array([len(x) for x in sets])
        row = np.repeat(np.arange(len(sets)), size)
        _, col, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        both = seen[col] > 1
        row, col = row[both], col[both]
        _, col = np.unique(col, return_inverse=True)
        shared = np.zeros((len(sets), len(sets)), np.float32)
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        for lo in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS_AT_ONCE):
            x, y = np.searchsorted(col, [lo, lo + COLUMNS_AT_ONCE])
            m = np.zeros((len(sets), COLUMNS_AT_ONCE), np.float32)
            m[row[x:y], col[x:y] - lo] = 1
            shared += m @ m.T
        a, b = np.nonzero(np.triu(100 * shared >= percent * (size[:, None] + size[None, :] - shared), 1))
        keep = (own[a] != own[b]) | (i == j)
        x, y = _stars(rid, a[keep], b[keep])
        return pa.Table.from_pydict({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})
    return run


def _hub_links(pairs: DataFrame, reps: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links of every member to the best of its hubs: the most alike
    by estimate, then the smallest."""
    side = reps.select("rid", "regs", "n")
    left = side.toDF("member", "regs_a", "n_a")
    right = side.toDF("hub", "regs_b", "n_b")
    # a size ratio under the threshold rules a pair out before anything else
    near = pairs.join(left, "member").join(right, "hub").where(
        F.least("n_a", "n_b") * 100 >= percent * F.greatest("n_a", "n_b"))
    near = near.select("member", "hub", "regs_a", "regs_b", "n_a", "n_b") \
        .mapInArrow(_estimates(percent), "member long, hub long, est double")
    near = near.groupBy("member").agg(F.min(F.struct(-F.col("est"), "hub"))["hub"].alias("hub"))
    near = landed(near.select("member", "hub"), "near-pairs")
    # every set travels once, to the task of its hub; a hub's own row has no member
    roles = near.select(F.col("member").alias("rid"), "hub", "member").union(
        near.select(F.col("hub").alias("rid"), "hub", F.lit(None).cast("long")).distinct())
    roles = landed(roles.join(reps.select("rid", "doc_id", "thash"), "rid").drop("rid"), "near-roles")
    small = broadcast_if_small(roles, SMALL_ROLES).alias("r")
    same_row = F.col("t.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("t.thash") == F.col("r.thash"))
    held = texts.alias("t").join(small, same_row).select("r.hub", "r.member", "t.text")
    held = landed(held.mapInArrow(_set_lists(width, ("hub", "member")),
                                  "hub long, member long, shingles array<long>"), "near-sets")
    members = held.where("member IS NOT NULL").withColumnRenamed("shingles", "set_a")
    hubs = held.where("member IS NULL").select("hub", F.col("shingles").alias("set_b")).dropDuplicates(["hub"])
    return landed(_verified(members.join(hubs, "hub"), percent)
                  .select(F.col("member").alias("a"), F.col("hub").alias("b")), "near-links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, thash, n_shingles, component_id, component_thash), one per
    row of ``docs``; ``thash`` is xxhash64 of the text. The last two name the
    document that stands for the component."""
    workers_can_import(docs.sparkSession)
    texts = take_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("thash"), "text")
    rows = landed(texts.mapInArrow(_sketch(width), "doc_id long, thash long, n long, digest binary, regs binary"),
                  "sketches")
    # equal sets collapse to the row with the smallest doc_id
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "thash"))
    reps = rows.where("n > 0").groupBy("digest").agg(first.alias("h"), F.first("n").alias("n"),
                                                     F.first("regs").alias("regs"))
    reps = landed(reps.select(F.monotonically_increasing_id().alias("rid"), "digest", "h.doc_id", "h.thash", "n",
                              "regs"), "representatives")

    bands = landed(reps.select("rid", "regs").mapInArrow(_buckets, "key long, rid long"), "bands")
    shared = bands.groupBy("key").agg(F.min("rid").alias("hub"), F.max("rid").alias("last")).where("hub < last")
    buckets = landed(bands.join(shared.select("key", "hub"), "key"), "buckets")
    hubs = buckets.where("rid > hub").select(F.col("rid").alias("member"), "hub").distinct()
    links = _hub_links(hubs, reps, texts, width, percent)

    # buckets that are not one component yet: which members may still be
    # alike across components, and exact tests within those clusters
    labels = connected_components(links)
    inside = landed(buckets.select("key", "rid").join(labels.withColumnRenamed("id", "rid"), "rid", "left")
                    .select("key", "rid", F.coalesce("component", "rid").alias("comp")), "bucket-components")
    sizes = inside.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
    open_ = sizes.where("lo < hi").select("key", F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("blocks"))
    rows_ = _block_pairs(inside.join(open_, "key"), "key").join(reps.select("rid", "n", "regs"), "rid")
    rows_ = rows_.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    maybe = landed(rows_.select("key", "i", "j", "own", "rid", "comp", "n", "regs")
                   .mapInArrow(_candidates(percent), "a long, b long"), "candidates")
    clusters = connected_components(maybe)
    # the smallest member names its cluster
    clusters = clusters.union(clusters.select(F.col("component").alias("id"), "component").distinct()) \
        .toDF("rid", "cluster")
    members_ = landed(clusters.join(labels.withColumnRenamed("id", "rid"), "rid", "left")
                      .withColumn("comp", F.coalesce("component", "rid")).drop("component")
                      .join(reps.select("rid", "doc_id", "thash", "n"), "rid"), "clusters")
    weight = members_.groupBy("cluster").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / EXACT_ROWS))
                                             .cast("int").alias("blocks"))
    held = _with_sets(members_.select("rid", "cluster", "comp", "doc_id", "thash"), texts, width)
    blocks = _block_pairs(held.join(weight, "cluster"), "cluster")
    more = landed(blocks.select("cluster", "i", "j", "own", "rid", "comp", "shingles").groupBy("cluster", "i", "j")
                  .applyInArrow(_exact_links(percent), "a long, b long"), "near-links")

    labels = connected_components(labels.toDF("a", "b").union(more))
    whole = reps.select("rid", "digest", "doc_id", "thash").join(labels.withColumnRenamed("id", "rid"), "rid", "left") \
        .withColumn("root", F.coalesce("component", "rid"))
    named = whole.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "thash")).alias("h"))
    whole = whole.select("digest", "root").join(named, "root").select(
        "digest", F.col("h.doc_id").alias("component_id"), F.col("h.thash").alias("component_thash"))
    return rows.select("doc_id", "thash", "n", "digest").join(whole, "digest", "left").select(
        "doc_id", "thash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("component_thash")).otherwise(F.col("thash")).alias("component_thash"))


def near_duplicate_report(docs: DataFrame, width: int, percent: int) -> DataFrame:
    out = near_duplicates(docs, width, percent)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the smallest doc_id (null ones
    last), of several texts under it the one with the smallest hash. A row
    repeated with equal doc_id and text is one document; rows without words
    all stay."""
    found = near_duplicates(docs, width, percent)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("thash") == F.col("component_thash"))
    gone = found.where(~stays & (F.col("n_shingles") > 0)) \
        .select("doc_id", "thash").distinct()
    gone = broadcast_if_small(landed(gone, "near-gone"), SMALL_ROLES).alias("g")
    mark = "_thash"
    while mark in docs.columns:   # a column of the documents may have any name
        mark += "_"
    keyed = docs.withColumn(mark, F.xxhash64("text")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col(f"d.{mark}") == F.col("g.thash"))
    kept = keyed.join(gone, same, "left_anti")
    # rows repeated as a whole: only doc_ids that occur again are looked at
    again = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = broadcast_if_small(landed(again, "near-again"), SMALL_ROLES).alias("a")
    repeated = F.col("k.doc_id").eqNullSafe(F.col("a.doc_id"))
    once = kept.alias("k").join(again, repeated, "left_anti")
    twice = kept.alias("k").join(again, repeated, "left_semi")
    words = twice.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    rest = twice.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return once.unionByName(words.dropDuplicates(["doc_id", mark])).unionByName(rest).drop(mark)
