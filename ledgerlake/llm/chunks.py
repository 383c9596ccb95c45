"""Substring deduplication by content-defined chunks (operator 2).

A gear hash rolls over the bytes of a text; its low 16 bits depend on the last
16 bytes only. Of every ``WIDTH`` adjacent places the one with the largest
value is a cut (of equal ones the last), so cuts move with the content: an
insertion changes the chunks around it and no others, and no chunk is longer
than ``MAX_BYTES``. There is no cut that counts from a chunk's begin.

Chunks are deduplicated by a 64-bit digest. A chunk between two cuts is a key
together with the ``SEEN`` bytes before it, which its first cut rests on. Two
equal passages have the same cuts from the largest place of their first whole
window to that of their last one; these differ from ``SEEN + 2 * WIDTH`` =
``PASSAGE_BYTES`` bytes on, so every such passage holds a key, periodic ones
too, and reaches less than ``WIDTH`` bytes beyond its keys.

A key of more than one document is repeated. Adjacent repeated keys of a
document are a run. Of each run, the stretch around the keys that another
document has goes to this document: to the first and to the last document
that have the key, a document a run and key, not one a document. There every
place of every key gives a diagonal, along which both texts are compared byte
by byte; equal stretches of ``PASSAGE_BYTES`` and more are passages of both
documents, to their edges. Spans that touch are one row.

What can be missed: a passage of two documents, each key of which a smaller
and a larger document have too that hold less of it. Everything that is
reported stands in another document, byte by byte.

Nothing collects the copies of a key: digests are counted by partial
aggregation and joined back (a frequent digest's rows can be split); the
stretches of a key of many documents are dealt to several copies of the text
that they are compared with, some ``ASKERS`` to each.

Defined results: null and empty texts have no chunk; rows with the same
doc_id are one document (its texts are not compared with each other, each
different text is reported, equal ones once); rows without doc_id are told
apart by their text; of ties for first_doc the smallest document counts; a
very long text is one row of a task, its stretches are requests of their own;
columns besides doc_id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlake.llm.common import landed, mix, slices, take_columns, text_buffers, workers_can_import

WINDOW = 32              # bytes that the rolling hash sees
SEEN = 16                # bytes that its low 16 bits see
WIDTH = 40               # one cut at least in so many places
MAX_BYTES = SEEN + WIDTH
PASSAGE_BYTES = 96       # SEEN + 2 * WIDTH: such a passage holds a key
REACH = 256              # bytes around a key that are compared, within its run
ASKERS = 2048
SLICE = 1 << 18
PAIRS = 1 << 20          # places of equal keys paired at once
EDGE = 1 << 12           # stretches up to this long are compared along many diagonals at once
_RNG = np.random.Generator(np.random.PCG64(20260202))
GEAR = _RNG.integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
KEYS = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))


def gear_hash(buf: np.ndarray, kind=np.uint32) -> np.ndarray:
    """h[i] = sum of GEAR[buf[i-j]] << j over the last 32 bytes, mod 2**32,
    by doubling the window five times; as uint16 its low 16 bits, which the
    last 16 bytes make."""
    h = GEAR.astype(kind)[buf]
    width, window = 1, min(WINDOW, 8 * np.dtype(kind).itemsize)
    while width < window:
        shifted = h[:-width] << kind(width) if len(h) > width else h[:0]
        h = h.copy()
        h[width:] += shifted
        width *= 2
    return h


def _distinct(x: np.ndarray) -> np.ndarray:
    """Different values of a sorted array."""
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def _inner_cuts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Cuts inside the texts: of each ``WIDTH`` adjacent places of one text,
    all with ``SEEN`` bytes of it before them, the last largest one."""
    if len(buf) < SEEN + WIDTH:
        return np.zeros(0, np.int64)
    value = np.zeros(len(buf), np.int64)  # place i: a cut before byte i
    value[1:] = gear_hash(buf, np.uint16)[:-1]
    value[1:] += 1
    value[(buf & 0xC0) == 0x80] = 0       # never inside a character
    best, width = value << 32 | np.arange(len(buf)), 1
    while width < WIDTH:
        step = min(width, WIDTH - width)
        best = np.maximum(best[:-step], best[step:])
        width += step
    whole = np.zeros(len(buf) + 1, np.int8)
    lo, hi = off[:-1] + SEEN, off[1:] - WIDTH + 1
    np.add.at(whole, lo[lo < hi], 1)
    np.add.at(whole, hi[lo < hi], -1)
    best = best[np.cumsum(whole[:len(best)], dtype=np.int8) > 0]
    return _distinct(best[best >> 32 > 0] & 0xFFFFFFFF)  # the largest of a window that moves on never moves back


def cut_points(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ends of all chunks (every text ends one)."""
    return np.union1d(_inner_cuts(buf, off), off[1:][np.diff(off) > 0])


def keys(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(digests, begins, ends, first): chunks between two cuts of a text, the
    digest also of the ``SEEN`` bytes before; text i has first[i]:first[i+1]."""
    cuts = _inner_cuts(buf, off)
    text = np.searchsorted(off, cuts, "right") - 1
    pair = np.flatnonzero(text[1:] == text[:-1])
    begin, end = cuts[pair], cuts[pair + 1]
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(len(buf) - 1, 0), _P)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(KEYS[buf] * powers[:len(buf)])])
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(buf), _P_INVERSE)]))
    digest = (total[end] - total[begin - SEEN]) * back[begin - SEEN]
    digest = mix(digest ^ ((end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return digest.view(np.int64), begin, end, np.searchsorted(text[pair], np.arange(len(off)))


def chunk(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digests, byte lengths, first) - text i has chunks first[i]:first[i+1]."""
    cuts = cut_points(buf, off)
    begins = np.concatenate([[0], cuts[:-1]]).astype(np.int64) if len(cuts) else cuts.astype(np.int64)
    powers = np.cumprod(np.full(MAX_BYTES, _P))
    rank = np.arange(len(buf)) - np.repeat(begins, cuts - begins)
    value = KEYS[buf] * powers[rank]
    digest = np.add.reduceat(value, begins) if len(begins) else np.zeros(0, np.uint64)
    length = (cuts - begins).astype(np.int64)
    digest = mix(digest ^ (length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return digest, length, np.searchsorted(begins, off)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            buf, off = text_buffers(part.column("text"))
            digest, length, first = chunk(buf, off)
            start = np.concatenate([[0], np.cumsum(length)])
            chars = np.diff(np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[start])
            lists = lambda v: pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(v))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "uid": part.column("uid"), "digests": lists(digest.view(np.int64)),
                "bytes": lists(length.astype(np.int32)), "chars": lists(chars.astype(np.int32))})


def _list(batch: pa.RecordBatch, column: str, i: int) -> np.ndarray:
    values = batch.column(column)[i].values
    return values.to_numpy(zero_copy_only=False) if values is not None else np.zeros(0, np.int64)


# ------------------------------------------------------------------ passages

def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different keys of every text."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            digest, _, _, first = keys(*text_buffers(part.column("text")))
            own = [np.unique(digest[a:b]) for a, b in zip(first[:-1], first[1:])]
            first = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            yield pa.RecordBatch.from_pydict({"uid": part.column("uid"), "digests": pa.ListArray.from_arrays(
                pa.array(first, pa.int32()), pa.array(np.concatenate(own), pa.int64()))})


def _heads(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a character begins at a byte or the end, characters before it)."""
    head = np.append((buf & 0xC0) != 0x80, True)
    return head, np.concatenate([[0], np.cumsum(head[:-1])])


def stretches(digest, begin, end, size, known, others, counts):
    """(other document, low, high, askers) of what a text of ``size`` bytes
    has to ask: per run of adjacent repeated keys and other document the
    bytes around the keys they share. ``known`` is sorted."""
    at = np.minimum(np.searchsorted(known, digest), len(known) - 1)
    hit = np.flatnonzero(known[at] == digest)
    if not len(hit):
        return []
    at, begin, end = at[hit], begin[hit], end[hit]
    new = np.append(True, np.diff(hit) != 1)
    run = np.cumsum(new) - 1
    edge = np.append(np.flatnonzero(new), len(hit))
    run_lo, run_hi = begin[edge[:-1]] - SEEN - WIDTH, end[edge[1:] - 1] + WIDTH
    out = []
    for other, asks in others:
        rows = np.flatnonzero(asks[at])
        if not len(rows):
            continue
        rows = rows[np.lexsort((rows, other[at[rows]], run[rows]))]
        who, where = other[at[rows]], run[rows]
        first = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (where[1:] != where[:-1])))
        lo = np.maximum(np.minimum.reduceat(begin[rows], first) - REACH, run_lo[where[first]])
        hi = np.minimum(np.maximum.reduceat(end[rows], first) + REACH, run_hi[where[first]])
        most = np.maximum.reduceat(counts[at[rows]], first)
        out += zip(who[first].tolist(), np.maximum(lo, 0).tolist(), np.minimum(hi, size).tolist(), most.tolist())
    return out


ASKED = "partner long, salt int, kind int, rid long, doc_id long, uid long, at long, data binary"


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What every text asks other documents. The last document of a key asks
    the first one, which need not ask back: answers are for both."""
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            out: dict[str, list] = {f.name: [] for f in _ASKED}
            ids, uids, rids = (part.column(c).to_pylist() for c in ("doc_id", "uid", "rid"))
            all_bytes, off = text_buffers(part.column("text"))
            digest, begin, end, key = keys(all_bytes, off)
            for i in range(part.num_rows):
                buf, own = all_bytes[off[i]:off[i + 1]], slice(key[i], key[i + 1])
                known, firsts, lasts, counts = (_list(part, c, i) for c in ("digests", "firsts", "lasts", "counts"))
                order = np.argsort(known)
                known, firsts, lasts, counts = known[order], firsts[order], lasts[order], counts[order]
                later = firsts != uids[i]
                found = stretches(digest[own], begin[own] - off[i], end[own] - off[i], len(buf), known,
                                  ((firsts, later), (lasts, later & (lasts != uids[i]))), counts)
                if not found:
                    continue
                head, chars = _heads(buf)
                raw, spread = buf.tobytes(), int(mix(np.array([uids[i]], np.int64).view(np.uint64))[0])
                for who, lo, hi, most in found:
                    while not head[lo]:  # whole characters
                        lo -= 1
                    while not head[hi]:
                        hi += 1
                    if hi - lo >= PASSAGE_BYTES:
                        row = (who, spread % -(-most // ASKERS), 1, rids[i], ids[i], uids[i], int(chars[lo]), raw[lo:hi])
                        for column, v in zip(out.values(), row):
                            column.append(v)
            yield pa.RecordBatch.from_pydict({f.name: pa.array(out[f.name], f.type) for f in _ASKED})


_ASKED = pa.schema([("partner", pa.int64()), ("salt", pa.int32()), ("kind", pa.int32()), ("rid", pa.int64()),
                    ("doc_id", pa.int64()), ("uid", pa.int64()), ("at", pa.int64()), ("data", pa.binary())])


def _runs(buf: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Per text its keys sorted by digest: (digest, first begin, step, count);
    equal keys one behind the other (a periodic stretch) are one."""
    digest, begin, end, key = keys(buf, off)
    text = np.repeat(np.arange(len(off) - 1), np.diff(key))
    new = np.ones(len(digest), bool)
    new[1:] = (digest[1:] != digest[:-1]) | (begin[1:] != end[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(digest)))
    order = np.lexsort((digest[first], text[first]))
    first, count = first[order], count[order]
    columns = digest[first], begin[first] - off[text[first]], (end - begin)[first], count
    edge = np.searchsorted(text[first], np.arange(len(off))).tolist()
    return [tuple(c[a:b] for c in columns) for a, b in zip(edge[:-1], edge[1:])]


def _diagonals(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> Iterator[np.ndarray]:
    """Differences of place at which equal keys of two texts meet. Periodic
    stretches meet around both ends, and between in steps of the shorter one."""
    lo = b[0].searchsorted(a[0], "left")
    n, i = b[0].searchsorted(a[0], "right") - lo, 0
    some = n.nonzero()[0]
    a, lo, n = tuple(c[some] for c in a), lo[some], n[some]
    total = n.cumsum()
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, "right")))
        x = np.repeat(np.arange(i, j), n[i:j])
        y = np.arange(len(x)) - np.repeat(np.cumsum(n[i:j]) - n[i:j], n[i:j]) + np.repeat(lo[i:j], n[i:j])
        i, shift = j, b[1][y] - a[1][x]
        more, less = b[3][y] - a[3][x], np.minimum(b[3][y], a[3][x])
        if not (more.any() or (less > 1).any()):
            yield _distinct(np.sort(shift))
            continue
        steps = -(-np.abs(more) // less) + 1
        k = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
        by = np.minimum(k * np.repeat(less, steps), np.repeat(np.abs(more), steps)) * np.repeat(np.sign(more), steps)
        step = a[2][x]
        found = [np.repeat(shift, steps) + by * np.repeat(step, steps)]
        # a periodic stretch begins and ends up to MAX_BYTES from its first and last key
        both = np.flatnonzero(less > 1)
        if len(both):
            near = -(-MAX_BYTES // step[both])
            wide = 2 * near + 1
            k = (np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide + near, wide)) * np.repeat(step[both], wide)
            ends = shift[both], shift[both] + more[both] * step[both]
            found += [np.repeat(end, wide) + k for end in ends]
        yield np.unique(np.concatenate(found))


class Text:
    """A text that stretches are compared with: its bytes between ``EDGE``
    bytes on either side, its keys, and once asked for the places of each key
    (none where a stretch is periodic)."""

    def __init__(self, buf: np.ndarray, runs):
        self.framed = np.zeros(len(buf) + 2 * EDGE, np.uint8)
        self.framed[EDGE:EDGE + len(buf)] = buf
        self.runs, self._places = runs, None

    @property
    def places(self) -> dict[int, list[int]]:
        if self._places is None:
            self._places = {}
            if (self.runs[3] == 1).all():
                for digest, begin in zip(self.runs[0].tolist(), self.runs[1].tolist()):
                    self._places.setdefault(digest, []).append(begin)
        return self._places


def _shifts(n: int, piece_runs, text: Text) -> Iterator[np.ndarray]:
    """The diagonals of a piece, those of a short one with few common keys by
    looking its keys up."""
    if n <= EDGE and text.places and (piece_runs[3] == 1).all():
        found = [(begin, text.places[digest]) for digest, begin in zip(piece_runs[0].tolist(), piece_runs[1].tolist())
                 if digest in text.places]
        if sum(len(at) for _, at in found) <= EDGE:
            yield np.array(sorted({y - begin for begin, at in found for y in at}), np.int64)
            return
    yield from _diagonals(piece_runs, text.runs)


def equal_stretches(piece: np.ndarray, piece_runs, text: Text) -> list[tuple[int, int, int]]:
    """(begin, end, place in the text) of all equal stretches of
    ``PASSAGE_BYTES`` and more along diagonals with a common key."""
    out = []
    framed = text.framed
    n, size = len(piece), len(framed) - 2 * EDGE
    for shifts in _shifts(n, piece_runs, text):
        shifts = shifts[(shifts >= PASSAGE_BYTES - n) & (shifts <= size - PASSAGE_BYTES)]
        if n > EDGE or len(shifts) <= 2:
            for d in shifts.tolist():
                lo, hi = max(0, -d), min(n, size - d)
                unlike = (piece[lo:hi] != framed[EDGE + lo + d:EDGE + hi + d]).nonzero()[0]
                edges = np.empty(len(unlike) + 2, np.int64)
                edges[0], edges[1:-1], edges[-1] = -1, unlike, hi - lo
                for k in (edges[1:] - edges[:-1] > PASSAGE_BYTES).nonzero()[0].tolist():
                    x, y = lo + int(edges[k]) + 1, lo + int(edges[k + 1])
                    out.append((x, y, x + d))
            continue
        places = np.ndarray((len(framed) - n + 1, n), np.uint8, framed, 0, (1, 1))  # all stretches of n bytes
        many = max(1, PAIRS // n)
        for i in range(0, len(shifts), many):
            some = shifts[i:i + many]
            unlike = np.ones((len(some), n + 1), bool)  # a row a diagonal, a border behind each
            np.not_equal(places[some + EDGE], piece, out=unlike[:, :n])
            for row in ((some < 0) | (some > size - n)).nonzero()[0].tolist():  # beyond the text
                unlike[row, :max(0, -int(some[row]))] = True
                unlike[row, size - int(some[row]):] = True
            edges = unlike.ravel().nonzero()[0]
            width = edges.copy()
            width[0] += 1
            width[1:] -= edges[:-1]
            for k in (width > PASSAGE_BYTES).nonzero()[0].tolist():
                y, d = int(edges[k]) % (n + 1), int(some[edges[k] // (n + 1)])
                x = y - int(width[k]) + 1
                out.append((x, y, x + d))
    return out


def _spans(spans: list[tuple[int, int, int]], head: np.ndarray, chars: np.ndarray, at: int) -> list[tuple[int, int, int]]:
    """Whole characters of (begin, end, document) as code points, joined where
    they touch, with the smallest document."""
    out: list[tuple[int, int, int]] = []
    for x, y, other in sorted(spans):
        while x < y and not head[x]:
            x += 1
        while x < y and not head[y]:
            y -= 1
        x, y = at + int(chars[x]), at + int(chars[y])
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]), min(other, out[-1][2]))
        else:
            out.append((x, y, other))
    return out


def _needed(part: pa.RecordBatch) -> pa.Array:
    """Rows but for texts that nobody asks: groups of texts alone, unless they
    are the last one, which may go on."""
    partner, salt, kind = (part.column(c).to_numpy(zero_copy_only=False) for c in ("partner", "salt", "kind"))
    group = np.cumsum(np.append(True, (partner[1:] != partner[:-1]) | (salt[1:] != salt[:-1]))) - 1
    asked = np.bincount(group, kind) > 0
    asked[-1] = True
    return pa.array(asked[group])


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (partner, salt), its texts first: passages of the texts and of
    those that ask."""
    here, texts = None, []  # of the current partner: row, text, spans

    def flush(out):
        for (rid, doc_id, _), text, spans in texts:
            if spans:
                out += [(rid, doc_id, *x) for x in _spans(spans, *_heads(text.framed[EDGE:-EDGE]), 0)]

    def made(rows):
        return pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], pa.int64())
                                           for i, k in enumerate(("rid", "doc_id", "start", "end", "first_doc"))})
    for batch in batches:
        for part in slices(batch, "data", SLICE):
            part = part.filter(_needed(part))
            out: list[tuple] = []
            cols = {k: part.column(k).to_pylist() for k in ("partner", "salt", "kind", "rid", "doc_id", "uid", "at")}
            data, off = text_buffers(part.column("data"))
            runs = _runs(data, off)
            for i in range(part.num_rows):
                group = cols["partner"][i], cols["salt"][i]
                row = cols["rid"][i], cols["doc_id"][i], cols["uid"][i]
                if group != here:
                    flush(out)
                    here, texts = group, []
                buf = data[off[i]:off[i + 1]]
                if not cols["kind"][i]:
                    texts.append((row, Text(buf, runs[i]), []))
                    continue
                spans = []
                for other, text, back in texts:
                    first = min(row[2], other[2])
                    for x, y, z in equal_stretches(buf, runs[i], text):
                        spans.append((x, y, first))
                        back.append((z, z + y - x, first))
                if spans:
                    out += [(*row[:2], *x) for x in _spans(spans, *_heads(buf), cols["at"][i])]
            yield made(out)
    out = []
    flush(out)
    yield made(out)


def _uid():
    """Documents are told apart by doc_id; rows without one by their text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("uid")


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row per document: its chunk digests, byte and character lengths."""
    workers_can_import(docs.sparkSession)
    rows = take_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), _uid(), "text")
    return landed(rows.mapInArrow(_chunked, "doc_id long, uid long, digests array<long>, bytes array<int>, "
                                            "chars array<int>"), "chunks")


def _each(chunks: DataFrame) -> DataFrame:
    return chunks.select("uid", F.explode(F.array_distinct("digests")).alias("digest"))


def repeated_chunks(chunks: DataFrame) -> DataFrame:
    """(digest, first): chunks of more than one document, and the smallest
    of these documents, which keeps the chunk when copies are dropped."""
    return _each(chunks).groupBy("digest").agg(F.min("uid").alias("first"), F.max("uid").alias("last")) \
        .where("first <> last").select("digest", "first")


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _landed_questions(texts: DataFrame) -> DataFrame:
    """What all texts ask, as a written table, by way of a table of the
    repeated keys. The shuffle files of either write go when it ends: nothing
    reads them again."""
    each = texts.select("uid", "text").mapInArrow(_keyed, "uid long, digests array<long>") \
        .select("uid", F.explode("digests").alias("digest"))
    repeated = each.groupBy("digest").agg(F.min("uid").alias("first"), F.max("uid").alias("last"),
                                          F.count("*").alias("n")).where("first <> last")
    spark = texts.sparkSession
    was = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        repeated = landed(repeated, "repeated")
        # by document: a document's own repeated keys, never the copies of a key
        own = each.join(repeated, "digest").groupBy("uid").agg(
            F.collect_set(F.struct("digest", "first", "last", "n")).alias("own"))
        asked = texts.join(own, "uid").select(
            "doc_id", "uid", "rid", "text", F.col("own.digest").alias("digests"), F.col("own.first").alias("firsts"),
            F.col("own.last").alias("lasts"), F.col("own.n").alias("counts")).mapInArrow(_asked, ASKED)
        return landed(asked, "asked")
    finally:
        spark.conf.set(FREE_SHUFFLES, was)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per passage that other documents have too: doc_id, start and
    end (code points), first_doc (smallest document it was found in)."""
    workers_can_import(docs.sparkSession)
    texts = take_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), _uid(), "text").withColumn("rid", F.xxhash64("uid", "text"))
    asked = _landed_questions(texts)
    # a text that many ask stands in several places
    salts = asked.where("salt > 0").select("partner", "salt").distinct()
    one = texts.select(F.col("uid").alias("partner"), F.lit(0).alias("salt"), F.lit(0).alias("kind"), "rid", "doc_id",
                       "uid", F.lit(0).cast("long").alias("at"), F.col("text").cast("binary").alias("data")) \
        .where("length(data) >= %d" % PASSAGE_BYTES)
    several = one.drop("salt").join(salts, "partner").select(*one.columns)
    spans = one.unionByName(several).unionByName(asked).repartition("partner", "salt") \
        .sortWithinPartitions("partner", "salt", "kind").mapInArrow(
            _answered, "rid long, doc_id long, start long, end long, first_doc long")
    before = Window.partitionBy("rid", "doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("rid", "doc_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    apart = spans.distinct().withColumn("reach", F.max("end").over(before)) \
        .withColumn("island", F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(upto))
    return apart.groupBy("rid", "doc_id", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_doc").alias("first_doc")) \
        .select("doc_id", "start", "end", "first_doc")


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            buf, off = text_buffers(part.column("text"))
            digest, length, first = chunk(buf, off)
            texts = []
            for i in range(part.num_rows):
                a, b = first[i], first[i + 1]
                stay = ~np.isin(digest[a:b].view(np.int64), _list(part, "extra", i))
                own = buf[off[i]:off[i + 1]][np.repeat(stay, length[a:b])]
                texts.append(own.tobytes().decode("utf-8"))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "text": pa.array(texts, pa.string())})


def drop_repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id and text without the chunks that a smaller document keeps."""
    chunks = chunk_table(docs)
    own = _each(chunks).join(repeated_chunks(chunks), "digest").where("first <> uid").groupBy("uid").agg(
        F.collect_list("digest").alias("extra"))
    texts = take_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), _uid(), "text")
    return texts.join(own, "uid", "left").select("doc_id", "text", "extra").mapInArrow(
        _dropped, "doc_id long, text string")
