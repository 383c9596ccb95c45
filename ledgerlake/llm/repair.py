"""Token ids in Re-Pair compressed shards with random access (operator 1).

Texts are encoded with a public tokenizer file, an end id closes each
document, and documents are dealt in ascending ``doc_id`` order to contiguous
shards. Each shard is a sequence of blocks; a block is one grammar: the most
frequent pair of symbols is replaced by a new symbol until no pair occurs twice,
and the block stores the rules, the expansion length of every symbol and the
remaining sequence. Decoding any range of ids touches only the symbols whose
expansions cover it.

File format (one Parquet row per block, written by Spark's commit protocol):

====================  =====================================================
shard, block          position of the block; blocks of a shard are in order
n_tokens              ids the block expands to
doc_ids, doc_tokens   documents of the block and their id counts
width                 bytes of a symbol, 2 or (when symbols need it) 4
rules                 pairs of symbols; rule k defines symbol base + k
base                  first nonterminal
rule_len              uint32 expansion length of each rule
seq                   the sequence of symbols (both: lower 16 bits of all, then
                      with width 4 the upper 16 bits of all)
skip                  uint32 expansion offset of every ``SKIP``-th symbol
====================  =====================================================

Defined results: null text encodes as empty (just the end id); null doc_ids
come first; rows with equal doc_id are ordered by text (null as empty);
repeated rows are kept; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import os
import zlib
from collections.abc import Iterator
from itertools import islice, repeat
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerlake.llm.common import (broadcast_if_small, range_bucket, shuffle_partitions, slices, take_columns, text_buffers,
                                   workers_can_import)

BLOCK_TOKENS = 1 << 19   # ids per grammar (a longer document has a block of its own)
MIN_COUNT = 2            # pairs are replaced until none occurs so often
BAND = 0.9               # pairs looked at in one step: down to this part of the largest count,
AT_ONCE = 4096           # at most so many (steps only group replacements, their order is exact)
STARTS = 1_000_000       # block starts that are broadcast (beyond: a shuffled join)
LISTED = 0.5             # pairs are kept in sight down to this part of the largest count
SKIP = 256
CACHED_PIECES = 1_000_000  # distinct pieces whose ids a worker remembers,
PIECE_BYTES = 64         # none longer than this
JOINED = 100             # unknown words encoded as one text
TEXT_BYTES = 2 << 20     # text encoded at once

BLOCKS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
                    ("base", pa.int32()), ("width", pa.int32()), ("rules", pa.binary()),
                    ("rule_len", pa.binary()), ("seq", pa.binary()), ("skip", pa.binary())])
BLOCKS_DDL = ("shard int, block int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, base int, "
              "width int, rules binary, rule_len binary, seq binary, skip binary")


# ------------------------------------------------------------------ grammar

def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, lengths) of the runs of equal values."""
    if not len(ordered):
        return np.zeros((2, 0), np.int64)
    edge = np.ones(len(ordered) + 1, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=edge[1:-1])
    edges = np.flatnonzero(edge)
    return edges[:-1], edges[1:] - edges[:-1]


def _grouped(first: np.ndarray, second: np.ndarray, places: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """(places ordered by the pair of symbols there, how many each pair has,
    code of each pair). ``bits`` a symbol at most."""
    shift = int(places.max()).bit_length() if len(places) else 0
    if 2 * bits + shift <= 63:  # one sort of whole numbers
        key = first.astype(np.int64)
        key <<= bits
        key |= second
        key <<= shift
        key |= places
        key.sort()
        places = key & ((1 << shift) - 1)
        key >>= shift
    else:
        key = (first.astype(np.int64) << bits) | second
        order = np.argsort(key, kind="stable")
        key, places = key[order], places[order]
    begins, times = _runs(key)
    code = key[begins]
    return places, times, (code >> bits << 32) | (code & ((1 << bits) - 1))


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of every range, one after the other."""
    ends = np.cumsum(sizes)
    out = np.repeat(begins - (ends - sizes), sizes)
    out += np.arange(len(out))
    return out


def _in_order(count: np.ndarray, twin: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs can be replaced at once, with the same result as one after
    the other, always the most frequent one.

    Pairs are ranked by ``count``, descending; ``left`` and ``right`` are the
    ranks of every two places that share a symbol. A pair that shares no symbol
    with a replaced one keeps its count, so it has its turn while that is not
    below what the others can still reach: a pair that waits reaches its count
    less the places it lost, a pair with a new symbol the number of shared
    symbols it comes from. For a pair of equal symbols (``twin``), whose count
    depends on whole runs, its own count is the bound.
    """
    n = len(count)
    high, low = np.maximum(left, right), np.minimum(left, right)
    key = (high * n + low) * 2 + (left < right)
    key.sort()
    begins, times = _runs(key)
    key = key[begins]
    meet = list(zip((key // (2 * n)).tolist(), (key // 2 % n).tolist(), (key & 1).tolist(), times.tolist()))
    own = set(np.flatnonzero(twin).tolist())
    if own:
        meet = sorted(meet + [(rank, rank, 0, 0) for rank in own])
    counts, now = count.tolist(), [True] * n
    least = i = 0
    while i < len(meet):
        rank = meet[i][0]
        if counts[rank] < least:
            break
        sides, replaced, waiting = [0, 0], 0, 0
        while i < len(meet) and meet[i][0] == rank:
            _, other, side, k = meet[i]
            i += 1
            if other == rank:
                continue
            if now[other]:
                sides[side] += k
                replaced = max(replaced, k)
            else:
                waiting = max(waiting, k)
        if replaced:
            now[rank] = False
        if rank in own:
            bound = counts[rank]
        elif replaced:
            bound = max(counts[rank] - max(sides), replaced)
        else:
            bound = waiting
        least = max(least, bound)
    return np.array(now) & (count >= least)


def compress(ids: np.ndarray, base: int, least: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, rules) of Re-Pair: the most frequent pair gets a new symbol
    and is replaced, again and again, until no pair occurs ``least`` times.

    All pairs are counted exactly (in a run of one symbol every other one, as
    replacement from the left takes them); counts follow each replacement
    through a linked list of places. A pair's places are listed when its younger
    symbol is made, as it cannot come about later. Of equally frequent pairs any
    may come first; ``_in_order`` finds those that are replaced in one step.
    """
    n = len(ids)
    symbol = np.concatenate([[-1], ids, [-1]]).astype(np.int32)  # -1 before and after, -2 a place that is gone
    after, before = np.arange(1, n + 3), np.arange(-1, n + 1)
    pair = np.zeros(n + 2, np.int64)       # number of the pair that begins here; 0: none that counts
    # of each pair number: count, code, its range in ``listed``, rank in this step
    count, code, begin, size = np.zeros((4, 1 << 16), np.int64)
    rank = np.full(1 << 16, -1)
    listed, filled = np.zeros(n + 1, np.int64), 0
    pairs, made, rules = 1, base, []
    twins: dict[int, int] = {}             # symbol -> its pair with itself
    twin_at = np.zeros(0, np.int64)        # places of such pairs in runs of three and more,
    twin_of = np.zeros(0, np.int32)        # and their symbols
    front, floor = np.zeros(0, np.int64), 1 << 62  # pairs that counted floor when looked at last
    changed, first, second = np.arange(1, n), symbol[1:n], symbol[2:n + 1]
    while True:
        # pairs at changed places hold a new symbol, so none has a number yet
        fresh = changed[first == second]
        places, times, codes = _grouped(first, second, changed, made.bit_length())
        often = times >= least
        places = places[np.repeat(often, times)]
        times, codes = times[often], codes[often]
        end = pairs + len(times)
        while end > len(count):
            count, code, begin, size = [np.append(x, np.zeros_like(x)) for x in (count, code, begin, size)]
            rank = np.append(rank, np.full_like(rank, -1))
        while filled + len(places) > len(listed):
            listed = np.append(listed, np.zeros_like(listed))
        listed[filled:filled + len(places)] = places
        count[pairs:end], size[pairs:end], code[pairs:end] = times, times, codes
        begin[pairs:end] = filled + np.cumsum(times) - times
        filled += len(places)
        pair[places] = np.repeat(np.arange(pairs, end), times)
        fresh = fresh[pair[fresh] > 0]
        lost = np.zeros(0, bool)
        if len(twin_at):
            lost = (symbol[twin_at] != twin_of) | (symbol[after[twin_at]] != twin_of)
        if len(fresh) or lost.any():  # else all runs are as they were
            twins.update(zip(symbol[fresh].tolist(), pair[fresh].tolist()))
            touched = np.zeros(made, bool)  # symbols whose runs lost places
            touched[twin_of[lost]] = True
            again = touched[twin_of]
            runs = np.sort(np.concatenate([twin_at[again & ~lost], fresh]))
            begins = np.ones(len(runs), bool)
            begins[1:] = after[runs[:-1]] != runs[1:]
            number = np.arange(len(runs))
            odd = (number - np.maximum.accumulate(np.where(begins, number, 0))) % 2 == 1
            hidden, shown = runs[odd], runs[~odd]
            np.subtract.at(count, pair[hidden], 1)
            pair[hidden] = 0
            shown = shown[pair[shown] == 0]
            pair[shown] = [twins.get(x, 0) for x in symbol[shown].tolist()]
            np.add.at(count, pair[shown], 1)
            runs = runs[~(begins & np.append(begins[1:], True))]
            twin_at, twin_of = (np.concatenate([twin_at[~again], runs]),
                                np.concatenate([twin_of[~again], symbol[runs]]))
        count[0] = 0
        # the most frequent pairs; counts of pairs that have a number only fall
        front = np.concatenate([front, pairs + np.flatnonzero(count[pairs:end] >= floor)])
        pairs = end
        front = front[count[front] >= floor]
        top = int(count[front].max()) if len(front) else 0
        lowest = max(least, ceil(top * BAND))
        if not len(front) or lowest < floor:
            top = int(count[:pairs].max())
            if top < least:
                break
            lowest, floor = max(least, ceil(top * BAND)), max(least, int(top * LISTED))
            front = np.flatnonzero(count[:pairs] >= floor)
        best = front[count[front] >= lowest]
        best = best[np.argsort(-count[best], kind="stable")[:AT_ONCE]]
        # their places and where two of them meet
        where = listed[_ranges(begin[best], size[best])]
        rank_at = np.repeat(np.arange(len(best)), size[best])
        here = np.flatnonzero(pair[where] == best[rank_at])
        where, rank_at = where[here], rank_at[here]
        rank[best] = np.arange(len(best))
        rank_next = rank[pair[after[where]]]
        rank[best] = -1
        meet = np.flatnonzero(rank_next >= 0)
        of = code[best]
        go = _in_order(count[best], of >> 32 == of & 0xFFFFFFFF, rank_at[meet], rank_next[meet])
        # replace: the right place of each pair goes, its neighbours' pairs change
        rules.append(of[go])
        new = (made - 1 + np.cumsum(go)).astype(np.int32)
        if not go.all():
            here = np.flatnonzero(go[rank_at])
            where, rank_at = where[here], rank_at[here]
        right = after[where]
        np.subtract.at(count, pair[right], 1)
        pair[right] = pair[where] = 0
        np.subtract.at(count, pair[before[where]], 1)
        count[best[go]] = 0
        own = new[rank_at]
        symbol[where], symbol[right] = own, -2
        beyond = after[right]
        after[where] = beyond
        before[beyond] = where
        left = before[where]
        before_it, behind = symbol[left], symbol[beyond]
        on_left, on_right = np.flatnonzero((before_it >= 0) & (before_it < made)), np.flatnonzero(behind >= 0)
        left = left[on_left]
        pair[left] = 0
        changed = np.concatenate([where[on_right], left])
        first = np.concatenate([own[on_right], before_it[on_left]])
        second = np.concatenate([behind[on_right], own[on_left]])
        made += len(rules[-1])
    rules = np.concatenate([np.zeros(0, np.int64), *rules])
    return symbol[symbol >= 0].astype(np.uint32), np.stack([rules >> 32, rules & 0xFFFFFFFF], 1).astype(np.uint32)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule expands to. Rules only use earlier symbols, so passes
    as many as the grammar is deep settle."""
    length = np.ones(base + len(rules), np.int64)
    own = length[base:]
    while True:
        new = length[rules[:, 0]] + length[rules[:, 1]] if len(rules) else own
        if np.array_equal(new, own):
            return own.astype(np.uint32)
        own[:] = new


def expand(seq: np.ndarray, rules: np.ndarray, rule_len: np.ndarray, base: int) -> np.ndarray:
    """Ids of a symbol sequence: every symbol is spelled out once, then one
    gather writes all ids."""
    length = np.concatenate([np.ones(base, np.int64), rule_len.astype(np.int64)])
    begin = np.concatenate([[0], np.cumsum(length)])
    spelled = np.zeros(int(begin[-1]), np.uint32)
    spelled[:base] = np.arange(base, dtype=np.uint32)
    order = np.argsort(rule_len, kind="stable")  # parts are shorter, hence spelled before
    bounds = np.flatnonzero(np.diff(rule_len[order].astype(np.int64))) + 1
    for group in np.split(order, bounds) if len(order) else []:
        n = int(rule_len[group[0]])
        at = (begin[base + group][:, None] + np.arange(n)).ravel()
        spelled[at] = _gather(rules[group].ravel(), spelled, begin, length)
    return _gather(seq, spelled, begin, length)


def _gather(symbols: np.ndarray, spelled: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    n = length[symbols]
    end = np.cumsum(n)
    total = int(end[-1]) if len(end) else 0
    at = np.repeat(begin[symbols] - (end - n), n)
    at += np.arange(total)
    return spelled[at]


def _to_bytes(symbols: np.ndarray, width: int) -> bytes:
    """Lower halves of all symbols, then (width 4) the upper ones, which are
    nearly all alike and cost little in the compressed file."""
    low = symbols.astype(np.uint16).tobytes()
    return low if width == 2 else low + (symbols >> 16).astype(np.uint16).tobytes()


def _from_bytes(raw: bytes, width: int) -> np.ndarray:
    halves = np.frombuffer(raw, np.uint16)
    if width == 2:
        return halves
    low, high = np.split(halves, 2)
    return low | (high.astype(np.uint32) << 16)


def pack_block(ids: np.ndarray, base: int) -> dict:
    seq, rules = compress(ids, base)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    rule_len = expansion_lengths(rules, base)
    length = np.ones(len(seq), np.int64)
    high = seq >= base
    length[high] = rule_len[seq[high] - base]
    at = np.cumsum(length) - length
    return {"n_tokens": len(ids), "base": base, "width": width, "rules": _to_bytes(rules, width),
            "rule_len": rule_len.tobytes(), "seq": _to_bytes(seq, width),
            "skip": at[::SKIP].astype(np.uint32).tobytes()}


def unpack(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (_from_bytes(block["seq"], block["width"]), _from_bytes(block["rules"], block["width"]).reshape(-1, 2),
            np.frombuffer(block["rule_len"], np.uint32), np.frombuffer(block["skip"], np.uint32))


def decode_range(block: dict, start: int, count: int) -> np.ndarray:
    """Ids ``start .. start + count`` of a block, decoding only the symbols
    that cover them (found through the skip table and the rule lengths)."""
    seq, rules, rule_len, skip = unpack(block)
    if count <= 0 or not len(seq):
        return np.zeros(0, np.uint32)
    lo = int(np.searchsorted(skip, start, "right")) - 1
    hi = int(np.searchsorted(skip, start + count, "left"))
    part = seq[lo * SKIP:hi * SKIP]
    ids = expand(part, rules, rule_len, block["base"])
    skipped = start - int(skip[lo])
    return ids[skipped:skipped + count]


# ----------------------------------------------------------------- tokenizer

_ENCODERS: dict[str, "Encoder"] = {}
# how a byte-level vocabulary writes bytes: printable ones as they are, the
# others as the characters from U+0100 on, in order
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ODD = dict(zip([b for b in range(256) if b not in _PRINTED], map(chr, range(0x100, 0x200))))
_BYTES = "".join(_ODD.get(b, chr(b)) for b in range(255)) + " "  # 255 is in no UTF-8 text: divides words

# kinds of bytes; SURE begins a character that is no white space, of OTHER ones nothing is known
LETTER, DIGIT, MARK, QUOTE, SPACE, LINE, SURE, OTHER = range(8)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[0x21:0x7F] = MARK
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_KIND[0x30:0x3A] = DIGIT
_KIND[[0x20, 0x0A, 0x27]] = SPACE, LINE, QUOTE
_KIND[[*range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = SURE


def _cuts_before(kinds: int) -> int:
    """Is there a cut before a byte, from its kind and those beside it
    (before, own, after: three bits each); 2: and after it."""
    before, own, after = kinds >> 6, kinds >> 3 & 7, kinds & 7
    if own == SPACE:
        return int(after <= QUOTE or after == SURE)
    if own == LINE:
        return 2 * int(before <= QUOTE and after <= QUOTE)
    if own > QUOTE or before > QUOTE or before == QUOTE and own == LETTER:  # as in it's
        return 0
    return int(min(before, MARK) != min(own, MARK))


_CUT = np.array([_cuts_before(k) for k in range(512)], np.uint8)


def _kinds(raw: np.ndarray) -> np.ndarray:
    kind = _KIND[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)  # U+00C0 to U+00FF, letters but for two signs
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    return kind


def _single_words(pieces: list[bytes]) -> np.ndarray:
    """Which pieces are one word of the pre-split for certain, and not long:
    letters, digits or marks, a space before them or not, or a line feed."""
    kind = _kinds(np.frombuffer(b"".join(pieces), np.uint8))
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begin = np.cumsum(size) - size
    own = np.where(kind == QUOTE, MARK, kind)
    same = own <= MARK
    same[1:] &= own[1:] == own[:-1]
    same[begin] = (own[begin] <= SPACE) | (own[begin] == LINE) & (size == 1)
    spaced = begin[(own[begin] == SPACE) & (size > 1)] + 1
    same[spaced] = own[spaced] <= MARK
    return np.logical_and.reduceat(same, begin) & (size <= PIECE_BYTES)


def _pieces(raw: np.ndarray, off: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Where the pieces begin of texts ``raw[off[i]:off[i+1]]``, all in one
    buffer; those in ``whole`` are not cut."""
    kind = _kinds(raw)
    around = kind.astype(np.uint16) << 3
    begins, ends = off[:-1][off[:-1] < off[1:]], off[1:][off[:-1] < off[1:]]
    last = kind[ends - 1]
    kind[ends - 1] = OTHER                      # nothing before a text
    around[1:] += kind[:-1].astype(np.uint16) << 6
    around[0] += OTHER << 6
    kind[ends - 1] = last
    kind[begins] = OTHER                        # nor after it
    around[:-1] += kind[1:]
    around[-1] += OTHER
    cut = _CUT[around]
    cut[np.flatnonzero(cut == 2) + 1] = 1
    for i in whole.tolist():
        cut[off[i]:off[i + 1]] = 0
    cut[begins] = 1
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts, with a bounded memory of pieces.

    Texts are cut where the byte-level tokenizer's own pre-split always cuts
    too: before a space that no white space follows, around a single line feed,
    and where letters, digits and marks meet. Arrow finds the distinct pieces
    of many texts, and each is encoded once and remembered. Pieces that are one
    word of the pre-split go to the tokenizer's model as they are, many at a
    time, written as the vocabulary does and told apart by the lengths of their
    tokens; others are encoded one by one. Texts with one of the tokenizer's
    added tokens are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.words = Tokenizer(self.tok.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.size = self.tok.get_vocab_size()
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.token_bytes = np.zeros(self.size, np.int64)
        for token, i in self.tok.get_vocab().items():
            self.token_bytes[i] = len(token)
        self.known: dict[bytes, int] = {}
        self.ids, self.begin = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)  # begin: one more than pieces

    def _each(self, pieces: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.tok.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]

    def _encoded(self, pieces: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids (in runs) and numbers of ids of pieces that are one word each."""
        runs, sizes = [], []
        groups = [pieces[i:i + JOINED] for i in range(0, len(pieces), JOINED)]
        joined = [codecs.charmap_decode(b"\xff".join(g), "strict", _BYTES)[0] for g in groups]
        for group, e in zip(groups, self.words.encode_batch_fast(joined, add_special_tokens=False) if groups else []):
            ids = np.array(e.ids, np.uint32)
            ends = np.cumsum(self.token_bytes[ids])
            word_ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)))
            at = np.searchsorted(ends, word_ends)
            if not len(ends) or ends[-1] != word_ends[-1] or (ends[at] != word_ends).any():  # a vocabulary without some bytes
                each = self._each(group)
                ids, at = np.concatenate(each), np.cumsum([len(x) for x in each]) - 1
            runs.append(ids)
            sizes.append(np.diff(at, prepend=-1))
        return runs, sizes

    def _learn(self, new: list[bytes]) -> dict[bytes, int]:
        """Numbers of new pieces; the last ones may lie beyond the memory."""
        single = _single_words(new).tolist()
        words = [p for p, one in zip(new, single) if one]
        others = sorted((p for p, one in zip(new, single) if not one), key=len)  # long ones last
        runs, sizes = self._encoded(words)
        each = self._each(others) if others else []
        ids = np.concatenate([*runs, *each])
        sizes = np.concatenate([*sizes, np.array([len(x) for x in each], np.int64)])
        n = len(self.known)
        total = int(self.begin[n])
        while total + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        while n + len(new) >= len(self.begin):
            self.begin = np.append(self.begin, np.zeros_like(self.begin))
        self.ids[total:total + len(ids)] = ids
        self.begin[n + 1:n + 1 + len(new)] = total + np.cumsum(sizes)
        ordered = words + others
        numbers = dict(zip(ordered, range(n, n + len(new))))
        keep = len(new)
        while keep and len(ordered[keep - 1]) > PIECE_BYTES:
            keep -= 1
        keep = min(keep, CACHED_PIECES - n)
        self.known.update(numbers if keep == len(new) else islice(numbers.items(), max(keep, 0)))
        return numbers

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); null
        texts are empty."""
        raw, off = text_buffers(texts)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        data = raw.tobytes()
        whole = [np.flatnonzero(pc.match_substring(texts, x).fill_null(False).to_numpy(zero_copy_only=False))
                 for x in self.added if x.encode() in data]
        starts = _pieces(raw, off, np.concatenate([np.zeros(0, np.int64), *whole]))
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(data)]).dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.known.get, pieces.tolist(), repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh = pieces[new].tolist()
            number[new] = list(map(self._learn(fresh).__getitem__, fresh))
        begin = self.begin[number]
        size = self.begin[number + 1] - begin
        at = np.frombuffer(coded.indices.buffers()[1], np.int32, len(starts))
        n = size[at]
        end = np.cumsum(n)
        place = np.repeat(begin[at] - (end - n), n)
        place += np.arange(len(place))
        before = np.append(0, end)[np.searchsorted(starts, off)]
        return self.ids[place], np.diff(before)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(counts)[:-1]) if texts else []


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ----------------------------------------------------------------- Spark jobs

def _blocks_of(path: str, end_id: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        shard, block, held, ids, counts = None, 0, 0, [], []
        doc_ids: list = []

        def flush():
            nonlocal held, ids, counts, doc_ids, block
            row = {"shard": shard, "block": block, "doc_ids": doc_ids, "doc_tokens": counts,
                   **pack_block(np.concatenate(ids), enc.size)}
            block += 1
            held, ids, counts, doc_ids = 0, [], [], []
            return pa.RecordBatch.from_pylist([row], schema=BLOCKS)

        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                got, sizes = enc.encode_column(part.column("text"))
                ends = np.cumsum(sizes)
                got = np.insert(got, ends, end_id)
                ends += np.arange(1, len(ends) + 1)
                for s, d, n, to in zip(part.column("shard").to_pylist(), part.column("doc_id").to_pylist(),
                                       (sizes + 1).tolist(), ends.tolist()):
                    if held and (s != shard or held + n > block_tokens):
                        yield flush()
                    if s != shard:
                        shard, block = s, 0
                    ids.append(got[to - n:to])
                    held += n
                    counts.append(n)
                    doc_ids.append(d)
        if held:
            yield flush()
    return run


def write_token_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, shards: int | None = None,
                       block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode ``docs(doc_id, text)`` and write Re-Pair blocks under ``path``."""
    spark = docs.sparkSession
    workers_can_import(spark)
    docs = take_columns(docs, "doc_id", "text")
    shards = shards or shuffle_partitions(spark)
    dealt = docs.withColumn("shard", range_bucket(docs, "doc_id", shards))
    ordered = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "doc_id", "text")
    ordered.mapInArrow(_blocks_of(tokenizer, end_id, block_tokens), BLOCKS_DDL) \
        .write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``start``: ids in all blocks before. Prefix sums run over
    shards (a parameter) and inside each shard."""
    blocks = spark.read.schema(BLOCKS_DDL).parquet(path)
    sizes = blocks.select("shard", "block", "n_tokens")
    per_shard = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard = per_shard.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(per_shard, "shard")
              .select("shard", "block", (F.col("shard_start") + F.col("inside")).alias("start")))
    return blocks.join(broadcast_if_small(starts, STARTS), ["shard", "block"])


def _documents_of(digest_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1).to_pylist()[0]
                seq, rules, rule_len, _ = unpack(b)
                ids = expand(seq, rules, rule_len, b["base"])
                ends = np.cumsum(b["doc_tokens"])
                begins = ends - b["doc_tokens"]
                raw = memoryview(ids.astype("<u4").tobytes())
                cols = {"doc_id": pa.array(b["doc_ids"], pa.int64()),
                        "start": pa.array(begins + b["start"], pa.int64()),
                        "n_tokens": pa.array(b["doc_tokens"], pa.int64())}
                if digest_only:
                    cols["ids_crc32"] = pa.array([zlib.crc32(raw[4 * x:4 * y]) for x, y in
                                                  zip(begins.tolist(), ends.tolist())], pa.int64())
                else:
                    cols["ids"] = pa.array([ids[x:y].astype(np.int64) for x, y in
                                            zip(begins.tolist(), ends.tolist())], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(cols)
    return run


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    workers_can_import(spark)
    return read_token_blocks(spark, path).mapInArrow(
        _documents_of(True), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids themselves."""
    workers_can_import(spark)
    return read_token_blocks(spark, path).mapInArrow(
        _documents_of(False), "doc_id long, start long, n_tokens long, ids array<long>")


def compression_report(spark: SparkSession, path: str) -> DataFrame:
    """Per shard: ids, symbols left, rules, and bytes per id."""
    b = spark.read.schema(BLOCKS_DDL).parquet(path)
    size = F.length("seq") + F.length("rules") + F.length("rule_len") + F.length("skip")
    return b.groupBy("shard").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum(F.length("seq") / F.col("width")).cast("long").alias("n_symbols"),
        F.sum(F.length("rules") / (2 * F.col("width"))).cast("long").alias("n_rules"),
        (F.sum(size) / F.sum("n_tokens")).alias("bytes_per_id"))


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the shards to the shared folder, read them back, return digests."""
    from ledgerlake.session import scratch_path
    path = scratch_path(docs.sparkSession, "token-shards")
    write_token_shards(docs, tokenizer, path, end_id)
    return document_digests(docs.sparkSession, path)


__all__ = ["BLOCK_TOKENS", "compress", "compression_report", "decode_range", "document_digests", "encode_documents",
           "expand", "read_documents", "read_token_blocks", "write_token_shards"]
