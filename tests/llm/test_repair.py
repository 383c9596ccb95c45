import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import repair
from ledgerlake.llm.queries import tokenizer_path
from ledgerlake.session import scratch_path
from tests.llm.helpers import docs, edge_docs, empty_docs


def expected(rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("make", [docs, edge_docs])
def test_files_give_back_all_ids(spark, make):
    df = make(spark)
    got = sorted(map(tuple, repair.encode_documents(df, tokenizer_path()).collect()), key=lambda r: r[1])
    assert got == expected([(r["doc_id"], r["text"]) for r in df.collect()])


def test_empty_table(spark):
    assert repair.encode_documents(empty_docs(spark), tokenizer_path()).collect() == []


@pytest.mark.parametrize("text", ["a  b", "a   b c", " lead", "trail ", "x\n y", "x\n\n \n z ", "tab\t t", "  nb  ",
                                  "it's we'll,.. (x). 1,000.", "a\x00b c", "end. ", "  ", "é.è, ñ..", "  em", "q  \n"])
def test_cutting_at_spaces_changes_nothing(text):
    enc = repair.encoder(tokenizer_path())
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    for t in (text, f"w {text} w", text + "y"):
        assert enc.encode([t])[0].tolist() == tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("ids", [[], [5], [1, 1, 1, 1, 1, 1, 1, 1, 1], list(range(50)) * 40, [3, 4] * 999 + [3]])
def test_grammar_round_trip_and_random_access(ids):
    ids = np.array(ids, np.uint32)
    block = repair.pack_block(ids, 100)
    seq, rules, rule_len, _ = repair.unpack(block)
    assert repair.expand(seq, rules, rule_len, 100).tolist() == ids.tolist()
    for start, count in ((0, 3), (len(ids) // 2, 7), (max(0, len(ids) - 5), 5), (0, len(ids))):
        assert repair.decode_range(block, start, count).tolist() == ids[start:start + count].tolist()


def test_grammar_replaces_frequent_pairs():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1000, (50, 4))
    ids = words[rng.integers(0, 50, 5000)].ravel().astype(np.uint32)
    seq, rules = repair.compress(ids, 1000)
    assert len(seq) < len(ids) / 1.8 and len(rules)


def test_random_access_reads_from_files(spark):
    df = docs(spark)
    path = scratch_path(spark, "shards")
    repair.write_token_shards(df, tokenizer_path(), path, shards=3, block_tokens=5000)
    whole = {r["doc_id"]: r for r in repair.read_documents(spark, path).collect()}
    blocks = repair.read_token_blocks(spark, path).collect()
    assert len(blocks) > 3
    for b in blocks:
        b = b.asDict()
        doc, n = b["doc_ids"][-1], b["doc_tokens"][-1]
        got = repair.decode_range(b, b["n_tokens"] - n, n)
        assert got.tolist() == whole[doc]["ids"]
        assert whole[doc]["start"] == b["start"] + b["n_tokens"] - n
    report = repair.compression_report(spark, path).collect()
    assert sum(r["n_tokens"] for r in report) == sum(r["n_tokens"] for r in whole.values())
    assert all(r["n_symbols"] < r["n_tokens"] for r in report)


def pair_counts(seq):
    """Non-overlapping occurrences of every pair, from the left."""
    counts, last = Counter(), {}
    for i, pair in enumerate(zip(seq, seq[1:])):
        if pair[0] != pair[1] or last.get(pair) != i - 1:
            counts[pair] += 1
            last[pair] = i
    return counts


def replaced(seq, pair, symbol):
    out, i = [], 0
    while i < len(seq):
        hit = tuple(seq[i:i + 2]) == pair
        out.append(symbol if hit else seq[i])
        i += 2 if hit else 1
    return out


@pytest.mark.parametrize("seed", range(40))
def test_every_rule_replaces_the_most_frequent_pair_until_none_occurs_twice(seed):
    rng = np.random.default_rng(seed)
    words = [rng.integers(0, rng.integers(1, 20), rng.integers(1, 6)) for _ in range(rng.integers(1, 12))]
    ids = np.concatenate([words[i] for i in rng.integers(0, len(words), 80)]).astype(np.uint32)
    seq, rules = repair.compress(ids, 20)
    now = ids.tolist()
    for k, pair in enumerate(map(tuple, rules.tolist())):
        counts = pair_counts(now)
        assert counts[pair] == max(counts.values()) >= 2
        now = replaced(now, pair, 20 + k)
    assert now == seq.tolist()
    assert max(pair_counts(now).values(), default=0) < 2


def test_no_pair_is_left_when_symbols_pass_16_bits():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 65000, (3000, 3))
    ids = words[rng.integers(0, 3000, 30000)].ravel().astype(np.uint32)
    block = repair.pack_block(ids, 65000)
    seq, rules, rule_len, _ = repair.unpack(block)
    assert len(rules) > 1 << 11 and block["width"] == 4
    assert max(pair_counts(seq.tolist()).values()) < 2
    assert repair.decode_range(block, 44001, 500).tolist() == ids[44001:44501].tolist()


def test_no_pair_occurs_twice_in_any_block_of_the_files(spark):
    path = scratch_path(spark, "whole-grammars")
    repair.write_token_shards(docs(spark), tokenizer_path(), path, shards=2)
    blocks = repair.read_token_blocks(spark, path).collect()
    assert blocks
    for b in blocks:
        assert max(pair_counts(repair.unpack(b.asDict())[0].tolist()).values(), default=0) < 2


def test_words_are_remembered_apart_from_marks_and_line_feeds():
    enc = repair.Encoder(tokenizer_path())
    enc.encode(["see the.\nThen the,\nthe (the)", "see the!"])
    assert set(enc.known) == {b"see", b" the", b".", b"\n", b"Then", b",", b"the", b" (", b")", b"!"}


@pytest.mark.parametrize("seed", range(3))
def test_odd_texts_encode_as_the_tokenizer_does(seed, monkeypatch):
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(tokenizer_path()), repair.Encoder(tokenizer_path())
    monkeypatch.setattr(repair, "CACHED_PIECES", 500)
    rng = np.random.default_rng(seed)
    parts = np.array([*"abBst019'.,-$<|>", " ", "  ", "\n", "\n", "\r\n", "\t", "\x00", "\x1c", "\x85", "\xa0", "é", "ß", "×",
                      "ÿ", "ª", "中", "　", " ", "“", "é", "'s", "'re", "<|endoftext|>", "x" * 70],
                     dtype=object)
    for _ in range(3):
        texts = ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(500)]
        assert [g.tolist() for g in enc.encode(texts)] == \
            [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    assert 0 < len(enc.known) <= 500 and max(map(len, enc.known)) <= repair.PIECE_BYTES


def test_places_are_looked_at_a_few_times_only(monkeypatch):
    looked = []
    ranges = repair._ranges
    monkeypatch.setattr(repair, "_ranges", lambda begins, sizes: looked.append(int(sizes.sum())) or ranges(begins, sizes))
    rng = np.random.default_rng(3)
    words = rng.integers(0, 5000, (4000, 5))
    ids = words[(4000 * rng.random(20000) ** 3).astype(int)].ravel().astype(np.uint32)
    seq, rules = repair.compress(ids, 5000)
    assert repair.expand(seq, rules, repair.expansion_lengths(rules, 5000), 5000).tolist() == ids.tolist()
    assert sum(looked) < 6 * len(ids)


def test_pairs_are_the_same_when_they_do_not_fit_one_number():
    rng = np.random.default_rng(4)
    first, second = rng.integers(0, 9, (2, 500)).astype(np.int32)
    places = rng.permutation(500)
    for a, b in zip(repair._grouped(first, second, places, 4), repair._grouped(first, second, places, 30)):
        assert len(a) == len(b)
    one, two = (repair._grouped(first, second, np.sort(places), bits) for bits in (4, 30))
    assert all(np.array_equal(a, b) for a, b in zip(one, two))
