import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import chunks
from ledgerlake.llm.common import text_buffers
from tests.llm.helpers import docs, edge_docs, empty_docs, make


def text_of(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(n))


def slow_hash(data):
    """The rolling definition, byte by byte."""
    out = []
    for i in range(len(data)):
        h = 0
        for j in range(min(i + 1, chunks.WINDOW)):
            h += int(chunks.GEAR[data[i - j]]) << j
        out.append(h & 0xFFFFFFFF)
    return out


def test_gear_hash_is_the_rolling_hash():
    data = np.frombuffer(("héllo wörld " * 20).encode(), np.uint8)
    assert chunks.gear_hash(data).tolist() == slow_hash(data)


def test_chunks_are_whole_and_local():
    rng = np.random.default_rng(1)
    texts = [text_of(rng, 400), None, "", "x", "a" * 5000, "漢字" * 800, text_of(rng, 50)]
    buf, off = text_buffers(pa.array(texts))
    digest, length, first = chunks.chunk(buf, off)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        a, b = first[i], first[i + 1]
        assert length[a:b].sum() == len(raw) and (length[a:b] <= chunks.MAX_BYTES + 3).all()
        at = np.cumsum(length[a:b])[:-1]
        assert all((raw[p] & 0xC0) != 0x80 for p in at)
        alone = chunks.chunk(*text_buffers(pa.array([t], pa.string())))
        assert (alone[0] == digest[a:b]).all() and (alone[1] == length[a:b]).all()


def test_insertion_changes_only_near_chunks():
    rng = np.random.default_rng(2)
    t = text_of(rng, 800)
    a = set(chunks.chunk(*text_buffers(pa.array([t], pa.string())))[0].tolist())
    b = set(chunks.chunk(*text_buffers(pa.array([t[:2000] + "INSERTED" + t[2000:]])))[0].tolist())
    assert len(a - b) <= 4 and len(a) > 50


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    rng = np.random.default_rng(3)
    rows, planted, clean = [], set(), set()
    for p in range(30):
        passage = text_of(rng, 55)
        for k in range(3):
            i = len(rows)
            rows.append((i, text_of(rng, rng.integers(5, 60)) + " " + passage + " " + text_of(rng, rng.integers(5, 60))))
            planted.add(i)
    for _ in range(100):
        clean.add(len(rows))
        rows.append((len(rows), text_of(rng, 200)))
    got = chunks.repeated_passages(make(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == planted
    text = dict(rows)
    for r in got:
        piece = text[r["doc_id"]][r["start"]:r["end"]]
        assert piece[24:-24] in text[r["first_doc"]] and r["first_doc"] // 3 == r["doc_id"] // 3
    assert not {r["doc_id"] for r in got} & clean


def test_against_brute_force_on_the_table(spark):
    """Every reported span really stands in another document, and every
    document with a passage is found."""
    df = docs(spark)
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    got = chunks.repeated_passages(df).collect()
    for r in got:
        piece = text[r["doc_id"]][r["start"]:r["end"]]
        half = piece[:len(piece) // 2][-40:]
        assert any(half in t for i, t in text.items() if i != r["doc_id"])
    copies = {i for i, t in text.items() if len(t) > 400 and any(t == u for j, u in text.items() if i != j)}
    assert copies <= {r["doc_id"] for r in got}


def test_dropping_copies_keeps_one_of_each_chunk(spark):
    rng = np.random.default_rng(4)
    passage = text_of(rng, 120)
    rows = [(i, text_of(rng, 30) + " " + passage + " " + text_of(rng, 30)) for i in range(5)]
    out = {r["doc_id"]: r["text"] for r in chunks.drop_repeated_chunks(make(spark, rows)).collect()}
    assert out[0] == rows[0][1]
    assert all(len(out[i]) < len(rows[i][1]) - 400 for i in range(1, 5))


@pytest.mark.parametrize("source", [edge_docs, empty_docs])
def test_edges(spark, source):
    df = source(spark)
    got = chunks.repeated_passages(df).collect()
    assert {r["doc_id"] for r in got} <= {r["doc_id"] for r in df.collect()}
    back = chunks.drop_repeated_chunks(df).collect()
    assert len(back) == df.count()


def test_every_passage_of_the_least_length_is_found_to_its_edges(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for p in range(150):
        n = int(rng.integers(chunks.PASSAGE_BYTES, 330))
        passage = text_of(rng, 80)[:n] if p % 3 else ("ab" * 400)[:n] if p == 0 else (text_of(rng, 3) * 40)[:n]
        passage = passage[:-1] + "é" * (p % 2) + "z"
        for side in "<[", "{(":
            before, after = text_of(rng, rng.integers(5, 60)) + side[0], side[1] + text_of(rng, rng.integers(5, 60))
            rows.append((len(rows), before + passage + after))
            want[len(rows) - 1] = (len(before), len(before) + len(passage), len(rows) - 1 - (side == "{("))
    got = chunks.repeated_passages(make(spark, rows)).collect()
    assert {r["doc_id"]: (r["start"], r["end"], r["first_doc"]) for r in got} == want and len(got) == len(rows)


def test_less_than_a_passage_is_none(spark):
    rng = np.random.default_rng(6)
    short = text_of(rng, 40)[:chunks.PASSAGE_BYTES - 1]
    rows = [(i, text_of(rng, 30) + mark + short + mark + text_of(rng, 30)) for i, mark in enumerate("<[{(")]
    assert chunks.repeated_passages(make(spark, rows)).collect() == []


def windows_of(texts, n=chunks.PASSAGE_BYTES):
    """Per document the bytes that a window of n bytes covers which stands in
    another document too (brute force over all windows)."""
    where = {}
    for i, t in texts.items():
        for p in range(len(t) - n + 1):
            where.setdefault(t[p:p + n], set()).add(i)
    out = {}
    for i, t in texts.items():
        own = {q for p in range(len(t) - n + 1) if len(where[t[p:p + n]]) > 1 for q in range(p, p + n)}
        if own:
            out[i] = own
    return out


def covered(rows):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    return out


def test_pieces_in_smaller_documents_hide_no_passage(spark):
    rng = np.random.default_rng(7)
    rows = []

    def add(middle):
        rows.append((len(rows), text_of(rng, 20) + "<" + middle + ">" + text_of(rng, 20)))
    passages = [text_of(rng, 60)[:120 + 10 * (k % 12)] for k in range(40)]
    for t in passages:
        for lo in range(0, len(t), 60):
            add(t[lo:lo + 60])
    for t in passages:
        add(t)
        add(t)
    texts = dict(rows)
    assert covered(chunks.repeated_passages(make(spark, rows)).collect()) == windows_of(texts)


def test_passages_of_the_table_against_all_windows(spark):
    """Nothing is reported that no repeated window covers, and of all that
    repeated windows cover 99.9 % is found, in every document."""
    df = docs(spark)
    texts = {r["doc_id"]: r["text"] for r in df.collect() if r["text"] and r["text"].isascii()}
    want = windows_of(texts)
    got = covered(chunks.repeated_passages(df.where(df.doc_id.isin(list(texts)))).collect())
    assert all(v <= want[i] for i, v in got.items()) and set(got) == set(want)
    assert sum(map(len, got.values())) >= 0.999 * sum(map(len, want.values()))


def test_periodic_and_repeated_places(spark):
    line = "the same boiler plate stands in this line of every page of the book, again and again and again. "
    rows = [(0, "a" * 5000 + line * 30), (1, "b" * 300 + line * 3 + "a" * 200), (2, "xyz" * 500), (3, "q" + "xyz" * 60),
            (4, "漢字" * 400), (5, "…" + "漢字" * 90), (6, "b" * 90)]
    got = chunks.repeated_passages(make(spark, rows)).collect()
    assert {(r["doc_id"], r["start"], r["end"]) for r in got} == {
        (0, 0, 5000 + 30 * len(line)), (1, 300, 500 + 3 * len(line)), (2, 0, 1500), (3, 1, 181), (4, 0, 800), (5, 1, 181)}


def test_askers_of_one_text_are_dealt_out(spark, monkeypatch):
    rng = np.random.default_rng(8)
    passage = text_of(rng, 40)
    rows = [(i, text_of(rng, 8) + "<" + passage + ">" + text_of(rng, 8)) for i in range(60)]
    whole = sorted(map(tuple, chunks.repeated_passages(make(spark, rows)).collect()))
    monkeypatch.setattr(chunks, "ASKERS", 4)
    assert sorted(map(tuple, chunks.repeated_passages(make(spark, rows)).collect())) == whole and len(whole) == 60


@pytest.mark.parametrize("edge", [64, 1 << 12])
def test_stretches_by_every_path_against_all_places(monkeypatch, edge):
    """Short pieces by looked-up keys, long ones by sorted keys, few diagonals
    one by one, many at once; pieces reach over both ends of the text."""
    monkeypatch.setattr(chunks, "EDGE", edge)
    rng = np.random.default_rng(5)
    words = [text_of(rng, 12).encode() for _ in range(6)]
    line = text_of(rng, 130).encode()
    for case in range(30):
        def some():
            return b"".join(words[i] for i in rng.integers(0, len(words), 25))
        shared = (line, some(), b"ab" * 70)[case % 3]
        piece = some()[:rng.integers(0, 200)] + shared + some()[:rng.integers(0, 200)]
        text = some()[:rng.integers(0, 90)] + shared + some() + shared * int(rng.integers(0, 3))
        a, b = (np.frombuffer(x, np.uint8) for x in (piece, text))
        runs = [chunks._runs(x, np.array([0, len(x)]))[0] for x in (a, b)]
        got = chunks.equal_stretches(a, runs[0], chunks.Text(b, runs[1]))
        want = set()
        for d in range(-len(a), len(b)):
            lo, hi = max(0, -d), min(len(a), len(b) - d)
            unlike = np.concatenate([[lo - 1], lo + np.flatnonzero(a[lo:hi] != b[lo + d:hi + d]), [hi]])
            want |= {(int(unlike[k]) + 1, int(unlike[k + 1]), int(unlike[k]) + 1 + d)
                     for k in np.flatnonzero(np.diff(unlike) > chunks.PASSAGE_BYTES)}
        assert len(got) == len(set(got)) and set(got) <= want
        found, every = ({p for x, y, _ in spans for p in range(x, y)} for spans in (got, want))
        assert found == every


def test_texts_that_nobody_asks_are_left_out():
    part = pa.RecordBatch.from_pydict({"partner": pa.array([1, 2, 2, 3, 4], pa.int64()),
                                       "salt": pa.array([0, 0, 0, 0, 0], pa.int32()),
                                       "kind": pa.array([0, 0, 1, 0, 0], pa.int32())})
    assert chunks._needed(part).to_pylist() == [False, True, True, False, True]
