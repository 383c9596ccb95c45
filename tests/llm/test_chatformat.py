"""Folding event logs against a sequential fold, and exact round trips."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlake.llm import chatformat as cf
from tests.conftest import SF_SMALL

LOG = "conv_id bigint, message string, seq bigint, kind string, role string, text string, start string"
TURN = "conv_id bigint, turn bigint, role string, text string, message string"

PIECES = st.lists(st.sampled_from(["<", "[", "\\", "|", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "a", " ",
                                   "\n", "é", "<|end|>", "</s>", "[/INST]"]), max_size=12).map("".join)


@settings(max_examples=600, deadline=None)
@given(PIECES, st.sampled_from(["user", "assistant", "system", "tool", "", "a|b>\n%", "role"]))
def test_any_turn_is_read_back(text, role):
    formatted, begin, end = cf.render_turn(role, text)
    assert cf.parse_turn(formatted) == (role, text)
    assert cf.unescape(formatted[begin:end]) == (text if role == "assistant" else "")
    assert not re.search(r"<s>|</s>|\[/?INST\]|<</?SYS>>|<\|", cf.escape(text))


def test_joined_turns_can_be_parted_again():
    turns = [("system", "be < kind"), ("user", "say [INST] <"), ("assistant", "</s><"), ("tool", "|"), ("user", "")]
    joined = "".join(cf.render_turn(*t)[0] for t in turns)
    assert [cf.parse_turn(m[0]) for m in cf.RENDERED.finditer(joined)] == turns


def test_not_a_turn():
    with pytest.raises(ValueError):
        cf.parse_turn("[INST] a [/INST]<s> b</s> ")


def sequential(events):
    """One conversation's log, event by event."""
    order = []   # [message, start, role, text]
    first, gone = {}, set()
    for seq, kind, message, role, text in sorted(events, key=lambda e: (e[0], cf.KINDS.index(e[1]), e[4] or "")):
        role, text = role or "", text or ""
        if kind == "message" and message not in first:
            first[message] = seq
            order.append([message, seq, role, text])
            continue
        own = next((m for m in order if m[0] == message), None)
        if kind == "regenerate" and message in first:
            gone |= {m[0] for m in order if first[message] < m[1] < seq}
        if own:
            own[2] = role if kind == "message" else own[2]
            own[3] = {"message": text, "edit": text, "delta": own[3] + text, "regenerate": ""}[kind]
    return sorted((m[1], m[2], m[3]) for m in order if m[0] not in gone)


def random_log(rng, conv):
    rows, started = [], []
    for seq in range(rng.randrange(1, 40)):
        kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
        if kind == "message" or not started:
            started.append(f"m{len(started)}")
            rows.append((conv, started[-1], seq, "message", rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None])))
        else:
            rows.append((conv, rng.choice(started), seq, kind, None, rng.choice(["x", "</s>", "y ", None])))
    return rows


def test_fold_against_sequential_fold(spark):
    rng = random.Random(5)
    rows = [e for conv in [*range(60), None] for e in random_log(rng, conv)]
    rows += [(1000, "orphan", 1, "delta", None, "no begin"), (1001, None, 1, "message", "user", "no name")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], LOG)   # an extra column of a clashing name
    got = {}
    for r in cf.fold(df).collect():
        got.setdefault(r.conv_id, []).append((r.start, r.role, r.text))
    want = {}
    for conv in {r[0] for r in rows}:
        own = sequential([(s, k, m, role, t) for c, m, s, k, role, t in rows if c == conv and c != 1000])
        if own:
            want[conv] = own
    assert {c: sorted(v) for c, v in got.items()} == want


def test_unknown_kind_is_an_error(spark):
    with pytest.raises(Exception, match="unknown kind of event"):
        cf.fold(spark.createDataFrame([(1, "a", 1, "erase", "user", "x", "")], LOG)).collect()


def digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv),
                                                          key=lambda r: (r[1], r[2] or "", r[3] or ""))]
        loss = "".join(t for role, t in turns if role == "assistant")
        text = "".join(f"{role}\n{t}\n" for role, t in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[conv] = (len(turns), sha(text), len(loss), sha(loss), sum(len(cf.render_turn(*t)[0]) for t in turns))
    return out


def report(df):
    return {r.conv_id: tuple(r)[1:] for r in cf.chat_report(df).collect()}


PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def test_report_of_edge_rows(spark):
    long = "".join(f"é<s>{i}\n" for i in range(5000))
    rows = [(1, 0, "user", None), (1, 1, "assistant", None), (2, 5, "assistant", long), (2, 3, "user", "é"), (2, 4, None, "x"),
            (None, 0, "assistant", "n"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "assistant", "and"),
            (4, 0, "we|ird\n%", "[/INST]"), (5, 0, "assistant", "")]
    assert report(spark.createDataFrame([(*r, "clash") for r in rows], TURN)) == digests(rows + PROBE)
    assert report(spark.createDataFrame([], TURN)) == digests(PROBE)


def test_report_of_the_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert report(table) == digests(rows + PROBE)


def test_written_rows_stand_in_order_and_hot_conversation_is_spread(spark, tmp_path):
    log = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("conv_id"), F.col("id").cast("string").alias("message"),
        F.col("id").alias("seq"), F.lit("message").alias("kind"), F.lit("user").alias("role"), F.lit("t").alias("text"))
    out = cf.write_chat(log, str(tmp_path / "chat"))
    files = out.select("conv_id", "start", F.input_file_name().alias("f"))
    assert files.where("conv_id = 7").select("f").distinct().count() > 1
    rows = files.groupBy("f").agg(F.min(F.struct("conv_id", "start")).alias("lo"), F.max(F.struct("conv_id", "start")).alias("hi"))
    spans = sorted((tuple(r.lo), tuple(r.hi)) for r in rows.collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
