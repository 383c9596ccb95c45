import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import pii
from tests.llm.helpers import docs, edge_docs, empty_docs, make

# the contract's plain patterns
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, "email", m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, "ip", m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in CARD.finditer(text)
            if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    out.sort()
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in out)
    return [sum(s[1] == i for s in out) for i in range(4)], hashlib.sha256(joined.encode()).hexdigest(), out


TRICKY = [
    "mail a@b.cd@e.fg and x.y_z@q.co.uk, then a@b.c_d@e.f end", "b@c no dot; .@x.y; a@b..c d@e.f-", "@@a@b.c@",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 1.2.3 999.1.2.3.4 000255.1.1.1", "ip 10.0.0.1, 10.0.0.1.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5500005555555559  4 1 1 1", "12  34 5--6 7 8-9", "4111111111111111" * 3,
    "+1 (555) 010-9999 +49 30 1234567 +1 ++1234567890 +12345678901234567890 +1 2 3 .. ( 9", "+1(((((((((((((((((((",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 GB82WEST12345698765431",
    "ssn 123-45-6789 or 123-45-6789, social security 987-65-4321", "é😀 a@b.cd 漢字 1.1.1.1 +1 555 010 9999",
    "a@b.co" + " " * 50 + "a@b.co" * 600, "x" * 3000 + "@y.z", "9" * 4000, "1 " * 3000, "a@b.c " * 1000,
]


def check(df):
    got = pii.pii_report(df).collect()
    want = {}
    for r in df.select("doc_id", "text").collect():
        want.setdefault(r["doc_id"], []).append(brute(r["text"]))
    for r in got:
        counts = [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]]
        found = [w for w in want[r["doc_id"]] if w[0] == counts and w[1] == r["base_sha256"]]
        assert found, (r["doc_id"], counts, r["spans"][:300], want[r["doc_id"]][0][2][:10])
        spans = [s.rsplit(":", 2) for s in r["spans"].split(",")] if r["spans"] else []
        base = [f"{k}:{a}:{b}" for a, _, k, b in found[0][2]]
        assert [":".join(s) for s in spans if s[0] in ("email", "ip", "card", "phone")] == base
    assert len(got) == sum(map(len, want.values()))


def test_base_spans_match_the_plain_patterns(spark):
    check(make(spark, list(enumerate(TRICKY))))


@pytest.mark.parametrize("source", [docs, edge_docs])
def test_tables(spark, source):
    check(source(spark))


def test_empty_table(spark):
    assert pii.pii_report(empty_docs(spark)).collect() == []


def test_added_kinds_need_checksum_or_context(spark):
    df = make(spark, [(1, "pay to DE89 3704 0044 0532 0130 00 now"), (2, "pay to DE89 3704 0044 0532 0130 01 now"),
                      (3, "her ssn: 123-45-6789"), (4, "part 123-45-6789"), (5, "ssn 666-45-6789")])
    got = {r["doc_id"]: r["spans"] for r in pii.pii_report(df).collect()}
    assert "iban:7:34" in got[1] and "iban" not in got[2]
    assert got[3] == "ssn:9:20" and "ssn" not in got[4] and got[5] == ""


def test_context_moves_the_score(spark):
    df = make(spark, [(1, "call phone +1 555 010 9999"), (2, "value +1 555 010 9999")])
    got = {r["doc_id"]: r["scores"] for r in pii.pii_report(df).collect()}
    assert got[1][0] > got[2][0]


def test_checksums(spark):
    row = spark.range(1).select(pii.luhn(F.lit("4111111111111111")).alias("a"), pii.luhn(F.lit("4111111111111112")).alias("b"),
                                pii.mod97(F.lit("GB82WEST12345698765432")).alias("c"),
                                pii.mod97(F.lit("GB82WEST12345698765433")).alias("d")).first()
    assert tuple(row) == (True, False, True, False)


def test_very_long_runs_stay_linear(spark):
    df = make(spark, [(1, "a" * 400_000 + "@"), (2, "7" * 400_000), (3, "1." * 200_000), (4, "+1" + " " * 400_000)])
    assert {r["base_sha256"] for r in pii.pii_report(df).select("doc_id", "base_sha256").collect()
            if r["doc_id"] in (1, 2, 4)} == {hashlib.sha256(b"").hexdigest()}


def test_other_columns_survive(spark):
    df = edge_docs(spark)
    assert pii.find_pii(df).columns == [*df.columns, "pii"]
