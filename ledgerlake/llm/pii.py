"""Personal data: patterns propose, checksums confirm, context scores (operator 3).

Everything is a row-local Column expression: no shuffle, no Python worker.
Positions come from splitting the text at the matches: the gaps and the
matches, laid end to end, are the text.

The patterns start a run of their first character class only where that run
begins (or where the previous match ended) and never give back what a
repetition took. Both are equivalent to the plain patterns here and make the
scan linear in the text, also on very long words or digit runs. Card numbers
ask for their 14 digits in the pattern: a run of digits is taken whole, so a
shorter one would only be dropped later.

Defined results: null text has no spans; repeated rows and null ids are kept
as they are; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import take_columns

CHUNK = 256              # positions gathered before they join the result
CONTEXT_CHARS = 40       # looked at before a match
AFTER_CHARS = 20         # and after it
MIN_SCORE = 0.5          # added kinds below this score are dropped


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digit sums added, mod 10."""
    def add(acc: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        twice = digit * (1 + i % 2)
        return acc + twice - F.when(twice > 9, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """ISO 13616: first four characters moved to the end, letters as 10..35."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, acc * 10 + (c - 48)).otherwise(acc * 100 + (c - 55)) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(code)), F.lit(0), step) == 1


def _between(digits: Column, lo: int, hi: int) -> Column:
    return F.length(digits).between(lo, hi)


def _card(hit: Column) -> Column:
    return F.when(_between(_digits(hit), 14, 19), luhn(_digits(hit))).otherwise(False)


def _iban(hit: Column) -> Column:
    code = F.regexp_replace(hit, " ", "")
    return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(False)


_OCTET = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """``needs``: a text without this string has no match (cheap test)."""
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    words: str = ""          # context that speaks for it
    against: str = ""        # context that speaks against it
    needs: str = ""


# Patterns, digit counts and limits of the base kinds are given.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda h: F.lit(True), 0.9, "mail|contact|kontakt|correo|courriel", "example|test", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda h: h.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), 0.6, "ip|host|server|address|login", "version|section", "."),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+", _card, 0.7,
         "card|visa|master|credit|karte|carte|tarjeta", "order|serial|isbn"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda h: _between(_digits(h), 10, 15), 0.6,
         "phone|tel|call|mobil|fax", "", "+"),
)
# Kinds that the method adds.
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         _iban, 0.8, "iban|bank|account|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda h: ~h.rlike("^(000|666|9)|-00-|0000$"), 0.3, "ssn|social security", "", "-"),
)
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"


def _find(text: Column, kind: Kind) -> Column:
    """Array of (gap before, match, gap after) of all matches."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.when(text.contains(kind.needs), hits).otherwise(F.array().cast("array<string>")) if kind.needs else hits


def _positions(gaps: Column, hits: Column, kind: Kind, rank: int, base: bool) -> Column:
    """Spans of the hits."""
    n = F.size(hits)
    rows = F.arrays_zip(F.slice(gaps, F.lit(1), n).alias("gap"), hits.alias("hit"),
                        F.slice(gaps, F.lit(2), n).alias("next"))

    def span(start: Column, row: Column) -> Column:
        near = F.lower(F.concat(F.substring(row["gap"], -CONTEXT_CHARS, CONTEXT_CHARS), F.lit(" "),
                                F.substring(row["next"], 1, AFTER_CHARS)))
        score = F.lit(kind.score)
        if kind.words:
            score = score + F.when(near.rlike(kind.words), 0.3).otherwise(0.0)
        if kind.against:
            score = score - F.when(near.rlike(kind.against), 0.3).otherwise(0.0)
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"),
                        (start + F.length(row["hit"])).alias("end"),
                        F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"))

    # where each match starts: running sums, kept in runs of CHUNK
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("out"),
                    F.array().cast("array<array<int>>").alias("parts"))

    def step(acc: Column, row: Column) -> Column:
        start = acc["pos"] + F.length(row["gap"])
        full = F.size(acc["out"]) >= CHUNK
        return F.struct((start + F.length(row["hit"])).alias("pos"),
                        F.when(full, F.array(start)).otherwise(F.concat(acc["out"], F.array(start))).alias("out"),
                        F.when(full, F.concat(acc["parts"], F.array(acc["out"]))).otherwise(acc["parts"]).alias("parts"))

    starts = F.aggregate(rows, zero, step, lambda a: F.flatten(F.concat(a["parts"], F.array(a["out"]))))
    spans = F.zip_with(rows, starts, lambda row, start: F.when(kind.valid(row["hit"]), span(start, row)))
    good = (lambda s: s.isNotNull()) if base else (lambda s: s.isNotNull() & (s["score"] >= MIN_SCORE))
    return F.when(n > 0, F.filter(spans, good)).otherwise(F.array().cast(SPAN))


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``pii``: all spans (start, rank, kind, end, score) sorted
    by start, then kind; code points, end exclusive."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kinds = [(k, i, i < len(BASE)) for i, k in enumerate(BASE + ADDED)]
    taken = set(docs.columns)
    prefix = "_"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    found = docs.withColumns({f"{prefix}h{i}": _find(body, k) for k, i, _ in kinds})
    found = found.withColumns({f"{prefix}g{i}": F.when(F.size(f"{prefix}h{i}") > 0, F.split(body, k.pattern, -1))
                               for k, i, _ in kinds})
    spans = found.withColumns({f"{prefix}s{i}": _positions(F.col(f"{prefix}g{i}"), F.col(f"{prefix}h{i}"), k, i, base)
                               for k, i, base in kinds})
    merged = F.array_sort(F.concat(*[F.col(f"{prefix}s{i}") for _, i, _ in kinds]))
    return spans.select(*[F.col(f"`{c}`") for c in docs.columns], merged.alias("pii"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, all spans."""
    found = find_pii(take_columns(docs, "doc_id", "text")).drop("text")
    base = F.filter("pii", lambda s: s["rank"] < len(BASE))
    count = lambda name: F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long")
    return found.select("doc_id", *[count(k.name).alias(f"n_{k.name}") for k in BASE],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("pii")).alias("spans"),
                        F.transform("pii", lambda s: s["score"]).alias("scores"))
