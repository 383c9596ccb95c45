"""Secret scan with a recursive decoding worklist (operator 6).

Every whole text is scanned for the base patterns. What looks encoded is
unwrapped: the whole text with its percent escapes or its Unicode escapes
decoded (others stay as they are), base64 runs, and compressed bytes inside
them; each unwrapped layer is scanned again and searched for further
layers until nothing new appears. A layer equal to one of its own ancestors
is not entered again, so cycles end; a layer met again elsewhere in the
document is expanded once and reported at every place. Every character of a
layer knows the source range it came from, so a secret found five layers deep
is reported where it stands in the document.

Row-local: no shuffle; a task holds one batch of texts. A compressed layer is
read as a stream, all members of it, and scanned in windows of ``MAX_LAYER``
characters, so a decompression bomb costs time and not memory; a compressed
payload inside such a layer is held whole, as it stands there.

Defined results: null text has no spans; repeated rows are kept; an empty
table gives no rows. Added spans carry their layers in the kind, such as
``assign/base64/url``.
"""

from __future__ import annotations

import binascii
import bz2
import codecs
import hashlib
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import take_columns, workers_can_import

# The base patterns and least lengths are given.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
ESCAPES = ("url", "unicode")
KINDS = ("assign", "access", "hex")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

MAX_LAYER = 1 << 24      # characters of an unpacked layer that are scanned at a time
PIECE = 1 << 18          # bytes unpacked at a time
MIN_ENCODED = 16
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"((?:\\u[0-9A-Fa-f]{4})+)|((?:\\x[0-9A-Fa-f]{2})+)|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
UNITS = re.compile(r"\\u[Dd][89ABab][0-9A-Fa-f]{2}\\u[Dd][C-Fc-f][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}")
NOT_UTF8 = re.compile("([\udc80-\udcff])")
# a run may go on in the next lines, indented or not
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{%d,}(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)*={0,2}" % MIN_ENCODED)
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
WHITE = re.compile(r"[ \t\r\n]+")
PRINTED = re.compile(rb"[\t\r\n\x20-\x7e]{%d,}" % (MIN_ENCODED * 3 // 4))
SAFE_END = re.compile(r"[^A-Za-z0-9+/_;\r\n-]")  # before a line end: no run goes on in the next line
OPEN_RUN = re.compile(r"[A-Za-z0-9+/_=\r\n-]*(?:[ \t]+\n[A-Za-z0-9+/_=\r\n-]*)*")  # backwards from the end
# where compressed bytes may begin: gzip, bz2, zstd; zlib only behind what is no letter or digit
STARTS = re.compile(r"(?=H4sI|Qlpo|KLUv[/_])|(?<![A-Za-z0-9+])(?=e[A-P])")
SPACES = re.compile(r"\x20{256,}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind index, end) of the base patterns, unsorted."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return out


class Layer:
    """Decoded text; ``places.source`` gives the range of characters in the
    text it stands in (None: every character has the whole range ``span``)."""
    __slots__ = ("text", "path", "span", "places")

    def __init__(self, text, path, span=None, places=None):
        self.text, self.path, self.span, self.places = text, path, span, places

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.span if self.places is None else self.places.source(a, b)


def _printed(text: str) -> int:
    if text.isprintable():
        return len(text)
    return sum(map(str.isprintable, text)) + sum(map(text.count, "\t\r\n"))


def _readable(raw: bytes) -> str | None:
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and _printed(text) >= 0.95 * len(text) else None


def _wide(raw: bytes) -> str | None:
    """Text in UTF-16, told by its mark or by the zeros of ASCII characters."""
    raw = raw[:len(raw) // 2 * 2]
    for code, mark, high in (("utf-16-le", b"\xff\xfe", raw[1::2]), ("utf-16-be", b"\xfe\xff", raw[::2])):
        if len(raw) >= 8 and (raw[:2] == mark or 2 * high.count(0) >= len(high)):
            text = raw.decode(code, "replace").removeprefix("\ufeff")
            if _printed(text) - text.count("\ufffd") >= 0.95 * len(text) > 0:
                return text
    return None


def _wrapping(head: bytes) -> str | None:
    """Name of the compression that bytes begin with."""
    if head[:2] == b"\x1f\x8b":
        return "gzip"
    if head[:1] == b"\x78" and len(head) > 2 and (head[0] * 256 + head[1]) % 31 == 0:
        return "zlib"
    if head[:3] == b"BZh":
        return "bz2"
    return "zstd" if head[:4] == b"\x28\xb5\x2f\xfd" else None


class _Source:
    """Pieces of bytes as a file."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = pieces, b""

    def read(self, n: int) -> bytes:
        self.rest = self.rest or next(self.pieces, b"")
        out, self.rest = self.rest[:n], self.rest[n:]
        return out


def _decompressed(name: str, pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Bytes of all members, at most ``PIECE`` at a time. A broken or torn
    payload ends where it breaks."""
    try:
        if name == "zstd":
            import zstandard
            reader = zstandard.ZstdDecompressor().stream_reader(_Source(pieces), read_across_frames=True)
            while out := reader.read(PIECE):
                yield out
            return
        member, rest, n = None, b"", 0
        for piece in pieces:
            rest += piece
            while True:
                if member is None:
                    rest = rest.lstrip(b"\0") if n else rest  # members may be padded
                    if len(rest) < 4:
                        break
                    if _wrapping(rest) != name:
                        return
                    member = bz2.BZ2Decompressor() if name == "bz2" else zlib.decompressobj(31 if name == "gzip" else 15)
                    n += 1
                out = member.decompress(rest, PIECE)
                rest = b"" if name == "bz2" else member.unconsumed_tail
                if out:
                    yield out
                if member.eof:
                    member, rest = None, member.unused_data
                elif member.needs_input if name == "bz2" else not rest and len(out) < PIECE:
                    break
    except Exception:  # noqa: BLE001 - any malformed payload ends here
        return


class Unpacked:
    """The text behind a compressed payload, through any number of compressed
    wrappings, as a stream of windows. Wrappings that lead back to bytes met
    before (a payload that unpacks to itself) are not entered again."""
    __slots__ = ("raw", "span", "path", "names", "readable")

    def __init__(self, raw: bytes, path: tuple, span: tuple[int, int]):
        self.raw, self.span, self.names, self.readable = raw, span, (), False
        seen, head = {hashlib.blake2b(raw).digest()}, raw[:4]
        while (name := _wrapping(head)) is not None:
            self.names += (name,)
            head = self._head()
            if head and _wrapping(head) is not None:
                digest = hashlib.blake2b()
                for piece in self._pieces():
                    digest.update(piece)
                if digest.digest() in seen:
                    head = b""
                seen.add(digest.digest())
            if not head:
                self.names = self.names[:-1]
                break
        self.path = path + self.names

    def _pieces(self) -> Iterator[bytes]:
        pieces = (self.raw[at:at + PIECE] for at in range(0, len(self.raw), PIECE))
        for name in self.names:
            pieces = _decompressed(name, pieces)
        return pieces

    def _head(self) -> bytes:
        head = b""
        for piece in self._pieces():
            head += piece
            if len(head) >= 4:
                break
        return head

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.span

    def windows(self) -> Iterator[str]:
        """Texts of about ``MAX_LAYER`` characters, bytes that are no text
        replaced, so one of them costs no finding; ``readable`` tells
        afterwards whether all of it is text (and no payload by chance)."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        held, total, good, limit = "", 0, 0, MAX_LAYER
        for piece in chain(self._pieces(), (None,)):
            new = decoder.decode(piece or b"", piece is None)
            total += len(new)
            good += _printed(new) - new.count("\ufffd")
            held += new
            if len(held) >= limit:
                held = SPACES.sub(" " * 256, held)  # how many does not matter to a match
            if len(held) >= limit:
                end, begin = _cut(held)
                if begin:
                    yield held[:end]
                    held, limit = held[begin:], MAX_LAYER
                else:
                    limit = 2 * len(held)
        if held:
            yield held
        self.readable = 0 < total and good >= 0.95 * total


def _cut(held: str) -> tuple[int, int]:
    """(end of this window, begin of the next). A window ends at a line end
    that nothing crosses; without one in its second half the next begins with
    an overlap. An unfinished run that is itself compressed goes to the next
    window whole (begin 0: read on)."""
    n = at = len(held)
    while (at := held.rfind("\n", n // 2, at)) >= 0:
        if SAFE_END.fullmatch(held[at - 1] if held[at - 1] != "\r" else held[at - 2]):
            return at + 1, at + 1
    for m in STARTS.finditer(held, n - OPEN_RUN.match(held[::-1]).end()):
        if _opens(_base64(held[m.start():m.start() + 4096].split("=")[0])):
            return n, m.start()
    return n, n - max(1, min(n // 2, max(4096, MAX_LAYER // 16)))


def _opens(raw: bytes) -> bool:
    """Whether the first 1,024 or more bytes of a payload, or all, are compressed."""
    name = _wrapping(raw[:4])
    if name == "gzip":
        return raw[2:3] == b"\x08"
    if name == "zlib":
        return bool(next(_decompressed(name, iter([raw])), b""))
    return name is not None


def _base64(run: str) -> bytes:
    """Bytes of a run; line ends inside it and a last character that is no
    byte are left out."""
    body = WHITE.sub("", run).rstrip("=").replace("-", "+").replace("_", "/")
    body = body[:-1] if len(body) % 4 == 1 else body
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


class _Run:
    """Places of bytes decoded from a run in lines: three bytes stand for four
    characters, from ``skip`` characters on."""
    __slots__ = ("begin", "src", "n", "skip", "text", "at")

    def __init__(self, lines: list[tuple[int, int]], skip: int, first: int, text: str):
        self.begin, self.src, self.n = [], [], 0
        for a, b in lines:
            self.begin.append(self.n), self.src.append(a)
            self.n += b - a
        self.skip, self.text = skip, text
        # byte at which each character begins
        self.at = range(first, first + len(text) + 1) if text.isascii() else None

    def _place(self, j: int) -> int:
        i = bisect_right(self.begin, j) - 1
        return self.src[i] + j - self.begin[i]

    def source(self, a: int, b: int) -> tuple[int, int]:
        if self.at is None:
            self.at = array("q", accumulate((len(c.encode("utf-8")) for c in self.text), initial=0))
        lo, hi = self.at[a], self.at[b] - 1
        return (self._place(self.skip + lo // 3 * 4 + lo % 3),
                self._place(min(self.n - 1, self.skip + hi // 3 * 4 + hi % 3 + 1)) + 1)


def _base64_layers(text: str, begin: int, end: int) -> Iterator[Layer | Unpacked]:
    """Layers of one run, which may go over several lines: all of it, or, where
    that is no text, what is text at any alignment and what is compressed from
    any place on."""
    run, path = text[begin:end], ("base64",)
    lines = [p.span() for p in LINE.finditer(text, begin, end)]
    raw = _base64(run)
    whole = Unpacked(raw, path, (begin, end)) if _wrapping(raw[:4]) is not None else None
    if whole is not None and whole.names:
        yield whole
        if whole.readable:  # other payloads may begin with a line
            for a, _ in lines[1:]:
                if STARTS.match(text, a) and _opens(_base64(text[a:min(a + 4096, end)])):
                    yield Unpacked(_base64(text[a:end]), path, (a, end))
            return
    elif (got := _readable(raw)) is not None:
        yield Layer(got, path, places=_Run(lines, 0, 0, got))
        return
    elif (got := _wide(raw)) is not None:
        yield Layer(got, (*path, "utf16"), (begin, end))
        return
    for m in STARTS.finditer(text, begin, end):
        a = m.start()
        if a > begin and _opens(_base64(text[a:min(a + 4096, end)])):
            yield Unpacked(_base64(text[a:end]), path, (a, end))
    body = WHITE.sub("", run).rstrip("=")
    for skip in range(4):
        raw = _base64(body[skip:])
        for m in PRINTED.finditer(raw):
            got = m.group().decode("ascii")
            yield Layer(got, path, places=_Run(lines, skip, m.start(), got))


def _utf8_parts(raw: bytes) -> Iterator[tuple[int, str, bool]]:
    """(number of bytes, their characters, whether they are UTF-8) of a run;
    a byte that is not stands for itself."""
    for part in NOT_UTF8.split(raw.decode("utf-8", "surrogateescape")):
        if part and 0xDC80 <= ord(part[0]) < 0xDD00:
            yield 1, chr(ord(part) - 0xDC00), False
        elif part:
            yield len(part.encode("utf-8")), part, True


class _Decoder:
    """Collects the text of a decoded layer and where its parts come from."""

    def __init__(self, text: str):
        self.text, self.out, self.at, self.n = text, [], 0, 0
        self.begin, self.src, self.step, self.end = array("q"), array("q"), array("q"), array("q")

    def put(self, chars: str, a: int, b: int, step: int) -> None:
        """``chars`` stand for text[a:b], each for ``step`` of it (0: for all)."""
        if a > self.at:
            self.put(self.text[self.at:a], self.at, a, 1)
        if chars:
            self.begin.append(self.n), self.src.append(a), self.step.append(step), self.end.append(b)
            self.out.append(chars)
            self.n += len(chars)
        self.at = b

    def put_bytes(self, raw: bytes, a: int, width: int, latin) -> None:
        """A run of escaped bytes, ``width`` characters each: UTF-8, else what
        ``latin`` takes of Latin-1; other bytes stay as they are."""
        for n, chars, valid in _utf8_parts(raw):
            if valid and len(chars) < n:
                at = a
                for c in chars:
                    wide = width * len(c.encode("utf-8"))
                    self.put(c, at, at + wide, 0)
                    at += wide
            elif valid or latin(chars):
                self.put(chars, a, a + width * n, width)
            a += width * n

    def layer(self, name: str) -> Layer | None:
        if not self.begin:
            return None
        self.put("", len(self.text), len(self.text), 1)
        return Layer("".join(self.out), (name,), places=self)

    def source(self, a: int, b: int) -> tuple[int, int]:
        i, j = bisect_right(self.begin, a) - 1, bisect_right(self.begin, b - 1) - 1
        return (self.src[i] + self.step[i] * (a - self.begin[i]),
                self.src[j] + self.step[j] * (b - self.begin[j]) if self.step[j] else self.end[j])


def _url(text: str) -> Layer | None:
    """The text with all its percent escapes decoded."""
    out = _Decoder(text)
    for p in PERCENT.finditer(text):
        out.put_bytes(bytes.fromhex(p.group().replace("%", "")), p.start(), 3, str.isprintable)
    return out.layer("url")


def _escapes(text: str) -> Layer | None:
    """The text with all its Unicode escapes decoded."""
    out = _Decoder(text)
    for e in ESCAPE.finditer(text):
        if e.group(1):
            for u in UNITS.finditer(text, e.start(), e.end()):
                units = bytes.fromhex(u.group().replace("\\u", ""))
                try:
                    out.put(units.decode("utf-16-be"), u.start(), u.end(), 6 if len(units) == 2 else 0)
                except UnicodeDecodeError:
                    pass  # half a pair stays as it is
        elif e.group(2):
            out.put_bytes(bytes.fromhex(e.group().replace("\\x", "")), e.start(), 4, bool)
        else:
            point = int(e.group(3)) if e.group(3) else int(e.group(4), 16)
            if point < 0x110000 and not 0xD800 <= point < 0xE000:
                out.put(chr(point), e.start(), e.end(), 0)
    return out.layer("unicode")


def unwrap(text: str) -> Iterator[Layer | Unpacked]:
    """All layers found directly inside one text."""
    for m in BASE64.finditer(text):
        yield from _base64_layers(text, m.start(), m.end())
    for pattern, decode in ((PERCENT, _url), (ESCAPE, _escapes)):
        if pattern.search(text) and (got := decode(text)) is not None:
            yield got


def _expand(text: str):
    """Findings of one text, (start, kind index, end, layers) in its own
    characters: a generator that yields the texts of its layers and is sent
    their findings. What is found by decoding escapes is new if it is not
    found without that, nor with the same decodings in another order, nor part
    of a base span of its kind."""
    base = base_spans(text)
    out = {(a, kind, b, ()) for a, kind, b in base}
    names = set(out)
    ends = [{}, {}, {}]
    for a, kind, b in base:
        ends[kind][a] = b
    begins = [sorted(e) for e in ends]

    def new(x, kind, y, path):
        if all(name in ESCAPES for name in path):
            i = bisect_right(begins[kind], x)
            if i and y <= ends[kind][begins[kind][i - 1]]:
                return False
        return _plainer(x, kind, y, path) not in names

    for inner in unwrap(text):
        if isinstance(inner, Unpacked):
            got = set()
            for window in inner.windows():
                got |= {(0, kind, 0, path) for _, kind, _, path in (yield window)}
        else:
            got = yield inner.text
        for a, kind, b, path in got:
            x, y = inner.source(a, b)
            if inner.path[0] not in ESCAPES or new(x, kind, y, path) and new(x, kind, y, inner.path + path):
                out.add((x, kind, y, inner.path + path))
                names.add(_plainer(x, kind, y, inner.path + path))
    return out


def _plainer(a: int, kind: int, b: int, path: tuple) -> tuple:
    """A finding with its outer escape layers in a fixed order."""
    n = next((i for i, name in enumerate(path) if name not in ESCAPES), len(path))
    return a, kind, b, tuple(sorted(path[:n])) + path[n:]


def _mark(text: str):
    return text if len(text) < 4096 else hashlib.blake2b(text.encode("utf-8", "replace")).digest()


def findings(text: str) -> set[tuple[int, int, int, tuple]]:
    """Findings of a text and all its layers. A layer equal to one of its own
    ancestors is not entered again; a text met elsewhere in the document is
    expanded once, and its findings are mapped to every place it stands at."""
    known: dict = {}
    stack = [[_expand(text), _mark(text), True]]  # generator, text, whether its findings are whole
    active = {stack[0][1]: 0}
    send = None
    while True:
        try:
            inner = stack[-1][0].send(send)
        except StopIteration as end:
            send = end.value
            _, mark, whole = stack.pop()
            del active[mark]
            if whole:
                known[mark] = send
            if not stack:
                return send
            continue
        mark = _mark(inner)
        if mark in active:
            for frame in stack[active[mark] + 1:]:
                frame[2] = False  # depends on what it was reached through
            send = set()
        elif mark in known:
            send = known[mark]
        else:
            active[mark] = len(stack)
            stack.append([_expand(inner), mark, True])
            send = None


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, str]]]:
    """(base spans, added spans) of a whole text, sorted."""
    found = findings(text)
    plain = {s[:3] for s in found if not s[3]}
    added = {(a, kind, b, "/".join((KINDS[kind],) + path)) for a, kind, b, path in found if path}
    return sorted(plain), sorted(s for s in added if s[:3] not in plain)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            counts, digests, spans, layers = ([], [], []), [], [], []
            for text in part.column("text").to_pylist():
                base, added = scan(text or "")
                for k in range(3):
                    counts[k].append(sum(s[1] == k for s in base))
                named = [(a, k, b, KINDS[k]) for a, k, b in base]
                join = lambda xs: ",".join(f"{name}:{a}:{b}" for a, _, b, name in xs)
                digests.append(hashlib.sha256(join(named).encode()).hexdigest())
                spans.append(join(sorted(named + added)))
                layers.append(len(added))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "n_assign": pa.array(counts[0], pa.int64()),
                "n_access": pa.array(counts[1], pa.int64()), "n_hex": pa.array(counts[2], pa.int64()),
                "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string()),
                "n_decoded": pa.array(layers, pa.int64())})


def secret_report(docs: DataFrame) -> DataFrame:
    workers_can_import(docs.sparkSession)
    rows = take_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                 "spans string, n_decoded long")
