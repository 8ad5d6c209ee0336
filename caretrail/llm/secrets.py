"""Secret scan: patterns over a text and over every layer that is nested in it.

Worklist: a text is the first layer. From a layer come further ones: the same text with its percent escapes or its
Unicode escapes decoded (hexadecimal, braced and octal ones, numbered and named entities), or with the NULs of UTF-16 taken out, the content of each base64 run (also one that is wrapped over lines, and at each of the four
alignments), and that of each gzip, zlib or bzip2 stream, whichever escape gave its bytes. Decoded bytes are characters of
the same number: what is looked for is ASCII, and no byte is lost. Each layer is scanned and unwrapped in turn until
nothing new comes up; a layer whose content was seen at the same place ends its branch, so cycles end too. Every layer knows which code points of the original each of its characters stands for, so what is found
anywhere is reported as a span of the original text.

Defined cases: a null text is an empty one; an empty text has no spans; repeated rows each get their result; ids may be
null and are passed through. An empty table gives an empty one. Spans that tie in their start go by kind as listed, then end. A kept column that
has the name of a result, or of another kept one, gets `_in` behind its name; no column name is reserved. Texts of any length are scanned whole. All members of a
compressed stream are read to their end; content above `most_bytes` (default 64 MB) is scanned in windows of that size,
each sharing half with the next, so only a match or a nested run of more than half a window can be cut.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caretrail.llm.names import laid_out
from caretrail.llm.stored import small_batches, tidy

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(
    r"\\u(?P<x4>[0-9A-Fa-f]{4})|\\u\{(?P<xb>[0-9A-Fa-f]{1,6})\}|\\U(?P<x8>[0-9A-Fa-f]{8})|\\x(?P<x2>[0-9A-Fa-f]{2})|\\(?P<o3>[0-3][0-7]{2})"
    r"|&#[xX](?P<xe>[0-9A-Fa-f]{1,6});|&#(?P<de>[0-9]{1,7});|&(?P<name>[A-Za-z][A-Za-z0-9]{1,31});"
)
BASES = {"x": 16, "o": 8, "d": 10}
# Text in two bytes a character, either order, as it looks byte by byte.
WIDE = re.compile(r"\x00?(?:[\t\n\r\x20-\x7e]\x00){7,}[\t\n\r\x20-\x7e]?")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}")
BREAK = re.compile(r"[\x20\t]*(?:\r\n?|\n|(?:\\r)?\\n)[\x20\t]*")
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}+(?:{BREAK.pattern}[A-Za-z0-9+/_-]++(?![\x20\t]*[A-Za-z0-9]))+")
PACKED = re.compile(r"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)")
# Bytes without any of these hold no secret and no further layer.
LIVE = re.compile(
    rb"[A-Za-z0-9+/_-]{16}|%[0-9A-F]{2}|\\[ux]|\\[0-3][0-7]{2}|&#|&[A-Z][A-Z0-9]+;|(?:[\t\n\r\x20-\x7e]\x00){7}"
    rb"|\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh|passw|secret|token|api_?key",
    re.IGNORECASE,
)
URL_SAFE = str.maketrans("-_", "+/")
FEED, PIECE = 1 << 10, 1 << 20

Span = tuple[str, int, int]


def find(text: str) -> list[Span]:
    """Spans (kind, start, end) of one layer: leftmost, non-overlapping per kind."""
    spans: list[Span] = []
    low = text.lower()
    if any(name in low for name in NAMES):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return spans


class Layer:
    """A text and where its characters come from: `inside` maps a span on to the source, the original has none."""

    source: Layer | None = None

    def __init__(self, text: str):
        self.text = text

    def inside(self, begin: int, stop: int) -> tuple[int, int]:
        raise NotImplementedError

    def origin(self, begin: int, stop: int) -> tuple[int, int]:
        """The span in the original, through as many layers as there are."""
        layer = self
        while layer.source is not None:
            begin, stop = layer.inside(begin, stop)
            layer = layer.source
        return begin, stop

    def whole(self) -> tuple[int, int]:
        return self.origin(0, len(self.text))


class Spliced(Layer):
    """The source with the parts (begin, stop, new text) put in; a piece is a part, or what was copied between two."""

    def __init__(self, source: Layer, parts: list[tuple[int, int, str]]):
        texts, self.source, self.at, self.begin, self.stop, self.copied = [], source, [], [], [], []
        done = size = 0
        for begin, stop, text in [*parts, (len(source.text), len(source.text), "")]:
            for a, b, new, copied in ((done, begin, source.text[done:begin], True), (begin, stop, text, False)):
                if new:
                    texts.append(new)
                    self.at.append(size)
                    self.begin.append(a)
                    self.stop.append(b)
                    self.copied.append(copied)
                    size += len(new)
            done = stop
        super().__init__("".join(texts))

    def inside(self, begin: int, stop: int) -> tuple[int, int]:
        i, j = bisect_right(self.at, begin) - 1, bisect_right(self.at, stop - 1) - 1
        left = self.begin[i] + (begin - self.at[i] if self.copied[i] else 0)
        right = self.begin[j] + stop - self.at[j] if self.copied[j] else self.stop[j]
        return left, right


class Decoded(Layer):
    """The bytes of a base64 run, whose characters lie at `chars` of the source: three bytes are four of them."""

    def __init__(self, text: str, source: Layer, chars: list[int] | range):
        self.text, self.source, self.chars = text, source, chars

    def inside(self, begin: int, stop: int) -> tuple[int, int]:
        return self.chars[begin // 3 * 4], self.chars[min(len(self.chars) - 1, (stop - 1) // 3 * 4 + 3)] + 1


class Unpacked(Layer):
    """Content of a stream: all of it stands for the whole stream."""

    def __init__(self, text: str, source: Layer, begin: int, stop: int):
        self.text, self.source, self.stream = text, source, (begin, stop)

    def inside(self, begin: int, stop: int) -> tuple[int, int]:
        return self.stream


def percent_parts(text: str) -> list[tuple[int, int, str]]:
    """Each escape as the character of its byte; one part an escape, so that spans inside a run stay sharp."""
    parts = []
    for m in PERCENT.finditer(text):
        raw, at = binascii.unhexlify(m[0].replace("%", "")), m.start()
        parts += [(at + 3 * i, at + 3 * i + 3, chr(b)) for i, b in enumerate(raw)]
    return parts


def unicode_parts(text: str) -> list[tuple[int, int, str]]:
    parts = []
    for m in UNICODE.finditer(text):
        kind, said = m.lastgroup, m[m.lastgroup]
        if kind == "name":
            new = html5.get(said + ";", "")
        else:
            code = int(said, BASES[kind[0]])
            new = chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else ""
        if new:
            parts.append((m.start(), m.end(), new))
    return parts


def wide_parts(text: str) -> list[tuple[int, int, str]]:
    """The NULs between characters of two bytes each, to be taken out."""
    return [(i, i + 1, "") for m in WIDE.finditer(text) for i in range(m.start(), m.end()) if text[i] == "\0"]


def inflated(text: str, at: int) -> Iterator[tuple[bytes, int]]:
    """Content of the stream that begins there, all members, in pieces, each with the end of what was read so far."""
    while PACKED.match(text, at):
        one = bz2.BZ2Decompressor() if text[at] == "B" else zlib.decompressobj(wbits=47)
        while not one.eof:
            chunk = text[at : at + FEED]
            try:
                raw = chunk.encode("latin-1")
            except UnicodeEncodeError as error:  # no byte: the stream ends before it
                raw = chunk[: error.start].encode("latin-1")
            if not raw:
                return
            at += len(raw)
            try:
                more = True
                while more:
                    yield one.decompress(raw, PIECE), at
                    raw = getattr(one, "unconsumed_tail", b"")
                    more = not one.eof and (bool(raw) or not getattr(one, "needs_input", True))
            except (zlib.error, OSError, ValueError):
                return
        at -= len(one.unused_data)
        yield b"", at


def windows(pieces: Iterator[tuple[bytes, int]], most_bytes: int) -> Iterator[bytes]:
    """The pieces as windows of `most_bytes`, each sharing half with the next."""
    held, fresh = bytearray(), False
    for piece, _ in pieces:
        held += piece
        fresh = fresh or bool(piece)
        while len(held) >= most_bytes:
            yield bytes(held[:most_bytes])
            del held[: max(1, most_bytes // 2)]
            fresh = len(held) > most_bytes // 2
    if fresh:
        yield bytes(held)


def packed_layers(layer: Layer, most_bytes: int) -> Iterator[Layer]:
    """Content of each compressed stream among the characters that are bytes."""
    done = 0
    for m in PACKED.finditer(layer.text):
        if m.start() < done:
            continue
        end, got = m.start(), False
        for piece, end in inflated(layer.text, m.start()):
            got = got or bool(piece)
        if not got:
            continue
        done = end
        for raw in windows(inflated(layer.text, m.start()), most_bytes):
            if LIVE.search(raw):
                yield Unpacked(raw.decode("latin-1"), layer, m.start(), end)


def base64_layers(layer: Layer) -> Iterator[Layer]:
    for m in BASE64.finditer(layer.text):
        yield from aligned(layer, m[0], range(m.start(), m.end()))
    for m in WRAPPED.finditer(layer.text) if "\n" in layer.text or "\r" in layer.text or "\\n" in layer.text else ():
        chars, at = [], m.start()
        for gap in [*BREAK.finditer(layer.text, m.start(), m.end()), None]:
            chars += range(at, gap.start() if gap else m.end())
            at = gap.end() if gap else at
        yield from aligned(layer, BREAK.sub("", m[0]), chars)


def aligned(layer: Layer, run: str, chars: list[int] | range) -> Iterator[Layer]:
    """What the run says when read from each of its first four characters on."""
    run = run.translate(URL_SAFE)
    for skip in range(4):
        size = len(run) - skip - ((len(run) - skip) % 4 == 1)
        raw = binascii.a2b_base64(run[skip : skip + size] + "=" * (-size % 4))
        if LIVE.search(raw):
            yield Decoded(raw.decode("latin-1"), layer, chars[skip : skip + size])


def scan(text: str, most_bytes: int = 64 << 20) -> tuple[list[Span], set[Span]]:
    """Spans of the text itself, and those that only its nested layers show, as spans of the text."""
    base, added = find(text), set()
    work, seen = [Layer(text)], set()
    while work:
        layer = work.pop()
        if not layer.text:
            continue
        for escapes, parts_of in (("%", percent_parts), ("\\&", unicode_parts), ("\0", wide_parts)):
            if any(e in layer.text for e in escapes) and (parts := parts_of(layer.text)):
                work += _new(Spliced(layer, parts), seen, added)
        for inner in base64_layers(layer):
            work += _new(inner, seen, added)
        for inner in packed_layers(layer, most_bytes):
            work += _new(inner, seen, added)
    return base, added - set(base)


def _new(layer: Layer, seen: set, added: set[Span]) -> list[Layer]:
    if not layer.text:
        return []
    mark = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), *layer.whole())
    if mark in seen:
        return []
    seen.add(mark)
    added.update((kind, *layer.origin(a, b)) for kind, a, b in find(layer.text))
    return [layer]


def spelled(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def secret_spans(df: DataFrame, text: str = "text", keep: tuple[str, ...] = (), most_bytes: int = 64 << 20) -> DataFrame:
    """One row per row of `df`: the columns named in `keep`, `base_spans` and `nested_spans` (kind:start:end, comma-joined).

    Only the text and the kept columns go to the Python workers; nothing is shuffled.
    """
    small_batches(df.sparkSession)
    source, out = laid_out(df, keep, F.col(text), StructType().add("base_spans", "string").add("nested_spans", "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t or "", most_bytes) for t in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array([spelled(base) for base, _ in found], pa.string())]
            columns += [pa.array([spelled(added) for _, added in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return source.mapInArrow(tidy(run), out)


def masked(text: str, spans: str, mark: str = "[secret]") -> str:
    """The text with every span, or union of overlapping spans, replaced by the mark."""
    ranges = sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s)
    out, done = [], 0
    for begin, stop in ranges:
        if begin >= done:
            out += [text[done:begin], mark]
        done = max(done, stop)
    return "".join([*out, text[done:]])


def mask_secrets(df: DataFrame, text: str = "text", mark: str = "[secret]", most_bytes: int = 64 << 20) -> DataFrame:
    """`df` with the secrets of its text masked: same columns and rows, null texts stay null."""
    small_batches(df.sparkSession)
    at, schema = df.columns.index(text), df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t in batch.column(at).to_pylist():
                if t:
                    base, added = scan(t, most_bytes)
                    t = masked(t, spelled({*base, *added}), mark) if base or added else t
                texts.append(t)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(tidy(run), schema)


def secret_digest(documents: DataFrame) -> DataFrame:
    """doc_id, counts of the base spans by kind, a hash of them, and all spans: see the module text for odd rows."""
    found = secret_spans(documents, "text", ("doc_id",))
    count = lambda kind: F.regexp_count("base_spans", F.lit(f"{kind}:")).cast("long")
    joined = F.concat_ws(",", F.expr("nullif(base_spans, '')"), F.expr("nullif(nested_spans, '')"))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2("base_spans", 256).alias("base_sha256"),
        _ordered(joined).alias("spans"),
    )


def _ordered(joined):
    """Comma-joined spans by start, then kind as listed, then end."""
    row = F.transform(
        F.filter(F.split(joined, ","), lambda s: s != ""),
        lambda s: F.struct(
            F.split(s, ":")[1].cast("long").alias("start"),
            F.array_position(F.array(*map(F.lit, KINDS)), F.split(s, ":")[0]).alias("rank"),
            F.split(s, ":")[2].cast("long").alias("end"),
            s.alias("span"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(row), lambda r: r["span"]), ",")
