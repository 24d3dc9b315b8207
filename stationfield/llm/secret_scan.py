"""Secrets: an Aho-Corasick automaton finds keywords, and patterns are tried only where it hits.

Texts are scanned as UTF-8 bytes, folded A-Z to a-z, so a keyword hit is one pass over the text
whatever the number of keywords. Each hit anchors its kind's pattern. Runs of hexadecimal digits
have no keyword of their own; there the keyword is 24 times "digit" in the text's character
classes. The last kinds carry their own checksum (CRC-32 in base 62, the format of public
code-hosting and package tokens), and are dropped where it is wrong.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in the order in which spans at one place are listed.
KINDS = ("assign", "access", "hex", "signed")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
SIGNED_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
SIGNED = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase

_HEX_CLASS = bytes(120 if chr(b) in "0123456789abcdef" else 46 for b in range(256))
_HEX_RUN = b"x" * 24

Span = tuple[str, int, int]


@cache
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_WORDS), ("access", ("akia",)), ("signed", SIGNED_WORDS)):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def checksum62(body: bytes) -> str:
    """CRC-32 as six digits of base 62."""
    value, out = zlib.crc32(body), ""
    while value:
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out.rjust(6, "0")


def _holds(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[2]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    return checksum62(m[1]).encode() == m[2]


def scan(text: str | None) -> list[Span]:
    """Spans (kind, start, end) of one text in code points, by start and then kind."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    found: list[Span] = []
    ends = dict.fromkeys(KINDS, 0)  # matches of a kind, kept or dropped, do not overlap
    patterns = {"assign": ASSIGN, "access": ACCESS, "signed": SIGNED}
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in _automaton().iter(data.lower().decode("latin-1")))
    for start, kind in hits:
        if start >= ends[kind] and (m := patterns[kind].match(data, start)):
            ends[kind] = m.end()
            if _holds(kind, m):
                found.append((kind, start, m.end()))
    classes, at = data.translate(_HEX_CLASS), 0
    while (at := classes.find(_HEX_RUN, at)) >= 0:
        end = HEX.match(data, at).end()
        found.append(("hex", at, end))
        at = end
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    if len(data) == len(text):
        return found
    return _in_code_points(data, found)


def _in_code_points(data: bytes, spans: list[Span]) -> list[Span]:
    places = sorted({p for _, start, end in spans for p in (start, end)})
    at, count, points = 0, 0, {}
    for p in places:
        count += len(data[at:p].decode("utf-8", "surrogatepass"))
        at, points[p] = p, count
    return [(kind, points[start], points[end]) for kind, start, end in spans]


def redacted(text: str | None, spans: list[Span], mask: str = "[SECRET]") -> str | None:
    """The text with every run of overlapping spans replaced by `mask`."""
    if not spans:
        return text
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


SCHEMA = "spans array<struct<kind:string,start:bigint,end:bigint>>, redacted string"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def secrets(docs: DataFrame, text: str = "text", redact: bool = True) -> DataFrame:
    """`row` (the whole row), `spans` and, on request, the `redacted` text. Nothing is shuffled.

    Null texts have no spans and stay null. Works on whole texts of any length.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = [scan(t) for t in texts]
            clean = [redacted(t, s) if redact else None for t, s in zip(texts, spans, strict=True)]
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(rows, _SPANS), pa.array(clean, pa.string())], ["row", "spans", "redacted"]
            )

    keep = [c for c in docs.columns if c != text or not redact]
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    return given.mapInArrow(scanned, f"row {given.schema['row'].dataType.simpleString()}, {SCHEMA}")


def redact_secrets(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns of `docs`, with secrets masked in the text and its length set anew."""
    out = secrets(docs, text)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != text} | {text: F.col("redacted")}
    if n_chars in docs.columns:
        columns[n_chars] = F.when(F.size("spans") > 0, F.length("redacted").cast(docs.schema[n_chars].dataType)).otherwise(columns[n_chars])
    return out.select(*[columns[c].alias(c) for c in docs.columns])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a hash of their spans, and all spans as text."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [scan(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in x if s[0] != "signed"] for x in spans]
            counts = [pa.array([sum(s[0] == kind for s in x) for x in base], pa.int64()) for kind in KINDS[:3]]
            hashes = [hashlib.sha256(listed(x).encode()).hexdigest() for x in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(hashes, pa.string()), pa.array(map(listed, spans), pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        scanned, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )
