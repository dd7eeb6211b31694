"""Secrets in texts: keyword prefilter, anchored patterns near hits, checksum validation.

Method. One Aho-Corasick pass over the lower-cased bytes finds the keywords that secrets start with.
Anchored patterns run only at those places. Kinds whose tokens embed a checksum or a structure are then
validated by it. Runs of hexadecimal digits have no keyword; one pattern finds them.

Kinds: ``assign`` (a password, secret, token or key that is set to a value), ``access`` (cloud access key ids) and
``hex`` (long hexadecimal runs) are the base ones. Added: ``github`` and ``npm`` (the last six
characters are the CRC-32 of the rest in base 62), ``jwt`` (first part decodes to JSON with an algorithm) and
``pem`` (private key blocks).

Defined results: a null text is empty; spans count code points, end exclusive; spans of different
kinds may overlap; repeated rows give a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from selvatrace.llm.common import lean, pick, small

#: Base kinds first: their order breaks ties of spans that start together.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_GITHUB = re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_NPM = re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_JWT = re.compile(rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_PEM = re.compile(rb"-----BEGIN ([A-Z ]*PRIVATE KEY)-----[A-Za-z0-9+/=\s]+-----END \1-----")
#: What a first segment of a web token is made of.
_SEGMENT = re.compile(rb"[A-Za-z0-9_-]*")
_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_MIN_VALUE = 6
_MIN_ACCESS = 20

#: Keyword (lower case) to kind.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt", "-----begin ": "pem",
}
_PATTERNS = {"assign": _ASSIGN, "access": _ACCESS, "github": _GITHUB, "npm": _NPM, "jwt": _JWT, "pem": _PEM}


def base62_crc(body: bytes) -> bytes:
    """CRC-32 of ``body`` as six base-62 digits."""
    n, out = zlib.crc32(body), []
    for _ in range(6):
        n, d = divmod(n, 62)
        out.append(_DIGITS[d])
    return bytes(reversed(out))


def _jwt_ok(token: bytes) -> bool:
    head = token.split(b".")[0]
    try:
        parsed = json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(parsed, dict) and "alg" in parsed


def _valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= _MIN_VALUE
    if kind == "access":
        return m.end() - m.start() >= _MIN_ACCESS
    if kind in ("github", "npm"):
        return base62_crc(m[0][4:-6]) == m[0][-6:]
    return _jwt_ok(m[0]) if kind == "jwt" else True


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        out.add_word(word, (kind, len(word) - 1))
    out.make_automaton()
    return out


def find(text: str | None, keywords: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each secret, by start and then by kind."""
    raw = (text or "").encode("utf-8", "replace")
    # Lower-casing bytes touches A-Z only, and one character per byte keeps positions.
    near = sorted((end - back, kind) for end, (kind, back) in keywords.iter(raw.lower().decode("latin-1")))
    found, done = [], dict.fromkeys(_PATTERNS, 0)
    for at, kind in near:
        if at < done[kind]:
            continue
        if m := _PATTERNS[kind].match(raw, at):
            done[kind] = m.end()
            if _valid(kind, m):
                found.append((kind, at, m.end()))
        elif kind == "jwt":
            # Whatever follows this segment follows it for every later start within it.
            done[kind] = _SEGMENT.match(raw, at).end()
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(raw)]
    if found and not raw.isascii():
        places = sorted({p for _, s, e in found for p in (s, e)})
        points, done_to, so_far = {}, 0, 0
        for p in places:  # a code point starts at every byte that continues none
            so_far += sum(1 for b in raw[done_to:p] if b & 0xC0 != 0x80)
            points[p], done_to = so_far, p
        found = [(k, points[s], points[e]) for k, s, e in found]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each secret replaced by its kind in angle brackets; overlapping ones count as one."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(key, secrets): one row per row of ``docs``, with (kind, start, end) of each secret. With ``carry``, those
    columns of it in place of the key, and ``clean``: the text without its secrets."""
    columns = carry or [key]
    rows = pick(docs, *dict.fromkeys([*columns, text]))
    at = rows.columns.index(text)
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for b in small(batches):
            texts = b.column(at).to_pylist()
            spans = [find(t, keywords) for t in texts]
            told = pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in spans], kinds)
            out = {c: b.column(i) for i, c in enumerate(columns)} | {"secrets": told}
            if carry:
                out["clean"] = pa.array([redacted(t, s) for t, s in zip(texts, spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    clean = ", clean string" if carry else ""
    return rows.mapInArrow(lean(run), f"{schema}, secrets array<struct<kind:string,start:bigint,end:bigint>>{clean}")
