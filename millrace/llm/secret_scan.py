"""Secrets in texts: patterns, and structures that confirm themselves.

The base patterns report assignments, access key ids and long hex runs. Beside them, a key
is looked for at every place where base64 or hex could begin one, within longer runs too, and
over line ends (white space, or as escapes such as a literal ``\\n``). Its own lengths tell
where it ends, and no letter or digit may follow. It is reported if its bytes parse:

* ``der``: a sequence whose nested lengths all fit and that has a key's form: a version, an
  algorithm identifier, alone with an octet string if encrypted, or at least three integers;
* ``openssh``: the key container's magic, followed by length-prefixed fields that fit;
* ``jwt``: any three neighbours of dotted base64url parts, of which the first two decode to
  JSON objects and the header names an algorithm; the header may end a longer part;
* ``pem``: armour lines around base64 that decodes to ``der`` or ``openssh``, or that headers
  call encrypted.

Spans are counted in code points, the end is exclusive. Within a kind they don't overlap.

Defined cases: a null text is empty and an empty text has no spans; texts are scanned
whole; each row is judged alone, so repeated rows are no matter.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: In the order in which spans with the same start are listed. The first three are the base.
KINDS = ("assign", "access", "hex", "der", "openssh", "jwt", "pem")
BASE = KINDS[:3]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
#: One of these, or no assignment.
_NAMES = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run of 24 and more; a shorter one would be dropped.
_HEX = re.compile(r"[0-9a-f]{24,}")
#: What can stand between the lines of a key.
_BREAK = re.compile(r"(?:\s|\\+(?:[nrt]|u000[aAdD]|(?=/)))+")
#: How a key can begin, its characters, those that may not follow it, how many make n bytes, and their bytes.
_FORMS = (
    (re.compile(r"M[A-P]|b3Blbn"), re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[A-Za-z0-9+]"), lambda n: (4 * n + 2) // 3, lambda run: _decoded(run)),
    (re.compile(r"30|6[Ff]70"), re.compile(r"[0-9A-Fa-f]+"), re.compile(r"[0-9A-Fa-f]"), lambda n: 2 * n, bytes.fromhex),
)
#: A header of an object with ``alg`` has eight characters at least; a payload may be ``{}``, a signature empty.
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]*+){2,}")
#: How an object can begin; what stands before it in a part is not the header's.
_OBJECT = re.compile(r"e[w-z0-9_-]")
_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
_ESCAPED = re.compile(r"\\+(?:([nrt]|u000[aAdD])|(?=/))")
_QUOTES = re.compile(r"""["'][\s+.,&\\]*["']""")
_SSH_MAGIC = b"openssh-key-v1\0"


def _decoded(run: str) -> bytes | None:
    try:
        plain = run.rstrip("=").translate(str.maketrans("-_", "+/"))
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER elements that exactly fill data[at:end], else None."""
    found = []
    while at < end:
        if at + 2 > end:
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length >= 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > end:
                return None
            length = int.from_bytes(data[at : at + size], "big")
            at += size
        if at + length > end:
            return None
        found.append((tag, at, at + length))
        at += length
    return found


def _nested(data: bytes, start: int, end: int, depth: int = 8) -> list[tuple[int, int, int]] | None:
    """The elements of a sequence, if the lengths fit at every level."""
    inner = _elements(data, start, end)
    if inner is None or depth == 0:
        return None
    for tag, a, b in inner:
        if tag in (0x30, 0x31) and _nested(data, a, b, depth - 1) is None:
            return None
    return inner


def is_der_key(data: bytes) -> bool:
    if len(data) < 24 or data[0] != 0x30:
        return False
    outer = _elements(data, 0, len(data))
    if outer is None or len(outer) != 1:
        return False
    inner = _nested(data, outer[0][1], outer[0][2])
    if not inner or len(inner) < 2:
        return False
    tags = [tag for tag, _, _ in inner]
    if tags[0] == 0x02 and (inner[0][2] - inner[0][1] != 1 or data[inner[0][1]] > 1):  # no version
        return False
    if tags[:4] == [0x02] * 4 and set(tags) <= {0x02, 0x30}:  # version and numbers of a private RSA or DSA key
        return True
    if tags[0] == 0x02 and tags[1] in (0x30, 0x04):  # version, then algorithm or EC scalar
        algorithm = _elements(data, *inner[1][1:]) if tags[1] == 0x30 else None
        return tags[1] == 0x04 or bool(algorithm) and algorithm[0][0] == 0x06 and 0x04 in tags[2:]
    if tags == [0x30, 0x04]:  # algorithm and an encrypted key; public keys are no secrets
        algorithm = _elements(data, *inner[0][1:])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return False


def _openssh_size(read: Callable[[int], bytes | None]) -> int:
    """Bytes up to the end of the fields: cipher, key derivation and its options, number of keys,
    one public key and the private part; 0 if they don't fit. ``read`` gives the first n bytes.
    """
    at = len(_SSH_MAGIC)
    if read(at) != _SSH_MAGIC:
        return 0
    for field in ("cipher", "derivation", "options", "count", "public", "private"):
        data = read(at + 4)
        if data is None:
            return 0
        at += 4
        if field != "count":
            at += int.from_bytes(data[-4:], "big")
    return at if read(at) is not None else 0


def is_openssh_key(data: bytes) -> bool:
    return _openssh_size(lambda n: data[:n] if n <= len(data) else None) > 0


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """Where the content of the element at ``at`` begins and ends."""
    if at + 2 > len(data):
        return None
    size = data[at + 1] & 0x7F if data[at + 1] >= 0x80 else 0
    if size > 4 or data[at + 1] == 0x80 or at + 2 + size > len(data):
        return None
    begin = at + 2 + size
    return begin, begin + (int.from_bytes(data[at + 2 : begin], "big") if size else data[at + 1])


def _der_size(read: Callable[[int], bytes | None]) -> int:
    """The length of a sequence that begins as a key does, 0 if none does.

    A version of one byte, or an algorithm with its identifier, comes first, and the element
    behind it fits into the sequence: so only the beginnings of keys are read in full.
    """
    head = read(9)
    outer = _length(head, 0) if head and head[0] == 0x30 else None
    if outer is None or outer[1] < 24:
        return 0
    begin, end = outer
    first = head[begin] if begin < len(head) else 0
    if first not in (0x02, 0x30):
        return 0
    # Headers of up to six bytes within and behind the first element.
    data = read(min(begin + 12, end))
    inner = data and _length(data, begin)
    if not inner or inner[1] >= end:
        return 0
    if first == 0x02 and (inner[1] - inner[0] != 1 or data[inner[0]] > 1):
        return 0
    if first == 0x30 and (inner[0] >= len(data) or data[inner[0]] != 0x06 or inner[1] > begin + 512):
        return 0
    data = read(min(inner[1] + 6, end))
    following = data and _length(data, inner[1])
    return end if following and following[1] <= end and data[inner[1]] in (0x02, 0x04, 0x30) else 0


def _gathered(text: str, at: int, n: int, run: re.Pattern) -> tuple[str, int] | None:
    """``n`` characters of ``run`` from ``at`` on, over line ends, and where they end."""
    if n > len(text) - at:
        return None
    parts = []
    while m := run.match(text, at, at + n):
        parts.append(m[0])
        n -= len(m[0])
        if not n:
            return "".join(parts), m.end()
        if not (m := _BREAK.match(text, m.end())):
            break
        at = m.end()
    return None


def _keys(text: str) -> Iterator[tuple[int, int, str]]:
    for first, run, more, chars, bytes_of in _FORMS:
        at = 0
        while m := first.search(text, at):
            start, at = m.start(), m.start() + 1

            def read(n: int) -> bytes | None:
                part = _gathered(text, start, chars(n), run)
                return part and bytes_of(part[0])

            head = read(9)
            if head is None:
                continue
            if _SSH_MAGIC.startswith(head):
                kind, size = "openssh", _openssh_size(read)
            else:
                kind, size = "der", _der_size(read)
            if not size or not (part := _gathered(text, start, chars(size), run)):
                continue
            end = part[1]
            if kind == "openssh":
                # Bytes behind the fields are the key's as well.
                rest = run.match(text, end)
                end = rest.end() if rest else end
            elif more.match(text, end) or not is_der_key(bytes_of(part[0])):
                continue
            if first is _FORMS[0][0]:
                end += min(len(text[end : end + 2]) - len(text[end : end + 2].lstrip("=")), 2)
            yield start, end, kind
            at = end


def _armoured(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _ARMOUR.finditer(text):
        close, mark = text.find("-----", m.end()), f"-----END {m[1]}-----"
        if close < 0 or not text.startswith(mark, close):
            continue
        # Texts in code: escapes, and one quoted line beside the other.
        body = _ESCAPED.sub(lambda e: "\n" if e[1] else "", text[m.end() : close])
        lines = _QUOTES.sub("", body).strip(" \n\"'\\").splitlines()
        data = "".join(line for line in lines if ":" not in line)
        encrypted = any(re.match(r"\s*Proc-Type: *4, *ENCRYPTED", line) for line in lines) and any("DEK-Info:" in line for line in lines)
        found = _decoded("".join(data.split()))
        if _structure(found) or encrypted and found and len(found) >= 24:
            yield m.start(), close + len(mark), "pem"


def _object(part: str) -> dict | None:
    try:
        found = json.loads(_decoded(part) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _header(part: str) -> tuple[int, str] | None:
    """Where a token's header begins in a part, and its algorithm; each of the four alignments is decoded once."""
    decoded: dict[int, bytes | None] = {}
    for start in [0, *(o.start() for o in _OBJECT.finditer(part))]:
        turn = start % 4
        if turn not in decoded:
            decoded[turn] = _decoded(part[turn:])
        data, at = decoded[turn], (start - turn) // 4 * 3
        if not data or data[at : at + 1] != b"{" or not data.rstrip().endswith(b"}"):
            continue
        try:
            found = json.loads(data[at:])
        except (ValueError, RecursionError):
            continue
        if isinstance(found, dict) and isinstance(found.get("alg"), str):
            return start, found["alg"]
    return None


def _tokens(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _DOTTED.finditer(text):
        parts, at, k = m[0].split("."), m.start(), 0
        while k + 2 < len(parts):
            size = 1
            if parts[k + 1][:1] == "e" and _object(parts[k + 1]) is not None:
                header = _header(parts[k])
                # Only a token that says so goes unsigned.
                if header and (parts[k + 2] or header[1].lower() == "none"):
                    size = 3
                    yield at + header[0], at + len(".".join(parts[k : k + 3])), "jwt"
            at += sum(len(part) + 1 for part in parts[k : k + size])
            k += size


def _structure(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der" if is_der_key(data) else "openssh" if is_openssh_key(data) else None


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), by start and then by the order of KINDS."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    found += _keys(text)
    if "." in text:
        found += _tokens(text)
    if "-----BEGIN " in text:
        found += _armoured(text)
    return sorted(set(found), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def spans(text: Column) -> Column:
    """array<struct<start int, end int, kind string>> of a text."""

    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])

    @F.arrow_udf("array<struct<start: int, end: int, kind: string>>")
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [[dict(zip(("start", "end", "kind"), s)) for s in spans_of(text.as_py() or "")] for text in batch]
            yield pa.array(rows, type=pa.list_(kind))

    return scanned(text)


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch of touching or overlapping spans replaced by ``mark``."""

    @F.arrow_udf("string")
    def masked(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), found.to_pylist()):
            if not text or not spans:
                out.append(text)
                continue
            kept, at, hidden = [], 0, -1
            for span in spans:
                if span["start"] > hidden:
                    kept += [text[at : span["start"]], mark]
                hidden = max(hidden, span["end"])
                at = hidden
            out.append("".join([*kept, text[at:]]))
        return pa.array(out, type=pa.string())

    return masked(text, found)
