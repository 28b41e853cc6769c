"""Secret scan with structural confirmation.

Plain patterns find credentials by their wording (assign, access, hex). Encoded material is reported only
if it holds what it claims to hold: a candidate run of base64 or hexadecimal digits is decoded, and
its structure is parsed to the last byte.

``der``  a DER sequence that begins with the integers and algorithm identifiers of a key, all nested lengths exact
``ssh``  a key in length-prefixed fields: the private-key container, or a public key whose type is named first
``pem``  an armoured private key: its label, and a body that decodes to one of the two forms above
``jwt``  a signed token: a header that is a JSON object naming its algorithm, a payload that is a JSON object
         and a signature as long as the algorithm makes it
``jwe``  an encrypted token in five parts: a header that also names the cipher, start value and tag of its lengths

Keys are found wherever in a run of digits they begin, in lines with or without real line ends, and in pairs of
hexadecimal digits behind colons.

Offsets are code points, ends exclusive. Null and empty texts have no spans.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import itertools
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.llm.common import bounded_batches

KINDS = ("assign", "access", "hex", "der", "jwe", "jwt", "pem", "ssh")
BASE = KINDS[:3]
SPANS = "array<struct<kind: string, start: long, end: long>>"

# Patterns of the plain kinds, and the least length of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

LONG_HEX = re.compile(r"[0-9a-f]{24,}")
# Lines of 40 digits or more, broken or with a written line end, go on in the next line.
LINE_END = re.compile(r"\r?\n[\x20\t]*|\\r\\n|\\n")
HEX_RUN = re.compile(rf"(?:[0-9A-Fa-f]{{40,}}+(?:{LINE_END.pattern})(?=[0-9A-Fa-f]))*+[0-9A-Fa-f]++")
HEX_PAIRS = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::\s*[0-9A-Fa-f]{2})+")
BASE64_RUN = re.compile(rf"(?<![A-Za-z0-9+/])(?:[A-Za-z0-9+/]{{40,}}+(?:{LINE_END.pattern})(?=[A-Za-z0-9+/]))*+[A-Za-z0-9+/]++")
LEAST_DIGITS = {16: 48, 64: 32}
# How keys begin: a sequence of 32 bytes or more, or a length and the type behind it.
HEADS = {
    16: re.compile(r"(?=30(?:8[1-4]|[2-7][0-9a-f])|000000[0-3][0-9a-f](?:7373682d|6563647361|736b2d)|6f70656e7373682d6b6579)"),
    64: re.compile(r"(?=M[C-I]|AAAA[A-P]|b3BlbnNzaC1r)"),
}
TOKEN_PART = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}(?=\.)")
TOKEN_END = r"(?![A-Za-z0-9_-]|\.[A-Za-z0-9_-])"
SIGNED_REST = re.compile(rf"\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*){TOKEN_END}")
SEALED_REST = re.compile(rf"\.([A-Za-z0-9_-]*)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)\.([A-Za-z0-9_-]+){TOKEN_END}")
ARMOUR = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ )*)PRIVATE KEY-----")
# Bytes of the signature by algorithm; the curve and RSA forms depend on the key.
SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EDDSA": 64}
SIGNATURE_NAMES = re.compile(r"(HS|RS|ES|PS)(256|384|512)|EdDSA|ES256K|none")
# Bytes of the start value and of the tag of encrypted tokens; types of public keys and their number of fields.
START_BYTES, TAG_BYTES = (12, 16), (16, 24, 32)
SSH_TYPES = ((re.compile(rb"ssh-rsa"), 3), (re.compile(rb"ssh-dss"), 5), (re.compile(rb"ssh-ed(25519|448)"), 2), (re.compile(rb"ecdsa-sha2-nistp(256|384|521)"), 3),
             (re.compile(rb"sk-ssh-ed25519(@[a-z.]+)?"), 3), (re.compile(rb"sk-ecdsa-sha2-nistp256(@[a-z.]+)?"), 4))
SSH_CONTAINER = b"openssh-key-v1\0"

Span = tuple[int, str, int]


# --- structures --------------------------------------------------------------------------

def der_items(data: bytes, at: int, stop: int, depth: int = 0) -> list[tuple[int, int, int, list]] | None:
    """The items of DER between two places as (tag, start and end of the content, items inside), None unless every length fits exactly."""
    items = []
    while at < stop:
        if at + 2 > stop or data[at] & 0x1F == 0x1F or depth > 16:
            return None
        tag, (first, end) = data[at], content_of(data, at, stop)
        if end < 0:
            return None
        inside = []
        if tag & 0x20:
            inside = der_items(data, first, end, depth + 1)
            if inside is None:
                return None
        elif tag == 0x02 and (first == end or end - first > 1 and data[first] in (0, 255) and data[first] >> 7 == data[first + 1] >> 7):
            return None
        items.append((tag, first, end, inside))
        at = end
    return items


def content_of(data: bytes, at: int, stop: int) -> tuple[int, int]:
    """Where the content of the item at ``at`` begins and ends; (-1, -1) if its length is not in the shortest form or leads too far."""
    size, first = data[at + 1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or first + width > stop:
            return -1, -1
        size, first = int.from_bytes(data[first:first + width], "big"), first + width
        if size < 0x80 or size >> 8 * (width - 1) == 0:
            return -1, -1
    return (first, first + size) if first + size <= stop else (-1, -1)


def der_key_end(data: bytes, at: int) -> int:
    """Where the DER key that begins at ``at`` ends, -1 if there is none: one sequence in one of the forms keys have.

    Version and integers (RSA, DSA), version and octet string (EC), version, algorithm and octet
    string (any private key), algorithm and bit string (any public key), or an
    algorithm and an octet string (an encrypted key).
    """
    if at + 24 > len(data) or data[at] != 0x30:
        return -1
    first, end = content_of(data, at, len(data))
    if end < at + 24:
        return -1
    inside = der_items(data, first, end)
    if not inside or len(inside) < 2:
        return -1
    tags = [tag for tag, *_ in inside]

    def size(item) -> int:
        return item[2] - item[1]

    def algorithm(item) -> bool:
        return item[0] == 0x30 and bool(item[3]) and item[3][0][0] == 0x06 and size(item[3][0]) >= 3

    if tags[0] == 0x02 and size(inside[0]) == 1 and data[inside[0][1]] <= 1:
        if all(tag == 0x02 for tag in tags):
            return end if len(tags) in (6, 9) else -1
        if tags[1] == 0x04:
            return end if size(inside[1]) >= 16 and all(tag & 0xE0 == 0xA0 for tag in tags[2:]) else -1
        return end if len(tags) >= 3 and algorithm(inside[1]) and tags[2] == 0x04 else -1
    if algorithm(inside[0]):
        return end if len(tags) == 2 and tags[1] in (0x03, 0x04) and size(inside[1]) >= 16 else -1
    return end if tags == [0x02, 0x02] and size(inside[0]) >= 64 else -1


def field_end(data: bytes, at: int) -> int:
    """The end of the field behind a 4-byte length, -1 if it leads too far."""
    end = at + 4 + int.from_bytes(data[at:at + 4], "big")
    return end if at >= 0 and at + 4 <= end <= len(data) else -1


def ssh_key_end(data: bytes, at: int) -> int:
    """Where the key of length-prefixed fields that begins at ``at`` ends, -1 if there is none."""
    if data.startswith(SSH_CONTAINER, at):
        at += len(SSH_CONTAINER)
        cipher = field_end(data, at)
        if cipher < 0 or not data[at + 4:cipher].isascii():
            return -1
        at = field_end(data, field_end(data, cipher))  # key derivation and its options
        if at < 0 or at + 4 > len(data):
            return -1
        fields, at = int.from_bytes(data[at:at + 4], "big") + 1, at + 4  # public keys, and the private ones in one
        if fields < 2:
            return -1
    else:
        end = field_end(data, at)
        fields = next((n for name, n in SSH_TYPES if name.fullmatch(data, at + 4, end)), 0) if 0 <= end <= at + 68 else 0
        if not fields:
            return -1
    start = at
    for _ in range(fields):
        at, before = field_end(data, at), at
        if at < before + 5:
            return -1
    return at if at >= start + 32 else -1


def key_at(data: bytes | None, at: int = 0) -> tuple[str, int] | None:
    """Kind and end of the key that begins at ``at``."""
    for kind, end_of in (("der", der_key_end), ("ssh", ssh_key_end)):
        if data and (end := end_of(data, at)) >= 0:
            return kind, end
    return None


def from_base64(run: str) -> bytes | None:
    run = run.rstrip("=")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def from_base64url(part: str) -> bytes | None:
    return from_base64(part.replace("-", "+").replace("_", "/"))


def json_object(data: bytes | None) -> dict | None:
    try:
        found = json.loads(data.decode("utf-8")) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


# --- tokens ------------------------------------------------------------------------------

def last_object(data: bytes) -> int:
    """Where the JSON object that ends with ``data`` would begin, -1 if nowhere: the brace that closes the last one, read from
    the end. Quotes tell what is text, a quote behind an odd number of backslashes excepted."""
    depth, quoted, at = 0, False, len(data) - 1
    while at >= 0:
        byte = data[at]
        if byte == 0x22:
            slashes = at
            while slashes and data[slashes - 1] == 0x5C:
                slashes -= 1
            if (at - slashes) % 2 == 0:
                quoted = not quoted
            at = slashes
        elif not quoted and byte == 0x7D:
            depth += 1
        elif not quoted and byte == 0x7B:
            depth -= 1
            if depth == 0:
                return at
        elif depth == 0 and byte not in b" \t\r\n":
            return -1
        at -= 1
    return -1


def token_header(part: str) -> tuple[int, dict] | None:
    """A header that names its algorithm and ends with ``part``, and where it begins: at the start, or inside, as a dash or an underscore is a
    digit of its alphabet too. Each of the alignments has one possible beginning, so a part is decoded three times at most."""
    found = []
    for skipped in range(4):
        if (len(part) - skipped) % 4 == 1:
            continue
        data = from_base64url(part[skipped:])
        at = last_object(data) if data else -1
        if at >= 0 and at % 3 == 0:
            header = json_object(data[at:])
            start = skipped + at // 3 * 4
            if header is not None and isinstance(header.get("alg"), str) and (start == 0 or part[start - 1] in "-_"):
                found.append((start, header))
    return min(found, key=lambda f: f[0], default=None)


def is_signed(header: dict, payload: str, signature: str) -> bool:
    name = header["alg"]
    if not SIGNATURE_NAMES.fullmatch(name) or json_object(from_base64url(payload)) is None:
        return False
    data = from_base64url(signature) if signature else b""
    if data is None:
        return False
    return len(data) == 0 if name == "none" else len(data) == SIGNATURE_BYTES.get(name.upper(), len(data)) and len(data) >= 32


def is_sealed(header: dict, key: str, start: str, sealed: str, tag: str) -> bool:
    """A token in five parts: its header also names the cipher, and start value and tag have one of the lengths ciphers have."""
    parts = [from_base64url(part) if part else b"" for part in (key, start, sealed, tag)]
    return isinstance(header.get("enc"), str) and None not in parts and len(parts[1]) in START_BYTES and len(parts[3]) in TAG_BYTES


# --- spans -------------------------------------------------------------------------------

class Covered:
    """Disjoint spans, to be asked by place."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start

    def add(self, start: int, end: int) -> None:
        at = bisect.bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def armoured_keys(text: str) -> Iterator[Span]:
    """A foot closes the head right before it, so every body is read once."""
    head = None
    for mark in ARMOUR.finditer(text):
        if mark[1] == "BEGIN":
            head = mark
            continue
        if head is not None and head[2] == mark[2]:
            lines = [line.strip() for line in text[head.end():mark.start()].replace("\\r", "").replace("\\n", "\n").splitlines()]
            data = from_base64("".join("".join(line for line in lines if ":" not in line).split()))
            sealed = any(line.startswith("Proc-Type:") and "ENCRYPTED" in line for line in lines)
            found = key_at(data)
            if found and found[1] == len(data) or sealed and data and len(data) % 8 == 0:
                yield head.start(), "pem", mark.end()
        head = None


def tokens(text: str) -> Iterator[Span]:
    for match in TOKEN_PART.finditer(text):
        found = token_header(match[0])
        if found is None:
            continue
        start, header = found
        sealed = SEALED_REST.match(text, match.end()) if "enc" in header else None
        signed = None if sealed else SIGNED_REST.match(text, match.end())
        if sealed and is_sealed(header, *sealed.groups()):
            yield match.start() + start, "jwe", sealed.end()
        elif signed and is_signed(header, *signed.groups()):
            yield match.start() + start, "jwt", signed.end()


def keys_in(digits: str, base: int) -> Iterator[tuple[int, str, int]]:
    """Keys (start, kind, end) in a run of base 16 or 64 digits, wherever in it they begin and at whatever digit; each alignment is decoded once."""
    group, size = (2, 1) if base == 16 else (4, 3)
    lower, decoded, after = digits.lower() if base == 16 else digits, {}, 0
    for head in HEADS[base].finditer(lower):
        at = head.start()
        if at < after:
            continue
        skipped = at % group
        if skipped not in decoded:
            own = digits[skipped:]
            spare = len(own) % 2 if base == 16 else int(len(own) % 4 == 1)
            own = own[:len(own) - spare]
            decoded[skipped] = bytes.fromhex(own) if base == 16 else from_base64(own)
        found = key_at(decoded[skipped], (at - skipped) // group * size)
        if found:
            length = found[1] - (at - skipped) // group * size
            after = at + -(-length * group // size)
            yield at, found[0], after


def encoded_keys(text: str) -> Iterator[Span]:
    """Keys in hexadecimal digits (plain, or in pairs behind colons) and in base64, over line ends too."""
    for pattern, base in ((HEX_PAIRS, 16), (HEX_RUN, 16), (BASE64_RUN, 64)):
        for match in pattern.finditer(text):
            if match.end() - match.start() < LEAST_DIGITS[base]:
                continue
            breaks = re.compile(r":\s*") if pattern is HEX_PAIRS else LINE_END
            begins, ends = [match.start()], []
            for gap in breaks.finditer(match[0]):
                ends.append(match.start() + gap.start())
                begins.append(match.start() + gap.end())
            ends.append(match.end())
            pieces = [text[b:e] for b, e in zip(begins, ends, strict=True)]
            before = [0, *itertools.accumulate(map(len, pieces))]

            def place(at: int) -> int:
                piece = bisect.bisect_right(before, at, 0, len(pieces)) - 1
                return begins[piece] + at - before[piece]

            for first, kind, last in keys_in("".join(pieces), base):
                end = place(last - 1) + 1
                padding = -(last - first) % 4 if base == 64 and last == before[-1] else 0
                while padding and text[end:end + 1] == "=":
                    end, padding = end + 1, padding - 1
                yield place(first), kind, end


def structured_spans(text: str) -> list[Span]:
    """Encoded keys and tokens whose structure holds. Armoured blocks come first, then tokens, and what they cover is not reported again.
    The time is linear in the text, but for structures nested over sixteen deep."""
    spans, covered = [], Covered()
    for found in (armoured_keys, tokens, encoded_keys):
        for start, kind, end in found(text):
            if covered.free(start, end):
                covered.add(start, end)
                spans.append((start, kind, end))
    return spans


def find_spans(text: str | None) -> list[Span]:
    """All spans as (start, kind, end), by start and then by kind in the order of ``KINDS``."""
    if not text:
        return []
    spans: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        spans += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    longest = max(map(len, text.split()), default=0)
    if "AKIA" in text and longest >= LEAST["access"]:
        spans += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if longest >= LEAST["hex"]:
        spans += [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]
    if longest >= 24 or "PRIVATE KEY-----" in text:
        spans += structured_spans(text)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def spans_of(text: Column) -> Column:
    """The spans of a text column, as array<struct<kind, start, end>>; empty for a null text."""
    bounded_batches()

    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for s, k, e in find_spans(t if isinstance(t, str) else None)] for t in batch], dtype=object)

    return scan.asNondeterministic()(text)


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s.kind.isin(*kinds))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def mask(text: str | None, replacement: str) -> str | None:
    """The text with every span, overlapping ones as one, replaced."""
    if not text:
        return text
    out, end = [], 0
    for start, _, stop in find_spans(text):
        if start >= end:
            out += [text[end:start], replacement]
        end = max(end, stop)
    return "".join([*out, text[end:]]) if out else text


def masked(text: Column, replacement: str = "[SECRET]") -> Column:
    """The text column with all secrets replaced; other texts, null included, stay as they are."""
    bounded_batches()

    @F.pandas_udf("string")
    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([mask(t if isinstance(t, str) else None, replacement) for t in batch], dtype=object)

    return replace.asNondeterministic()(text)
