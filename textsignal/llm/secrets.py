"""Secrets in text: patterns propose, and decoded structure confirms.

Base kinds are patterns with a length rule. On top, base64 and hex candidates are decoded and reported only
when they hold a key encoding whose nested lengths add up, or a signed token whose header names an algorithm.
"""
import base64
import binascii
import bisect
import json
import re

import pyarrow as pa

from textsignal.llm.common import slices

# The base patterns, each with the group and length that count. A run of one class that is long
# enough is found by its length alone; the assigned value is measured after the match, since short ones use up their text.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_MIN = 6
BASE = ("assign", "access", "hex")

# A token's first part starts at the first eyJ of a run that has room for it; runs are tried once each, so long ones cost linear time.
HEADER_RUN = re.compile(r"[A-Za-z0-9_-]{13,}")
TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
ENCODED = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40})KEY-----([A-Za-z0-9+/=\s]+)-----END [A-Z0-9 ]{0,40}KEY-----")
HEX_BYTES = re.compile(r"[0-9A-Fa-f]{64,}")
# Where a DER sequence may start in base64 or hex, wherever the run around it starts; lines of it may be broken and indented.
START_64 = re.compile(r"M[A-P][A-Za-z0-9+/_-]{2}")
START_HEX = re.compile(r"30[0-8][0-9A-Fa-f]")
RUN_64 = re.compile(r"[A-Za-z0-9+/_-]+")
RUN_HEX = re.compile(r"[0-9A-Fa-f]+")
PADDING = re.compile(r"={0,2}")
BREAK = re.compile(r"\r?\n[\x20\t]{0,8}")
MAX_INSIDE = 1 << 16   # bytes of a key that begins inside a run, so that crafted lengths cost bounded time; a key that is a run of its own has no bound
HEAD_BYTES = 18   # enough for the outer header and that of the first element
FOUND = ("key", "ssh", "token")
KINDS = BASE + FOUND
MAX_DEPTH = 12


def _tlv(data, at, end):
    """Tag, content range of the element at `at`, or None if its length does not fit."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at:at + n], "big"), at + n
    return (tag, at, at + size) if at + size <= end else None


def is_key_der(data):
    """True for one DER sequence that fills the data, whose nested lengths all fit and which starts like a key."""
    todo, inner = [(0, len(data), 0)], []
    while todo:
        at, end, depth = todo.pop()
        while at < end:
            element = _tlv(data, at, end)
            if element is None or depth > MAX_DEPTH:
                return False
            tag, start, stop = element
            if depth == 1:
                inner.append((tag, stop - start))
            if depth == 0 and (tag != 0x30 or stop != len(data)):
                return False
            if tag & 0x20:
                todo.append((start, stop, depth + 1))
            at = stop
    if len(inner) < 2 or len(data) < 24:
        return False
    # A private key starts with a version number; a public one is an algorithm and a bit string.
    return inner[0] == (0x02, 1) or inner[0][0] == 0x30 and inner[1][0] in (0x03, 0x04)


def _take(text, at, n, run):
    """End of the first `n` characters of the class of `run` from `at` on, over line breaks, or None if there are fewer."""
    while True:
        found = run.match(text, at, at + n)
        if found is None:
            return None
        if found.end() - at == n:
            return found.end()
        n, at = n - (found.end() - at), found.end()
        at = gap.end() if (gap := BREAK.match(text, at)) else len(text)


def _der_size(head):
    """Bytes of the sequence that starts with `head`, if its first element is a version number or a sequence."""
    outer = _tlv(head, 0, 1 << 32)
    if outer is None or outer[0] != 0x30 or not 24 <= outer[2] <= MAX_INSIDE or outer[1] + 2 > len(head):
        return None
    first = _tlv(head, outer[1], outer[2])
    return outer[2] if first and (first[0] == 0x30 or first[0] == 0x02 and first[2] - first[1] == 1) else None


def keys(text, start, run, chars, decode):
    """(start, end) of DER keys at any place of a run of encoded characters; `chars` tells how many encode n bytes.
    A place is decoded in full only after its first bytes look like a key."""
    at = 0
    while found := start.search(text, at):
        at = found.start() + 1
        head_end = _take(text, found.start(), chars(HEAD_BYTES), run)
        size = head_end and _der_size(decode(text[found.start():head_end]) or b"")
        end = size and _take(text, found.start(), chars(size), run)
        if end and is_key_der((decode(text[found.start():end]) or b"")[:size]):
            yield found.start(), end
            at = end


def _unhex(text):
    return bytes.fromhex(text)


def is_ssh(data):
    """True for an OpenSSH private key, or length-prefixed fields that fill the data and start with a key type."""
    at = 15 if data.startswith(b"openssh-key-v1\0") else 0
    fields = []
    while at + 4 <= len(data) and len(fields) < 3:
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4:at + 4 + size])
        at += 4 + size
    if data.startswith(b"openssh-key-v1\0"):
        return len(fields) == 3 and fields[0].isascii()
    return len(fields) >= 2 and fields[0].startswith((b"ssh-", b"ecdsa-sha2-", b"sk-"))


def decode64(text):
    """Bytes of standard or URL-safe base64 with or without padding; None if it is none."""
    body = re.sub(r"\s+", "", text).rstrip("=").translate({45: 43, 95: 47})
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def structure(data):
    """Kind of key encoding in the bytes, or None."""
    if data and data[0] == 0x30 and is_key_der(data):
        return "key"
    if data and (data.startswith(b"openssh-key-v1\0") or data[:2] == b"\0\0") and is_ssh(data):
        return "ssh"
    return None


def is_token(text):
    """True if the first part is a JSON header that names an algorithm and the second decodes to a JSON object."""
    try:
        head, body = (json.loads(decode64(p) or b"") for p in text.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def tokens(text):
    """(start, end) of what looks like a signed token, leftmost first and without overlaps."""
    at = text.find("eyJ")
    while at >= 0:
        run = HEADER_RUN.match(text, at)
        found = run and TOKEN.match(text, at)
        if found:
            yield found.span()
        at = text.find("eyJ", found.end() if found else run.end() if run else at + 3)


def outside(spans, others):
    """Those of `others` that share no character with one of the spans."""
    cover = []
    for start, end in sorted(spans):
        if cover and start < cover[-1][1]:
            cover[-1][1] = max(cover[-1][1], end)
        else:
            cover.append([start, end])
    for start, end in others:
        near = bisect.bisect_left(cover, [end, 0]) - 1   # the last stretch that starts before the end
        if near < 0 or cover[near][1] <= start:
            yield start, end


def find(text):
    """(start, kind, end) of every span, by start and then by kind as listed in KINDS. Null text has none."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_MIN]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    more = set()
    for m in ARMOUR.finditer(text):
        data = decode64(m[2])
        kind = data is not None and structure(data)
        if kind:
            more.add((m.start(), KINDS.index(kind), m.end()))
    more.update((s, KINDS.index("token"), e) for s, e in tokens(text) if is_token(text[s:e]))
    for m in ENCODED.finditer(text):
        kind = (data := decode64(m[0])) and structure(data)
        if kind:
            more.add((m.start(), KINDS.index(kind), m.end()))
    for m in HEX_BYTES.finditer(text):
        kind = structure(bytes.fromhex(m[0][:len(m[0]) // 2 * 2]))
        if kind:
            more.add((m.start(), KINDS.index(kind), m.end()))
    whole = [(s, e) for s, k, e in more if KINDS[k] != "token"]
    inside = [*keys(text, START_64, RUN_64, lambda n: -(-n * 4 // 3), decode64), *keys(text, START_HEX, RUN_HEX, lambda n: 2 * n, _unhex)]
    more.update((s, KINDS.index("key"), e) for s, e in outside(whole, ((s, PADDING.match(text, e).end()) for s, e in inside)))
    return [(s, KINDS[k], e) for s, k, e in sorted(spans + list(more))]


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan(docs, text="text", name="secrets"):
    """Add the spans of each text as an array of (kind, start, end) in code points, end exclusive. No shuffle."""
    from pyspark.sql import types as T
    kept = [f for f in docs.schema.fields if f.name != name]
    schema = T.StructType(kept + [T.StructField(name, T._parse_datatype_string(SPANS))])
    inner = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, 2 << 20, text):
                found = [[{"kind": k, "start": s, "end": e} for s, k, e in find(t)] for t in batch.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(found, inner)], names=schema.names)
    return docs.mapInArrow(run, schema)
