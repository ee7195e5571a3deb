"""Secret scans with multipart credential linking.

Strong findings stand alone: assignments of a secret, access identifiers and long hexadecimal runs.
Weak parts (bare random-looking tokens, service endpoints, key identifiers) say little alone. They are
linked by an interval join: each part, with its position, is matched to the parts of another sort
that begin within ``reach`` code points of it and in the same scope (a block between blank lines). A
weak part is reported only where such a complement stands near.

Defined cases: a null or empty text has no findings; texts are scanned whole; repeated rows are scanned
one by one; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, portions

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ENDPOINT = re.compile(r"(?:https?|s3|ftp|postgres|mysql|mongodb|redis)://[^\s\"'<>]+")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])")
IDENTIFIER = re.compile(r"\b(?:client_?id|access_?key_?id|account|username|user|login)\b[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.@=-]{3,})", re.IGNORECASE | re.ASCII)
SCOPE = re.compile(r"\n[\x20\t\r]*\n")
BASE_KINDS = ("assign", "access", "hex")
#: The sort of part that each kind is; a weak part needs one of another sort near it.
SORTS = {"assign": "secret", "hex": "secret", "weak_secret": "secret", "access": "identifier", "weak_id": "identifier", "endpoint": "endpoint"}
KINDS = (*BASE_KINDS, "weak_secret", "weak_id", "endpoint")
_HINTS = ("://", "amazonaws")
_BUCKET = re.compile(r"\.amazonaws\.com\b")
_LABEL = frozenset("abcdefghijklmnopqrstuvwxyz0123456789-")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return spans + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def entropy(token: str) -> float:
    """Bits a character, of the token's own characters."""
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def bucket_hosts(text: str) -> list[tuple[int, int]]:
    """Places of host names below amazonaws.com, each read back from its end, so that long runs take linear time."""
    found = []
    for m in _BUCKET.finditer(text):
        end = m.start()
        begin = end
        while begin and (text[begin - 1] in _LABEL or text[begin - 1] == "." and begin < end and text[begin] != "."):
            begin -= 1
            if found and begin < found[-1][1]:
                begin = found[-1][1]
                break
        while begin < end and (text[begin] == "." or begin and (text[begin - 1].isalnum() or text[begin - 1] == "_")):
            begin += 1
        if begin < end:
            found.append((begin, m.end()))
    return found


def weak_parts(text: str, min_entropy: float) -> list[tuple[int, int, str]]:
    parts = []
    for m in CANDIDATE.finditer(text):
        token = m[0]
        if any(c.isdigit() for c in token) and any(c.isupper() for c in token) and any(c.islower() for c in token) and entropy(token) >= min_entropy:
            parts.append((m.start(), m.end(), "weak_secret"))
    parts += [(m.start(), m.end(), "weak_id") for m in IDENTIFIER.finditer(text)]
    if any(hint in text for hint in _HINTS):
        urls = [m.span() for m in ENDPOINT.finditer(text)]
        parts += [(a, b, "endpoint") for a, b in urls]
        if urls:
            begins = [a for a, _ in urls]
            inside = lambda at: (k := bisect.bisect_right(begins, at)) > 0 and urls[k - 1][1] > at
            parts += [(a, b, "endpoint") for a, b in bucket_hosts(text) if not inside(a)]
        else:
            parts += [(a, b, "endpoint") for a, b in bucket_hosts(text)]
    return parts


def merged(spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that ascending spans cover."""
    starts, ends = [], []
    for start, end, _ in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def link(text: str, strong: list[tuple[int, int, str]], weak: list[tuple[int, int, str]], reach: int) -> list[tuple[int, int, str]]:
    """Weak parts that no strong span overlaps and that are near a complement in the same scope.

    An endpoint and an identifier are public, so a pair needs a secret on one side; an identifier or
    endpoint is reported when a secret is near, a secret when an identifier or endpoint is. All parts
    link, those under a strong span too (an endpoint whose path holds a key, say): only they are not
    reported again. Sorting aside, time is linear in the text and its parts.
    """
    if not weak:
        return []
    starts, ends = merged(sorted(strong))
    bounds = [m.start() for m in SCOPE.finditer(text)]
    scope = lambda at: bisect.bisect_right(bounds, at)
    # of each scope the starts of its parts, and the furthest end of the parts up to each
    secrets, others = {}, {}
    for start, end, kind in sorted(strong + weak):
        place = (secrets if SORTS[kind] == "secret" else others).setdefault(scope(start), ([], []))
        place[0].append(start)
        place[1].append(max(end, place[1][-1]) if place[1] else end)

    def near(start: int, end: int, among: dict[int, tuple[list[int], list[int]]]) -> bool:
        begins, furthest = among.get(scope(start), ((), ()))
        at = bisect.bisect_right(begins, end + reach)
        return at > 0 and furthest[at - 1] >= start - reach

    def free(start: int, end: int) -> bool:
        at = bisect.bisect_left(starts, end)
        return at == 0 or ends[at - 1] <= start

    return [(a, b, kind) for a, b, kind in weak if free(a, b) and near(a, b, others if SORTS[kind] == "secret" else secrets)]


def scan_text(text: str | None, reach: int = 300, min_entropy: float = 3.5) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base findings and linked weak findings as (start, end, kind), each by start, then kind."""
    text = text or ""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    strong = sorted(base_spans(text), key=order)
    linked = link(text, strong, weak_parts(text, min_entropy), reach)
    return strong, sorted(linked, key=order)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", reach: int = 300, min_entropy: float = 3.5) -> DataFrame:
    """One row per row of ``docs``: (id, base, linked), both arrays of (kind, start, end)."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in portions(batches, "text"):
            found = [scan_text(t, reach, min_entropy) for t in batch.column(1).to_pylist()]
            columns = [pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in f[i]] for f in found], span) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id, "base", "linked"])

    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(F.col(id), F.col(text).cast("string").alias("text")).mapInArrow(run, f"`{id}` {docs.schema[id].dataType.simpleString()}, base {kind}, linked {kind}")


def digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts, the hash of the base spans and all spans as text, from what ``scan`` returns."""
    def of(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def rank(kind):
        return F.array_position(F.array(*map(F.lit, KINDS)), kind)

    both = F.array_sort(F.transform(F.concat("base", "linked"), lambda s: F.struct(s["start"].alias("a"), rank(s["kind"]).alias("r"), s["end"].alias("b"), s["kind"].alias("kind"))))
    every = F.transform(both, lambda s: F.struct(s["kind"].alias("kind"), s["a"].alias("start"), s["b"].alias("end")))
    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(id, *map(number, BASE_KINDS), F.sha2(of(F.col("base")), 256).alias("base_sha256"), of(every).alias("spans"))


def redact_text(text: str | None, reach: int, min_entropy: float, mark: str) -> str | None:
    if text is None:
        return None
    strong, linked = scan_text(text, reach, min_entropy)
    out, at = [], 0
    for start, end, _ in sorted(strong + linked):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if at else text


def redact(docs: DataFrame, text: str = "text", reach: int = 300, min_entropy: float = 3.5, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``; an integer ``n_chars`` follows the new text."""
    place = docs.columns.index(text)
    counted = docs.columns.index("n_chars") if dict(docs.dtypes).get("n_chars") in ("bigint", "int") else None

    def run(batches):
        for batch in portions(batches, text):
            was = batch.column(place).to_pylist()
            new = [redact_text(t, reach, min_entropy, mark) for t in was]
            batch = batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))
            if (at := counted) is not None:
                kept = [n if a == b else len(b) for n, a, b in zip(batch.column(at).to_pylist(), was, new, strict=True)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(kept, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(lean(run), docs.schema)


def sha256_of(spans: str) -> str:
    return hashlib.sha256(spans.encode()).hexdigest()
