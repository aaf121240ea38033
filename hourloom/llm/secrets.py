"""Secrets in texts, and weak parts of a credential that count only beside their complements."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import slices
from hourloom.session import durable

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}=*")
_HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORD = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
_IDENTIFIER = re.compile(r"""(?<![A-Za-z0-9_])(client_?id|user_?name|account_?id|access_?key_?id|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""", re.I | re.A)
_IDENTIFIER_HINT = re.compile(r"client|user_?name|account|access|login", re.I | re.A)
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
_ADDRESS = re.compile(r"[^\s\"'<>]{4,}", re.A)
_BREAK = re.compile(r"\n[ \t\r]*\n")

#: Order of kinds that start at one place.
KINDS = ("assign", "access", "hex", "linked_identifier", "linked_secret", "linked_endpoint")
#: Code points between the end of one part of a credential and the start of the next one, at most.
REACH = 400


def _long_runs(text: str) -> list[re.Match]:
    return list(_RUN.finditer(text))


def base_spans(text: str, runs: list[re.Match] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, leftmost and without overlap within a kind, in order.

    A hexadecimal run that is long enough lies within a long run of the wider alphabet; ``runs`` are those of the text.
    """
    found = []
    if _KEYWORD.search(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    for run in _long_runs(text) if runs is None else runs:
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text, run.start(), run.end())]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _endpoints(text: str) -> Iterator[tuple[int, int]]:
    """Scheme, ``://`` and at least four characters of an address, leftmost and without overlap.

    Each ``://`` is found first and its scheme walked back, from the first small letter of the run before it: every character is
    passed once, however long the run.
    """
    free = 0
    at = text.find("://")
    while at >= 0:
        low = at
        while low > free and text[low - 1] in _SCHEME:
            low -= 1
        while low < at and not "a" <= text[low] <= "z":
            low += 1
        address = _ADDRESS.match(text, at + 3) if low < at else None
        if address:
            free = address.end()
            yield low, free
        at = text.find("://", free if address else at + 1)


def _weak_parts(text: str, runs: list[re.Match]) -> list[tuple[int, int, str]]:
    found = []
    if _IDENTIFIER_HINT.search(text):
        found += [(m.start(), m.end(), "identifier") for m in _IDENTIFIER.finditer(text)]
    for m in runs:
        run = m[0]
        if len(run) >= 32 and re.search("[A-Z]", run) and re.search("[a-z]", run) and re.search("[0-9]", run) and "//" not in run:
            found.append((m.start(), m.end(), "secret"))
    found += [(start, end, "endpoint") for start, end in _endpoints(text)]
    return found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    part = pa.struct([("scope", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("role", pa.string()), ("weak", pa.bool_())])
    role = {"assign": "secret", "access": "identifier", "hex": "secret"}
    for batch in slices(batches, "text", 8_000_000):
        spans, parts = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            runs = _long_runs(text)
            base = base_spans(text, runs)
            weak = _weak_parts(text, runs)
            spans.append([{"start": s, "end": e, "kind": k} for s, e, k in base])
            both = []
            if weak:  # nothing to decide without a weak part
                breaks = [m.end() for m in _BREAK.finditer(text)]
                taken = [(s, e) for s, e, _ in base]
                weak = _outside(weak, taken)
                if weak:
                    rows = [(s, e, role[k], False) for s, e, k in base] + [(s, e, k, True) for s, e, k in weak]
                    both = [{"scope": bisect.bisect_right(breaks, s), "start": s, "end": e, "role": k, "weak": w} for s, e, k, w in rows]
            parts.append(both)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(span)), pa.array(parts, pa.list_(part))], ["doc_id", "base", "parts"])


def _outside(weak: list, taken: list) -> list:
    """The weak parts that overlap no base span, by one sorted walk."""
    merged: list[list[int]] = []
    for s, e in sorted(taken):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    ends = [e for _, e in merged]
    out = []
    for w in weak:
        i = bisect.bisect_right(ends, w[0])
        if i == len(merged) or merged[i][0] >= w[1]:
            out.append(w)
    return out


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``base`` and ``linked``, arrays of (start, end, kind) in order.

    Base spans are assignments, access ids and long hexadecimal runs. Weak parts (a login name, a mixed random string, an
    address) say little alone. Within a scope, a stretch of text between blank lines, an interval join by window frames asks
    what lies within ``reach`` code points before or after, from the end of one part to the start of the other: a weak secret is
    linked if an identifier is near, a weak identifier if a secret is, an address if both are. Running frames hold, by role, the
    furthest end so far and the next start to come, so many parts in one document do not turn into pairs. The texts are scanned once, into a table of spans that is written before the join. Null and empty texts
    have no spans; repeated rows and null ids each get their own row.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span = "array<struct<start:int,end:int,kind:string>>"
    schema = f"doc_id {id_type}, base {span}, parts array<struct<scope:int,start:int,end:int,role:string,weak:boolean>>"
    found = docs.select("doc_id", "text").mapInArrow(_scan, schema).withColumn("row", F.monotonically_increasing_id())
    found = durable(found)
    parts = found.where("size(parts) > 0").select("row", F.inline("parts"))
    order = ("start", "end", "role")
    scope = Window.partitionBy("row", "scope").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before, after = scope.orderBy(*order), scope.orderBy(*(F.desc(c) for c in order))
    own = lambda role, column: F.when(F.col("role") == role, F.col(column))
    near = {
        role: F.coalesce(F.max(own(role, "end")).over(before) + reach >= F.col("start"), F.lit(False))
        | F.coalesce(F.min(own(role, "start")).over(after) - reach <= F.col("end"), F.lit(False))
        for role in ("identifier", "secret")
    }
    linked = (
        parts.withColumns({"by_identifier": near["identifier"], "by_secret": near["secret"]})
        .where("weak AND CASE role WHEN 'secret' THEN by_identifier WHEN 'identifier' THEN by_secret ELSE by_identifier AND by_secret END")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", F.concat(F.lit("linked_"), "role").alias("kind")))).alias("linked"))
    )
    return found.drop("parts").join(linked, "row", "left").select("doc_id", "base", F.coalesce("linked", F.expr(f"cast(array() AS {span})")).alias("linked"))


def span_text(spans: str) -> F.Column:
    """kind:start:end, comma-joined, by start and then kind as listed."""
    rank = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS))
    keyed = f"array_sort(transform({spans}, s -> struct(s.start AS start, CASE s.kind {rank} END AS rank, s.end AS end, s.kind AS kind)))"
    return F.expr(f"array_join(transform({keyed}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")


def brute_base(text: str | None) -> tuple[int, int, int, str]:
    """Counts by kind and digest of the base spans, written down as plainly as possible for the tests."""
    spans = []
    for i, (kind, pattern, least) in enumerate((("assign", ASSIGN, 6), ("access", ACCESS, 20), ("hex", re.compile("[0-9a-f]+"), 24))):
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                spans.append((m.start(), i, f"{kind}:{m.start()}:{m.end()}"))
    kinds = [s[1] for s in spans]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(",".join(s[2] for s in sorted(spans)).encode()).hexdigest()
