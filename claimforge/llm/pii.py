"""Personal data by weak supervision.

Four base kinds (email, ip, card, phone) are found by their exact rules and always stay. Wider patterns
propose further spans: keys and passwords, phones without a country code, social security numbers, spelled-out
addresses. Labelers of three kinds vote on every proposed span, base or not: regex (strict forms), gazetteer
(known key prefixes, domains, cue words) and context (what stands before and around). Expectation-maximisation
over all votes of the corpus estimates each labeler's reliability and the probability that a span is personal
data; with these soft labels a logistic regression on the span's form and context is trained, the final
classifier. A proposed span is added where it says 0.5 or more and no base span overlaps it.

EM and training see counts by vote and feature pattern, gathered over all documents: their number is bounded
by the patterns, not by the corpus. Offsets count code points, ends are exclusive. Null and empty texts have no
spans. Every row gives one row, also repeated ones; extra columns are ignored by find(). Without any proposed
span the classifier adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, id_text
from .vectext import sums, text_bytes

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "key", "ssn")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The base rules. A run of digits is never entered in its middle: the digits before would match as well.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Wider patterns.
KEY = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+")
LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]+)+")

#: Gazetteers.
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xoxb-", "xoxp-", "AIza", "glpat-", "eyJ")
TOP_DOMAINS = frozenset("com org net edu gov de fr es it uk eu io info biz co".split())
CUES = frozenset("password passwd pwd token secret key apikey api auth bearer credential phone tel telephone mobile call fax mail email contact ssn social card visa ip address addr host".split())
AGAINST = frozenset("version ver v isbn issn page pages figure fig section sec chapter commit sha checksum md5 hash build release order invoice".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(s: str) -> list[tuple[int, int]]:
    """Each @ with the longest local part before it and a domain after it; found around the @, so in linear time."""
    out, end, at = [], 0, s.find("@")
    while at >= 0:
        start = at
        while start > end and s[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(s, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = s.find("@", max(at + 1, end))
    return out


def base_spans(s: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [(0, a, b) for a, b in emails(s)]
    out += [(1, *m.span()) for m in IP.finditer(s) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(s):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in s:
        out += [(3, *m.span()) for m in PHONE.finditer(s) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def proposed(s: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the wider patterns that no base span and no earlier one overlaps."""
    found = [(4, *m.span()) for m in KEY.finditer(s) if any("0" <= c <= "9" for c in m[0]) and any(c.isalpha() for c in m[0])]
    found += [(5, *m.span()) for m in SSN.finditer(s)]
    found += [(3, *m.span()) for m in LOCAL_PHONE.finditer(s)]
    found += [(0, *m.span()) for m in SPELLED.finditer(s)] if "at]" in s or "at)" in s or "at ]" in s or "at )" in s else []
    starts, ends, out = [], [], []
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a < ends[-1]:
            ends[-1] = max(b, ends[-1])
        else:
            starts.append(a), ends.append(b)
    for kind, a, b in sorted(found, key=lambda x: (x[1], -x[2])):
        k = bisect_left(starts, b)
        if (not k or ends[k - 1] <= a) and (not out or out[-1][2] <= a):
            out.append((kind, a, b))
    return out


WORD = re.compile(r"[A-Za-z]+")


def examine(s: str, kind: int, a: int, b: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Votes (1 personal data, -1 not, 0 none) and the classifier's features of a span."""
    span, before, after = s[a:b], s[max(0, a - 32) : a], s[b : b + 2]
    words = {w.lower() for w in WORD.findall(before)}
    last = (WORD.findall(before) or [""])[-1].lower()
    digits = sum("0" <= c <= "9" for c in span)
    upper, lower = any("A" <= c <= "Z" for c in span), any("a" <= c <= "z" for c in span)
    hexadecimal = all(c in "0123456789abcdefABCDEF" for c in span)
    mixed = sum(("0" <= x <= "9") != ("0" <= y <= "9") for x, y in zip(span, span[1:], strict=False))
    strict = {
        0: bool(re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", span)) or "@" not in span,
        1: not span.startswith(("0.", "127.", "255.")),
        2: span[0] in "3456",
        3: digits in (10, 11, 12),
        4: mixed >= 4 or bool(re.fullmatch(r"AKIA[0-9A-Z]{16}", span)),
        5: span[:3] not in ("000", "666") and span[0] != "9",
    }[kind]
    known = span.startswith(KEY_PREFIXES) if kind == 4 else kind == 0 and span.rpartition(".")[2].lower() in TOP_DOMAINS
    tail = before.rstrip(" \"'")
    assigned = tail.endswith(("=", ":"))
    bare = (not before or not before[-1].isalnum()) and (not after or not after[0].isalnum())
    votes = (
        1 if strict else -1,
        1 if known else 0,
        1 if last in CUES else 0,
        -1 if words & AGAINST else 0,
        1 if assigned else 0,
        0 if bare else -1,
        (1 if digits * 5 >= len(span) else -1) if kind == 4 else 0,
    )
    return votes, (int(strict), int(known), int(bool(words & CUES)), int(bool(words & AGAINST)), int(assigned), int(bare), int(digits * 5 >= len(span)), int(upper and not lower), int(hexadecimal), int(len(span) > 24), int(mixed >= 6))


def wanted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents that can hold a span at all: each kind needs a digit, an @, or "at" in brackets."""
    digits = sums((data >= 48) & (data <= 57), offsets)
    marks = sums(np.isin(data, np.frombuffer(b"@[(", np.uint8)), offsets)
    return np.flatnonzero((digits >= 1) | (marks > 0))


def texts_of(column: pa.Array) -> Iterator[tuple[int, str]]:
    """Positions and texts of the documents that can hold a span."""
    data, offsets = text_bytes(column)
    for d in wanted(data, offsets).tolist():
        yield d, data[offsets[d] : offsets[d + 1]].tobytes().decode()


@dataclass
class Model:
    """Reliabilities by labeler (rows: not personal, personal; columns: votes -1, 0, 1), the prior, and the classifier."""

    reliability: np.ndarray
    prior: float
    coefficients: np.ndarray

    def accepts(self, kind: int, features: tuple[int, ...]) -> bool:
        return bool(row(kind, features) @ self.coefficients >= 0)


def row(kind: int, features: tuple[int, ...]) -> np.ndarray:
    return np.array([*(float(kind == k) for k in range(len(KINDS))), *features, 1.0])


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of each vote pattern, labelers' reliabilities and prior; it begins from the majority of votes."""
    n, m = votes.shape
    p = np.clip(0.5 + 0.2 * votes.sum(axis=1), 0.1, 0.9)
    table, prior = np.zeros((m, 2, 3)), 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        prior = float((weight[1].sum() + 1) / (counts.sum() + 2))
        for j in range(m):
            for v in (-1, 0, 1):
                # a labeler is thought better than chance, before any vote
                lean = 1.0 + (v == -1), 1.0 + (v == 1)
                table[j, :, v + 1] = weight[:, votes[:, j] == v].sum(axis=1) + lean
        table /= table.sum(axis=2, keepdims=True)
        logs = sum(np.log(table[j][:, votes[:, j] + 1]) for j in range(m))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + np.log((1 - prior) / prior), -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p, table, prior


def train(x: np.ndarray, y: np.ndarray, counts: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Logistic regression on soft labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (counts * (p - y)) + ridge * w
        h = (x * (counts * (p * (1 - p) + 1e-9))[:, None]).T @ x + ridge * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w = w - d * min(1.0, 4 / max(1e-9, np.abs(d).max()))
        if np.abs(d).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Votes over all documents; only counts by pattern reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for _, s in texts_of(batch.column(0)):
                base = base_spans(s)
                for kind, a, b in [*base, *proposed(s, base)]:
                    votes, features = examine(s, kind, a, b)
                    seen[kind, votes, features] += 1
        keys = sorted(seen)
        arrays = [pa.array([k[0] for k in keys], pa.int32()), pa.array([list(k[1]) for k in keys], pa.list_(pa.int32())), pa.array([list(k[2]) for k in keys], pa.list_(pa.int32())), pa.array([seen[k] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["kind", "votes", "features", "n"])

    rows = arrow(docs.select(docs[text_col].cast("string").alias("text")), run, "kind int, votes array<int>, features array<int>, n long").groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).collect()
    rows = sorted((r.kind, tuple(r.votes), tuple(r.features), r.n) for r in rows)
    if not rows:
        return Model(np.zeros((0, 2, 3)), 0.5, np.array([0.0] * (len(KINDS) + 11) + [-1.0]))
    votes, counts = np.array([r[1] for r in rows]), np.array([r[3] for r in rows], float)
    p, table, prior = expectation_maximisation(votes, counts)
    return Model(table, prior, train(np.array([row(r[0], r[2]) for r in rows]), p, counts))


def spans(s: str, model: Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans, by kind as listed and then start."""
    base = base_spans(s)
    more = [(k, a, b) for k, a, b in proposed(s, base) if model.accepts(k, examine(s, k, a, b)[1])]
    return base, sorted([*base, *more])


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base and all spans as arrays of (kind, start, end)."""
    rows = id_text(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    named = lambda found: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [[]] * batch.num_rows, [[]] * batch.num_rows
            for d, s in texts_of(batch.column(1)):
                base[d], every[d] = map(named, spans(s, model.value))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, kind), pa.array(every, kind)], ["doc_id", "base", "spans"])

    item = "array<struct<kind:string,start:int,end:int>>"
    return arrow(rows, run, f"doc_id long, base {item}, spans {item}")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the SHA-256 of the base spans and all spans as text."""
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x.kind == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, BASE), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def masked(s: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in found):
        if a >= at:
            out += [s[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + s[at:]


def redact(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The documents, all their columns, with spans masked and ``size_col`` (if there) counting code points anew."""
    model, at = docs.sparkSession.sparkContext.broadcast(fit(docs, text_col)), docs.columns.index(text_col)
    size = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            changed = {}
            for d, s in texts_of(batch.column(at)):
                found = spans(s, model.value)[1]
                if found:
                    changed[d] = masked(s, found)
            if changed:
                columns, mask = list(batch.columns), np.zeros(batch.num_rows, bool)
                mask[list(changed)] = True
                columns[at] = pc.replace_with_mask(columns[at], pa.array(mask), pa.array(list(changed.values()), columns[at].type))
                if size is not None:
                    columns[size] = pc.replace_with_mask(columns[size], pa.array(mask), pa.array([len(s) for s in changed.values()], columns[size].type))
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return arrow(docs, run, docs.schema)
