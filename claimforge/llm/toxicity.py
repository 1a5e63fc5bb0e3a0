"""Toxicity by noisy-channel deobfuscation.

Writers hide words by leetspeak (``1d10t``), spacing (``s t u p i d``, ``s.t.u.p.i.d``) and repetition
(``stuuupid``). Vectorised masks find the words where any of these can have been at work: a symbol beside a
letter or another symbol, two or more equal letters, characters parted by separators or any white space. Each
becomes a lattice: a symbol may stand for letters, a separator between single characters may be noise, a run may
stand for one letter or two, and everything may also mean itself. Viterbi decoding over the last two characters
picks the path that is likeliest under the channel and a character trigram model of the corpus. Other words are
left alone: all they could hold is a symbol that stands alone. The restored text is then scored.

Model: character trigram counts over all documents (29 classes); document frequencies of tokens and
token beginnings, by 64-bit hash, in toxic and other documents of a bounded hash sample of the labelled rows; a logistic
regression on a document's strongest tokens. While that regression is fitted, a training document's own
occurrences don't count in its token weights, so its features are as they would be if it were held out.

Rows whose crc32(id as text) mod 3 is 1 teach nothing. Labels, lang, source and id are no inputs of a score.
A null id counts as an empty text there. Null and empty texts get the score of a text without tokens. Every
row gives one row, also repeated ones; extra columns are ignored by score(). With no labels of one kind the
score is the smoothed share of label 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, cut, id_text, label_sample
from .vectext import LOWER_TABLE, U, WHITE, Text, blocks, group_of, mix, sums, text_bytes

PREFIXES = (4, 5, 6)
#: What a symbol may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t"}
#: Separators that may stand between the characters of one word.
BETWEEN = " \t\n\v\f\r.-_*"
# Classes of the character model: 0 is white space, 1-26 are a-z, then bytes of other letters, and the rest.
FOREIGN, SIGN, CLASSES = 27, 28, 29
CLASS = np.full(256, SIGN, np.int64)
CLASS[WHITE] = 0
CLASS[97:123] = np.arange(1, 27)
CLASS[65:91] = np.arange(1, 27)
CLASS[128:] = FOREIGN
CLASS_LIST = CLASS.tolist()
LETTER = (CLASS > 0) & (CLASS < SIGN)
IS_LEET, IS_BETWEEN = np.zeros(256, bool), np.zeros(256, bool)
IS_LEET[[ord(c) for c in LEET]] = True
IS_BETWEEN[[ord(c) for c in BETWEEN]] = True
#: Log-probabilities of the channel: a symbol for a letter, a dropped separator, one that is kept between single characters, a run for one letter or two.
SUBSTITUTE, DROP, KEEP, SQUEEZE = -1.0, -0.1, -3.0, -0.7
#: Restored spans that a worker remembers, and pieces after which what all paths share is put out.
REMEMBERED, SETTLED = 100_000, 1024
#: Token weights below LEAST are no evidence; those above STRONG are counted.
LEAST, STRONG = 1.0, 2.0


def bordered(classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The classes with two of white space before, between and behind documents, so that no trigram holds parts of two."""
    filled = np.diff(offsets) > 0
    return np.append(np.insert(classes, np.repeat(offsets[:-1][filled], 2), 0), [0, 0]) if filled.any() else classes


def count_trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of character trigrams over all documents, the same however these are dealt out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for lo, hi in blocks(offsets):
                c = bordered(CLASS[data[offsets[lo] : offsets[hi]]].astype(np.int32), offsets[lo : hi + 1] - offsets[lo])
                if len(c) > 2:
                    total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    rows = arrow(docs.select(docs[text_col].cast("string").alias("text")), run, "gram long, n long").groupBy("gram").agg(F.sum("n")).toArrow()
    out = np.zeros(CLASSES**3, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out.reshape(CLASSES, CLASSES, CLASSES)


def log_model(counts: np.ndarray) -> list:
    """log P(third | first, second), interpolated with the bigram and unigram models."""
    one = counts.sum(axis=(0, 1)) + 0.5
    one = one / one.sum()
    two = counts.sum(axis=0) + 5 * one
    two = two / two.sum(axis=1, keepdims=True)
    three = counts + 5 * two[None, :, :]
    return np.log(three / three.sum(axis=2, keepdims=True)).tolist()


def choices_of(piece: bytes) -> list[tuple[bytes, float]]:
    """Alternatives (output, log-probability) of a piece: one character, a run of one letter or of white space."""
    c = piece[0]
    spaced = IS_BETWEEN[c]
    choices = [(piece, KEEP if spaced else 0.0)]
    if spaced:
        choices.append((b"", DROP))
    elif len(piece) >= 3:
        choices += [(piece[:1], SQUEEZE), (piece[:2], SQUEEZE)]
    elif len(piece) == 2:
        choices.append((piece[:1], SQUEEZE))
    elif IS_LEET[c]:
        choices += [(x.encode(), SUBSTITUTE) for x in LEET[chr(c)]]
    return choices


PIECE = re.compile(rb"[\x20\x09-\x0D]+|([A-Za-z])\1*+|.", re.S)


def lattice(span: bytes) -> Iterator[list[tuple[bytes, float]]]:
    """The alternatives of each piece of a span, one after the other."""
    alone: dict[bytes, list[tuple[bytes, float]]] = {}
    for m in PIECE.finditer(span):
        piece = m[0]
        if len(piece) > 2:
            yield choices_of(piece)
        else:
            if piece not in alone:
                alone[piece] = choices_of(piece)
            yield alone[piece]


def viterbi(pieces: Iterable[list[tuple[bytes, float]]], model: list) -> bytes:
    """The likeliest output between two word ends.

    Outputs are chains of back-pointers. What all paths share is put out every SETTLED pieces, so a long span takes
    time in proportion to its length, and memory for its output and the part on which paths differ.
    """
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    parts: list[bytes] = []
    for n, choices in enumerate(pieces, 1):
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, chain) in paths.items():
            for out, cost in choices:
                p, q, s = a, b, score + cost
                for c in out:
                    k = CLASS_LIST[c]
                    s += model[p][q][k]
                    p, q = q, k
                if (p, q) not in new or s > new[p, q][0]:
                    new[p, q] = (s, (chain, out))
        paths = new
        if n % SETTLED == 0:
            paths = settle(paths, parts)
    _, chain = max(((s + model[p][q][0], chain) for (p, q), (s, chain) in paths.items()), key=lambda x: x[0])
    return b"".join([*parts, *(out for _, out in unrolled(chain))])


def unrolled(chain: tuple | None) -> list[tuple]:
    """The nodes of a chain, first to last."""
    nodes = []
    while chain is not None:
        nodes.append(chain)
        chain = chain[0]
    return nodes[::-1]


def settle(paths: dict, parts: list[bytes]) -> dict:
    """The paths without what their chains share from the beginning, which goes to ``parts``."""
    chains = [unrolled(chain) for _, chain in paths.values()]
    shared, least = 0, min(map(len, chains))
    while shared < least and all(x[shared] is chains[0][shared] for x in chains):
        shared += 1
    parts += [out for _, out in chains[0][:shared]]
    again: dict[int, tuple] = {}
    out = {}
    for (state, (score, _)), nodes in zip(paths.items(), chains, strict=True):
        chain = None
        for node in nodes[shared:]:
            chain = again.setdefault(id(node), (chain, node[1]))
        out[state] = score, chain
    return out


def suspects(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the spans to decode: words with a sign of obfuscation, and runs of single characters."""
    starts, ends, bounds = text.words()
    if not len(starts):
        return starts, ends
    buf = text.buf
    letter, leet, between = LETTER[buf], IS_LEET[buf], IS_BETWEEN[buf]
    n = text.n + 4  # into the padding, so that no slice below is shorter than its offset
    sign = np.zeros(n + 1, bool)
    # byte i and the next stand in one document; two steps
    same = np.ones(n + 1, bool)
    same[text.offsets[1:] - 1] = False
    both = same[: n - 2] & same[1 : n - 1]
    # a symbol beside a letter or another symbol
    beside = letter | leet
    sign[:n] = leet[:n] & beside[1 : n + 1] & same[:n]
    sign[1:n] |= leet[1:n] & beside[: n - 1] & same[: n - 1]
    sign[: n - 1] |= letter[: n - 1] & (buf[: n - 1] == buf[1:n]) & (buf[: n - 1] < 128) & same[: n - 1]
    dotted = letter[: n - 2] & between[1 : n - 1] & letter[2:n] & both
    sign[: n - 4] |= dotted[:-2] & dotted[2:] & ~WHITE[buf[1 : n - 3]] & ~WHITE[buf[3 : n - 1]]
    seen = np.concatenate([[0], np.cumsum(sign)])
    odd = seen[ends] > seen[starts]
    # three or more words of one character in a row, whatever white space parts them
    single = (ends - starts == 1) & (letter[starts] | leet[starts])
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1]
    joined[bounds[:-1][bounds[:-1] < len(starts)]] = False
    first = single & ~joined
    at = np.flatnonzero(first)
    size = np.diff(np.append(np.flatnonzero(~joined), len(starts)))[np.searchsorted(np.flatnonzero(~joined), at)]
    long = at[size >= 3]
    size = size[size >= 3]
    odd[single] = False
    own = np.flatnonzero(odd)
    s = np.concatenate([starts[own], starts[long]])
    e = np.concatenate([ends[own], ends[long + size - 1]])
    order = np.argsort(s, kind="stable")
    return s[order], e[order]


def restore(text: Text, model: list, memo: dict[bytes, bytes] | None = None) -> Text:
    """The block with its suspect spans decoded. ``memo`` keeps short ones for the next block of the same model."""
    memo = {} if memo is None else memo
    starts, ends = suspects(text)
    if not len(starts):
        return text
    raw, parts, at = text.buf[: text.n].tobytes(), [], 0
    shift = np.zeros(len(starts), np.int64)
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        span = raw[a:b]
        new = memo.get(span)
        if new is None:
            new = viterbi(lattice(span), model)
            if len(span) <= 32:
                if len(memo) >= REMEMBERED:
                    memo.clear()
                memo[span] = new
        parts += [raw[at:a], new]
        at, shift[k] = b, len(new) - len(span)
    parts.append(raw[at:])
    total = np.concatenate([[0], np.cumsum(shift)])
    offsets = text.offsets + total[np.searchsorted(ends, text.offsets, "right")]
    return Text(np.frombuffer(b"".join(parts), np.uint8), offsets)


def features(text: Text) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of each token and of its beginnings (0: too short), and the bounds of documents over tokens."""
    starts, ends, bounds = text.runs(LETTER[text.buf[: text.n]])
    out = [text.hashes(starts, ends) | U(1)]
    lane = text.lanes[starts] if len(starts) else np.zeros(0, U)
    for k in PREFIXES:
        p = mix((lane & U((1 << 8 * k) - 1)) + U(k << 56)) | U(1)
        p[ends - starts <= k] = 0
        out.append(p)
    return out, bounds


class Weights:
    """Weights of hashed features; a filter of hash bits spares most look-ups."""

    BITS = 22

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[keys >> U(64 - self.BITS)] = True

    def most(self, hashes: list[np.ndarray], values: np.ndarray | None = None) -> np.ndarray:
        """The largest weight among the features of each token, 0 at least. ``values`` may stand in for the own ones, by position."""
        values, out = self.values if values is None else values, np.zeros(len(hashes[0]))
        for h in hashes:
            at = np.flatnonzero(self.seen[h >> U(64 - self.BITS)])
            if len(at) and len(self.keys):
                k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
                out[at] = np.maximum(out[at], np.where(self.keys[k] == h[at], values[k], 0))
        return out


def evidence(weight: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """By document: its two largest token weights, log(1 + strong tokens), log(1 + tokens)."""
    n = len(bounds) - 1
    doc, at = group_of(bounds), np.flatnonzero(weight > 0)
    out = np.zeros((n, 4))
    out[:, 3] = np.log1p(np.diff(bounds))
    if len(at):
        d, w = doc[at], weight[at]
        order = np.lexsort((-w, d))
        d, w = d[order], w[order]
        first = np.concatenate([[True], d[1:] != d[:-1]])
        out[d[first], 0] = w[first]
        second = np.flatnonzero(first)[:-1] + 1 if first.sum() > 1 else np.zeros(0, np.int64)
        second = np.append(second, np.flatnonzero(first)[-1] + 1)
        ok = second < len(d)
        second, owner = second[ok], d[first][ok]
        same = d[second] == owner
        out[owner[same], 1] = w[second[same]]
        out[:, 2] = np.log1p(np.bincount(d[w > STRONG], minlength=n))
    return out


def log_odds(a: np.ndarray, b: np.ndarray, toxic: float, other: float) -> np.ndarray:
    """Evidence of a feature in ``a`` toxic and ``b`` other documents; none where it is in less than two toxic ones."""
    g = np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (other + 1))
    # few documents say little: a count of 2 keeps half of its weight, a count of 8 four fifths
    g = g * a / (a + 2.0)
    return np.where((a >= 2) & (g >= LEAST), g, 0)


@dataclass
class Model:
    trigrams: list
    weights: Weights
    coefficients: np.ndarray
    memo: dict[bytes, bytes] = field(default_factory=dict)

    def scores(self, text: Text) -> np.ndarray:
        hashes, bounds = features(restore(text, self.trigrams, self.memo))
        return sigmoid(standard(evidence(self.weights.most(hashes), bounds)) @ self.coefficients)


def standard(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last column is the constant and carries no penalty."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (p - y) + penalty * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        d = np.linalg.solve(h, g)
        w = w - d * min(1.0, 4 / max(1e-9, np.abs(d).max()))
        if np.abs(d).max() < 1e-8:
            break
    return w


def rising(x: np.ndarray, y: np.ndarray, evident: int = 3) -> np.ndarray:
    """logistic() without falling coefficients of the first ``evident`` columns: more evidence never lowers a score."""
    used = list(range(x.shape[1]))
    while True:
        w = logistic(x[:, used], y)
        falling = [(v, k) for v, k in zip(w, used, strict=True) if k < evident and v < 0]
        if not falling:
            out = np.zeros(x.shape[1])
            out[used] = w
            return out
        used.remove(min(falling)[1])


def taught() -> Column:
    """True for ids whose labels may be used."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3)) != 1


def fit(docs: DataFrame, labels: DataFrame, label_bound: int = 20_000) -> Model:
    """``label_bound`` bounds the labelled documents that train the classifier; the character model sees all documents."""
    trigrams = log_model(count_trigrams(docs))
    sample = label_sample(labels, "toxic", label_bound, taught())
    rows = cut(id_text(docs).join(F.broadcast(sample), "doc_id").select("text", "label"))
    totals = {int(r[0]): r[1] for r in rows.groupBy("label").count().collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not other:
        share = (toxic + 0.5) / (toxic + other + 1)
        return Model(trigrams, Weights(np.zeros(0, U), np.zeros(0)), np.array([0, 0, 0, 0, np.log(share / (1 - share))]))

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        memo: dict[bytes, bytes] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            y = batch.column(1).to_numpy()
            for lo, hi in blocks(offsets):
                text = restore(Text(np.frombuffer(data[offsets[lo] : offsets[hi]].tobytes().translate(LOWER_TABLE), np.uint8), offsets[lo : hi + 1] - offsets[lo]), trigrams, memo)
                yield *features(text), y[lo:hi]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, bounds, y in blocks_of(batches):
            doc = np.tile(group_of(bounds), len(hashes))
            every = np.concatenate(hashes)
            doc, every = doc[every > 0], every[every > 0]
            _, first = np.unique(mix(every ^ mix(doc.astype(U) + U(1))), return_index=True)
            keys, of = np.unique(every[first], return_inverse=True)
            a = np.bincount(of, y[doc[first]] == 1, len(keys)).astype(np.int64)
            b = np.bincount(of, minlength=len(keys)) - a
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(a), pa.array(b)], ["feature", "a", "b"])

    odds = F.log((F.col("a") + 0.5) / F.lit(toxic + 1)) - F.log((F.col("b") + 0.5) / F.lit(other + 1))
    seen = arrow(rows, count, "feature long, a long, b long").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter(F.col("a") >= 2).filter(odds >= LEAST).toArrow()
    keys, a, b = (seen.column(i).to_numpy() for i in range(3))
    order = np.argsort(keys.view(U))
    keys, a, b = keys.view(U)[order], a[order], b[order]
    weights = Weights(keys, log_odds(a, b, toxic, other))
    less_a, less_b = log_odds(a - 1, b, toxic - 1, other), log_odds(a, np.maximum(b - 1, 0), toxic, other - 1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, bounds, y in blocks_of(batches):
            own = np.repeat(y == 1, np.diff(bounds))
            x = evidence(np.where(own, weights.most(hashes, less_a), weights.most(hashes, less_b)), bounds)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*x.T, y.astype(float))], ["x0", "x1", "x2", "x3", "y"])

    table = arrow(rows, measure, "x0 double, x1 double, x2 double, x3 double, y double").toArrow()
    x = np.stack([table.column(i).to_numpy() for i in range(5)], axis=1)
    # the order in which rows arrive must not show in the last digits
    x = x[np.lexsort(x.T)]
    return Model(trigrams, weights, rising(standard(x[:, :4]), x[:, 4]))


def scored_blocks(model: Model, column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    return np.concatenate([np.zeros(0), *(model.scores(Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower=True)) for lo, hi in blocks(offsets))])


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, label_bound: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = id_text(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, label_bound))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = scored_blocks(model.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return arrow(rows, run, "doc_id long, score double, predicted int").select("doc_id", (~taught()).alias("held_out"), "score", "predicted")


def harmless(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, label_bound: int = 20_000, text_col: str = "text") -> DataFrame:
    """The documents, all their columns, that score below the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label_bound))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scored_blocks(model.value, batch.column(at)) < threshold))

    return arrow(docs, run, docs.schema)
