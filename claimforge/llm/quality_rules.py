"""Quality rules by compression bands.

zstandard compresses each whole document and its fixed chunks, which cover all of it. Text that compresses far
better than prose of its length repeats itself; text that barely compresses is noise. The band of allowed ratios
depends on the length, since short inputs carry less context. fit() takes the bands from what good documents of
each length show, from all labelled rows; where it has too few of a length, and without labels, the
general bands below hold. Word and line rules come before the bands.

Null and empty texts have zero counts and fail the word minimum. Every row of the input gives one row, also
repeated ones; extra columns are ignored. No shuffle: one map over the scan.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, id_text, label_rows
from .vectext import WHITE, Text, U, blocks, group_of, mix, same, sums, text_bytes, within

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Bands:
    """``document`` and ``chunk``: (up to this many bytes, lowest ratio, highest ratio), by length.

    A ratio is compressed over raw bytes. A document is rejected when more than ``chunk_share`` of its chunks are
    out of band, or ``chunk_run`` in a row, or more than ``chunk_most`` in all. So one table or quotation does not
    reject a long document, and no length excuses more. ``tail_bytes``: a last partial chunk of this length is
    long enough for the document limits of its own length.
    """

    document: tuple[tuple[float, float, float], ...] = (
        (64, 0.0, 1.6), (256, 0.45, 1.05), (1024, 0.40, 0.88), (4096, 0.41, 0.76), (16384, 0.38, 0.70), (65536, 0.36, 0.66), (float("inf"), 0.33, 0.64),
    )
    chunk: tuple[tuple[float, float, float], ...] = ((4096, 0.36, 0.74),)
    chunk_bytes: int = 4096
    chunk_share: float = 0.25
    chunk_run: int = 3
    chunk_most: int = 4
    tail_bytes: int = 1024
    level: int = 3


#: Labels are learnt from rows whose crc32(id as text) mod 3 is not 1; the others are left to measure errors.
TAUGHT = "pmod(crc32(cast(doc_id as string)), 3) <> 1"


def fit(docs: DataFrame, labels: DataFrame, bands: Bands = Bands(), least: int = 40, tail: float = 0.002, margin: float = 0.005) -> Bands:
    """``bands`` with limits by octave of length, and for chunks, that leave ``tail`` of the good ratios on each side, and a margin.

    All labelled documents count. An octave with fewer than ``least`` good documents keeps the limits that ``bands``
    has for its longest. Every document whose label may teach is measured where it lies, and only its few ratios meet
    the labels, so neither texts are shuffled nor a table of labels is broadcast that grows with the corpus; only
    counts by octave and thousandth of a ratio reach the driver. Documents that fail the base rules, nulls and
    repeated labels (the smallest counts) teach nothing.
    """
    good = label_rows(labels, "quality", F.expr(TAUGHT)).filter("label = 1").select("doc_id")
    rows = id_text(docs).filter(F.expr(TAUGHT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            for lo, hi in blocks(offsets):
                text = Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                view, failed = memoryview(text.buf), fails(measure(text))
                thousandths = lambda a, b: round(1000 * len(zip_.compress(view[a:b])) / (b - a))  # noqa: B023, E731
                seen: Counter = Counter()
                for d in np.flatnonzero(~failed).tolist():
                    a, b = int(text.offsets[d]), int(text.offsets[d + 1])
                    seen[ids[lo + d], (b - a).bit_length(), thousandths(a, b)] += 1
                    for k in range(a, b - bands.chunk_bytes + 1, bands.chunk_bytes):
                        seen[ids[lo + d], 0, thousandths(k, k + bands.chunk_bytes)] += 1
                yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in seen], t) for j, t in enumerate((pa.int64(), pa.int32(), pa.int32()))] + [pa.array(list(seen.values()), pa.int64())], ["doc_id", "octave", "ratio", "n"])

    counts: dict[int, list[tuple[int, int]]] = {}
    for octave, ratio, n in arrow(rows, run, "doc_id long, octave int, ratio int, n long").join(good.hint("merge"), "doc_id").groupBy("octave", "ratio").agg(F.sum("n")).orderBy("octave", "ratio").collect():
        counts.setdefault(octave, []).append((ratio, n))

    def limits_of(octave: int) -> tuple[float, float] | None:
        ratios, n = (np.array(x) for x in zip(*counts.get(octave, [(0, 0)]), strict=True))
        if n.sum() < least:
            return None
        up = np.cumsum(n)
        low, high = ratios[np.searchsorted(up, tail * up[-1], "right")], ratios[np.searchsorted(up, (1 - tail) * up[-1], "left")]
        return float(low / 1000 - margin), float(high / 1000 + margin)

    document = tuple((float((1 << o) - 1), *(limits_of(o) or limits(bands.document, (1 << o) - 1))) for o in range(1, 41))
    own = limits_of(0)
    return replace(bands, document=(*document, bands.document[-1]), chunk=((bands.chunk_bytes, *own),) if own else bands.chunk)


def limits(bands: tuple[tuple[float, float, float], ...], n: int) -> tuple[float, float]:
    return next(((lo, hi) for top, lo, hi in bands if n <= top), bands[-1][1:])


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, zstd_ratio double, n_chunks long, n_low_chunks long, n_high_chunks long"


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items whose key occurs more than once, and the first item with the key of each."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    begins = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    size = np.diff(np.append(np.flatnonzero(begins), len(s)))
    many = np.repeat(size > 1, size)
    return order[many], np.repeat(order[begins], size)[many]


def plainly(text: bytes) -> tuple[int, int]:
    """n_dup_lines and n_repeat_words of one text, without hashes of our own."""
    words, lines = text.split(), [x for x in text.split(b"\n") if x.split()]
    seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = np.zeros(len(words) + 1, np.int64)
    for k in range(len(words) - 7):
        if seen[tuple(words[k : k + 8])] > 1:
            covered[k] += 1
            covered[min(k + 8, len(words))] -= 1
    return len(lines) - len(set(lines)), int((np.cumsum(covered)[:-1] > 0).sum())


def measure(text: Text) -> dict[str, np.ndarray]:
    """The word and line counts of each document of a block.

    Hashes say which windows and lines can be equal; their bytes decide. A document in which two different ones
    share a hash is counted plainly().
    """
    starts, ends, bounds = text.words()
    buf, n = text.buf[: text.n], text.n
    inside = ((buf & 0xC0) != 0x80) & ~WHITE[buf]
    h = text.hashes(starts, ends)
    # windows of eight words
    at, window_bounds = within(bounds, 8)
    w = np.zeros(len(at), U)
    for j in range(8):
        w = mix(w + h[at + j])
    doc = group_of(window_bounds)
    again, like = groups(mix(w ^ mix(doc.astype(U) + U(1))))
    equal = doc[again] == doc[like]
    for j in range(8):
        a, b = at[again] + j, at[like] + j
        size = ends[a] - starts[a]
        equal &= size == ends[b] - starts[b]
        equal[equal] = same(text.lanes, starts[a[equal]], text.lanes, starts[b[equal]], size[equal])
    odd = set(doc[again[~equal]].tolist()) | set(doc[like[~equal]].tolist())
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + 8, -1)
    repeated = np.cumsum(cover)[:-1] > 0
    # lines that hold a word
    lf, le, lb = text.runs(buf != 10)
    words_before = np.concatenate([[0], np.cumsum(np.bincount(starts, minlength=n + 1)[: n + 1])]) if n else np.zeros(2, np.int64)
    # a word that begins inside the line: every word of a line begins in it, as lines break at white space
    has = words_before[le] > words_before[lf]
    owner, lf, le = group_of(lb)[has], lf[has], le[has]
    line = mix(text.hashes(lf, le) ^ mix(owner.astype(U) + U(7)))
    again, like = groups(line)
    size = le[again] - lf[again]
    equal = (owner[again] == owner[like]) & (size == le[like] - lf[like])
    equal[equal] = same(text.lanes, lf[again[equal]], text.lanes, lf[like[equal]], size[equal])
    odd |= set(owner[again[~equal]].tolist()) | set(owner[like[~equal]].tolist())
    n_dup = np.bincount(owner[again], minlength=text.docs) - np.bincount(owner[np.unique(like)], minlength=text.docs)
    n_repeat = sums(repeated, bounds)
    for d in odd:
        n_dup[d], n_repeat[d] = plainly(buf[text.offsets[d] : text.offsets[d + 1]].tobytes())
    return {
        "n_words": np.diff(bounds),
        "word_chars": sums(inside, text.offsets),
        "n_symbols": sums(SYMBOLS[buf], text.offsets),
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
    }


def fails(base: dict[str, np.ndarray], min_words: int = 20, max_repeat_percent: int = 30) -> np.ndarray:
    """The base rules."""
    return (base["n_words"] < min_words) | (100 * base["n_repeat_words"] > max_repeat_percent * base["n_words"])


def compress(text: Text, bands: Bands) -> dict[str, np.ndarray]:
    """Ratios of whole documents, counts of chunks out of band, and the verdict of the bands.

    The chunks cover all bytes. A document of at most one chunk is its own chunk. A last partial chunk is judged
    as the full window that ends with the text and, from ``tail_bytes`` on, by itself; one of the two is enough.
    """
    zip_ = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)
    ratio, chunks, low, high, kept = (np.zeros(text.docs, t) for t in (float, np.int64, np.int64, np.int64, bool))
    view, size = memoryview(text.buf), bands.chunk_bytes

    def measured(a: int, b: int) -> float:
        return len(zip_.compress(view[a:b])) / (b - a)

    def side(r: float, lo: float, hi: float) -> int:
        return int(r > hi) - int(r < lo)

    for d in range(text.docs):
        a, b = int(text.offsets[d]), int(text.offsets[d + 1])
        if a == b:
            continue
        ratio[d] = measured(a, b)
        whole = side(ratio[d], *limits(bands.document, b - a))
        if b - a < size:
            sides = [whole]
        else:
            own = limits(bands.chunk, size)
            sides = [side(measured(k, k + size), *own) for k in range(a, b - size + 1, size)]
            rest = (b - a) % size
            if rest:
                last = side(measured(b - size, b), *own)
                if not last and rest >= bands.tail_bytes:
                    last = side(measured(b - rest, b), *limits(bands.document, rest))
                sides.append(last)
        chunks[d], low[d], high[d] = len(sides), sides.count(-1), sides.count(1)
        run = longest = 0
        for x in sides:
            run = run + 1 if x else 0
            longest = max(longest, run)
        bad = low[d] + high[d]
        kept[d] = not whole and bad <= bands.chunk_share * chunks[d] and bad <= bands.chunk_most and longest < bands.chunk_run
    return {"zstd_ratio": ratio, "n_chunks": chunks, "n_low_chunks": low, "n_high_chunks": high, "kept": kept}


def rules(df: DataFrame, bands: Bands = Bands(), min_words: int = 20, max_repeat_percent: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts, ratios and verdicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in blocks(offsets):
                text = Text(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                base, method = measure(text), compress(text, bands)
                failed = fails(base, min_words, max_repeat_percent)
                method["kept"] &= ~failed
                out = {"doc_id": batch.column(0)[lo:hi], **base, "base_failed": failed, **{k: method[k] for k in ("kept", "zstd_ratio", "n_chunks", "n_low_chunks", "n_high_chunks")}}
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in out.values()], list(out))

    return arrow(id_text(df, id_col, text_col), run, SCHEMA)
