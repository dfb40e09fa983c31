"""Words and lines of many texts at once, found and hashed with numpy on Arrow's own buffers.

A span's hash is a polynomial over its bytes, ``sum(value[byte_i] * B**i)`` modulo 2**64, read off a running sum: the
difference of two sums, times the inverse power of the start. The running sum is kept at the ends of spans only and
bytes are handled in segments, so a text of any length needs a few arrays of one segment plus arrays of one entry a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 19
CHUNK_BYTES = 4 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, np.uint64)
    out[0] = 1
    done = 1
    while done < count:
        step = min(done, count - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_POW = _powers(_BASE, SEGMENT)
_INV = _powers(_INVERSE, SEGMENT)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one-to-one)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]  # A-Z count as a-z

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


class Texts:
    """The bytes of some texts, one after another, and where each begins (one more offset than texts)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_text(self, hit: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked in ``hit``."""
        total = np.concatenate(([0], np.cumsum(hit, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


class Spans:
    """Spans in order: ``text`` (index of the text), ``start`` and ``end`` (byte positions), ``hash``."""

    def __init__(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, count: int):
        self.text, self.start, self.end, self.hash = text, start, end, hashes
        self.counts = np.bincount(text, minlength=count).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))


def texts_of(column: pa.Array) -> Texts:
    """Arrow strings as ``Texts``; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return Texts(raw[at[0] : at[-1]], at - at[0])


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have ``most`` bytes together, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > most:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += int(size)
    if first < len(sizes):
        yield batch.slice(first)


def spans(texts: Texts, breaks: np.ndarray, lower: bool = False) -> Spans:
    """The longest runs without a byte of ``breaks``, within each text."""
    value = _LOWER if lower else _EXACT
    n = len(texts.data)
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    begins, ends, at_begin, at_end, inverse = [], [], [], [], []
    carry, out_before = np.uint64(0), True
    for low in range(0, n, SEGMENT):
        part = texts.data[low : low + SEGMENT]
        size = len(part)
        out = breaks[part]
        before = np.concatenate(([out_before], out[:-1]))
        here = edge[low : low + size]
        opens = np.flatnonzero(~out & (before | here))
        closes = np.flatnonzero(~before & (out | here))
        with np.errstate(over="ignore"):
            terms = value[part] * (_POW[:size] * np.uint64(pow(_BASE, low, 1 << 64)))
            sums = np.concatenate(([carry], carry + np.cumsum(terms, dtype=np.uint64)))
            inverse.append(_INV[opens] * np.uint64(pow(_INVERSE, low, 1 << 64)))
        begins.append(opens + low)
        ends.append(closes + low)
        at_begin.append(sums[opens])
        at_end.append(sums[closes])
        carry, out_before = sums[-1], bool(out[-1])
    if n and not out_before:
        ends.append(np.array([n]))
        at_end.append(np.array([carry], np.uint64))
    if not begins:
        none = np.zeros(0, np.int64)
        return Spans(none, none, none, np.zeros(0, np.uint64), len(texts))
    start, end = np.concatenate(begins), np.concatenate(ends)
    with np.errstate(over="ignore"):
        hashes = mix((np.concatenate(at_end) - np.concatenate(at_begin)) * np.concatenate(inverse))
    text = np.searchsorted(texts.offsets, start, side="right") - 1
    return Spans(text, start, end, hashes, len(texts))


def words(texts: Texts, lower: bool = False) -> Spans:
    """Runs of bytes other than space and U+0009 to U+000D; ``lower`` hashes A-Z as a-z."""
    return spans(texts, _SPACE, lower)


def lines(texts: Texts) -> Spans:
    """Non-empty lines."""
    return spans(texts, _NEWLINE)


def windows(found: Spans, width: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``width`` neighbouring words within a text: (text, index of the first word, hash).

    With ``short`` a text of fewer words gives one window of all of them.
    """
    n = len(found.hash)
    kept = found.counts[found.text] >= width
    last = found.first[found.text] + found.counts[found.text] - width
    index = np.flatnonzero(kept & (np.arange(n) <= last))
    with np.errstate(over="ignore"):
        h = np.full(len(index), np.uint64(width))
        for k in range(width):
            h = mix(h * np.uint64(_BASE) + found.hash[index + k])
        text = found.text[index]
        if short and (few := np.flatnonzero((found.counts > 0) & (found.counts < width))).size:
            whole = []
            for t in few:
                g = np.full(1, np.uint64(found.counts[t]))
                for k in range(found.first[t], found.first[t + 1]):
                    g = mix(g * np.uint64(_BASE) + found.hash[k : k + 1])
                whole.append(g[0])
            text = np.concatenate((text, few))
            index = np.concatenate((index, found.first[few]))
            h = np.concatenate((h, np.array(whole, np.uint64)))
    return text, index, h


def repeated(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items in reading order, whether the same text has an equal item before, and whether it has one anywhere."""
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, bool)
    with np.errstate(over="ignore"):
        key = mix(hashes + mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:]] = same
    anywhere = again.copy()
    anywhere[order[:-1]] |= same
    return again, anywhere
