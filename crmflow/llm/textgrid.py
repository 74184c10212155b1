"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

Words are runs of bytes other than space, tab, newline, vertical tab, form feed and carriage return. A word's key is a
64-bit polynomial hash of its bytes (A-Z lowered when asked), passed through a mixer, so equal words have equal keys in
every task. Null texts count as empty. Texts are cut into pieces of about ``CHUNK`` bytes for bounded memory; a text is
never cut, a longer one makes a piece of its own.
"""
import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once.
CHUNK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_PLAIN = np.arange(256, dtype=np.uint64) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {}


def _power(base, n):
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * CHUNK:
            _powers[base] = have
    return have[:n]


def mix(x):
    """A bijective mixer of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Grid:
    """The words of some texts: ``doc`` (position of the text), ``start`` and ``end`` (bytes in ``data``), ``key``."""

    def __init__(self, data, offsets, lower, keys=True):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.empty_like(word)
        after[-1:] = False
        after[:-1] = word[1:]
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.words = np.bincount(self.doc, minlength=self.n)
        self.first = np.concatenate([[0], np.cumsum(self.words)])
        self._totals = {}
        if keys:
            self.key = span_keys(self, self.start, self.end, lower)

    def totals(self, lower):
        """Running polynomial sums over the bytes; the difference of two gives a span's hash."""
        if lower not in self._totals:
            total = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((_LOWER if lower else _PLAIN)[self.data] * _power(_BASE, len(self.data)), out=total[1:])
            self._totals[lower] = total
        return self._totals[lower]

    def grams(self, n, short=False):
        """Keys of n-word windows and the text of each. With ``short``, a text of fewer words has one window."""
        if n == 1:
            return self.key, self.doc
        size = len(self.key) - n + 1
        if size > 0:
            value = self.key[:size].copy()
            for i in range(1, n):
                value = mix(value + np.uint64(_BASE * (i + 1) % (1 << 64))) + self.key[i:i + size]
            value = mix(value)
            own = self.doc[:size] == self.doc[n - 1:n - 1 + size]
            value, doc = value[own], self.doc[:size][own]
        else:
            value, doc = np.empty(0, np.uint64), np.empty(0, np.int64)
        if not short:
            return value, doc
        more = np.flatnonzero((self.words > 0) & (self.words < n))
        if not len(more):
            return value, doc
        extra = np.zeros(len(more), np.uint64)
        for i in range(n - 1):
            has = self.words[more] > i
            extra[has] = mix(extra[has] + np.uint64(i + 7)) + self.key[self.first[more[has]] + i]
        value, doc = np.concatenate([value, mix(extra ^ np.uint64(_BASE))]), np.concatenate([doc, more])
        order = np.argsort(doc, kind="stable")
        return value[order], doc[order]

    def rows(self):
        """First and last word of each text, as a list of pairs."""
        return list(zip(self.first[:-1].tolist(), self.first[1:].tolist()))


def text_buffers(column):
    """Bytes and offsets of an Arrow string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(column, size=CHUNK):
    """Yields (first, last, bytes, offsets) over runs of texts of about ``size`` bytes."""
    data, offsets = text_buffers(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def grids(column, lower=True, size=CHUNK, keys=True):
    """Yields (first, last, Grid) over runs of texts."""
    for i, j, data, offsets in pieces(column, size):
        yield i, j, Grid(data, offsets, lower, keys)


#: 0: letters, digits and all bytes above 127; 1: other printable ASCII.
_PUNCT = np.zeros(256, bool)
_PUNCT[33:127] = True
for _run in (range(48, 58), range(65, 91), range(97, 123)):
    _PUNCT[list(_run)] = False


def tails(grid):
    """Where each word's trailing ASCII punctuation begins (its end if there is none, its start if it is all of it)."""
    n = len(grid.data)
    if not n:
        return grid.end
    place = np.arange(n)
    place[_PUNCT[grid.data]] = -1
    place = np.maximum.accumulate(place)
    return np.maximum(place[grid.end - 1] + 1, grid.start)


def tokens(grid, lower=True):
    """Keys of words without their trailing punctuation and of that punctuation, in text order, and the text of each."""
    cut = tails(grid)
    split = (cut > grid.start) & (cut < grid.end)
    count = 1 + split.astype(np.int64)
    at = np.cumsum(count) - count
    start, end = np.empty(int(count.sum()), np.int64), np.empty(int(count.sum()), np.int64)
    start[at], end[at] = grid.start, np.where(split, cut, grid.end)
    start[at[split] + 1], end[at[split] + 1] = cut[split], grid.end[split]
    doc = np.repeat(grid.doc, count)
    return span_keys(grid, start, end, lower), doc, start, end


def span_keys(grid, start, end, lower=True):
    """Keys of the byte spans; a whole word's is the word's key."""
    total = grid.totals(lower)
    return mix((total[end] - total[start]) * _power(_INVERSE, len(grid.data) + 1)[start])
