"""Periodic runs of words, from Lyndon arrays.

Phase one of Baier's suffix sorter groups the suffixes by their longest Lyndon prefix; the length of a suffix's final group
context is its entry of the Lyndon array. It is run under an order of the words and under the reversed order. Every maximal
run has, under one of the two, a root that is the longest Lyndon word at its place; the two longest common extensions of a
root and the same place one root further (hash of prefixes, binary search) give the run. Runs are then compared word by word.

Words that cannot lie in a run asked for cut a text first: each word of such a run occurs there as often as the exponent, and
each window of a length that follows from the bounds twice. What is left between the cuts is searched piece by piece; runs
never reach over a cut, and words are told apart by their bytes there.

Nulls: a null text has no words and no runs; a null doc_id stays. Empty texts: no runs, an empty collapsed text. Very long
texts: taken whole. Repeated rows: one row each. Ties: runs are ordered by start, then period. No rows: no result. Other
columns are ignored.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts
from crmflow.llm.textgrid import Grid, mix, pieces

#: A run is at least this many times its period, and has at least this many words.
EXPONENT, LEAST = 4, 6

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def lyndon_lengths(letters: list[int], kinds: int) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, by grouping suffixes from the highest group down.

    ``letters`` are 0 to ``kinds`` - 1. A group's members share a context; all higher groups are done. Each member extends the
    nearest place to its left that is not done by its own context, and places extended equally often leave their group
    for a new one right above it.
    """
    n = len(letters)
    members = [[] for _ in range(kinds)]
    for i, x in enumerate(letters):
        members[x].append(i)
    group, width = list(letters), [1] * kinds
    below, above = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    # Places not done, as a ring closed by place n.
    left, right = [n, *range(n)], [*range(1, n + 1), 0]
    lengths = [0] * n
    g = kinds - 1
    while g >= 0:
        size, times = width[g], {}
        for i in members[g]:
            if group[i] == g:
                lengths[i] = size
                a, b = left[i], right[i]
                right[a], left[b] = b, a
                if a != n:
                    times[a] = times.get(a, 0) + 1
        members[g] = None
        made = {}
        for j in times if len(times) < 2 else sorted(times, key=times.get, reverse=True):
            old, k = group[j], times[j]
            new = made.get((old, k))
            if new is None:
                new = made[old, k] = len(width)
                width.append(width[old] + k * size)
                members.append([])
                top = above[old]
                below.append(old)
                above.append(top)
                above[old], below[top] = new, new
            group[j] = new
            members[new].append(j)
        g = below[g]
    return lengths


class Spans:
    """Prefix hashes of a sequence, for common extensions of many pairs of places at once."""

    def __init__(self, values):
        n = len(values)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(values.astype(np.uint64) + np.uint64(1)) * powers[:n], out=self.total[1:])
        self.unit = np.full(n + 1, _INVERSE, np.uint64)
        self.unit[0] = 1
        self.unit = np.multiply.accumulate(self.unit)

    def keys(self, first, size):
        return (self.total[first + size] - self.total[first]) * self.unit[first]

    def extension(self, a, b, most, back=False):
        """How far the places ``a`` and ``b`` agree, up to ``most`` letters, forwards or backwards."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            step = middle if back else 0
            same = self.keys(a - step, middle) == self.keys(b - step, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def window_length(exponent: int, least: int) -> int:
    """The longest window of which a run of every period holds two copies of each it has."""
    return max(1, min(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 2)))


def stretches(key, owner, exponent, least):
    """First and end places of the stretches that may hold runs; nothing outside them can lie in one."""
    window = window_length(exponent, least)
    place = np.arange(len(key))
    while len(place):
        part = np.cumsum(np.diff(place, prepend=place[0]) > 1) if len(place) < len(key) else np.zeros(len(place), np.int64)
        part = mix((part + 1).astype(np.uint64)) ^ mix((owner[place] + 1).astype(np.uint64) * _BASE)
        own = key[place]
        n = len(place) - window + 1
        if n < 2:
            return np.empty((0, 2), np.int64)
        value = own[:n].copy()
        for k in range(1, window):
            value = mix(value) + own[k:k + n]
        inside = part[:n] == part[window - 1:]
        kept = _covered(_often(mix(value) ^ part[:n], 2) & inside, window, len(place))
        kept &= _often(mix(own) ^ part, exponent)
        if kept.all():
            break
        place = place[kept]
    if not len(place):
        return np.empty((0, 2), np.int64)
    edge = np.flatnonzero((np.diff(place) > 1) | (np.diff(owner[place]) != 0)) + 1
    first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(place)]]) - 1
    found = np.stack([place[first], place[last] + 1], axis=1)
    return found[found[:, 1] - found[:, 0] >= least]


def _often(value, times):
    """Which values occur at least so many times."""
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    edge = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])
    out = np.empty(len(value), bool)
    out[order] = np.repeat(np.diff(edge) >= times, np.diff(edge))
    return out


def _covered(starts, window, n):
    """Which of ``n`` places lie in a marked window."""
    change = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(starts)
    change[at] += 1
    change[at + window] -= 1
    return np.cumsum(change[:n]) > 0


def runs(letters: list[int], kinds: int, exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of a sequence of letters 0 to ``kinds`` - 1, by start and period."""
    n, values = len(letters), np.asarray(letters, np.int64)
    spans, found = Spans(values), set()
    for order in (letters, [kinds - 1 - x for x in letters]):
        period = np.asarray(lyndon_lengths(order, kinds), np.int64)
        at = np.flatnonzero(period * exponent <= n)
        at = at[at + period[at] < n]
        at = at[values[at] == values[at + period[at]]]
        p = period[at]
        ahead = spans.extension(at, at + p, n - at - p)
        behind = spans.extension(at, at + p, at, back=True)
        size = behind + p + ahead
        good = (size >= exponent * p) & (size >= least)
        found |= set(zip((at - behind)[good].tolist(), size[good].tolist(), p[good].tolist()))
    return sorted((start, size, p) for start, size, p in found if _exact(values, start, size, p))


def _exact(values, start, size, p):
    """Compares a run letter by letter; two spans of one hash are a case to report, not to pass over."""
    if not np.array_equal(values[start:start + size - p], values[start + p:start + size]):
        raise ValueError("two different spans of words have one hash")
    return True


def _found(batches, exponent, least):
    for batch in batches:
        for i, j, data, offsets in pieces(batch.column("text")):
            grid = Grid(data, offsets, False)
            by_text = [[] for _ in range(j - i)]
            for first, end in stretches(grid.key, grid.doc, exponent, least).tolist():
                own = int(grid.doc[first])
                seen = {}
                letters = [seen.setdefault(data[a:b].tobytes(), len(seen)) for a, b in zip(grid.start[first:end].tolist(), grid.end[first:end].tolist())]
                skip = first - int(grid.first[own])
                by_text[own] += [(start + skip, size, p) for start, size, p in runs(letters, len(seen), exponent, least)]
            rows, collapsed = [], []
            for k, found in enumerate(by_text):
                words = data[offsets[k]:offsets[k + 1]].tobytes().split()
                rows.append([{"start": a, "length": b, "period": c} for a, b, c in found])
                if found:
                    keep = np.ones(len(words), bool)
                    for start, size, p in found:
                        keep[start + p:start + size] = False
                    words = [words[x] for x in np.flatnonzero(keep).tolist()]
                collapsed.append(b" ".join(words).decode())
            yield pa.record_batch(
                [batch.column("doc_id").slice(i, j - i), pa.array(grid.words, pa.int64()), pa.array(rows, _RUNS), pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def found(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, the maximal runs (start word, length, smallest period) and the collapsed text.

    A run has at least ``least`` words and ``exponent`` (2 or more) times its period. The collapsed text, words joined by one space,
    leaves out what lies in a run after the run's first period. One pass, no shuffle.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    return texts(docs).mapInArrow(
        lambda batches: _found(batches, exponent, least),
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def tiled(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts of the query: in one of ten documents, by crc32 of the doc_id, a drawn tail repeats its beginning.

    Documents without an id and texts without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    named = texts(docs).withColumn("g", F.when(h % 10 == 0, F.floor(h / 10)))
    named = named.withColumn("words", F.when(F.col("g").isNotNull(), words)).withColumn("n", F.size("words").cast("long"))
    a = F.col("g") % F.col("n")
    named = named.withColumn("a", F.when(F.col("n") > 0, a).cast("int"))
    rest = F.col("n") - F.col("a")
    named = named.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    return named.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(_repeated(), " ")).otherwise(F.col("text")).alias("text"))


def _repeated() -> Column:
    rest = (F.col("n") - F.col("a")).cast("int")
    one = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(one, F.ceil(rest / F.col("p")).cast("int"))), 1, rest)
    return F.concat(F.slice("words", F.lit(1), F.col("a")), tail)


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the run of the greatest exponent, and sha256 of the runs and of the collapsed text."""
    rows = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period"))), F.lit("\n")))
    best = F.aggregate(
        "runs", F.get("runs", F.lit(0)),
        lambda held, r: F.when(r["length"] * held["period"] > held["length"] * r["period"], r).otherwise(held))
    named = found(tiled(docs)).withColumn("best", best)
    return named.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{x}").alias(x) for x in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(rows, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
