"""Quality rules with line sequence labelling.

The rules count words, symbols, repeated lines and repeated 8-word windows of whole texts. A linear-chain conditional random field (CRF)
over the lines marks each as content or boilerplate by Viterbi decoding; a document that passes the rules is kept if content
lines hold at least ``SHARE`` of its word characters. The CRF is fitted by stochastic gradients of its likelihood (forward and backward
sums) on at most ``SAMPLE_ROWS`` labelled documents; lines of low-quality documents, repeated lines and licence lines are its boilerplate.

Nulls and empty texts: no words, no lines, base_failed, not kept. Null doc_id and repeated rows: each row has its own
result. No labels: no CRF, all lines are content. Equal Viterbi scores: content. Other columns are ignored.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts
from crmflow.llm.textgrid import Grid, mix, pieces, span_keys

WINDOW, LEAST_WORDS, MOST_REPEATED, SHARE, SAMPLE_ROWS = 8, 20, 30, 0.5, 3000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?{}[]=_~^\\/@")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
#: Words of licence and notice lines, as byte strings in lower case.
NOTICE = (b"license", b"licence", b"licensed", b"copyright", b"rights", b"cookies", b"privacy", b"lizenz", b"licencia")
FEATURES = 26


def _inside(flag, start, end):
    """How many bytes with a flag each span has."""
    total = np.concatenate([[0], np.cumsum(flag)])
    return total[end] - total[start]


class Lines:
    """Rule counts of some texts, and the feature matrix of their lines with a word."""

    def __init__(self, data, offsets):
        grid = Grid(data, offsets, False)
        n = grid.n
        letter = (data & 0xC0) != 0x80
        chars = _inside(letter, grid.start, grid.end)
        self.words = grid.words
        self.word_chars = np.bincount(grid.doc, weights=chars, minlength=n).astype(np.int64)
        self.symbols = _inside(_SYMBOL[data], offsets[:-1], offsets[1:])
        breaks = np.flatnonzero(data == 10)
        first = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], breaks + 1]))
        first = first[first < len(data)]
        doc = np.searchsorted(offsets, first, "right") - 1
        after = np.searchsorted(breaks, first)
        last = offsets[doc + 1]
        if len(breaks):
            stop = np.where(after < len(breaks), breaks[np.minimum(after, len(breaks) - 1)], len(data))
            last = np.minimum(last, stop)
        low, high = np.searchsorted(grid.start, first), np.searchsorted(grid.start, last)
        has = high > low
        first, last, doc, low, high = first[has], last[has], doc[has], low[has], high[has]
        key = span_keys(grid, first, last, False)
        order = np.lexsort((np.arange(len(key)), key, doc))
        again = np.zeros(len(key), bool)
        again[order[1:]] = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        self.dup_lines = np.bincount(doc[again], minlength=n)
        self.repeat_words = self._repeated(grid, n)
        self.doc, self.count = doc, np.bincount(doc, minlength=n)
        self.chars = np.concatenate([[0], np.cumsum(chars)])
        self.chars = self.chars[high] - self.chars[low]
        self.again = again
        self.features = self._features(data, grid, first, last, low, high, again)

    @staticmethod
    def _repeated(grid, n):
        size = len(grid.key) - WINDOW + 1
        if size <= 0:
            return np.zeros(n, np.int64)
        value = grid.key[:size].copy()
        for i in range(1, WINDOW):
            value = mix(value) + grid.key[i:i + size]
        at = np.flatnonzero(grid.doc[:size] == grid.doc[WINDOW - 1:])
        value = mix(value[at] ^ mix(grid.doc[at].astype(np.uint64)))
        order = np.argsort(value, kind="stable")
        same = value[order][1:] == value[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(len(grid.key) + 1, np.int64)
        edge[at[twice]] += 1
        np.add.at(edge, at[twice] + WINDOW, -1)
        return np.bincount(grid.doc[np.cumsum(edge[:-1]) > 0], minlength=n)

    def _features(self, data, grid, first, last, low, high, again):
        words, size = high - low, np.maximum(1, last - first)
        share = lambda flag: _inside(flag, first, last) / size
        symbol, mark, upper, digit = share(_SYMBOL[data]), share(_MARK[data]), share(_UPPER[data]), share(_DIGIT[data])
        notice_keys = np.array([_key(w) for w in NOTICE], np.uint64)
        lower = span_keys(grid, grid.start, grid.end, True)
        notice = _inside(np.isin(lower, notice_keys), low, high) > 0
        echo = np.zeros(len(grid.key), bool)
        echo[1:] = (grid.key[1:] == grid.key[:-1]) & (grid.doc[1:] == grid.doc[:-1])
        echo = _inside(echo, low, high) / words
        end = data[grid.end[high - 1] - 1] if len(high) else np.empty(0, np.uint8)
        mean = size / words
        columns = [np.ones(len(first), bool), words <= 2, words <= 5, words <= 12, words > 40, words > 120]
        columns += [symbol > x for x in (0, 0.03, 0.1, 0.2)] + [mark > x for x in (0, 0.03, 0.1)] + [upper > x for x in (0.15, 0.5)]
        columns += [digit > x for x in (0.05, 0.3)] + [echo > x for x in (0, 0.1, 0.4)]
        columns += [again, notice, np.isin(end, list(b".!?")), mean > 10, mean > 20, mean < 3.5]
        return np.stack(columns, 1).astype(np.float64)


def _key(word):
    data = np.frombuffer(word, np.uint8)
    return Grid(data, np.array([0, len(data)]), True).key[0]


def _forward_backward(score, move):
    """Log-likelihood parts of one line sequence: marginals of states and of moves."""
    n = len(score)
    a, b = np.zeros((n, 2)), np.zeros((n, 2))
    a[0] = score[0]
    for i in range(1, n):
        a[i] = score[i] + np.logaddexp(a[i - 1, 0] + move[0], a[i - 1, 1] + move[1])
    for i in range(n - 2, -1, -1):
        x = score[i + 1] + b[i + 1]
        b[i] = np.logaddexp(move[:, 0] + x[0], move[:, 1] + x[1])
    total = np.logaddexp(*a[-1])
    pairs = np.zeros((2, 2))
    for i in range(1, n):
        pairs += np.exp(a[i - 1][:, None] + move + (score[i] + b[i])[None, :] - total)
    return np.exp(a + b - total), pairs


def fit_crf(sequences, epochs=6, rate=0.3, decay=1e-4, seed=13):
    """Weights (features x 2) and moves (2 x 2, from and to) from (features, labels) sequences; label 1 is boilerplate."""
    weight, move = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    past, move_past = np.full((FEATURES, 2), 1.0), np.full((2, 2), 1.0)
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in draw.permutation(len(sequences)):
            x, y = sequences[k]
            p, pairs = _forward_backward(x @ weight, move)
            told = np.zeros_like(p)
            told[np.arange(len(y)), y] = 1
            scale = 1 / np.sqrt(len(y))
            g = scale * (x.T @ (told - p)) - decay * weight
            moved = np.zeros((2, 2))
            np.add.at(moved, (y[:-1], y[1:]), 1)
            h = scale * (moved - pairs) - decay * move
            past += g * g
            move_past += h * h
            weight += rate * g / np.sqrt(past)
            move += rate * h / np.sqrt(move_past)
    return weight, move


def viterbi(score, count, move):
    """Best states of all line sequences at once (``count`` lines each), a step for all of them at a time."""
    state = np.zeros(len(score), np.int8)
    first = np.cumsum(count) - count
    live = np.argsort(-count, kind="stable")
    live = live[count[live] > 0]
    if not len(live):
        return state
    best, back = score.copy(), np.zeros((len(score), 2), np.int8)
    sizes = count[live]
    for step in range(1, int(sizes[0])):
        own = live[:np.searchsorted(-sizes, -step, "left")]
        at = first[own] + step
        come = best[at - 1][:, :, None] + move[None]
        back[at] = come[:, 1] > come[:, 0]
        best[at] = score[at] + come.max(1)
    end = first[live] + sizes - 1
    state[end] = best[end, 1] > best[end, 0]
    for step in range(int(sizes[0]) - 1, 0, -1):
        own = live[:np.searchsorted(-sizes, -step, "left")]
        at = first[own] + step
        state[at - 1] = back[at, state[at]]
    return state


def training_lines(docs: DataFrame, labels: DataFrame, rows: int):
    chosen = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")).dropna().groupBy("id").agg(F.max("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(rows)

    def gather(batches):
        for batch in batches:
            for i, j, data, offsets in pieces(batch.column(0)):
                lines = Lines(data, offsets)
                good = batch.column(1).slice(i, j - i).to_pylist()
                end = np.cumsum(lines.count)
                for k in range(j - i):
                    own = slice(int(end[k] - lines.count[k]), int(end[k]))
                    x = lines.features[own]
                    if len(x):
                        y = np.full(len(x), 1 - good[k])
                        y[lines.again[own] | (x[:, 21] > 0)] = 1
                        yield pa.record_batch([pa.array([x.astype(np.int8).tobytes()], pa.binary()), pa.array([y.astype(np.int8).tobytes()], pa.binary())], names=["x", "y"])

    got = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("text", "quality").mapInArrow(gather, "x binary, y binary").collect()
    return [(np.frombuffer(r[0], np.int8).reshape(-1, FEATURES).astype(np.float64), np.frombuffer(r[1], np.int8).astype(int)) for r in sorted(got, key=lambda r: (bytes(r[0]), bytes(r[1])))]


def judged(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share, n_lines, n_boilerplate."""
    sequences = training_lines(docs, labels, rows)
    shared = docs.sparkSession.sparkContext.broadcast(fit_crf(sequences) if sequences else (np.zeros((FEATURES, 2)), np.zeros((2, 2))))

    def judge(batches):
        weight, move = shared.value
        for batch in batches:
            for i, j, data, offsets in pieces(batch.column(1)):
                lines = Lines(data, offsets)
                state = viterbi(lines.features @ weight, lines.count, move)
                n = j - i
                content = np.bincount(lines.doc, weights=lines.chars * (state == 0), minlength=n)
                share = content / np.maximum(1, np.bincount(lines.doc, weights=lines.chars, minlength=n))
                failed = (lines.words < LEAST_WORDS) | (100 * lines.repeat_words > MOST_REPEATED * lines.words)
                values = [lines.words, lines.word_chars, lines.symbols, lines.dup_lines, lines.repeat_words]
                yield pa.record_batch([batch.column(0).slice(i, n), *(pa.array(v.astype(np.int64)) for v in values), pa.array(failed), pa.array(~failed & (share >= SHARE)), pa.array(share), pa.array(lines.count), pa.array(np.bincount(lines.doc[state == 1], minlength=n))],
                                      names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "n_lines", "n_boilerplate"])

    return texts(docs).mapInArrow(judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, n_lines long, n_boilerplate long")
