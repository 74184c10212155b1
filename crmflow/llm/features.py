"""Hashed n-gram indicators of texts, samples of labelled rows, and linear scores over them."""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts
from crmflow.llm.textgrid import grids, mix, span_keys, tokens

#: Most labelled rows that a model is fitted on: those of the least hash of doc_id. A bound, whatever the input.
SAMPLE_ROWS = 8000


def indicators(grid, bits: int, orders=(1, 2), prefix: int = 0):
    """Distinct (text, feature) pairs: hashed token n-grams of the given orders, sorted by text. A text has at most 2**bits.

    With ``prefix``, the first that many bytes of each token are features too: they join words of one stem.
    """
    key, doc, start, end = tokens(grid)
    found = []
    if prefix:
        head = np.minimum(end, start + prefix)
        long = head < end
        value = span_keys(grid, start[long], head[long])
        found.append((doc[long] << bits) | (mix(value + np.uint64(99)) >> np.uint64(64 - bits)).astype(np.int64))
    for n in orders:
        size = len(key) - n + 1
        if size > 0:
            value = key[:size].copy()
            for i in range(1, n):
                value = mix(value) + key[i:i + size]
            own = doc[:size] == doc[n - 1:]
            found.append((doc[:size][own] << bits) | (mix(value[own] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int64))
        if n == 2 and size > 0:
            # How often (in powers of two) a text says a token again at once: the same 2-gram shape whatever the token.
            again = np.bincount(doc[1:][(key[1:] == key[:-1]) & own], minlength=grid.n)
            text = np.flatnonzero(again)
            level = np.log2(again[text]).astype(np.int64)
            for back in range(int(level.max()) + 1 if len(text) else 0):
                deep = text[level >= back]
                shape = int(mix(np.array([1000 + back], np.uint64))[0] >> np.uint64(64 - bits))
                found.append((deep << bits) | shape)
    both = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return both >> bits, both & ((1 << bits) - 1)


def sample(docs: DataFrame, labels: DataFrame, columns: list, where, bits: int, orders, rows: int = SAMPLE_ROWS, prefix: int = 0):
    """Features and labels of at most ``rows`` labelled documents, on the driver: (list of feature arrays, label matrix, ids).

    Rows with a null id or label are left out; of rows that repeat an id, the one with the largest labels counts.
    """
    chosen = labels.select(F.col("doc_id").cast("long").alias("id"), *[F.col(c).cast("double").alias(f"y{k}") for k, c in enumerate(columns)])
    chosen = chosen.dropna().where(where(F.col("id"))).groupBy("id").agg(*[F.max(f"y{k}").alias(f"y{k}") for k in range(len(columns))])
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(rows)
    names = [f"y{k}" for k in range(len(columns))]
    rows_ = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("text", "id", *names)

    def gather(batches):
        for batch in batches:
            for i, j, grid in grids(batch.column(0), keys=False):
                doc, feature = indicators(grid, bits, orders, prefix)
                ends = np.cumsum(np.bincount(doc, minlength=j - i))
                raw, cut = feature.astype(np.int32).tobytes(), [0, *(4 * ends).tolist()]
                yield pa.record_batch([*(batch.column(k + 1).slice(i, j - i) for k in range(1 + len(names))), pa.array([raw[x:y] for x, y in zip(cut, cut[1:])], pa.binary())], names=["id", *names, "f"])

    schema = "id long, " + "".join(f"{x} double, " for x in names) + "f binary"
    got = {r[0]: r for r in rows_.mapInArrow(gather, schema).collect()}
    order = sorted(got)
    features = [np.frombuffer(got[i][-1], np.int32) for i in order]
    return features, np.array([list(got[i][1:-1]) for i in order], np.float64).reshape(len(order), len(names)), np.array(order, np.int64)


def sums(doc, feature, weight, n):
    """Sum of the weights of each text's features."""
    return np.bincount(doc, weights=weight[feature], minlength=n)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def platt(margin, y, rounds: int = 100):
    """Slope and offset that turn margins into probabilities (Newton steps; smoothed targets)."""
    up, down = (y > 0.5).sum(), (y <= 0.5).sum()
    if not up or not down:
        return 1.0, float(np.log((up + 1) / (down + 1)))
    target = np.where(y > 0.5, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * margin + b)
        g = np.array([np.sum((p - target) * margin), np.sum(p - target)])
        w = p * (1 - p) + 1e-9
        h = np.array([[np.sum(w * margin * margin) + 1e-6, np.sum(w * margin)], [np.sum(w * margin), np.sum(w) + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)
