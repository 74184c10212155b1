"""Toxicity by a classifier chain.

The categories are label columns in a fixed order. Each has a linear (logistic) model over indicators of tokens and of
their first bytes, and the probabilities of all categories before it. In training these probabilities are out of fold: they come from
models that haven't seen the row, so a later model learns how far to trust them. In scoring the chain runs in order.

The models are fitted on at most ``features.SAMPLE_ROWS`` labelled rows on the driver (a bound, whatever the input); every
text is scored whole. Nulls and empty texts: the offset's probability. Null doc_id and repeated rows are scored like any
other. No labels at all: every probability is 0, nothing is rejected. Columns other than doc_id and text are ignored.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts, workers_see_package
from crmflow.llm.features import SAMPLE_ROWS, indicators, sample, sigmoid, sums
from crmflow.llm.textgrid import grids

BITS = 20
FOLDS = 3
PREFIX = 5
LEAST_ROWS = 4
#: Category name and the label it is read from: SQL over the columns of the label table.
CATEGORIES = (("junk", "1 - quality"), ("toxic", "toxic"))
REJECT = 0.5


def logistic(features, extra, y, epochs=10, rate=0.3, seed=3):
    """Weights of indicators, weights of the dense inputs and an offset, by adaptive stochastic gradients.

    Indicators are scaled by the size of their class log-count ratio, and those of under ``LEAST_ROWS`` rows count 0, so a
    word seen with one class only outweighs the many that a few rows happen to share.
    """
    up, down = np.ones(1 << BITS), np.ones(1 << BITS)
    for f, t in zip(features, y):
        (up if t > 0.5 else down)[f] += 1
    scale = np.abs(np.log(up / up.sum()) - np.log(down / down.sum()))
    scale[up + down < 2 + LEAST_ROWS] = 0
    del up, down
    weight, past = np.zeros(1 << BITS), np.full(1 << BITS, 1e-1)
    dense, dense_past = np.zeros(extra.shape[1] + 1), np.full(extra.shape[1] + 1, 1e-1)
    inputs = np.hstack([extra, np.ones((len(y), 1))])
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in draw.permutation(len(y)):
            f, x = features[i], inputs[i]
            v = scale[f]
            g = 1 / (1 + np.exp(-min(max(weight[f] @ v + dense @ x, -40), 40))) - y[i]
            if abs(g) < 1e-3:
                continue
            step = g * v
            past[f] += step * step
            weight[f] -= rate * step / np.sqrt(past[f])
            dense_past += (g * x) ** 2
            dense -= rate * g * x / np.sqrt(dense_past)
    return weight * scale, dense


def _predict(model, features, extra):
    weight, dense = model
    return sigmoid(np.array([weight[f].sum() for f in features]) + np.hstack([extra, np.ones((len(features), 1))]) @ dense)


def fit_chain(features, y):
    """One model for each column of ``y``; earlier probabilities enter out of fold."""
    chain, extra = [], np.zeros((len(y), 0))
    part = np.arange(len(y)) % FOLDS
    for k in range(y.shape[1]):
        chain.append(logistic(features, extra, y[:, k]))
        if k < y.shape[1] - 1:
            out = np.zeros(len(y))
            for fold in range(FOLDS):
                rest, own = np.flatnonzero(part != fold), np.flatnonzero(part == fold)
                model = logistic([features[i] for i in rest], extra[rest], y[rest, k])
                out[own] = _predict(model, [features[i] for i in own], extra[own])
            extra = np.hstack([extra, out[:, None]])
    return chain


def fitted(labels: DataFrame, docs: DataFrame, categories=CATEGORIES, rows: int = SAMPLE_ROWS):
    names = [name for name, _ in categories]
    read = labels.select("doc_id", *[F.expr(sql).alias(name) for name, sql in categories])
    features, y, _ = sample(docs, read, names, lambda x: x.isNotNull(), BITS, (1,), rows, PREFIX)
    return fit_chain(features, y) if len(y) else None


def probabilities(models, column, count):
    """Yields (first, last, matrix of ``count`` category probabilities) over runs of the texts of an Arrow column."""
    for i, j, grid in grids(column, keys=False):
        doc, feature = indicators(grid, BITS, (1,), PREFIX)
        past = np.zeros((j - i, 0))
        for k in range(count):
            if models is None:
                p = np.zeros(j - i)
            else:
                weight, dense = models[k]
                p = sigmoid(sums(doc, feature, weight, j - i) + np.hstack([past, np.ones((j - i, 1))]) @ dense)
            past = np.hstack([past, p[:, None]])
        yield i, j, past


def toxicity(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, a probability for each category (its name), rejected (the last category's is at least ``REJECT``)."""
    names = [name for name, _ in categories]
    shared = docs.sparkSession.sparkContext.broadcast(fitted(labels, docs, categories, rows))

    def score(batches):
        for batch in batches:
            for i, j, p in probabilities(shared.value, batch.column(1), len(names)):
                yield pa.record_batch([batch.column(0).slice(i, j - i), *(pa.array(p[:, k].copy()) for k in range(len(names)))], names=["doc_id", *names])

    out = texts(docs).mapInArrow(score, "doc_id long, " + ", ".join(f"`{x}` double" for x in names))
    return out.withColumn("rejected", F.col(names[-1]) >= REJECT)


def without_toxic(docs: DataFrame, labels: DataFrame, categories=CATEGORIES) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't rejected; texts are judged one by one, in one pass and without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(labels, docs, categories))
    workers_see_package(docs.sparkSession)
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            p = [x[:, -1] for _, _, x in probabilities(shared.value, batch.column(at), len(categories))]
            if p:
                yield batch.filter(pa.array(np.concatenate(p) < REJECT))

    return docs.mapInArrow(keep, docs.schema)
