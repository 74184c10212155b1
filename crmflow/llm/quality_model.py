"""Quality classifier: naive Bayes support vectors.

Indicators of token 1- and 2-grams (hashed to 2**BITS) are scaled by the class log-count ratio
``r = log((p / |p|) / (q / |q|))``, p and q the smoothed indicator counts of both classes, and a hinge-loss linear model is
fitted on the scaled indicators by dual coordinate descent. Its weights are drawn towards the mean size of all weights,
as the method's authors advise. Margins become probabilities by a sigmoid fitted on folds that a model hasn't seen.

The model is fitted on the driver on at most ``features.SAMPLE_ROWS`` labelled rows (a bound, whatever the input); every
text is scored whole. Nulls and empty texts have no indicators: their score is that of the offset. Rows without doc_id are
scored too. Repeated rows are scored each. No labels, or one class only: a constant score. No documents: no rows. Other columns are
ignored. Ties of the score with the threshold are predicted 1.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts
from crmflow.llm.features import SAMPLE_ROWS, indicators, platt, sample, sigmoid, sums
from crmflow.llm.textgrid import grids

BITS = 18
ORDERS = (1, 2)


def hinge_by_dual(features, scale, y, cost=1.0, epochs=20, seed=7):
    """Weights (over scaled indicators) and offset of an L2-regularised hinge-loss model; ``y`` is -1 or 1."""
    weight, offset = np.zeros(len(scale)), 0.0
    values = [scale[f] for f in features]
    norm = np.array([v @ v + 1 for v in values])
    alpha = np.zeros(len(y))
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in draw.permutation(len(y)):
            f, v = features[i], values[i]
            gradient = y[i] * (weight[f] @ v + offset) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                weight[f] += step * v
                offset += step
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return weight, offset


def fit(features, y, beta=0.25):
    """One weight for each indicator (ratio times model weight) and an offset."""
    up, down = np.ones(1 << BITS), np.ones(1 << BITS)
    for f, t in zip(features, y):
        (up if t > 0.5 else down)[f] += 1
    ratio = np.log(up / up.sum()) - np.log(down / down.sum())
    weight, offset = hinge_by_dual(features, ratio, np.where(y > 0.5, 1.0, -1.0))
    mean = np.abs(weight).sum() / max(1, np.count_nonzero(weight))
    weight = (1 - beta) * mean * np.sign(weight) + beta * weight
    return weight * ratio, offset


def fit_with_probability(features, y, folds=4):
    """(weights, offset, slope, shift) or a constant probability where there is one class only."""
    if len(set((y > 0.5).tolist())) < 2:
        return np.zeros(1 << BITS), 0.0, 1.0, float(4 * y.mean() - 2) if len(y) else 0.0
    part = np.arange(len(y)) % folds
    margin = np.zeros(len(y))
    for k in range(folds):
        own = [features[i] for i in np.flatnonzero(part != k)]
        weight, offset = fit(own, y[part != k])
        for i in np.flatnonzero(part == k):
            margin[i] = weight[features[i]].sum() + offset
    slope, shift = platt(margin, y)
    return (*fit(features, y), slope, shift)


def scored(docs: DataFrame, labels: DataFrame, train, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, score of every row of ``docs``; ``train`` maps an id column to a condition: rows to learn from."""
    model = fit_with_probability(*(lambda f, y, _: (f, y[:, 0]))(*sample(docs, labels, ["quality"], train, BITS, ORDERS, rows)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        weight, offset, slope, shift = shared.value
        for batch in batches:
            for i, j, grid in grids(batch.column(1), keys=False):
                doc, feature = indicators(grid, BITS, ORDERS)
                margin = sums(doc, feature, weight, j - i) + offset
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(sigmoid(slope * margin + shift))], names=["doc_id", "score"])

    return texts(docs).mapInArrow(score, "doc_id long, score double")


def fifth(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: learns from ids whose crc32 isn't divisible by 5. Without an id: not held out, nor learnt from."""
    out = scored(docs, labels, lambda x: fifth(x) != 0)
    return out.select("doc_id", F.coalesce(fifth(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
