"""Mixing sources to target weights with soft membership.

A softmax classifier over hashed token indicators, fitted on a labelled table of domains (at most ``SAMPLE_ROWS`` rows), gives
every document its posterior over domains. Document rates r >= ``floor`` (0 unless asked) are found by projected-gradient
least squares, so that the expected token total of each domain, the sum of rate * tokens * posterior, meets its target:
r starts at 1, and each step sums all totals over Spark tasks, then moves every rate against the gradient and projects it.
The gradient is scaled by G, the sum of tokens * posterior * posterior' over the rates above the floor, with ``DAMPING``
of the sum over all: the rates move by the posterior times the solution of G x = errors, so that where no further rate
meets the floor one step meets all targets. A rate follows from its document's posterior and the solutions of the steps so
far (a few numbers a step), so no rates are kept between steps and a lost task is simply run again. The descent ends when
every total is met, after ``PATIENCE`` steps without a better mix or after ``STEPS`` steps; the best mix met counts. What it
misses is returned: ``unmet`` is the largest distance of a domain's total from its target, as a part of all tokens of
the mix (``mixed`` warns of it). Soft posteriors can make targets unreachable: no rates take tokens from a domain alone.

Rates from a floor on can't lower a domain below the floor. Then the targets are raised where they lie below, and the others
lowered by one factor, so that their sum stays: these totals are in reach, and ``unmet`` still counts from the targets asked.

Rates become whole copies: floor(r), and one more with the probability of the rest, by a hash of doc_id. Tokens are words.

Nulls and empty texts: no tokens, the classifier's offset as posterior. Null doc_id: hashed as 0. Repeated rows: each has its rate.
No labelled rows, or no tokens: all rates are 1. Domains without a target have target 0; a domain that no text has is left out of the
errors. Other columns are ignored (``mixed`` returns them).
"""
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import bounded, saved, texts, workers_see_package
from crmflow.llm.features import indicators, sample
from crmflow.llm.textgrid import grids, mix

BITS, SAMPLE_ROWS, STEPS, PATIENCE, CLOSE, DAMPING = 16, 4000, 40, 15, 1e-4, 1e-3
#: Token shares of the mix by language and quality; their products are the targets of the domains "language:quality".
LANGUAGES = {"en": 0.5, "fr": 0.2, "de": 0.18, "es": 0.12}
QUALITY = {"1": 0.95, "0": 0.05}
TARGETS = {f"{a}:{b}": x * y for a, x in LANGUAGES.items() for b, y in QUALITY.items()}


def softmax(z):
    z = np.exp(z - z.max(-1, keepdims=True))
    return z / z.sum(-1, keepdims=True)


def fit(features, label, classes, epochs=6, rate=0.3, seed=5):
    """Weights (features x classes) and offsets of a softmax model, by adaptive stochastic gradients."""
    weight, past = np.zeros((1 << BITS, classes)), np.full((1 << BITS, classes), 1.0)
    offset, offset_past = np.zeros(classes), np.full(classes, 1.0)
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in draw.permutation(len(label)):
            f = features[i]
            scale = 1 / np.sqrt(max(1, len(f)))
            g = softmax(scale * weight[f].sum(0) + offset)
            g[label[i]] -= 1
            step = g * scale
            past[f] += step * step
            weight[f] -= rate * step / np.sqrt(past[f])
            offset_past += g * g
            offset -= rate * g / np.sqrt(offset_past)
    return weight.astype(np.float32), offset


class Membership:
    """Domain names, and posteriors of texts."""

    def __init__(self, docs: DataFrame, labelled: DataFrame):
        names = [r[0] for r in labelled.where("domain is not null").select("domain").distinct().orderBy("domain").collect()]
        self.names = names
        self.model = None
        if names:
            place = F.coalesce(*[F.when(F.col("domain") == n, F.lit(float(k))) for k, n in enumerate(names)])
            features, label, _ = sample(docs, labelled.select("doc_id", place.alias("y")), ["y"], lambda x: x.isNotNull(), BITS, (1,), SAMPLE_ROWS)
            if len(label):
                self.model = fit(features, label[:, 0].astype(int), len(names))

    def of(self, column):
        """(tokens, posterior matrix) of an Arrow column of texts."""
        tokens, posterior = [np.empty(0, np.int64)], [np.empty((0, len(self.names)))]
        weight, offset = self.model
        for i, j, grid in grids(column, keys=False):
            doc, feature = indicators(grid, BITS, (1,))
            size = np.bincount(doc, minlength=j - i)
            z = np.zeros((j - i, len(self.names)))
            own = np.flatnonzero(size)
            if len(doc):
                z[own] = np.add.reduceat(weight[feature], (np.cumsum(size) - size)[own], axis=0, dtype=np.float64)
            posterior.append(softmax(z / np.sqrt(np.maximum(size, 1))[:, None] + offset))
            tokens.append(grid.words)
        return np.concatenate(tokens), np.concatenate(posterior)


def rates(posterior, steps, floor):
    """Rates after the steps, each a vector by domain."""
    r = np.ones(len(posterior))
    for error in steps:
        r = np.maximum(floor, r - posterior @ error)
    return r


def copies(ids: pa.Array, rate):
    unit = (mix(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return (np.floor(rate) + (unit < rate - np.floor(rate))).astype(np.int64)


def in_reach(want, least):
    """The totals with the sum of ``want`` that are at least ``least`` and else in the proportions of ``want``."""
    if least.sum() >= want.sum():
        return least
    held = np.zeros(len(want), bool)
    while True:
        factor = (want.sum() - least[held].sum()) / max(want[~held].sum(), 1e-300)
        more = ~held & (factor * want < least)
        if not more.any():
            return np.where(held, least, factor * want)
        held |= more


def descend(members: DataFrame, names, targets, floor, growth):
    """(vectors of all steps, what is unmet); ``members`` has n_tokens and posterior."""
    spark, steps, size, best, least, every = members.sparkSession, [], len(names), 0, np.inf, None
    for _ in range(STEPS + 1):
        shared = spark.sparkContext.broadcast(list(steps))

        def total(batches):
            out = np.zeros(size + size * size)
            for batch in batches:
                n = batch.column(0).to_numpy(zero_copy_only=False)
                p = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(n), -1)
                r = rates(p, shared.value, floor)
                out[:size] += (n * r) @ p
                # At the start all rates can move.
                own = r > floor if shared.value else slice(None)
                out[size:] += ((n[own, None] * p[own]).T @ p[own]).ravel()
            yield pa.record_batch([pa.array([out.tolist()], pa.list_(pa.float64()))], names=["t"])

        parts = members.select("n_tokens", "posterior").mapInArrow(total, "t array<double>")
        # A task sends one row: one task adds them up, however many partitions the session's shuffles have.
        now = parts.repartition(1).select(F.posexplode("t")).groupBy("pos").agg(F.sum("col")).collect()
        got = np.zeros(size + size * size)
        for pos, x in now:
            got[pos] = x
        got, pairs = got[:size], got[size:].reshape(size, size)
        if every is None:
            share = np.array([targets.get(n, 0.0) for n in names])
            if got.sum() <= 0 or share.sum() <= 0:
                return [], 0.0
            asked = growth * got.sum() * share / share.sum()
            want, every = in_reach(asked, floor * got), pairs
        miss = float(np.abs(got - want).max() / want.sum())
        if miss < least:
            best, least, unmet = len(steps), miss, float(np.abs(got - asked).max() / asked.sum())
        if miss <= CLOSE or len(steps) == best + PATIENCE or len(steps) == STEPS:
            break
        steps.append(np.linalg.pinv(pairs + DAMPING * every, rcond=1e-9, hermitian=True) @ (got - want))
    return steps[:best], 0.0 if unmet <= CLOSE else unmet


def solved(docs: DataFrame, labelled: DataFrame, targets=None, floor=0.0, growth=1.0):
    """Broadcast (membership, steps, unmet), and the saved table doc_id, n_tokens, posterior; None where nothing can be learnt."""
    bounded(docs.sparkSession)
    source = texts(docs)
    membership = Membership(docs, labelled)
    if membership.model is None:
        return None, None
    shared = source.sparkSession.sparkContext.broadcast(membership)

    def score(batches):
        for batch in batches:
            n, p = shared.value.of(batch.column(1))
            ends = pa.array(np.arange(len(n) + 1) * p.shape[1], pa.int32())
            yield pa.record_batch([batch.column(0), pa.array(n), pa.ListArray.from_arrays(ends, pa.array(p.ravel()))], names=["doc_id", "n_tokens", "posterior"])

    members = saved(source.mapInArrow(score, "doc_id long, n_tokens long, posterior array<double>"), "members")
    steps, unmet = descend(members, membership.names, targets or TARGETS, floor, growth)
    return source.sparkSession.sparkContext.broadcast((membership, steps, unmet)), members


def rated(docs: DataFrame, labelled: DataFrame, targets=None, floor=0.0, growth=1.0) -> DataFrame:
    """doc_id, n_tokens, domain (likeliest), posterior (by domain name), rate, copies of every row of ``docs``, and what is unmet of the mix."""
    shared, members = solved(docs, labelled, targets, floor, growth)
    if members is None:
        words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
        return texts(docs).select("doc_id", words.cast("long").alias("n_tokens"), F.lit(None).cast("string").alias("domain"),
                                  F.lit(None).cast("map<string,double>").alias("posterior"), F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"), F.lit(0.0).alias("unmet"))
    names = shared.value[0].names

    def rate(batches):
        for batch in batches:
            p = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            r = rates(p, shared.value[1], floor)
            domain = pa.array([names[k] for k in p.argmax(1)], pa.string()) if batch.num_rows else pa.array([], pa.string())
            yield pa.record_batch([batch.column(0), batch.column(1), domain, batch.column(2), pa.array(r), pa.array(copies(batch.column(0), r))], names=["doc_id", "n_tokens", "domain", "posterior", "rate", "copies"])

    out = members.mapInArrow(rate, "doc_id long, n_tokens long, domain string, posterior array<double>, rate double, copies long")
    return out.withColumns({"posterior": F.map_from_arrays(F.array(*[F.lit(n) for n in names]), "posterior"), "unmet": F.lit(shared.value[2])})


def mixed(docs: DataFrame, labelled: DataFrame, targets=None, floor=0.0, growth=1.0) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its rate says. With ``floor`` 1 no document goes."""
    shared, members = solved(docs, labelled, targets, floor, growth)
    if members is None:
        return docs
    if shared.value[2]:
        warnings.warn(f"the mix misses a target by {shared.value[2]:.4f} of its tokens", RuntimeWarning, stacklevel=2)
    workers_see_package(docs.sparkSession)
    text, at = docs.columns.index("text"), docs.columns.index("doc_id")

    def repeat(batches):
        for batch in batches:
            membership, steps, _ = shared.value
            n = copies(batch.column(at), rates(membership.of(batch.column(text))[1], steps, floor))
            yield batch.take(pa.array(np.repeat(np.arange(batch.num_rows), n)))

    return docs.mapInArrow(repeat, docs.schema)


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, domain of the labelled documents: their language and their quality label."""
    own = labels.select(F.col("doc_id").alias("id"), "quality").dropna()
    return docs.select("doc_id", "lang").dropna().join(own, F.col("doc_id") == F.col("id")).select("doc_id", F.concat_ws(":", "lang", F.col("quality").cast("string")).alias("domain"))
