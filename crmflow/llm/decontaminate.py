"""Benchmark decontamination by latent semantic retrieval.

Terms are the words of the items (A-Z lowered, without trailing punctuation). The items are dealt into blocks of bounded size, and
a randomised SVD of a block's TF-IDF rows gives its latent space: each power step ``A'(A Q)`` is summed by term over Spark
tasks, and only the thin basis is orthonormalised on the driver. The rank is the block's number of items, so the space holds
every item whole. Document frequencies are counted over all documents; frequent terms weigh little, none weighs nothing.

A window is four strides of a text with one more on either side. Every window of every document is mapped to the latent space
and checked on its words by the longest common subsequence (LCS) of item and window. An item is found
if the LCS covers ``WHOLE`` of it, or ``PART`` of it with its answer: its last words, ``ANSWER`` of them in order. Two bounds that follow
from this rule save most checks and lose no window: the latent product with an item (the sum of its words' products) is at least the
weight of the lightest words with which the rule can hold (``least_mass``), and so many of the item's words, and of its answer's,
occur in the window. Each item has windows of its own length class, so long and short items are treated alike. Benchmark
tables are reference sets; they, the terms and the bases are sent to all tasks.

Nulls and empty texts have no windows, null or empty items are never found. Null doc_id: the row is searched and returned. Repeated
rows are each searched; ties between windows of a document: the largest LCS, then the first. Other columns are ignored.
"""
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts, workers_see_package
from crmflow.llm.textgrid import grids, span_keys, tails

STEPS = 3
#: Most items, and words of items, that share a latent space.
BLOCK_ITEMS, BLOCK_WORDS = 256, 1 << 14
WHOLE, PART, ANSWER, ANSWER_WORDS = 0.75, 0.5, 0.75, 8
#: Words with a term whose latent products a task holds at once.
SLICE = 1 << 15
#: Words of windows that are compared with items' words at once; items of more than ``MASKED`` words skip that bound.
GATHER, MASKED = 1 << 20, 512


def words(grid):
    """Keys of the words without trailing punctuation, their texts and the first word of each text."""
    cut = tails(grid)
    end = np.where(cut > grid.start, cut, grid.end)
    return span_keys(grid, grid.start, end), grid.doc, grid.first


def _keys_of(column):
    out = []
    for i, j, grid in grids(column, keys=False):
        key, _, first = words(grid)
        out += [key[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return out


def _items(benchmark: DataFrame):
    """Ids and word keys of the benchmark's items."""
    items = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long"), "text").distinct().orderBy("item_id", "text").toPandas()
    return items["item_id"].to_numpy(np.int64), _keys_of(pa.array(items["text"].tolist(), pa.string()))


def _frequencies(source: DataFrame, terms: np.ndarray):
    """Documents, and documents with each of the (sorted) terms, over all rows."""
    shared = source.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        terms = shared.value
        total, rows = np.zeros(len(terms) + 1, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for i, j, grid in grids(batch.column(0), keys=False):
                key, doc, _ = words(grid)
                at = np.minimum(np.searchsorted(terms, key), len(terms) - 1)
                hit = terms[at] == key
                pair = np.unique(doc[hit] * len(terms) + at[hit])
                total[:-1] += np.bincount(pair % len(terms), minlength=len(terms))
        total[-1] = rows
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["term", "n"])

    got = source.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(len(terms) + 1, np.int64)
    total[got["term"].to_numpy()] = got["n"].to_numpy()
    return int(total[-1]), total[:-1]


def orthonormal(columns: np.ndarray, rows: int = 1 << 13) -> np.ndarray:
    """An orthonormal basis of the columns' span from their Gram matrix, summed over blocks of rows in double precision."""
    gram = np.zeros((columns.shape[1],) * 2)
    for i in range(0, len(columns), rows):
        block = columns[i:i + rows].astype(np.float64)
        gram += block.T @ block
    value, vector = np.linalg.eigh(gram)
    kept = value > 1e-12 * max(value.max(initial=0), 1e-300)
    turn = vector[:, kept] / np.sqrt(value[kept])
    out = np.empty((len(columns), turn.shape[1]), np.float32)
    for i in range(0, len(columns), rows):
        out[i:i + rows] = columns[i:i + rows].astype(np.float64) @ turn
    return out


def randomised_basis(spark, passages: list, terms: int, rank: int, steps: int = STEPS) -> np.ndarray:
    """Orthonormal basis (terms x rank) of the main right singular directions of sparse rows [(places, weights)]."""
    rows = pd.DataFrame({"p": [p.astype(np.int32).tobytes() for p, _ in passages], "w": [w.astype(np.float64).tobytes() for _, w in passages]})
    rank = min(rank, terms, len(passages))
    if not rank:
        return np.zeros((terms, 0), np.float32)
    table = spark.createDataFrame(rows, "p binary, w binary").repartition(8)
    basis = np.random.default_rng(11).standard_normal((terms, rank)).astype(np.float32)
    for _ in range(steps):
        shared = spark.sparkContext.broadcast(basis)

        def step(frames):
            q = shared.value
            for frame in frames:
                rows = [(np.frombuffer(p, np.int32), np.frombuffer(w, np.float64)) for p, w in zip(frame["p"], frame["w"])]
                own = np.unique(np.concatenate([p for p, _ in rows])) if rows else np.empty(0, np.int32)
                total = np.zeros((len(own), q.shape[1]), np.float32)
                for p, w in rows:
                    total[np.searchsorted(own, p)] += np.outer(w, w @ q[p])
                yield pd.DataFrame({"t": own, "v": [v.tobytes() for v in total]})

        def add(frames):
            total = {}
            for frame in frames:
                for t, v in zip(frame["t"].tolist(), frame["v"]):
                    v = np.frombuffer(v, np.float32)
                    total[t] = total[t] + v if t in total else v
            names = np.fromiter(total, np.int32, len(total))
            for i in range(0, len(names), 1024):
                part = names[i:i + 1024]
                yield pd.DataFrame({"t": [part.tobytes()], "v": [b"".join(total[t].tobytes() for t in part.tolist())]})

        # The new columns take the old ones' place; terms that no passage has are 0.
        got = table.mapInPandas(step, "t int, v binary").repartition(8, "t").mapInPandas(add, "t binary, v binary").collect()
        basis = np.zeros((terms, basis.shape[1]), np.float32)
        while got:
            t, v = got.pop()
            t = np.frombuffer(t, np.int32)
            basis[t] = np.frombuffer(v, np.float32).reshape(len(t), -1)
        basis = orthonormal(basis)
        shared.unpersist()
    return basis


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, all of ``a`` in one integer's bits."""
    place = {}
    for i, x in enumerate(a):
        place[x] = place.get(x, 0) | (1 << i)
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b:
        if match := place.get(x):
            u = row & match
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def needed(item) -> tuple:
    """Words of the rule: of the item alone, of the item with its answer, of the answer; and the answer's length."""
    n, answer = len(item), min(len(item), ANSWER_WORDS)
    return tuple(int(np.ceil(x - 1e-9)) for x in (WHOLE * n, PART * n, ANSWER * answer)) + (answer,)


def least_mass(value) -> float:
    """The least sum of the values of an item's words (in order) with which the rule holds."""
    value = np.asarray(value, np.float64)
    whole, part, told, answer = needed(value)
    last = np.sort(value[len(value) - answer:])
    rest = np.sort(np.concatenate([value[:len(value) - answer], last[told:]]))
    return min(np.sort(value)[:whole].sum(), last[:told].sum() + rest[:max(0, part - told)].sum())


class Block:
    """Some of the items (places ``ids``) with their own terms and latent space."""

    def __init__(self, ids, items, terms, latent, vectors, least):
        self.ids, self.terms, self.latent = ids, terms, latent.astype(np.float32)
        self.vectors, self.norm = vectors.astype(np.float32), np.linalg.norm(vectors, axis=1)
        # Room for the rounding of single precision.
        self.least = 0.999 * np.asarray(least)
        self.classes, self.rule, self.products = {}, np.array([needed(x)[:3] for x in items]), {}
        for k, item in enumerate(items):
            if len(item):
                self.classes.setdefault(1 << int(np.ceil(np.log2(max(16, 1.5 * len(item))))), []).append(k)
        self.masks, self.answer = {}, {}
        for width, own in self.classes.items():
            # A window's latent product with an item is the sum of its words' products, formed here once.
            self.products[width] = self.latent @ self.vectors[own].T
            parts = -(-max(len(items[k]) for k in own) // 64)
            if parts <= MASKED // 64:
                # For each item and term a bit for each of its places in the item.
                mask, answer = np.zeros((parts, len(own), len(terms)), np.uint64), np.zeros((parts, len(own)), np.uint64)
                for y, k in enumerate(own):
                    for i, t in enumerate(np.searchsorted(terms, items[k]).tolist()):
                        mask[i // 64, y, t] |= np.uint64(1 << i % 64)
                        if i >= len(items[k]) - ANSWER_WORDS:
                            answer[i // 64, y] |= np.uint64(1 << i % 64)
                self.masks[width], self.answer[width] = mask, answer

    def enough(self, width, item, y, term, begin, end):
        """Which pairs of a window (its terms from ``begin`` to ``end``) and an item have the words that the rule needs."""
        if width not in self.masks:
            return np.ones(len(item), bool)
        out, step = np.empty(len(item), bool), max(1, GATHER * 2 // (3 * width))
        for i in range(0, len(item), step):
            a, n, who = begin[i:i + step], (end - begin)[i:i + step], y[i:i + step]
            first = np.cumsum(n) - n
            word = term[np.arange(int(n.sum())) + np.repeat(a - first, n)]
            row = np.repeat(who, n)
            have, told = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64)
            for mask, answer in zip(self.masks[width], self.answer[width]):
                bits = np.bitwise_or.reduceat(mask[row, word], first)
                have += np.bitwise_count(bits)
                told += np.bitwise_count(bits & answer[who])
            whole, part, least = self.rule[item[i:i + step]].T
            out[i:i + step] = (have >= whole) | ((have >= part) & (told >= least))
        return out

    def cosine(self, key, k):
        """Cosine of a window's words and an item in the latent space."""
        at = np.minimum(np.searchsorted(self.terms, key), len(self.terms) - 1)
        vector = self.latent[at[self.terms[at] == key]].sum(0)
        return float(vector @ self.vectors[k] / (np.linalg.norm(vector) * self.norm[k] + 1e-9))

    def candidates(self, key, first):
        """(text, place of the item in the block, begin and end word) of every window that passes the bounds."""
        at = np.minimum(np.searchsorted(self.terms, key), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == key)
        if not len(hit):
            return
        term, doc = at[hit], np.searchsorted(first, hit, "right") - 1
        for width, own in self.classes.items():
            own, stride = np.array(own), width // 4
            # A block is a stride of words of a text, a window six blocks in a row; only windows with terms need a look.
            block = (doc << 40) + (hit - first[doc]) // stride
            edge = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(hit))
            block = block[edge[:-1]]
            text = block >> 40 << 40
            start = np.unique(np.maximum(block[:, None] - np.arange(-1, 5), text[:, None]).ravel())
            low, high = np.searchsorted(block, np.maximum(start - 1, start >> 40 << 40)), np.searchsorted(block, start + 5)
            some = high > low
            start, low, high = start[some], low[some], high[some]
            d = start >> 40
            begin, i = first[d] + (start & ((1 << 40) - 1)) * stride, 0
            ends = edge[high]
            while i < len(start):
                # Windows over at most SLICE words with a term at once, so that long texts take no more memory than short ones.
                j = max(i + 1, min(i + SLICE // 4, int(np.searchsorted(ends, edge[low[i]] + SLICE, "right"))))
                a, b = low[i], high[j - 1]
                product, size = self.products[width], np.diff(edge[a:b + 1])
                blocks = product[term[edge[a:b]]]
                for n in range(1, int(size.max())):
                    more = np.flatnonzero(size > n)
                    blocks[more] += product[term[edge[a + more] + n]]
                total = np.zeros((b - a + 1, len(own)))
                np.cumsum(blocks, axis=0, out=total[1:])
                x, y = np.nonzero(total[high[i:j] - a] - total[low[i:j] - a] >= self.least[own])
                good = self.enough(width, own[y], y, term, edge[low[i + x]], edge[high[i + x]])
                for w, k in zip((i + x[good]).tolist(), own[y[good]].tolist()):
                    t, at = int(d[w]), int(begin[w])
                    yield t, k, max(int(first[t]), at - stride), min(int(first[t + 1]), at + width + stride)
                i = j


class Index:
    """What a task needs to search texts: the items and their blocks."""

    def __init__(self, ids, items, blocks):
        self.ids, self.items, self.blocks = ids, [x.tolist() for x in items], blocks

    def candidates(self, key, first):
        for block in self.blocks:
            for doc, k, begin, end in block.candidates(key, first):
                yield doc, int(block.ids[k]), begin, end, block, k

    def found(self, column):
        """Yields (text, item id, cosine, lcs share, answer found) for an Arrow column of texts, the best window of each pair."""
        for i, j, grid in grids(column, keys=False):
            key, _, first = words(grid)
            best = {}
            for doc, k, begin, end, block, place in self.candidates(key, first):
                item = self.items[k]
                near = key[begin:end].tolist()
                share = common_subsequence(item, near) / len(item)
                if share < PART:
                    continue
                answer = item[-ANSWER_WORDS:]
                told = common_subsequence(answer, near) >= ANSWER * len(answer)
                if (share >= WHOLE or told) and (share, told) > best.get((doc, k), (0, 0, 0))[1:]:
                    best[doc, k] = (block.cosine(key[begin:end], place), share, told)
            for (doc, k), (cosine, share, told) in sorted(best.items()):
                yield i + doc, int(self.ids[k]), cosine, share, bool(told)


def build(docs: DataFrame, benchmark: DataFrame):
    """The search index of a benchmark, weighted by all of ``docs``; a broadcast variable."""
    spark = docs.sparkSession
    source = texts(docs)
    ids, items = _items(benchmark)
    terms = np.unique(np.concatenate(items)) if items else np.empty(0, np.uint64)
    blocks = []
    if len(terms):
        rows, count = _frequencies(source, terms)
        weight = np.log((rows + 1) / (np.minimum(count, rows) + 0.5))
        held, size = [[]], 0
        for k, keys in enumerate(items):
            if len(keys):
                if held[-1] and (len(held[-1]) == BLOCK_ITEMS or size + len(keys) > BLOCK_WORDS):
                    held.append([])
                    size = 0
                held[-1].append(k)
                size += len(keys)
        blocks = [_block(spark, np.array(own), [items[k] for k in own], terms, weight) for own in held]
    return spark.sparkContext.broadcast(Index(ids, items, blocks))


def _block(spark, ids, items, terms, weight) -> Block:
    used = np.unique(np.concatenate(items))
    weight = weight[np.searchsorted(terms, used)]
    sparse, least = [], []
    for keys in items:
        at = np.searchsorted(used, keys)
        place, n = np.unique(at, return_counts=True)
        w = weight[place] * n
        sparse.append((place, w / np.linalg.norm(w)))
        least.append(least_mass(weight[at] ** 2 * n[np.searchsorted(place, at)]))
    basis = randomised_basis(spark, sparse, len(used), len(items))
    latent = weight.astype(np.float32)[:, None] * basis
    vectors = np.array([latent[np.searchsorted(used, keys)].sum(0, dtype=np.float64) for keys in items])
    return Block(ids, items, used, latent, vectors, least)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, lcs (share of the item's words), answer: one row for each document and item found in it."""
    index = build(docs, benchmark)

    def search(batches):
        for batch in batches:
            hits = list(index.value.found(batch.column(1)))
            if hits:
                at, item, cosine, share, told = zip(*hits)
                yield pa.record_batch([batch.column(0).take(pa.array(at)), pa.array(item), pa.array(cosine), pa.array(share), pa.array(told)], names=["doc_id", "item_id", "cosine", "lcs", "answer"])

    return texts(docs).mapInArrow(search, "doc_id long, item_id long, cosine double, lcs double, answer boolean")


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found; one pass, no join."""
    index = build(docs, benchmark)
    workers_see_package(docs.sparkSession)
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            good = np.ones(batch.num_rows, bool)
            good[[x[0] for x in index.value.found(batch.column(at))]] = False
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
