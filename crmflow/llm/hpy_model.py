"""Hierarchical Pitman-Yor language model (words, one word of context) and add-one unigram scores.

Each previous word is a context restaurant; all of them share one parent, the word restaurant, whose base is uniform over
the vocabulary and one unknown word. Seatings are sampled by Gibbs: in each sweep the customers of a dish leave their
restaurant and sit down again, one by one, at an old table or at a new one; a new one has the weight (strength + discount *
all tables of the restaurant) * the parent's probability of the dish, the dish's own new tables included. All dishes of a
sweep are seated at once, against the other dishes' tables of the sweep before. After ``BURN`` sweeps the tables are averaged
over ``SWEEPS`` more; as predictions are linear in the tables, that averages the predictive probabilities. The parent's
customers are the tables of all contexts: before each sweep they are summed by word over all buckets, seated in the same way,
and the parent's probabilities are sent back to the buckets. For every context the probabilities of all words sum to one.

Draws follow from context, word, sweep and customer alone (a hash of them), and all sums are of whole numbers: the same rows
have the same scores in any order, number of partitions and layout. Where new tables are rare, customers who join old ones
are counted in one draw, by the exact law of the wait for the next new table.

How it is spread: texts are cut into chunks of about ``CHUNK_TOKENS`` tokens, kept as word numbers with the chunk's word table. A
chunk sends its distinct word pairs with their training counts, as packed arrays, to the bucket of the context (contexts that a
bounded sample of documents shows to be frequent are split into parts by the word, for the layout only: the tables of all parts are
summed in Spark after each sweep). A bucket merges all chunks and keeps where each chunk's pairs are; each sweep is a shuffle of table
sums to word buckets and one back. There are as many word buckets as the root of the number of buckets. At the end a bucket
sends to each chunk one number a pair and the customers and tables of each context. Words go to the word buckets and
back likewise, with exact counts. So what is gathered is in proportion to the distinct words and pairs of each chunk.
Words are 64-bit keys throughout; packed pairs name them by their place in a table of the row's words.

Nulls and empty texts: the end token alone. Null doc_id: scored, not learnt from, held_out true. Repeated rows are each learnt and
scored. No training rows: counts 0, V 0, uniform probability of one unknown word. No documents: no rows. Texts are never cut;
one longer than ``CHUNK_TOKENS`` is a chunk of its own. Ties do not arise. Other columns are ignored.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import dropped, saved, spread, texts
from crmflow.llm.textgrid import grids, mix

DISCOUNT, STRENGTH, PARENT_DISCOUNT, PARENT_STRENGTH = 0.75, 1.0, 0.75, 1.0
BURN, SWEEPS = 2, 4
CHUNK_TOKENS = 2_500_000
#: Customers of a dish who sit down one at a time; customers a table from which on waits are drawn; customers seated at once.
FEW, RARE, SEATED = 32, 32, 1 << 19
SAMPLE_DOCS, HOT_SHARE = 2000, 0.002
#: Marks of rows that aren't from chunks, and the first seed after those of the sweeps.
OFFER, PAST, LAST = -1, -2, 1000
END, START = np.uint64(0x1234567), np.uint64(0x7654321)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def packed(x, kind) -> bytes:
    """The bytes of an array, compressed, after their number."""
    raw = np.ascontiguousarray(x, dtype=kind).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpacked(raw, kind):
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], decompressed_size=n, codec="zstd", asbytes=True) if n else b"", kind)


def coded(x) -> bytes:
    """Whole numbers below 2**32, as four byte planes, which compress well."""
    return packed(np.ascontiguousarray(x, "<u4").view(np.uint8).reshape(-1, 4).T, np.uint8)


def decoded(raw):
    return np.ascontiguousarray(unpacked(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


STATE = "chunk long, doc_ids array<long>, lengths binary, train binary, words binary, low binary, mid binary, high binary, trained long"


def _state(chunk, ids, lengths, train, keys):
    """A chunk as a row: its documents, its word table (frequent words first), and word numbers in three byte planes."""
    words, number, count = np.unique(np.concatenate([*keys, [START, END]]), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words))
    words, number = words[order], rank[number[:-2]]
    lengths, train = np.concatenate(lengths), np.concatenate(train)
    planes = [packed((number >> np.uint32(s)) & np.uint32(255), np.uint8) for s in (0, 8, 16)]
    if len(words) > 1 << 24:
        raise ValueError("a chunk has more words than its number planes hold")
    row = [chunk, ids, packed(lengths, "<i8"), packed(train, np.int8), words.tobytes(), *planes, int((lengths * train).sum())]
    kinds = [pa.int64(), pa.list_(pa.int64()), *(pa.binary(),) * 6, pa.int64()]
    return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=[x.split()[0] for x in STATE.split(", ")])


def _chunks(batches):
    from pyspark import TaskContext

    part, count = TaskContext.get().partitionId(), 0
    ids, lengths, train, keys, size = [], [], [], [], 0
    for batch in batches:
        learn = batch.column(2).to_numpy(zero_copy_only=False)
        for i, j, grid in grids(batch.column(1)):
            ends = grid.first[1:]
            keys.append(np.insert(grid.key, ends, END))
            lengths.append(grid.words + 1)
            train.append(learn[i:j].astype(np.int64))
            ids += batch.column(0).slice(i, j - i).to_pylist()
            size += len(grid.key) + j - i
            if size >= CHUNK_TOKENS:
                yield _state((part << 24) + count, ids, lengths, train, keys)
                count += 1
                ids, lengths, train, keys, size = [], [], [], [], 0
    if ids:
        yield _state((part << 24) + count, ids, lengths, train, keys)


class Chunk:
    """A chunk read back: tokens, pairs, and where each pair's seat group goes. Twice the same for the same row and layout."""

    def __init__(self, row, hot, buckets, vocabulary_only=False):
        self.lengths = unpacked(row["lengths"], "<i8")
        self.words = np.frombuffer(row["words"], np.uint64)
        word = np.zeros(int(self.lengths.sum()), np.int32)
        for shift, plane in ((0, "low"), (8, "mid"), (16, "high")):
            word |= unpacked(row[plane], np.uint8).astype(np.int32) << shift
        self.word, n = word, len(self.words)
        self.learnt = np.repeat(unpacked(row["train"], np.int8), self.lengths)
        if vocabulary_only:
            return
        code = np.empty(len(word), np.int64)
        code[1:] = word[:-1]
        code[np.cumsum(self.lengths) - self.lengths] = np.flatnonzero(self.words == START)[0]
        code *= n
        code += word
        code, pair = np.unique(code, return_inverse=True)
        self.pair = pair.astype(np.int32)
        del pair
        self.left, self.right = (code // n).astype(np.int32), (code % n).astype(np.int32)
        del code
        self.count = np.bincount(self.pair, weights=self.learnt, minlength=len(self.left)).astype(np.int64)
        # Seat groups: contexts, or what a bucket has of the parts of frequent ones. Every part is asked, with or without pairs.
        parts = np.ones(n, np.int64)
        at = _context_of(self.words, hot)
        parts[at >= 0] = hot[1][at[at >= 0]]
        part = (mix(self.words[self.right]) >> np.uint64(33)).astype(np.int64) % parts[self.left]
        used = np.flatnonzero(np.bincount(self.left, minlength=n))
        groups = np.repeat(used, parts[used])
        first = np.zeros(n, np.int64)
        first[used] = np.cumsum(parts[used]) - parts[used]
        group_part = np.arange(len(groups)) - first[groups]
        bucket = (mix(mix(self.words[groups]) + group_part.astype(np.uint64) * GOLDEN) >> np.uint64(24)).astype(np.int64) % buckets
        by_key = np.argsort(self.words)
        rank = np.empty(n, np.int64)
        rank[by_key] = np.arange(n)
        self.sorted_words = self.words[by_key]
        code, place = np.unique(bucket * n + rank[groups], return_inverse=True)
        self.group_left, self.group_bucket = by_key[code % n], code // n
        place = place[first[self.left] + part]
        self.pair_order = np.argsort(place * n + rank[self.right])
        self.pair_group, self.pair_rank = place[self.pair_order], rank[self.right[self.pair_order]]
        self.edges = np.searchsorted(self.group_bucket, np.arange(buckets + 1))

    def requests(self):
        """(bucket, contexts, pairs of each, table of the pairs' words, words of the pairs by their place in it, training counts)."""
        count = self.count[self.pair_order]
        own, number = np.zeros(len(self.words), bool), np.empty(len(self.words), np.int64)
        for b in np.flatnonzero(np.diff(self.edges)):
            low, high = self.edges[b], self.edges[b + 1]
            x, y = np.searchsorted(self.pair_group, [low, high])
            size = np.bincount(self.pair_group[x:y] - low, minlength=high - low)
            own[:] = False
            own[self.pair_rank[x:y]] = True
            table = np.flatnonzero(own)
            number[table] = np.arange(len(table))
            yield int(b), self.words[self.group_left[low:high]].tobytes(), coded(size), self.sorted_words[table].tobytes(), coded(number[self.pair_rank[x:y]]), coded(count[x:y])


def rise(x, w):
    """log gamma(x + w) - log gamma(x) for x > 0, w >= 0, by Stirling's series eight steps up."""
    y, z, product = x + 8, x + 8 + w, np.ones(len(x))
    for k in range(8):
        product *= 1 + w / (x + k)
    return (y - 0.5) * np.log1p(w / y) + w * (np.log(z) - 1) + (1 / z - 1 / y) / 12 - (z ** -3 - y ** -3) / 360 - np.log(product)


def uniform(key, counter):
    """Numbers between 0 and 1 that follow from 64-bit keys and counters."""
    return ((mix(key + (counter.astype(np.uint64) + np.uint64(1)) * GOLDEN) >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def _threshold(u, k, first, more, discount):
    """The least number of tables above which a customer with draw ``u`` opens one: u < w / (w + k - discount * t) with
    w = first + more * t, solved for t."""
    return (u * k - (1 - u) * first) / ((1 - u) * more + u * discount)


def _each(tables, start, end, first, more, discount, key):
    """Tables after the customers ``start`` to ``end`` of each dish have sat down, every customer with a draw of its own.

    The tables met by a customer are those of the dish before plus the ones opened by earlier customers. From any guess of them
    follows who opens a table, and from that the next guess; the first customers are right at once, and what no longer
    changes is the walk one by one.
    """
    size = (end - start).astype(np.int64)
    edge = np.cumsum(size)
    low = edge - size
    place = np.arange(int(edge[-1])) - np.repeat(low, size)
    dish = np.repeat(np.arange(len(size)), size)
    k = start[dish] + place
    limit = _threshold(uniform(key[dish], k), k, first[dish], more[dish], discount)
    w = first + more * tables
    met = tables[dish] + np.floor((w / (w + start - discount * tables))[dish] * place)
    opens = met > limit
    total = np.zeros(len(opens) + 1)
    while True:
        np.cumsum(opens, out=total[1:])
        met = (tables - total[low])[dish] + total[:-1]
        now = met > limit
        if np.array_equal(now, opens):
            return tables + total[edge] - total[low]
        opens = now


def _waits(tables, start, end, first, more, discount, key):
    """As ``_each`` for dishes that seldom open a table: one draw gives the wait for the next.

    That m customers in a row open none has the probability gamma(a + m) gamma(a + w) / (gamma(a) gamma(a + m + w)) with
    a = k - discount * t.
    """
    tables, seated, live = tables.copy(), start.astype(np.float64), np.arange(len(tables))
    while len(live):
        t, left = tables[live], end[live] - seated[live]
        w, a = first[live] + more[live] * t, seated[live] - discount * t
        level = rise(a, w) - np.log(uniform(key[live], seated[live]))
        opens = np.flatnonzero(rise(a + left, w) >= level)
        live, left, w, a, level = live[opens], left[opens], w[opens], a[opens], level[opens]
        # The wait lies from low (possible) to below high (not); near a * (u ** (-1 / w) - 1) in most cases.
        low, high = np.zeros(len(live)), left.copy()
        with np.errstate(over="ignore"):
            guess = a * np.expm1(np.minimum((level - rise(a, w)) / w, 700))
        for probe in (0.9 * guess - 2, 1.1 * guess + 2):
            probe = np.clip(np.floor(probe), low, high)
            shorter = rise(a + probe, w) >= level
            low, high = np.where(shorter, low, probe), np.where(shorter, np.minimum(high, probe), high)
        some = np.flatnonzero(high - low > 1)
        while len(some):
            probe = np.floor((low[some] + high[some]) / 2)
            shorter = rise(a[some] + probe, w[some]) >= level[some]
            high[some[shorter]], low[some[~shorter]] = probe[shorter], probe[~shorter]
            some = some[high[some] - low[some] > 1]
        seated[live] += low + 1
        tables[live] += 1
        live = live[end[live] > seated[live]]
    return tables


def seat(customers, others, strength, discount, parent, key):
    """Tables of dishes whose customers sit down one by one, each with the draws of its ``key``; 0 < discount < 1.

    With k customers at t tables the next one opens a table with weight w = (strength + discount * (others + t)) * parent
    against k - discount * t for the old ones; ``others`` counts the restaurant's tables of other dishes. The first
    ``FEW`` customers sit down one at a time in all dishes at once, then as many as sit already, by a draw for each customer.
    Large dishes in which a new table is rarer than one in ``RARE`` customers go on by a draw for each wait. All have the law of one by one.
    """
    shape = len(customers)
    tables = np.minimum(customers, 1).astype(np.float64)
    live = np.flatnonzero(customers > 1)
    live = live[np.argsort(-customers[live], kind="stable")]
    parent, others = np.broadcast_to(parent, shape)[live], np.broadcast_to(others, shape)[live]
    first, more, key, end = (strength + discount * others) * parent, np.asarray(discount * parent), key[live], customers[live].astype(np.float64)
    t = np.ones(len(live))

    def rare(own, start):
        """Seats the dishes that seldom open a table to their ends; the others, in order."""
        w = first[own] + more[own] * t[own]
        seldom = w * RARE < w + start - discount * t[own]
        some = own[seldom]
        t[some] = _waits(t[some], np.full(len(some), start), end[some], first[some], more[some], discount, key[some])
        return own[~seldom]

    # Dishes lie by their customers, the ones still open in front.
    large = int(np.searchsorted(-end, -FEW, "left"))
    own = np.concatenate([rare(np.arange(large), 1), np.arange(large, len(end))])
    few = [x[own] for x in (t, first, more, key, end)]
    n = len(own)
    for k in range(1, FEW):
        n = int(np.searchsorted(-few[4][:n], -k, "left"))
        few[0][:n] += few[0][:n] > _threshold(uniform(few[3][:n], np.full(n, k)), k, few[1][:n], few[2][:n], discount)
    t[own] = few[0]
    start = FEW
    while len(own := own[end[own] > start]):
        own = rare(own, start)
        # No more than SEATED customers at once, however many a dish has.
        for i in range(start, 2 * start, SEATED):
            some = own[end[own] > i]
            stop = np.minimum(end[some], min(2 * start, i + SEATED))
            total = np.cumsum(stop - i)
            cut = np.unique(np.searchsorted(total, np.arange(SEATED, total[-1], SEATED))) if len(some) else []
            for o, last in zip(np.split(some, cut), np.split(stop, cut)):
                if len(o):
                    t[o] = _each(t[o], np.full(len(o), float(i)), last, first[o], more[o], discount, key[o])
        start *= 2
    tables[live] = t
    return tables


def parent_chance(weight, customers, tables, known):
    """The parent's probability of words of these weights (customers less discounted tables; 0: never learnt)."""
    return (weight + (PARENT_STRENGTH + PARENT_DISCOUNT * tables) / (known + 1)) / (PARENT_STRENGTH + customers)


def chance(weight, customers, tables, parent):
    """The probability of words of these weights in a context of so many customers and tables."""
    return (weight + (STRENGTH + DISCOUNT * tables) * parent) / (STRENGTH + customers)


SEATS = "bucket int, groups binary, sizes binary, words binary, pairs binary, counts binary, tables binary, total binary, hot array<double>"
LINKS = "chunk long, places binary, entries binary"


def _context_of(groups, hot):
    """Place of each context among the frequent ones, or -1."""
    if not len(hot[0]):
        return np.full(len(groups), -1)
    at = np.minimum(np.searchsorted(hot[0], groups), len(hot[0]) - 1)
    return np.where(hot[0][at] == groups, at, -1)


def _hot_tables(groups, owner, tables, hot) -> list:
    """Tables of each frequent context in a bucket."""
    mine = _context_of(groups, hot)
    whole = np.bincount(owner, weights=tables, minlength=len(groups))
    return np.bincount(mine[mine >= 0], weights=whole[mine >= 0], minlength=len(hot[0])).tolist()


def _first_seats(bucket, rows, hot):
    """A bucket's requests merged, with one table for each learnt pair; then, for each chunk, the places of its contexts and pairs."""
    keys, sizes = [np.frombuffer(r["groups"], np.uint64) for r in rows], [decoded(r["sizes"]) for r in rows]
    tables = [np.frombuffer(r["words"], np.uint64) for r in rows]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    words, number = np.unique(np.concatenate(tables), return_inverse=True)
    start = np.cumsum([0, *map(len, tables)])
    number = np.concatenate([number[s + decoded(r["pairs"])] for s, r in zip(start.tolist(), rows)])
    code, entry = np.unique(np.repeat(place, np.concatenate(sizes)) * len(words) + number, return_inverse=True)
    total = np.bincount(entry, weights=np.concatenate([decoded(r["counts"]) for r in rows]), minlength=len(code)).astype(np.int64)
    owner, number, one = code // len(words), code % len(words), np.minimum(total, 1)
    yield (bucket, every.tobytes(), coded(np.bincount(owner, minlength=len(every))), words.tobytes(), coded(number), coded(total),
           coded(one), coded(0 * one), _hot_tables(every, owner, one, hot), None, None, None)
    at, group_at = 0, 0
    for r, k, s in zip(rows, keys, sizes):
        n, g = int(s.sum()), len(k)
        # Both ascend within a request: differences are small.
        yield (bucket, *(None,) * 8, r["chunk"], coded(np.diff(place[group_at:group_at + g], prepend=0)), coded(np.diff(entry[at:at + n], prepend=0)))
        at, group_at = at + n, group_at + g


def word_bucket(words, buckets):
    return (mix(words) >> np.uint64(24)).astype(np.int64) % buckets


def _learnt_by_bucket(row, buckets):
    """Word table and word places of a bucket's pairs, and the learnt words' places in the table by word bucket."""
    words, number = np.frombuffer(row["words"], np.uint64), decoded(row["pairs"])
    learnt = np.flatnonzero(np.bincount(number, weights=decoded(row["counts"]), minlength=len(words)))
    home = word_bucket(words[learnt], buckets)
    order = np.argsort(home, kind="stable")
    return words, number, learnt[order], home[order]


def _offered(row, buckets, column):
    """(word bucket, bucket, words, sums of their tables) of a bucket."""
    words, number, own, home = _learnt_by_bucket(row, buckets)
    total = np.bincount(number, weights=decoded(row[column]), minlength=len(words))[own]
    edges = np.searchsorted(home, np.arange(buckets + 1))
    for v in np.flatnonzero(np.diff(edges)):
        x, y = edges[v], edges[v + 1]
        yield int(v), row["bucket"], words[own[x:y]].tobytes(), packed(total[x:y], "<f8")


def _summed(rows):
    """Sorted words of all rows, and the sums of their numbers."""
    words = [np.frombuffer(r["words"], np.uint64) for r in rows]
    every = np.unique(np.concatenate([np.empty(0, np.uint64), *words]))
    total = np.zeros(len(every))
    for r, w in zip(rows, words):
        total[np.searchsorted(every, w)] += unpacked(r["sums"], "<f8")
    return every, total


def _seated_parent(every, customers, before, tables, known, seed):
    """Parent tables of words; ``before`` are theirs and ``tables`` those of all words after the sweep before."""
    return seat(customers, tables - before, PARENT_STRENGTH, PARENT_DISCOUNT, 1 / (known + 1), mix(every + np.uint64((seed + 1) * int(GOLDEN) % (1 << 64))))


def _parent(v, rows, tables, known, seed):
    """Seats all contexts' tables of a bucket's words at the parent: its own row (bucket -1), then an answer to each bucket.

    ``rows`` begin with its row of the sweep before; at the start ``tables`` is None and each word has one table.
    """
    past, rows = [r for r in rows if r["bucket"] < 0], [r for r in rows if r["bucket"] >= 0]
    every, customers = _summed(rows)
    if tables is None:
        now = np.minimum(customers, 1)
    else:
        now = _seated_parent(every, customers, unpacked(past[0]["sums"], "<f8"), tables, known, seed)
    yield -1, v, every.tobytes(), packed(now, "<f8"), int((customers > 0).sum()), int(customers.sum()), float(now.sum())
    weight = customers - PARENT_DISCOUNT * now
    for r in rows:
        yield r["bucket"], v, None, packed(weight[np.searchsorted(every, np.frombuffer(r["words"], np.uint64))], "<f8"), 0, 0, 0.0


def _swept(row, answers, buckets, hot, whole_hot, known, customers, tables, seed, averaged):
    """A bucket's seats after one more sweep; ``answers`` are the parent's weights by word bucket."""
    groups, size = np.frombuffer(row["groups"], np.uint64), decoded(row["sizes"])
    owner, count, now = np.repeat(np.arange(len(groups)), size), decoded(row["counts"]), decoded(row["tables"])
    words, number, own, _ = _learnt_by_bucket(row, buckets)
    parent = np.zeros(len(words))
    if answers:
        parent[own] = np.concatenate([unpacked(a, "<f8") for a in answers])
    parent = parent_chance(parent, customers, tables, known)
    whole, mine = np.bincount(owner, weights=now, minlength=len(groups)), _context_of(groups, hot)
    whole[mine >= 0] = whole_hot[mine[mine >= 0]]
    key = mix(mix(groups)[owner] + words[number]) + np.uint64(seed) * mix(words)[number]
    now = seat(count, whole[owner] - now, STRENGTH, DISCOUNT, parent[number], key).astype(np.int64)
    total = coded(decoded(row["total"]) + now) if averaged else row["total"]
    return (*(row[k] for k in ("bucket", "groups", "sizes", "words", "pairs", "counts")), coded(now), total, _hot_tables(groups, owner, now, hot))


def _merged(row, links):
    """One bucket's answer to each chunk: weights of its pairs, customers and tables of its contexts."""
    size, total, tables = decoded(row["sizes"]), decoded(row["counts"]), decoded(row["total"]) / SWEEPS
    owner = np.repeat(np.arange(len(size)), size)
    customers, group_tables = (np.bincount(owner, weights=x, minlength=len(size)) for x in (total, tables))
    weight = total - DISCOUNT * tables
    for r in links:
        own, entry = np.cumsum(decoded(r["places"])), np.cumsum(decoded(r["entries"]))
        yield r["chunk"], r["bucket"], packed(weight[entry], "<f4"), packed(customers[own], "<i8"), packed(group_tables[own], "<f4")


def _by(batches, key):
    """Rows of one value of ``key`` at a time, from batches sorted by it."""
    held, value = [], None
    for batch in batches:
        # Row by row: a batch may hold many packed arrays.
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if held and row[key] != value:
                yield value, held
                held = []
            value = row[key]
            held.append(row)
    if held:
        yield value, held


def _table(rows, names, kinds):
    rows = list(rows)
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _frequent(source: DataFrame, buckets: int):
    """Sorted keys of words that are frequent in a bounded sample, and into how many parts their contexts are cut."""
    chosen = source.select(F.col("doc_id").alias("id")).where("id is not null").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)

    def count(batches):
        for batch in batches:
            for _, _, grid in grids(batch.column(0)):
                key, n = np.unique(grid.key, return_counts=True)
                top = n >= max(2, HOT_SHARE / 4 * n.sum())
                yield pa.record_batch([pa.array(np.append(key[top], np.uint64(0)).view(np.int64)), pa.array(np.append(n[top], n.sum()))], names=["w", "n"])

    got = source.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"), "left_semi").select("text").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n")).limit(int(4 / HOT_SHARE)).toPandas()
    total = got.loc[got["w"] == 0, "n"].sum()
    hot = got[(got["w"] != 0) & (got["n"] >= HOT_SHARE * total)]
    key = hot["w"].to_numpy(np.int64).view(np.uint64)
    parts = np.ceil(hot["n"].to_numpy(float) / max(1, total) * buckets * 2).astype(np.int64)
    # The start of a text is a context too: once in each document.
    order = np.argsort(key)
    return key[order], np.maximum(1, parts[order])


def scored(docs: DataFrame, train: str) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; ``train`` is SQL over doc_id: rows to learn from."""
    source = texts(docs)
    spark = source.sparkSession
    buckets = spread(source)
    word_buckets = int(np.ceil(np.sqrt(buckets)))
    names, binary = [x.split()[0] for x in SEATS.split(", ")], pa.binary()
    seat_kinds = [pa.int32(), *(binary,) * 7, pa.list_(pa.float64())]
    state = saved(source.select("doc_id", "text", F.expr(f"coalesce({train}, false)").alias("train")).mapInArrow(_chunks, STATE), "chunks")
    trained = state.agg(F.sum("trained")).first()[0] or 0
    hot = spark.sparkContext.broadcast(_frequent(source, buckets))

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for r in Chunk(row, hot.value, buckets).requests():
                    yield _table([(row["chunk"], *r)], ["chunk", "bucket", "groups", "sizes", "words", "pairs", "counts"], [pa.int64(), pa.int32(), *(binary,) * 5])

    def first(batches):
        for b, rows in _by(batches, "bucket"):
            for r in _first_seats(b, rows, hot.value):
                yield _table([r], [*names, "chunk", "places", "entries"], [*seat_kinds, pa.int64(), binary, binary])

    def offer(column):
        def offer(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    for r in _offered(batch.slice(k, 1).to_pylist()[0], word_buckets, column):
                        yield _table([r], ["v", "bucket", "words", "sums"], [pa.int32(), pa.int32(), binary, binary])
        return offer

    def parent(*given):
        def parent(batches):
            for v, rows in _by(batches, "v"):
                for r in _parent(v, rows, *given):
                    yield _table([r], ["bucket", "v", "words", "sums", "known", "customers", "all_tables"], [pa.int32(), pa.int32(), binary, binary, pa.int64(), pa.int64(), pa.float64()])
        return parent

    def sweep(*given):
        def sweep(batches):
            for _, rows in _by(batches, "bucket"):
                yield _table([_swept(rows[0], [r["sums"] for r in rows[1:]], word_buckets, hot.value, *given)], names, seat_kinds)
        return sweep

    def sample(batches):
        for _, rows in _by(batches, "bucket"):
            for chunk, b, *r in _merged(rows[0], rows[1:]):
                yield _table([(chunk, 0, b, *r)], ["chunk", "kind", "bucket", "a", "b", "c"], [pa.int64(), pa.int32(), pa.int32(), *(binary,) * 3])

    def ask_words(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, hot.value, buckets, vocabulary_only=True)
                count = np.bincount(chunk.word, weights=chunk.learnt, minlength=len(chunk.words))
                home = word_bucket(chunk.words, word_buckets)
                order = np.argsort(home, kind="stable")
                edges = np.searchsorted(home[order], np.arange(word_buckets + 1))
                for v in np.flatnonzero(np.diff(edges)):
                    own = order[edges[v]:edges[v + 1]]
                    yield _table([(int(v), row["chunk"], chunk.words[own].tobytes(), packed(count[own], "<f8"))], ["v", "chunk", "words", "sums"], [pa.int32(), pa.int64(), binary, binary])

    def count_words(total, distinct):
        def count_words(batches):
            for v, rows in _by(batches, "v"):
                own, past, rows = ([r for r in rows if x(r["chunk"])] for x in (lambda c: c == OFFER, lambda c: c == PAST, lambda c: c >= 0))
                every, count = _summed(rows)
                weight, sums = np.zeros(len(every)), (0, 0, 0.0)
                if own:
                    # The contexts' averaged tables sit down at the parent once more, averaged in their turn.
                    words, customers = _summed(own)
                    customers = np.rint(customers / SWEEPS).astype(np.int64)
                    before, tables = unpacked(past[0]["sums"], "<f8"), np.zeros(len(words))
                    for k in range(SWEEPS):
                        tables += _seated_parent(words, customers, before, total, distinct, LAST + k) / SWEEPS
                    weight[np.searchsorted(every, words)] = customers - PARENT_DISCOUNT * tables
                    sums = (int((count > 0).sum()), int(customers.sum()), float(tables.sum()))
                for k, r in enumerate(rows):
                    at = np.searchsorted(every, np.frombuffer(r["words"], np.uint64))
                    yield _table([(r["chunk"], 1, v, packed(count[at], "<i8"), packed(weight[at], "<f8"), b"", *(sums if k == 0 else (0, 0, 0.0)))],
                                 ["chunk", "kind", "bucket", "a", "b", "c", "known", "customers", "tables"], [pa.int64(), pa.int32(), pa.int32(), *(binary,) * 3, pa.int64(), pa.int64(), pa.float64()])
        return count_words

    answer = "chunk long, kind int, bucket int, a binary, b binary, c binary"
    asked = state.mapInArrow(ask, "chunk long, bucket int, groups binary, sizes binary, words binary, pairs binary, counts binary")
    begun = saved(asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(first, f"{SEATS}, {LINKS}"), "seats")
    links = begun.where("chunk is not null").select("bucket", "chunk", "places", "entries")
    seats, told, tables, known = begun.where("chunk is null").select(*names), None, None, 0
    for k in range(BURN + SWEEPS):
        sums = seats.mapInArrow(offer("tables"), "v int, bucket int, words binary, sums binary")
        if told is not None:
            sums = sums.unionByName(told.where("bucket < 0").select("v", "bucket", "words", "sums"))
        sums = sums.repartition(buckets, "v").sortWithinPartitions("v", "bucket")
        past, told = told, saved(sums.mapInArrow(parent(tables, known, 2 * k), "bucket int, v int, words binary, sums binary, known long, customers long, all_tables double"), "parent")
        if k:
            dropped(past)
        known, customers, tables = (x or 0 for x in told.agg(F.sum("known"), F.sum("customers"), F.sum("all_tables")).first())
        whole = np.zeros(len(hot.value[0]))
        # At most 1 / HOT_SHARE frequent contexts.
        for place, n in seats.select(F.posexplode("hot")).groupBy("pos").agg(F.sum("col")).collect():
            whole[place] = n
        both = seats.withColumn("v", F.lit(-1)).unionByName(told.where("bucket >= 0").select("bucket", "v", "sums"), allowMissingColumns=True)
        both = both.repartition(buckets, "bucket").sortWithinPartitions("bucket", "v")
        swept = saved(both.mapInArrow(sweep(whole, known, customers, tables, 2 * k + 1, k >= BURN), SEATS), "seats")
        if k:
            dropped(seats)
        else:
            # Of the first table only the links are read again.
            links = saved(links, "links")
            dropped(begun)
        seats = swept
    offers = "v int, chunk long, words binary, sums binary"
    sums = seats.mapInArrow(offer("total"), "v int, bucket int, words binary, sums binary").select("v", F.lit(OFFER).cast("long").alias("chunk"), "words", "sums")
    sums = sums.unionByName(told.where("bucket < 0").select("v", F.lit(PAST).cast("long").alias("chunk"), "words", "sums"))
    words = state.mapInArrow(ask_words, offers).unionByName(sums).repartition(buckets, "v").sortWithinPartitions("v", "chunk")
    words = saved(words.mapInArrow(count_words(tables, known), answer + ", known long, customers long, tables double"), "words")
    dropped(told)
    known, customers, tables = (x or 0 for x in words.agg(F.sum("known"), F.sum("customers"), F.sum("tables")).first())
    pairs = seats.unionByName(links, allowMissingColumns=True).repartition(buckets, "bucket").sortWithinPartitions("bucket", F.col("chunk").asc_nulls_first()).mapInArrow(sample, answer)

    def finish(batches):
        for _, rows in _by(batches, "chunk"):
            rows.sort(key=lambda r: (r["kind"], r["bucket"]))
            chunk, ids = Chunk(rows[-1], hot.value, buckets), rows[-1]["doc_ids"]
            n = len(chunk.words)
            own = [r for r in rows if r["kind"] == 0]
            weight = np.empty(len(chunk.left))
            weight[chunk.pair_order] = np.concatenate([unpacked(r["a"], "<f4") for r in own])
            # Parts of a context are summed.
            context_customers = np.bincount(chunk.group_left, weights=np.concatenate([unpacked(r["b"], "<i8") for r in own]), minlength=n)
            context_tables = np.bincount(chunk.group_left, weights=np.concatenate([unpacked(r["c"], "<f4") for r in own]), minlength=n)
            own = [r for r in rows if r["kind"] == 1]
            order = np.argsort(word_bucket(chunk.words, word_buckets), kind="stable")
            count, parent = np.zeros(n, np.int64), np.zeros(n)
            count[order] = np.concatenate([unpacked(r["a"], "<i8") for r in own])
            parent[order] = np.concatenate([unpacked(r["b"], "<f8") for r in own])
            parent = parent_chance(parent, customers, tables, known)
            left = chunk.left
            score = np.log10(chance(weight, context_customers[left], context_tables[left], parent[chunk.right]))[chunk.pair]
            base = np.log10((count + 1) / (trained + known + 1))[chunk.word]
            doc = np.repeat(np.arange(len(chunk.lengths)), chunk.lengths)
            out = [np.bincount(doc, weights=x, minlength=len(chunk.lengths)) for x in ((count > 0)[chunk.word], base, score)]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(chunk.lengths), pa.array(out[0].astype(np.int64)), pa.array(out[1]), pa.array(out[2])], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    nothing = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in STATE.split(", ")[1:]]
    answers = pairs.unionByName(words.select("chunk", "kind", "bucket", "a", "b", "c")).select("*", *nothing)
    kept = state.select("chunk", F.lit(2).alias("kind"), F.lit(0).alias("bucket"), *[F.lit(None).cast("binary").alias(x) for x in "abc"], *[x.split()[0] for x in STATE.split(", ")[1:]])
    together = answers.unionByName(kept).repartition(buckets, "chunk").sortWithinPartitions("chunk", "kind", "bucket")
    out = together.mapInArrow(finish, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(int(trained)).cast("long"))


def seventh_scores(docs: DataFrame) -> DataFrame:
    """Scores by a model of the rows whose doc_id has a crc32 that isn't 2 modulo 7, and their perplexity."""
    rule = "pmod(crc32(cast(doc_id as string)), 7) <> 2"
    out = scored(docs, rule)
    return out.select("doc_id", F.expr(f"not coalesce({rule}, false)").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                      F.expr("pow(10, -score / n_tokens)").alias("perplexity"))
