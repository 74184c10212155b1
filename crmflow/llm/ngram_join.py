"""N-gram Jaccard join: blocked sparse matrix product of the document by n-gram incidence matrix.

A row of the matrix is a document's set of distinct word n-grams (64-bit keys), a column an n-gram. Two rows link when
``overlap >= t * union``. The columns are dealt into blocks by hash. Two sets of sizes n <= m that link differ in at most
``d = floor(n * (1 - t) / t)`` n-grams (the size-derived bound), so over ``d + 1`` column blocks at least one block has equal
slices in both rows, that is, an overlap equal to both slices' sizes. Only rows with a full block in common can have
enough overlap; all other entries of the product are discarded unseen. For the rest the product is computed: rows that
candidates connect form a family, a family is cut into row blocks, and for each pair of row blocks a task accumulates the
overlap counts (dense products for frequent columns, sparse ones for rare columns, shared columns once) and discards
pairs below the bound.

The number of column blocks follows the size of the smaller set: sizes are cut into intervals so that linked sets lie in
the same or in neighbouring intervals, and a row has the slices of its own interval and of the one below. Empty slices say
nothing: there are some blocks to spare, so that a full one with n-grams remains; a row with more empty slices than that
has the slices of further, independent dealings of all its n-grams too, and only the last of these holds empty slices. N-grams
of passages that many documents share would tie unrelated rows together; they are left out of the slices of rows that have
enough others (leaving columns out adds no differences).
Slices are sent as packed arrays, one for each batch and bucket of keys.

Skew: equal sets are one row of the matrix (a class). In each batch rows with a slice in common are linked to the first
of them, and only that one is sent on, so a slice that a third of all rows have arrives once per batch. Families are cut
into blocks of bounded size; only blocks of the same or of neighbouring size intervals are paired. Chance ties make families
grow faster than the input, and the rows sent grow with the square of a family. So a family of several blocks is first cut by parity
sketches of one to two bits for each n-gram: two sketches differ in at most as many bits as their sets in n-grams, and rows that are
held together only by pairs whose sketches differ in more than a link allows are no longer one family.

Nulls and empty texts: no n-grams, linked with nothing. Null doc_id: such rows are classed, linked and returned with the others,
but do not name a component (null where no row of it has an id). A doc_id with several texts: each row is judged by its own
text. Repeated rows: returned as often as they come. No documents: no rows. Texts are never cut. Other columns are ignored. Ties do not arise:
the least doc_id names a component.
"""
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crmflow.llm.common import saved, small_side, spread, texts
from crmflow.llm.components import components
from crmflow.llm.textgrid import grids, mix

#: Most documents, and n-grams, of one block of rows (in expectation).
BLOCK_DOCS = 1024
BLOCK_GRAMS = 1 << 20
#: Most documents, and n-grams, of one block of parity sketches (in expectation).
SKETCH_DOCS = 16_384
SKETCH_GRAMS = 1 << 25
#: A column in more rows of a block pair than this is multiplied densely.
DENSE = 48
#: Texts and n-grams of the sample that shows common n-grams, and in how many of the texts those are.
SAMPLE_DOCS, MOST_COMMON, COMMON = 4000, 500_000, 3


def intervals(percent: int, most: int = 1 << 31) -> np.ndarray:
    """Lower ends of the size intervals: sets that link lie in one interval or in neighbouring ones."""
    low = [1]
    while low[-1] < most:
        low.append(low[-1] * 100 // percent + 1)
    return np.array(low, np.int64)


def gram_sets(grid, n: int):
    """Distinct n-gram keys of each text, sorted within the text, and the text of each key."""
    value, doc = grid.grams(n, short=True)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[first], doc[first]


def _slices(value, doc, size, low, blocks, back, seed):
    """Keys of the column-block slices, the text of each, and whether the slice is empty."""
    at = np.searchsorted(low, size, "right") - 1 - back
    count = np.where((at >= 0) & (size > 0), blocks[np.maximum(at, 0)], 0)
    first = np.concatenate([[0], np.cumsum(count)])
    has = count[doc] > 0
    value, doc = value[has], doc[has]
    part = (mix(value + np.uint64(seed)) >> np.uint64(32)) * count[doc].astype(np.uint64) >> np.uint64(32)
    slot = first[doc] + part.astype(np.int64)
    total = np.zeros(first[-1], np.uint64)
    np.add.at(total, slot, mix(value ^ np.uint64(0x5851F42D4C957F2D)))
    filled = np.zeros(first[-1], bool)
    filled[slot] = True
    owner = np.repeat(np.arange(len(size)), count)
    name = (np.arange(first[-1]) - first[owner]) * (1 << 20) + at[owner] * 16 + seed
    return mix(total + mix(name.astype(np.uint64))), owner, ~filled


def slice_keys(value, doc, size, percent, common):
    """All slice keys of the rows and the row of each. ``common``: sorted n-grams that are left out where enough others remain."""
    low = intervals(percent)
    most = (low[1:] - 1) * (100 - percent) // percent
    spare = most // 5 + 4
    blocks = most + 1 + spare
    if len(common):
        own = common[np.minimum(np.searchsorted(common, value), len(common) - 1)] != value
    else:
        own = np.ones(len(value), bool)
    left = np.bincount(doc[own], minlength=len(size))
    # Two sets that link differ in at most size * (100 - percent) / percent n-grams, whichever size that is, so that one of
    # these two choices is made for both of them.
    some = 4 * left >= size
    whole = left < size / 4 + 1.25 * size * (100 - percent) / percent + 1
    every = np.ones(len(value), bool)
    keys, owners = [], []
    for chosen, dealings, seed in ((some, (own, every, every, every), 1), (whole & (left < size), (every, every, every), 9)):
        for back in (0, 1):
            wanted = chosen
            for k, mine in enumerate(dealings):
                has = mine & wanted[doc]
                key, owner, empty = _slices(value[has], doc[has], np.where(wanted, size, 0), low, blocks, back, seed + k)
                # Without empty slices one equal slice remains for sure, unless both rows have more empty ones than are to spare.
                # Such rows are dealt again; equal empty slices would tie unrelated rows together, so they count in the last dealing only.
                at = np.maximum(np.searchsorted(low, size, "right") - 1 - back, 0)
                wanted = np.bincount(owner[empty], minlength=len(size)) > spare[at]
                use = ~empty if k < len(dealings) - 1 else np.ones(len(key), bool)
                keys.append(key[use])
                owners.append(owner[use])
                if not wanted.any():
                    break
    return np.concatenate(keys), np.concatenate(owners)


def common_grams(source: DataFrame, n: int) -> np.ndarray:
    """n-grams of at least ``COMMON`` different texts of a bounded sample. Which ones they are changes the layout, not the links."""
    chosen = source.select(F.col("doc_id").alias("id")).where("id is not null").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)

    def count(batches):
        for batch in batches:
            for _, _, grid in grids(batch.column(0)):
                yield pa.record_batch([pa.array(_signed(gram_sets(grid, n)[0]))], names=["g"])

    sampled = source.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"), "left_semi").select("text").distinct()
    found = sampled.mapInArrow(count, "g long").groupBy("g").count().where(F.col("count") >= COMMON).orderBy(F.desc("count"), "g").limit(MOST_COMMON).select("g").toArrow()
    return np.sort(found["g"].to_numpy().view(np.uint64))


def _signed(x):
    return x.astype(np.uint64, copy=False).view(np.int64)


def _sets(batch, column, n, seed):
    """(first, last, n-grams, their texts, sizes, nodes, second signatures) over runs of a batch's texts."""
    for i, j, grid in grids(batch.column(column)):
        value, doc = gram_sets(grid, n)
        size = np.bincount(doc, minlength=j - i)
        ends = np.cumsum(size)
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value + np.uint64(s)))]) for s in (seed, seed + 77)]
        node, check = (_signed(mix(s[ends] - s[ends - size] + size.astype(np.uint64))) for s in sums)
        yield i, j, value, doc, size, node, check


def _scan(n, seed):
    def scan(batches):
        for batch in batches:
            for i, j, _, _, size, node, check in _sets(batch, 1, n, seed):
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(node), pa.array(check), pa.array(size.astype(np.int32))], names=["doc_id", "h", "node", "c", "n"])
    return scan


def _slice_scan(n, percent, seed, buckets, common):
    """A batch's slice keys by bucket: the low 48 bits (the bucket is drawn from others), sorted, and the place of each row's node."""
    def scan(batches):
        for batch in batches:
            keys, nodes = [], []
            for _, _, value, doc, size, node, _ in _sets(batch, 0, n, seed):
                if len(value):
                    key, owner = slice_keys(value, doc, size, percent, common.value)
                    keys.append(key)
                    nodes.append(node[owner])
            if not keys:
                continue
            key, node = np.concatenate(keys), np.concatenate(nodes)
            bucket = (mix(key) >> np.uint64(40)).astype(np.int64) % buckets
            order = np.lexsort((key, bucket))
            key, node, bucket = key[order], node[order], bucket[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            lead = node[first][np.cumsum(first) - 1]
            near = np.flatnonzero(lead != node)
            pairs = np.unique(np.stack([lead[near], node[near]], 1), axis=0) if len(near) else np.empty((0, 2), np.int64)
            key, node, bucket = key[first], node[first], bucket[first]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                own = slice(edges[k], edges[k + 1])
                names, place = np.unique(node[own], return_inverse=True)
                short = key[own].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                yield _row([k, short, place.astype("<u2" if len(names) <= 1 << 16 else "<u4").tobytes(), names.tobytes(), pairs[:, 0].tobytes(), pairs[:, 1].tobytes()])
                pairs = pairs[:0]
    return scan


def _row(values):
    return pa.record_batch([pa.array([values[0]], pa.int32()), *(pa.array([v], pa.binary()) for v in values[1:])], names=["bucket", "keys", "place", "nodes", "a", "b"])


def _stars(batches):
    """Edges from the first node to the others of each slice key, for one bucket after the other."""
    held, at = [], None
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if held and row["bucket"] != at:
                yield from _star(held)
                held = []
            at = row["bucket"]
            held.append(row)
    if held:
        yield from _star(held)


def _star(rows):
    key, node = [], []
    left, right = ([np.frombuffer(r[x], np.int64) for r in rows] for x in "ab")
    for r in rows:
        raw = np.frombuffer(r["keys"], np.uint8).reshape(-1, 6)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :6] = raw
        names = np.frombuffer(r["nodes"], np.int64)
        key.append(wide.view("<u8").ravel())
        node.append(names[np.frombuffer(r["place"], "<u2" if len(names) <= 1 << 16 else "<u4")])
    key, node = np.concatenate(key), np.concatenate(node)
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    lead = node[first][np.cumsum(first) - 1]
    near = np.flatnonzero(lead != node)
    pairs = np.stack([np.concatenate([*left, lead[near]]), np.concatenate([*right, node[near]])], 1)
    pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
    if len(pairs):
        yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


def overlaps(sets: list) -> np.ndarray:
    """Overlap counts of all rows: the product of their incidence matrix with its transpose."""
    rows = len(sets)
    if rows == 2:
        both = float(len(np.intersect1d(sets[0], sets[1], assume_unique=True)))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    value = np.concatenate(sets)
    row = np.repeat(np.arange(rows), [len(x) for x in sets])
    order = np.argsort(value, kind="stable")
    value, row = value[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(value)))
    product = np.full((rows, rows), float(np.sum(count == rows)), np.float32)
    flat = product.reshape(-1)
    for c in np.unique(count):
        if 1 < c <= DENSE and c < rows:
            member = row[first[count == c][:, None] + np.arange(c)]
            for x in range(c):
                for y in range(x + 1, c):
                    at = np.bincount(member[:, x] * rows + member[:, y], minlength=rows * rows) if len(member) * 8 > rows * rows else None
                    if at is not None:
                        flat += at
                        flat += at.reshape(rows, rows).T.reshape(-1)
                    else:
                        np.add.at(flat, member[:, x] * rows + member[:, y], 1)
                        np.add.at(flat, member[:, y] * rows + member[:, x], 1)
    heavy = np.flatnonzero((count > DENSE) & (count < rows))
    step = max(1, (1 << 22) // rows)
    for i in range(0, len(heavy), step):
        part = heavy[i:i + step]
        sizes = count[part]
        block = np.zeros((rows, len(part)), np.float32)
        at = np.repeat(first[part] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        block[row[at], np.repeat(np.arange(len(part)), sizes)] = 1
        product += block @ block.T
    return product


def spanning_links(sets: list, percent: int) -> list:
    """Pairs of positions that link and connect all that is linked among ``sets``."""
    size = np.array([len(x) for x in sets], np.float64)
    both = overlaps(sets)
    linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    np.fill_diagonal(linked, False)
    seen, found = ~linked.any(1), []
    for start in range(len(sets)):
        if seen[start]:
            continue
        seen[start] = True
        edge = [start]
        while edge:
            x = edge.pop()
            more = np.flatnonzero(linked[x] & ~seen)
            seen[more] = True
            found += [(x, int(y)) for y in more]
            edge += more.tolist()
    return found


def sketches(value, doc, size):
    """Parity of the number of n-grams on each bit of a text's sketch, as bytes; a sketch has the least power of two bits from its size on, 64 at least."""
    bits = sketch_words(size) * 64
    edge = np.concatenate([[0], np.cumsum(bits)])
    slot = edge[doc] + (value & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=edge[-1]) & 1).astype(np.uint8), bitorder="little").tobytes(), edge // 8


def sketch_words(size):
    """64-bit words of a sketch."""
    return np.left_shift(1, np.ceil(np.log2(np.maximum(size, 64) / 64)).astype(np.int64))


def _folded(sketch, words):
    """Sketches as columns of ``words`` words: the halves of a longer one are added up."""
    out = np.empty((words, len(sketch)), np.uint64)
    for k, x in enumerate(sketch):
        x = np.frombuffer(x, "<u8")
        while len(x) > words:
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        out[:, k] = x
    return out


def _joined(label, x, y):
    """``label`` (position of an earlier member of the own set, its own for the first) with the sets of x and y made one."""
    while True:
        a, b = label[x], label[y]
        apart = a != b
        if not apart.any():
            return label
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def near_links(sketch: list, size, side, percent: int) -> list:
    """Pairs of positions that connect all rows whose sketches allow a link. If there are two sides, only rows of different ones are compared."""
    size, side = np.asarray(size, np.int64), np.asarray(side, bool)
    order = np.argsort(size, kind="stable")
    size, side = size[order], side[order]
    words, label, across = sketch_words(size), np.arange(len(size)), side.any() and not side.all()
    # Rows after the last one that is small enough for a link with this one.
    ends = np.searchsorted(size * percent, size * 100, "right")
    for w in np.unique(words).tolist():
        a, b = np.searchsorted(words, [w, w + 1]).tolist()
        table = _folded([sketch[k] for k in order[a:ends[b - 1]].tolist()], w)
        short = table[:w // 2] ^ table[w // 2:] if w > 1 else table
        x = a
        while x < b:
            step = max(1, min(b - x, 256, (1 << 20) // max(1, int(ends[min(b, x + 256) - 1]) - x)))
            mine, other = slice(x, x + step), slice(x + 1, int(ends[x + step - 1]))
            most = (size[mine, None] + size[None, other]) * (100 - percent) // (100 + percent)
            fits = (np.arange(other.start, other.stop) > np.arange(x, x + step)[:, None]) & (np.arange(other.start, other.stop) < ends[mine, None])
            if across:
                fits &= side[mine, None] != side[None, other]
            apart = np.zeros(most.shape, np.int32)
            for row in short:
                apart += np.bitwise_count(row[x - a:x - a + step, None] ^ row[None, x + 1 - a:other.stop - a])
            i, j = np.nonzero(fits & (apart <= most))
            # Folded sketches tell unrelated rows apart; the others are compared by the whole ones.
            apart = np.zeros(len(i), np.int32)
            for row in table:
                apart += np.bitwise_count(row[i + (x - a)] ^ row[j + (x + 1 - a)])
            near = apart <= most[i, j]
            i, j = i[near], j[near]
            label = _joined(label, i + x, j + x + 1)
            x += step
    return [(int(order[label[k]]), int(order[k])) for k in np.flatnonzero(label != np.arange(len(label)))]


def _products(percent, linked):
    def links(frames):
        kept = None
        for frame in frames:
            frame = frame if kept is None else pd.concat([kept, frame], ignore_index=True)
            last = frame.iloc[-1] if len(frame) else None
            if last is None:
                continue
            mine = (frame["fam"] == last["fam"]) & (frame["i"] == last["i"]) & (frame["j"] == last["j"])
            kept, whole = frame[mine], frame[~mine]
            yield linked(whole, percent)
        if kept is not None:
            yield linked(kept, percent)
    return links


def _linked(frame, percent):
    return _edges(frame, lambda part: spanning_links([np.frombuffer(g, np.uint64) for g in part["grams"]], percent))


def _near(frame, percent):
    return _edges(frame, lambda part: near_links(part["grams"].tolist(), part["n"], part["mine"] == part["i"], percent))


def _edges(frame, links):
    a, b = [], []
    node = frame["node"].to_numpy()
    mark = np.stack([frame["fam"].to_numpy(), frame["i"].to_numpy(), frame["j"].to_numpy()], 1) if len(frame) else np.empty((0, 3), np.int64)
    cut = np.flatnonzero(np.any(mark[1:] != mark[:-1], axis=1)) + 1
    for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(frame)]):
        if j - i > 1:
            for x, y in links(frame.iloc[i:j]):
                a.append(node[i + x])
                b.append(node[i + y])
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _rows(n, sketch):
    def rows(batches):
        sent = np.empty(0, np.int64)
        for batch in batches:
            # Rows with the id and the text of a class's representative are alike: a task sends one of them.
            node = batch.column(1).to_numpy(zero_copy_only=False)
            first = np.unique(node, return_index=True)[1]
            first = np.sort(first[~np.isin(node[first], sent)])
            sent = np.concatenate([sent, node[first]])
            batch = batch.take(pa.array(first))
            for i, j, grid in grids(batch.column(0)):
                value, doc = gram_sets(grid, n)
                size = np.bincount(doc, minlength=j - i)
                raw, cut = sketches(value, doc, size) if sketch else (value.tobytes(), 8 * np.concatenate([[0], np.cumsum(size)]))
                cut = cut.tolist()
                grams = pa.array([raw[x:y] for x, y in zip(cut, cut[1:])], pa.binary())
                yield pa.record_batch([*(batch.column(k).slice(i, j - i) for k in range(1, 5)), pa.array(size.astype(np.int32)), grams], names=["node", "fam", "mine", "places", "n", "grams"])
    return rows


def _blocks(families: DataFrame, docs: int, grams: int):
    """Families of more than one block of ``docs`` rows and ``grams`` n-grams: fam and blocks."""
    blocks = F.ceil(F.greatest(F.count("*") / docs, F.sum("n") / grams)).cast("int")
    return families.groupBy("fam").agg(blocks.alias("blocks")).where("blocks > 1")


def _placed(families: DataFrame, large: DataFrame, percent: int, docs: int, grams: int, alone: bool) -> DataFrame:
    """``families`` with ``mine`` (block) and ``places``: the block pairs that a row goes to, (0, 0) in families that are not ``large``.

    Sets that link lie in the same or in neighbouring size intervals, so blocks are cut within intervals, and only those of the same or
    of neighbouring ones are paired. ``alone``: a block is also paired with itself, else only if there is no other.
    """
    low = ", ".join(f"{x}L" for x in intervals(percent).tolist())
    families = families.withColumn("at", F.expr(f"cast(size(filter(array({low}), x -> x <= n)) as long)"))
    # A family of one block is the rule: only the others are looked up.
    counts = families.join(F.broadcast(large.select("fam")), "fam", "left_semi").groupBy("fam", "at").agg(F.ceil(F.greatest(F.count("*") / docs, F.sum("n") / grams)).alias("k"))
    counts = counts.groupBy("fam").agg(F.map_from_entries(F.collect_list(F.struct("at", "k"))).alias("ks"))
    placed = families.join(F.broadcast(counts), "fam", "left")
    block = "(({at}) * 4294967296L + ({x}))"
    mine = block.format(at="at", x="pmod(xxhash64(node), ks[at])")
    own = f"transform(sequence(0L, ks[at] - 1), x -> {block.format(at='at', x='x')})"
    others = [f"transform(filter({own}, x -> {str(alone).lower()} or x <> mine), x -> struct(least(x, mine) as i, greatest(x, mine) as j))"]
    for step, pair in ((-1, "struct(x as i, mine as j)"), (1, "struct(mine as i, x as j)")):
        near = f"transform(sequence(0L, ks[at + {step}] - 1), x -> {block.format(at=f'at + {step}', x='x')})"
        others.append(f"if(ks[at + {step}] is null, array(), transform({near}, x -> {pair}))")
    placed = placed.withColumn("mine", F.expr(f"if(ks is null, 0L, {mine})"))
    placed = placed.withColumn("places", F.expr(f"if(ks is null, array(struct(0L as i, 0L as j)), concat({', '.join(others)}))"))
    return placed.withColumn("places", F.expr("if(size(places) = 0, array(struct(mine as i, mine as j)), places)")).drop("ks", "at")


def _compared(source: DataFrame, placed: DataFrame, n: int, percent: int, sketch: bool) -> DataFrame:
    """Edges (a, b) between the rows of ``placed``, compared block pair by block pair: by their sketches, or by their n-grams."""
    members = saved(placed.select(F.col("rep.doc_id").alias("rep_id"), F.col("rep.h").alias("rep_h"), "node", "fam", "mine", "places"), "members")
    own = (source["h"] == F.col("rep_h")) & source["doc_id"].eqNullSafe(F.col("rep_id"))
    grams = source.join(small_side(members, members.count()), own).select("text", "node", "fam", "mine", "places")
    grams = grams.mapInArrow(_rows(n, sketch), "node long, fam long, mine long, places array<struct<i: long, j: long>>, n int, grams binary")
    grams = grams.withColumn("p", F.explode("places")).select("fam", "p.i", "p.j", "node", "mine", "n", "grams")
    grams = grams.repartition(spread(grams), "fam", "i", "j").sortWithinPartitions("fam", "i", "j", "node")
    return grams.mapInPandas(_products(percent, _near if sketch else _linked), "a long, b long")


def _finer(source: DataFrame, families: DataFrame, n: int, percent: int) -> DataFrame:
    """``families`` with those of more than one block cut into parts between which no two rows can link; rows that can't link at all go."""
    large = saved(_blocks(families, BLOCK_DOCS, BLOCK_GRAMS), "large")
    if not large.limit(1).count():
        return families
    members = families.join(F.broadcast(large.select("fam")), "fam", "left_semi")
    parts = components(_compared(source, _placed(members, large, percent, SKETCH_DOCS, SKETCH_GRAMS, True), n, percent, True))
    parts = members.drop("fam").join(parts.withColumnRenamed("component", "fam"), "node").select(families.columns)
    return saved(families.join(F.broadcast(large.select("fam")), "fam", "left_anti").select(families.columns).unionByName(parts), "families")


def _components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, h (hash of the text), n, node (class), component and component_id (least doc_id) of every row of ``docs``."""
    source = texts(docs).withColumn("h", F.xxhash64("text"))
    for seed in range(1, 9):
        rows = saved(source.mapInArrow(_scan(n, seed), "doc_id long, h long, node long, c long, n int"), "rows")
        rows = rows.withColumn("node", F.when(F.col("n") > 0, F.col("node")))
        classes = saved(rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "h")).alias("rep"), F.max("n").alias("n"), (F.min("c") != F.max("c")).alias("clash")), "classes")
        if not classes.where("clash").limit(1).count():
            break
    else:
        raise RuntimeError("different sets of n-grams have one signature under each of eight seeds")
    buckets = spread(source)
    common = source.sparkSession.sparkContext.broadcast(common_grams(source, n))
    slices = source.select("text").mapInArrow(_slice_scan(n, percent, seed, buckets, common), "bucket int, keys binary, place binary, nodes binary, a binary, b binary")
    edges = slices.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_stars, "a long, b long")
    rows = rows.drop("c")
    families = components(edges)
    families = families.join(classes.select("node", "rep", "n"), "node").withColumnRenamed("component", "fam")
    families = _finer(source, saved(families, "families"), n, percent)
    large = saved(_blocks(families, BLOCK_DOCS, BLOCK_GRAMS), "large")
    links = _compared(source, _placed(families, large, percent, BLOCK_DOCS, BLOCK_GRAMS, False), n, percent, False)
    joined = components(links)
    named = classes.select("node", "least").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "component").select("node", "component", "component_id")
    return rows.join(named, "node", "left")


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id and class_id of every row of ``docs`` (see the module's text)."""
    out = _components(docs, n, percent)
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.col("node").alias("class_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component; rows without n-grams all stay.

    The least doc_id stays, then the least hash of the text; rows without doc_id come last. Rows are told apart by doc_id and
    text, so another text under a repeated doc_id is judged by itself. Of rows equal in both any one stays.
    """
    found = saved(_components(docs, n, percent).where("n > 0").select("doc_id", "h", "component"), "found")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
    first = found.groupBy("component").agg(F.min(order).alias("first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h"))
    gone = saved(found.join(first, "component").where(~same).select(F.col("doc_id").alias("_gone_id"), F.col("h").alias("_gone_h")).distinct(), "gone")
    many = saved(found.groupBy("doc_id", "h").count().where("count > 1").select(F.col("doc_id").alias("_gone_id"), F.col("h").alias("_gone_h")), "repeated")
    own_id, own_hash = docs["doc_id"].cast("long"), F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    row = own_id.eqNullSafe(F.col("_gone_id")) & (own_hash == F.col("_gone_h"))
    kept = docs.join(small_side(gone, gone.count()), row, "left_anti")
    if not many.limit(1).count():
        return kept
    many = small_side(many, many.count())
    once = kept.join(many, row, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(many, row, "left_anti").unionByName(once)
