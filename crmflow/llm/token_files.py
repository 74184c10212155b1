"""Token-id files in Simple-8b word-aligned coding.

A file is a Parquet table of segments, so any store Spark can read serves, and a lost task is simply written again.
A segment holds whole documents, in ascending doc_id order over all files, as

    shard, first   file number and ids before the segment in that shard
    n_ids          ids in the segment
    doc_ids        ids of its documents; lengths: their token counts (uint32)
    words          Simple-8b words (uint64): a selector in the top 4 bits, 60 bits of ids from the lowest bit on
    offsets        first word of each block of ``BLOCK`` ids (uint32); blocks are coded independently
    escapes        ids of 2**20 - 1 and more (uint32); their places hold 2**20 - 1 in a 20-bit word
    escape_offsets first escape of each block (uint32)

Selector s packs ``COUNTS[s]`` ids of ``WIDTHS[s]`` bits. A word takes as many ids as fit (greedy). All integers are
little-endian. Encoding looks each distinct word up once per worker: words are separated by white space that the tokenizer
drops, so a text's ids are those of its words in turn.

Nulls and empty texts: the end id alone. Null doc_id: first in the order. Repeated rows are written each, equal ids in the
order of their texts. No rows: no files, no result. Other columns are ignored.
"""
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crmflow.llm.common import new_path, spread, texts, workers_see_package
from crmflow.llm.textgrid import Grid, pieces, span_keys, tails

WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20])
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3])
BLOCK = 4096
ESCAPE = (1 << 20) - 1
#: Ids that fill a segment; a longer document has one of its own.
SEGMENT = 1 << 18

SEGMENTS = "shard int, first long, n_ids long, doc_ids array<long>, lengths binary, words binary, offsets binary, escapes binary, escape_offsets binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(ids: np.ndarray):
    """Simple-8b words, block offsets, escapes and escape offsets of some ids (uint32)."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    code = np.zeros(blocks * BLOCK, np.int64)
    code[:n] = np.minimum(ids, ESCAPE)
    need = np.searchsorted(WIDTHS, np.frexp(code.astype(np.float64))[1])
    grid = np.zeros((blocks, BLOCK + 61), np.int16)
    pick = np.full((blocks, BLOCK), len(WIDTHS) - 1, np.int8)
    need = need.reshape(blocks, BLOCK)
    for s in range(len(WIDTHS) - 2, -1, -1):
        wide = need > s
        if wide.all():
            break
        np.cumsum(wide, axis=1, out=grid[:, 1:BLOCK + 1], dtype=np.int16)
        grid[:, BLOCK + 1:] = grid[:, BLOCK:BLOCK + 1]
        c = COUNTS[s]
        pick[grid[:, c:c + BLOCK] == grid[:, :BLOCK]] = s
    # Each block is walked from its start, all blocks a word at a time.
    size = np.full(blocks, BLOCK)
    if blocks:
        size[-1] = n - (blocks - 1) * BLOCK
    at, live = np.zeros(blocks, np.int64), np.arange(blocks)
    starts, owners = [], []
    while len(live):
        starts.append(at[live])
        owners.append(live)
        at[live] += COUNTS[pick[live, at[live]]]
        live = live[at[live] < size[live]]
    if not starts:
        return (np.empty(0, np.uint64), *(np.empty(0, np.uint32),) * 3)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    owner, begin = owner[order], np.concatenate(starts)[order]
    chosen = pick[owner, begin]
    padded = np.concatenate([code.reshape(blocks, BLOCK), np.zeros((blocks, 60), np.int64)], axis=1)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        own = np.flatnonzero(chosen == s)
        value = np.zeros(len(own), np.uint64)
        for k in range(COUNTS[s]):
            value |= padded[owner[own], begin[own] + k].astype(np.uint64) << np.uint64(k * WIDTHS[s])
        words[own] |= value
    out = np.flatnonzero(ids >= ESCAPE)
    return words, np.searchsorted(owner, np.arange(blocks)).astype(np.uint32), ids[out].astype(np.uint32), np.searchsorted(out, np.arange(blocks) * BLOCK).astype(np.uint32)


def unpack(words, offsets, escapes, n) -> np.ndarray:
    """The ids (uint32) of packed words; all words of one selector are taken apart at once."""
    if not n:
        return np.empty(0, np.uint32)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[chosen]
    last = np.append(offsets[1:].astype(np.int64), len(words)) - 1
    size = np.full(len(offsets), BLOCK)
    size[-1] = n - (len(offsets) - 1) * BLOCK
    total = np.add.reduceat(count, offsets.astype(np.int64))
    count[last] -= total - size
    place = np.cumsum(count) - count
    ids = np.zeros(n, np.uint32)
    for s in np.unique(chosen):
        own = np.flatnonzero(chosen == s)
        for k in range(COUNTS[s]):
            has = own[count[own] > k]
            ids[place[has] + k] = (words[has] >> np.uint64(k * WIDTHS[s])) & np.uint64((1 << int(WIDTHS[s])) - 1)
    out = np.flatnonzero(ids == ESCAPE)
    ids[out] = escapes[:len(out)]
    return ids


class Encoder:
    """Ids of whole texts. Distinct words are kept, sorted by key, up to ``MOST``; then the store starts anew."""

    MOST = 1_500_000

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        self.keys, self.at, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.store, self.used = np.empty(1 << 16, np.uint32), 0

    def whole(self, raw, offsets):
        texts_ = [raw[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts_, add_special_tokens=False)]
        return np.concatenate([np.empty(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64)

    def spans(self, grid):
        """Words, cut before trailing punctuation where the tokenizer cuts too: after a digit, or a letter of ASCII or Latin-1."""
        data, cut = grid.data, tails(grid)
        split = (cut > grid.start) & (cut < grid.end)
        before = data[np.maximum(cut - 1, 0)]
        lead = data[np.maximum(cut - 2, 0)]
        plain = (before < 128) & ((before >= 97) & (before <= 122) | (before >= 65) & (before <= 90) | (before >= 48) & (before <= 57))
        latin = (lead == 0xC3) & (before != 0x97) & (before != 0xB7) & (before >= 128) & (cut - 2 >= grid.start)
        split &= plain | latin
        count = 1 + split.astype(np.int64)
        at = np.cumsum(count) - count
        start, end = np.empty(int(count.sum()), np.int64), np.empty(int(count.sum()), np.int64)
        start[at], end[at] = grid.start, np.where(split, cut, grid.end)
        start[at[split] + 1], end[at[split] + 1] = cut[split], grid.end[split]
        return start, end, np.repeat(grid.doc, count)

    def learn(self, keys, spans, data):
        if len(self.keys) + len(keys) > self.MOST:
            self.clear()
        model, found, hard = self.tokenizer.model, [None] * len(keys), []
        for k, (a, b) in enumerate(spans):
            raw = data[a:b].tobytes()
            # Lower-case ASCII letters need no normaliser and make one piece; the model alone gives their ids.
            if raw.isalpha():
                found[k] = [t.id for t in model.tokenize(raw.lower().decode())]
            else:
                hard.append((k, raw.decode()))
        for (k, _), e in zip(hard, self.tokenizer.encode_batch_fast([x for _, x in hard], add_special_tokens=False)):
            found[k] = e.ids
        size = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter((t for x in found for t in x), np.uint32, int(size.sum()))
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.empty_like(self.store)])
        self.store[self.used:self.used + len(flat)] = flat
        where = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, where, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, where, size)
        self.keys = np.insert(self.keys, where, keys)
        self.used += len(flat)

    def encode(self, data, offsets):
        """Ids of some texts (bytes and offsets), one after the other, and how many each has."""
        if b"<|" in data.tobytes():
            return self.whole(data, offsets)
        grid = Grid(data, offsets, True, keys=False)
        start, end, doc = self.spans(grid)
        key, first, inverse = np.unique(span_keys(grid, start, end), return_index=True, return_inverse=True)
        if len(key) > self.MOST:
            return self.whole(data, offsets)
        at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[at] != key) if len(self.keys) else np.arange(len(key))
        if len(new):
            if len(self.keys) + len(new) > self.MOST:
                self.clear()
                new = np.arange(len(key))
            self.learn(key[new], zip(start[first[new]].tolist(), end[first[new]].tolist()), data)
            at = np.searchsorted(self.keys, key)
        begin, size = self.at[at][inverse], self.size[at][inverse]
        places = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        return self.store[places], np.bincount(doc, weights=size, minlength=len(offsets) - 1).astype(np.int64)


_encoders: dict = {}


def encoder(path) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _segment(shard, first, ids, docs, lengths):
    words, offsets, escapes, escape_offsets = pack(ids)
    values = [shard, first, len(ids), docs, lengths.astype("<u4").tobytes(), words.astype("<u8").tobytes(), offsets.tobytes(), escapes.tobytes(), escape_offsets.tobytes()]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *(pa.binary(),) * 5]
    return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=[x.split()[0] for x in SEGMENTS.split(", ")])


def write_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1) -> None:
    """Encodes whole texts, appends ``end_id`` to each and writes the files, in ascending doc_id order (then by a hash of the text), below ``path``."""
    tokenizer = tokenizer or default_tokenizer()

    def encode(batches):
        code, shard, first = encoder(tokenizer), TaskContext.get().partitionId(), 0
        held, names, sizes, total = [], [], [], 0
        for batch in batches:
            for i, j, data, offsets in pieces(batch.column(1)):
                ids, count = code.encode(data, offsets)
                ids = np.insert(ids, np.cumsum(count), end_id)
                names += batch.column(0).slice(i, j - i).to_pylist()
                held.append(ids)
                sizes.append(count + 1)
                total += len(ids)
                if total >= SEGMENT:
                    yield _segment(shard, first, np.concatenate(held), names, np.concatenate(sizes))
                    first += total
                    held, names, sizes, total = [], [], [], 0
        if total:
            yield _segment(shard, first, np.concatenate(held), names, np.concatenate(sizes))

    ordered = texts(docs).withColumns({"hash": F.xxhash64("text"), "part": F.spark_partition_id()})
    # Rows of one id, and equal rows too, are dealt to as many tasks as they need.
    ordered = ordered.repartitionByRange(spread(docs), "doc_id", "hash", "part").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    ordered.mapInArrow(encode, SEGMENTS).write.option("compression", "zstd").parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and shard of each document, all from the files."""
    workers_see_package(spark)
    files = spark.read.schema(SEGMENTS).parquet(path)
    # One number for each file written.
    totals = dict(files.groupBy("shard").agg(F.sum("n_ids")).collect())
    before, run = {}, 0
    for shard in sorted(totals):
        before[shard] = run
        run += totals[shard]
    base = spark.sparkContext.broadcast(before)

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<u4"), np.frombuffer(row["escapes"], "<u4"), row["n_ids"])
                size = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                end = np.cumsum(size)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((end - size).tolist(), end.tolist())]
                start = base.value[row["shard"]] + row["first"] + end - size
                yield pa.record_batch([pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(np.full(len(size), row["shard"], np.int32))], names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    return files.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")


def encoded(docs: DataFrame) -> DataFrame:
    """Files of ``docs`` in the shared folder, and what is read back from them."""
    path = new_path(docs.sparkSession, "tokens")
    write_files(docs, path)
    return read_files(docs.sparkSession, path)
