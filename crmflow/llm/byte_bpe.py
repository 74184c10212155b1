"""Byte-level BPE over a file of ranks: encoding by the tokenizers library, decoding by the reversed byte table.

The library works on characters, so every byte stands for one printable character. A rank file names tokens only; the pair
each token is merged from is what the lower ranks make of its bytes. A whole match that is a token is taken as it is.

Matches never cross the places where a run of non-space characters (with one space before it) begins, white space ends or
a run of Latin letters meets ASCII punctuation, so a text is cut there. The library sees a cut when it is new to the task:
the store has a younger and an older half, and what is used again moves back to the younger; long cuts always go to it.

Nulls: a null text is empty and has no ids; a null doc_id stays. Very long texts: encoded whole, one piece of about 1 MB of
texts at a time, a longer text alone. Repeated rows: one row each. Ties of equal ranks: the leftmost pair first. No rows: no
result. Other columns are ignored.
"""
import base64
import functools
import itertools
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmflow.llm.common import texts
from crmflow.llm.textgrid import pieces

#: Cuts of the store's younger half before it becomes the older one, and the longest that is kept (characters).
STORED, LONGEST = 150_000, 64

#: White space of the pattern's ``\s`` (Unicode's White_Space, fixed).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters up to U+024F, a fixed range; the pattern takes a whole run of them with one space before it.
_LETTER = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
_CUTS = re.compile(
    f" ?[{_LETTER}]++(?=[\\x00-@\\[-`{{-\\x7f]|$)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def byte_characters() -> dict[int, str]:
    """One printable character for each byte: itself where it is one, else the next from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0x100)} - {0xAD}
    spare = itertools.count(0x100)
    return {b: chr(b if b in printable else next(spare)) for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that the ranks below the token's own leave of it; None if they leave more."""
    parts = [token[i:i + 1] for i in range(len(token))]
    none = ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= none:
            return None
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


@functools.lru_cache(2)
def tokenizer(path: str, pattern: str):
    """The library's tokenizer of a rank file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, names = read_ranks(path), byte_characters()
    spelled = {token: "".join(names[b] for b in token) for token in ranks}
    pairs = (last_pair(token, ranks) for token in sorted(ranks, key=ranks.get) if len(token) > 1)
    made = Tokenizer(models.BPE(
        vocab={spelled[t]: r for t, r in ranks.items()}, merges=[(spelled[a], spelled[b]) for a, b in filter(None, pairs)],
        ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


class ByteTable:
    """The bytes of every id: the vocabulary's characters turned back into bytes, end to end."""

    def __init__(self, vocab: dict[str, int]):
        back = {c: b for b, c in byte_characters().items()}
        spelled = dict((i, bytes(back[c] for c in token)) for token, i in vocab.items())
        self.size = np.zeros(max(spelled) + 1 if spelled else 0, np.int64)
        for i, raw in spelled.items():
            self.size[i] = len(raw)
        self.first = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(len(self.size))), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of some ids. An id may end inside a character; its bytes are joined here, not its characters."""
        size = self.size[ids]
        end = np.cumsum(size)
        return self.data[np.repeat(self.first[ids] - end + size, size) + np.arange(int(size.sum()))]

    def texts(self, runs):
        """Text of ids that arrive in runs: bytes of a character that is not whole yet wait for the next run."""
        held = b""
        for ids in runs:
            held += self.decode(np.asarray(ids, np.int64)).tobytes()
            cut = whole_characters(held)
            yield held[:cut].decode("utf-8", "replace")
            held = held[cut:]
        if held:
            yield held.decode("utf-8", "replace")


def whole_characters(raw: bytes) -> int:
    """Length of ``raw`` without the beginning of a character at its end."""
    for back in range(1, min(4, len(raw)) + 1):
        lead = raw[-back]
        if lead >= 0xC0:
            width = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return len(raw) - back if width > back else len(raw)
        if lead < 0x80:
            break
    return len(raw)


@functools.lru_cache(2)
def byte_table(path: str, pattern: str) -> ByteTable:
    return ByteTable(tokenizer(path, pattern).get_vocab())


class Encoder:
    """Ids of texts; ``young`` and ``old`` hold those of cuts seen by this task, 4 bytes an id."""

    def __init__(self, path: str, pattern: str):
        self.tokenizer, self.young, self.old = tokenizer(path, pattern), {}, {}

    def ids(self, rows: list[str]) -> list[np.ndarray]:
        cuts = [_CUTS.findall(x) for x in rows]
        young, old = self.young, self.old
        new = set(itertools.chain.from_iterable(cuts)).difference(young)
        young.update((c, old[c]) for c in new.intersection(old))
        new = sorted(new.difference(old))
        # A few thousand at once: the library's results are far larger than the ids.
        for k in range(0, len(new), 4096):
            part = new[k:k + 4096]
            young.update(zip(part, [array("i", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]))
        out = [np.frombuffer(b"".join(map(young.__getitem__, own)), np.int32) for own in cuts]
        for c in new:
            if len(c) > LONGEST:
                del young[c]
        if len(young) > STORED:
            self.young, self.old = {}, young
        return out


def _lists(rows, kind):
    """An Arrow list column of number arrays."""
    ends = np.cumsum([0, *(len(x) for x in rows)])
    flat = np.concatenate([np.empty(0, kind), *rows], dtype=kind)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def character_spans(raw: np.ndarray, size: np.ndarray):
    """First and last code point (end exclusive) that each token of ``size`` bytes touches."""
    end = np.cumsum(size)
    begun = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return begun[end - size + 1] - 1, begun[end]


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None, spans: bool = False) -> DataFrame:
    """doc_id and ids of every whole text; with ``spans`` also the code points ``starts`` and ``ends`` of each id.

    A character whose bytes lie in several tokens belongs to each of them. One pass, no shuffle.
    """
    path, pattern = path or default_ranks(), pattern or default_pattern()

    def run(batches):
        code = Encoder(path, pattern)
        for batch in batches:
            for i, j, data, offsets in pieces(batch.column("text")):
                raw = data.tobytes()
                rows = code.ids([raw[a:b].decode() for a, b in itertools.pairwise(offsets.tolist())])
                columns = {"doc_id": batch.column("doc_id").slice(i, j - i), "ids": _lists(rows, np.int32)}
                if spans:
                    table = byte_table(path, pattern)
                    found = [character_spans(data[offsets[k]:offsets[k + 1]], table.size[ids]) for k, ids in enumerate(rows)]
                    columns |= {"starts": _lists([a for a, _ in found], np.int32), "ends": _lists([b for _, b in found], np.int32)}
                yield pa.record_batch(list(columns.values()), names=list(columns))

    more = ", starts array<int>, ends array<int>" if spans else ""
    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>" + more)


def decoded(tokens: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids and ``decoded``, the bytes that the ids stand for (null ids: none)."""
    path, pattern = path or default_ranks(), pattern or default_pattern()

    def run(batches):
        table = byte_table(path, pattern)
        for batch in batches:
            column = batch.column("ids").fill_null([])
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            # About a megabyte of ids at once.
            i = 0
            while i < len(column):
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + (1 << 18), "right")) - 1)
                ids = flat[ends[i]:ends[j]]
                at = np.concatenate([[0], np.cumsum(table.size[ids])])[ends[i:j + 1] - ends[i]]
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), j - i, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(table.decode(ids))])
                yield pa.record_batch([batch.column("doc_id").slice(i, j - i), column.slice(i, j - i), raw.cast(pa.binary())], names=["doc_id", "ids", "decoded"])
                i = j

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of ids, and sha256 of the ids and of the bytes decoded from them."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded(encoded(docs)).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
