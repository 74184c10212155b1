"""Periodic runs, byte-level BPE and fill-in-middle against plain Python, on small cases and on whole given tables."""
import functools
import hashlib
import random
import re
import zlib

import cases
import numpy as np
import pytest

from crmflow.llm import byte_bpe, fill_in_middle, periodic_runs
from crmflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def given(spark, sf_dir):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def odd():
    return [(r[0], r[1] or "") for r in cases.rows()]


# Periodic runs

def plain_runs(words, exponent=4, least=6):
    """All maximal runs by trying every period."""
    number = {}
    v = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = {}
    for q in range(1, len(v) // exponent + 1):
        same = np.concatenate([[False], v[q:] == v[:-q], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            size = b - a + q
            # A multiple of a smaller period gives the stretch of that period again.
            if size >= max(least, exponent * q) and not any(q % p == 0 for p in found.get((a, size), ())):
                found.setdefault((a, size), []).append(q)
    return sorted((a, size, q) for (a, size), periods in found.items() for q in periods)


def plain_tiled(i, words):
    h = None if i is None else zlib.crc32(str(i).encode())
    if h is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def plain_digest(i, text):
    words = plain_tiled(i, WORD.findall(text))
    runs = plain_runs(words)
    gone = {k for a, size, q in runs for k in range(a + q, a + size)}
    best = min(runs, key=lambda r: (-r[1] * 10 ** 12 // r[2], r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    listed = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
    return (i, len(runs), *best, milli, sha(listed), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def lyndon(s):
    """Length of the longest Lyndon word at each place, by its meaning."""
    def is_lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))
    return [max(k for k in range(1, len(s) - i + 1) if is_lyndon(s[i:i + k])) for i in range(len(s))]


def test_lyndon_lengths_by_grouping():
    draw = random.Random(2)
    for _ in range(400):
        kinds = draw.choice([1, 2, 3, 5])
        s = [draw.randrange(kinds) for _ in range(draw.randrange(0, 18))] * draw.choice([1, 1, 3])
        assert periodic_runs.lyndon_lengths(s, kinds) == lyndon(s)


@pytest.mark.parametrize("exponent,least", [(4, 6), (2, 2), (2, 7), (3, 3), (4, 1)])
def test_runs_of_small_sequences(exponent, least):
    draw = random.Random(exponent * 10 + least)
    for k in range(400):
        kinds = draw.choice([1, 2, 3, 4])
        s = [draw.randrange(kinds) for _ in range(draw.randrange(1, 40))]
        if k % 2:
            unit = [draw.randrange(kinds) for _ in range(draw.randrange(1, 7))]
            s = s[:9] + unit * draw.randrange(2, 7) + unit[:draw.randrange(len(unit))] + s[9:]
        number = {}
        letters = [number.setdefault(x, len(number)) for x in s]
        assert periodic_runs.runs(letters, len(number), exponent, least) == plain_runs(s, exponent, least)


@pytest.mark.parametrize("exponent,least", [(4, 6), (2, 2), (3, 10)])
def test_runs_of_texts(spark, exponent, least):
    draw = random.Random(5)
    rows = []
    for i in range(120):
        words = []
        for _ in range(draw.randrange(0, 12)):
            part = [draw.choice(["a", "b", "c", "é", "dd", "A", "x" * 50]) for _ in range(draw.randrange(1, 9))]
            words += part * draw.choice([1, 1, 2, 3, 5, 9])
        rows.append((i, "".join(w + draw.choice([" ", "\n", " \t", "\x0b\x0c"]) for w in words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in periodic_runs.found(docs, exponent, least).collect()}
    for i, text in rows:
        words = WORD.findall(text)
        want = plain_runs(words, exponent, least)
        assert [tuple(x) for x in got[i]["runs"]] == want and got[i]["n_words"] == len(words)
        gone = {k for a, size, q in want for k in range(a + q, a + size)}
        assert got[i]["collapsed"] == " ".join(w for k, w in enumerate(words) if k not in gone)


def test_runs_query(spark, sf_dir):
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect())
    want = sorted(plain_digest(*row) for row in given(spark, sf_dir))
    assert got == want
    assert sum(row[1] > 0 for row in want) > 10


def test_runs_of_odd_rows(spark):
    for extra in (False, True):
        got = sorted((tuple(r) for r in periodic_runs.digests(cases.documents(spark, extra)).collect()), key=str)
        assert got == sorted((plain_digest(*row) for row in odd()), key=str)
    assert periodic_runs.digests(cases.documents(spark).limit(0)).collect() == []


# Byte-level BPE

@functools.lru_cache(1)
def reference_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=byte_bpe.read_ranks(byte_bpe.default_ranks()), special_tokens={})


def plain_tokens(i, text):
    ids = reference_encoding().encode_ordinary(text)
    return i, len(ids), sha(",".join(map(str, ids))), sha(text)


def test_tokens_query(spark, sf_dir):
    got = sorted(tuple(r) for r in QUERIES["op12_byte_bpe"](spark, sf_dir).collect())
    assert got == sorted(plain_tokens(*row) for row in given(spark, sf_dir))


def test_tokens_of_odd_rows(spark):
    for extra in (False, True):
        got = sorted((tuple(r) for r in byte_bpe.digests(cases.documents(spark, extra)).collect()), key=str)
        assert got == sorted((plain_tokens(*row) for row in odd()), key=str)
    assert byte_bpe.digests(cases.documents(spark).limit(0)).collect() == []


def test_tokens_of_all_code_points_and_spaces():
    code = byte_bpe.Encoder(byte_bpe.default_ranks(), byte_bpe.default_pattern())
    every = ["".join(f"{chr(c)}b {chr(c)} x{chr(c)}{chr(c)} 1\n{chr(c)}" for c in range(a, a + 64) if not 0xD800 <= c < 0xE000) for a in range(0, 0x30000, 64)]
    draw = random.Random(3)
    spaces = "a'st é中1!\n\t \x85\xa0 　\x1c\x1f᠎​"
    every += ["".join(draw.choice(spaces) for _ in range(draw.randrange(60))) for _ in range(4000)]
    every += ["a" * 5000, " " * 3000, "ab" * 3000 + "\n" * 70]
    assert [x.tolist() for x in code.ids(every)] == [reference_encoding().encode_ordinary(x) for x in every]


def test_store_starts_anew(monkeypatch):
    monkeypatch.setattr(byte_bpe, "STORED", 50)
    code = byte_bpe.Encoder(byte_bpe.default_ranks(), byte_bpe.default_pattern())
    for k in range(6):
        rows = [cases.prose(k, 40), cases.prose(k + 1, 90)]
        assert [x.tolist() for x in code.ids(rows)] == [reference_encoding().encode_ordinary(x) for x in rows]


def test_spans_equal_the_library(spark):
    rows = [(1, "naïve 中文 😀😀 don't\n\n stop"), (2, "🏳️‍🌈é"), (3, ""), (4, "plain words only")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = byte_bpe.tokenizer(byte_bpe.default_ranks(), byte_bpe.default_pattern())
    for r in byte_bpe.encoded(docs, spans=True).collect():
        e = made.encode(dict(rows)[r["doc_id"]], add_special_tokens=False)
        assert (r["ids"], list(zip(r["starts"], r["ends"]))) == (e.ids, e.offsets)


def test_characters_split_between_ids():
    table = byte_bpe.byte_table(byte_bpe.default_ranks(), byte_bpe.default_pattern())
    text = "x 😀🏳️‍🌈中文 naïve é"
    ids = reference_encoding().encode_ordinary(text)
    parts = list(table.texts([[i] for i in ids]))
    assert "".join(parts) == text and "�" not in "".join(parts)
    assert any(not p for p in parts)
    assert "".join(table.texts([ids[:3], ids[3:]])) == text
    # A lone byte that never becomes a character is given up at the end.
    lone = byte_bpe.read_ranks(byte_bpe.default_ranks())["é".encode()[:1]]
    assert list(table.texts([[lone]])) == ["", "\ufffd"]


# Fill-in-middle

def plain_cut(i, text):
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, sha(text), sha(text)
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return i, n, "spm", a, b - a, sha(f"<S>{suf}<P>{pre}<M>{mid}"), sha(text)
    return i, n, "psm", a, b - a, sha(f"<P>{pre}<S>{suf}<M>{mid}"), sha(text)


def test_middle_query(spark, sf_dir):
    got = sorted(tuple(r) for r in QUERIES["op13_fill_in_middle"](spark, sf_dir).collect())
    assert got == sorted(plain_cut(*row) for row in given(spark, sf_dir))


def test_middle_of_odd_rows(spark):
    draw = random.Random(4)
    marked = [(1000 + k, "".join(draw.choice(["<", "P", "S", "M", ">", "é", "中", "😀", "a "]) for _ in range(draw.randrange(40)))) for k in range(300)]
    long = [(2000 + k, "".join(draw.choice(["a", "é" * 400, "b" * 300, "😀x" * 200]) for _ in range(600))) for k in range(6)]
    for extra in (False, True):
        got = sorted((tuple(r) for r in fill_in_middle.digests(cases.documents(spark, extra)).collect()), key=str)
        assert got == sorted((plain_cut(*row) for row in odd()), key=str)
    docs = spark.createDataFrame(marked + long, "doc_id long, text string")
    got = fill_in_middle.digests(docs).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_cut(*row) for row in marked + long)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.digests(docs.limit(0)).collect() == []


def test_select_in_every_container():
    draw = np.random.default_rng(1)
    n = 3 * fill_in_middle.SPAN + 77
    flags = np.zeros(n, bool)
    flags[:fill_in_middle.SPAN] = True                                                   # a run
    flags[fill_in_middle.SPAN:2 * fill_in_middle.SPAN] = draw.random(fill_in_middle.SPAN) < 0.5   # a bitmap
    flags[2 * fill_in_middle.SPAN:] = draw.random(n - 2 * fill_in_middle.SPAN) < 0.01    # arrays
    marks = fill_in_middle.Boundaries(flags)
    assert [type(x).__name__ for x in marks.parts] == ["RunContainer", "BitmapContainer", "ArrayContainer", "ArrayContainer"]
    want = np.flatnonzero(flags)
    assert len(marks) == len(want)
    for k in [0, len(want) - 1, *draw.integers(0, len(want), 3000).tolist()]:
        assert marks.select(k) == want[k]
