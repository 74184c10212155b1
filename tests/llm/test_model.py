"""The language model: the law of seating, its probabilities, counts, and that the layout of its input does not matter."""
import collections
import math
import random
import re
import zlib

import cases
import numpy as np
import pytest

from crmflow.llm import hpy_model
from crmflow.llm.hpy_model import coded, decoded, packed, seat, unpacked


@pytest.fixture(scope="module")
def zipf():
    draw = random.Random(4)
    word = lambda: f"w{int(draw.paretovariate(0.7)) % 3000}"
    return [(d, " ".join(word() for _ in range(100))) for d in range(400)]


def scores(spark, rows, partitions, buckets):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", buckets)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
        return np.array([r["score"] / r["n_tokens"] for r in hpy_model.seventh_scores(docs).orderBy("doc_id").collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_layout_does_not_matter(spark, zipf):
    one, chunks, buckets = scores(spark, zipf, 1, 2), scores(spark, zipf, 12, 2), scores(spark, zipf, 7, 24)
    assert np.abs(one - chunks).max() < 1e-9 and np.abs(one - buckets).max() < 1e-9


def one_by_one(customers, others, strength, discount, parent, draw):
    tables = 1
    for k in range(1, customers):
        new = (strength + discount * (others + tables)) * parent
        tables += draw.random() < new / (new + k - discount * tables)
    return tables


@pytest.mark.parametrize("customers, others, parent", [(2, 0, 0.5), (7, 3, 0.1), (200, 0, 0.3), (200, 50, 0.02), (600, 400, 0.3), (1500, 20, 1e-5)])
def test_seats_have_the_law_of_one_by_one(customers, others, parent):
    n, draw = 3000, random.Random(1)
    want = np.array([one_by_one(customers, others, 1.0, 0.75, parent, draw) for _ in range(n)])
    got = seat(np.full(n, customers), np.full(n, others), 1.0, 0.75, np.full(n, parent), hpy_model.mix(np.arange(1, n + 1, dtype=np.uint64)))
    error = math.sqrt((want.var() + got.var()) / n) + 1e-9
    assert abs(want.mean() - got.mean()) < 4 * error
    assert abs(want.std() - got.std()) < 0.1 * want.std() + 0.01
    values = range(1, int(want.max()) + 1)
    assert max(abs((want <= v).mean() - (got <= v).mean()) for v in values) < 0.05


def test_wait_of_very_many_customers():
    key = hpy_model.mix(np.arange(1, 2001, dtype=np.uint64))
    got = seat(np.full(2000, 10 ** 9), np.zeros(2000), 1.0, 0.75, np.full(2000, 1e-7), key)
    # Almost no new table raises the weight: they come at rate weight / k.
    mean = 1 + 1.75e-7 * (math.log(10 ** 9) + 4)
    assert abs(got.mean() - mean) < 0.01 and seat(np.array([0, 1]), 0, 1.0, 0.75, 0.5, key[:2]).tolist() == [0, 1]


def test_a_context_sums_to_one():
    draw = np.random.default_rng(3)
    known, words = 500, 500
    customers = draw.integers(1, 400, words)
    parent_tables = seat(customers, 300, 1.0, 0.75, 1 / (known + 1), hpy_model.mix(np.arange(words, dtype=np.uint64)))
    parent = hpy_model.parent_chance(np.append(customers - 0.75 * parent_tables, 0), customers.sum(), parent_tables.sum(), known)
    assert abs(parent.sum() - 1) < 1e-12
    pairs = np.where(draw.random(words + 1) < 0.2, draw.integers(1, 90, words + 1), 0)
    tables = seat(pairs, 100, 1.0, 0.75, parent, hpy_model.mix(np.arange(words + 1, dtype=np.uint64)))
    got = hpy_model.chance(pairs - 0.75 * tables, pairs.sum(), tables.sum(), parent)
    assert abs(got.sum() - 1) < 1e-12 and got.min() > 0


def test_numbers_survive_packing():
    numbers = np.array([0, 1, 255, 256, 70_000, (1 << 32) - 1])
    assert decoded(coded(numbers)).tolist() == numbers.tolist() and decoded(coded([])).tolist() == []


def test_parts_of_a_context_have_its_whole_tables():
    hot = (np.array([5], np.uint64), np.array([2]))
    groups = np.array([5, 6], np.uint64)
    assert hpy_model._context_of(groups, hot).tolist() == [0, -1]
    words = np.arange(100, 300, dtype=np.uint64)
    row = {"bucket": 0, "groups": groups[:1].tobytes(), "sizes": coded([200]), "words": words.tobytes(), "pairs": coded(np.arange(200)), "counts": coded(np.full(200, 3)),
           "tables": coded(np.ones(200)), "total": coded(np.zeros(200))}
    answers = [packed(np.full(200, 0.25), "<f8")]
    few, many = (decoded(hpy_model._swept(row, answers, 1, hot, np.array([whole]), 1000, 1000, 1000.0, 1, True)[6]).sum() for whole in (200.0, 200_000.0))
    assert many > few + 100


def test_words_are_told_apart_by_all_bits():
    near = np.array([1 << 40, (1 << 40) + 1], np.uint64)
    rows = [{"words": near.tobytes(), "sums": packed([2, 3], "<f8")}, {"words": near[1:].tobytes(), "sums": packed([5], "<f8")}]
    every, total = hpy_model._summed(rows)
    assert every.tolist() == near.tolist() and total.tolist() == [2, 8]


def plain(rows):
    """Counts and base scores of texts, word by word."""
    told = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        held = i is None or zlib.crc32(str(i).encode()) % 7 == 2
        told.append((i, held, [*words, None]))
    count = collections.Counter(w for _, held, words in told if not held for w in words)
    total = sum(count.values())
    return [(i, held, len(words), sum(w in count for w in words), total, sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in words)) for i, held, words in told]


@pytest.mark.parametrize("source", ["odd rows", "given table"])
def test_counts_against_plain_python(spark, sf_dir, source):
    docs = cases.documents(spark) if source == "odd rows" else spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = hpy_model.seventh_scores(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    want = sorted(plain([(r["doc_id"], r["text"]) for r in docs.collect()]), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def exact_law(customers, others, parent, strength=1.0, discount=0.75):
    """Probability of each number of tables after so many customers, step by step."""
    law, t = np.zeros(customers + 2), np.arange(customers + 2)
    law[1] = 1
    for k in range(1, customers):
        w = (strength + discount * (others + t)) * parent
        moved = np.where(t <= k, w / (w + np.maximum(k - discount * t, 0.1)), 0) * law
        law -= moved
        law[1:] += moved[:-1]
    return law


@pytest.mark.parametrize("customers, others, parent", [(31, 3, 0.3), (32, 3, 0.3), (33, 3, 0.3), (70, 100, 0.01), (200, 50, 0.02), (600, 400, 0.3), (1500, 20, 1e-3), (1500, 2000, 0.01)])
def test_seats_have_the_exact_law(customers, others, parent):
    n = 60_000
    law = exact_law(customers, others, parent)
    got = seat(np.full(n, customers), np.full(n, others), 1.0, 0.75, np.full(n, parent), hpy_model.mix(np.arange(1, n + 1, dtype=np.uint64)))
    share = np.bincount(got.astype(int), minlength=len(law)) / n
    # Kolmogorov's distance: below 1.95 / sqrt(n) in 999 of 1000 samples of the law.
    assert np.abs(np.cumsum(share) - np.cumsum(law)).max() < 1.95 / math.sqrt(n)


def test_seats_do_not_depend_on_their_company(monkeypatch):
    draw = np.random.default_rng(8)
    customers, others, parent = draw.integers(0, 3000, 300), draw.integers(0, 500, 300), draw.random(300) ** 4
    key = hpy_model.mix(np.arange(300, dtype=np.uint64))
    together = seat(customers, others, 1.0, 0.75, parent, key)
    alone = [seat(customers[i:i + 1], others[i:i + 1], 1.0, 0.75, parent[i:i + 1], key[i:i + 1])[0] for i in range(300)]
    monkeypatch.setattr(hpy_model, "SEATED", 100)
    assert together.tolist() == alone == seat(customers, others, 1.0, 0.75, parent, key).tolist()
