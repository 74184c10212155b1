"""Decontamination against a brute-force search over all windows, on planted paraphrases."""
import math
import random
from collections import Counter

import numpy as np

from crmflow.llm import decontaminate


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def accepts(item, near):
    share = plain_lcs(item, near) / len(item)
    return share >= 0.75 or (share >= 0.5 and plain_lcs(item[-8:], near) >= 0.75 * len(item[-8:]))


def brute_force(texts, items):
    """Pairs that the rule accepts in some window of the item's length class."""
    out = set()
    for d, text in enumerate(texts):
        for k, item in enumerate(items):
            stride = (1 << math.ceil(math.log2(max(16, 1.5 * len(item))))) // 4
            if any(len(set(item) & set(near)) >= 2 and accepts(item, near) for near in (text[max(0, at - stride):at + 5 * stride] for at in range(0, len(text), stride))):
                out.add((d, k))
    return out


def planted(seed=3, documents=60, items=24):
    """Texts and items of word lists, and pairs with an item's words replaced: the rarest, or any, with or without its answer."""
    draw = random.Random(seed)
    word = lambda: f"w{int(draw.paretovariate(0.4)) % 100_000}"
    items = [[word() for _ in range(draw.randrange(16, 50))] for _ in range(items)]
    texts = [[word() for _ in range(250)] for _ in range(documents)]
    count = Counter(w for t in texts for w in set(t))
    want = set()
    for n, (k, item) in enumerate((k, item) for k, item in enumerate(items) for _ in range(2)):
        # 22% of the words without regard to the answer, or 40% outside of it.
        places = range(len(item)) if n % 2 else range(len(item) - 8)
        places = sorted(places, key=lambda i: (count[item[i]] if n % 4 < 2 else 0, draw.random()))[:int((0.22 if n % 2 else 0.4) * len(item))]
        new = [f"new{draw.random()}" if i in places else w for i, w in enumerate(item)]
        assert accepts(item, new)
        text = texts[n % documents]
        at = draw.randrange(len(text))
        text[at:at] = new
        want.add((n % documents, k))
    return texts, items, want


def test_paraphrases_are_found(spark):
    texts, items, want = planted()
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    every = brute_force(texts, items)
    assert want <= every
    assert len(want & got) >= 0.9 * len(want) and got == every


def test_least_mass_is_the_least():
    draw = np.random.default_rng(1)
    for n in (1, 2, 3, 9, 12):
        value = draw.random(n)
        answer = min(n, 8)
        best = min(value[[bool(s >> i & 1) for i in range(n)]].sum() for s in range(1 << n) if (c := s.bit_count()) >= 0.75 * n or (c >= 0.5 * n and (s >> (n - answer)).bit_count() >= 0.75 * answer))
        assert np.isclose(decontaminate.least_mass(value), best)


def test_items_in_several_blocks(spark, monkeypatch):
    texts, items, want = planted()
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(decontaminate, "MASKED", 0)
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    assert want <= {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}


def test_items_of_one_word_and_frequent_terms(spark):
    docs = spark.createDataFrame([(d, f"some common words in all texts {'singleton' if d == 3 else 'other'} end") for d in range(40)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(0, "Singleton."), (1, "common words in all texts")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(3, 0), *((d, 1) for d in range(40))}
