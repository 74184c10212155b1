"""Families of the n-gram join that candidates tie together without a link: they are cut before n-grams are sent."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crmflow.llm import ngram_join

SCHEMA = "doc_id long, text string"


def drawn_sets(draw, count=240):
    bases = [draw.integers(0, 1 << 63, n).astype(np.uint64) for n in (12, 40, 130, 700)]
    sets = []
    for k in range(count):
        base = bases[k % 4]
        kept = draw.random(len(base)) > draw.choice([0.02, 0.1, 0.3])
        sets.append(np.unique(np.concatenate([base[kept], draw.integers(0, 1 << 63, int((~kept).sum())).astype(np.uint64)])))
    return sets, np.array([len(x) for x in sets])


def linked(sets, size, percent):
    both = ngram_join.overlaps(sets)
    return 100 * both >= percent * (size[:, None] + size[None, :] - both)


def joined(count, pairs):
    label = np.arange(count)
    for a, b in pairs:
        label[label == label[b]] = label[a]
    return label


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("sides", [1, 2])
def test_sketches_keep_every_link(percent, sides):
    sets, size = drawn_sets(np.random.default_rng(percent))
    value, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    raw, cut = ngram_join.sketches(value, doc, size)
    side = np.arange(len(sets)) % 8 < 4 if sides == 2 else np.zeros(len(sets), bool)
    label = joined(len(sets), ngram_join.near_links([raw[a:b] for a, b in zip(cut, cut[1:])], size, side, percent))
    asked = linked(sets, size, percent) & ((side[:, None] != side) | (sides == 1))
    assert (label[:, None] == label)[asked].all()
    # Rows of different bases are told apart.
    apart = (np.arange(len(sets))[:, None] - np.arange(len(sets))) % 4 > 0
    assert not (label[:, None] == label)[apart].any()


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_rows_share_a_slice(percent):
    sets, size = drawn_sets(np.random.default_rng(7))
    value, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    for common in (np.empty(0, np.uint64), np.sort(np.concatenate([sets[3][:450], sets[2][:90], sets[1][:10]]))):
        key, owner = ngram_join.slice_keys(value, doc, size, percent, common)
        share = np.zeros((len(sets), len(sets)), bool)
        for k in np.unique(key):
            rows = owner[key == k]
            share[np.ix_(rows, rows)] = True
        assert share[linked(sets, size, percent)].all()


def test_empty_slices_tie_no_unrelated_rows():
    draw = np.random.default_rng(3)
    common = np.unique(draw.integers(0, 1 << 63, 200_000).astype(np.uint64))
    sets = [np.sort(np.concatenate([draw.choice(common, 70, replace=False), draw.integers(0, 1 << 63, 30).astype(np.uint64)])) for _ in range(200)]
    size = np.array([len(x) for x in sets])
    key, owner = ngram_join.slice_keys(np.concatenate(sets), np.repeat(np.arange(200), size), size, 80, common)
    found, times = np.unique(np.unique(np.stack([key.astype(np.uint64), owner.astype(np.uint64)], 1), axis=0)[:, 0], return_counts=True)
    assert len(found) and (times > 1).sum() < 20


def chain(draw, rows, words=300, step=60):
    """Texts of which each shares 0.67 of its n-grams with the next one: candidates, but no links at 0.8."""
    line = [f"w{draw.randrange(1 << 40)}" for _ in range(words + step * rows)]
    return [" ".join(line[k * step:k * step + words]) for k in range(rows)]


def test_a_family_without_links_is_not_sent_block_by_block(spark, monkeypatch):
    draw, sent, keep = random.Random(4), [], ngram_join.saved

    def spied(df, name):
        out = keep(df, name)
        if name == "members":
            copies = F.size("places") if "places" in out.columns else F.greatest(F.col("blocks") - 1, F.lit(1))
            sent.append(out.agg(F.count("*"), F.coalesce(F.sum(copies), F.lit(0))).first())
        return out

    monkeypatch.setattr(ngram_join, "saved", spied)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 4)
    texts = chain(draw, 60)
    rows = [(k, x) for k, x in enumerate(texts)] + [(100 + k, x + " more words here") for k, x in enumerate(texts[:3])]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(spark.createDataFrame(rows, SCHEMA), 5, 80).collect()}
    assert got == {**{k: k for k in range(60)}, **{100 + k: k for k in range(3)}}
    # What goes to the product of n-grams: hardly a row but the six that link, each once.
    assert sent[-1][1] <= 12


def test_many_blocks_give_the_components_of_one(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"w{draw.randrange(1 << 40)}" for _ in range(200)]
    rows = []
    for k in range(90):
        words = list(base[:draw.choice([120, 150, 175, 200])])
        for _ in range(draw.choice([0, 1, 2, 6])):
            words[draw.randrange(len(words))] = f"x{draw.randrange(1 << 40)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, SCHEMA)
    sets = {k: {tuple(x.split()[i:i + 5]) for i in range(len(x.split()) - 4)} for k, x in rows}
    want = {k: k for k in sets}
    for _ in sets:
        before = dict(want)
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * len(sets[a] | sets[b]):
                    want[a] = want[b] = min(want[a], want[b])
        if want == before:
            break
    for blocks in ((1024, 8192), (4, 8), (3, 2)):
        monkeypatch.setattr(ngram_join, "BLOCK_DOCS", blocks[0])
        monkeypatch.setattr(ngram_join, "SKETCH_DOCS", blocks[1])
        got = ngram_join.jaccard_components(docs, 5, 80).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want, blocks
