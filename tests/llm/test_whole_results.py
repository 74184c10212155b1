"""Whole results of registered queries and of stages against plain Python."""
import collections
import re
import zlib

import cases
import numpy as np
import pytest

import corpus_pipeline
from crmflow.llm import line_labels, mixing, ngram_join, quality_model, sharding
from crmflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain_lines(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    count = collections.Counter(windows)
    repeated = {k + x for k, w in enumerate(windows) if count[w] > 1 for x in range(8)}
    earlier, dup = set(), 0
    for line in lines:
        dup += bool(WORD.search(line)) and line in earlier
        earlier.add(line)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed


@pytest.mark.parametrize("source", ["odd rows", "given table"])
def test_quality_rules(spark, sf_dir, source):
    if source == "odd rows":
        docs = cases.documents(spark)
        got = line_labels.judged(docs, cases.labels(spark)).collect()
    else:
        docs, got = given(spark, sf_dir), QUERIES["op4_quality_rules"](spark, sf_dir).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = collections.Counter((r["doc_id"], *plain_lines(r["text"])) for r in docs.collect())
    assert collections.Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got) and (source == "odd rows" or any(r["kept"] for r in got))


@pytest.mark.parametrize("source", ["odd rows", "given table"])
def test_shards(spark, sf_dir, source):
    docs = cases.documents(spark) if source == "odd rows" else given(spark, sf_dir)
    got = (sharding.sharded(docs) if source == "odd rows" else QUERIES["op5_sharding"](spark, sf_dir)).collect()
    texts = collections.defaultdict(list)
    want = collections.Counter()
    for r in docs.collect():
        raw = (r["text"] or "").encode()
        texts[zlib.crc32(raw), len(raw) + 16].append(r["doc_id"])
        want[r["doc_id"], len(raw) + 16, zlib.crc32(raw)] += 1
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)} and {r["shard"] for r in got} <= set(range(40))
    # Groups stay together, slots have no gaps, and no shard exceeds the least loaded by more than the largest group.
    place, slots, load = collections.defaultdict(set), collections.defaultdict(list), [0] * 40
    for r in got:
        place[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(x) == 1 for x in place.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(load) - min(load) <= max(size * len(ids) for (_, size), ids in texts.items())


def test_mix_meets_its_targets(spark, sf_dir):
    docs = given(spark, sf_dir).select("doc_id", "text").collect()
    got = QUERIES["op1_mixing_to_target_weights"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == sorted((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in docs)
    total = collections.Counter()
    for r in got:
        assert abs(sum(r["posterior"].values()) - 1) < 1e-6 and r["posterior"][r["domain"]] == max(r["posterior"].values())
        assert r["rate"] >= 0 and r["copies"] - r["rate"] < 1 and r["rate"] - r["copies"] < 1
        for domain, x in r["posterior"].items():
            total[domain] += r["rate"] * r["n_tokens"] * x
    tokens = sum(r["n_tokens"] for r in got)
    known = sum(mixing.TARGETS.get(d, 0) for d in total)
    miss = max(abs(total[d] / tokens - mixing.TARGETS.get(d, 0) / known) for d in total)
    assert {r["unmet"] for r in got} == {got[0]["unmet"]} and abs(miss - got[0]["unmet"]) <= 2 * mixing.CLOSE


def test_targets_out_of_reach_are_told(spark):
    # Clear domains: 800 documents of one, 200 of the other, ten words each.
    docs = spark.createDataFrame([(i, " ".join(["apple" if i % 5 else "pear"] * 10)) for i in range(1000)], SCHEMA)
    labelled = docs.selectExpr("doc_id", "case when doc_id % 5 > 0 then 'a' else 'b' end as domain").where("doc_id < 200")
    targets = {"a": 0.5, "b": 0.5}

    def result(floor, growth):
        got = mixing.rated(docs, labelled, targets, floor, growth).collect()
        total = [sum(r["rate"] * r["n_tokens"] * r["posterior"][d] for r in got) for d in "ab"]
        return total, got[0]["unmet"]

    total, unmet = result(0.0, 1.0)
    assert np.allclose(total, [5000, 5000], rtol=1e-3) and unmet == 0
    # No document goes: the first domain keeps its tokens, the rest of the mix goes to the second, and the miss is told.
    total, unmet = result(1.0, 1.25)
    assert abs(total[0] - 8000) < 60 and abs(total[1] - 4500) < 60 and abs(unmet - 1750 / 12500) < 0.01
    with pytest.warns(RuntimeWarning, match="misses a target"):
        mixing.mixed(docs, labelled, targets, 1.0, 1.25)


def test_totals_in_reach():
    want, least = np.array([50.0, 30, 20]), np.array([10.0, 28, 25])
    got = mixing.in_reach(want, least)
    assert np.isclose(got.sum(), 100) and (got >= least - 1e-9).all() and got[2] == 25 and np.isclose(got[0] / got[1], 46.875 / 28.125)
    assert (mixing.in_reach(want, 0 * least) == want).all() and (mixing.in_reach(want, 9 * least) == 9 * least).all()


def test_quality_without_id_is_not_held_out(spark):
    got = quality_model.quality_scores(cases.documents(spark), cases.labels(spark)).collect()
    assert all(r["held_out"] is (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_toxic_rows_are_caught(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rejected = {r["doc_id"]: r["rejected"] for r in QUERIES["op10_toxicity"](spark, folder).collect()}
    toxic = [rejected[i] for i, t in labels.items() if t == 1]
    clean = [rejected[i] for i, t in labels.items() if t == 0]
    assert len(toxic) > 40 and sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    kept = corpus_pipeline.drop_toxic(spark, given(spark, folder), folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, x in rejected.items() if not x)


def test_a_repeated_id_with_other_texts(spark):
    one, other, third = cases.prose(1, 80), cases.prose(2, 80), cases.prose(3, 300)
    near = third.replace(third.split()[200], "changed", 1)
    rows = [(1, one), (2, one), (2, other), (2, other), (None, third), (None, third), (None, near), (3, None), (3, ""), (None, "")]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len([r for r in kept if r["doc_id"] is None and r["text"] in (third, near)]) == 1
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    rest = [tuple(r) for r in kept if not (r["doc_id"] is None and r["text"])]
    assert sorted(rest, key=key) == sorted([(1, one), (2, other), (3, None), (3, ""), (None, "")], key=key)


def test_links_through_rows_without_id(spark):
    third = cases.prose(3, 300)
    words = third.split()
    # 5 and 6 link through a row without id only.
    step = [" ".join("x" if k in off else w for k, w in enumerate(words)) for off in ((20, 60), (20,), (20, 100))]
    far = [" ".join("y" if k in off else w for k, w in enumerate(words)) for off in ((), (40,), (80,), (120,))]
    rows = [(5, step[0]), (None, step[1]), (6, step[2]), (None, far[0]), (5, far[1]), (9, "other words that link with nothing")]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    sets = [set(zip(w, w[1:], w[2:])) for w in (t.split() for _, t in rows)]
    lowest = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                    lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    name = {g: min((rows[k][0] for k in range(len(rows)) if lowest[k] == g and rows[k][0] is not None), default=None) for g in lowest}
    want = collections.Counter((rows[k][0], len(sets[k]), name[lowest[k]]) for k in range(len(rows)))
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want


def test_near_copies_of_the_given_table(spark, sf_dir):
    docs = given(spark, sf_dir)
    rows = [(r["doc_id"], WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))) for r in docs.collect()]
    sets = {i: set(zip(*(w[k:] for k in range(5)))) if len(w) > 4 else ({tuple(w)} if w else set()) for i, w in rows}
    lowest = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and sets[a]]
    for _ in links:
        for a, b in links:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    assert links and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i in sets if lowest[i] == i)
