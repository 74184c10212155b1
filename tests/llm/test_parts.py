"""Parts of the operators against plain versions."""
import heapq
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from crmflow.llm import decontaminate, hpy_model, line_labels, mixing, pii, sharding, textgrid, token_files
from crmflow.llm import components as components_module
from crmflow.llm.components import components


@pytest.mark.parametrize("kind", ["small", "large", "mixed", "empty", "one"])
def test_simple8b_round_trip(kind):
    draw = np.random.default_rng(1)
    ids = {"small": draw.integers(0, 3, 20_000), "large": draw.integers(0, 1 << 32, 9_000), "empty": np.empty(0), "one": np.array([1]),
           "mixed": np.where(draw.random(30_000) < 0.01, draw.integers(1 << 20, 1 << 31, 30_000), draw.integers(0, 50_000, 30_000))}[kind].astype(np.uint32)
    words, offsets, escapes, _ = token_files.pack(ids)
    assert (token_files.unpack(words, offsets, escapes, len(ids)) == ids).all()
    if kind == "small":
        assert len(words) * 20 < len(ids)


def test_words_and_grams():
    texts = ["One  two\tThree", None, "", " a\x0bb\x0cc\nd ", "é x y"]
    for i, j, grid in textgrid.grids(pa.array(texts), size=4):
        for k in range(i, j):
            want = re.findall(r"[^\x20\x09-\x0D]+", texts[k] or "")
            spans = [(a, b) for a, b, d in zip(grid.start, grid.end, grid.doc) if d == k - i]
            assert [grid.data[a:b].tobytes().decode() for a, b in spans] == want


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (100, 101)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 160)}}


def tasks_of(spark, job):
    """Tasks that ``job`` runs where a shuffle has 20 partitions, none of them merged, and nothing is broadcast."""
    sc, group = spark.sparkContext, f"tasks-{random.random()}"
    held = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        sc.setJobGroup(group, "")
        job()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return sum(tracker.getStageInfo(s).numCompletedTasks for s in stages)


def test_a_round_of_components_shuffles_four_times(spark, monkeypatch):
    rounds, keep = [], components_module.saved
    monkeypatch.setattr(components_module, "saved", lambda *a: rounds.append(1) or keep(*a))
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long").coalesce(1)
    tasks = tasks_of(spark, lambda: components(edges))
    # The first shuffle and the write of all edges; then three joins and sums read by 20 tasks, two scans of up to 8 and a sum.
    assert len(rounds) > 3 and tasks <= 60 + (len(rounds) - 1) * 120


def test_a_pass_of_the_mix_adds_up_in_one_task(spark):
    rows = [(5, [0.9, 0.1]), (7, [0.2, 0.8]), (11, [0.6, 0.4])] * 4
    members = spark.createDataFrame(rows, "n_tokens long, posterior array<double>").repartition(4).localCheckpoint()
    found = []
    tasks = tasks_of(spark, lambda: found.append(mixing.descend(members, ["x", "y"], {"x": 0.5, "y": 0.5}, 0.0, 1.0)))
    steps, unmet = found[0]
    assert steps and unmet < 1e-3
    # Four partial sums a pass, and one task that adds them.
    assert tasks <= (len(steps) + 1) * 6


def test_longest_first_in_bulk_equals_one_by_one():
    draw = random.Random(2)
    sizes = sorted(draw.sample(range(1, 2000), 60), reverse=True)
    counts = [draw.choice([1, 3, 50, 900]) for _ in sizes]
    dealt = sharding.schedule(np.array(sizes), np.array(counts), 7)
    heap = [(0, k) for k in range(7)]
    for size, count in zip(sizes, counts):
        for _ in range(count):
            load, k = heapq.heappop(heap)
            heapq.heappush(heap, (load + size, k))
    assert dealt.sum(1).tolist() == counts
    assert sorted((dealt * np.array(sizes)[:, None]).sum(0)) == sorted(x for x, _ in heap)


def test_viterbi_against_all_paths():
    draw = np.random.default_rng(3)
    count, move = np.array([5, 0, 1, 3]), draw.normal(size=(2, 2))
    score = draw.normal(size=(9, 2))
    got, at = line_labels.viterbi(score, count, move), 0
    for n in count:
        best = max((tuple((p >> k) & 1 for k in range(n)) for p in range(1 << n)), key=lambda s: sum(score[at + k, x] for k, x in enumerate(s)) + sum(move[a, b] for a, b in zip(s, s[1:])))
        assert tuple(got[at:at + n]) == best
        at += n


def test_common_subsequence():
    draw = random.Random(4)
    for _ in range(60):
        a, b = [draw.randrange(4) for _ in range(draw.randrange(1, 12))], [draw.randrange(4) for _ in range(draw.randrange(12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == table[-1][-1]


def test_base_spans_against_plain_patterns():
    plain = [re.compile(x) for x in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]
    draw = random.Random(5)
    pieces = ["a@b.c", "@", "x.y+z@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+12", "é", " ", ".", "0000.1.2.3", "7"]
    for _ in range(400):
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(1, 9)))
        want = [(m.start(), m.end(), k) for k, p in enumerate(plain) for m in p.finditer(text)]

        def good(a, b, k):
            digits = re.sub("[^0-9]", "", text[a:b])
            return (k == 0, all(int(x) <= 255 for x in text[a:b].split(".")) if k == 1 else False, k == 2 and 12 <= len(digits) <= 19 and pii.luhn(digits), k == 3 and 9 <= len(digits) <= 15)[k]

        assert pii.base_spans(text) == sorted((s for s in want if good(*s)), key=lambda s: (s[0], s[2], s[1]))


def test_labelers_are_told_apart():
    draw = np.random.default_rng(6)
    truth = draw.random(4000) < 0.3
    rate = (0.95, 0.9, 0.55)
    votes = np.stack([np.where(draw.random(4000) < r, truth, ~truth) for r in rate], 1).astype(int)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    _, up, down, _ = pii.reliabilities(patterns, counts.astype(float))
    assert np.abs(up - rate).max() < 0.06 and np.abs(down - (1 - np.array(rate))).max() < 0.06


def test_seating():
    customers = np.array([0, 1, 2, 50, 5000])
    tables = hpy_model.seat(customers, 0, 1.0, 0.75, 0.5, textgrid.mix(np.arange(1, 6, dtype=np.uint64)))
    assert (tables <= customers).all() and (tables[1:] >= 1).all() and tables[0] == 0


def test_rates_meet_targets():
    draw = np.random.default_rng(8)
    n, p = draw.integers(1, 500, 3000).astype(float), draw.dirichlet([0.3] * 4, 3000)
    share = np.array([0.4, 0.3, 0.2, 0.1])
    want, steps, pairs = n.sum() * share, [], (n[:, None] * p).T @ p
    for _ in range(mixing.STEPS):
        steps.append(np.linalg.solve(pairs, (n * mixing.rates(p, steps, 0)) @ p - want))
    assert np.abs((n * mixing.rates(p, steps, 0)) @ p - want).max() < 1e-3 * want.sum()


def test_randomised_basis_spans_the_main_directions(spark):
    draw = np.random.default_rng(2)
    dense = (draw.random((60, 40)) < 0.3) * draw.random((60, 40)) * np.linspace(3, 0.1, 60)[:, None]
    basis = decontaminate.randomised_basis(spark, [(np.flatnonzero(r), r[r > 0]) for r in dense], 40, rank=30, steps=8)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-4)
    kept, best = np.linalg.norm(dense @ basis), np.sqrt((np.linalg.svd(dense, compute_uv=False)[:30] ** 2).sum())
    assert kept > 0.99 * best
    # Fewer directions than asked: those that there are.
    assert decontaminate.randomised_basis(spark, [(np.array([0, 1]), np.array([1.0, 2.0]))] * 3, 5, rank=3).shape == (5, 1)
